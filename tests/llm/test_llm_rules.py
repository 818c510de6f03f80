"""Quality rules, secrets and the pipeline."""

from llm_brute import base_quality, base_secrets, rows, sha

from spendwatch.llm import divergence, ownership

FOLDER = "/root/testdata/sf0.01"
BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
KINDS = ["assign", "access", "hex"]


def test_quality_query(spark, text_queries, texts):
    made = text_queries["op4_quality_rules"](spark, FOLDER)
    assert rows(made, *BASE) == sorted(base_quality(texts), key=repr)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    judged = made.toPandas().merge(labels, on="doc_id")
    judged = judged[~judged["base_failed"]]
    assert judged[judged["quality"] == 1]["kept"].mean() > 0.97
    assert judged[judged["quality"] == 0]["kept"].mean() < 0.5
    assert not made.filter("base_failed AND kept").count()


def test_quality_of_odd_rows(odd, odd_texts, nothing):
    assert rows(divergence.quality(odd), *BASE) == sorted(base_quality(odd_texts), key=repr)
    assert divergence.quality(nothing).collect() == []


def test_distance_is_jensen_shannon(spark):
    import math

    p, q = [3, 0, 5, 2], [1, 4, 0, 5]
    share = lambda x: [v / sum(x) for v in x]
    mean = [(a + b) / 2 for a, b in zip(share(p), share(q))]
    part = lambda x: sum(a * math.log2(a / m) for a, m in zip(share(x), mean) if a)
    frame = spark.createDataFrame([(p,), ([0, 0, 0, 0],)], "c array<bigint>")
    found = sorted(r[0] for r in frame.select(divergence.distance("c", q)).collect())
    assert abs(found[0] - math.sqrt((part(p) + part(q)) / 2)) < 1e-12 and found[1] == 1.0


def test_a_language_without_common_words_has_a_reference_of_its_own(spark, documents):
    """Texts that pass in English pass in other letters too; a few of a language are judged by the base rules alone."""
    cyrillic = str.maketrans("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "абцдефгхийклмнопярстувжызщАБЦДЕФГХИЙКЛМНОПЯРСТУВЖЫЗЩ")
    base = divergence.quality(documents.filter("lang = 'en'"))
    good = {r["doc_id"] for r in base.filter("kept").collect()}
    english = [(r["doc_id"], r["text"], "en") for r in documents.filter("lang = 'en'").collect()]
    other = [(-1 - i, t.translate(cyrillic), "ru") for i, t, _ in english if i in good]
    junk = [(10**6 + k, "$#*|<> 1234 %&" * 60, "ru") for k in range(10)]
    few = [(10**7 + k, other[k][1], "bg") for k in range(3)]
    made = {r["doc_id"]: r["kept"] for r in divergence.quality(spark.createDataFrame(english + other + junk + few, "doc_id bigint, text string, lang string")).collect()}
    assert sum(made[i] for i, *_ in other) >= 0.95 * len(other)
    assert not any(made[i] for i, *_ in junk) and all(made[i] for i, *_ in few)


def test_secrets_query(spark, text_queries, texts):
    made = {r["doc_id"]: r for r in text_queries["op10_secrets"](spark, FOLDER).collect()}
    for i, t in texts:
        base = base_secrets(t)
        named = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert made[i]["base_sha256"] == sha(named)
        assert [x for x in made[i]["spans"].split(",") if x and not x.startswith("live")] == [x for x in named.split(",") if x]
        assert [made[i][f"n_{k}"] for k in KINDS] == [sum(s[1] == n for s in base) for n in range(3)]


def test_copied_examples_and_live_values(spark):
    copied, own, short = "0123456789abcdef" * 2, "fedcba9876543210" * 2 + "ab", "hunter2x"
    docs = [(1, f"token = {copied}", "a"), (2, f"see {copied} there", "b"), (3, f"é secret: '{own}' end", "c"), (3, f"é secret: '{own}' end", "c"), (4, f"password={short}", "d"), (5, None, None)]
    frame = spark.createDataFrame(docs, "doc_id int, text string, source string")
    made = {r["row"]["doc_id"]: r for r in ownership.scan_secrets(frame).collect()}
    assert made[1]["n_live"] == made[2]["n_live"] == 0 and made[1]["n_shared"] == 1
    at = docs[2][1].index(own)
    assert f"live:{at}:{at + len(own)}" in made[3]["spans"] and made[3]["live"] == [own]
    assert made[4]["n_assign"] == 1 and made[4]["n_live"] == 0 and made[5]["spans"] == ""
    clean = ownership.redacted(frame)
    assert clean.columns == frame.columns and clean.count() == len(docs)
    assert not [r for r in clean.collect() if r["text"] and own in r["text"]] and clean.filter(f"text LIKE '%{copied}%'").count() == 2


def test_secrets_of_odd_rows(odd, odd_texts, nothing):
    made = ownership.scan_secrets(odd, keep=["doc_id"])
    found = rows(made.select("row.doc_id", "n_assign", "n_access", "n_hex"), "*")
    wanted = [(i, *(sum(s[1] == n for s in base_secrets(t)) for n in range(3))) for i, t in odd_texts]
    assert found == sorted(wanted, key=repr)
    assert ownership.redacted(odd).columns == odd.columns and ownership.redacted(nothing).collect() == []


def test_pipeline_stages(spark, odd):
    """Each stage bears odd rows and keeps the columns; the whole run on the small tables obeys its own rules."""
    import corpus_pipeline

    folder, docs = FOLDER, odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == odd.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() > 0
    assert corpus_pipeline.near_duplicates(spark, odd.limit(0), folder).collect() == []


def test_pipeline_query(spark, text_queries, documents):
    packed = text_queries["pipeline"](spark, FOLDER).toPandas()
    kept = set(packed["doc_id"])
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    good, bad = (set(labels[labels["quality"] == q]["doc_id"]) for q in (1, 0))
    assert len(kept & bad) < 0.1 * len(bad) and len(kept & good) > 0.7 * len(good)
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    assert len({texts[i] for i in kept}) == len(kept)
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096
