"""Classifier, personal data and page extraction: held-out accuracy and brute force."""

import time

import numpy as np
import pytest
from llm_brute import base_personal, rows, sha

from spendwatch.llm import extraction, factorise, personal
from spendwatch.llm.domblocks import leaf_blocks
from spendwatch.llm.tagger import CODES, Tagger

FOLDER = "/root/testdata/sf0.01"
KINDS = ["email", "ip", "card", "phone"]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_classifier_query(spark, text_queries, labels):
    made = text_queries["op9_quality_classifier"](spark, FOLDER).toPandas()
    assert len(made) == 1_000 and made["score"].between(0, 1).all() and ((made["score"] >= 0.3) == (made["predicted"] == 1)).all()
    import zlib

    assert [zlib.crc32(str(i).encode()) % 5 == 0 for i in made["doc_id"]] == made["held_out"].tolist()
    judged = made[made["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (judged["predicted"] == judged["quality"]).mean() > 0.95
    assert judged[judged["quality"] == 1]["predicted"].mean() > 0.98


def test_pairwise_identity():
    """The linear-time score equals the sum over all pairs."""
    rng = np.random.default_rng(1)
    size = factorise.BUCKETS + factorise.STATS
    machine = factorise.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, 4)), np.zeros(factorise.STATS), np.ones(factorise.STATS))
    made = factorise.features([b"one two three two", b""])
    row, feature, value = machine.rows(*made)
    margins, _ = machine.margins(row, feature, value, 2)
    for k in range(2):
        f, x = feature[row == k], value[row == k]
        pairs = sum(machine.factors[f[i]] @ machine.factors[f[j]] * x[i] * x[j] for i in range(len(f)) for j in range(i))
        assert abs(margins[k] - (0.3 + machine.linear[f] @ x + pairs)) < 1e-9


def test_classifier_on_odd_rows(spark, odd, nothing):
    few = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (None, 1), (5, None), (9, 7), (16, 0), (10, 1)], "doc_id bigint, quality int")
    machine = factorise.train(odd, few)
    made = factorise.scored(odd, machine, ["doc_id"]).toPandas()
    assert len(made) == odd.count() and made["score"].between(0, 1).all()
    assert factorise.scored(nothing, machine).count() == 0
    none = factorise.train(nothing, few.limit(0))
    assert {r["score"] for r in factorise.scored(odd, none).collect()} == {0.5}
    kept = factorise.accepted(odd, few.limit(0))
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_base_personal_data(spark, text_queries, texts):
    made = text_queries["op6_personal_data"](spark, FOLDER)
    found = rows(made, "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256")
    wanted = []
    for i, t in texts:
        base = base_personal(t)
        wanted.append((i, *(sum(s[0] == k for s in base) for k in range(4)), sha(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base))))
    assert found == sorted(wanted, key=repr)
    spans = {r["doc_id"]: r["spans"].split(",") for r in made.select("doc_id", "spans").collect()}
    assert all(f"{KINDS[k]}:{a}:{b}" in spans[i] for i, t in texts for k, a, b in base_personal(t))


ODD_TEXTS = [
    "a@b.c@d.e.f x@y z.w@-.- @. 1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.256 00.0.0.00001", "4111-1111 1111 1111 5 4111  1111", "+1 (((( +12345678 9+123456789012345 6",
    "+ +1 +33.1.2.3.4.5.6.7.8.9", "", "@", "é@é.com é.x@host.de", "1" * 3_000, "a" * 3_000 + "@", "- 1 - 2 -3", "9 9-9 9",
]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_base_spans_of_odd_texts(text):
    assert sorted(personal.base_spans(text)) == base_personal(text)


def test_tagger_learns_and_stretches_join():
    tagger = personal.trained()
    ids, tags = personal.labelled_windows(200, seed=77)
    scores = tagger.emissions(ids)
    right = np.mean([(tagger.decode(scores[:, k]) == tags[:, k]).mean() for k in range(200)])
    assert right > 0.95
    text = "call (415) 555-0199 or 5105 1051 0510 5106 and bob @ host.example.com today"
    added = {(k, text[a:b]) for k, a, b in personal.all_spans(tagger, [text])[0][1]}
    assert (3, "(415) 555-0199") in added and (0, "bob @ host.example.com") in added
    # every character of a long run of digits lies in one stretch, cut into overlapping windows
    text = "x" * 50 + "1" * 500 + "y" * 50
    assert personal.stretches(text) == [(50 - personal.AROUND, 550 + personal.AROUND)]
    personal.tagged_spans(tagger, [text, "", "no digits at all"])


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    tagger = Tagger(5, seed=2)
    ids, tags = rng.integers(0, CODES, (6, 3)), rng.integers(0, 5, (6, 3))
    _, grads = tagger.gradients(ids, tags)
    for name in tagger.w:
        flat, grad = tagger.w[name].reshape(-1), grads[name].reshape(-1)
        for at in rng.choice(np.flatnonzero(np.abs(grad) > 1e-4), 3):
            kept = flat[at]
            flat[at] = kept + 1e-5
            up = tagger.gradients(ids, tags)[0]
            flat[at] = kept - 1e-5
            down = tagger.gradients(ids, tags)[0]
            flat[at] = kept
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-4 * max(1, abs(grad[at])), name


def test_personal_data_in_odd_rows(odd, odd_texts, nothing):
    tagger = Tagger(personal.TAGS)
    made = personal.find_personal(odd, tagger)
    assert rows(made, "doc_id", "n_email") == sorted(((i, sum(s[0] == 0 for s in base_personal(t))) for i, t in odd_texts), key=repr)
    assert personal.find_personal(nothing, tagger).collect() == []


def test_field_on_held_out_pages():
    chain = extraction.trained()
    right = count = 0
    for page, labels in extraction.labelled_pages(80, seed=909):
        blocks = leaf_blocks(page)
        found = chain.decode([chain.emissions(blocks)])[0]
        right, count = right + (found == labels).sum(), count + len(labels)
    assert right / count > 0.97


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    chain = extraction.Chain({}, np.zeros((0, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    scores = [rng.normal(size=(n, 2)) for n in (1, 5, 3, 0)]
    for s, path in zip(scores, chain.decode(scores)):
        worth = lambda p: sum(s[t, x] for t, x in enumerate(p)) + chain.begin[p[0]] + sum(chain.moves[a, b] for a, b in zip(p, p[1:]))  # noqa: B023, E731
        every = [[k >> t & 1 for t in range(len(s))] for k in range(2 ** len(s))] if len(s) else []
        assert not every or worth(path.astype(int).tolist()) == pytest.approx(max(map(worth, every)))


def test_pages_query(spark, text_queries):
    """The generated pages mark their article, so the wanted text can be cut out plainly."""
    import html
    import re

    made = {r["page_id"]: r for r in text_queries["op1_html_extraction"](spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(made) == len(pages)
    for p in pages:
        article = re.search(r"(?s)<article>(.*?)</article>", p["html"])[1]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", x).replace("<br>", " ")).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert made[p["page_id"]]["text"] == "\n\n".join(x for x in parts if x)
        assert made[p["page_id"]]["n_chars"] == len(made[p["page_id"]]["text"])


def test_odd_pages(spark):
    pages = [
        (1, "u", None), (2, None, ""), (None, "u", "<p>"), (3, "u", "no markup at all"), (4, "u", "<article><h1>A &amp; B</h1><p>One<br>two&nbsp; three<p>Four.</article"),
        (5, "u", "<script>var x = '<p>no</p>';</script><!-- <p>no</p> --><main><p>Yes it is, and this is all of it.</p></main><style>p{}</style><nav><a href='>'>Home</a></nav>"),
        (5, "u", "<article>" + "<p>Long text here.</p>" * 3_000 + "</article>"), (6, "u", "<" * 50 + "&" * 50 + "</p></p></div>"),
    ]
    frame = spark.createDataFrame([(*p, 1, "t") for p in pages], "page_id int, url string, html string, n_chars int, text string")
    made = {(r["page_id"], r["n_chars"]): r["text"] for r in extraction.extract(frame).collect()}
    assert len(made) == len(pages)
    by_id = {k[0]: t for k, t in made.items()}
    assert by_id[1] == by_id[2] == by_id[None] == ""
    assert by_id[4] == "A & B\n\nOne two three\n\nFour."
    assert {t for k, t in made.items() if k[0] == 5} == {"Yes it is, and this is all of it.", "\n\n".join(["Long text here."] * 3_000)}
    assert extraction.extract(frame.limit(0)).collect() == []


def test_deep_pages_take_linear_work():
    """Unclosed elements nest as deep as the page is long; blocks share them instead of copying the path."""
    chain = extraction.trained()

    def seconds(n: int) -> float:
        start = time.perf_counter()
        blocks = leaf_blocks("<div>ab " * n)
        assert len(blocks) == n and len(chain.decode([chain.emissions(blocks)])[0]) == n
        return time.perf_counter() - start

    seconds(500)
    assert seconds(16_000) < 9 * min(seconds(4_000) for _ in range(3))  # 16 times if it were quadratic
    for page in ("<ul><li>" + "<div>x" * 5_000 + "<li>y" * 5_000, "<div>a</p>" * 5_000, "<a>b<td>c" * 5_000):
        assert leaf_blocks(page)


def test_long_pages_are_decoded_alone():
    sizes = [3, 10**6, 5, 0, 70_000, 4]
    groups = extraction._alike(sizes)
    assert sorted(k for g in groups for k in g) == list(range(6))
    assert all(len(g) == 1 or len(g) * max(sizes[k] for k in g) <= extraction.PLACES for g in groups)
    assert [k for g in groups if len(g) == 1 for k in g] == [4, 1]
