"""Quality rules by distribution divergence, in DataFrame functions only.

Every document gets two histograms: characters by class, and how often the
common words of each language occur among its words. The histograms of the
documents that pass the base rules are added up per language, over the whole
table, into references. A document is kept if its Jensen-Shannon distance to
the nearest language's references stays below the limits. Texts with fewer than
``MIN_WORDS`` words fail the base rules, so no distance is judged on too little;
the common-word distance is judged from ``MIN_COMMON`` words on.

Everything about one document is computed inside its row, without a shuffle;
only the sums per language are shuffled. The references of the four languages
with common words of their own are compared with every document. Any other
language with ``MIN_REFERENCE`` passing documents has a reference too, joined to
its own documents. A document of a language with fewer is judged by the base
rules alone; so are all documents where there is no reference at all. A null
language is compared with the four.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.scratch import written

MIN_WORDS = 50
#: Share of words in repeated three-word windows above which the base rules fail, in percent.
MAX_REPEATED = 50
#: Words from which the distance of common words is judged.
MIN_COMMON = 100
#: Documents that pass the base rules from which a language without common words of its own has a reference.
MIN_REFERENCE = 20
#: Largest Jensen-Shannon distances (base 2) of a kept document.
MAX_CHARACTER_DISTANCE = 0.20
MAX_COMMON_DISTANCE = 0.26

# Common words of the four languages.
COMMON_WORDS = {
    "de": ["das", "der", "die", "ein", "für", "ist", "mit", "nicht", "und", "von"],
    "en": ["and", "for", "in", "is", "of", "that", "the", "to", "was", "with"],
    "es": ["con", "de", "el", "en", "la", "los", "por", "que", "se", "y"],
    "fr": ["dans", "de", "des", "est", "et", "la", "le", "les", "pour", "que"],
}
LANGUAGES = sorted(COMMON_WORDS)
#: Every common word once. One more class counts all other words.
WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})
#: Character classes, as patterns of what belongs to them; what is left is the last class.
CLASSES = [
    "[a-z]", "[\\x20\\x09-\\x0D]", "[^\\x00-\\x7F]", "[A-Z]", "[.,;:!?]", "[0-9]", "[#*$%&|<>]",
]
SYMBOL = CLASSES.index("[#*$%&|<>]")
SPACE = 1
GAP = CLASSES[SPACE] + "+"


def _base(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Base counts and the two histograms of every row of ``docs``, computed inside the row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), text.alias("_text"))
    # each class is taken out of what the earlier ones left, so texts get shorter
    rest, counts = "_text", []
    for k, pattern in enumerate(CLASSES):
        rows = rows.withColumn(f"_rest{k}", F.regexp_replace(rest, pattern + "+", ""))
        counts.append(F.char_length(rest) - F.char_length(f"_rest{k}"))
        rest = f"_rest{k}"
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    words = F.filter(F.split("_text", GAP), lambda w: w != "")
    rows = rows.select(
        "doc_id", "lang", F.char_length("_text").alias("_chars"), F.array(*counts, F.char_length(rest)).cast("array<bigint>").alias("characters"),
        lines.alias("_lines"), words.alias("_words"),
    )
    rows = rows.withColumn("_common", F.filter("_words", lambda w: w.isin(WORDS)))
    window = lambda i: F.xxhash64(F.get("_words", i), F.lit("\n"), F.get("_words", i + 1), F.lit("\n"), F.get("_words", i + 2))
    places = F.when(F.size("_words") >= 3, F.sequence(F.lit(0), F.size("_words") - 3)).otherwise(F.array().cast("array<int>"))
    # windows in order of their hash: equal ones become neighbours
    rows = rows.withColumn("_sorted", F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("h"), i.alias("i")))))
    near = lambda k: F.get("_sorted", k)["h"]
    again = F.filter("_sorted", lambda w, k: (near(k - 1) == w["h"]) | (near(k + 1) == w["h"]))
    rows = rows.withColumn("_again", F.sort_array(F.transform(again, lambda w: w["i"])))
    # a repeated window covers three words, or those up to the next repeated window
    covered = F.transform("_again", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("_again", k + 1) - i, F.lit(3))))
    times = lambda c: F.size(F.filter("_common", lambda w: w == F.lit(c)))
    return rows.select(
        "doc_id", "lang", "characters",
        F.array(*map(times, WORDS), F.size("_words") - F.size("_common")).cast("array<bigint>").alias("words"),
        F.size("_words").cast("bigint").alias("n_words"),
        (F.col("_chars") - F.col("characters")[SPACE]).cast("bigint").alias("word_chars"),
        F.col("characters")[SYMBOL].alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("bigint"), lambda total, x: total + x).alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))


def references(measured: DataFrame) -> DataFrame:
    """``lang, ref_characters, ref_words``: histograms summed over all documents of a language that pass the base rules.

    One row for each fixed language, and for each other one with at least
    ``MIN_REFERENCE`` such documents.
    """
    sums = [
        F.array(*[F.sum(F.col(name)[k]) for k in range(size)]).alias(f"ref_{name}") for name, size in (("characters", len(CLASSES) + 1), ("words", len(WORDS) + 1))
    ]
    passing = measured.filter(~F.col("base_failed") & F.col("lang").isNotNull()).groupBy("lang").agg(F.count("*").alias("_n"), *sums)
    return passing.filter((F.col("_n") >= MIN_REFERENCE) | F.col("lang").isin(LANGUAGES)).drop("_n")


def distance(counts: str, reference: list[int] | str) -> Column:
    """Jensen-Shannon distance (base 2) of a column of counts to fixed counts or to another column; 1 if either is empty."""
    if not isinstance(reference, str):
        total = F.lit(sum(reference))
        given = F.array(*[F.lit(n / max(sum(reference), 1)) for n in reference])
    else:
        total = F.aggregate(reference, F.lit(0).cast("bigint"), lambda s, x: s + x)
        given = F.transform(reference, lambda n: n / total)
    whole = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, x: s + x)
    share = lambda x, mean: F.when(x > 0, x * F.log2(x / mean)).otherwise(F.lit(0.0))
    terms = F.zip_with(F.transform(counts, lambda n: n / whole), given, lambda p, q: share(p, (p + q) / 2) + share(q, (p + q) / 2))
    divergence = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2
    return F.when((whole > 0) & (total > 0), F.sqrt(F.greatest(divergence, F.lit(0.0)))).otherwise(F.lit(1.0))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, distances to the nearest language and the verdict ``kept`` for every row of ``docs``."""
    measured = written(_base(docs, id_col, text_col, lang_col))
    known = written(references(measured))
    # at most one row per fixed language comes to the driver; other languages are joined
    fixed = {r["lang"]: (r["ref_characters"], r["ref_words"]) for r in known.filter(F.col("lang").isin(LANGUAGES)).collect()}
    others = known.filter(~F.col("lang").isin(LANGUAGES))
    rows = measured.join(others, "lang", "left")

    def nearest(name: str, at: int) -> Column:
        own = F.when(F.col(f"ref_{name}").isNotNull(), distance(name, f"ref_{name}")).otherwise(1.0)
        return F.least(*[distance(name, r[at]) for r in fixed.values()], own, F.lit(1.0))

    judged = rows.withColumn("character_distance", nearest("characters", 0)).withColumn("common_distance", nearest("words", 1))
    near = (F.col("character_distance") <= MAX_CHARACTER_DISTANCE) & ((F.col("common_distance") <= MAX_COMMON_DISTANCE) | (F.col("n_words") < MIN_COMMON))
    # a language of too few documents has nothing to be compared with
    alone = F.col("ref_characters").isNull()
    if fixed:
        alone &= F.col("lang").isNotNull() & ~F.col("lang").isin(LANGUAGES)
    return judged.withColumn("kept", ~F.col("base_failed") & (near | F.coalesce(alone, F.lit(False)))).select("doc_id", *[c for c in measured.columns if c not in ("doc_id", "characters", "words")], "character_distance", "common_distance", "kept")
