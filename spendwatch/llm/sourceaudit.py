"""Divergence of the sources of a language by their words.

Tasks sort word-start pointers over blocks of the Arrow text buffers
(``pointersort``); a run of equal words yields, for each language and source in
it, its occurrences and documents. Spark adds these rows up. So no word is
shuffled more than once per block, whatever its frequency, and no source or
language meets in one task.

All arithmetic is in whole numbers. A share is one plus a floor of 10^9 (count
+ 1) / (total + terms). A pair of sources is compared over all kept terms of the
language without listing those that a source lacks: the terms of one source
against the other's zero share come from a histogram of counts, terms of both
from a join on the term, and terms of neither all have one value.

Null text, language and source are empty strings. Repeated ids and rows are
documents of their own. A language without kept terms has pairs of value zero;
an empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendwatch.llm.pointersort import equal_runs, sorted_pointers
from spendwatch.llm.scratch import written
from spendwatch.llm.textblocks import LOWER, blocks, byte_class, joined, runs

#: Bytes of terms ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` after A-Z became a-z.
TERM = byte_class([(0x61, 0x7A), (0x80, 0xFF)])
#: Text bytes whose words are sorted at once.
SHARD_BYTES = 8 << 20
#: Documents of a language that a kept term is in, and ranks of the term report.
LEAST_DOCUMENTS, TOP = 3, 200
UNIT = 1_000_000_000


def _counted(texts: list[bytes], group: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Terms of some texts with their group, occurrences and documents, one row for each term and group."""
    data, text_starts = joined([t.translate(LOWER) for t in texts])
    starts, ends = runs(TERM[data]) if len(data) else (np.zeros(0, np.int64),) * 2
    order = sorted_pointers(data, starts, ends)
    run = equal_runs(data, starts, ends, order)
    document = (np.searchsorted(text_starts, starts, side="right") - 1)[order]
    pair, occurrences = np.unique(run * max(len(texts), 1) + document, return_counts=True)
    run_of, document_of = np.divmod(pair, max(len(texts), 1))
    groups = int(group.max()) + 1 if len(group) else 1
    key, place, documents = np.unique(run_of * groups + group[document_of], return_inverse=True, return_counts=True)
    total = np.bincount(place, weights=occurrences, minlength=len(key)).astype(np.int64)
    head = np.flatnonzero(np.diff(run, prepend=-1))
    words = [data[starts[p] : ends[p]].tobytes() for p in order[head]]
    return [words[r] for r in (key // groups).tolist()], key % groups, total, documents


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of every term in every source."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches, "_text", SHARD_BYTES):
            place: dict[tuple[str, str], int] = {}
            names = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
            group = np.array([place.setdefault(n, len(place)) for n in names], np.int64)
            words, which, total, documents = _counted(texts, group)
            lang, source = (pa.array([n[k] for n in place], pa.string()) for k in (0, 1))
            columns = [pc.take(lang, pa.array(which)), pc.take(source, pa.array(which)), pa.array(words, pa.binary()).cast(pa.string()), pa.array(total), pa.array(documents.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    only = docs.select(docs[text_col].alias("_text"), *_groups(docs, lang_col, source_col))
    shards = only.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return shards.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _groups(docs: DataFrame, lang_col: str, source_col: str) -> list:
    return [F.coalesce(docs[c].cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))]


def _share(count: str, total: str) -> F.Column:
    """One plus the floor of the smoothed share; wide numbers only where they are needed."""
    wide = f"(CAST({UNIT} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(20,0))) div CAST({total} AS DECIMAL(20,0))"
    return F.expr(f"1 + CASE WHEN {count} < {(1 << 62) // UNIT} THEN ({UNIT}L * ({count} + 1)) div ({total}) ELSE {wide} END")


def _gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: divergence of each source from each other one, and its most telling terms."""
    counts = written(term_counts(docs, text_col, lang_col, source_col))
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
    terms = written(terms.select("lang", "term", "n"))
    kept = written(counts.join(terms.select("lang", "term"), ["lang", "term"], "left_semi").select("lang", "term", "source", "n"))

    everywhere = docs.select(*_groups(docs, lang_col, source_col)).distinct()
    by_lang = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_n"))
    by_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("source_n"), F.count("*").alias("held"))
    groups = everywhere.join(by_lang, "lang", "left").join(by_source, ["lang", "source"], "left")
    groups = groups.fillna(0, ["terms", "lang_n", "source_n", "held"]).withColumn("total", F.expr("source_n + terms"))
    # without kept terms a share is never read, only must not fail
    groups = written(groups.withColumn("zero", F.when(F.col("terms") > 0, _share("0L", "greatest(total, 1L)")).otherwise(F.lit(1).cast("long"))))

    shares = kept.join(groups.select("lang", "source", "total", "zero"), ["lang", "source"])
    shares = written(shares.select("lang", "term", "source", _share("n", "total").alias("p"), "zero"))

    language = terms.join(by_lang, "lang").select("lang", "term", _share("n", "lang_n + terms").alias("q"))
    telling = shares.join(language, ["lang", "term"]).filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_gap("p", "q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    telling = telling.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)

    return _pairs(shares, groups).withColumn("rank", F.row_number().over(ranked)).unionByName(telling)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Each two sources of a language and the sum of their gaps over all kept terms."""
    mine = shares.select("lang", "term", "source", "p", "zero")
    other = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("zero").alias("zero_q"))
    both = mine.join(other, ["lang", "term"]).filter("source < item")
    # terms of both sources, less what the two histograms count for them
    there = f"{_gap('p', 'q')} - {_gap('p', 'zero_q')} - {_gap('zero', 'q')} + {_gap('zero', 'zero_q')}"
    back = f"{_gap('q', 'p')} - {_gap('q', 'zero')} - {_gap('zero_q', 'p')} + {_gap('zero_q', 'zero')}"
    joint = both.groupBy("lang", "source", "item").agg(F.sum(F.expr(there)).alias("there"), F.sum(F.expr(back)).alias("back"))
    joint = joint.select("lang", F.explode(F.array(F.struct("source", "item", F.col("there").alias("value")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))).alias("v")).select("lang", "v.*")

    # each different share of a source and how many terms have it
    steps = shares.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("times"))
    against = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_q"))
    alone = steps.join(against, "lang").filter("source <> item")
    first = alone.select("lang", "source", "item", F.expr(f"times * ({_gap('p', 'zero_q')})").alias("value"))
    second = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.expr(f"times * ({_gap('zero_q', 'p')})").alias("value"))

    two = groups.select("lang", "source", "zero", "held", "terms").join(groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_q"), F.col("held").alias("held_q")), "lang").filter("source <> item")
    neither = two.select("lang", "source", "item", F.expr(f"(terms - held - held_q) * ({_gap('zero', 'zero_q')})").alias("value"))
    parts = neither.unionByName(first).unionByName(second).unionByName(joint)
    summed = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value")


def divergence_sql(least: int = LEAST_DOCUMENTS, top: int = TOP) -> str:
    """The same rows, every kept term listed for every source."""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(body, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {least}),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(c) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT t.lang, t.source, t.term, CAST(count(*) AS HUGEINT) AS c FROM t JOIN k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL),
sn AS (SELECT lang, source, sum(c) AS n FROM s GROUP BY lang, source),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(s.c, 0) AS c,
    1 + ({UNIT}::HUGEINT * (coalesce(s.c, 0) + 1)) // (coalesce(sn.n, 0) + v.v) AS p,
    1 + ({UNIT}::HUGEINT * (k.c + 1)) // (v.n + v.v) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN v ON v.lang = g.lang
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
  LEFT JOIN sn ON sn.lang = g.lang AND sn.source = g.source),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM dense WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
WHERE part = 'pair' OR rank <= {top}
"""
