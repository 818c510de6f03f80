"""Quality classifier: a factorisation machine on hashed words and text structure.

A text becomes a sparse unit vector of hashed words and a few standardised
structure figures, all taken from the text itself. The score adds a linear part
and all pairwise products of features, weighted by products of low-rank factors;
with the identity  sum_{i<j} <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i|^2 x_i^2) / 2
it costs one pass over the features.

Training takes at most ``TRAIN_ROWS`` labelled rows, the first by a hash of
their id, and runs in numpy on the driver from their features. Scoring is a
narrow pass over the whole texts.

Null and empty texts have no words and are scored on their structure. Repeated
ids and rows are scored row by row; a labelled id that repeats is used once per
row. Labels other than 0 and 1 are ignored. Without labels of both kinds the
score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.textblocks import Words, blocks, byte_class

#: Labelled rows used for training at most.
TRAIN_ROWS = 6_000
BUCKETS = 1 << 14
RANK = 8
#: Steps of training: whole epochs, ``EPOCHS`` at least.
STEPS = 250
EPOCHS = 30
BATCH = 256
RATE = 0.05
DECAY = 1e-4
SEED = 17
#: Scores from here on are label 1.
ACCEPT = 0.3
#: One fold in ``FOLDS`` is held out.
FOLDS = 5

BYTE_CLASSES = [
    byte_class([(0x41, 0x5A)]), byte_class([(0x61, 0x7A)]), byte_class([(0x30, 0x39)]), byte_class([(0x80, 0xBF)]),
    byte_class([(b, b) for b in b".,;:?"]), byte_class([(b, b) for b in b"!"]), byte_class([(b, b) for b in b"|"]), byte_class([(b, b) for b in b"#*$%&<>@+=~^_/\\{}[]"]),
    byte_class([(0x0A, 0x0A)]), byte_class([(0x00, 0x08), (0x0E, 0x1F), (0x7F, 0x7F)]),
]
STATS = 2 * len(BYTE_CLASSES) + 8


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row edges, buckets and values of the hashed words, and the structure figures of each text."""
    n, words = len(texts), Words(texts)
    code = words.docs.astype(np.int64) * BUCKETS + (words.hashes % np.uint64(BUCKETS)).astype(np.int64)
    cell, count = np.unique(code, return_counts=True)
    doc, bucket = cell // BUCKETS, cell % BUCKETS
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(doc, value * value, n))
    value = value / np.maximum(norm, 1e-9)[doc]
    size = np.array([max(len(t), 1) for t in texts], float)
    stats = np.zeros((n, STATS))
    last = np.append(words.text_starts[1:], len(words.data))
    for k, table in enumerate(BYTE_CLASSES):
        total = np.concatenate(([0], np.cumsum(table[words.data])))
        share = (total[last] - total[words.text_starts]) / size
        stats[:, 2 * k], stats[:, 2 * k + 1] = share, np.sqrt(share)
    window, first = words.windows(3)
    owner = words.docs[first]
    kinds = np.unique(window + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)[1]
    windows = np.bincount(owner, minlength=n)
    base = 2 * len(BYTE_CLASSES)
    stats[:, base] = np.log1p(words.counts)
    stats[:, base + 1] = np.log1p(size)
    stats[:, base + 2] = size / np.maximum(words.counts, 1) / 10
    stats[:, base + 3] = np.bincount(doc, minlength=n) / np.maximum(words.counts, 1)
    stats[:, base + 4] = 1 - np.bincount(owner[kinds], minlength=n) / np.maximum(windows, 1)
    stats[:, base + 5] = [_repeated_lines(t) for t in texts]
    stats[:, base + 6] = words.counts < 20
    stats[:, base + 7] = words.counts > 2_000
    return np.searchsorted(doc, np.arange(n + 1)), bucket, value, stats


def _repeated_lines(text: bytes) -> float:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return 1 - len(set(lines)) / len(lines) if lines else 0.0


@dataclass
class Machine:
    """Weights of buckets, then of structure figures."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def rows(self, edges: np.ndarray, bucket: np.ndarray, value: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One sparse row per text: row number, feature and value of every entry."""
        n = len(stats)
        scaled = np.clip((stats - self.mean) / self.scale, -4, 4) / 4
        row = np.concatenate([np.repeat(np.arange(n, dtype=np.int32), np.diff(edges)), np.repeat(np.arange(n, dtype=np.int32), STATS)])
        feature = np.concatenate([bucket.astype(np.int32), np.tile(BUCKETS + np.arange(STATS, dtype=np.int32), n)])
        return row, feature, np.concatenate([value.astype(np.float32), scaled.ravel().astype(np.float32)])

    def margins(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Score before the logistic function, and the sums of factors of each row."""
        weighted = self.factors[feature] * value[:, None]
        sums = np.stack([np.bincount(row, weighted[:, f], n) for f in range(weighted.shape[1])], 1)
        squares = np.bincount(row, (weighted * weighted).sum(axis=1), n)
        return self.bias + np.bincount(row, self.linear[feature] * value, n) + ((sums * sums).sum(axis=1) - squares) / 2, sums

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        made = features(texts)
        return 1 / (1 + np.exp(-np.clip(self.margins(*self.rows(*made), len(texts))[0], -30, 30)))


def fit(edges: np.ndarray, bucket: np.ndarray, value: np.ndarray, stats: np.ndarray, label: np.ndarray) -> Machine:
    """Logistic loss by AdaGrad on shuffled small batches; deterministic."""
    rng, size = np.random.default_rng(SEED), BUCKETS + STATS
    mean, scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    share = float(np.clip(label.mean(), 1e-3, 1 - 1e-3))
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.02, (size, RANK)), mean, scale)
    row, feature, x = machine.rows(edges, bucket, value, stats)
    order = np.argsort(row, kind="stable").astype(np.int32)
    row, feature, x = row[order], feature[order], x[order]
    first = np.searchsorted(row, np.arange(len(label) + 1))
    del order, row
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    batches = max(1, len(label) // BATCH)
    for _ in range(max(EPOCHS, -(-STEPS // batches))):
        for part in np.array_split(rng.permutation(len(label)), batches):
            take = np.concatenate([np.arange(first[k], first[k + 1]) for k in part])
            r = np.repeat(np.arange(len(part)), first[part + 1] - first[part])
            f, v = feature[take], x[take]
            margin, sums = machine.margins(r, f, v, len(part))
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[part]) / len(part) * 16
            used, where = np.unique(f, return_inverse=True)
            pull = error[r] * v
            gw = np.bincount(where, pull, len(used)) + DECAY * machine.linear[used]
            gv = np.stack([np.bincount(where, pull * (sums[r, k] - machine.factors[f, k] * v), len(used)) for k in range(RANK)], 1) + DECAY * machine.factors[used]
            seen_w[used] += gw * gw
            seen_v[used] += gv * gv
            machine.linear[used] -= RATE * 5 * gw / np.sqrt(seen_w[used])
            machine.factors[used] -= RATE * gv / np.sqrt(seen_v[used])
            seen_b += error.sum() ** 2
            machine.bias -= RATE * error.sum() / np.sqrt(seen_b)
    return machine


def held_out(id_col: str = "doc_id"):
    """Whether a row belongs to the fold that training never sees."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """Machine from at most ``rows`` labelled documents outside the held-out fold."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    labelled = texts.join(F.broadcast(chosen), F.col("_id") == F.col("doc_id")).select("_id", "_text", "quality")  # ``rows`` at most

    def prepare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in blocks(batches, "_text"):
            edges, bucket, value, stats = features(raw)
            listed = lambda x, kind: pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(x, kind))
            yield pa.RecordBatch.from_arrays(
                [part.column("_id").cast(pa.string()), part.column("quality").cast(pa.int32()), listed(bucket, pa.int32()), listed(value.astype(np.float32), pa.float32()), pa.array(list(stats), pa.list_(pa.float64()))],
                names=["id", "quality", "bucket", "value", "stats"],
            )

    made = labelled.mapInArrow(prepare, "id string, quality int, bucket array<int>, value array<float>, stats array<double>")
    held = made.limit(2 * rows).toArrow().sort_by("id").combine_chunks()  # repeated ids add rows of their own
    label = held["quality"].to_numpy().astype(float)
    if len(set(label)) < 2:
        share = float(np.clip(label.mean(), 0.01, 0.99)) if len(label) else 0.5
        return Machine(float(np.log(share / (1 - share))), np.zeros(BUCKETS + STATS), np.zeros((BUCKETS + STATS, 1)), np.zeros(STATS), np.ones(STATS))
    bucket, value, stats = (held[name].combine_chunks() for name in ("bucket", "value", "stats"))
    edges = np.concatenate(([0], np.cumsum(np.diff(bucket.offsets.to_numpy()))))
    return fit(edges, bucket.flatten().to_numpy(), value.flatten().to_numpy(), stats.flatten().to_numpy().reshape(len(label), STATS), label)


def scored(docs: DataFrame, machine: Machine, keep: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: ``row``, a struct of its ``keep`` columns (default: all), and ``score``."""
    held = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.linear, machine.factors, machine.mean, machine.scale))  # of fixed size
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col("text").alias("_text"))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Machine(*held.value)
        for part, texts in blocks(batches, "_text"):
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(here.score(texts))], names=["row", "score"])

    return rows.mapInArrow(score, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def accepted(docs: DataFrame, labels: DataFrame, at_least: float = ACCEPT) -> DataFrame:
    """The documents whose score is high enough, with the columns of ``docs``."""
    return scored(docs, train(docs, labels)).filter(F.col("score") >= at_least).select("row.*")
