"""Repeated passages, by fixed-block anchors.

Every text is cut into non-overlapping blocks of ``BLOCK`` words, the anchors.
A repeat of ``2 * BLOCK - 1`` words or more holds a whole anchor of the earlier
text wherever it begins, so probing the anchors with every rolling window of
``BLOCK`` words misses none. A hit is then extended to the windows of the full
repeat length around it, which are compared; runs of equal windows are the
maximal exact repeats.

Both comparisons run bucketed by hash. Windows travel packed, many in one row,
and each task first settles what repeats inside its own text block: a passage
in a third of all documents reaches a bucket once per text block, not once per
document. The number of buckets follows the measured size of the corpus. Tasks
take texts in Arrow batches of ``BATCH_ROWS`` rows, so what they hold does not
grow with a partition.

Order of documents is the order of integer ids. A null id neither takes part
as an earlier document nor loses words; rows with one id are no repeats of each
other. Null and empty texts have no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.scratch import written
from spendwatch.llm.textblocks import Words, blocks, mix

#: Words in a repeat, and in an anchor: ``REPEAT >= 2 * BLOCK - 1``.
REPEAT = 13
BLOCK = 7
#: Text bytes whose windows meet in one bucket.
BUCKET_BYTES = 8 << 20
#: Buckets per shard of documents that results return to.
SHARD_BUCKETS = 4
#: Text bytes in which a task settles repeats by itself.
TASK_BYTES = 4 << 20
ANCHOR = np.uint32(1 << 31)
LOW31 = np.uint32((1 << 31) - 1)
#: Rows with whole texts, or lists of windows, in one Arrow batch.
BATCH_ROWS = 2_000
#: A second hash, independent of the first, deals full windows to buckets.
SECOND_BASE = 0xC2B2AE3D27D4EB4F


def _packed(bucket: np.ndarray, owner: np.ndarray, values: np.ndarray, owners: np.ndarray) -> list[tuple[int, bytes]]:
    """One payload per bucket: number of owners, owners, how many values each has, values.

    ``owner`` indexes rows of ``owners`` (one or more int64 columns).
    """
    if not len(bucket):
        return []
    order = np.argsort(bucket * len(owners) + owner, kind="stable")
    bucket, owner, values = bucket[order], owner[order], values[order]
    edge = np.flatnonzero(np.diff(bucket * len(owners) + owner, prepend=-1))
    count = np.diff(np.append(edge, len(bucket)))
    cut = np.flatnonzero(np.diff(bucket[edge], prepend=-1))
    out = []
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(edge)]):
        low, high = edge[a], edge[b] if b < len(edge) else len(bucket)
        head = np.array([b - a], "<i4").tobytes() + owners[owner[edge[a:b]]].tobytes() + count[a:b].astype("<i4").tobytes()
        out.append((int(bucket[low]), head + values[low:high].tobytes()))
    return out


def _dealt(owner: np.ndarray, values: np.ndarray, shards: int) -> pa.Table:
    """``shard, payload``: the values packed by a hash of their owner's id, one row per shard."""
    shard = (mix(owner[:, 0].astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((*owner.T[::-1], shard))
    shard, owner, values = shard[order], owner[order], values[order]
    first = np.ones(len(owner), bool)
    first[1:] = np.any(owner[1:] != owner[:-1], axis=1)
    rows = _packed(shard, np.cumsum(first) - 1, values, owner[first].astype("<i8"))
    return pa.table({"shard": pa.array([k for k, _ in rows], pa.int64()), "payload": pa.array([p for _, p in rows], pa.binary())})


def _gathered(dealt: DataFrame, names: list[str], values: str, kind: str) -> DataFrame:
    """One row per owner with all its values, from rows of ``_dealt``. A shard holds about ``SHARD_BUCKETS`` buckets' worth of documents."""
    width = len(names)

    def gather(table: pa.Table) -> pa.Table:
        owner, value = _unpacked(table.column("payload").to_pylist(), width, kind)
        order = np.lexsort(owner.T[::-1])
        owner, value = owner[order], value[order]
        edge, lists = _lists(owner, value.view("i" + kind[2:]))
        return pa.table({**{n: pa.array(owner[edge, k]) for k, n in enumerate(names)}, values: lists})

    schema = ", ".join(f"{n} bigint" for n in names) + f", {values} array<{'int' if kind == '<u4' else 'bigint'}>"
    return dealt.groupBy("shard").applyInArrow(gather, schema)


def _unpacked(payloads: Iterable[bytes], width: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Owners and values of all payloads, one owner row per value."""
    owners, values = [], []
    for raw in payloads:
        n = int(np.frombuffer(raw, "<i4", 1)[0])
        own = np.frombuffer(raw, "<i8", n * width, 4).reshape(n, width)
        count = np.frombuffer(raw, "<i4", n, 4 + 8 * n * width)
        owners.append(np.repeat(own, count, axis=0))
        values.append(np.frombuffer(raw, kind, -1, 4 + 8 * n * width + 4 * n))
    if not owners:
        return np.zeros((0, width), np.int64), np.zeros(0, kind)
    return np.concatenate(owners), np.concatenate(values)


def _lists(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """First index of each run of equal owners, and the runs' values as lists."""
    edge = np.flatnonzero(np.any(np.diff(owner, axis=0) != 0, axis=1)) + 1 if len(owner) else np.zeros(0, np.int64)
    edge = np.concatenate(([0], edge)) if len(owner) else edge
    return edge, pa.ListArray.from_arrays(pa.array(np.append(edge, len(values)).astype(np.int32)), pa.array(values))


def _groups(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each run of equal keys, and the run number of each row."""
    first = np.ones(len(sorted_keys), bool)
    first[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(first), np.cumsum(first) - 1


def anchor_hits(docs: DataFrame, buckets: int, repeat: int = REPEAT, block: int = BLOCK) -> DataFrame:
    """``id, hits``: per document the hashes of windows that may be shared anchors. Reads ``_id, _text``."""

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches, "_text", TASK_BYTES):
            words = Words(texts)
            null = np.array(part.column("_id").is_null().to_pylist(), bool)
            ids = part.column("_id").fill_null(0).to_numpy()
            window, first = words.windows(block)
            doc = words.docs[first]
            use = (words.counts[doc] >= repeat) & ~null[doc]
            window, first, doc = window[use], first[use], doc[use]
            anchor = (first - words.edges[doc]) % block == 0
            order = np.argsort(window, kind="stable")
            window, doc, anchor = window[order], doc[order], anchor[order]
            start, group = _groups(window)
            short = ((window >> np.uint64(32)).astype(np.uint32)) & LOW31
            # the smallest id of each group speaks for it; groups of several ids are hits already
            own = ids[doc]
            low = np.minimum.reduceat(own, start) if len(start) else own
            high = np.maximum.reduceat(own, start) if len(start) else own
            marked = np.logical_or.reduceat(anchor, start) if len(start) else anchor
            several = (low != high)[group]
            known, row = np.unique(low, return_inverse=True)
            value = short[start] | np.where(marked, ANCHOR, np.uint32(0))
            rows = _packed((window[start] % np.uint64(buckets)).astype(np.int64), row, value.astype("<u4"), known.astype("<i8")[:, None])
            local = np.flatnonzero(several)
            settled = _dealt(own[local][:, None], short[local].astype("<u4"), buckets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*(b for b, _ in rows), *settled.column("shard").to_pylist()], pa.int64()),
                    pa.array([p for _, p in rows] + [None] * settled.num_rows, pa.binary()),
                    pa.array([None] * len(rows) + settled.column("payload").to_pylist(), pa.binary()),
                ],
                names=["bucket", "payload", "settled"],
            )

    def meet(table: pa.Table) -> pa.Table:
        known_owner, known_value = _unpacked(table.column("settled").drop_null().to_pylist(), 1, "<u4")
        owner, value = _unpacked(table.column("payload").drop_null().to_pylist(), 1, "<u4")
        order = np.argsort(value & LOW31, kind="stable")
        owner, value = owner[order], value[order]
        start, group = _groups(value & LOW31)
        hit = np.zeros(0, np.int64)
        if len(start):
            shared = np.minimum.reduceat(owner[:, 0], start) != np.maximum.reduceat(owner[:, 0], start)
            marked = np.bitwise_or.reduceat(value, start) >= ANCHOR
            hit = np.flatnonzero((shared & marked)[group])
        return _dealt(np.concatenate([known_owner, owner[hit]]), np.concatenate([known_value, value[hit] & LOW31]), shards)

    shards = max(1, buckets // SHARD_BUCKETS)
    probes = docs.mapInArrow(probe, "bucket bigint, payload binary, settled binary")
    met = probes.groupBy("bucket").applyInArrow(meet, "shard bigint, payload binary")
    return _gathered(met, ["id"], "hits", "<u4")


def _member(owner: np.ndarray, value: np.ndarray, lists: list[list[int] | None]) -> np.ndarray:
    """Whether each value is in the list of its owner (an index into ``lists``)."""
    out = np.zeros(len(value), bool)
    edges = np.searchsorted(owner, np.arange(len(lists) + 1))
    for k, known in enumerate(lists):
        if known is not None and len(known) and edges[k] < edges[k + 1]:
            out[edges[k] : edges[k + 1]] = np.isin(value[edges[k] : edges[k + 1]], known)
    return out


def _kept(words: Words, covered: np.ndarray, k: int) -> tuple[int, str]:
    """How many words of text ``k`` are covered, and the digest of the others."""
    a, b = words.edges[k], words.edges[k + 1]
    left = np.flatnonzero(~covered[a:b]) + a
    raw = words.data
    if len(left) == b - a:
        text = b" ".join(words.texts[k].split())
    else:
        whole = raw.tobytes() if len(words.texts) == 1 else raw[words.starts[a] : words.ends[b - 1]].tobytes()
        shift = 0 if len(words.texts) == 1 else int(words.starts[a])
        text = b" ".join([whole[i - shift : j - shift] for i, j in zip(words.starts[left].tolist(), words.ends[left].tolist())])
    return int(b - a - len(left)), hashlib.sha256(text).hexdigest()


def _lists_of(column: pa.Array) -> list[np.ndarray | None]:
    return [None if x is None or not x.is_valid else x.values.to_numpy(zero_copy_only=False) for x in column]


STAGE = "kind int, id bigint, digest bigint, n_words bigint, n_removed bigint, kept_sha256 string, text string, near array<int>, bucket int, payload binary"


def extended(docs: DataFrame, buckets: int, repeat: int = REPEAT, block: int = BLOCK) -> DataFrame:
    """Documents and, for those with anchor hits, the full windows around them. Reads ``_id, _digest, _text, hits``.

    Kind 0 are documents: settled ones carry their result, open ones their text
    and the places already known to repeat an earlier document of the same text
    block (``near``). Kind 1 are packed full windows that go to buckets.
    """

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches, "_text", TASK_BYTES):
            words = Words(texts)
            n = len(texts)
            null = np.array(part.column("_id").is_null().to_pylist(), bool)
            ids = part.column("_id").fill_null(0).to_numpy()
            digests = part.column("_digest").fill_null(0).to_numpy()
            window, first = words.windows(block)
            short = ((window >> np.uint64(32)).astype(np.uint32) & LOW31).astype(np.int32)
            hit = first[_member(words.docs[first], short, _lists_of(part.column("hits")))]
            # every full window that holds a hit: it begins at the hit or up to repeat - block words earlier
            edge = np.zeros(len(words.hashes) + 1, np.int64)
            np.add.at(edge, np.maximum(hit - (repeat - block), words.edges[words.docs[hit]]), 1)
            np.add.at(edge, hit + 1, -1)
            full, start = words.windows(repeat)
            second, _ = words.windows(repeat, SECOND_BASE)
            use = np.cumsum(edge)[start] > 0
            full, second, start = full[use], second[use], start[use]
            doc = words.docs[start]
            use = ~null[doc]
            full, second, start, doc = full[use], second[use], start[use], doc[use]
            order = np.argsort(full, kind="stable")
            full, second, start, doc = full[order], second[order], start[order], doc[order]
            own = ids[doc]
            run, group = _groups(full)
            low = np.minimum.reduceat(own, run) if len(run) else own
            later = own > low[group] if len(run) else np.zeros(0, bool)
            owners = np.stack([ids, digests], 1).astype("<i8")
            rest = np.flatnonzero(~later)
            packed = _packed((second[rest] % np.uint64(buckets)).astype(np.int64), doc[rest], full[rest].astype("<u8"), owners)
            open_docs = set(np.unique(doc).tolist())
            known = np.flatnonzero(later)
            known = known[np.argsort(doc[known], kind="stable")]
            places = np.searchsorted(doc[known], np.arange(n + 1))
            near = start[known] - words.edges[doc[known]]
            none = np.zeros(len(words.hashes), bool)
            rows = []
            for k in range(n):
                if k in open_docs:
                    rows.append((0, None, None, texts[k].decode(), near[places[k] : places[k + 1]].tolist()))
                else:
                    rows.append((0, *_kept(words, none, k), None, None))
            kind, removed, sha, text, near_lists = zip(*rows) if rows else [()] * 5
            m = len(packed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*kind, *[1] * m], pa.int32()),
                    pa.array([*part.column("_id").to_pylist(), *[None] * m], pa.int64()),
                    pa.array([*digests.tolist(), *[None] * m], pa.int64()),
                    pa.array([*words.counts.tolist(), *[None] * m], pa.int64()),
                    pa.array([*removed, *[None] * m], pa.int64()),
                    pa.array([*sha, *[None] * m], pa.string()),
                    pa.array([*text, *[None] * m], pa.string()),
                    pa.array([*near_lists, *[None] * m], pa.list_(pa.int32())),
                    pa.array([*[None] * n, *[b for b, _ in packed]], pa.int32()),
                    pa.array([*[None] * n, *[p for _, p in packed]], pa.binary()),
                ],
                names=[f.split()[0] for f in STAGE.split(", ")],
            )

    return docs.mapInArrow(extend, STAGE)


def later_windows(stage: DataFrame, buckets: int) -> DataFrame:
    """``id, digest, later``: hashes of the full windows that a smaller id also has."""
    shards = max(1, buckets // SHARD_BUCKETS)

    def compare(table: pa.Table) -> pa.Table:
        owner, value = _unpacked(table.column("payload").to_pylist(), 2, "<u8")
        order = np.argsort(value, kind="stable")
        owner, value = owner[order], value[order]
        start, group = _groups(value)
        hit = np.flatnonzero(owner[:, 0] > np.minimum.reduceat(owner[:, 0], start)[group]) if len(start) else np.zeros(0, np.int64)
        return _dealt(owner[hit], value[hit], shards)

    found = stage.filter("kind = 1").select("bucket", "payload").groupBy("bucket").applyInArrow(compare, "shard bigint, payload binary")
    return _gathered(found, ["id", "digest"], "later", "<u8")


def removed_words(docs: DataFrame, repeat: int = REPEAT, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``.

    A word goes if a window of ``repeat`` words over it also begins in a
    document with a smaller id; windows are judged on the input.
    """
    if repeat < 2 * block - 1:
        raise ValueError("an anchor must fit into every repeat")
    only = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    size = only.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(8, -(-size // BUCKET_BYTES))
    hits = written(anchor_hits(only, buckets, repeat, block), BATCH_ROWS).withColumnRenamed("id", "_hit")
    met = only.join(hits, F.col("_id") == F.col("_hit"), "left").select("_id", F.xxhash64("_text").alias("_digest"), "_text", "hits")
    stage = written(extended(met, buckets, repeat, block), BATCH_ROWS)
    later = written(later_windows(stage, buckets), BATCH_ROWS).withColumnRenamed("id", "_i").withColumnRenamed("digest", "_d")
    open_docs = stage.filter("kind = 0 AND text IS NOT NULL").select("id", "digest", "text", "near")
    open_docs = open_docs.join(later, (F.col("id") == F.col("_i")) & (F.col("digest") == F.col("_d")), "left").select("id", F.col("text").alias("_text"), "near", "later")

    def cover(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches, "_text"):
            words = Words(texts)
            full, start = words.windows(repeat)
            gone = start[_member(words.docs[start], full.astype(np.int64), _lists_of(part.column("later")))]
            near = [words.edges[k] + x for k, x in enumerate(_lists_of(part.column("near"))) if x is not None]
            gone = np.concatenate([gone, *near]).astype(np.int64)
            edge = np.zeros(len(words.hashes) + 1, np.int64)
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + repeat, -1)
            covered = np.cumsum(edge[:-1]) > 0
            done = [_kept(words, covered, k) for k in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(words.counts), pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    result = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    settled = stage.filter("kind = 0 AND text IS NULL").select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
    # written here, so that the bound on batches holds wherever the result is read
    return settled.unionByName(written(open_docs.mapInArrow(cover, result), BATCH_ROWS))
