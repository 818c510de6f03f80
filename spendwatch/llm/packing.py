"""Packing token sequences by cutting-stock column generation.

One pass tokenizes every whole text and cuts it at multiples of the sequence
length; only piece lengths and checksums are kept, in a written table. The
lengths' histogram (a bounded number of classes) goes to the driver, where a
linear program picks patterns of classes. Pieces are ranked inside their class
and each rank belongs to one place of one pattern, so the assignment is a join
with a table of rank ranges whose size depends on the number of classes only.
Offsets are sums inside one sequence.

A class may hold most of the pieces: ranks are made inside salted parts of a
class and shifted by the parts' counts. Null and empty texts are the end token
alone. Repeated ids and rows are packed like any other row; a null id stays.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from spendwatch.llm.cuttingstock import class_sizes, whole_patterns
from spendwatch.llm.textblocks import LOWER, NON_SPACE, blocks, byte_class, joined, span_hashes
from spendwatch.session import cut_lineage

#: Remembered words per task; beyond, the memory starts afresh.
REMEMBERED = 500_000
#: Stands between words that are encoded together.
MARK = "\x01"
TOGETHER = 256
#: a-z and the lower-case letters from U+00DF to U+00FF, in UTF-8.
PLAIN = re.compile(rb"(?:[a-z]|\xC3[\x9F-\xB6\xB8-\xBF])+")
#: White space 0, ASCII letters 1, digits 2, other ASCII 3, the rest 4.
KINDS = np.full(256, 3, np.int8)
KINDS[0x80:] = 4
KINDS[byte_class([(0x30, 0x39)])] = 2
KINDS[byte_class([(0x41, 0x5A), (0x61, 0x7A)])] = 1
KINDS[~NON_SPACE] = 0
#: Pieces per part of a class when ranks are made.
PART_ROWS = 100_000


class WordIds:
    """Token ids of texts, every different word encoded once per task.

    The vocabulary's pre-tokenizer never reaches over white space, nor does its
    normalizer, so the ids of a text are those of its words. Words are cut
    further where an ASCII letter, digit and other character meet, which the
    pre-tokenizer does too, but for words with an apostrophe or ``<`` (endings
    such as ``'s``, special tokens). ASCII letters are lower-cased first, as the
    normalizer does, but for texts that may hold a special token.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(file)
        self.library.no_truncation()
        self.library.no_padding()
        self.mark = self.library.encode(MARK, add_special_tokens=False).ids
        # lower-case letters in composed form pass the normalizer unchanged: for them the vocabulary alone
        self.letters = Tokenizer.from_file(file)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ending = self.library.model.end_of_word_suffix
        self.ends = np.array([self.library.id_to_token(i).endswith(ending) for i in range(self.library.get_vocab_size())])
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.store = np.zeros(1 << 16, np.uint32)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Ids of the words one after another, how many each has, and in which order the words stand."""
        simple = [bool(PLAIN.fullmatch(w)) for w in words]
        easy = [k for k, s in enumerate(simple) if s]
        rest = [k for k, s in enumerate(simple) if not s and MARK.encode() not in words[k]]
        alone = [k for k, s in enumerate(simple) if not s and MARK.encode() in words[k]]
        ids = self._together(self.letters, words, easy, b" ")
        at = np.flatnonzero(self.ends[ids])
        sizes = [np.diff(at, prepend=-1)]
        more = self._together(self.library, words, rest, f" {MARK} ".encode(), closed=True)
        at = np.flatnonzero(more == self.mark[0])
        sizes.append(np.diff(at, prepend=-1) - 1)
        last = [self.library.encode(words[k].decode(), add_special_tokens=False).ids for k in alone]
        sizes.append(np.array([len(x) for x in last], np.int64))
        return np.concatenate([ids, np.delete(more, at), np.array(list(chain.from_iterable(last)), np.uint32)]), np.concatenate(sizes), easy + rest + alone

    @staticmethod
    def _together(library: Tokenizer, words: list[bytes], which: list[int], between: bytes, closed: bool = False) -> np.ndarray:
        tail = between if closed else b""
        texts = [(between.join([words[k] for k in which[i : i + TOGETHER]]) + tail).decode() for i in range(0, len(which), TOGETHER)]
        made = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(made), np.uint32, sum(map(len, made)))

    def ids(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by ``end``, and where each text begins (one more entry at the end)."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        data, text_starts = joined([t if b"<|" in t else t.translate(LOWER) for t in texts])
        starts, ends = fragments(data)
        different, one, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.forget()
        keys = different.tolist()
        found = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(found < 0)
        if len(new):
            raw = data.tobytes()
            ids, sizes, order = self.encoded([raw[a:b] for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist())])
            used = int(self.first[-1] + self.size[-1]) if len(self.first) else 0
            if used + len(ids) > len(self.store):
                self.store = np.concatenate([self.store, np.zeros(max(len(self.store), len(ids)), np.uint32)])
            self.store[used : used + len(ids)] = ids
            place = len(self.size) + np.arange(len(order))
            self.first = np.append(self.first, used + np.cumsum(sizes) - sizes)
            self.size = np.append(self.size, sizes)
            found[new[order]] = place
            self.known.update(zip(different[new[order]].tolist(), place.tolist()))
        edges = np.append(np.searchsorted(starts, text_starts[1:]), len(starts))
        stops = edges + np.arange(len(texts))
        index = np.insert(found[which], edges, -1)
        closing = index < 0
        count = np.where(closing, 1, self.size[index]) if len(self.size) else np.ones(len(index), np.int64)
        after = np.cumsum(count)
        first = self.first[index] if len(self.first) else np.zeros(len(index), np.int64)
        first[closing] = 0
        out = self.store[np.repeat(first - (after - count), count) + np.arange(after[-1])]
        out[after[closing] - 1] = end
        return out, np.concatenate(([0], after[stops]))


def fragments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of words that the vocabulary treats alone."""
    kind = KINDS[data]
    space = kind == 0
    cut = kind[1:] != kind[:-1]
    whole = np.flatnonzero((data == 0x27) | (data == 0x3C))
    ascii_only = (kind < 4) if len(data) else space
    inner = ascii_only[1:] & ascii_only[:-1] & ~space[1:] & ~space[:-1]
    if len(whole):
        word = np.cumsum(space)
        kept = np.zeros(int(word[-1]) + 1, bool)
        kept[word[whole]] = True
        inner &= ~kept[word[1:]]
    border = np.flatnonzero(cut & (inner | (space[1:] != space[:-1]))) + 1
    edges = np.concatenate(([0], border, [len(data)]))
    begins = np.flatnonzero(~space[edges[:-1]])
    return edges[begins], edges[begins + 1]


def token_pieces(docs: DataFrame, file: str, capacity: int, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``, one row per piece of at most ``capacity`` ids."""
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordIds(file)
        for part, texts in blocks(batches, "_text"):
            ids, edges = encoder.ids(texts, end)
            raw = memoryview(ids.astype("<u4").tobytes())
            tokens = np.diff(edges)
            pieces = -(-tokens // capacity)
            doc = np.repeat(np.arange(len(texts)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
            length = np.minimum(capacity, tokens[doc] - start)
            at = edges[doc] + start
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("_id").take(pa.array(doc)), *map(pa.array, (start, length, np.array(crc, np.int64), tokens[doc]))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    only = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    return only.mapInArrow(cut, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def assign(pieces: DataFrame, capacity: int) -> DataFrame:
    """The pieces (any columns, with ``length``) plus ``sequence_id`` and a gapless ``offset``.

    ``pieces`` is read several times and should be a written table.
    """
    spark = pieces.sparkSession
    sizes = class_sizes(capacity)
    # the smallest class that holds the length: lengths up to the capacity, so a table of that many rows
    of_length = np.searchsorted(sizes, np.arange(capacity + 1))
    class_of = F.broadcast(spark.createDataFrame([(n, int(k)) for n, k in enumerate(of_length)], "length bigint, _class int"))
    rows = pieces.count()
    salts = max(1, -(-rows // PART_ROWS))
    dealt = pieces.join(class_of, "length").withColumn("_part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    counts = dealt.groupBy("_class", "_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn(
        "_before", F.sum("_n").over(Window.partitionBy("_class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    ).select(F.col("_class").alias("_c"), F.col("_part").alias("_p"), F.coalesce("_before", F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_class", "_part").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = dealt.withColumn("_local", local)
    ranked = ranked.join(before, (F.col("_class") == F.col("_c")) & (F.col("_part") == F.col("_p"))).withColumn("_rank", F.col("_local") + F.col("_before"))

    demand = np.zeros(len(sizes), np.int64)
    for row in counts.groupBy("_class").agg(F.sum("_n").alias("n")).collect():  # one row per class at most
        demand[row["_class"]] = row["n"]
    ranges, used, sequences = [], np.zeros(len(sizes), np.int64), 0
    for pattern, times in whole_patterns(sizes, demand, capacity):
        place = 0
        for k in np.flatnonzero(pattern)[::-1].tolist():
            copies = int(pattern[k])
            ranges.append((k, int(used[k]), int(used[k] + copies * times), copies, sequences, place))
            used[k] += copies * times
            place += copies
        sequences += times
    # ranges of one class in an array; a rank finds its own by position
    plan = spark.createDataFrame(ranges, "k int, low bigint, high bigint, copies bigint, first_sequence bigint, place bigint")
    by_class = F.broadcast(plan.groupBy(F.col("k").alias("_k")).agg(F.sort_array(F.collect_list(F.struct("low", "high", "copies", "first_sequence", "place"))).alias("_ranges")))
    mine = F.element_at(F.filter("_ranges", lambda r: (r["low"] <= F.col("_rank")) & (F.col("_rank") < r["high"])), 1)
    placed = ranked.join(by_class, F.col("_class") == F.col("_k")).withColumn("_range", mine)
    inside = F.col("_rank") - F.col("_range.low")
    placed = placed.withColumn("sequence_id", F.col("_range.first_sequence") + F.floor(inside / F.col("_range.copies"))).withColumn(
        "_place", F.col("_range.place") + inside % F.col("_range.copies")
    )
    earlier = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*pieces.columns, "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))


def pack(docs: DataFrame, file: str, capacity: int, end: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    return assign(cut_lineage(token_pieces(docs, file, capacity, end, id_col, text_col)), capacity)
