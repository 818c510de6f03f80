"""Benchmark passages in documents, by one Aho-Corasick automaton.

Benchmark items become windows of ten consecutive normalised words. One
automaton holds all windows; each document is normalised the same way and
scanned once. A match's place among the normalised words gives its words, and
those words' byte places in the original text give code-point spans.

The automaton is built from a broadcast of the benchmark, whose size is
measured first: a benchmark above ``AUTOMATON_BYTES`` of text is split by a
hash of its items into parts of about that size, which scan one after another
in the same narrow pass. Documents are never shuffled.

Null and empty texts have no words and no hits; a null item text has none
either. Items without an id still mark words but are not named. Repeated ids,
rows and items are harmless: every row is scanned, an item id counts once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.textblocks import LETTER_DIGIT, LOWER, blocks, runs

#: Words in a window.
WINDOW = 10
#: Benchmark text per automaton.
AUTOMATON_BYTES = 1 << 18
#: Lower case for letters, a space for what is no word.
FOLD = bytes(LOWER[b] if LETTER_DIGIT[LOWER[b]] else 0x20 for b in range(256))

SCHEMA = (
    "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "items array<string>, spans array<struct<start:bigint,stop:bigint>>"
)


class Scanner:
    """Automaton over the windows of some items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        found: dict[bytes, tuple[int, set[str]]] = {}
        for item, text in items:
            words = (text or "").encode().translate(FOLD).split()
            for k in range(max(1, len(words) - window + 1) if words else 0):
                part = words[k : k + window]
                key = b" " + b" ".join(part) + b" "
                found.setdefault(key, (len(part), set()))[1].update([item] if item is not None else [])
        self.automaton = ahocorasick.Automaton()
        for key, (count, names) in found.items():
            # one character per byte: matching bytes of UTF-8 is matching characters
            self.automaton.add_word(key.decode("latin-1"), (len(key), count, names))
        self.empty = not found
        if found:
            self.automaton.make_automaton()

    def matches(self, normal: bytes) -> tuple[list[tuple[int, int]], set[str]]:
        """Places of matches, as byte position of the space before and word count, and the items found."""
        places, names = [], set()
        if not self.empty:
            for end, (size, count, items) in self.automaton.iter(normal.decode("latin-1")):
                places.append((end - size + 1, count))
                names |= items
        return places, names


def _hit_words(normal: bytes, places: list[tuple[int, int]], n_words: int) -> np.ndarray:
    spaces = np.flatnonzero(np.frombuffer(normal, np.uint8) == 0x20)
    at, count = np.array(places, np.int64).reshape(-1, 2).T
    first = np.searchsorted(spaces, at)
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + count, -1)
    return np.cumsum(edge[:-1]) > 0


def _original_spans(raw: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Code-point spans of the runs of hit words in the original text."""
    folded = np.frombuffer(raw.translate(FOLD) + b" ", np.uint8)
    starts, ends = runs(folded != 0x20)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    first, last = runs(np.append(hit, False))
    return [{"start": int(points[starts[a]]), "stop": int(points[ends[b - 1]])} for a, b in zip(first, last)]


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: ``row``, a struct of its ``keep`` columns (default: all), and counts, items and spans of benchmark passages."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = -(-total // AUTOMATON_BYTES) or 1
    numbered = items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))

    kept = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns])
    carried = docs.select(kept.alias("row"), F.col(text_col).alias("text"), F.array().cast("array<bigint>").alias("places"), F.array().cast("array<string>").alias("items"))
    row_type = carried.schema["row"].dataType.simpleString()
    for part in range(parts):
        held = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in numbered.filter(F.col("part") == part).select("item", "text").collect()])
        last = part == parts - 1

        def look(batches: Iterable[pa.RecordBatch], held=held, last=last) -> Iterator[pa.RecordBatch]:
            scanner = Scanner(held.value, window)
            for batch, texts in blocks(batches, "text"):
                before_places, before_items = batch.column("places").to_pylist(), batch.column("items").to_pylist()
                places, items, results = [], [], []
                for raw, old, seen in zip(texts, before_places, before_items):
                    words = raw.translate(FOLD).split()
                    normal = b" " + b" ".join(words) + b" "
                    met, named = scanner.matches(normal) if words else ([], set())
                    met = [*zip(old[::2], old[1::2]), *met]
                    named = sorted(named.union(seen))
                    if not last:
                        places.append([n for pair in met for n in pair])
                        items.append(named)
                        continue
                    hit = _hit_words(normal, met, len(words)) if met else np.zeros(0, bool)
                    results.append(
                        (len(words), int(hit.sum()), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(met), named, _original_spans(raw, hit) if met else [])
                    )
                if last:
                    columns = list(zip(*results)) if results else [()] * 7
                    yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(c, t) for c, t in zip(columns, _TYPES))], names=["row", *_NAMES])
                else:
                    yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), pa.array(places, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], names=["row", "text", "places", "items"])

        carried = carried.mapInArrow(look, f"row {row_type}, {SCHEMA}" if last else carried.schema)
    return carried


_TYPES = (
    pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()),
    pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
)
_NAMES = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"]


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark passage, with the columns of ``docs``."""
    return scan(docs, benchmark, window).filter(~F.col("contaminated")).select("row.*")
