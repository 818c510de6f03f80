"""Whole texts as byte blocks for numpy: words, their hashes, and their places.

Everything here works on a block of a few megabytes at a time, so a task's
memory is bounded by the block size plus its longest single text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes per block. A block always holds at least one whole text.
BLOCK_BYTES = 2 << 20
#: Odd multiplier of the polynomial word hash, modulo 2^64.
WORD_BASE = 0x9E3779B97F4A7C15
#: Odd multiplier of the hash over several words.
WINDOW_BASE = 0xD6E8FEB86659FD93
SPACE = 0x20


def byte_class(ranges: Iterable[tuple[int, int]]) -> np.ndarray:
    """Truth table over byte values that is true within the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of words ``[^\x20\x09-\x0D]+``.
NON_SPACE = ~byte_class([(0x09, 0x0D), (SPACE, SPACE)])
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z.
LETTER_DIGIT = byte_class([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
#: A-Z to a-z, other bytes unchanged.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def text_bytes(column: pa.Array) -> list[bytes]:
    """The column as UTF-8 byte strings; null is empty."""
    return pc.cast(pc.fill_null(column, ""), pa.large_binary()).to_pylist()


def blocks(batches: Iterable[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches holding about ``limit`` text bytes each, with those texts."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
        for start, stop in zip(edges, edges[1:]):
            part = batch.slice(start, stop - start)
            yield part, text_bytes(part.column(text))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one byte array, each followed by a space, and where each starts."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8) if texts else np.zeros(0, np.uint8)
    starts = np.zeros(len(texts), np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=starts[1:])
    return data, starts


def mix(value: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    value = value ^ (value >> np.uint64(30))
    value = value * np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(27)
    value *= np.uint64(0x94D049BB133111EB)
    value ^= value >> np.uint64(31)
    return value


def powers(base: int, count: int) -> np.ndarray:
    """``base`` to 0, 1, ... modulo 2^64."""
    out = np.full(max(count, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:count]


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values; the last value must be false."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, equal spans alike wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(WORD_BASE, len(data)), out=total[1:])
    inverse = powers(pow(WORD_BASE, -1, 1 << 64), int(starts[-1]) + 1)
    return mix((total[ends] - total[starts]) * inverse[starts])


class Words:
    """The words of some texts: hash, byte place in ``data``, and document of each."""

    def __init__(self, texts: list[bytes], inside: np.ndarray = NON_SPACE, lower: bool = False):
        self.texts = [t.translate(LOWER) for t in texts] if lower else texts
        self.data, self.text_starts = joined(self.texts)
        self.starts, self.ends = runs(inside[self.data]) if len(self.data) else (np.zeros(0, np.int64),) * 2
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        first = np.searchsorted(self.starts, self.text_starts)
        self.edges = np.append(first, len(self.starts))
        self.counts = np.diff(self.edges)
        self.docs = np.repeat(np.arange(len(texts)), self.counts)

    def windows(self, size: int, base: int = WINDOW_BASE) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words of one text, and the index of their first words."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        value = np.zeros(n, np.uint64)
        for k in range(size):
            value = value * np.uint64(base) + self.hashes[k : k + n]
        index = np.flatnonzero(self.docs[:n] == self.docs[size - 1 :])
        return mix(value[index]), index
