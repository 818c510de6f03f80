"""Piece encoding by a table of last tokens, and decoding.

In a merge-type (BPE) vocabulary each prefix of a text has exactly one last
token: its encoding is a chain in which every two neighbours, encoded together,
stay those two. So the table of a pre-token is filled from left to right. An
automaton over the vocabulary names the pieces that end at a place, and the one
that is compatible with the last token of the prefix before it is the entry.
The ids are then read backwards through the table. The work is linear in the
text and does not depend on how its merges nest.

Why pairs are enough: until the first merge over a border, what happens inside
two neighbours is the same in the text and in the pair alone, ties included
(the leftmost of equal merges goes first in both).

Texts are cut before runs of spaces and at line breaks where the vocabulary has
no piece over such a border (checked); each different pre-token is worked out
once per task. Characters outside the vocabulary become byte pieces and merge
with nothing.

Null texts are empty and get the begin and end ids alone; repeated ids and rows
are rows of their own, an empty table gives none, and further columns of the
table are not read.
"""

from __future__ import annotations

import codecs
import math
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from spendwatch.llm.textblocks import BLOCK_BYTES, blocks

MARK = "▁"
#: Longest pre-token that is remembered, and how many are; beyond, the memory starts afresh.
REMEMBERED_CHARS, REMEMBERED = 48, 600_000
#: Remembered answers of the pair test.
PAIRS = 2_000_000
#: What stands in the table where no piece ends, and before the first place.
NOTHING = -1
#: A text whose normal form shows whether the model changes characters.
PROBE = "a  ﬁ ÅÅ​　\tＡ b "
UNKNOWN_TEXT = " ⁇ ".encode()


def _one_mark_per_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("one_mark_per_byte", _one_mark_per_byte)


class PrefixTable:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, model: str):
        library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = library.get_piece_size()
        if library.normalize(PROBE) != MARK + PROBE.replace(" ", MARK):
            raise ValueError("only models that leave characters as they are and mark the begin are read")
        if any(library.is_unused(i) for i in range(size)):
            raise ValueError("models with unused pieces are not read")
        self.begin, self.end = library.bos_id(), library.eos_id()
        special = {i for i in range(size) if library.is_control(i) or library.is_unknown(i)}
        self.byte_ids = {int(library.id_to_piece(i)[3:5], 16): i for i in range(size) if library.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary must hold all bytes")
        self.names = [library.id_to_piece(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(self.names) if i not in special and not library.is_byte(i)}
        if any(c not in self.ids for p in self.ids for c in p):
            raise ValueError("each character of a piece must be a piece")
        self.rank = {p: -library.get_score(i) for p, i in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        crossing = any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p in self.ids)
        self.cut = None if crossing else re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+").findall
        self.pairs: dict[int, bool] = {}
        self.spines: dict[tuple[int, bool], list | None] = {}
        self.known: dict[str, bytes] = {}
        self.bytes_of = [b"" if i in special else p.replace(MARK, " ").encode() for i, p in enumerate(self.names)]
        for value, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([value])
        self.bytes_of[library.unk_id()] = UNKNOWN_TEXT
        self.special = special - {library.unk_id()}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by its merges, best first and leftmost among equals."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, place = None, -1
            for k in range(len(parts) - 1):
                r = rank.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r < best):
                    best, place = r, k
            if place < 0:
                break
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return parts

    def spine(self, piece: int, right: bool) -> list[tuple[str, float, float]] | None:
        """The outer pieces of a piece through time, last first: text, rank of its birth and of its end.

        None where the merges inside do not run in the order of their ranks, so
        that only going through them tells; always so where ranks tie.
        """
        key = (piece, right)
        if key in self.spines:
            return self.spines[key]
        text, rank = self.names[piece], self.rank
        parts, born, steps = list(text), {c: -math.inf for c in text}, []
        while len(parts) > 1:
            found = [(rank[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
            if not found:
                break
            r, k = min(found)
            steps.append(r)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            outer = parts[-1] if right else parts[0]
            if outer not in born:
                born[outer] = r
        spine = None
        if len(parts) == 1 and all(a < b for a, b in zip(steps, steps[1:])):
            ends = [p for p in born if (text.endswith(p) if right else text.startswith(p))]
            ends = sorted({p for p in ends if len(p) > 1 or p == (text[-1] if right else text[0])}, key=len, reverse=True)
            spine = [(p, born[p], born[ends[k - 1]] if k else math.inf) for k, p in enumerate(ends)]
        self.spines[key] = spine
        return spine

    def tested(self, left: int, right: int) -> bool:
        """Whether the pieces stay themselves: no two outer pieces that live at one time merge before either ends."""
        one, two = self.spine(left, True), self.spine(right, False)
        if one is None or two is None:
            want = [self.names[left], self.names[right]]
            return self.merged("".join(want)) == want
        i = j = 0
        while True:
            (a, a_born, a_ends), (b, b_born, b_ends) = one[i], two[j]
            r = self.rank.get(a + b)
            if r is not None and r < a_ends and r <= b_ends:  # of equal merges the left one goes first
                return False
            if a_born == b_born == -math.inf:
                return True
            if a_born > b_born:
                i += 1
            else:
                j += 1

    def chain(self, token: str) -> bytes:
        """Ids of one pre-token, packed: the table forwards, the ids backwards."""
        last, size = [NOTHING] * len(token), [1] * len(token)
        pairs, width = self.pairs, len(self.names)
        for stop, (piece, length) in self.automaton.iter(token):
            if last[stop] == NOTHING:
                start = stop + 1 - length
                before = last[start - 1] if start else NOTHING
                key = (before + 1) * width + piece
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    fits = self.merged(self.names[piece]) == [self.names[piece]] if before == NOTHING else self.tested(before, piece)
                    pairs[key] = fits
                if fits:
                    last[stop], size[stop] = piece, length
        out, at = [], len(token) - 1
        while at >= 0:
            if last[at] == NOTHING:
                out.extend([self.byte_ids[b] for b in reversed(token[at].encode())])
            else:
                out.append(last[at])
            at -= size[at]
        out.reverse()
        return struct.pack(f"<{len(out)}I", *out)

    def remembered(self, token: str) -> bytes:
        packed = self.chain(token)
        if len(token) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[token] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a whole text without begin and end, as packed little-endian numbers."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        known, add = self.known.get, self.remembered
        return b"".join([known(t) or add(t) for t in (self.cut(marked) if self.cut else [marked])])

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; begin and end ids are silent, the first mark goes.

        A byte that is no part of a character becomes a replacement mark. A
        silent id ends the character before it.
        """
        ids = np.frombuffer(packed, "<u4").tolist()
        out, special, first = [], self.special, True
        edges = [-1, *[k for k, i in enumerate(ids) if i in special], len(ids)]
        for before, stop in zip(edges, edges[1:]):
            run = ids[before + 1 : stop]
            if run:
                data = b"".join([self.bytes_of[i] for i in run])
                out.append(data[first and self.names[run[0]].startswith(MARK) :].decode("utf-8", "one_mark_per_byte"))
                first = False
        return "".join(out)


@lru_cache(maxsize=2)
def prefix_table(model: str) -> PrefixTable:
    """One table per process and model."""
    return PrefixTable(model)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row, begin and end ids included.

    ``ids`` holds little-endian unsigned 32-bit numbers. A narrow pass; a block
    of texts is worked on at a time.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model)
        before, after = np.array([table.begin], "<u4").tobytes(), np.array([table.end], "<u4").tobytes()
        for part, texts in blocks(batches, "_text", BLOCK_BYTES):
            ids = [before + table.encode(t.decode()) + after for t in texts]
            counts = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("_id"), counts, pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    only = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    return only.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` with the text ``decoded`` from the ids; null ids are none."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model)
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            edges = [0, *(np.flatnonzero(np.diff(sizes // (4 * BLOCK_BYTES))) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for start, stop in zip(edges, edges[1:]):
                part = batch.slice(start, stop - start)
                texts = [table.decode(i or b"") for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary, decoded string")
