"""Token counts with a whole-token shortcut.

A sentence-piece model of the kind used here merges characters by rank, and no
piece has a word-begin mark after another character (checked when the table is
made). So no merge reaches over the start of a run of spaces, nor over a
character that is part of no longer piece, such as a line break. Texts are cut
there into pre-tokens, and the counts of pre-tokens add up to the count of the
text.

The table is proved offline, once per task: every vocabulary string that begins
with the mark is encoded alone, and only those that come back as one token are
in it. A pre-token found in the table counts one; the others are merged by the
library, each different one once per task.

Null and empty texts have no tokens. A text that holds the mark character
itself is given to the library whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from spendwatch.llm.textblocks import BLOCK_BYTES, SPACE, blocks, joined, span_hashes

MARK = "▁"
NEW_LINE = 0x0A
#: Remembered pre-tokens per task; beyond, the memory starts afresh.
REMEMBERED = 400_000


class WholeTokens:
    """Counts of pre-tokens, from the proved table or from the library."""

    def __init__(self, model: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        plain = [p for i, p in enumerate(pieces) if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))]
        if any(MARK in p.lstrip(MARK) for p in plain) or any("\n" in p for p in plain if len(p) > 1):
            raise ValueError("this vocabulary has pieces that cross pre-token borders")
        words = [p[1:] for p in plain if p.startswith(MARK) and p.strip(MARK)]
        alone = [w for w, ids in zip(words, self.library.encode(words, num_threads=1)) if len(ids) == 1]
        self.known = dict.fromkeys(_hashes([b" " + w.replace(MARK, " ").encode() for w in alone]).tolist(), 1)
        self.proved = len(self.known)

    def merged(self, tokens: list[bytes]) -> list[int]:
        """Counts of pre-tokens by the library.

        The library puts a mark before what it is given, and a line break is
        always a token of its own.
        """
        texts = [t.decode() for t in tokens]
        given = [t[1:] + "\n" if t[0] == " " else "\n" + t for t in texts]
        return [len(ids) - (1 if t[0] == " " else 2) for t, ids in zip(texts, self.library.encode(given, num_threads=1))]

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text."""
        mark = MARK.encode()
        whole = {i for i, t in enumerate(texts) if mark in t}
        # the library's own leading mark is the space before each text; the line break after it is not counted
        padded = [b" " + t if t and i not in whole else b"" for i, t in enumerate(texts)]
        data, starts = joined(padded)
        data = data.copy()
        data[starts[1:] - 1] = NEW_LINE
        data[-1:] = NEW_LINE
        space, line = data == SPACE, data == NEW_LINE
        begins = ~line
        begins[1:] &= line[:-1] | (space[1:] & ~space[:-1])
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(data))
        last = np.minimum(last, np.append(np.flatnonzero(line), len(data))[np.searchsorted(np.flatnonzero(line), first)])
        different, one, which = np.unique(span_hashes(data, first, last), return_index=True, return_inverse=True)
        if len(self.known) > self.proved + REMEMBERED:
            self.known = dict(list(self.known.items())[: self.proved])
        known = self.known
        new = [(h, one[k]) for k, h in enumerate(different.tolist()) if h not in known]
        known.update(zip((h for h, _ in new), self.merged([data[first[k] : last[k]].tobytes() for _, k in new])))
        per_token = np.fromiter((known[h] for h in different.tolist()), np.int64, len(different))[which]
        total = np.zeros(len(data) + 1, np.int64)
        total[1:] = line  # a line break is one token
        np.add.at(total, first + 1, per_token)
        total = np.cumsum(total)
        stop = np.append(starts[1:], len(data))
        out = total[stop] - total[starts] - 1  # without the line break put after each text
        for i in whole:
            out[i] = len(self.library.encode(texts[i].decode()))
        return out


def _hashes(tokens: list[bytes]) -> np.ndarray:
    data, starts = joined(tokens)
    return span_hashes(data, starts, starts + [len(t) for t in tokens])


def token_counts(docs: DataFrame, model: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, repeated ids and rows included.

    A narrow pass over the texts without a shuffle; a null id stays null.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WholeTokens(model)
        for part, texts in blocks(batches, "_text", BLOCK_BYTES):
            tokens = counter.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    only = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    return only.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
