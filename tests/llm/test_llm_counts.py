"""Token counts and packing against the libraries, and the linear program."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_brute import rows
from tokenizers import Tokenizer

from spendwatch.llm import cuttingstock, packing
from spendwatch.llm.tokencount import WholeTokens, token_counts

FOLDER = "/root/testdata/sf0.01"
MODEL, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
COUNTS = ("doc_id", "n_bytes", "n_tokens", "over_limit")


def counted(rows):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return sorted(((i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in rows), key=repr)


def test_counts_query(spark, text_queries, texts):
    assert rows(text_queries["op5_token_counts"](spark, FOLDER), *COUNTS) == counted(texts)


def test_counts_of_odd_rows(odd, odd_texts, nothing):
    assert rows(token_counts(odd, MODEL, 4096), *COUNTS) == counted(odd_texts)
    assert token_counts(nothing, MODEL, 4096).collect() == []


def test_counts_of_random_texts():
    rng = random.Random(5)
    texts = ["".join(rng.choice(" \n\tab▁é世'.,1") for _ in range(rng.randrange(14))) for _ in range(3_000)]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert WholeTokens(MODEL).counts([t.encode() for t in texts]).tolist() == [len(x) for x in library.encode(texts)]


def test_ids_of_random_texts():
    rng = random.Random(6)
    parts = [*" \n\tabZé世'.,1<|>_\x01", "<|endoftext|>", "don't", "'s", "İ", "ß", "é", "≠", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(3_000)]
    library = Tokenizer.from_file(WORDS)
    ids, edges = packing.WordIds(WORDS).ids([t.encode() for t in texts], 2)
    for k, t in enumerate(texts):
        assert ids[edges[k] : edges[k + 1]].tolist() == [*library.encode(t, add_special_tokens=False).ids, 2], t


def check_packed(pieces_of, texts, capacity, end=2):
    """Every id lies in one piece, pieces have the right checksums, sequences are gapless and within the capacity."""
    library = Tokenizer.from_file(WORDS)
    wanted = sorted(([*library.encode(t or "", add_special_tokens=False).ids, end] for _, t in texts), key=len)
    pieces = sorted((r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in pieces_of)
    made = sorted((len(x), s, len(x[s : s + capacity]), zlib.crc32(np.array(x[s : s + capacity], "<u4").tobytes())) for x in wanted for s in range(0, len(x), capacity))
    assert pieces == made
    by_sequence = {}
    for r in sorted(pieces_of, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == by_sequence.get(r["sequence_id"], 0)
        by_sequence[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(by_sequence.values(), default=0) <= capacity
    return by_sequence


def test_packing_query(spark, text_queries, texts):
    used = check_packed(text_queries["op7_packing"](spark, FOLDER).collect(), texts, 4096)
    assert sum(used.values()) > 0.97 * 4096 * len(used)


def test_packing_of_odd_rows(odd, odd_texts, nothing, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 4)  # several parts of a class
    check_packed(packing.pack(odd, WORDS, 128, 2).collect(), odd_texts, 128)
    assert packing.pack(nothing, WORDS, 128, 2).collect() == []


def test_patterns_meet_the_demand():
    rng = np.random.default_rng(2)
    sizes = cuttingstock.class_sizes(4096)
    assert sizes[-1] == 4096 and (np.diff(sizes) > 0).all()
    demand = np.where(rng.random(len(sizes)) < 0.3, rng.integers(1, 400, len(sizes)), 0)
    chosen = cuttingstock.whole_patterns(sizes, demand, 4096)
    assert (sum(p * n for p, n in chosen) == demand).all() and max((p * sizes).sum() for p, _ in chosen) <= 4096
    bound = (sizes * demand).sum() / 4096
    assert sum(n for _, n in chosen) < 1.05 * bound + 2


def test_knapsack_is_the_best():
    rng = np.random.default_rng(4)
    sizes, worth = np.array([3, 5, 7, 11]), rng.random(4)
    best = max(a * worth[0] + b * worth[1] + c * worth[2] + d * worth[3] for a in range(9) for b in range(6) for c in range(4) for d in range(3) if 3 * a + 5 * b + 7 * c + 11 * d <= 25)
    value, pattern = cuttingstock.best_pattern(sizes, worth, 25)
    assert abs(value - best) < 1e-9 and abs((pattern * worth).sum() - best) < 1e-9 and (pattern * sizes).sum() <= 25


@pytest.mark.parametrize("draw", [lambda r, n: np.ones(n, int), lambda r, n: r.integers(1, 21, n), lambda r, n: r.integers(1, 61, n), lambda r, n: np.clip(np.exp(r.normal(5, 0.8, n)), 1, 4096).astype(int)])
def test_little_padding_for_short_documents(draw):
    lengths = draw(np.random.default_rng(7), 409_600)
    sizes = cuttingstock.class_sizes(4096)
    demand = np.bincount(np.searchsorted(sizes, lengths), minlength=len(sizes))
    chosen = cuttingstock.whole_patterns(sizes, demand, 4096)
    assert (sum(p * t for p, t in chosen) == demand).all() and all((p * sizes).sum() <= 4096 for p, _ in chosen)
    assert 1 - lengths.sum() / (4096 * sum(t for _, t in chosen)) <= 0.02
