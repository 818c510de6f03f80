"""Piece encoding against the library, ids and decoded texts."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from spendwatch.llm.count_queries import piece_roundtrip_query
from spendwatch.llm.prefixtable import PrefixTable, decode, encode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return PrefixTable(MODEL)


def _ids(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


def _texts(pieces, rng):
    letters = list("aeinrst  \n\tABé▁ñß€漢字😀́\x00<>s/0x12")
    names = list(pieces.ids)
    for k in range(4000):
        if k % 2:
            yield "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        else:
            yield "".join(rng.choice(names) for _ in range(rng.randrange(12))).replace("▁", " " if k % 4 else "▁")
    yield from ("", " ", "\n", "  \n ", "^^^^^", "a" * 3000, " " * 700, "<s>a</s><unk><0x0A>", "ab" * 1500, "\U0010ffff￿")


def test_same_ids_as_the_library(pieces, library):
    for text in _texts(pieces, random.Random(4)):
        assert _ids(pieces.encode(text)) == library.encode(text), text


def test_same_text_as_the_library(pieces, library):
    rng = random.Random(8)
    odd = [0, 1, 2, *pieces.byte_ids.values(), *(pieces.ids[p] for p in ("▁", "▁▁", "▁a", "a"))]
    for _ in range(6000):
        ids = [rng.choice(odd) if rng.random() < 0.7 else rng.randrange(32_000) for _ in range(rng.randrange(9))]
        assert pieces.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_pair_test_is_what_merging_says(pieces):
    rng = random.Random(2)
    alone = [i for p, i in pieces.ids.items() if pieces.merged(p) == [p]]
    for _ in range(30_000):
        u, v = rng.choice(alone), rng.choice(alone)
        names = [pieces.names[u], pieces.names[v]]
        assert pieces.tested(u, v) == (pieces.merged("".join(names)) == names)


def test_each_prefix_has_one_last_piece(pieces):
    for token in ("▁internationalisation", "▁▁▁▁▁xyzzy", "aaaaaaabaaaa", "^^^^"):
        chains = {}
        for stop in range(1, len(token) + 1):
            fits = [p for p in pieces.ids if token[:stop].endswith(p) and pieces.merged(token[:stop])[-1] == p]
            assert len(fits) == 1
            chains[stop] = fits[0]
        assert _ids(pieces.chain(token))[-1] == pieces.ids[chains[len(token)]]


def test_memory_starts_afresh(pieces, monkeypatch):
    monkeypatch.setattr("spendwatch.llm.prefixtable.REMEMBERED", 3)
    monkeypatch.setattr("spendwatch.llm.prefixtable.PAIRS", 3)
    small = PrefixTable(MODEL)
    text = "some words and some more words, over and over again"
    assert small.encode(text) == pieces.encode(text)
    assert len(small.known) <= 3


def test_rows(spark, library):
    long = "wörter ohne Ende " * 20_000
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (None, "", None), (3, long, "x"), (4, "x" * 50_000, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    got = decode(encode(docs, MODEL), MODEL).collect()
    assert len(got) == len(rows)
    for row, (doc, text, _) in zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens)), sorted(rows, key=lambda r: (str(r[0]), len(r[1] or "")))):
        want = library.encode(text or "", add_bos=True, add_eos=True)
        assert (row.doc_id, row.n_tokens, _ids(bytes(row.ids)), row.decoded) == (doc, len(want), want, library.decode(want))
    assert decode(encode(docs.limit(0), MODEL), MODEL).count() == 0


def test_query_over_the_table(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = piece_roundtrip_query(spark, folder).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = library.encode(texts[row.doc_id], add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
