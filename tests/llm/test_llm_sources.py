"""Pointer sort and source divergence against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from spendwatch.llm import pointersort, sourceaudit
from spendwatch.llm.pointersort import equal_runs, sorted_pointers
from spendwatch.llm.sourceaudit import source_divergence, term_counts

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("small", [2, 300, 32_768])
def test_pointers_come_out_in_byte_order(small, monkeypatch):
    monkeypatch.setattr(pointersort, "SMALL", small)
    rng = random.Random(small)
    words = ["".join(rng.choice("abc") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 40]))).encode() for _ in range(1500)]
    words += ["häßlich".encode(), b"aaaaaaaa", b"aaaaaaaaa"] * 40 + [b"a" * 8 * k for k in range(1, 30)]
    rng.shuffle(words)
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    ends = starts + [len(w) for w in words]
    order = sorted_pointers(data, starts, ends)
    assert [words[k] for k in order] == sorted(words)
    run = equal_runs(data, starts, ends, order)
    assert all((words[a] == words[b]) == (x == y) for a, b, x, y in zip(order, order[1:], run, run[1:]))
    none = np.zeros(0, np.int64)
    assert len(sorted_pointers(data, none, none)) == 0 and len(equal_runs(data, none, none, none)) == 0


def _plain(rows, least=3, top=200):
    docs = [(l or "", s or "", WORD.findall((t or "").translate(LOWER))) for t, l, s in rows]
    found, count = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for lang, source, words in docs:
        groups[lang].add(source)
        found[lang].update(set(words))
        count[lang, source].update(words)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, c in found[lang].items() if c >= least)
        v, whole = len(kept), Counter()
        for s in sources:
            whole.update({t: count[lang, s][t] for t in kept})

        def share(c, v=v, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept}

        q, p = share(whole), {s: share(count[lang, s]) for s in sources}
        for s in sources:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            term = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, values in (("pair", pair), ("term", term)):
                ranked = sorted(values, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, f, k) for k, (i, f) in enumerate(ranked, 1) if part == "pair" or k <= top}
    return out


def _rows(rng, n):
    words = ["Alpha", "beta", "Größe", "naïve", "x", "it's", "漢字", "a1b", "GAMMA-delta", "eps"] + [f"w{k}" for k in range(30)]
    words = [w + chr(97 + k % 26) for k, w in enumerate(words)]
    out = []
    for k in range(n):
        text = rng.choice([None, "", "  ", "1 2 3"]) if k % 17 == 0 else " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))
        out.append((text, rng.choice(["en", "de", None, ""]), "hot" if k % 3 == 0 else rng.choice(["s1", "s2", None, "S1"])))
    return out + [("only here", "xx", "s1"), ("only here", "xx", "s2"), (None, "yy", "s1"), (None, None, None)] + out[:20]


@pytest.mark.parametrize("parts", [1, 23])
def test_same_as_plain_counting(spark, parts):
    rows = _rows(random.Random(6), 300)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, source string, n int, item int").repartition(parts)
    got = [tuple(r) for r in source_divergence(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == _plain(rows)


def test_rank_limit_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(sourceaudit, "SHARD_BYTES", 200)
    rows = _rows(random.Random(9), 200)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert {tuple(r) for r in source_divergence(docs, least=2, top=3).collect()} == _plain(rows, 2, 3)


def test_documents_of_a_term(spark):
    docs = spark.createDataFrame([("a a A b", "en", "s"), ("a c", "en", "s"), ("a", "en", "t"), ("ab " * 30_000, "en", "t")], "text string, lang string, source string")
    got = {(r.source, r.term): (r.n, r.docs) for r in term_counts(docs).collect()}
    assert got == {("s", "a"): (4, 2), ("s", "b"): (1, 1), ("s", "c"): (1, 1), ("t", "a"): (1, 1), ("t", "ab"): (30_000, 1)}


def test_empty_table(spark):
    assert source_divergence(spark.createDataFrame([], "text string, lang string, source string")).collect() == []
