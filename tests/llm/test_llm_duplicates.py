"""Repeated passages, near copies and benchmark passages against brute force."""

import random

import numpy as np
import pytest
from llm_brute import PASSAGE, benchmark_hits, near_groups, rows, without_repeats

from spendwatch.llm import contamination, nearcopies, repeats
from spendwatch.llm.nearcopies import near_copies, one_of_each

FOLDER = "/root/testdata/sf0.01"
REPEATS = ("doc_id", "n_words", "n_removed", "kept_sha256")
HITS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
NEAR = ("doc_id", "n_shingles", "component_id", "kept")


def test_repeats_query(spark, text_queries, texts):
    assert rows(text_queries["op2_substring_dedup"](spark, FOLDER), *REPEATS) == sorted(without_repeats(texts), key=repr)


def test_repeats_of_odd_rows(odd, odd_texts):
    assert rows(repeats.removed_words(odd), *REPEATS) == sorted(without_repeats(odd_texts), key=repr)


def test_repeats_meet_across_blocks_and_buckets(spark, monkeypatch):
    """Tiny text blocks and many buckets: nothing is settled inside a block, and a common passage is in every text."""
    monkeypatch.setattr(repeats, "TASK_BYTES", 200)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 500)
    rng = random.Random(3)
    made = []
    for k in range(120):
        own = [f"v{rng.randrange(40)}" for _ in range(rng.randrange(60))]
        at = rng.randrange(len(own) + 1)
        made.append((k, " ".join(own[:at] + PASSAGE.split()[rng.randrange(30) :] * (k % 3 > 0) + own[at:])))
    docs = spark.createDataFrame(made, "doc_id bigint, text string").repartition(7)
    assert rows(repeats.removed_words(docs), *REPEATS) == sorted(without_repeats(made), key=repr)


def test_repeats_read_texts_in_bounded_batches(spark, monkeypatch):
    """All documents in one partition: no task is given more rows at once than the bound."""
    kept = repeats.blocks

    def bounded(batches, *more):
        for batch in batches:
            assert batch.num_rows <= 50
            yield from kept([batch], *more)

    monkeypatch.setattr(repeats, "BATCH_ROWS", 50, raising=False)
    monkeypatch.setattr(repeats, "blocks", bounded)
    made = [(k, f"own{k} " * (k % 5) + PASSAGE * (k % 3 > 0)) for k in range(300)]
    docs = spark.createDataFrame(made, "doc_id bigint, text string").coalesce(1)
    assert rows(repeats.removed_words(docs), *REPEATS) == sorted(without_repeats(made), key=repr)


def test_repeats_of_an_empty_table(nothing):
    assert repeats.removed_words(nothing).collect() == []


def test_anchor_must_fit(odd):
    with pytest.raises(ValueError):
        repeats.removed_words(odd, repeat=12, block=7)


def test_benchmark_query(spark, text_queries, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    found = rows(text_queries["op3_decontamination"](spark, FOLDER), "doc_id", *HITS)
    wanted = benchmark_hits(texts, items)
    assert found == sorted(wanted, key=repr) and any(r[-1] for r in wanted)


ITEMS = [(1, PASSAGE.upper()), (2, "one TWO, three"), (3, None), (4, ""), (None, "few words"), (5, "one two"), (5, "again one two"), (30, "é" * 40 + " 😀")]


@pytest.mark.parametrize("part", [contamination.AUTOMATON_BYTES, 100])
def test_benchmark_in_odd_rows(spark, odd, odd_texts, monkeypatch, part):
    """With one automaton and with several that scan one after another."""
    monkeypatch.setattr(contamination, "AUTOMATON_BYTES", part)
    benchmark = spark.createDataFrame(ITEMS, "item_id int, text string")
    found = contamination.scan(odd, benchmark)
    assert rows(found, "row.doc_id", *HITS) == sorted(benchmark_hits(odd_texts, ITEMS), key=repr)
    left = contamination.decontaminated(odd, benchmark)
    assert left.columns == odd.columns and left.count() == sum(not r[-1] for r in benchmark_hits(odd_texts, ITEMS))


def test_spans_point_into_the_original(spark):
    text = "xx É— One,  TWO\nthree! yy"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    row = contamination.scan(docs, spark.createDataFrame([("a", "one two three")], "item_id string, text string")).first()
    assert [text[s["start"] : s["stop"]] for s in row["spans"]] == ["One,  TWO\nthree"]


def test_benchmark_of_empty_tables(spark, nothing, odd):
    none = spark.createDataFrame([], "item_id int, text string")
    assert contamination.scan(nothing, none).collect() == []
    assert {r["contaminated"] for r in contamination.scan(odd, none).collect()} == {False}


def test_near_copies_of_odd_rows(odd, odd_texts):
    assert rows(near_copies(odd, 3, 85), *NEAR) == sorted(near_groups(odd_texts, 3, 85), key=repr)


def test_near_copies_of_an_empty_table(nothing):
    assert near_copies(nothing, 3, 85).collect() == []


def _copies(seed):
    """Groups of near copies of all closenesses, among them one larger than a small node."""
    rng = np.random.default_rng(seed)
    made = []
    for group, count in enumerate([150, 40, 12, 5, 5, 3, 2, 2]):
        words = [f"g{group}w{k}" for k in rng.integers(0, 400, 120)]
        for _ in range(count):
            copy = list(words)
            for at in rng.integers(0, len(copy), rng.integers(0, 5)):
                copy[at] = f"new{rng.integers(0, 10**6)}"
            made.append((len(made), " ".join(copy)))
    return made


def test_near_copies_in_large_groups(spark):
    made = _copies(11)
    docs = spark.createDataFrame(made, "doc_id bigint, text string").repartition(5)
    assert rows(near_copies(docs, 3, 85), *NEAR) == sorted(near_groups(made, 3, 85), key=repr)


@pytest.mark.parametrize("block", [768, 9])
def test_leaves_of_several_groups(spark, monkeypatch, block):
    """Texts that share half their words meet in large leaves but are linked in small groups only."""
    monkeypatch.setattr(nearcopies, "SMALL", 8)
    monkeypatch.setattr(nearcopies, "LARGE", 20)
    monkeypatch.setattr(nearcopies, "BLOCK_CLASSES", block)
    monkeypatch.setattr(nearcopies, "LEADERS", 1)
    rng = np.random.default_rng(block)
    shared, made = [f"s{k}" for k in range(60)], []
    for group in range(30):
        own = shared + [f"g{group}w{k}" for k in range(int(rng.integers(6, 40)))]
        for _ in range(int(rng.integers(1, 9))):
            copy = list(own)
            for at in rng.integers(0, len(copy), rng.integers(0, 3)):
                copy[at] = f"new{rng.integers(0, 10**6)}"
            made.append((len(made), " ".join(copy)))
    docs = spark.createDataFrame(made, "doc_id bigint, text string").repartition(5)
    waves = []
    monkeypatch.setattr(nearcopies, "outsiders", lambda *a, kept=nearcopies.outsiders: waves.append(1) or kept(*a))
    assert rows(near_copies(docs, 3, 85), *NEAR) == sorted(near_groups(made, 3, 85), key=repr)
    assert waves  # the third wave had work


def test_work_grows_linearly_with_a_group(spark, monkeypatch):
    """All rows that carry whole sets, for near copies of one text."""
    work, kept = [], nearcopies.confirmed
    monkeypatch.setattr(nearcopies, "confirmed", lambda cells, *more: work.append(cells.count()) or kept(cells, *more))
    total = {}
    for count in (1_000, 2_000, 4_000):
        rng = np.random.default_rng(count)
        base = [f"w{k}" for k in range(120)]
        made = []
        for k in range(count):
            copy = list(base)
            for at in rng.integers(0, 120, 2):
                copy[at] = f"new{rng.integers(0, 10**9)}"
            made.append((k, " ".join(copy)))
        work.clear()
        found = near_copies(spark.createDataFrame(made, "doc_id bigint, text string").repartition(8), 3, 85)
        assert found.filter("component_id <> 0").isEmpty()  # the brute-force result: every text is linked through others
        total[count] = sum(work)
    assert total[2_000] <= 2.3 * total[1_000] and total[4_000] <= 2.3 * total[2_000]
    assert total[4_000] <= 10 * 4_000


def test_connected_groups_do_not_multiply_in_the_trees(spark, monkeypatch):
    """All rows written on the way, for near copies of one text in nodes far above the size that branches."""
    count, kept = [], nearcopies.written
    monkeypatch.setattr(nearcopies, "SMALL", 8)
    monkeypatch.setattr(nearcopies, "LARGE", 20)
    monkeypatch.setattr(nearcopies, "written", lambda df, *more: (made := kept(df, *more), count.append(made.count()))[0])
    total = {}
    for copies in (100, 400):
        rng = np.random.default_rng(copies)
        made = []
        for k in range(copies):
            copy = [f"w{k}" for k in range(120)]
            copy[rng.integers(0, 120)] = f"new{k}"
            made.append((k, " ".join(copy)))
        count.clear()
        found = near_copies(spark.createDataFrame(made, "doc_id bigint, text string").repartition(4), 3, 85)
        assert found.filter("component_id <> 0").isEmpty()
        total[copies] = sum(count)
    assert total[400] <= 5 * total[100]


def test_nodes_that_can_meet_at_once_branch_once(spark, monkeypatch):
    """Texts that share half their words, mostly not linked, in nodes above the smallest size: classes are repeated on one level only."""
    made, kept = [], nearcopies._children
    monkeypatch.setattr(nearcopies, "SMALL", 8)
    monkeypatch.setattr(nearcopies, "_children", lambda nodes: made.append(nodes.count()) or kept(nodes))
    rng = np.random.default_rng(5)
    texts = []
    for k in range(60):
        copy = [f"s{i}" for i in range(60)] + [f"g{k // 3}w{i}" for i in range(30)]
        copy[rng.integers(60, 90)] = f"new{k}"
        texts.append((k, " ".join(copy)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    assert rows(near_copies(docs, 3, 85), *NEAR) == sorted(near_groups(texts, 3, 85), key=repr)
    assert len(made) == 1


def test_one_of_each_keeps_columns(odd, odd_texts):
    kept = one_of_each(odd, 5, 80)
    assert kept.columns == odd.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    # rows without words all stay; one row stays of every other group
    groups = near_groups([(k, t) for k, (_, t) in enumerate(odd_texts)], 5, 80)
    assert len(found) == len({g[2] for g in groups})
    assert sum(t is None or not t.strip() for _, t in found) == sum(t is None or not t.strip() for _, t in odd_texts)
