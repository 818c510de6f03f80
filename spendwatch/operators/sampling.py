"""Exact, reproducible samples and splits that need no global sort.

Rows are ordered by a hash of their key. Taking the first k rows of that order
means keeping every row at or below one cut point, so once the cut is known the
sample is a plain filter on the scan: no shuffle, no window, and the same rows
under any partitioning. The cut is found by counting rows per hash interval and
narrowing to the interval that holds rank k.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Hashable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.hashing import unit_hash

INTERVALS = 4_096
RANK_LOCALLY_BELOW = 10_000
MAX_STRATA = 64
#: Hash cells for each asked position, parts of a cell that is counted again, rows from which it is, and cells at most.
CELLS_EACH = 4
FINER = 64
CROWDED = 64
MOST_CELLS = 1 << 48

Cut = tuple[float, object]


def sample_size(rows: int, fraction: float) -> int:
    """Rows in a fractional sample: half-even rounding of ``rows * fraction``."""
    return round(rows * fraction)


def test_size(rows: int, share: float) -> int:
    """Rows in the test part: the share, rounded up."""
    return math.ceil(rows * share)


test_size.__test__ = False  # not a test case


def hash_cuts(
    df: DataFrame,
    key: str,
    seed: object,
    want: Callable[[dict[Hashable, int]], dict[Hashable, int]],
    by: str | None = None,
) -> dict[Hashable, Cut | None]:
    """Cut point ``(draw, key)`` per stratum such that the wanted number of rows lie at or below it.

    ``want`` maps rows per stratum to wanted rows per stratum. A stratum that
    wants nothing gets None. ``key`` must identify a row. What reaches the
    driver is bounded: interval counts, then at most ``RANK_LOCALLY_BELOW``
    keys per stratum.
    """
    stratum = F.col(by) if by else F.lit("all")
    draws = df.select(stratum.alias("stratum"), F.col(key).alias("key"), unit_hash(seed, key).alias("draw"))

    def count_intervals(rows: DataFrame, low: Column, width: Column) -> dict[Hashable, dict[int, int]]:
        slot = F.floor((F.col("draw") - low) / width).cast("int").alias("slot")
        found: dict[Hashable, dict[int, int]] = {}
        for row in rows.groupBy("stratum", slot).count().collect():
            found.setdefault(row["stratum"], {})[row["slot"]] = row["count"]
        return found

    counts = count_intervals(draws, F.lit(0.0), F.lit(1.0 / INTERVALS))
    if len(counts) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    wanted = want({s: sum(c.values()) for s, c in counts.items()})

    cuts: dict[Hashable, Cut | None] = {}
    open_: dict[Hashable, list] = {}
    for s, slots in counts.items():
        k = wanted.get(s, 0)
        cuts[s] = None
        if k >= sum(slots.values()):
            cuts[s] = (1.0, None)
        elif k > 0:
            open_[s] = [0.0, 1.0 / INTERVALS, k, slots]

    while open_:
        narrowed = {}
        for s, (low, width, k, slots) in open_.items():
            slot, before = _slot_of_rank(slots, k)
            narrowed[s] = (low + slot * width, width, k - before, slots[slot])
        inside = _inside(narrowed)
        if max(n[3] for n in narrowed.values()) <= RANK_LOCALLY_BELOW:
            members: dict[Hashable, list[Cut]] = {s: [] for s in narrowed}
            for row in draws.filter(inside).collect():
                members[row["stratum"]].append((row["draw"], row["key"]))
            for s, (_, _, k, _) in narrowed.items():
                cuts[s] = sorted(members[s])[k - 1]
            break
        if min(n[1] for n in narrowed.values()) < 2.0**-50:
            raise ValueError(f"{key} does not identify rows")
        low = _by_stratum(narrowed, 0)
        width = _by_stratum(narrowed, 1) / INTERVALS
        finer = count_intervals(draws.filter(inside), low, width)
        open_ = {s: [n[0], n[1] / INTERVALS, n[2], finer[s]] for s, n in narrowed.items()}
    return cuts


def _slot_of_rank(slots: dict[int, int], rank: int) -> tuple[int, int]:
    before = 0
    for slot in sorted(slots):
        if before + slots[slot] >= rank:
            return slot, before
        before += slots[slot]
    raise AssertionError("rank beyond the counted rows")


def _inside(narrowed: dict) -> Column:
    terms = [
        F.col("stratum").eqNullSafe(F.lit(s)) & (F.col("draw") >= low) & (F.col("draw") < low + width)
        for s, (low, width, _, _) in narrowed.items()
    ]
    condition = terms[0]
    for term in terms[1:]:
        condition = condition | term
    return condition


def _by_stratum(narrowed: dict, position: int) -> Column:
    chosen = F.lit(None).cast("double")
    for s, values in narrowed.items():
        chosen = F.when(F.col("stratum").eqNullSafe(F.lit(s)), F.lit(values[position])).otherwise(chosen)
    return chosen


def at_or_below(cuts: dict[Hashable, Cut | None], key: str, seed: object, by: str | None = None) -> Column:
    """Membership test of the sample as a row expression."""
    draw = unit_hash(seed, key)
    chosen = F.lit(False)
    for s, cut in cuts.items():
        if cut is None:
            test = F.lit(False)
        elif cut[1] is None:
            test = F.lit(True)
        else:
            test = (draw < cut[0]) | ((draw == cut[0]) & (F.col(key) <= F.lit(cut[1])))
        chosen = test if by is None else F.when(F.col(by).eqNullSafe(F.lit(s)), test).otherwise(chosen)
    return chosen


def sample_exact(
    df: DataFrame, key: str, fraction: float | None = None, n: int | None = None, seed: object = 42
) -> DataFrame:
    """Uniform sample without replacement of an exact size."""

    def want(rows: dict) -> dict:
        return {s: sample_size(c, fraction) if n is None else min(n, c) for s, c in rows.items()}

    return df.filter(at_or_below(hash_cuts(df, key, seed, want), key, seed))


def split_exact(df: DataFrame, key: str, share: float = 0.15, seed: object = 42) -> DataFrame:
    """Adds ``is_test``: exactly ``ceil(n * share)`` rows are test rows."""

    def want(rows: dict) -> dict:
        return {s: test_size(c, share) for s, c in rows.items()}

    return df.withColumn("is_test", at_or_below(hash_cuts(df, key, seed, want), key, seed))


def proportional_sizes(rows: dict[Hashable, int], total: int) -> dict[Hashable, int]:
    """Split ``total`` over strata in proportion, largest remainders first."""
    n = sum(rows.values())
    shares = {s: c * total / n for s, c in rows.items()}
    sizes = {s: math.floor(v) for s, v in shares.items()}
    order = sorted(rows, key=lambda s: (sizes[s] - shares[s], str(s)))
    for s in order[: total - sum(sizes.values())]:
        sizes[s] += 1
    return sizes


def split_stratified(df: DataFrame, key: str, by: str, share: float = 0.15, seed: object = 42) -> DataFrame:
    """As :func:`split_exact`, with each stratum represented in proportion."""

    def want(rows: dict) -> dict:
        return proportional_sizes(rows, test_size(sum(rows.values()), share))

    return df.withColumn("is_test", at_or_below(hash_cuts(df, key, seed, want, by), key, seed, by))


def split_bernoulli(df: DataFrame, key: str, share: float = 0.15, seed: object = 42) -> DataFrame:
    """Approximate split: each row decides alone, so no pass over the data is needed."""
    return df.withColumn("is_test", unit_hash(seed, key) < share)


def folds(df: DataFrame, key: str, k: int = 5, seed: object = 42) -> DataFrame:
    """Adds ``fold`` in 0..k-1 for cross-validation."""
    return df.withColumn("fold", F.floor(unit_hash(seed, key) * k).cast("int"))


def dense_index(df: DataFrame, key: str, seed: object, name: str = "row_index") -> DataFrame:
    """Adds the 0-based position of each row in hash order.

    Positions come from interval offsets plus a rank inside the interval, so
    ranking work is spread over ``INTERVALS`` even groups instead of one global
    sort. The offsets table has at most ``INTERVALS`` rows.
    """
    from pyspark.sql import Window

    drawn = df.withColumn("_draw", unit_hash(seed, key)).withColumn(
        "_slot", F.floor(F.col("_draw") * INTERVALS).cast("int")
    )
    sizes = drawn.groupBy("_slot").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slot", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_slot").orderBy("_draw", key)
    ranked = drawn.withColumn("_rank", F.row_number().over(within) - 1)
    indexed = ranked.join(F.broadcast(offsets), "_slot")
    return indexed.withColumn(name, F.col("_offset") + F.col("_rank")).drop(
        "_draw", "_slot", "_rank", "_offset"
    )


def rows_at_positions(df: DataFrame, key: str, seed: object, positions: DataFrame, name: str = "row_index", fold: str | None = None) -> DataFrame:
    """The rows of ``df`` at the given positions of its hash order, with the position.

    The order is that of :func:`dense_index`, but the table is never shuffled.
    Rows are counted per hash cell, about ``CELLS_EACH`` cells for a position.
    A cell that holds an asked position and many rows is counted again in
    ``FINER`` parts, until only rows of small cells leave the scan. The number
    of cells depends on the number of positions alone, so their counts are
    searched on the driver; ``positions`` has one column ``name`` and a size
    fixed by its caller.

    With ``fold``, ``positions`` also has ``part``: a position counts only rows
    whose ``fold`` differs from it, and a row is returned for each such part
    that asks for it. All parts share the passes over the table.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    part_of = F.col("part") if fold else F.lit(0)
    held = positions.select(part_of.cast("int").alias("part"), F.col(name).cast("bigint").alias("at")).distinct().toPandas()
    held = held[held["at"] >= 0].sort_values(["part", "at"])
    parts, which = np.unique(held["part"].to_numpy(dtype=np.int64), return_inverse=True)
    asked = held["at"].to_numpy(dtype=np.int64)
    drawn = df.withColumn("_draw", unit_hash(seed, key)).withColumn("_fold", F.col(fold) if fold else F.lit(-1))
    cells = 1 << max(1, CELLS_EACH * len(asked) - 1).bit_length()

    def counted(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells in order; for each part the rows before each cell, and in it."""
        found = rows.groupBy(F.floor(F.col("_draw") * cells).alias("cell"), F.col("_fold").alias("fold")).agg(F.count("*").alias("n")).toPandas()
        cell, at = np.unique(found["cell"].to_numpy(dtype=np.int64), return_inverse=True)
        n, left_out = found["n"].to_numpy(dtype=np.int64), found["fold"].to_numpy(dtype=np.int64)
        size = np.zeros((len(cell), len(parts)), np.int64)
        for k, part in enumerate(parts):
            np.add.at(size[:, k], at, np.where(left_out == part, 0, n) if fold else n)
        return cell, np.cumsum(size, axis=0) - size, size

    def placed(before: np.ndarray, place: np.ndarray) -> np.ndarray:
        at = np.zeros(len(place), np.int64)
        for k in range(len(parts)):
            at[which == k] = np.searchsorted(before[:, k], place[which == k], side="right") - 1
        return at

    def within(cell: np.ndarray) -> DataFrame:
        wanted = spark.createDataFrame(pd.DataFrame({"_in": np.unique(cell)}), "_in bigint")
        return drawn.join(F.broadcast(wanted), F.floor(F.col("_draw") * cells) == F.col("_in"), "left_semi")

    cell, before, size = counted(drawn)
    there = asked < size.sum(axis=0)[which]
    asked, which = asked[there], which[there]
    columns = [*df.columns, *(["part"] if fold else []), name]
    if not len(asked):
        return df.limit(0).withColumn("part", F.lit(0)).withColumn(name, F.lit(0).cast("bigint")).select(*columns)
    at = placed(before, asked)
    turn = asked - before[at, which]
    while size[at, which].max() > CROWDED and cells * FINER <= MOST_CELLS:
        parent, rows = cell[at], within(cell[at])
        cells *= FINER
        cell, before, size = counted(rows)
        place = before[np.searchsorted(cell, parent * FINER), which] + turn
        at = placed(before, place)
        turn = place - before[at, which]

    wanted = pd.DataFrame({"_in": cell[at], "_for": parts[which], "_turn": turn, name: asked})
    found = spark.createDataFrame(wanted, f"_in bigint, _for int, _turn bigint, {name} bigint")
    every = F.array(*[F.lit(int(p)) for p in parts])
    inside = within(cell[at]).withColumn("_cell", F.floor(F.col("_draw") * cells)).withColumn("part", F.explode(every))
    if fold:
        inside = inside.filter("part <> _fold")
    ranked = inside.withColumn("_rank", F.row_number().over(Window.partitionBy("_cell", "part").orderBy("_draw", key)) - 1)
    same = (F.col("_cell") == F.col("_in")) & (F.col("part") == F.col("_for")) & (F.col("_rank") == F.col("_turn"))
    return ranked.join(F.broadcast(found), same).select(*columns)
