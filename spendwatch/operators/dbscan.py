"""DBSCAN on a grid, for two- or three-dimensional client profiles.

Cells are so small that any two points of one cell are within ``eps``. A cell
with ``min_pts`` rows is therefore all core without measuring a distance, and
its core points are one cluster. Distances are only measured for points of
sparse cells, and between neighbouring cells when their boxes leave it open
whether a pair within ``eps`` exists; open boxes are halved until they decide.
Copies of a point are one weighted point.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.sqltext import ident
from spendwatch.operators.components import connected_components
from spendwatch.operators.skew import spread_join
from spendwatch.session import cut_lineage

NOISE = -1
MEASURE_BELOW = 20_000_000
MAX_HALVINGS = 40


def _offsets(d: int) -> list[tuple[int, ...]]:
    """Cells that can hold a point within ``eps`` of a point of the central cell."""
    reach = math.ceil(math.sqrt(d))
    gap = lambda o: sum(max(abs(v) - 1, 0) ** 2 for v in o)
    return [o for o in itertools.product(range(-reach, reach + 1), repeat=d) if gap(o) <= d]


def _shifted(cell: Sequence[str], offset: Sequence[int]) -> Column:
    return F.struct(*[(F.col(c) + o).alias(f"n{i}") for i, (c, o) in enumerate(zip(cell, offset, strict=True))])


def _squared(left: Sequence[str], right: Sequence[str]) -> Column:
    return sum(F.pow(F.col(a) - F.col(b), 2) for a, b in zip(left, right, strict=True))


def dbscan(df: DataFrame, key: str, features: Sequence[str], eps: float, min_pts: int, measure_below: int = MEASURE_BELOW) -> DataFrame:
    """``(id, is_core, cluster)``; the cluster is its smallest core id, noise is -1.

    A border point near several clusters joins the one with the smallest id.
    """
    d = len(features)
    if not 1 <= d <= 3:
        raise ValueError("the grid is meant for one to three features")
    side = eps / math.sqrt(d)
    xs, cell = [f"x{i}" for i in range(d)], [f"c{i}" for i in range(d)]
    rows = df.selectExpr(f"{ident(key)} AS id", *[f"cast({ident(f)} as double) AS {x}" for f, x in zip(features, xs, strict=True)])
    points = rows.groupBy(*xs).agg(F.min("id").alias("pid"), F.count("*").alias("w"))
    points = points.withColumns({c: F.floor(F.col(x) / side) for c, x in zip(cell, xs, strict=True)})
    sizes = points.groupBy(*cell).agg(F.sum("w").alias("in_cell"))
    points = cut_lineage(spread_join(points, sizes, cell))

    dense = points.filter(F.col("in_cell") >= min_pts)
    sparse = points.filter(F.col("in_cell") < min_pts)
    around = sparse.withColumn("n", F.explode(F.array(*[_shifted(cell, o) for o in _offsets(d)]))).select(
        "pid", *[F.col(x).alias(f"q{x}") for x in xs], *[F.col(f"n.n{i}").alias(c) for i, c in enumerate(cell)]
    )
    qs = [f"q{x}" for x in xs]
    counted = (
        spread_join(points.select(*cell, *xs, "w"), around, cell)
        .filter(_squared(qs, xs) <= eps * eps)
        .groupBy("pid")
        .agg(F.sum("w").alias("near"))
    )
    sparse_core = sparse.join(counted, "pid").filter(F.col("near") >= min_pts).drop("near")
    core = cut_lineage(dense.select("pid", *xs, *cell).unionByName(sparse_core.select("pid", *xs, *cell)))

    core_cells = core.groupBy(*cell).agg(F.min("pid").alias("node"))
    edges = _linked_cells(core, core_cells, xs, cell, side, eps, measure_below)
    components = connected_components(core_cells.select("node"), edges)
    named = core_cells.join(components, "node").select(*cell, F.col("component").alias("cluster"))
    core_named = cut_lineage(spread_join(core, named, cell))

    # Border points lie in sparse cells only.
    border = (
        spread_join(core_named.select(*cell, *xs, "cluster"), around, cell)
        .filter(_squared(qs, xs) <= eps * eps)
        .groupBy("pid")
        .agg(F.min("cluster").alias("border_cluster"))
    )
    labelled = (
        points.select("pid", *xs)
        .join(core_named.select("pid", "cluster"), "pid", "left")
        .join(border, "pid", "left")
        .select(
            *xs,
            F.col("cluster").isNotNull().alias("is_core"),
            F.coalesce("cluster", "border_cluster", F.lit(NOISE)).alias("cluster"),
        )
    )
    return spread_join(rows, labelled, xs).select("id", "is_core", "cluster")


def _boxes(core: DataFrame, xs: Sequence[str], side: float, level: int) -> DataFrame:
    """Bounding boxes of the core points on the grid halved ``level`` times."""
    step = side / 2**level
    keyed = core.withColumns({f"g{i}": F.floor(F.col(x) / step) for i, x in enumerate(xs)})
    bounds = [agg(x).alias(f"{tag}{i}") for i, x in enumerate(xs) for tag, agg in (("lo", F.min), ("hi", F.max))]
    return keyed.groupBy(*[f"g{i}" for i in range(len(xs))]).agg(F.count("*").alias("size"), *bounds)


def _linked_cells(
    core: DataFrame, core_cells: DataFrame, xs: Sequence[str], cell: Sequence[str], side: float, eps: float, measure_below: int
) -> DataFrame:
    """Pairs ``(a, b)`` of core cells that hold core points within ``eps`` of each other."""
    d = len(xs)
    grid = [f"g{i}" for i in range(d)]
    half = [o for o in _offsets(d) if o > (0,) * d]
    named = core_cells.select("node", *[F.col(c).alias(g) for c, g in zip(cell, grid, strict=True)])
    tried = named.withColumn("n", F.explode(F.array(*[_shifted(grid, o) for o in half]))).select(
        F.col("node").alias("a"), *[F.col(g).alias(f"a_{g}") for g in grid], *[F.col(f"n.n{i}").alias(g) for i, g in enumerate(grid)]
    )
    open_ = tried.join(named, grid).select(
        "a", F.col("node").alias("b"), *[f"a_{g}" for g in grid], *[F.col(g).alias(f"b_{g}") for g in grid]
    )
    linked = None
    for level in range(MAX_HALVINGS):
        boxes = _boxes(core, xs, side, level)
        side_of = lambda s: boxes.select(*[F.col(c).alias(f"{s}_{c}") for c in boxes.columns])
        met = open_.join(side_of("a"), [f"a_{g}" for g in grid]).join(side_of("b"), [f"b_{g}" for g in grid])
        near, far = [], []
        for i in range(d):
            gap = F.greatest(F.col(f"a_lo{i}") - F.col(f"b_hi{i}"), F.col(f"b_lo{i}") - F.col(f"a_hi{i}"), F.lit(0.0))
            span = F.greatest(F.col(f"a_hi{i}") - F.col(f"b_lo{i}"), F.col(f"b_hi{i}") - F.col(f"a_lo{i}"))
            near.append(F.pow(gap, 2))
            far.append(F.pow(span, 2))
        verdict = cut_lineage(
            met.withColumn("near2", sum(near)).withColumn("far2", sum(far)).filter(F.col("near2") <= eps * eps)
        )
        sure = verdict.filter(F.col("far2") <= eps * eps).select("a", "b").distinct()
        linked = sure if linked is None else linked.unionByName(sure)
        left = verdict.filter(F.col("far2") > eps * eps).join(sure, ["a", "b"], "left_anti")
        work = left.agg(F.sum(F.col("a_size").cast("double") * F.col("b_size"))).first()[0]
        if work is None:
            return linked
        if work <= measure_below:
            return linked.unionByName(_measured(left, core, xs, grid, side / 2**level, eps))
        children = F.array(*[F.array(*[F.lit(v) for v in o]) for o in itertools.product((0, 1), repeat=2 * d)])
        split = left.withColumn("child", F.explode(children))
        open_ = split.select(
            "a", "b",
            *[(F.col(f"a_{g}") * 2 + F.col("child")[i]).alias(f"a_{g}") for i, g in enumerate(grid)],
            *[(F.col(f"b_{g}") * 2 + F.col("child")[d + i]).alias(f"b_{g}") for i, g in enumerate(grid)],
        )
    raise RuntimeError("cells could not be told apart")


def _measured(left: DataFrame, core: DataFrame, xs: Sequence[str], grid: Sequence[str], step: float, eps: float) -> DataFrame:
    """Point distances for the few box pairs still open; their number was checked."""
    keyed = core.withColumns({g: F.floor(F.col(x) / step) for g, x in zip(grid, xs, strict=True)})
    side_of = lambda s: keyed.select(*[F.col(g).alias(f"{s}_{g}") for g in grid], *[F.col(x).alias(f"{s}_{x}") for x in xs])
    pairs = (
        left.select("a", "b", *[f"{s}_{g}" for s in "ab" for g in grid])
        .join(side_of("a"), [f"a_{g}" for g in grid])
        .join(side_of("b"), [f"b_{g}" for g in grid])
    )
    return pairs.filter(_squared([f"a_{x}" for x in xs], [f"b_{x}" for x in xs]) <= eps * eps).select("a", "b").distinct()
