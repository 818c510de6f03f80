"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) as Spark jobs.

Every tree sees at most ``sub_sample`` rows, so the rows drawn for all trees
are a fixed number whatever the table size. Fitting is: counting passes that
find the drawn rows' places in hash order, one filter pass that keeps those
rows, and one grouped task per tree. Scoring ships the finished trees, whose size is bounded
the same way, to Arrow-batched tasks over the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendwatch.functions.hashing import unit_draw, unit_hash
from spendwatch.operators.quantiles import exact_quantiles
from spendwatch.operators.sampling import rows_at_positions
from spendwatch.session import cut_lineage

# Parameters of the two forests in use.
PRODUCTION_FOREST = dict(trees=150, max_features=0.8, bootstrap=True, contamination=0.1, seed=42)
EXPLORATION_FOREST = dict(trees=100, max_features=1.0, bootstrap=False, contamination=0.001, seed=42)
SUB_SAMPLE = 256

MAX_SUB_SAMPLE = 65_536
CACHE_ROWS = 4_096
EULER = 0.5772156649015329
NODE_SCHEMA = "tree int, node int, feature int, split double, size int, path double"
PATH_DECIMALS = 9


def average_path(n: int) -> float:
    """Expected path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


@dataclass(frozen=True)
class Forest:
    """A fitted forest: node records, and the score below which a row is anomalous."""

    features: tuple[str, ...]
    nodes: tuple[tuple[int, int, int, float, int, float], ...]
    trees: int
    sub_sample: int
    offset: float
    contamination: float


def tree_columns(features: int, max_features: float, tree: int, seed: object) -> list[int]:
    """The columns one tree may split on, a truncated share drawn by hash."""
    take = max(1, int(max_features * features))
    order = sorted(range(features), key=lambda c: unit_draw(f"{seed}:column", tree, c))
    return sorted(order[:take])


def deal_rows(
    matrix: DataFrame, key: str, rows: int, trees: int, used: int, sub_sample: int, bootstrap: bool, seed: object
) -> DataFrame:
    """The rows each tree learns from: table columns plus ``tree``.

    With ``bootstrap`` each of a tree's ``used`` slots draws a row position of
    its own. Without it a tree keeps the first ``used`` distinct positions
    among ``4 * sub_sample`` draws. One rule for tables of every size; the rows
    come straight from the table.
    """
    spark = matrix.sparkSession
    per_tree = used if bootstrap else 4 * sub_sample
    slots = spark.range(trees * per_tree).select(
        (F.col("id") / per_tree).cast("int").alias("tree"), (F.col("id") % per_tree).cast("int").alias("slot")
    )
    drawn = slots.withColumn("row_index", F.floor(unit_hash(f"{seed}:draw", "tree", "slot") * rows))
    if bootstrap:
        drawn = drawn.select("tree", "row_index")
    else:
        turn = Window.partitionBy("tree").orderBy("turn", "row_index")
        candidates = drawn.groupBy("tree", "row_index").agg(F.min("slot").alias("turn"))
        drawn = candidates.withColumn("_turn", F.row_number().over(turn)).filter(F.col("_turn") <= used).select("tree", "row_index")
    found = rows_at_positions(matrix, key, f"{seed}:index", drawn.select("row_index"))
    # trees * sub_sample rows of two integers: a size fixed by the parameters.
    return found.join(F.broadcast(drawn), "row_index")


def grow_tree(x: np.ndarray, tree: int, columns: Sequence[int], depth_limit: int, seed: object) -> list[tuple]:
    """Grow one tree over its bounded row block; nodes are numbered as a heap."""
    out: list[tuple] = []
    pending = [(1, np.arange(len(x)))]
    while pending:
        node, rows = pending.pop()
        depth = node.bit_length() - 1
        block = x[rows]
        varying: list[int] = []
        if len(rows) > 1 and depth < depth_limit:
            low, high = block.min(axis=0), block.max(axis=0)
            varying = [c for c in columns if low[c] < high[c]]
        if not varying:
            out.append((tree, node, -1, 0.0, len(rows), depth + average_path(len(rows))))
            continue
        feature = varying[int(unit_draw(f"{seed}:feature", tree, node) * len(varying))]
        share = unit_draw(f"{seed}:split", tree, node)
        split = float(low[feature] + share * (high[feature] - low[feature]))
        if split >= high[feature]:
            split = float(low[feature])
        left = block[:, feature] <= split
        out.append((tree, node, feature, split, len(rows), 0.0))
        pending += [(2 * node, rows[left]), (2 * node + 1, rows[~left])]
    return out


def fit_nodes(
    matrix: DataFrame,
    key: str,
    features: Sequence[str],
    trees: int,
    max_features: float = 1.0,
    bootstrap: bool = False,
    sub_sample: int = SUB_SAMPLE,
    seed: object = 42,
) -> tuple[DataFrame, int]:
    """Node table of a forest and the sub-sample size actually used."""
    if not 2 <= sub_sample <= MAX_SUB_SAMPLE:
        raise ValueError(f"sub_sample must lie between 2 and {MAX_SUB_SAMPLE}")
    rows = matrix.count()
    used = min(sub_sample, rows)
    depth_limit = math.ceil(math.log2(max(used, 2)))
    names = list(features)

    def grow(block: pd.DataFrame) -> pd.DataFrame:
        tree = int(block["tree"].iloc[0])
        x = block[names].to_numpy(dtype=np.float32).astype(np.float64)
        columns = tree_columns(len(names), max_features, tree, seed)
        grown = grow_tree(x, tree, columns, depth_limit, seed)
        return pd.DataFrame(grown, columns=["tree", "node", "feature", "split", "size", "path"])

    slim = matrix.select(key, *[F.col(f"`{n}`") for n in names])
    dealt = deal_rows(slim, key, rows, trees, used, sub_sample, bootstrap, seed)
    # Tree blocks are small, so an unpinned shuffle would be coalesced into one
    # task that grows every tree.
    tasks = min(trees, matrix.sparkSession.sparkContext.defaultParallelism)
    nodes = dealt.repartition(tasks, "tree").groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    return nodes, used


def _tables(forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Complete binary layouts, so that every row takes the same number of steps."""
    depth = max(node.bit_length() - 1 for _, node, *_ in forest.nodes)
    width = 1 << depth
    feature = np.zeros((forest.trees, 2 * width), dtype=np.int64)
    split = np.full((forest.trees, 2 * width), np.inf)
    path = np.zeros((forest.trees, width))
    for tree, node, column, at, _, length in forest.nodes:
        if column >= 0:
            feature[tree, node], split[tree, node] = column, at
        else:
            shift = depth - (node.bit_length() - 1)
            first = (node << shift) - width
            path[tree, first : first + (1 << shift)] = length
    return feature, split, path, depth


def path_lengths(x: np.ndarray, feature: np.ndarray, split: np.ndarray, path: np.ndarray, depth: int) -> np.ndarray:
    """Mean path length over the trees, for blocks of rows small enough to stay in cache."""
    total = np.zeros(len(x))
    width = 1 << depth
    for start in range(0, len(x), CACHE_ROWS):
        block = np.ascontiguousarray(x[start : start + CACHE_ROWS])
        flat, first = block.ravel(), np.arange(len(block)) * block.shape[1]
        sums = total[start : start + CACHE_ROWS]
        for t in range(len(feature)):
            node = np.ones(len(block), dtype=np.int64)
            for _ in range(depth):
                above = flat.take(first + feature[t].take(node)) > split[t].take(node)
                node = 2 * node + above
            sums += path[t].take(node - width)
    return np.round(total / len(feature), PATH_DECIMALS)


def path_length_udf(spark: SparkSession, forest: Forest):
    """Arrow-batched mean path length of the forest's feature columns."""
    shared = spark.sparkContext.broadcast(_tables(forest))

    @F.pandas_udf("double")
    def mean_path(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        feature, split, path, depth = shared.value
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=np.float32) for c in columns]).astype(np.float64)
            yield pd.Series(path_lengths(x, feature, split, path, depth))

    return mean_path


def path_length(spark: SparkSession, forest: Forest) -> Column:
    return path_length_udf(spark, forest)(*[F.col(f"`{n}`") for n in forest.features])


def score_from_path(path: Column, sub_sample: int) -> Column:
    """Score in [-1, 0): the closer to -1, the easier a row is to isolate."""
    return -F.pow(F.lit(2.0), -path / F.lit(average_path(sub_sample)))


def with_scores(matrix: DataFrame, forest: Forest) -> DataFrame:
    """Adds ``path_length``, ``score`` and ``decision``."""
    scored = matrix.withColumn("path_length", path_length(matrix.sparkSession, forest)).withColumn(
        "score", score_from_path(F.col("path_length"), forest.sub_sample)
    )
    return scored.withColumn("decision", F.col("score") - F.lit(forest.offset))


def fit_forest(
    matrix: DataFrame,
    key: str,
    features: Sequence[str],
    trees: int,
    contamination: float,
    max_features: float = 1.0,
    bootstrap: bool = False,
    sub_sample: int = SUB_SAMPLE,
    seed: object = 42,
) -> Forest:
    """Fit the trees, then set the offset at the contamination quantile of the training scores."""
    nodes, used = fit_nodes(matrix, key, features, trees, max_features, bootstrap, sub_sample, seed)
    records = tuple(tuple(r) for r in nodes.collect())
    raw = Forest(tuple(features), records, trees, used, 0.0, contamination)
    # written once: the quantile takes several passes, each of which would score all rows again
    scores = cut_lineage(with_scores(matrix, raw).select("score"))
    offset = exact_quantiles(scores, ["score"], [contamination]).first()["quantile"]
    return Forest(raw.features, raw.nodes, raw.trees, raw.sub_sample, offset, contamination)
