"""Many isolation forests at once: cross-validation folds and parameter grids.

The trees of all models are grown in one job, keyed by (model, tree): the drawn
positions of all of them are found in the same passes over the table, also
where a model leaves a fold out. All forests then walk a row in one narrow
pass, and a row of a fold is judged by the forest that never saw it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendwatch.functions import decisions
from spendwatch.functions.hashing import unit_hash
from spendwatch.operators.iforest import NODE_SCHEMA, SUB_SAMPLE, Forest, _tables, average_path, grow_tree, path_lengths, tree_columns
from spendwatch.operators.quantiles import exact_quantiles
from spendwatch.operators.sampling import rows_at_positions

#: Bound on trees of all models, whose nodes go to every task.
MOST_TREES = 10_000


@dataclass(frozen=True)
class Spec:
    """One model: its size, its random stream, and the fold it must not see."""

    trees: int
    sub_sample: int = SUB_SAMPLE
    max_features: float = 1.0
    bootstrap: bool = False
    seed: object = 42
    leave_out: int | None = None


def _drawn(matrix: DataFrame, model: int, spec: Spec, rows: int) -> DataFrame:
    """``model, part, tree, row_index``: the positions of one model's trees among the rows it may see."""
    used = min(spec.sub_sample, rows)
    per_tree = used if spec.bootstrap else 4 * spec.sub_sample
    slots = matrix.sparkSession.range(spec.trees * per_tree).select((F.col("id") / per_tree).cast("int").alias("tree"), (F.col("id") % per_tree).cast("int").alias("slot"))
    drawn = slots.withColumn("row_index", F.floor(unit_hash(f"{spec.seed}:draw", "tree", "slot") * rows))
    if not spec.bootstrap:
        turn = Window.partitionBy("tree").orderBy("turn", "row_index")
        candidates = drawn.groupBy("tree", "row_index").agg(F.min("slot").alias("turn"))
        drawn = candidates.withColumn("_turn", F.row_number().over(turn)).filter(F.col("_turn") <= used)
    part = -1 if spec.leave_out is None else spec.leave_out
    return drawn.select(F.lit(model).alias("model"), F.lit(part).alias("part"), "tree", "row_index")


def grow_all(matrix: DataFrame, key: str, features: Sequence[str], specs: Sequence[Spec], index_seed: object = 42, fold: str | None = None) -> tuple[DataFrame, list[int]]:
    """Node tables of all models, keyed ``model, tree``, and the sub-sample size of each model.

    ``fold`` names an integer column from 0 on that ``leave_out`` refers to.
    """
    if sum(s.trees for s in specs) > MOST_TREES:
        raise ValueError(f"more than {MOST_TREES} trees in all")
    own = F.col(fold) if fold else F.lit(-1)
    sizes = {r["f"]: r["n"] for r in matrix.groupBy(own.alias("f")).agg(F.count("*").alias("n")).collect()}  # one row for each fold
    rows = [sum(n for f, n in sizes.items() if s.leave_out is None or f != s.leave_out) for s in specs]
    names = list(features)

    drawn = _drawn(matrix, 0, specs[0], rows[0])
    for model in range(1, len(specs)):
        drawn = drawn.unionByName(_drawn(matrix, model, specs[model], rows[model]))
    slim = matrix.select(key, *([fold] if fold else []), *[F.col(f"`{n}`") for n in names])
    found = rows_at_positions(slim if fold else slim.withColumn("_all", F.lit(-2)), key, f"{index_seed}:index", drawn.select("part", "row_index"), fold=fold or "_all")
    dealt = found.join(F.broadcast(drawn), ["part", "row_index"])  # trees times sub-sample: a size fixed by the parameters

    def grow(block: pd.DataFrame) -> pd.DataFrame:
        model, tree = int(block["model"].iloc[0]), int(block["tree"].iloc[0])
        spec = specs[model]
        limit = math.ceil(math.log2(max(min(spec.sub_sample, rows[model]), 2)))
        x = block[names].to_numpy(dtype=np.float32).astype(np.float64)
        grown = grow_tree(x, tree, tree_columns(len(names), spec.max_features, tree, spec.seed), limit, spec.seed)
        out = pd.DataFrame(grown, columns=["tree", "node", "feature", "split", "size", "path"])
        out.insert(0, "model", model)
        return out

    tasks = min(sum(s.trees for s in specs), matrix.sparkSession.sparkContext.defaultParallelism)
    nodes = dealt.repartition(tasks, "model", "tree").groupBy("model", "tree").applyInPandas(grow, "model int, " + NODE_SCHEMA)
    return nodes, [min(s.sub_sample, n) for s, n in zip(specs, rows)]


def forests_of(nodes: DataFrame, features: Sequence[str], specs: Sequence[Spec], used: Sequence[int]) -> list[Forest]:
    """The grown trees as one forest per model, without an offset yet."""
    records: list[list[tuple]] = [[] for _ in specs]
    for row in nodes.collect():  # nodes of at most ``MOST_TREES`` trees
        records[row["model"]].append(tuple(row)[1:])
    return [Forest(tuple(features), tuple(r), s.trees, n, 0.0, 0.0) for r, s, n in zip(records, specs, used)]


def with_all_scores(matrix: DataFrame, forests: Sequence[Forest], name: str = "scores", only: str | None = None) -> DataFrame:
    """Adds the array of every forest's score; with ``only``, just the one of the forest that this column numbers."""
    shared = matrix.sparkSession.sparkContext.broadcast([(*_tables(f), average_path(f.sub_sample)) for f in forests])

    @F.pandas_udf("array<double>")
    def walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        held = shared.value
        for own, *columns in batches:
            x = np.column_stack([c.to_numpy(dtype=np.float32) for c in columns]).astype(np.float64)
            mine = own.to_numpy()
            if only is None:
                scores = np.column_stack([-np.power(2.0, -path_lengths(x, *h[:4]) / h[4]) for h in held])
            else:
                scores = np.zeros((len(x), 1))
                for k, h in enumerate(held):
                    there = np.flatnonzero(mine == k)
                    if len(there):
                        scores[there, 0] = -np.power(2.0, -path_lengths(x[there], *h[:4]) / h[4])
            yield pd.Series(list(scores))

    own = F.col(only) if only else F.lit(0)
    return matrix.withColumn(name, walk(own, *[F.col(f"`{n}`") for n in forests[0].features]))


def cross_validated(matrix: DataFrame, key: str, features: Sequence[str], k: int, contamination: float, fold: str = "fold", seed: object = 42, **size) -> DataFrame:
    """``matrix`` with ``score, decision, prediction`` of the forest that left the row's fold out.

    One forest per fold, grown together. Its offset is the contamination
    quantile of the scores of its own training rows.
    """
    specs = [Spec(leave_out=f, seed=f"{seed}:{f}", **size) for f in range(k)]
    nodes, used = grow_all(matrix, key, features, specs, seed, fold)
    forests = forests_of(nodes, features, specs, used)
    all_scores = with_all_scores(matrix.select(fold, *[F.col(f"`{n}`") for n in features]), forests)
    seen = all_scores.select(*[F.when(F.col(fold) != f, F.element_at("scores", f + 1)).alias(f"s{f}") for f in range(k)])
    cuts = {r["column_name"]: r["quantile"] for r in exact_quantiles(seen, [f"s{f}" for f in range(k)], [contamination]).collect()}
    offset = F.element_at(F.array(*[F.lit(cuts[f"s{f}"]) for f in range(k)]), F.col(fold) + 1)
    scored = with_all_scores(matrix, forests, "_own", fold).withColumn("score", F.element_at("_own", 1)).withColumn("decision", F.col("score") - offset)
    return scored.withColumn("prediction", decisions.label_from_decision(F.col("decision"))).drop("_own")
