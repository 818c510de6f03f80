"""SQL that grows and walks the same forests, level by level, for checks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from spendwatch.operators.iforest import average_path
from spendwatch.plans.datasets import sql_draw


def _lengths(limit: int) -> str:
    values = ", ".join(f"({n}, {average_path(n)!r}::DOUBLE)" for n in range(limit + 1))
    return f"(VALUES {values}) v(n, c)"


def grow(
    name: str,
    source: str,
    features: Sequence[str],
    trees: int,
    max_features: float,
    bootstrap: bool,
    sub_sample: int,
    seed: object = 42,
    index_seed: object | None = None,
) -> str:
    """CTEs ending in ``{name}_nodes``, from ``source`` with ``row_key`` and the features."""
    d = len(features)
    take = max(1, int(max_features * d))
    limit = math.ceil(math.log2(sub_sample))
    xs = ", ".join(f'"{f}"::FLOAT::DOUBLE' for f in features)
    parts = [
        f"""{name}_idx AS MATERIALIZED (SELECT [{xs}] AS xs, count(*) OVER () AS total,
            row_number() OVER (ORDER BY {sql_draw(f"{seed if index_seed is None else index_seed}:index", "row_key")}, row_key) - 1 AS row_index FROM {source})"""
    ]
    slots = sub_sample if bootstrap else 4 * sub_sample
    tried = f"""(SELECT tree, slot, floor({sql_draw(f"{seed}:draw", "tree", "slot")} * (SELECT max(total) FROM {name}_idx)) AS row_index
            FROM range({trees}) a(tree), range({slots}) b(slot))"""
    if bootstrap:
        parts.append(f"{name}_drawn AS (SELECT tree, slot, row_index FROM {tried})")
    else:
        parts.append(
            f"""{name}_drawn AS (SELECT tree, slot, row_index FROM
            (SELECT tree, row_index, min(slot) AS slot FROM {tried} GROUP BY 1, 2)
            QUALIFY row_number() OVER (PARTITION BY tree ORDER BY slot) <= {sub_sample})"""
        )
    parts.append(
        f"""{name}_cols AS MATERIALIZED (SELECT tree, c FROM range({trees}) a(tree), range({d}) b(c)
            QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {sql_draw(f"{seed}:column", "tree", "c")}, c) <= {take})"""
    )
    parts.append(
        f"""{name}_dealt AS MATERIALIZED (SELECT tree, slot, xs FROM {name}_drawn JOIN {name}_idx USING (row_index))"""
    )
    parts.append(f"{name}_at0 AS MATERIALIZED (SELECT tree, slot, xs, 1 AS node FROM {name}_dealt)")
    for level in range(limit):
        parts.append(
            f"""{name}_sp{level} AS MATERIALIZED (SELECT tree, node, c,
              CASE WHEN lo + u * (hi - lo) >= hi THEN lo ELSE lo + u * (hi - lo) END AS split, n FROM
              (SELECT tree, node, c, min(xs[c + 1]) AS lo, max(xs[c + 1]) AS hi, count(*) AS n,
                      {sql_draw(f"{seed}:split", "tree", "node")} AS u
               FROM {name}_at{level} JOIN {name}_cols USING (tree) GROUP BY tree, node, c) WHERE lo < hi
              QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY c) - 1
                = floor({sql_draw(f"{seed}:feature", "tree", "node")} * count(*) OVER (PARTITION BY tree, node)))"""
        )
        parts.append(
            f"""{name}_at{level + 1} AS MATERIALIZED (SELECT tree, slot, xs,
              2 * node + CASE WHEN xs[c + 1] > split THEN 1 ELSE 0 END AS node
              FROM {name}_at{level} JOIN {name}_sp{level} USING (tree, node))"""
        )
    inner = [f"SELECT tree, node, c AS feature, split, n AS size, 0.0::DOUBLE AS path FROM {name}_sp{i}" for i in range(limit)]
    leaves = []
    for level in range(limit + 1):
        split_off = f"WHERE NOT EXISTS (SELECT 1 FROM {name}_sp{level} s WHERE s.tree = a.tree AND s.node = a.node)"
        leaves.append(
            f"SELECT tree, node, {level} AS depth, count(*) AS size FROM {name}_at{level} a "
            f"{split_off if level < limit else ''} GROUP BY 1, 2"
        )
    parts.append(
        f"""{name}_nodes AS MATERIALIZED ({" UNION ALL ".join(inner)} UNION ALL
            SELECT tree, node, -1, 0.0::DOUBLE, size, depth + c FROM ({" UNION ALL ".join(leaves)}) l
            JOIN {_lengths(sub_sample)} ON v.n = l.size)"""
    )
    return ",\n".join(parts)


def walk(name: str, source: str, features: Sequence[str], trees: int, sub_sample: int, contamination: float, train: str) -> str:
    """CTEs ending in ``{name}_scored``: path length, score, decision and label of every row.

    ``train`` is the condition on ``source`` that selects the rows setting the offset.
    """
    limit = math.ceil(math.log2(sub_sample))
    xs = ", ".join(f'"{f}"::FLOAT::DOUBLE' for f in features)
    parts = [
        f"""{name}_w0 AS MATERIALIZED (SELECT row_key, ({train}) AS fits, [{xs}] AS xs, tree, 1 AS node
            FROM {source}, range({trees}) t(tree))"""
    ]
    for level in range(limit):
        parts.append(
            f"""{name}_w{level + 1} AS MATERIALIZED (SELECT row_key, fits, xs, w.tree,
              CASE WHEN n.feature < 0 OR n.node IS NULL THEN w.node ELSE 2 * w.node + CASE WHEN xs[n.feature + 1] > n.split THEN 1 ELSE 0 END END AS node
              FROM {name}_w{level} w LEFT JOIN {name}_nodes n ON w.tree = n.tree AND w.node = n.node)"""
        )
    parts.append(
        f"""{name}_path AS MATERIALIZED (SELECT row_key, any_value(fits) AS fits, round(avg(n.path), 9) AS path_length
            FROM {name}_w{limit} w JOIN {name}_nodes n ON w.tree = n.tree AND w.node = n.node GROUP BY row_key)"""
    )
    parts.append(
        f"""{name}_raw AS MATERIALIZED (SELECT *, -power(2.0, -path_length / {average_path(sub_sample)!r}::DOUBLE) AS score
            FROM {name}_path)"""
    )
    parts.append(
        f"""{name}_scored AS MATERIALIZED (SELECT row_key, fits, path_length, score, score - q AS decision,
            CASE WHEN score - q < 0 THEN -1 ELSE 1 END AS prediction
            FROM {name}_raw, (SELECT quantile_cont(score, {contamination!r}::DOUBLE) AS q FROM {name}_raw WHERE fits))"""
    )
    return ",\n".join(parts)
