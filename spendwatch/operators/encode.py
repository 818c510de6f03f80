"""Category encoding, schema alignment and the float matrix."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

from spendwatch.functions.sqltext import ident, text

MAX_CATEGORIES = 1_000


def fit_categories(
    df: DataFrame, columns: Iterable[str], limit: int = MAX_CATEGORIES
) -> dict[str, list[str]]:
    """Sorted distinct values per column, from one pass over the table.

    Each value becomes a column of the plan, so the result is small by nature;
    a column with more than ``limit`` values is refused, not truncated.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    pairs = ", ".join(f"{text(c)}, cast({ident(c)} as string)" for c in present)
    listed = df.selectExpr(f"stack({len(present)}, {pairs}) AS (name, value)")
    distinct = listed.filter("value IS NOT NULL").distinct()
    rows = distinct.limit(limit * len(present) + 1).collect()
    values = {c: sorted(r["value"] for r in rows if r["name"] == c) for c in present}
    for name, found in values.items():
        if len(found) > limit:
            raise ValueError(f"column {name} has more than {limit} categories")
    return values


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]], drop_first: bool = True) -> DataFrame:
    """Indicator columns ``column_value`` after the columns left alone.

    NULL and unseen values are 0 everywhere; ``drop_first`` makes the first
    value the baseline.
    """
    kept = [ident(c) for c in df.columns if c not in categories]
    made = [
        f"cast(coalesce({ident(name)} = {text(value)}, false) as tinyint) AS {ident(f'{name}_{value}')}"
        for name, values in categories.items()
        for value in (values[1:] if drop_first else values)
    ]
    return df.selectExpr(*kept, *made)


def as_float(name: str) -> str:
    """NULL to 0, booleans to 0/1, everything to 32-bit float."""
    return f"coalesce(cast({ident(name)} as float), cast(0 as float)) AS {ident(name)}"


def to_matrix(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """All columns but ``keep`` as 32-bit floats without NULLs."""
    keep = set(keep)
    return df.selectExpr(*[ident(c) if c in keep else as_float(c) for c in df.columns])


def align(df: DataFrame, names: Sequence[str], keep: Iterable[str] = ()) -> DataFrame:
    """Exactly ``names`` in order as floats: absent ones 0, others dropped."""
    present = set(df.columns)
    made = [as_float(n) if n in present else f"cast(0 as float) AS {ident(n)}" for n in names]
    return df.selectExpr(*[ident(c) for c in keep], *made)


def column_ranges(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Minimum and maximum of many columns in one pass, one row per column."""
    columns = list(columns)
    parts = [
        f"cast({kind}({ident(c)}) as double) AS {kind}_{i}" for i, c in enumerate(columns) for kind in ("min", "max")
    ]
    items = ", ".join(f"{text(c)}, min_{i}, max_{i}" for i, c in enumerate(columns))
    return df.selectExpr(*parts).selectExpr(f"stack({len(columns)}, {items}) AS (column_name, min_value, max_value)")


# Bounds strictly inside which a 64-bit column is narrowed.
INT_BELOW = 2147483647
INT_ABOVE = -2147483648


def downcast(df: DataFrame) -> DataFrame:
    """Doubles to floats; 64-bit integers to 32 bits where the range allows."""
    longs = [name for name, kind in df.dtypes if kind == "bigint"]
    narrow: set[str] = set()
    if longs:
        for row in column_ranges(df, longs).collect():
            low, high = row["min_value"], row["max_value"]
            if low is not None and high < INT_BELOW and low > INT_ABOVE:
                narrow.add(row["column_name"])
    casts = {
        name: "int" if name in narrow else "float"
        for name, kind in df.dtypes
        if name in narrow or kind == "double"
    }
    return df.selectExpr(
        *[f"cast({ident(c)} as {casts[c]}) AS {ident(c)}" if c in casts else ident(c) for c in df.columns]
    )
