"""Standard scaling with population deviation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from spendwatch.functions.sqltext import ident, number, text


@dataclass(frozen=True)
class Scaler:
    """Fitted mean and deviation per feature, in feature order."""

    names: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]


def scaler_table(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per feature from a single aggregation; a constant column gets 1."""
    value = [f"cast({ident(n)} as double)" for n in names]
    parts = [f"{f}({v}) AS {f}_{i}" for i, v in enumerate(value) for f in ("avg", "stddev_pop")]
    items = ", ".join(
        f"{i}, {text(n)}, avg_{i}, if(stddev_pop_{i} = 0, cast(1 as double), stddev_pop_{i})"
        for i, n in enumerate(names)
    )
    return df.selectExpr(*parts).selectExpr(f"stack({len(names)}, {items}) AS (position, feature, mean, deviation)")


def fit_scaler(df: DataFrame, names: Sequence[str]) -> Scaler:
    rows = sorted(scaler_table(df, names).collect(), key=lambda r: r["position"])
    return Scaler(
        tuple(r["feature"] for r in rows),
        tuple(r["mean"] if r["mean"] is not None else 0.0 for r in rows),
        tuple(r["deviation"] if r["deviation"] is not None else 1.0 for r in rows),
    )


def apply_scaler(df: DataFrame, scaler: Scaler | None, keep: Iterable[str] = ()) -> DataFrame:
    """``(x - mean) / deviation`` as floats; without a scaler, the input as is."""
    if scaler is None:
        return df
    scaled = [
        f"cast((cast({ident(n)} as double) - {number(m)}) / {number(d)} as float) AS {ident(n)}"
        for n, m, d in zip(scaler.names, scaler.means, scaler.deviations, strict=True)
    ]
    return df.selectExpr(*[ident(c) for c in keep], *scaled)
