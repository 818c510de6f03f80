"""Quoting for generated expressions.

Wide projections are written as SQL text: one call to the JVM per projection
instead of several per column.
"""

from __future__ import annotations


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    """A double literal that reads back to the same value."""
    return f"cast('{float(value)!r}' as double)"
