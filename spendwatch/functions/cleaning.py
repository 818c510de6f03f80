"""Parsing of money and time text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The columns holding currency text.
MONEY_COLUMNS = ("amount", "per_capita_income", "yearly_income", "total_debt")

# Text accepted as a number once the currency sign is gone: decimal or
# scientific notation, or an infinity. Suffixes such as "1d" that a plain cast
# would accept, thousands separators and "nan" are not numbers here.
_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def parse_money(text: Column) -> Column:
    """Remove every ``$``, trim, and read a double; anything else is NULL."""
    bare = F.trim(F.replace(text.cast("string"), F.lit("$"), F.lit("")))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def format_money(value: Column) -> Column:
    """Currency text with two decimals, the inverse of :func:`parse_money`."""
    return F.concat(F.lit("$"), value.cast("decimal(18,2)").cast("string"))


def parse_timestamp(text: Column, strict: bool = True) -> Column:
    """Zone-free timestamp; bad text raises when strict, else becomes NULL."""
    return text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz")
