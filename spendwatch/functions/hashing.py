"""Randomness that depends on row keys only, never on partitioning.

A draw is the leading 52 bits of an MD5 digest scaled to [0, 1), so the same
seed and key give the same double in Spark, in a pandas task and in other SQL
engines. 52 bits fit a double exactly and keep ties rare at 10^11 rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13
SPAN = float(16**HEX_DIGITS)


def unit_hash(seed: object, *parts: Column | str) -> Column:
    """Uniform draw in [0, 1) for the key made of ``parts``."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    key = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns])
    digits = F.substring(F.md5(key), 1, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(SPAN)


def unit_draw(seed: object, *parts: object) -> float:
    """The same draw for plain values, for use inside a task."""
    key = ":".join(str(p) for p in (seed, *parts))
    return int(hashlib.md5(key.encode()).hexdigest()[:HEX_DIGITS], 16) / SPAN
