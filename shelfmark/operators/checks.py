"""Table constraints as frames of offending keys; an empty frame means the constraint holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat or hold a NULL, with their number of rows."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | null)


def check_reference(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent, with their number of rows. NULL refers to nothing and is allowed."""
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return used.join(parent.select(key), key, "left_anti")


def check_lengths(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows with a text longer than its limit, and the columns concerned."""
    if not limits:
        return df.withColumn("too_long", F.array().cast("array<string>")).limit(0)
    found = F.array_compact(F.array(*[F.when(F.length(c) > n, F.lit(c)) for c, n in limits.items()]))
    return df.withColumn("too_long", found).filter(F.size("too_long") > 0)


def require(name: str, offending: DataFrame) -> None:
    """Raise with a few examples when a check found something."""
    sample = offending.limit(5).collect()
    if sample:
        raise ValueError(f"{name} violated, for example {[r.asDict() for r in sample]}")
