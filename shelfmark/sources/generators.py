"""Relations made from values: label lists, number series, time spines, image variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def brands(spark: SparkSession, names: Sequence[str], alias: str = "brand") -> DataFrame:
    """Array literal as a relation."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias(alias))


def number_series(spark: SparkSession, n: int, alias: str = "n") -> DataFrame:
    """1 to n, generated where it is used."""
    return spark.range(1, n + 1).withColumnRenamed("id", alias)


def time_spine(spark: SparkSession, start: str, end: str, step: str, alias: str = "stamp") -> DataFrame:
    """Stamps from start to end, both included."""
    return spark.range(1).select(spine(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"),
                                       step).alias(alias))


def spine(start: Column, end: Column, step: str) -> Column:
    return F.explode(F.sequence(start, end, F.expr(f"interval {step}")))


def image_variants(df: DataFrame, variants: Sequence[str], base: str = "image_url") -> DataFrame:
    """One row per variant of the base URL, in place of a union of as many scans."""
    urls = F.array(*[F.concat(F.col(base), F.lit(v)) for v in variants])
    return df.withColumn(base, F.explode(urls))
