"""Price changes over event-time windows of a stream, with a watermark for late points.

Two window aggregations follow each other. The first takes the points of a series inside one slide (a minute,
say) to their first and last price and the changes between; the second puts the slides of a sliding window
together. So no state holds more than the points of one slide of a series, or one row per slide of a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SERIES = ["item_id", "name"]


def changes_by_window(points: DataFrame, window: str = "1 hour", slide: str = "1 minute", late: str = "10 minutes",
                      by: Sequence[str] = SERIES, value: str = "price") -> DataFrame:
    """(series, window_start, window_end, samples, changes): price changes between the samples of each window.

    Windows hold their start and not their end. Of samples of one instant the greatest counts. A window is
    final, and written by a stream in append mode, once the watermark, `late` behind the newest point, has
    passed its end; points behind the watermark are dropped. Over a stored table every window is given.
    """
    rows = points.withWatermark("timestamp", late)
    slides = rows.groupBy(F.window("timestamp", slide).alias("slide"), *by).agg(
        F.array_sort(F.collect_list(F.struct(F.col("timestamp").alias("t"), F.col(value).alias("x")))).alias("_all"))
    # One sample per instant: the last of each in order.
    once = F.filter("_all", lambda p, i: (i == F.size("_all") - 1) | (F.get("_all", i + 1)["t"] != p["t"]))
    slides = slides.withColumn("_all", once)
    inner = F.aggregate(F.sequence(F.lit(1), F.size("_all")), F.lit(0).cast("bigint"), lambda n, i: n + F.when(
        F.get("_all", i)["x"] != F.get("_all", i - 1)["x"], 1).otherwise(0))
    slides = slides.select(*by, "slide", F.struct(
        F.element_at("_all", 1)["t"].alias("t"), F.element_at("_all", 1)["x"].alias("first"), F.element_at("_all", -1)["x"].alias("last"),
        F.size("_all").alias("n"), inner.alias("changes")).alias("part"))
    whole = slides.groupBy(F.window(F.window_time("slide"), window, slide).alias("window"), *by).agg(
        F.array_sort(F.collect_list("part")).alias("_parts"))
    between = F.aggregate(F.sequence(F.lit(1), F.size("_parts")), F.lit(0).cast("bigint"), lambda n, i: n + F.when(
        F.get("_parts", i)["first"] != F.get("_parts", i - 1)["last"], 1).otherwise(0))
    inside = F.aggregate("_parts", F.lit(0).cast("bigint"), lambda n, p: n + p["changes"])
    samples = F.aggregate("_parts", F.lit(0).cast("bigint"), lambda n, p: n + p["n"])
    return whole.select(*by, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                        samples.alias("samples"), (inside + between).alias("changes"))


def volatile(windows: DataFrame, most: int = 5) -> DataFrame:
    """Windows with more changes than that."""
    return windows.filter(F.col("changes") > most)
