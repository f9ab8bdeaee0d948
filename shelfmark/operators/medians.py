"""Exact medians of many groups at once, by narrowing histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.skew import attach

#: Cells of one histogram, and so the most rows of a window (some 10 MB).
CELLS = 1 << 18


def _whole(df: DataFrame, value: str) -> tuple[Column, int]:
    """The value as a whole number of its last digit, and how many of them make 1."""
    kind = df.schema[value].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(value).cast("bigint"), 1
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (F.col(value) * F.lit(10 ** kind.scale)).cast("bigint"), 10 ** kind.scale
    raise TypeError("medians are of whole numbers or decimals of up to 18 digits")


def _cell(width: int) -> Column:
    return F.col("_v") if width == 1 else F.call_function("div", F.col("_v"), F.lit(width))


def median_of(df: DataFrame, keys: Sequence[str], value: str, alias: str, cells: int = CELLS) -> DataFrame:
    """Exact median of each group as a double; the mean of the middle two for an even count.

    The range of all values is laid out in nested grids of `cells` cells. Every level counts the cells of
    the chosen cell of each group, and running counts choose the one below it that holds the middle row,
    until a cell is one value. Rows meet as counts of distinct values, and no window has more than `cells`
    rows, however many rows or values a group has. Levels follow from the range (one for up to
    `cells` values, two for up to its square); one narrow job reads it.

    NULL values do not count, a group without others is left out; NULL keys form groups of their own.
    """
    keys = list(keys)
    number, scale = _whole(df, value)
    rows = df.select(*keys, number.alias("_v")).filter(F.col("_v").isNotNull())
    low, high = rows.agg(F.min("_v"), F.max("_v")).first()
    low, span = (0, 1) if low is None else (low, high - low + 1)
    if span >= 1 << 62:
        raise ValueError("the values span more than 2**62 units")
    widths = [1]
    while widths[0] * cells < span:
        widths.insert(0, widths[0] * cells)
    # Exact: the difference fits, as the span does.
    weighted = rows.groupBy(*keys, (F.col("_v") - F.lit(low)).alias("_v")).agg(F.count("*").alias("_w"))

    def counted(df: DataFrame, *also: str, width: int) -> DataFrame:
        """Running counts over the cells of each group; `also` has one value in a group's cell above."""
        groups = [*keys, *also]
        if width > 1:
            df = df.groupBy(*groups, _cell(width).alias("_v")).agg(F.sum("_w").alias("_w"))
        group = Window.partitionBy(*groups)
        return df.withColumns({
            "_upto": F.sum("_w").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)),
            "_all": F.sum("_w").over(group)})

    def chosen(df: DataFrame) -> DataFrame:
        """Cells that hold a middle row, with its rank inside: `_low` and `_high`, one of them NULL at times."""
        def inside(rank: str) -> Column:
            before = F.col("_upto") - F.col("_w")
            return F.when((F.col(rank) > before) & (F.col(rank) <= F.col("_upto")), F.col(rank) - before)

        return df.select(*keys, "_v", inside("_low").alias("_low"), inside("_high").alias("_high")).filter(
            F.col("_low").isNotNull() | F.col("_high").isNotNull())

    def div2(c: Column) -> Column:
        return F.call_function("div", c, F.lit(2))

    # A level uses the one above once, so the plan grows by one join a level.
    middle = {"_low": div2(F.col("_all") + 1), "_high": div2(F.col("_all")) + 1}
    wanted = chosen(counted(weighted, width=widths[0]).withColumns(middle))
    for above, width in zip(widths, widths[1:]):
        below = attach(weighted.withColumn("_up", _cell(above)), wanted.withColumnRenamed("_v", "_up"),
                       [*keys, "_up"], ["_low", "_high"], "inner", bounded=False)
        wanted = chosen(counted(below, "_up", "_low", "_high", width=width))
    middle_two = F.max(F.when(F.col("_low").isNotNull(), F.col("_v"))) + F.max(
        F.when(F.col("_high").isNotNull(), F.col("_v")))
    both = middle_two.cast("decimal(38,0)") / 2 + F.lit(low)
    return wanted.groupBy(*keys).agg((both / scale).cast("double").alias(alias))
