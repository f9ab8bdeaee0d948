"""Medians by narrowing histograms against plain ones."""

from decimal import Decimal as D
from statistics import median

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.medians import median_of


def plain(rows):
    groups = {}
    for key, value in rows:
        if value is not None:
            groups.setdefault(key, []).append(value)
    return {k: float(median(v)) for k, v in groups.items()}


@pytest.mark.parametrize("cells", [50, 4096])
def test_medians(spark, cells):
    rows = [(i % 5 or None, (i * i * 7919) % 100_003 - 50_000) for i in range(1, 400)]
    rows += [(6, 3), (7, 1), (7, 4), (8, None), (9, -5), (9, -5), (9, 10), (9, 90_000)] + [(10, 7)] * 50
    df = spark.createDataFrame(rows, "k int, v bigint")
    got = {r["k"]: r["m"] for r in median_of(df, ["k"], "v", "m", cells).collect()}
    assert got == plain(rows)


def test_decimals_and_two_keys(spark):
    rows = [(("a", i % 3), D(i * 37 % 1000) / 100) for i in range(100)]
    df = spark.createDataFrame([(a, b, v) for (a, b), v in rows], "a string, b int, v decimal(12,2)")
    got = {(r["a"], r["b"]): r["m"] for r in median_of(df, ["a", "b"], "v", "m", 32).collect()}
    assert got == pytest.approx(plain(rows))


def test_empty_equal_and_refused(spark):
    df = spark.createDataFrame([(1, None)], "k int, v int")
    assert median_of(df, ["k"], "v", "m").collect() == []
    one = spark.createDataFrame([(1, 2**60)] * 3, "k int, v bigint")
    assert [tuple(r) for r in median_of(one, ["k"], "v", "m").collect()] == [(1, float(2**60))]
    with pytest.raises(TypeError):
        median_of(df.select("k", F.lit(1.5).alias("v")), ["k"], "v", "m")
    wide = spark.createDataFrame([(1, -2**62), (1, 2**62)], "k int, v bigint")
    with pytest.raises(ValueError):
        median_of(wide, ["k"], "v", "m")
