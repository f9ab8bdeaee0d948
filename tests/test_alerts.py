"""Alerts, metric samples and their equality on cut keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfmark.plans import indicators
from shelfmark.sources.readers import recent

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "item_id bigint, name string, price double, quantity int, timestamp timestamp, event_id bigint"


def series(item, prices, quantities, minutes=1):
    return [(item, f"i{item}", float(p), q, T0 + dt.timedelta(minutes=minutes * n), item * 10000 + n)
            for n, (p, q) in enumerate(zip(prices, quantities))]


def fired(df):
    return sorted((r.alert, r.item_id, (r.starts_at - T0).total_seconds() / 60, round(r.value, 3)) for r in df.collect())


def test_hold_times(spark):
    rows = series(1, [100] * 10, [5] * 10) + series(2, [100] * 11, [5] * 11)  # 9 and 10 minutes
    rows += series(3, [100] * 22, [5] * 10 + [50] + [5] * 11)  # broken by one sample
    rows += series(4, [100] * 11, [10] * 11) + series(5, [100] * 11, [None] * 11)
    out = indicators.alerts(spark.createDataFrame(rows, SCHEMA))
    assert fired(out) == [("LowInventory", 2, 0.0, 5.0), ("LowInventory", 3, 11.0, 5.0)]
    assert {(r.severity, r.name) for r in out.collect()} == {("warning", "i2"), ("warning", "i3")}


def test_spike_and_volatility(spark):
    rising = [100 * 1.1 ** n for n in range(12)]
    zigzag = [100 + n % 2 for n in range(40)]
    rows = series(1, rising, [50] * 12) + series(2, zigzag, [50] * 40)
    got = fired(indicators.alerts(spark.createDataFrame(rows, SCHEMA)))
    spike = [g for g in got if g[0] == "ProductPriceSpike"]
    rate = {r.alert: r.rate_5m for r in indicators.alerts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert rate["ProductPriceSpike"] == pytest.approx((100 * 1.1 ** 7 - 100 * 1.1 ** 3) / 240)
    assert spike == [("ProductPriceSpike", 1, 2.0, round((1.1 ** 4 - 1) * 100, 3))]
    assert [g for g in got if g[0] == "PriceVolatility"] == [("PriceVolatility", 2, 6.0, 21.0)]


def test_rsi_alert(spark):
    rows = series(1, range(1, 60), [50] * 59)
    got = fired(indicators.alerts(spark.createDataFrame(rows, SCHEMA)))
    assert ("TechnicalIndicatorAlert", 1, 14.0, 100.0) in got


@pytest.fixture(scope="module")
def busy(spark):
    """One item with many samples, several at one instant, and a small one."""
    n = spark.range(3000)
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 100.0
    big = n.select(F.lit(1).cast("bigint").alias("item_id"), F.lit("big").alias("name"), (100 + noise).alias("price"),
                   F.pmod(F.xxhash64("id", F.lit(1)), F.lit(14)).cast("int").alias("quantity"),
                   (F.timestamp_seconds(F.floor(F.col("id") / 3) * 40)).alias("timestamp"), F.col("id").alias("event_id"))
    small = n.filter("id < 80").select(
        F.lit(2).cast("bigint").alias("item_id"), F.lit("small").alias("name"), (50 + noise).alias("price"),
        F.lit(3).alias("quantity"), F.timestamp_seconds(F.col("id") * 60).alias("timestamp"), F.col("id").alias("event_id"))
    return big.unionByName(small)


RULES = (
    indicators.Rule("Spike", "warning", "pct_change_5m > 1", "pct_change_5m", "1 minutes"),
    indicators.Rule("Low", "warning", "quantity < 10", "quantity", "2 minutes"),
    indicators.Rule("Moves", "warning", "changes_1h > 80", "changes_1h", "5 minutes"),
    indicators.Rule("Rsi", "info", "rsi_14 > 52 OR rsi_14 < 48", "rsi_14", "1 minutes"),
)


def test_cut_key_gives_the_same_alerts(busy):
    light = fired(indicators.alerts(busy, RULES))
    assert {a[0] for a in light} == {"Spike", "Low", "Moves", "Rsi"} and len(light) > 50
    assert fired(indicators.alerts(busy, RULES, max_rows=100)) == light


def test_given_columns(busy):
    samples = busy.withColumns({"pct_change_5m": F.lit(None).cast("double"), "changes_1h": F.lit(0), "rsi_14": F.lit(90.0)})
    light = fired(indicators.evaluate_alerts(samples))
    assert ("TechnicalIndicatorAlert", 2, (dt.datetime(1970, 1, 1) - T0).total_seconds() / 60, 90.0) in light
    assert fired(indicators.evaluate_alerts(samples, max_rows=100)) == light


def test_metrics(busy):
    ind = indicators.price_indicators(busy, max_rows=100)
    samples = indicators.metric_samples(ind)
    assert samples.count() == 5 * busy.count()
    gauges = {(r.metric, tuple(sorted(r.labels.items()))): r.value for r in indicators.gauges(samples).collect()}
    assert len(gauges) == 10
    last = busy.filter("item_id = 1").orderBy(F.desc("timestamp"), F.desc("event_id")).first()
    assert gauges["product_quantity", (("item_id", "1"), ("name", "big"))] == last.quantity
    assert indicators.panel(samples, "price_ema", "14d").count() == busy.count()
    assert indicators.panel(samples, "price_ema", "7d").count() == 0


def test_recent_is_open_on_the_left(spark):
    df = spark.createDataFrame(series(1, [1] * 121, [1] * 121), SCHEMA)
    assert recent(df, "2024-01-01 02:00:00").count() == 60
    assert recent(df, "2024-01-01 01:00:00").count() == 60
