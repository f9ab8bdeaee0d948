"""Price indicators, alerts and metric samples of the price series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.series import (
    MICROS, hold_step, indicator_step, indicators, latest_by, micros_of, order_of, window_step,
)
from shelfmark.functions.skew import MAX_ROWS, numbered, routed


def price_indicators(points: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Samples with SMA-7, EMA-14, RSI-14 and the running number of price changes."""
    names = {"sma": "sma_7", "ema": "ema_14", "rsi": "rsi_14", "changes": "price_changes"}
    return indicators(points, names, max_rows=max_rows)


@dataclass(frozen=True)
class Rule:
    """An alert: SQL condition on a sample, the value reported, and how long it must hold."""

    alert: str
    severity: str
    condition: str
    value: str
    hold: str


# Thresholds, hold times and severities of the four alerts.
RULES = (
    Rule("ProductPriceSpike", "warning", "pct_change_5m > 20", "pct_change_5m", "5 minutes"),
    Rule("LowInventory", "warning", "quantity < 10", "quantity", "10 minutes"),
    Rule("PriceVolatility", "warning", "changes_1h > 5", "changes_1h", "15 minutes"),
    Rule("TechnicalIndicatorAlert", "info", "rsi_14 > 70 OR rsi_14 < 30", "rsi_14", "30 minutes"),
)
SERIES = ["item_id", "name"]


def alert_steps(short: int, long: int, rules: Sequence[Rule], max_rows: int, resume: bool = False) -> list:
    """The windows, indicators and hold times that the rules look at; window lengths in microseconds."""
    order = [MICROS]
    return [
        window_step(short, ["pct_change", "rate"], SERIES, names={"pct_change": "pct_change_5m", "rate": "rate_5m"}, max_rows=max_rows),
        window_step(long, ["changes"], SERIES, names={"changes": "changes_1h"}, max_rows=max_rows),
        indicator_step(order, {"rsi": "rsi_14"}, SERIES, max_rows=max_rows, resume=resume),
        hold_step(order, {f"_s{i}": F.expr(r.condition) for i, r in enumerate(rules)}, SERIES, max_rows, resume),
    ]


def one_per_instant(rows: DataFrame, tie: Sequence[str], max_rows: int, heavy: bool) -> DataFrame:
    """The last sample of each series and instant (`MICROS`), within the shuffle by series; heavy keys are numbered."""
    if heavy:
        return numbered(latest_by(rows, [*SERIES, MICROS], tie), SERIES, [MICROS], max_rows)
    later = F.lead(MICROS).over(Window.partitionBy(*SERIES).orderBy(MICROS, *tie))
    return rows.withColumn("_later", later).filter(
        F.col("_later").isNull() | (F.col("_later") != F.col(MICROS))).drop("_later")


def alerts(points: DataFrame, rules: Sequence[Rule] = RULES, short: str = "5 minutes",
           long: str = "1 hour", max_rows: int = MAX_ROWS) -> DataFrame:
    """Alerts of raw samples: one sample per series and instant, indicators, windows, then rules.

    For keys that are not heavy all of it runs on one shuffle by series.
    """
    order = [MICROS]
    tie = order_of(points)[1:] or ["price"]
    steps = alert_steps(micros_of(points, short), micros_of(points, long), rules, max_rows)

    def plan(rows: DataFrame, heavy: bool) -> DataFrame:
        rows = rows.withColumn(MICROS, F.unix_micros("timestamp"))
        rows = one_per_instant(rows, tie, max_rows, heavy)
        for step in steps:
            rows = step(rows, heavy)
        return rows.drop(MICROS)

    held = routed(points, SERIES, order, max_rows, plan, number=False)
    return firing(held, rules, [f"_s{i}" for i in range(len(rules))])


def evaluate_alerts(samples: DataFrame, rules: Sequence[Rule] = RULES,
                    max_rows: int = MAX_ROWS) -> DataFrame:
    """Alerts of samples that already have the columns the rules name."""
    since = [f"_s{i}" for i in range(len(rules))]
    conditions = {s: F.expr(r.condition) for s, r in zip(since, rules)}
    order = order_of(samples)
    held = routed(samples, SERIES, order, max_rows, hold_step(order, conditions, SERIES, max_rows))
    return firing(held, rules, since)


def firing(held: DataFrame, rules: Sequence[Rule], since: Sequence[str], fired_at: str | None = None) -> DataFrame:
    """One row per unbroken stretch that lasted long enough.

    `starts_at` is the instant the condition became true, `value` the reading when it had held, and
    `rate_5m`, where the samples have it, the rate per second of that sample. `fired_at` names a column for
    the time of that sample.
    """
    def entry(rule: Rule, start: str):
        lasted = F.col("timestamp") >= F.col(start) + F.expr(f"interval {rule.hold}")
        return F.when(lasted, F.struct(
            F.lit(rule.alert).alias("alert"), F.lit(rule.severity).alias("severity"),
            F.col(start).alias("starts_at"), F.expr(rule.value).cast("double").alias("value")))

    entries = F.array_compact(F.array(*[entry(r, s) for r, s in zip(rules, since)]))
    beside = [c for c in ("rate_5m",) if c in held.columns]
    rows = held.select(*SERIES, "timestamp", *beside, F.inline(entries))
    return rows.groupBy("alert", "severity", *SERIES, "starts_at").agg(
        *[F.min_by(c, "timestamp").alias(c) for c in ("value", *beside)],
        *([F.min("timestamp").alias(fired_at)] if fired_at else []))


METRICS = ("product_price", "product_quantity", "price_sma", "price_ema", "price_rsi")


def metric_samples(points: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Long form of indicator rows: `metric`, `labels`, `value`, `ts`, one row per sample and metric.

    Metrics that are not asked for are not built. A gauge holds its last value, see `gauges`.
    """
    item = [F.lit("item_id"), F.col("item_id").cast("string")]
    named = F.create_map(*item, F.lit("name"), F.col("name"))

    def row(metric: str, labels, value: str):
        return F.struct(F.lit(metric).alias("metric"), labels.alias("labels"),
                        F.col(value).cast("double").alias("value"))

    def period(p: str):
        return F.create_map(*item, F.lit("period"), F.lit(p))

    extra = [c for c in ("event_id",) if c in points.columns]
    sources = {
        "product_price": (named, "price"), "product_quantity": (named, "quantity"),
        "price_sma": (period("7d"), "sma_7"), "price_ema": (period("14d"), "ema_14"),
        "price_rsi": (F.create_map(*item), "rsi_14"),
    }
    return points.select(
        F.inline(F.array(*[row(m, *sources[m]) for m in metrics])),
        F.col("timestamp").alias("ts"), *extra,
    )


def gauges(samples: DataFrame) -> DataFrame:
    """Last value of each metric and label set."""
    order = [c for c in ("ts", "event_id") if c in samples.columns]
    # Maps cannot be grouped by; their sorted entries can.
    keyed = samples.withColumn("_series", F.array_sort(F.map_entries("labels")))
    last = keyed.groupBy("metric", "_series").agg(
        F.max_by("value", F.struct(*order)).alias("value"), F.max("ts").alias("ts"))
    return last.select("metric", F.map_from_entries("_series").alias("labels"), "value", "ts")


def panel(samples: DataFrame, metric: str, period: str | None = None) -> DataFrame:
    """Samples of one metric, optionally of one `period` label."""
    chosen = samples.filter(F.col("metric") == metric)
    return chosen if period is None else chosen.filter(F.col("labels")["period"] == period)
