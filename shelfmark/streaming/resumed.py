"""Indicators and alerts that go on from stored state.

A series has snapshots: the position and time of a sample, the sums of its averages there, and since when each
rule holds. A batch reads the newest snapshot before its own first point, the last samples up to it (as far
back as the windows reach), and its points; whatever the series has had before is not read. A point that is
late, at or before the newest snapshot, makes its series go back to a snapshot before it and replay the
stored points from there on. Alerts that fired after that snapshot and do not fire again are withdrawn.

State, last samples, points and alerts are bucketed tables (`shelfmark.sinks.bucketed`) by item, which
change in one commit, labelled with the batch: a batch that is repeated after its commit changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.series import (
    CARRIED, MICROS, OFFSET, OLD, SEED, first_by, indicator_step, latest_by, micros_of, order_of,
)
from shelfmark.functions.skew import MAX_ROWS, POS, attach, routed
from shelfmark.plans.indicators import RULES, SERIES, Rule, alert_steps, firing, gauges, metric_samples, one_per_instant
from shelfmark.schemas import PRICE_POINTS
from shelfmark.session import checkpointed, together
from shelfmark.sinks.bucketed import BucketedTables, Change, Layout
from shelfmark.sources.readers import recent

#: Order of old samples that are equal in time and tie-break.
ALIKE = "_alike"
#: Marks of the last row of a series, and of the last samples that the next batch looks back on.
NEWEST, TAIL = "_newest", "_tail"
#: Snapshots kept of a series: how far back a late point finds one, before it replays the whole series.
SNAPSHOTS = 8
#: Samples that moving averages and differences look back on.
BACK = {"indicators": 7, "alerts": 2}
BY = {"indicators": ["item_id"], "alerts": SERIES}
NUMBERS = {"indicators": ["ema", "up", "down", "rsi"], "alerts": ["up", "down", "rsi"]}
NAMES = {"sma": "sma_7", "ema": "ema_14", "rsi": "rsi_14", "changes": "price_changes"}


def _schema(kind: str, rules: Sequence[Rule]) -> T.StructType:
    out = T.StructType([f for f in PRICE_POINTS.fields if f.name in BY[kind]])
    out = out.add("place", T.LongType()).add("at", T.TimestampType())
    for name in NUMBERS[kind]:
        out = out.add(name, T.DoubleType())
    if kind == "indicators":
        return out.add("changes", T.LongType())
    for i in range(len(rules)):
        out = out.add(f"_s{i}", T.TimestampType())
    return out


ALERTS = T.StructType([
    T.StructField("alert", T.StringType()), T.StructField("severity", T.StringType()), *[f for f in PRICE_POINTS.fields if f.name in SERIES],
    T.StructField("starts_at", T.TimestampType()), T.StructField("value", T.DoubleType()), T.StructField("rate_5m", T.DoubleType()),
    T.StructField("fired_at", T.TimestampType()), T.StructField("raised", T.BooleanType()), T.StructField("batch_id", T.LongType())])
ALERT_KEY = ["alert", *SERIES, "starts_at"]


def open_store(spark: SparkSession, path: str, points: T.StructType = PRICE_POINTS, rules: Sequence[Rule] = RULES,
               buckets: int = 256) -> BucketedTables:
    """The tables of a stream of points: `points`, `alerts`, and of each kind the state and the last samples."""
    key = ("item_id",)
    tables = {"points": Layout(points, key, buckets), "alerts": Layout(ALERTS, key, buckets)}
    for kind in BY:
        tables[f"state_{kind}"] = Layout(_schema(kind, rules), key, buckets)
        tables[f"last_{kind}"] = Layout(points, key, buckets)
    return BucketedTables(spark, path, tables)


def _on(left: DataFrame, right: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Null-safe join on the series; the result has the keys once."""
    names = {k: f"_k{i}" for i, k in enumerate(by)}
    same = F.lit(True)
    for k, name in names.items():
        same = same & F.col(k).eqNullSafe(F.col(name))
    joined = left.join(right.withColumnsRenamed(names), same, how)
    return joined.drop(*names.values())


def _semi(df: DataFrame, keys: DataFrame, by: Sequence[str], how: str = "left_semi") -> DataFrame:
    return _on(df, keys.select(*by), by, how)


class _Kind:
    """One kind of result over the series of `by`, for one batch."""

    def __init__(self, kind: str, store: BucketedTables, points: DataFrame, touched: list[int], back: int) -> None:
        self.kind, self.store, self.by, self.back, self.touched = kind, store, BY[kind], back, touched
        self.columns = points.columns
        self.tie = order_of(points)[1:] or ["price"]
        self.order = ["timestamp", *self.tie]
        first = points.groupBy(*self.by).agg(F.min("timestamp").alias("_first"))
        self.state = store.read(f"state_{kind}", touched)
        snapshot = F.struct(*[c for c in self.state.columns if c not in self.by])
        known = _on(first, self.state.select(*self.by, snapshot.alias("_old")), self.by, "left")
        at = F.col("_old.at")
        # One row per series of the batch: its first point, the newest snapshot before it, whether a newer one exists.
        self.series = checkpointed(known.groupBy(*self.by, "_first").agg(
            F.max_by("_old", F.when(at < F.col("_first"), at)).alias("_base"),
            F.coalesce(F.max(at) >= F.col("_first"), F.lit(False)).alias("_late")))
        self.base = self.series.filter(F.col("_base").isNotNull()).select(*self.by, "_base.*")
        self.late = self.series.filter("_late").select(*self.by, F.col("_base.at").alias("at"))
        self.is_late = not self.late.isEmpty()

    def rows(self, points: DataFrame) -> DataFrame:
        """What the batch works on: the last samples before, marked OLD, and the samples from there on.

        The last old row of a series has its snapshot, and the number of the series' first row here.
        """
        context, fresh = _semi(self.store.read(f"last_{self.kind}", self.touched), self.series.filter("NOT _late"), self.by), points
        if self.is_late:
            history = checkpointed(_on(self.store.read("points", self.store.touched("points", self.late)), self.late, self.by, "inner"))
            fresh = fresh.unionByName(history.filter(F.col("at").isNull() | (F.col("timestamp") > F.col("at"))).select(*self.columns))
            context = context.unionByName(self._last(history.filter(F.col("timestamp") <= F.col("at"))).select(*self.columns))
        # Old samples that are alike get an order, so that one of them is the last.
        context = checkpointed(context.withColumns({OLD: F.lit(True), ALIKE: F.monotonically_increasing_id()}))
        return checkpointed(self._seeded(context)).unionByName(
            fresh.withColumns({OLD: F.lit(False), ALIKE: F.lit(0).cast("bigint")}), allowMissingColumns=True)

    def _last(self, rows: DataFrame) -> DataFrame:
        """The last samples of each series up to its `at`: as many as averages need, and those a window reaches."""
        series = Window.partitionBy(*self.by)
        if self.kind == "indicators":
            rank = F.row_number().over(series.orderBy(*[F.col(c).desc() for c in self.order]))
            return rows.withColumn("_rank", rank).filter(F.col("_rank") <= BACK[self.kind])
        rank = F.dense_rank().over(series.orderBy(F.col("timestamp").desc()))
        some = rows.withColumn("_rank", rank).filter(F.col("_rank") <= BACK[self.kind]).drop("_rank")
        span = F.unix_micros("at") - F.unix_micros("timestamp") <= self.back
        return latest_by(some.filter(~span).unionByName(rows.filter(span)), [*self.by, "timestamp"], self.tie)

    def _seeded(self, context: DataFrame) -> DataFrame:
        place = F.struct(*self.order, ALIKE)
        old = context.groupBy(*self.by).agg(F.max(place).alias("_last"), F.count("*").alias("_n"))
        base = _on(self.base, old, self.by, "left")
        values = [c for c in base.columns if c not in (*self.by, "place", "at", "_last", "_n")]
        base = base.select(*self.by, "_last", (F.col("place") - F.col("_n") + 1).alias(OFFSET), F.struct(*values).alias("_sums"))
        seed = F.when(place == F.col("_last"), F.col("_sums"))
        return _on(context, base, self.by, "left").withColumn(SEED, seed).drop("_last", "_sums")

    def marked(self, rows: DataFrame, order: Sequence[str], heavy: bool) -> DataFrame:
        """Rows with the number of their series' first row, and marks at what the next batch starts from.

        The marks are NEWEST, at the last row of a series, and TAIL, at its last samples (see `_last`). For light
        keys the windows that come after it use the same sort; heavy keys have been numbered.
        """
        of_all = {OFFSET: F.max(OFFSET), "_n": F.count("*"), "_end": F.max("timestamp")}
        if heavy:
            whole_series = rows.groupBy(*self.by).agg(*[f.alias(c) for c, f in of_all.items()])
            rows = attach(rows.drop(OFFSET), whole_series, self.by, list(of_all))
            after = F.col("_n") - 1 - F.col(POS)
        else:
            ordered = Window.partitionBy(*self.by).orderBy(*order)
            every = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            rows = rows.withColumns({"_rank": F.row_number().over(ordered), **{c: f.over(every) for c, f in of_all.items()}})
            after = F.col("_n") - F.col("_rank")
        tail = after < BACK[self.kind]
        if self.kind == "alerts":
            tail = tail | (F.unix_micros("_end") - F.unix_micros("timestamp") <= self.back)
        return rows.withColumns({TAIL: tail, NEWEST: after == 0}).drop("_n", "_end", "_rank")

    def changes(self, out: DataFrame, values: dict[str, Column]) -> list[Change]:
        """State and last samples of the touched buckets after the batch."""
        newest = out.filter(NEWEST).select(
            *self.by, F.col(f"{CARRIED}.place").alias("place"), F.col("timestamp").alias("at"), *[v.alias(k) for k, v in values.items()])
        # Snapshots that the batch goes back behind are dropped.
        valid = _on(self.state, self.series.select(*self.by, "_first"), self.by, "left").filter(
            F.col("_first").isNull() | (F.col("at") < F.col("_first")))
        kept = valid.select(*self.state.columns).unionByName(newest.select(*self.state.columns))
        rank = F.row_number().over(Window.partitionBy(*self.by).orderBy(F.col("at").desc()))
        kept = kept.withColumn("_rank", rank).filter(F.col("_rank") <= SNAPSHOTS).drop("_rank")
        last = _semi(self.store.read(f"last_{self.kind}", self.touched), self.series, self.by, "left_anti")
        return [Change(f"state_{self.kind}", kept, self.touched),
                Change(f"last_{self.kind}", last.unionByName(out.filter(TAIL).select(*self.columns)), self.touched)]


def advance(store: BucketedTables, points: DataFrame, batch_id: int, rules: Sequence[Rule] = RULES, short: str = "5 minutes",
            long: str = "1 hour", max_rows: int = MAX_ROWS) -> DataFrame | None:
    """Take a batch of points in; returns its samples with indicators, those replayed for late points included.

    None for a batch that is already in, or has no points. All tables change in one commit. Points go through
    one shuffle by series for each kind of result; the two kinds are worked out side by side.
    """
    store.refresh()
    if store.manifest.label is not None and batch_id <= store.manifest.label:
        return None
    points = checkpointed(points.filter(F.col("item_id").isNotNull() & F.col("timestamp").isNotNull()))
    touched = store.touched("points", points)
    if not touched:
        return None
    (fresh, changes), more = together(
        store.spark, lambda: _indicators(store, points, touched, max_rows),
        lambda: _alerts(store, points, touched, batch_id, rules, short, long, max_rows))
    store.commit([*changes, *more, Change("points", points)], batch_id)
    return fresh


def _indicators(store: BucketedTables, points: DataFrame, touched: list[int], max_rows: int) -> tuple[DataFrame, list[Change]]:
    """Indicators of all samples, by item, and what they change."""
    kind = _Kind("indicators", store, points, touched, 0)
    order = [*kind.order, ALIKE]
    step = indicator_step(order, NAMES, kind.by, max_rows=max_rows, resume=True)

    def plan(given: DataFrame, heavy: bool) -> DataFrame:
        return step(kind.marked(given, order, heavy), heavy)

    out = checkpointed(routed(kind.rows(points), kind.by, order, max_rows, plan).drop(SEED, OFFSET))
    values = {"ema": F.col("ema_14"), "up": F.col(f"{CARRIED}.up"), "down": F.col(f"{CARRIED}.down"), "rsi": F.col("rsi_14"), "changes": F.col("price_changes")}
    return out.filter(~F.col(OLD)).select(*points.columns, *NAMES.values()), kind.changes(out, values)


def _alerts(store: BucketedTables, points: DataFrame, touched: list[int], batch_id: int, rules: Sequence[Rule], short: str, long: str,
            max_rows: int) -> list[Change]:
    """What the alerts of one sample per series and instant change."""
    reach = micros_of(points, long)
    kind = _Kind("alerts", store, points, touched, max(reach, micros_of(points, short)))
    steps = alert_steps(micros_of(points, short), reach, rules, max_rows, resume=True)

    def plan(given: DataFrame, heavy: bool) -> DataFrame:
        given = one_per_instant(given.withColumn(MICROS, F.unix_micros("timestamp")), kind.tie, max_rows, heavy)
        given = kind.marked(given, [MICROS], heavy)
        for each in steps:
            given = each(given, heavy)
        return given.drop(MICROS)

    held = checkpointed(routed(kind.rows(points), SERIES, [MICROS], max_rows, plan, number=False).drop(SEED, OFFSET))
    since = [f"_s{i}" for i in range(len(rules))]
    changes = kind.changes(held, {"up": F.col(f"{CARRIED}.up"), "down": F.col(f"{CARRIED}.down"), "rsi": F.col("rsi_14"), **{s: F.col(s) for s in since}})
    found = firing(held.filter(~F.col(OLD)), rules, since, "fired_at")
    return [*changes, Change("alerts", _corrected(store, kind, found, rules, batch_id))]


def _corrected(store: BucketedTables, kind: _Kind, found: DataFrame, rules: Sequence[Rule], batch_id: int) -> DataFrame:
    """What the batch adds to the alerts: those that fire now, and withdrawals of those that no longer do."""
    # An alert that had fired when the snapshot was taken is known.
    known = F.array(*[
        F.struct(F.lit(r.alert).alias("alert"), F.when(F.col("at") >= F.col(f"_s{i}") + F.expr(f"interval {r.hold}"), F.col(f"_s{i}")).alias("starts_at"))
        for i, r in enumerate(rules)])
    before = kind.base.select(*SERIES, F.inline(known)).filter(F.col("starts_at").isNotNull())
    found = checkpointed(_semi(found, before, ALERT_KEY, "left_anti").withColumns({"raised": F.lit(True), "batch_id": F.lit(batch_id).cast("bigint")}))
    found = found.select(*[f.name for f in ALERTS.fields])
    if not kind.is_late:
        return found
    raised = _semi(_standing(store.read("alerts", store.touched("alerts", kind.late))), kind.late, SERIES)
    raised = _on(raised, kind.base.select(*SERIES, "at"), SERIES, "left").filter(F.col("at").isNull() | (F.col("fired_at") > F.col("at"))).drop("at")
    same = [*ALERT_KEY, "value", "rate_5m", "fired_at"]
    gone = _semi(raised, found, ALERT_KEY, "left_anti").withColumns({"raised": F.lit(False), "batch_id": F.lit(batch_id).cast("bigint")})
    return _semi(found, raised, same, "left_anti").unionByName(gone.select(*found.columns))


def _standing(alerts: DataFrame) -> DataFrame:
    """Alerts that are raised and not withdrawn, as last reported."""
    return first_by(alerts, ALERT_KEY, [F.col("batch_id").desc()]).filter("raised")


def read_alerts(store: BucketedTables) -> DataFrame:
    """Alerts as they stand after the last batch."""
    return _standing(store.read("alerts")).drop("raised", "batch_id")


def stream_resumed(points: DataFrame, path: str, out: str, checkpoint: str, hours: int = 1, rules: Sequence[Rule] = RULES,
                   buckets: int = 256, once: bool = True) -> StreamingQuery:
    """Gauges and alerts after each batch of price points, from stored state; `read_alerts` reads the alerts.

    Gauges are the last values of the series that a batch has points of, unless older than `hours` before their
    newest sample. They are written after the state; a batch that broke in between writes none when repeated.
    """
    def refresh(batch: DataFrame, batch_id: int) -> None:
        store = open_store(batch.sparkSession, path, batch.schema, rules, buckets)
        fresh = advance(store, batch, batch_id, rules)
        if fresh is not None:
            newest = fresh.agg(F.max("timestamp")).first()[0]
            gauges(metric_samples(recent(fresh, str(newest), hours))).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = points.writeStream.outputMode("append").foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
