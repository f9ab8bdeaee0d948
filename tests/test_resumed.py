"""Indicators and alerts that go on from state, against those of all points at once."""

import datetime as dt
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.plans import indicators
from shelfmark.schemas import PRICE_POINTS
from shelfmark.sinks.bucketed import BucketedTables
from shelfmark.sources import readers
from shelfmark.streaming import jobs, resumed

START = dt.datetime(2024, 3, 1)


def make_points():
    """Four series: one item under two names, bursts, a null name, repeated samples, quantities that come and go."""
    rng = np.random.default_rng(3)
    rows = []
    for item, name, n in ((1, "a", 120), (1, "b", 40), (2, None, 90), (3, "c", 3)):
        t = 2 * np.cumsum(rng.integers(1, 250, n)) + (name == "b")
        x = np.round(100 + np.cumsum(rng.normal(0, 4, n)), 2)
        for i in range(n):
            rows.append((item, name, float(x[i]), int(5 if (i // 25) % 2 else 50), START + dt.timedelta(seconds=int(t[i]))))
    return [*rows, rows[10], rows[20], rows[130], rows[200]]


def key(row):
    return tuple("" if v is None else round(v, 6) if isinstance(v, float) else str(v) for v in row)


def test_batches_equal_the_whole(spark, tmp_path, monkeypatch):
    rows = make_points()
    order = sorted(range(len(rows)), key=lambda i: rows[i][4])
    late = set(order[60:66]) | {order[150]}
    early = [rows[i] for i in order if i not in late]
    batches = [early[:90], early[90:170], early[170:], [rows[i] for i in sorted(late)]]
    schema = PRICE_POINTS
    store = resumed.open_store(spark, str(tmp_path / "store"), schema, buckets=3)
    read, real = [], BucketedTables.read
    monkeypatch.setattr(BucketedTables, "read", lambda self, table, buckets=None: read.append(table) or real(self, table, buckets))
    parts, withdrawn = [], 0
    for n, batch in enumerate(batches):
        read.clear()
        df = spark.createDataFrame(batch, schema)
        parts.append(resumed.advance(store, df, n, max_rows=40 if n == 1 else 1_000_000))
        # Stored points are read for late ones only.
        assert ("points" in read) == (n == 3)
        assert resumed.advance(store, df, n) is None
    everything = spark.createDataFrame(rows, schema)
    want = {key(r[:5]): key(r[5:]) for r in indicators.price_indicators(everything).select(*schema.names, "sma_7", "ema_14", "rsi_14", "price_changes").collect()}
    got = {}
    for part in parts:
        got |= {key(r[:5]): key(r[5:]) for r in part.select(*schema.names, "sma_7", "ema_14", "rsi_14", "price_changes").collect()}
    # Of repeated samples, either may be the first.
    times = [(r[0], r[4]) for r in rows]
    clear = {key(r) for r in rows if times.count((r[0], r[4])) == 1}
    assert set(got) == set(want) and len(clear) > 200
    for k in clear:
        assert np.allclose([float(v or -1) for v in got[k]], [float(v or -1) for v in want[k]], atol=1e-5), k
    columns = ["alert", *indicators.SERIES, "starts_at", "value"]
    found = sorted(key(r) for r in resumed.read_alerts(store).select(*columns).collect())
    assert found == sorted(key(r) for r in indicators.alerts(everything).select(*columns).collect()) and found
    log = store.read("alerts")
    withdrawn = log.filter(~F.col("raised")).count()
    assert log.count() >= len(found) + withdrawn
    state = store.read("state_indicators").groupBy("item_id").count().collect()
    assert all(r["count"] <= resumed.SNAPSHOTS for r in state)


def test_a_late_point_moves_an_alert(spark, tmp_path):
    """Stock is low from 10:00 on; a late sample says that it was full at 10:05."""
    store = resumed.open_store(spark, str(tmp_path), buckets=2)

    def sample(minute, quantity):
        return (1, "n", 100.0 + minute, quantity, dt.datetime(2024, 3, 1, 10, minute))

    def low():
        return [(r.starts_at.minute, r.fired_at.minute) for r in resumed.read_alerts(store).filter("alert = 'LowInventory'").collect()]

    schema = PRICE_POINTS
    resumed.advance(store, spark.createDataFrame([sample(0, 5), sample(4, 5)], schema), 0)
    assert low() == []
    resumed.advance(store, spark.createDataFrame([sample(m, 5) for m in (8, 12, 16, 20)], schema), 1)
    assert low() == [(0, 12)]
    resumed.advance(store, spark.createDataFrame([sample(5, 50)], schema), 2)
    assert low() == [(8, 20)]


def test_stream(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(inbox)

    def land(name, rows):
        with open(os.path.join(inbox, name), "w") as f:
            f.write("\n".join(json.dumps({"item_id": 1, "name": "n", "price": p, "quantity": 5, "timestamp": t}) for t, p in rows))
        points = jobs.parse_points(readers.read_message_files(spark, inbox))
        jobs.run_once(resumed.stream_resumed(points, str(tmp_path / "store"), out, str(tmp_path / "cp"), buckets=2))

    land("a.txt", [(f"2024-03-01T10:{m:02d}:00", 100.0 + m) for m in range(6)])
    land("b.txt", [(f"2024-03-01T10:{m:02d}:00", 100.0 + m) for m in range(6, 20)])
    gauges = {r.metric: r.value for r in spark.read.parquet(out).filter("batch_id = 1").collect()}
    assert gauges["product_price"] == 119.0 and gauges["price_sma"] == pytest.approx(116.0) and gauges["price_rsi"] == 100.0
    store = resumed.open_store(spark, str(tmp_path / "store"), buckets=2)
    assert [r.starts_at for r in resumed.read_alerts(store).filter("alert = 'LowInventory'").collect()] == [dt.datetime(2024, 3, 1, 10)]


def test_points_are_kept_once_per_kind(spark, tmp_path, monkeypatch):
    """Of frames as long as the batch, only the points and the two results are checkpointed, and those of late series once more."""
    rows = [(1 + i % 2, "n", 100.0 + i % 7, 5, START + dt.timedelta(seconds=60 * i + (i % 40 == 0))) for i in range(200)]
    early, late = [r for i, r in enumerate(rows) if i % 9], [r for i, r in enumerate(rows) if i % 9 == 0]
    store = resumed.open_store(spark, str(tmp_path), buckets=2)
    sizes, real = [], resumed.checkpointed

    def counted(df):
        kept = real(df)
        sizes.append(kept.count())
        return kept

    monkeypatch.setattr(resumed, "checkpointed", counted)
    for n, batch in enumerate((early, late)):
        sizes.clear()
        resumed.advance(store, spark.createDataFrame(batch, PRICE_POINTS), n)
        assert sum(size >= 170 for size in sizes) == (3 if n == 0 else 4)
    found = sorted(key(r[:6]) for r in resumed.read_alerts(store).select("alert", *indicators.SERIES, "starts_at", "value").collect())
    want = indicators.alerts(spark.createDataFrame(rows, PRICE_POINTS)).select("alert", *indicators.SERIES, "starts_at", "value")
    assert found == sorted(key(r) for r in want.collect()) and found
