"""Streaming jobs on landed files, run twice with one checkpoint."""

import datetime as dt
import json
import os

import pytest

from shelfmark.plans import indicators
from shelfmark.sinks import files
from shelfmark.sources import readers
from shelfmark.streaming import jobs
from shelfmark.streaming.flatten import flatten_stream


def message(item, price, minute=0, **extra):
    return json.dumps({"timestamp": f"2024-03-01T10:{minute:02d}:00", "data": {
        "id": str(item), "name": f"n{item}", "created_time": "2024-03-01T10:00:00", "primary_category": 1,
        "skus": [{"SkuId": 1, "price": price, "quantity": 2}], "images": ["u"], "attributes": {"brand": "b"}, **extra}})


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines))


def test_fan_out_survives_replay(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(inbox, "a.txt", [message(1, 1.0), message(2, 2.0), "broken"])
    sinks = [files.foreach_parquet(f"{out}/flat"), files.foreach_json(f"{out}/json")]

    def run():
        flat = flatten_stream(readers.read_message_files(spark, inbox))
        assert jobs.run_once(jobs.start_all(flat, sinks, f"{out}/cp"))

    run()
    land(inbox, "b.txt", [message(3, 3.0)])
    run()
    run()
    rows = spark.read.parquet(f"{out}/flat")
    assert sorted((r.item_id, r.batch_id) for r in rows.collect()) == [(1, 0), (2, 0), (3, 1)]
    assert "ingest_date" in rows.columns
    texts = [json.loads(r.value) for r in spark.read.text(f"{out}/json").collect()]
    assert sorted(t["item_id"] for t in texts) == [1, 2, 3] and all(t["updated_time"] is None for t in texts)
    # A replayed batch replaces its folder.
    again = spark.createDataFrame([(3, dt.datetime(2024, 3, 1))], "item_id bigint, processing_time timestamp")
    sinks[0](again, 1)
    assert spark.read.parquet(f"{out}/flat").count() == 3


def test_fallback_path(spark, tmp_path):
    blocker = tmp_path / "file"
    blocker.write_text("not a folder")
    df = spark.createDataFrame([(1, dt.datetime(2024, 3, 1))], "item_id bigint, processing_time timestamp")
    files.foreach_parquet(f"{blocker}/x", str(tmp_path / "second"))(df, 4)
    assert spark.read.parquet(str(tmp_path / "second")).first().batch_id == 4
    with pytest.raises(Exception):
        files.foreach_parquet(f"{blocker}/x")(df, 4)
    # The batch is replayed with the first root healthy: it is in one of them only.
    files.foreach_parquet(str(tmp_path / "first"), str(tmp_path / "second"))(df, 4)
    assert spark.read.parquet(str(tmp_path / "first")).count() == 1
    assert not os.path.exists(tmp_path / "second" / "batch_id=4")


def test_append_stream(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    for name, item in (("a.txt", 1), ("b.txt", 2)):
        land(inbox, name, [message(item, 1.0)])
        flat = flatten_stream(readers.read_message_files(spark, inbox))
        jobs.run_once(jobs.stream_to_parquet(flat, f"{out}/data", f"{out}/cp"))
    assert sorted(r.item_id for r in spark.read.parquet(f"{out}/data").collect()) == [1, 2]


def test_latest_state(spark, tmp_path):
    inbox, state = str(tmp_path / "in"), str(tmp_path / "state")

    def run():
        raw = readers.read_message_files(spark, inbox)
        flat = flatten_stream(raw, keep=("message_time",)).select("item_id", "price", "message_time")
        jobs.run_once(jobs.upsert_stream(flat, state, ["item_id"], ["message_time"], str(tmp_path / "cp"), buckets=4))
        return {r.item_id: float(r.price) for r in jobs.read_state(spark, state).collect()}

    land(inbox, "a.txt", [message(1, 5.0, 5), message(1, 3.0, 3), message(2, 1.0, 1), message(9, 9.0)])
    assert run() == {1: 5.0, 2: 1.0, 9: 9.0}
    land(inbox, "b.txt", [message(1, 4.0, 4), message(2, 2.0, 2)])  # the first one is late
    assert run() == {1: 5.0, 2: 2.0, 9: 9.0}
    assert run() == {1: 5.0, 2: 2.0, 9: 9.0}
    assert jobs.read_state(spark, state).count() == 3
    # A commit that broke before its manifest leaves the state as it was.
    land(inbox, "c.txt", [message(1, 7.0, 7)])
    real = jobs.json.dumps
    jobs.json.dumps = lambda *a, **k: 1 / 0
    try:
        with pytest.raises(Exception):
            run()
    finally:
        jobs.json.dumps = real
    assert {r.item_id: float(r.price) for r in jobs.read_state(spark, state).collect()} == {1: 5.0, 2: 2.0, 9: 9.0}
    assert run() == {1: 7.0, 2: 2.0, 9: 9.0}
    for n in range(4):
        land(inbox, f"d{n}.txt", [message(9, 10.0 + n, 10 + n)])
        assert run() == {1: 7.0, 2: 2.0, 9: 10.0 + n}


def test_bucket_count_is_part_of_the_state(spark, tmp_path):
    inbox, state = str(tmp_path / "in"), str(tmp_path / "state")

    def run(buckets, name):
        flat = flatten_stream(readers.read_message_files(spark, inbox), keep=("message_time",)).select("item_id", "price", "message_time")
        jobs.run_once(jobs.upsert_stream(flat, state, ["item_id"], ["message_time"], str(tmp_path / name), buckets=buckets))

    land(inbox, "a.txt", [message(n, 1.0) for n in range(20)])
    run(4, "one")
    with pytest.raises(Exception, match="4 buckets"):
        run(8, "two")
    assert jobs.read_state(spark, state).count() == 20


def test_metrics_and_alerts(spark, tmp_path):
    inbox, store, out = (str(tmp_path / n) for n in ("in", "store", "out"))

    def point(n, quantity):
        return json.dumps({"item_id": 1, "name": "n", "price": 100.0 + n, "quantity": quantity,
                           "timestamp": f"2024-03-01T10:{n:02d}:00"})

    def run():
        points = jobs.parse_points(readers.read_message_files(spark, inbox))
        jobs.run_once(jobs.stream_metrics(points, store, out, str(tmp_path / "cp")))

    land(inbox, "a.txt", [point(n, 5) for n in range(6)])
    run()
    land(inbox, "b.txt", [point(n, 5) for n in range(6, 20)])
    run()
    gauges = spark.read.parquet(f"{out}/gauges").filter("batch_id = 1 AND metric = 'product_price'")
    assert [r.value for r in gauges.collect()] == [119.0]
    alerts = spark.read.parquet(f"{out}/alerts")
    assert [(r.alert, r.batch_id) for r in alerts.filter("alert = 'LowInventory'").collect()] == [("LowInventory", 1)]
    assert spark.read.parquet(store).count() == 20


def test_metrics_over_the_whole_series(spark, tmp_path):
    """Samples six hours apart, a late one, and an alert that lasts for days."""
    inbox, store, out = (str(tmp_path / n) for n in ("in", "store", "out"))
    start = dt.datetime(2024, 3, 1)
    samples = [{"item_id": 1, "name": "n", "price": 100.0 + n * n % 13, "quantity": 5,
                "timestamp": (start + dt.timedelta(hours=6 * n)).isoformat()} for n in range(40)]
    late = samples.pop(20)

    def run(name, rows):
        land(inbox, name, [json.dumps(r) for r in rows])
        points = jobs.parse_points(readers.read_message_files(spark, inbox))
        jobs.run_once(jobs.stream_metrics(points, store, out, str(tmp_path / "cp")))

    run("a.txt", samples[:12])
    run("b.txt", samples[12:39])
    run("c.txt", [late])
    whole = jobs.parse_points(spark.read.text(inbox))
    last = indicators.price_indicators(whole).orderBy("timestamp").collect()[-1]
    got = {r.metric: r.value for r in spark.read.parquet(f"{out}/gauges").filter("batch_id = 2").collect()}
    assert got["price_sma"] == pytest.approx(last.sma_7) and got["price_ema"] == pytest.approx(last.ema_14)
    assert got["price_rsi"] == pytest.approx(last.rsi_14)
    found = spark.read.parquet(f"{out}/alerts").filter("alert = 'LowInventory'").collect()
    assert [(r.starts_at, r.batch_id) for r in found] == [(start, 0)]
