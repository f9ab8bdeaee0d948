"""Changes over sliding event-time windows: against the series function, and with late points in a stream."""

import datetime as dt
import json
import os

import numpy as np
from pyspark.sql import functions as F

from shelfmark.functions import series
from shelfmark.sources import readers
from shelfmark.streaming import jobs
from shelfmark.streaming.windows import changes_by_window, volatile

SCHEMA = "item_id bigint, name string, price double, quantity int, timestamp timestamp"
START = dt.datetime(2024, 3, 1, 10)


def make_points():
    rng = np.random.default_rng(1)
    rows = []
    for item in (1, 2):
        for minute in range(150):
            # The last microsecond of a minute ends the windows of both definitions alike.
            rows.append((item, "n", float(rng.integers(1, 3)), 1, START + dt.timedelta(minutes=minute, seconds=59, microseconds=999_999)))
            for second in rng.choice(59, rng.integers(0, 3), replace=False):
                rows.append((item, "n", float(rng.integers(1, 4)), 1, START + dt.timedelta(minutes=minute, seconds=int(second))))
    return rows


def test_equals_the_series_function(spark):
    points = spark.createDataFrame(make_points(), SCHEMA)
    want = {(r.item_id, r.timestamp): r.changes for r in series.changes_in(points, "1 hour", "changes", by=["item_id", "name"]).filter(
        "second(timestamp) = 59 AND date_format(timestamp, 'SSSSSS') = '999999'").collect()}
    got = {(r.item_id, r.window_end - dt.timedelta(microseconds=1)): r.changes for r in changes_by_window(points).collect()}
    assert len(want) == 300 and all(got[k] == n for k, n in want.items())
    some = changes_by_window(points)
    assert volatile(some).count() == some.filter(F.col("changes") > 5).count() > 0


def test_one_sample_per_instant(spark):
    at = START + dt.timedelta(seconds=5)
    points = spark.createDataFrame([(1, "n", 2.0, 1, at), (1, "n", 1.0, 1, at), (1, "n", 2.0, 1, at + dt.timedelta(seconds=1)),
                                    (1, None, 2.0, 1, at), (1, "n", 3.0, 1, at + dt.timedelta(minutes=2))], SCHEMA)
    rows = {(r.name, r.window_end): (r.samples, r.changes) for r in changes_by_window(points, "3 minutes").collect()}
    assert rows["n", START + dt.timedelta(minutes=1)] == (2, 0) and rows["n", START + dt.timedelta(minutes=3)] == (3, 1)
    assert rows[None, START + dt.timedelta(minutes=1)] == (1, 0)


def test_late_and_too_late_points(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(inbox)

    def land(name, minutes):
        with open(os.path.join(inbox, name), "w") as f:
            f.write("\n".join(json.dumps({"item_id": 1, "name": "n", "price": p, "quantity": 1, "timestamp": (START + dt.timedelta(minutes=m)).isoformat()})
                              for m, p in minutes))
        points = jobs.parse_points(readers.read_message_files(spark, inbox))
        windows = changes_by_window(points, "10 minutes", "5 minutes", "10 minutes")
        jobs.run_once(windows.writeStream.outputMode("append").format("parquet").option("path", out)
                      .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())

    land("a.txt", [(0, 1.0), (2, 2.0), (20, 3.0)])        # watermark at minute 10
    land("b.txt", [(12, 9.0), (1, 5.0), (60, 4.0)])       # 12 is late but in time; 1 is too late
    land("c.txt", [(200, 4.0)])
    rows = {(r.window_end - START).seconds // 60: (r.samples, r.changes) for r in spark.read.parquet(out).filter(F.col("window_end") > START).collect()}
    assert rows[5] == (2, 1) and rows[10] == (2, 1)   # minutes 0 and 2, without the point of minute 1
    assert rows[15] == (1, 0) and rows[20] == (1, 0)  # minute 12
    assert rows[25] == rows[30] == (1, 0)             # minute 20
