"""Streaming jobs: several sinks from one source, latest state per key, gauges and alerts."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.series import latest_by
from shelfmark.plans.indicators import (
    RULES, Rule, alerts, gauges, metric_samples, price_indicators,
)
from shelfmark.schemas import PRICE_POINTS
from shelfmark.sinks.files import BatchSink, drop_folder, with_date
from shelfmark.sources.readers import recent


def stream_to_parquet(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append to a folder by ingest date; the file sink's own log makes a replay harmless."""
    writer = (with_date(df).writeStream.outputMode("append").format("parquet")
              .partitionBy("ingest_date").option("path", path).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_all(df: DataFrame, sinks: Sequence[BatchSink], checkpoint: str, once: bool = True) -> StreamingQuery:
    """One query that reads each batch once and hands it to every sink.

    A failing sink fails the batch, which is then repeated from the checkpoint; sinks are replay-safe.
    """
    def fan_out(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode("append").foreachBatch(fan_out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def run_once(query: StreamingQuery, timeout: int | None = None) -> bool:
    """Wait for an available-now query; an outside scheduler starts the next run."""
    return query.awaitTermination(timeout) if timeout else bool(query.awaitTermination() or True)


def upsert_stream(df: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str],
                  checkpoint: str, buckets: int = 1024, once: bool = True) -> StreamingQuery:
    """Keep the latest row per key in a folder partitioned by key bucket; `read_state` reads it.

    `order_by` is the message time, then partition and offset, since messages carry no key and may
    arrive in any order. The rows hold these columns, so a late message loses against a newer row of
    an earlier batch and a replay changes nothing. A batch reads and rewrites only the buckets it
    touches; their numbers, at most `buckets`, are the only thing that reaches the driver.

    New buckets go to folders of their own; a manifest that names the folder of every bucket is written
    last and switches all of them at once. Whatever breaks before that leaves the state as it was. The
    number of buckets is part of the manifest and cannot be changed for a state that exists.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        manifests = _manifests(spark, path)
        where = _manifest(spark, path, manifests[-1]) if manifests else {}
        if where.get("buckets", buckets) != buckets:
            raise ValueError(f"the state has {where['buckets']} buckets, not {buckets}")
        if batch_id in manifests:
            return  # replayed after its switch
        rows = latest_by(batch, keys, order_by).select("*", bucket).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = [r.bucket for r in rows.select("bucket").distinct().collect()]
            if not touched:
                return
            folders = where.get("folders", {})
            known = _read_folders(batch, path, {k: v for k, v in folders.items() if int(k) in touched})
            merged = latest_by(known.unionByName(rows), ["bucket", *keys], order_by)
            (merged.write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("bucket").parquet(f"{path}/data/batch={batch_id}"))
        finally:
            rows.unpersist()
        now = {**folders, **{str(k): batch_id for k in touched}}
        line = json.dumps({"buckets": buckets, "folders": now})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/manifest/batch={batch_id}")
        _expire(batch, path, manifests, folders, now)

    writer = df.writeStream.outputMode("append").foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _manifests(spark: SparkSession, path: str) -> list[int]:
    """Batches whose manifest is complete, ascending."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/batch=*/_SUCCESS")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


def _manifest(spark: SparkSession, path: str, batch_id: int) -> dict:
    return json.loads(spark.read.text(f"{path}/manifest/batch={batch_id}").first().value)


def _read_folders(like: DataFrame, path: str, folders: dict[str, int]) -> DataFrame:
    """Rows of the named bucket folders, with the columns of `like` and `bucket`."""
    schema = T.StructType([*like.schema.fields, T.StructField("bucket", T.IntegerType())])
    paths = [f"{path}/data/batch={batch}/bucket={k}" for k, batch in sorted(folders.items())]
    if not paths:
        return like.sparkSession.createDataFrame([], schema)
    # The bucket follows from the folder's name; batches share it, so it is read from the path.
    rows = like.sparkSession.read.schema(like.schema).parquet(*paths)
    number = F.regexp_extract(F.input_file_name(), r"bucket=(\d+)", 1).cast("int")
    return rows.withColumn("bucket", number)


def _expire(like: DataFrame, path: str, manifests: list[int], before: dict[str, int], now: dict[str, int]) -> None:
    """Remove folders that neither this manifest nor the one before it names."""
    if len(manifests) < 2:
        return
    spark = like.sparkSession
    old = _manifest(spark, path, manifests[-2])["folders"]
    for k, batch in old.items():
        if batch not in (before.get(k), now.get(k)):
            drop_folder(like, f"{path}/data/batch={batch}/bucket={k}")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Current rows of a state written by `upsert_stream`."""
    manifests = _manifests(spark, path)
    if not manifests:
        raise FileNotFoundError(f"no state in {path}")
    folders = _manifest(spark, path, manifests[-1])["folders"]
    return spark.read.parquet(*[f"{path}/data/batch={b}/bucket={k}" for k, b in sorted(folders.items())])


def stream_metrics(points: DataFrame, store: str, out: str, checkpoint: str, hours: int = 1,
                   rules: Sequence[Rule] = RULES, buckets: int = 256, once: bool = True) -> StreamingQuery:
    """Gauges and alerts after each batch of price points.

    Points are stored by series bucket and batch. A batch recomputes the series it has points of from
    all their stored points, so indicators, running counts and hold times start where the series does
    and a late point is in its place. Gauges are the last values of those series, unless older than
    `hours` before their newest sample. An alert is written once, by the batch that first sees it.
    """
    series = ["item_id", "name"]
    bucket = F.pmod(F.xxhash64("item_id"), F.lit(buckets)).cast("int").alias("bucket")

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("*", bucket, F.lit(batch_id).alias("batch_id")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = [r.bucket for r in rows.select("bucket").distinct().collect()]
            if not touched:
                return
            _replace_batch(rows, store)
            mine = rows.select(*series).distinct()
            stored = spark.read.schema(rows.schema).parquet(store).filter(F.col("bucket").isin(touched))
            history = stored.drop("bucket", "batch_id").join(mine, series, "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
            newest = history.agg(F.max("timestamp")).first()[0]
            shown = recent(price_indicators(history), str(newest), hours)
            gauges(metric_samples(shown)).write.mode("overwrite").parquet(f"{out}/gauges/batch_id={batch_id}")
            found = alerts(history, rules).select("*", bucket, F.lit(batch_id).alias("batch_id"))
            known = _stored_alerts(found, f"{out}/alerts").filter(
                F.col("bucket").isin(touched) & (F.col("batch_id") != batch_id))
            new = found.join(known.select("alert", *series, "starts_at"), ["alert", *series, "starts_at"], "left_anti")
            _replace_batch(new.select(*found.columns), f"{out}/alerts")
            history.unpersist()
        finally:
            rows.unpersist()

    writer = points.writeStream.outputMode("append").foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _replace_batch(rows: DataFrame, path: str) -> None:
    """Rows in folders by bucket and batch; a replay replaces the folders of its batch."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket", "batch_id").parquet(path))


def _stored_alerts(like: DataFrame, path: str) -> DataFrame:
    try:
        return like.sparkSession.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.sparkSession.createDataFrame([], like.schema)


def parse_points(df: DataFrame, value: str = "value") -> DataFrame:
    """Price points from JSON messages."""
    return df.select(F.from_json(F.col(value).cast("string"), PRICE_POINTS).alias("p")).select("p.*")
