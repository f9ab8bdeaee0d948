"""File, database and message sinks for batch frames and for micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from py4j.protocol import Py4JJavaError

BatchSink = Callable[[DataFrame, int], None]


def write_partitioned(df: DataFrame, path: str, by: str = "primary_category",
                      max_records: int = 5_000_000) -> None:
    """Full copy in folders by a column.

    The rebalance hint lets AQE split a partition value that holds much of the data, where a plain
    repartition by the column would put it in one task.
    """
    (df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "static")
       .option("maxRecordsPerFile", max_records).partitionBy(by).parquet(path))


def cast_for_store(df: DataFrame) -> DataFrame:
    """Column types of the keyed store."""
    kinds = {"timestamp": "timestamp", "processing_time": "timestamp", "price": "decimal(10,2)",
             "quantity": "int"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in kinds.items() if c in df.columns})


def write_table(df: DataFrame, fmt: str, options: dict[str, str], mode: str = "append") -> None:
    """Append through any connector; for a store without keys use the upsert of `tables`."""
    cast_for_store(df).write.format(fmt).mode(mode).options(**options).save()


def write_text(df: DataFrame, path: str) -> None:
    """One text column, replacing the folder."""
    df.write.mode("overwrite").text(path)


def with_date(df: DataFrame) -> DataFrame:
    return df.withColumn("ingest_date", F.to_date("processing_time"))


def drop_folder(df: DataFrame, path: str) -> None:
    """Remove a folder of any file system Spark knows; nothing happens if it is not there."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def foreach_parquet(path: str, fallback: str | None = None) -> BatchSink:
    """Each batch in its own `batch_id` folder, replaced on replay; another root if the first fails.

    A batch belongs to one root: whichever attempt succeeds removes what an earlier attempt left of the
    batch in the other.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        def to(root: str) -> None:
            (with_date(df).write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("ingest_date").parquet(f"{root}/batch_id={batch_id}"))

        try:
            to(path)
        except (AnalysisException, Py4JJavaError, OSError):
            if fallback is None:
                raise
            to(fallback)
            try:
                drop_folder(df, f"{path}/batch_id={batch_id}")
            except Py4JJavaError:
                pass  # the first root cannot be reached at all
        else:
            if fallback is not None:
                drop_folder(df, f"{fallback}/batch_id={batch_id}")

    return write


def foreach_jdbc(url: str, table: str, driver: str, **options: str) -> BatchSink:
    """Appends the batch with its `batch_id` after deleting what an interrupted attempt left of it."""
    def write(df: DataFrame, batch_id: int) -> None:
        execute(df, url, f"DELETE FROM {table} WHERE batch_id = {int(batch_id)}", driver, options)
        rows = df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        (rows.write.format("jdbc").mode("append")
         .options(url=url, dbtable=table, driver=driver, **options).save())

    return write


def execute(df: DataFrame, url: str, statement: str, driver: str, options: dict[str, str]) -> None:
    """One statement over the JDBC driver that the writer uses; the writer itself cannot delete."""
    jvm = df.sparkSession._jvm
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        properties.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()


def foreach_json(path: str | None = None, kafka: dict[str, str] | None = None) -> BatchSink:
    """Each row as one JSON record, to a folder per batch or to a topic."""
    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
        if kafka is not None:
            rows.write.format("kafka").options(**kafka).save()
        else:
            rows.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write
