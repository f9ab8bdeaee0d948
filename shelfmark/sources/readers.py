"""Batch and stream sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.schemas import API_PAGE, API_PRODUCT, TABLES, Catalog, conform


def read_jdbc(spark: SparkSession, url: str, query: str,
              partition: tuple[str, int, int, int] | None = None, **options) -> DataFrame:
    """Table name or sub-select of a database.

    `partition` is (column, lower, upper, pieces); without it the whole result comes through one
    connection, so give it for anything large.
    """
    source = query if query.strip().replace(".", "").replace("_", "").isalnum() else f"({query}) q"
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", source)
    if partition:
        column, lower, upper, pieces = partition
        reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper,
                                numPartitions=pieces)
    return reader.options(**options).load()


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
               fail_on_data_loss: bool = False, **options) -> DataFrame:
    """Stream of a topic; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .options(**options)
        .load()
    )


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of landed message files, one JSON message per line, as column `value`."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_catalog(spark: SparkSession, source: str, fmt: str = "parquet", **options) -> Catalog:
    """The four tables from `source/<table>` folders, `source.<table>` tables or a database.

    `fmt` is any file format, `table` for catalog tables (`source` is the database name) or `jdbc`
    (`source` is the url).
    """
    def load(name: str, schema: T.StructType) -> DataFrame:
        if fmt == "table":
            df = spark.table(f"{source}.{name}")
        elif fmt == "jdbc":
            df = read_jdbc(spark, source, name, **options)
        elif fmt in ("json", "csv"):
            df = spark.read.schema(schema).options(**options).format(fmt).load(f"{source}/{name}")
        else:
            df = spark.read.options(**options).format(fmt).load(f"{source}/{name}")
        return conform(df, schema)

    return Catalog(**{name: load(name, schema) for name, schema in TABLES.items()})


def read_api_pages(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Products of landed API pages, one JSON page per line or per file; empty pages give no rows.

    A page that is not JSON gives one row with `_corrupt_record` set and no product.
    """
    pages = spark.read.option("wholetext", whole_files).text(path)
    return products_of_pages(pages.filter(F.trim("value") != ""))


def products_of_pages(pages: DataFrame, value: str = "value") -> DataFrame:
    """Products of page texts."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = pages.select(F.from_json(value, API_PAGE, options).alias("p"))
    broken = F.col("p._corrupt_record")
    nothing = F.array(F.lit(None).cast(API_PRODUCT))
    listed = F.when(broken.isNull(), F.col("p.data.products")).otherwise(nothing)
    return parsed.select(F.explode(listed).alias("product"), broken.alias("_corrupt_record")).select(
        "product.*", "_corrupt_record")


def recent(df: DataFrame, as_of: str, hours: int = 1, ts: str = "timestamp") -> DataFrame:
    """Rows of the trailing window that ends at `as_of`, the left end open."""
    end = F.lit(as_of).cast("timestamp")
    return df.filter((F.col(ts) > end - F.expr(f"INTERVAL {hours} HOUR")) & (F.col(ts) <= end))


def literal_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def page_slice(df: DataFrame, order: Sequence[str], page: int, size: int = 20) -> DataFrame:
    """One page (from 1) of an ordered frame."""
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


# Column type for each kind of JSON value.
JSON_TYPES = {
    "BOOLEAN": "BOOLEAN", "BIGINT": "INTEGER", "DECIMAL": "DECIMAL", "DOUBLE": "DECIMAL",
    "STRING": "TEXT", "OBJECT": "JSONB", "ARRAY": "JSONB",
}
SPARK_TYPES = {
    "BOOLEAN": "BOOLEAN", "INTEGER": "BIGINT", "DECIMAL": "DECIMAL(38,6)", "TEXT": "STRING",
    "JSONB": "VARIANT", "DATE": "DATE",
}


def infer_table_schema(df: DataFrame, column: str) -> DataFrame:
    """Column names (lower case) and types that the JSON objects in `column` call for.

    Integer and decimal values of one name give DECIMAL, other mixtures TEXT, NULL alone TEXT.
    `created_date` is added, as each loaded table has it.
    """
    pairs = df.select(F.explode(F.from_json(column, "map<string,variant>")).alias("key", "value"))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    mapping = F.create_map(*[F.lit(x) for kv in JSON_TYPES.items() for x in kv])
    seen = pairs.select(F.lower("key").alias("column_name"), F.try_element_at(mapping, kind).alias("t"))
    kinds = seen.groupBy("column_name").agg(F.array_sort(F.collect_set("t")).alias("ts"))
    merged = (
        F.when(F.size("ts") == 1, F.col("ts")[0])
        .when(F.col("ts") == F.array(F.lit("DECIMAL"), F.lit("INTEGER")), F.lit("DECIMAL"))
        .otherwise(F.lit("TEXT"))
    )
    out = kinds.select("column_name", merged.alias("sql_type"))
    stamp = df.sparkSession.range(1).select(F.lit("created_date").alias("column_name"),
                                            F.lit("DATE").alias("sql_type"))
    return out.unionByName(stamp)


def table_ddl(columns: DataFrame, table: str) -> str:
    """CREATE TABLE text for an inferred schema; one row per column, so collecting it is small."""
    spec = ", ".join(f"`{r.column_name}` {SPARK_TYPES[r.sql_type]}" for r in columns.collect())
    return f"CREATE TABLE IF NOT EXISTS {table} ({spec}) USING parquet"
