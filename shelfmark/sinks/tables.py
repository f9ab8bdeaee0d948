"""Versioned tables: new content goes to a new folder, then the table is pointed at it.

A folder cannot be overwritten while it is read, and readers of the old version keep their files.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfmark.functions.series import latest_by
from shelfmark.operators.checks import check_key, check_lengths, check_reference, require
from shelfmark.operators.merge import insert_missing, replace_children, upsert
from shelfmark.schemas import KEYS, LENGTH_LIMITS, TABLES, Catalog, conform


def create_tables(spark: SparkSession, db: str, location: str, recreate: bool = False) -> None:
    """Declare the four tables; with `recreate` the old ones are dropped first, children before parent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    if recreate:
        for name in ("attributes", "images", "skus", "products"):
            spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
    for name, schema in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({columns}) USING parquet "
                  f"LOCATION '{location}/{name}/version={uuid.uuid4().hex}'")


def read_current(spark: SparkSession, table: str) -> DataFrame:
    """The current version, also when another session has moved the table since it was last read."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def write_version(table: str, df: DataFrame, location: str) -> str:
    """Write content for a table to a folder of its own, which is not current yet."""
    path = f"{location}/version={uuid.uuid4().hex}"
    conform(df, df.sparkSession.table(table).schema).write.mode("error").parquet(path)
    return path


def make_current(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def replace_content(table: str, df: DataFrame, location: str) -> str:
    """Write a new version of a table and make it current; returns its folder."""
    path = write_version(table, df, location)
    make_current(df.sparkSession, table, path)
    return path


def expire_versions(spark: SparkSession, table: str, location: str, keep: int = 2) -> list[str]:
    """Remove old versions of a table; the current one and the newest others, `keep` in all, stay.

    Readers that began on a removed version lose it, so `keep` covers the longest of them.
    """
    described = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()
    current = described.data_type.rstrip("/").rsplit("/", 1)[1]
    root = spark._jvm.org.apache.hadoop.fs.Path(location)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f for f in fs.listStatus(root) if f.getPath().getName().startswith("version=")]
    others = sorted((f for f in folders if f.getPath().getName() != current),
                    key=lambda f: f.getModificationTime(), reverse=True)
    gone = [f.getPath() for f in others[keep - 1:]]
    for path in gone:
        fs.delete(path, True)
    return [path.getName() for path in gone]


def upsert_table(table: str, updates: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                 location: str) -> str:
    """Upsert as a new version. A format with row-level changes takes `merge_into` instead."""
    current = read_current(updates.sparkSession, table)
    return replace_content(table, upsert(current, updates, keys, order_by), location)


def merge_statement(table: str, source: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    on = " AND ".join(f"t.`{k}` <=> u.`{k}`" for k in keys)
    sets = ", ".join(f"t.`{c}` = u.`{c}`" for c in columns if c not in keys)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"u.`{c}`" for c in columns)
    return (f"MERGE INTO {table} t USING {source} u ON {on} WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")


def merge_into(table: str, updates: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> None:
    """Upsert in place, for table formats that support MERGE; rewrites only the files concerned."""
    spark = updates.sparkSession
    columns = spark.table(table).columns
    view = f"_updates_{uuid.uuid4().hex}"
    latest_by(updates, keys, order_by).select(*columns).createOrReplaceTempView(view)
    try:
        spark.sql(merge_statement(table, view, columns, keys))
    finally:
        spark.catalog.dropTempView(view)


def bulk_load(staged: Catalog, db: str, location: str, staging: str) -> None:
    """Stage all four tables, check keys, references and lengths, then append their files.

    Only staged rows are checked: among themselves, and by key against the current tables. Nothing is
    appended when a check fails, and rows that are already there are neither rewritten nor counted anew.
    """
    spark = staged.products.sparkSession
    for name, df in staged.tables().items():
        conform(df, TABLES[name]).write.mode("error").parquet(f"{staging}/{name}")
    loaded = {name: spark.read.schema(TABLES[name]).parquet(f"{staging}/{name}") for name in TABLES}
    current = {name: read_current(spark, f"{db}.{name}") for name in TABLES}
    known = current["products"].select("item_id").unionByName(loaded["products"].select("item_id"))
    for name, df in loaded.items():
        keys = KEYS[name]
        require(f"key of {name}", check_key(df, keys))
        require(f"key of {name}", current[name].select(*keys).join(df.select(*keys), list(keys), "left_semi"))
        require(f"text limits of {name}", check_lengths(df, LENGTH_LIMITS[name]))
        if name != "products":
            require(f"product of {name}", check_reference(df, known, "item_id"))
    for name, df in loaded.items():
        df.select(*current[name].columns).write.mode("append").insertInto(f"{db}.{name}")


def load_pages(catalog: Catalog, db: str, location: str, sample_style: bool = False) -> None:
    """Keyed load of normalized pages into the tables.

    Products, SKUs and attributes are upserted and images added if absent. In `sample_style` SKUs of
    touched items are replaced and the date of known images is renewed. Equal keys inside one load
    carry no order, so the greatest row wins and a repeated load gives the same tables. All four new
    versions are written before the first table is pointed at its own.
    """
    spark = catalog.products.sparkSession

    written: dict[str, str] = {}

    def put(name: str, content: DataFrame) -> None:
        written[name] = write_version(f"{db}.{name}", content, f"{location}/{name}")

    def rest(name: str) -> list[str]:
        return [f.name for f in TABLES[name].fields if f.name not in KEYS[name]]

    now = {name: read_current(spark, f"{db}.{name}") for name in TABLES}
    for name in ("products", "attributes"):
        put(name, upsert(now[name], getattr(catalog, name), KEYS[name], rest(name)))
    if sample_style:
        put("skus", replace_children(now["skus"], catalog.skus.dropDuplicates(KEYS["skus"])))
        put("images", upsert(now["images"], catalog.images, KEYS["images"], ["created_date"]))
    else:
        put("skus", upsert(now["skus"], catalog.skus, KEYS["skus"], rest("skus")))
        put("images", insert_missing(now["images"], catalog.images, KEYS["images"], ["created_date"]))
    for name, path in written.items():
        make_current(spark, f"{db}.{name}", path)
