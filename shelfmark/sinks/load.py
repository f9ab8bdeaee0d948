"""The load job: landed API pages to tables, rejected products and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.plans.documents import product_documents
from shelfmark.schemas import TABLES, Catalog
from shelfmark.session import checkpointed
from shelfmark.sinks import publish, tables
from shelfmark.sources import pages, readers


def rejected_rows(bad: DataFrame) -> DataFrame:
    """Products that a load leaves out, with the reasons and the whole product as JSON text."""
    return bad.select("item_id", F.array_join("reasons", ",").alias("reasons"),
                      F.to_json(F.struct(*[c for c in bad.columns if c != "reasons"])).alias("product"))


def load_job(spark: SparkSession, landed: str, db: str, location: str, quarantine: str, run_date: str,
             fmt: str = "text", options: dict[str, str] | None = None, whole_files: bool = False) -> None:
    """Load landed pages into the tables, set rejected products apart, and publish what was loaded.

    Rejected products go to `quarantine/run_date=...`, replaced when the day is run again; the tables are
    loaded by key, so a repeated run gives the same tables and messages. One message per part of each
    product of this run is published in its current state.
    """
    good, bad = pages.split_products(readers.read_api_pages(spark, landed, whole_files))
    rejected_rows(bad).write.mode("overwrite").json(f"{quarantine}/run_date={run_date}")
    catalog = pages.normalize_pages(good, run_date)
    tables.load_pages(catalog, db, location)
    items = checkpointed(catalog.products.select("item_id").distinct())
    current = Catalog(**{name: tables.read_current(spark, f"{db}.{name}").join(items, "item_id", "left_semi")
                         for name in TABLES})
    publish.publish_products(product_documents(current), fmt, options or {})
