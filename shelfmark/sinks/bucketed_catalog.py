"""The four catalog tables as bucketed tables: keyed changes that rewrite touched buckets, in one commit.

All four are dealt by item_id, so a product and its children lie in buckets of one number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators.checks import check_key, check_lengths, check_reference, require
from shelfmark.operators.merge import insert_missing, replace_children, upsert
from shelfmark.schemas import KEYS, LENGTH_LIMITS, TABLES, Catalog, conform
from shelfmark.session import checkpointed
from shelfmark.sinks.bucketed import BucketedTables, Change, Layout


def open_catalog(spark: SparkSession, path: str, buckets: int = 1024) -> BucketedTables:
    return BucketedTables(spark, path, {name: Layout(schema, ("item_id",), buckets) for name, schema in TABLES.items()})


def read_catalog(tables: BucketedTables) -> Catalog:
    """The four tables, all of them as one commit left them."""
    return Catalog(**{name: tables.read(name) for name in TABLES})


def _rest(name: str) -> list[str]:
    return [f.name for f in TABLES[name].fields if f.name not in KEYS[name]]


def upsert_change(tables: BucketedTables, name: str, updates: DataFrame, keys: Sequence[str] | None = None,
                  order_by: Sequence[str] | None = None) -> Change:
    """Rows replace those of the same key; only buckets that updates fall into are read and rewritten."""
    own = tables.touched(name, updates)
    return Change(name, upsert(tables.read(name, own), updates, keys or KEYS[name], order_by or _rest(name)), own)


def upsert_rows(tables: BucketedTables, name: str, updates: DataFrame, keys: Sequence[str] | None = None,
                order_by: Sequence[str] | None = None) -> None:
    tables.commit([upsert_change(tables, name, checkpointed(updates), keys, order_by)])


def load_catalog(tables: BucketedTables, catalog: Catalog, sample_style: bool = False) -> None:
    """Keyed load of normalized pages into all four tables, as one commit.

    Products, SKUs and attributes are upserted and images added if absent. In `sample_style` SKUs of
    touched items are replaced and the date of known images is renewed. Equal keys inside one load carry
    no order, so the greatest row wins and a repeated load gives the same tables.
    """
    given = {name: checkpointed(conform(df, TABLES[name])) for name, df in catalog.tables().items()}
    changes = [upsert_change(tables, name, given[name]) for name in ("products", "attributes")]
    if sample_style:
        own = tables.touched("skus", given["skus"])
        changes.append(Change("skus", replace_children(tables.read("skus", own), given["skus"].dropDuplicates(KEYS["skus"])), own))
        changes.append(upsert_change(tables, "images", given["images"], order_by=["created_date"]))
    else:
        changes.append(upsert_change(tables, "skus", given["skus"]))
        own = tables.touched("images", given["images"])
        changes.append(Change("images", insert_missing(tables.read("images", own), given["images"], KEYS["images"], ["created_date"]), own))
    tables.commit(changes)


def bulk_append(tables: BucketedTables, staged: Catalog) -> None:
    """Check keys, references and text lengths of staged rows, then append all four tables as one commit.

    Staged rows are checked among themselves, and by key against the buckets they fall into. Nothing is
    appended when a check fails, and rows that are already there are not rewritten.
    """
    given = {name: checkpointed(conform(df, TABLES[name])) for name, df in staged.tables().items()}
    current = {name: tables.read(name, tables.touched(name, df)) for name, df in given.items()}
    for name, df in given.items():
        keys = KEYS[name]
        require(f"key of {name}", check_key(df, keys))
        require(f"key of {name}", current[name].select(*keys).join(df.select(*keys), list(keys), "left_semi"))
        require(f"text limits of {name}", check_lengths(df, LENGTH_LIMITS[name]))
        if name != "products":
            known = tables.read("products", tables.touched("products", df)).select("item_id").unionByName(given["products"].select("item_id"))
            require(f"product of {name}", check_reference(df, known, "item_id"))
    tables.commit([Change(name, df) for name, df in given.items()])
