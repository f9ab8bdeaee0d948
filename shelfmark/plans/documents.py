"""The flat product table and the nested product documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.columns import iso_text
from shelfmark.functions.skew import MAX_ROWS, attach, find_heavy, salted_join
from shelfmark.schemas import FULL_PRODUCTS, MESSAGE_SKUS, Catalog
from shelfmark.session import checkpointed

#: SKUs or images that a part of a document holds, about; a property of the message format.
PAGE = 50_000
#: Items of several parts that are broadcast; more of them are joined by a shuffle.
FEW_ITEMS = 100_000


def full_products(catalog: Catalog, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per product, SKU and image; a product without children keeps one row.

    The one-to-one attributes come first. The fan-out joins are salted, since a left join cannot be
    split at run time on the side that repeats.
    """
    base = catalog.products.drop("created_date").join(
        catalog.attributes.select("item_id", "brand", "description"), "item_id", "left")
    skus = catalog.skus.drop("created_date").withColumnRenamed("status", "sku_status")
    images = catalog.images.select("item_id", "image_url")
    sku_heavy = find_heavy(skus, ["item_id"], max_rows)
    image_heavy = find_heavy(images, ["item_id"], max_rows)
    with_skus = salted_join(base, skus, ["item_id"], "left", right_heavy=sku_heavy)
    with_images = salted_join(with_skus, images, ["item_id"], "left", sku_heavy, image_heavy)
    return with_images.select(*FULL_PRODUCTS)


def _oversized(skus: DataFrame, urls: DataFrame, page: int) -> DataFrame | None:
    """Items whose SKUs or images fill more than a page: `parts`, smallest SKU and URL; None without any.

    Items with more than `page` rows of a kind are found by one job over the item numbers; only their rows
    are made distinct here. At most (rows / page) items are left.
    """
    kinds = {"sku": skus, "url": urls}
    numbers = reduce(DataFrame.unionByName, [
        d.select("item_id", F.lit(name).alias("kind")) for name, d in kinds.items()])
    crowded = find_heavy(numbers, ["item_id", "kind"], page)
    if crowded is None:
        return None
    items = crowded.select("item_id").distinct()

    def sizes(name: str) -> DataFrame:
        own = kinds[name].join(items, "item_id", "left_semi").distinct()
        return own.groupBy("item_id").agg(F.count("*").alias(f"{name}_n"), F.min("child").alias(name))

    most = F.greatest(F.coalesce("sku_n", F.lit(1)), F.coalesce("url_n", F.lit(1)))
    plan = sizes("sku").join(sizes("url"), "item_id", "full").select(
        "item_id", F.ceil(most / page).cast("int").alias("parts"), "sku", "url")
    plan = checkpointed(plan.filter(F.col("parts") > 1))
    return None if plan.isEmpty() else plan


def _child_lists(children: DataFrame, plan: DataFrame | None, few: bool, first: str, name: str) -> DataFrame:
    """Distinct children of each item, or of each part of it, as a sorted list: one exchange of the children."""
    gathered = F.array_sort(F.collect_set("child")).alias(name)
    if plan is None:
        return children.groupBy("item_id").agg(gathered)
    placed = attach(children, plan, ["item_id"], ["parts", first], bounded=few)
    part = F.when(F.col("child").eqNullSafe(F.col(first)), F.lit(0)).otherwise(
        F.pmod(F.xxhash64("child"), F.coalesce("parts", F.lit(1))).cast("int"))
    # An exchange of its own: the parts of one item leave the task that the join brought them to.
    placed = placed.select("item_id", part.alias("part"), "child").repartition("item_id", "part")
    return placed.groupBy("item_id", "part").agg(gathered)


def product_documents(catalog: Catalog, published: str | Column | None = None,
                      page: int = PAGE) -> DataFrame:
    """Nested document of each product: columns `timestamp`, `data`, `part`, `parts`.

    Children are made distinct where they are gathered, so SKUs and images of an item do not multiply and
    every child is shuffled once. A document has as many parts as its distinct SKUs or images fill pages of
    `page`, at least one; children are dealt to the parts by hash, except that the smallest SKU and URL are
    in part 0. A part holds about `page` of each, so no message and no task grows with the product.
    Children without item number belong to no document.
    """
    sku = F.struct(
        F.col("sku_id").alias("SkuId"), F.col("seller_sku").alias("SellerSku"),
        F.col("shop_sku").alias("ShopSku"), F.col("status").alias("Status"), F.col("quantity"),
        F.col("available").alias("Available"), F.col("price"), F.col("special_price"))
    skus = catalog.skus.filter(F.col("item_id").isNotNull()).select("item_id", sku.alias("child"))
    urls = catalog.images.filter(F.col("item_id").isNotNull() & F.col("image_url").isNotNull()).select(
        "item_id", F.col("image_url").alias("child"))
    plan = _oversized(skus, urls, page)
    few = plan is not None and plan.count() <= FEW_ITEMS

    docs = catalog.products.drop("created_date").join(
        catalog.attributes.select("item_id", "brand", "description"), "item_id", "left")
    keys = ["item_id"]
    if plan is None:
        docs = docs.withColumns({"part": F.lit(0), "parts": F.lit(1)})
    else:
        keys.append("part")
        docs = attach(docs, plan, ["item_id"], ["parts"], bounded=few)
        docs = docs.withColumn("parts", F.coalesce("parts", F.lit(1)))
        docs = docs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    docs = docs.join(_child_lists(skus, plan, few, "sku", "skus"), keys, "left").join(
        _child_lists(urls, plan, few, "url", "images"), keys, "left")
    if published is None:
        published = F.current_timestamp()
    elif isinstance(published, str):
        published = F.lit(published).cast("timestamp")
    return docs.select(
        iso_text(published).alias("timestamp"),
        F.struct(
            F.col("item_id").cast("string").alias("id"), "name",
            iso_text("created_time").alias("created_time"),
            iso_text("updated_time").alias("updated_time"),
            "primary_category", "status",
            F.coalesce("images", F.array().cast("array<string>")).alias("images"),
            F.coalesce("skus", F.array().cast(MESSAGE_SKUS)).alias("skus"),
            F.struct("name", "brand", "description").alias("attributes"),
        ).alias("data"),
        "part", "parts",
    )


def document_json(docs: DataFrame) -> DataFrame:
    """Message text of each document: timestamp, data, part and parts; NULL fields are written."""
    money = docs.withColumn("data", F.col("data").withField("skus", F.transform(
        "data.skus", lambda s: s.withField("price", s["price"].cast("double"))
        .withField("special_price", s["special_price"].cast("double")))))
    body = F.to_json(F.struct("timestamp", "data", "part", "parts"), {"ignoreNullFields": "false"})
    return money.select(body.alias("value"))
