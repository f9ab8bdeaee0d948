"""API products to the four tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.columns import epoch_ms
from shelfmark.operators.merge import split_bad
from shelfmark.schemas import ATTRIBUTES, IMAGES, LENGTH_LIMITS, PRODUCTS, SKUS, Catalog, conform

# Message key of each SKU column.
SKU_KEYS = {
    "sku_id": "SkuId", "seller_sku": "SellerSku", "shop_sku": "ShopSku", "status": "Status",
    "quantity": "quantity", "available": "Available", "price": "price", "special_price": "special_price",
}


def longer_than(limit: int) -> Callable[[Column], Column]:
    return lambda text: F.length(text) > limit


def split_products(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Loadable products, and those a load would reject together with all their children."""
    limits = LENGTH_LIMITS["products"]
    sku_limits = {"SellerSku": 100, "ShopSku": 100, "Status": 50}
    long_sku = F.lit(False)
    for field, limit in sku_limits.items():
        long_sku = long_sku | F.exists(F.col(f"skus.{field}"), longer_than(limit))
    return split_bad(products, {
        "not JSON": F.col("_corrupt_record").isNotNull(),
        "no item_id": F.col("item_id").isNull(),
        "no attributes": F.col("attributes").isNull(),
        "created_time": F.col("created_time").isNotNull() & epoch_ms("created_time").isNull(),
        "updated_time": F.col("updated_time").isNotNull() & epoch_ms("updated_time").isNull(),
        "name too long": F.length("attributes.name") > limits["name"],
        "status too long": F.length("status") > limits["status"],
        "brand too long": F.length("attributes.brand") > LENGTH_LIMITS["attributes"]["brand"],
        "SKU without id": F.exists("skus", lambda s: s["SkuId"].isNull()),
        "SKU text too long": long_sku,
        "image without URL": F.exists("images", lambda u: u.isNull()),
    })


def normalize_pages(products: DataFrame, run_date: str) -> Catalog:
    """One product row, its SKU and image rows and one attribute row for each API product.

    The name comes from the attributes. Absent or empty lists give no child rows. A product that
    occurs on several pages gives its rows again; the keyed writes take care of that.
    """
    date = F.lit(run_date).cast("date").alias("created_date")
    sku = F.explode("skus").alias("sku")
    given = F.coalesce("attributes.name", "attributes.brand", "attributes.description").isNotNull()
    return Catalog(
        products=conform(products.select(
            "item_id", F.col("attributes.name").alias("name"),
            epoch_ms("created_time").alias("created_time"),
            epoch_ms("updated_time").alias("updated_time"),
            "primary_category", "status", date), PRODUCTS),
        skus=conform(products.select("item_id", sku).select(
            "item_id", *[F.col(f"sku.{key}").alias(name) for name, key in SKU_KEYS.items()], date), SKUS),
        images=conform(products.select("item_id", F.explode("images").alias("image_url"), date), IMAGES),
        attributes=conform(products.filter(given).select(
            "item_id", "attributes.brand", "attributes.description", date), ATTRIBUTES),
    )
