"""SKU facts at item grain, the shared first step of the reports.

The four tables meet on `item_id`. SKUs and images are the only tables with many rows per item, so
they are reduced to one row per item first: the aggregation combines on the map side, a hot item
reaches the join as one row, and a distinct count of items becomes a plain count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.columns import on_sale, sale_price


def item_facts(skus: DataFrame, zero_is_no_sale: bool = False) -> DataFrame:
    """Sums, counts and extremes of each item's SKUs. Columns a report does not use are pruned."""
    q, p, s = F.col("quantity"), F.col("price"), F.col("special_price")
    sale = on_sale()
    return skus.groupBy("item_id").agg(
        F.sum(p).alias("price_sum"),
        F.count(p).alias("price_count"),
        F.max(p).alias("max_price"),
        F.min(p).alias("min_price"),
        F.sum(q).alias("units"),
        F.count(q).alias("quantity_count"),
        F.sum(q * p).alias("gross"),
        F.sum(q * sale_price(zero_is_no_sale=zero_is_no_sale)).alias("actual"),
        F.sum(F.when(sale, q * (p - s)).otherwise(0)).alias("discount"),
        F.count_if(q > 50).alias("high_stock"),
        F.count_if(q <= 20).alias("low_stock"),
        F.count_if(q <= 10).alias("scarce"),
        F.count_if(sale).alias("sale_skus"),
        F.max(sale).alias("discounted"),
    )


def image_facts(images: DataFrame) -> DataFrame:
    return images.groupBy("item_id").agg(
        F.count("image_url").alias("images"), F.lit(1).alias("has_images"))
