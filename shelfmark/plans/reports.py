"""The catalog reports. Every report returns an ordered frame; `as_of` is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.columns import (
    DISCOUNT_LABELS, PRICE_BOUNDS, PRICE_LABELS, STOCK_BOUNDS, STOCK_LABELS, bucket, discount_pct,
    discount_range, label_of, on_sale, pct, ratio, round2,
)
from shelfmark.functions.series import growth_pct, with_previous
from shelfmark.operators.gaps import densify
from shelfmark.plans.facts import image_facts, item_facts


def category_analytics(products: DataFrame, skus: DataFrame, images: DataFrame,
                       attributes: DataFrame, approx: bool = False) -> DataFrame:
    """Counts, prices, stock, images and brands of each category that has SKUs.

    With `approx` the SKU ids of a category are counted by sketch, which needs no shuffle of SKU rows.
    """
    items = (
        products.filter(F.col("primary_category").isNotNull()).select("item_id", "primary_category")
        .join(item_facts(skus), "item_id", "left")
        .join(image_facts(images), "item_id", "left")
        .join(attributes.select("item_id", "brand", F.length("description").alias("text_length")),
              "item_id", "left")
    )
    sums = ["price_sum", "price_count", "units", "quantity_count", "gross", "high_stock", "low_stock",
            "sale_skus", "images", "has_images", "with_skus", "long_texts"]
    by_brand = items.groupBy("primary_category", "brand").agg(
        *[F.sum(c).alias(c) for c in sums[:10]],
        F.count("price_count").alias("with_skus"),
        F.count_if(F.col("text_length") > 500).alias("long_texts"),
        F.max("max_price").alias("max_price"),
        F.min("min_price").alias("min_price"),
        F.count("*").alias("rows"),
    )
    most_common = F.when(F.col("brand").isNotNull(), F.struct(-F.col("rows"), F.col("brand")))
    by_category = by_brand.groupBy("primary_category").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.max("max_price").alias("max_price"),
        F.min("min_price").alias("min_price"),
        F.count("brand").alias("brands"),
        F.min_by("brand", most_common).alias("top_brand"),
    ).filter(F.col("with_skus") > 0)
    # SKU ids are only unique inside an item; the distinct count needs the SKU rows.
    sku_ids = skus.select("item_id", "sku_id").join(
        products.select("item_id", "primary_category"), "item_id")
    distinct = F.approx_count_distinct if approx else F.count_distinct
    sku_counts = sku_ids.groupBy("primary_category").agg(distinct("sku_id").alias("sku_count"))
    c = F.col
    return by_category.join(sku_counts, "primary_category", "left").select(
        "primary_category",
        c("with_skus").alias("total_products"),
        c("sku_count").alias("total_skus"),
        ratio("price_sum", "price_count").alias("average_price"),
        c("max_price").alias("highest_price"),
        c("min_price").alias("lowest_price"),
        c("units").alias("total_inventory"),
        round2("gross").alias("inventory_value"),
        c("high_stock").alias("high_stock_items"),
        c("low_stock").alias("low_stock_items"),
        ratio("units", "quantity_count").alias("average_stock_level"),
        c("sale_skus").alias("items_on_sale"),
        F.coalesce("images", F.lit(0)).alias("total_images"),
        F.coalesce("has_images", F.lit(0)).alias("products_with_images"),
        ratio("images", "has_images").alias("avg_images_per_product"),
        c("brands").alias("unique_brands"),
        c("top_brand").alias("most_common_brand"),
        c("long_texts").alias("detailed_descriptions"),
        pct("sale_skus", "with_skus").alias("sale_items_percentage"),
        ratio("gross", "units").alias("average_item_value"),
    ).orderBy(c("inventory_value").desc_nulls_first())


def _brand_products(products: DataFrame, skus: DataFrame, attributes: DataFrame,
                    zero_is_no_sale: bool = False) -> DataFrame:
    items = (
        item_facts(skus, zero_is_no_sale)
        .join(products.select("item_id", "primary_category"), "item_id")
        .join(attributes.select("item_id", "brand"), "item_id")
    )
    return items.groupBy("brand", "primary_category").agg(
        F.count("*").alias("total_products"),
        F.sum("gross").alias("total_revenue"),
        F.sum("actual").alias("actual_revenue"),
        F.sum("units").alias("total_units_sold"),
        F.sum("scarce").alias("low_stock_count"),
        F.count_if("discounted").alias("discounted_items"),
    )


def brand_kpi_impact(products: DataFrame, skus: DataFrame, attributes: DataFrame,
                     zero_is_no_sale: bool = False) -> DataFrame:
    """Five metrics of each brand and category in long form, from one pass over the aggregates."""
    metrics = _brand_products(products, skus, attributes, zero_is_no_sale)
    lost = F.col("total_revenue") - F.col("actual_revenue")

    def row(category: str, name: str, value: Column, percentage: Column) -> Column:
        return F.struct(F.lit(category).alias("impact_category"), F.lit(name).alias("metric_name"),
                        value.cast("decimal(38,2)").alias("value"), percentage.alias("percentage"))

    c = F.col
    long = metrics.select(F.inline(F.array(
        row("Revenue Impact", "Actual Revenue", c("actual_revenue"), pct("actual_revenue", "total_revenue")),
        row("Revenue Impact", "Discount Loss", lost, pct(lost, "total_revenue")),
        row("Inventory Health", "Low Stock Products", c("low_stock_count"),
            pct("low_stock_count", "total_products")),
        row("Pricing Strategy", "Discounted Products", c("discounted_items"),
            pct("discounted_items", "total_products")),
        row("Sales Efficiency", "Sales per Product", c("total_units_sold"),
            pct("total_units_sold", "total_products")),
    )))
    return long.orderBy("impact_category", F.col("percentage").desc_nulls_first())


def brand_roi(products: DataFrame, skus: DataFrame, attributes: DataFrame,
              zero_is_no_sale: bool = False) -> DataFrame:
    """Revenue effect of sale prices and units per product of each brand and category."""
    metrics = _brand_products(products, skus, attributes, zero_is_no_sale)
    gain = F.col("actual_revenue") - F.col("total_revenue")
    return metrics.select(
        "brand", "primary_category",
        pct(gain, "total_revenue").alias("roi_percentage"),
        ratio("total_units_sold", "total_products").alias("units_per_product"),
    ).orderBy("brand", "primary_category")


def sku_ranges(skus: DataFrame) -> DataFrame:
    """SKUs with their price, stock and discount bucket and the sale flag."""
    return skus.withColumns({
        "price_range": bucket("price", PRICE_BOUNDS, PRICE_LABELS),
        "stock_range": bucket("quantity", STOCK_BOUNDS, STOCK_LABELS),
        "discount_percentage": discount_pct(),
        "discount_range": discount_range(),
        "is_discounted": on_sale(),
    })


def distributions(products: DataFrame, skus: DataFrame) -> DataFrame:
    """SKU counts, mean price and stock by price, stock and discount bucket.

    SKUs are first counted per item and triple of bucket numbers, so at most 125 rows of an item
    reach the join; the three groupings then come from one pass, and labels are put on last.
    """
    five = range(5)
    cells = skus.select(
        "item_id", "price", "quantity",
        bucket("price", PRICE_BOUNDS, five).alias("price_no"),
        bucket("quantity", STOCK_BOUNDS, five).alias("stock_no"),
        discount_range(labels=five).alias("discount_no"),
    ).groupBy("item_id", "price_no", "stock_no", "discount_no").agg(
        F.count("*").alias("n"), F.sum("price").alias("price_sum"),
        F.count("price").alias("price_count"), F.sum("quantity").alias("units"),
    ).join(products.select("item_id"), "item_id")

    def row(metric: str, number: str, units: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric_type"), F.col(number).alias("no"),
                        "n", "price_sum", "price_count", units.alias("units"))

    long = cells.select(F.inline(F.array(
        row("Price Distribution", "price_no", F.col("units")),
        row("Stock Distribution", "stock_no", F.col("units")),
        row("Discount Distribution", "discount_no", F.lit(0).cast("bigint")),
    )))
    totals = long.groupBy("metric_type", "no").agg(
        F.sum("n").alias("count"), F.sum("price_sum").alias("price_sum"),
        F.sum("price_count").alias("price_count"), F.sum("units").alias("total_quantity"))
    metric = F.col("metric_type")
    label = (
        F.when(metric == "Price Distribution", label_of("no", PRICE_LABELS))
        .when(metric == "Stock Distribution", label_of("no", STOCK_LABELS))
        .otherwise(label_of("no", DISCOUNT_LABELS))
    )
    return totals.select(
        "metric_type", label.alias("range_bucket"), "count",
        ratio("price_sum", "price_count").alias("avg_value"), "total_quantity",
    ).orderBy("metric_type", "range_bucket")


def daily_brand_revenue(products: DataFrame, skus: DataFrame, attributes: DataFrame, as_of: str | Column,
                        days: int = 30, integer_growth: bool = False) -> DataFrame:
    """Revenue, discounts and growth by creation day and brand in the trailing `days`.

    The growth window runs over one row per brand and day. `integer_growth` truncates the quotient
    of the unit growth as integer division does.
    """
    end = F.lit(as_of).cast("timestamp")
    created = F.col("created_time")
    recent = products.filter((created >= end - F.expr(f"INTERVAL {days} DAYS")) & (created <= end))
    # SKUs of other items are left out before they are reduced.
    sold = skus.join(recent.select("item_id"), "item_id", "left_semi")
    daily = (
        recent.select("item_id", F.date_trunc("day", created).alias("sale_date"))
        .join(item_facts(sold), "item_id")
        .join(attributes.select("item_id", "brand"), "item_id")
        .groupBy("sale_date", "brand").agg(
            F.count("*").alias("products_sold"),
            F.sum("units").alias("units_sold"),
            F.sum("gross").alias("gross_revenue"),
            F.sum("discount").alias("discount_value"),
        )
    )
    daily = with_previous(daily, ["gross_revenue", "units_sold"], ["brand"], "sale_date")
    net = F.col("gross_revenue") - F.col("discount_value")
    return daily.select(
        "sale_date", "brand", "products_sold", "units_sold",
        round2("gross_revenue").alias("gross_revenue"),
        round2(net).alias("net_revenue"),
        round2("discount_value").alias("total_discounts"),
        pct("discount_value", "gross_revenue").alias("discount_pct"),
        ratio("units_sold", "products_sold").alias("units_per_product"),
        growth_pct("gross_revenue", "prev_gross_revenue").alias("revenue_growth_pct"),
        growth_pct("units_sold", "prev_units_sold", integer=integer_growth).alias("sales_growth_pct"),
        ratio(net, "units_sold").alias("average_order_value"),
    ).orderBy(F.col("sale_date").desc_nulls_first(), F.col("net_revenue").desc_nulls_first())


def hourly_brand_trend(facts: DataFrame, as_of: str | Column, days: int = 7,
                       members: DataFrame | None = None) -> DataFrame:
    """Hourly brand figures with 24-row moving averages and growth; hours without facts are zero."""
    end = F.lit(as_of).cast("timestamp")
    start = end - F.expr(f"INTERVAL {days} DAYS")
    counted = ["products_count", "total_units", "gross_revenue", "actual_revenue", "items_on_sale"]
    members = facts.select("brand").distinct() if members is None else members
    shown = facts.filter((F.col("time_bucket") >= start) & (F.col("time_bucket") <= end))
    full = densify(shown, "time_bucket", ["brand"], start, end, "1 hour", counted, members)
    day = Window.partitionBy("brand").orderBy("time_bucket").rowsBetween(-23, 0)
    full = full.withColumns({
        "revenue_24h_ma": ratio(F.sum("gross_revenue").over(day), F.count("gross_revenue").over(day)),
        "units_24h_ma": ratio(F.sum("total_units").over(day), F.count("total_units").over(day)),
    })
    full = with_previous(full, ["actual_revenue"], ["brand"], "time_bucket")
    discount = F.col("gross_revenue") - F.col("actual_revenue")
    return full.select(
        "time_bucket", "brand",
        F.col("products_count").alias("new_products"),
        F.col("total_units").alias("units_sold"),
        round2("gross_revenue").alias("gross_revenue"),
        round2("actual_revenue").alias("net_revenue"),
        pct(discount, "gross_revenue").alias("discount_rate_pct"),
        F.col("items_on_sale").alias("products_on_sale"),
        round2("avg_price").alias("average_price"),
        "revenue_24h_ma", "units_24h_ma",
        growth_pct("actual_revenue", "prev_actual_revenue", first=None).alias("revenue_growth_pct"),
    ).orderBy(F.col("time_bucket").desc_nulls_first(), "brand")


SCORECARD_COUNTS = [
    "total_products", "active_listings", "new_listings", "removed_listings", "total_stock",
    "low_stock_items", "out_of_stock", "excess_stock", "units_sold", "orders_count",
    "gross_revenue", "net_revenue", "discount_amount", "promo_products", "page_views",
    "unique_visitors",
]


def brand_scorecard(daily_facts: DataFrame, start: Column, end: Column,
                    members: DataFrame | None = None) -> DataFrame:
    """Portfolio, stock, sales, price and marketing figures of every brand on every day."""
    members = daily_facts.select("brand").distinct() if members is None else members
    shown = daily_facts.filter((F.col("date_stamp") >= start) & (F.col("date_stamp") <= end))
    full = densify(shown, "date_stamp", ["brand"], start, end, "1 day", SCORECARD_COUNTS, members)
    at_risk = F.col("low_stock_items") + F.col("out_of_stock")
    as_is = {c: F.col(c) for c in SCORECARD_COUNTS}
    rounded = {c: round2(c).alias(c) for c in (
        "avg_order_size", "gross_revenue", "net_revenue", "avg_price", "median_price", "min_price",
        "max_price", "conversion_rate", "return_rate", "fulfillment_rate", "cancellation_rate",
        "avg_discount_percent")}
    return full.select(
        F.col("date_stamp").alias("date"), "brand",
        as_is["total_products"], as_is["active_listings"], as_is["new_listings"],
        as_is["removed_listings"],
        pct("active_listings", "total_products").alias("active_products_pct"),
        as_is["total_stock"], as_is["low_stock_items"], as_is["out_of_stock"], as_is["excess_stock"],
        pct(at_risk, "total_products").alias("stock_risk_pct"),
        as_is["units_sold"], F.col("orders_count").alias("order_count"), rounded["avg_order_size"],
        pct("units_sold", "total_stock").alias("stock_turnover_pct"),
        rounded["gross_revenue"], rounded["net_revenue"],
        round2("discount_amount").alias("total_discounts"),
        pct("discount_amount", "gross_revenue").alias("discount_pct"),
        rounded["avg_price"].alias("average_price"), rounded["median_price"], rounded["min_price"],
        rounded["max_price"],
        rounded["conversion_rate"].alias("conversion_rate_pct"),
        rounded["return_rate"].alias("return_rate_pct"),
        rounded["fulfillment_rate"].alias("fulfillment_rate_pct"),
        rounded["cancellation_rate"].alias("cancellation_rate_pct"),
        F.col("promo_products").alias("products_on_promotion"),
        rounded["avg_discount_percent"].alias("avg_discount_pct"),
        as_is["page_views"], as_is["unique_visitors"],
        pct("unique_visitors", "page_views").alias("visitor_engagement_pct"),
    ).orderBy(F.col("date").desc_nulls_first(), F.col("net_revenue").desc_nulls_first())
