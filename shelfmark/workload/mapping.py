"""The given tables as a product catalog. Whole-number arithmetic, so two engines agree exactly.

Prices are in minor units. Only the columns a query uses are read; the creation times are the one
derived value that needs an aggregation, and it is planned only where a report asks for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions.columns import pct, ratio, wide_sum
from shelfmark.operators.medians import median_of
from shelfmark.schemas import ATTRIBUTES, IMAGES, PRODUCTS, SKUS, Catalog, conform


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: str) -> Column:
    """Hundredths of a non-negative amount; `round` on doubles goes through text and is slow."""
    return F.floor(F.col(amount) * 100 + 0.5)


def sku_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their price and sale price in minor units."""
    pieces = F.col("l_quantity").cast("int")
    line = table(spark, sf_dir, "lineitem").withColumns({
        "quantity": pieces,
        "price": F.call_function("div", cents("l_extendedprice"), pieces),
        "off": cents("l_discount").cast("int"),
    })
    reduced = F.call_function("div", F.col("price") * (100 - F.col("off")), F.lit(100))
    return line.withColumn("special_price", F.when(F.col("off") > 0, reduced).otherwise(0))


def _sku_columns() -> list[Column]:
    item, sku = F.col("l_partkey"), F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return [
        item.alias("item_id"), sku.alias("sku_id"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("seller_sku"),
        F.concat(item, F.lit("-"), sku).alias("shop_sku"),
        F.col("l_linestatus").alias("status"),
        F.col("quantity"), F.col("quantity").alias("available"), F.col("price"),
        F.col("special_price"), F.to_date("l_shipdate").alias("created_date"),
    ]


def skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(sku_lines(spark, sf_dir).select(*_sku_columns()), SKUS)


def sku_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU rows with the columns that order rows of one key, and the return flag."""
    rows = sku_lines(spark, sf_dir).select(*_sku_columns(), "l_shipdate", "l_extendedprice", "l_returnflag")
    money = {c: F.col(c).cast("decimal(18,2)") for c in ("price", "special_price")}
    return rows.withColumns(money)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.min("l_shipdate").cast("timestamp").alias("created_time"),
        F.max("l_shipdate").cast("timestamp").alias("updated_time"))
    part = table(spark, sf_dir, "part")
    return conform(part.join(times, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"),
        "created_time", "updated_time",
        F.col("p_size").alias("primary_category"), F.col("p_type").alias("status"),
        F.to_date("created_time").alias("created_date"),
    ), PRODUCTS)


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "pages").select(
        F.call_function("div", F.col("page_id"), F.lit(2)).alias("item_id"),
        F.col("url").alias("image_url"), F.lit("2024-01-31").alias("created_date"),
    ), IMAGES)


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("brand"),
        F.col("p_type").alias("description"), F.lit("2024-01-31").alias("created_date"),
    ), ATTRIBUTES)


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(products(spark, sf_dir), skus(spark, sf_dir), images(spark, sf_dir),
                   attributes(spark, sf_dir))


def event_number() -> Column:
    """The number inside the event properties."""
    return F.get_json_object("props", "$.k").cast("int")


def price_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("item_id"), F.concat(F.lit("item "), F.col("user_id")).alias("name"),
        F.col("value").alias("price"), event_number().alias("quantity"),
        F.col("ts").cast("timestamp").alias("timestamp"), "event_id")


def hourly_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as brands, cents as revenue, `k % 30` as discount percent.

    Users are counted by grouping twice, which spreads a hot brand over its users.
    """
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("brand"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("time_bucket"), "user_id",
        cents("value").alias("cents"),
        (event_number() % 30).alias("off"))
    actual = F.call_function("div", F.col("cents") * (100 - F.col("off")), F.lit(100))
    by_user = events.groupBy("brand", "time_bucket", "user_id").agg(
        F.count("*").alias("units"), F.sum("cents").alias("gross"), F.sum(actual).alias("actual"),
        F.count_if(F.col("off") > 0).alias("on_sale"))
    return by_user.groupBy("time_bucket", "brand").agg(
        F.count("user_id").alias("products_count"),
        F.sum("units").alias("total_units"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("actual").alias("actual_revenue"),
        F.sum("on_sale").alias("items_on_sale"),
        ratio(F.sum("gross"), F.sum("units")).alias("avg_price"))


def daily_facts(spark: SparkSession, sf_dir: str, first_line: Column) -> DataFrame:
    """Daily brand figures of the line items, orders and events.

    Everything that adds up comes from (day, brand, item) rows, whose first and last days come from the
    same rows. Orders and the median need the rows of a brand's day, which the brand join spreads again
    by order and by price. An item's stock is what it sold that day and `p_size` pieces that were left.
    Events belong to the part with the user's number, and their days are moved so that the first event
    falls on `first_line`, the first line day. Orders in state F are fulfilled, those in state P count as cancelled.
    """
    line = sku_lines(spark, sf_dir).select(
        F.to_date("l_shipdate").alias("day"), F.col("l_partkey").alias("item"), "l_orderkey",
        "l_linestatus", "l_returnflag", "quantity", "price", "special_price", "off")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_brand").alias("brand"), F.col("p_size").alias("left_over"))
    q, p, s = F.col("quantity"), F.col("price"), F.col("special_price")
    by_item = line.groupBy("item", "day").agg(
        F.max((F.col("l_linestatus") == "O").cast("int")).alias("active"),
        F.sum("quantity").alias("units"), F.count("*").alias("n"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(q <= 10).alias("low"), F.count_if(q == 1).alias("out"), F.count_if(q > 45).alias("excess"),
        wide_sum(q * p).alias("gross"), wide_sum(F.when(s > 0, q * (p - s)).otherwise(0)).alias("discount"),
        wide_sum(p).alias("price_sum"), F.min(p).alias("min_price"), F.max(p).alias("max_price"),
        F.max((F.col("off") > 0).cast("int")).alias("promo"), F.sum("off").alias("off_sum"))
    of_item = Window.partitionBy("item")
    by_item = by_item.withColumns({"first_day": F.min("day").over(of_item), "last_day": F.max("day").over(of_item)})
    sums = by_item.join(part, "item").groupBy("day", "brand").agg(
        F.count("*").alias("total_products"),
        F.sum("active").alias("active_listings"),
        F.count_if(F.col("day") == F.col("first_day")).alias("new_listings"),
        F.count_if(F.col("day") == F.col("last_day")).alias("removed_listings"),
        F.sum("units").alias("units_sold"), F.sum(F.col("units") + F.col("left_over")).alias("total_stock"),
        F.sum("n").alias("n"), F.sum("returned").alias("returned"),
        F.sum("low").alias("low_stock_items"), F.sum("out").alias("out_of_stock"),
        F.sum("excess").alias("excess_stock"),
        F.sum("gross").alias("gross_revenue"), F.sum("discount").alias("discount_amount"),
        F.sum("price_sum").alias("price_sum"), F.min("min_price").cast("decimal(18,2)").alias("min_price"),
        F.max("max_price").cast("decimal(18,2)").alias("max_price"), F.sum("promo").alias("promo_products"),
        F.sum("off_sum").alias("off_sum"))
    rows = line.join(part, "item")
    states = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    orders = rows.select("day", "brand", "l_orderkey").distinct().join(states, "l_orderkey", "left")
    orders = orders.groupBy("day", "brand").agg(
        F.count("*").alias("orders_count"), F.count_if(F.col("o_orderstatus") == "F").alias("fulfilled"),
        F.count_if(F.col("o_orderstatus") == "P").alias("cancelled"))
    medians = median_of(rows.select("day", "brand", "price"), ["day", "brand"], "price", "median_price")
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "purchase"))
    first_event, = table(spark, sf_dir, "events").agg(F.min(F.to_date("ts"))).first()
    moved = F.date_add(F.to_date("ts"), F.datediff(first_line, F.lit(first_event)))
    visits = events.select(moved.alias("day"), "user_id", "event_type").join(
        part.select(F.col("item").alias("user_id"), "brand"), "user_id")
    visits = visits.groupBy("day", "brand", "user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("v"), F.count_if(F.col("event_type") == "purchase").alias("b"))
    visits = visits.groupBy("day", "brand").agg(
        F.sum("v").alias("page_views"), F.count_if(F.col("v") > 0).alias("unique_visitors"), F.sum("b").alias("purchases"))
    return (
        sums.join(orders, ["day", "brand"], "left").join(medians, ["day", "brand"], "left")
        .join(visits, ["day", "brand"], "left")
        .withColumnRenamed("day", "date_stamp")
        .withColumns({
            "avg_order_size": ratio("units_sold", "orders_count"),
            "net_revenue": F.col("gross_revenue") - F.col("discount_amount"),
            "avg_price": ratio("price_sum", "n"),
            "avg_discount_percent": ratio("off_sum", "n"),
            "conversion_rate": pct("purchases", "page_views"),
            "return_rate": pct("returned", "n"),
            "fulfillment_rate": pct("fulfilled", "orders_count"),
            "cancellation_rate": pct("cancelled", "orders_count"),
        }).drop("price_sum", "off_sum", "n", "returned", "fulfilled", "cancelled", "purchases")
    )
