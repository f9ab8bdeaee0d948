"""Registered queries: each takes the session and a folder of tables and returns a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import series
from shelfmark.functions.columns import (
    PRICE_BOUNDS, PRICE_LABELS, bucket, cycle_label, hour_of_day_cycle, on_sale, whole_number,
)
from shelfmark.operators import checks, gaps, merge
from shelfmark.plans import documents, indicators, reports
from shelfmark.session import checkpoint_root
from shelfmark.sinks import load
from shelfmark.sinks.publish import snapshot_messages
from shelfmark.sources import generators, pages, readers
from shelfmark.streaming import resumed
from shelfmark.streaming.flatten import flatten_stream
from shelfmark.workload import mapping as m

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def edge(df: DataFrame) -> DataFrame:
    """Plain types for comparison: doubles for decimals, naive timestamps, ISO text for dates."""
    def plain(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = lambda spark, sf_dir: edge(fn(spark, sf_dir))
    return fn


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in names})


# --- reports ---------------------------------------------------------------------------------

@query
def category_analytics(spark, sf):
    return reports.category_analytics(m.products(spark, sf), m.skus(spark, sf), m.images(spark, sf),
                                      m.attributes(spark, sf))


@query
def brand_kpi_impact(spark, sf):
    return reports.brand_kpi_impact(m.products(spark, sf), m.skus(spark, sf), m.attributes(spark, sf))


@query
def brand_kpi_impact_guarded(spark, sf):
    return reports.brand_kpi_impact(m.products(spark, sf), m.skus(spark, sf), m.attributes(spark, sf),
                                    zero_is_no_sale=True)


@query
def brand_roi(spark, sf):
    return reports.brand_roi(m.products(spark, sf), m.skus(spark, sf), m.attributes(spark, sf))


@query
def distributions(spark, sf):
    return reports.distributions(m.products(spark, sf), m.skus(spark, sf))


@query
def daily_brand_revenue(spark, sf):
    return reports.daily_brand_revenue(m.products(spark, sf), m.skus(spark, sf), m.attributes(spark, sf),
                                       as_of="1995-03-31", days=30)


def _span(df: DataFrame, column: Column) -> tuple[Column, int]:
    """Last value of a time column, as a constant of the plan, and whole days that reach back to the first."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return F.lit(high).cast("timestamp"), 0 if low is None else (high - low).days + 1


def _all_days(spark: SparkSession, sf: str) -> dict[str, Column | int]:
    """Span of all products: they are created on their first line's day."""
    as_of, days = _span(m.table(spark, sf, "lineitem"), F.col("l_shipdate").cast("timestamp"))
    return {"as_of": as_of, "days": days}


@query
def daily_brand_revenue_all(spark, sf):
    return reports.daily_brand_revenue(m.products(spark, sf), m.skus(spark, sf), m.attributes(spark, sf),
                                       **_all_days(spark, sf))


@query
def daily_brand_revenue_integer_growth(spark, sf):
    return reports.daily_brand_revenue(m.products(spark, sf), m.skus(spark, sf), m.attributes(spark, sf),
                                       integer_growth=True, **_all_days(spark, sf))


@query
def hourly_brand_trend(spark, sf):
    facts = m.hourly_facts(spark, sf)
    return reports.hourly_brand_trend(facts, as_of="2024-01-31", days=7)


@query
def hourly_brand_trend_all(spark, sf):
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    as_of, days = _span(m.table(spark, sf, "events"), hour)
    return reports.hourly_brand_trend(m.hourly_facts(spark, sf), as_of, days)


def _ends(df: DataFrame, column: Column) -> tuple[Column, Column]:
    """First and last value of a column, as constants of the plan."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return F.lit(low), F.lit(high)


@query
def brand_scorecard(spark, sf):
    start, end = _ends(m.table(spark, sf, "lineitem"), F.to_date("l_shipdate"))
    members = m.table(spark, sf, "part").select(F.col("p_brand").alias("brand")).distinct()
    return reports.brand_scorecard(m.daily_facts(spark, sf, start), start, end, members)


# --- tables and documents --------------------------------------------------------------------

@query
def full_products(spark, sf):
    return documents.full_products(m.catalog(spark, sf))


PUBLISHED = "2024-01-31 00:00:00"


@query
def product_documents_flat(spark, sf):
    docs = documents.product_documents(m.catalog(spark, sf), PUBLISHED)
    d = docs.select("data.*", F.col("part").cast("bigint").alias("part"))

    def text(*columns):
        return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in columns])

    def entry(kind, pos, value):
        return F.struct(F.lit(kind).alias("kind"), pos.cast("int").alias("pos"), value.alias("value"))

    header = F.array(entry("header", F.lit(0), text(*[F.col(c) for c in (
        "name", "created_time", "updated_time", "primary_category", "status", "attributes.brand",
        "attributes.description")])))
    keys = ("SkuId", "SellerSku", "ShopSku", "Status", "quantity", "Available", "price", "special_price")
    skus = F.transform("skus", lambda s, i: entry("sku", i, text(*[s[k] for k in keys])))
    urls = F.transform("images", lambda u, i: entry("image", i, u))
    return d.select("id", "part", F.inline(F.concat(header, skus, urls)))


@query
def flatten_stream_batch(spark, sf):
    docs = documents.product_documents(m.catalog(spark, sf), PUBLISHED)
    return flatten_stream(documents.document_json(docs)).drop("processing_time")


def _pages(spark, sf, spoilt: bool = False) -> tuple[DataFrame, DataFrame]:
    """Products of API pages of the catalog, twenty to a page, and the rejected ones.

    With `spoilt` products of large categories carry their name as creation time, and those of one type
    lack their attributes.
    """
    data = documents.product_documents(m.catalog(spark, sf), PUBLISHED).select("data.*", "part")
    millis = {c: (F.unix_seconds(F.col(c).cast("timestamp")) * 1000 + 738).cast("string")
              for c in ("created_time", "updated_time")}
    product = data.withColumn("item_id", F.col("id").cast("bigint")).withColumns(millis)
    if spoilt:
        product = product.withColumns({
            "created_time": F.when(F.col("primary_category") > 45, F.col("name")).otherwise(F.col("created_time")),
            "attributes": F.when(F.col("status") != "ECONOMY", F.col("attributes"))})
    body = F.struct("created_time", "updated_time", "images", "skus", "item_id", "primary_category",
                    "attributes", "status")
    page = F.floor(F.col("item_id") / 20).alias("page")
    listed = product.groupBy(page, "part").agg(F.collect_list(body).alias("products"))
    text = F.to_json(F.struct(F.struct(F.size("products").alias("total_products"), "products").alias("data")))
    return pages.split_products(readers.products_of_pages(listed.select(text.alias("value"))))


@query
def rejected_products(spark, sf):
    return load.rejected_rows(_pages(spark, sf, spoilt=True)[1]).select("item_id", "reasons")


@query
def normalize_pages_skus(spark, sf):
    return pages.normalize_pages(_pages(spark, sf)[0], "2024-01-31").skus


@query
def normalize_pages_products(spark, sf):
    return pages.normalize_pages(_pages(spark, sf)[0], "2024-01-31").products


@query
def normalize_pages_children(spark, sf):
    c = pages.normalize_pages(_pages(spark, sf)[0], "2024-01-31")
    images = c.images.select("item_id", F.lit("image").alias("kind"), F.col("image_url").alias("value"))
    brand = c.attributes.select("item_id", F.lit("brand").alias("kind"), F.col("brand").alias("value"))
    return images.unionByName(brand)


@query
def snapshot_rows(spark, sf):
    """Published table rows, read back from their messages."""
    rows = snapshot_messages(m.catalog(spark, sf))
    fields = ["item_id", "sku_id", "image_url", "brand", "price", "created_time"]
    return rows.select("table", F.json_tuple("value", *fields).alias(*fields)).withColumns(
        {"item_id": F.col("item_id").cast("bigint"), "sku_id": F.col("sku_id").cast("bigint"),
         "price": F.col("price").cast("double")})


# --- merges and checks -----------------------------------------------------------------------

ORDER = ["l_shipdate", "l_extendedprice"]
SKU_KEYS = ["item_id", "sku_id"]


def _returned(versions: DataFrame) -> DataFrame:
    return versions.filter("l_returnflag = 'R'").withColumns(
        {"status": F.lit("returned"), "quantity": F.lit(0)})


@query
def upsert_skus(spark, sf):
    versions = m.sku_versions(spark, sf)
    target = series.latest_by(versions, SKU_KEYS, ORDER).drop(*ORDER, "l_returnflag")
    return merge.upsert(target, _returned(versions), SKU_KEYS, ORDER)


@query
def replace_children_skus(spark, sf):
    versions = m.sku_versions(spark, sf)
    target = versions.drop(*ORDER, "l_returnflag")
    late = versions.filter(F.col("l_shipdate") >= F.lit("2001-10-15").cast("timestamp_ntz"))
    return merge.replace_children(target, late.withColumn("status", F.lit("new")))


@query
def insert_missing_images(spark, sf):
    target = m.images(spark, sf)
    updates = m.table(spark, sf, "pages").select(
        F.call_function("div", F.col("page_id"), F.lit(3)).alias("item_id"), F.col("url").alias("image_url"),
        F.date_add(F.lit("2024-02-01").cast("date"), (F.col("page_id") % 5).cast("int")).alias("created_date"))
    return merge.insert_missing(target, updates, ["item_id", "image_url"], ["created_date"])


@query
def upsert_image_dates(spark, sf):
    target = series.latest_by(m.images(spark, sf), ["item_id", "image_url"], ["created_date"])
    updates = m.table(spark, sf, "pages").select(
        F.call_function("div", F.col("page_id"), F.lit(3)).alias("item_id"), F.col("url").alias("image_url"),
        F.date_add(F.lit("2024-02-01").cast("date"), (F.col("page_id") % 5).cast("int")).alias("created_date"))
    return merge.upsert(target, updates, ["item_id", "image_url"], ["created_date"])


@query
def check_key_skus(spark, sf):
    return checks.check_key(m.skus(spark, sf), SKU_KEYS)


@query
def check_reference_images(spark, sf):
    """SKU rows of items that have no image."""
    return checks.check_reference(m.skus(spark, sf), m.images(spark, sf).select("item_id").distinct(), "item_id")


@query
def check_lengths_images(spark, sf):
    found = checks.check_lengths(m.images(spark, sf), {"image_url": 40})
    return found.withColumn("too_long", F.array_join("too_long", ","))


def _listing_rules() -> dict:
    return {"long name": F.length("name") > 10, "no sales": F.col("created_time").isNull(),
            "large category": F.col("primary_category") > 45}


@query
def split_bad_products(spark, sf):
    _, bad = merge.split_bad(m.products(spark, sf), _listing_rules())
    return bad.select("item_id", "name", F.array_join("reasons", ",").alias("reasons"))


@query
def drop_children_skus(spark, sf):
    _, bad = merge.split_bad(m.products(spark, sf), _listing_rules())
    return merge.drop_children(m.skus(spark, sf), bad).select("item_id", "sku_id", "quantity")


# --- projections -----------------------------------------------------------------------------

@query
def bucket_prices(spark, sf):
    return m.skus(spark, sf).groupBy(bucket("price", PRICE_BOUNDS, PRICE_LABELS).alias("price_range")).agg(
        F.count("*").alias("n"))


@query
def sku_discounts(spark, sf):
    """Bucket, percent and flag of every SKU row."""
    return reports.sku_ranges(m.skus(spark, sf)).select(
        "item_id", "sku_id", "price_range", "stock_range", "discount_percentage", "discount_range",
        "is_discounted")


@query
def image_variants(spark, sf):
    return generators.image_variants(m.images(spark, sf).drop("created_date"), ["?size=large", "?size=small"])


@query
def label_cycle(spark, sf):
    names = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]
    return m.table(spark, sf, "part").groupBy(cycle_label("p_partkey", names).alias("label")).agg(
        F.count("*").alias("n"), F.max(F.concat(F.lit("SKU-"), F.col("p_partkey"))).alias("last_name"))


@query
def hour_cycle(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return m.table(spark, sf, "events").groupBy(F.hour(ts).cast("bigint").alias("hour"), F.round(
        hour_of_day_cycle(ts), 9).alias("cycle")).agg(F.count("*").alias("n"))


@query
def whole_units(spark, sf):
    """Fractions to whole numbers, half to even."""
    return m.table(spark, sf, "events").select("event_id", whole_number(F.col("event_id") / 2).alias("units"))


@query
def infer_schema_props(spark, sf):
    return readers.infer_table_schema(m.table(spark, sf, "events"), "props")


@query
def page_slice(spark, sf):
    listed = m.products(spark, sf).select("item_id", "name", "primary_category")
    return readers.page_slice(listed, ["item_id"], page=3)


@query
def recent_points(spark, sf):
    return readers.recent(m.price_points(spark, sf), "2024-01-30 12:00:00", hours=36).drop("name")


# --- series ----------------------------------------------------------------------------------

def _series(spark, sf) -> DataFrame:
    return m.price_points(spark, sf).drop("name", "quantity")


@query
def sma_7(spark, sf):
    return rounded(series.sma(_series(spark, sf)), "sma_7")


@query
def sma_7d(spark, sf):
    return rounded(series.sma_days(_series(spark, sf)), "sma_7d")


@query
def ema_14(spark, sf):
    return rounded(series.ema(_series(spark, sf)), "ema_14")


@query
def rsi_14_cutler(spark, sf):
    return rounded(series.rsi(_series(spark, sf), method="cutler"), "rsi_14")


@query
def rsi_14_wilder(spark, sf):
    return rounded(series.rsi(_series(spark, sf)), "rsi_14")


@query
def price_changes(spark, sf):
    return series.price_changes(_series(spark, sf))


@query
def price_indicators(spark, sf):
    out = indicators.price_indicators(m.price_points(spark, sf))
    return rounded(out, "sma_7", "ema_14", "rsi_14")


def _instants(spark, sf) -> DataFrame:
    return series.latest_by(_series(spark, sf), ["item_id", "timestamp"], ["event_id"]).drop("event_id")


@query
def changes_1h(spark, sf):
    return series.changes_in(_instants(spark, sf), "1 hour", "changes_1h")


@query
def rate_5m(spark, sf):
    return rounded(series.rate_in(_instants(spark, sf), "5 minutes", "rate_5m"), "rate_5m")


@query
def pct_change_5m(spark, sf):
    return rounded(series.pct_change_in(_instants(spark, sf), "5 minutes", "pct_change_5m"), "pct_change_5m")


@query
def window_measures_3d(spark, sf):
    out = series.in_window(_instants(spark, sf), "3 days", ["changes", "rate", "pct_change"])
    return rounded(out, "rate", "pct_change")


@query
def held_for_10m(spark, sf):
    points = m.price_points(spark, sf).drop("name")
    return series.held_for(points, F.col("quantity") < 50, "10 minutes")


@query
def latest_by_item(spark, sf):
    return series.latest_by(m.price_points(spark, sf), ["item_id"], ["timestamp", "event_id"])


def _labelled(samples: DataFrame) -> DataFrame:
    labels = {c: F.try_element_at("labels", F.lit(c)) for c in ("item_id", "name", "period")}
    return rounded(samples.withColumns(labels).drop("labels"), "value")


@query
def metric_samples(spark, sf):
    return _labelled(indicators.metric_samples(indicators.price_indicators(m.price_points(spark, sf))))


@query
def metric_gauges(spark, sf):
    samples = indicators.metric_samples(indicators.price_indicators(m.price_points(spark, sf)))
    return _labelled(indicators.gauges(samples))


@query
def metric_panel_sma(spark, sf):
    sma = series.sma(m.price_points(spark, sf))
    return _labelled(indicators.panel(indicators.metric_samples(sma, ["price_sma"]), "price_sma", "7d"))


@query
def evaluate_alerts(spark, sf):
    return rounded(indicators.alerts(m.price_points(spark, sf)), "value", "rate_5m")


WIDE_RULES = (
    indicators.Rule("ProductPriceSpike", "warning", "pct_change_5m > 20", "pct_change_5m", "12 hours"),
    indicators.Rule("LowInventory", "warning", "quantity < 40", "quantity", "10 hours"),
    indicators.Rule("PriceVolatility", "warning", "changes_1h > 5", "changes_1h", "1 day"),
    indicators.Rule("TechnicalIndicatorAlert", "info", "rsi_14 > 55 OR rsi_14 < 45", "rsi_14", "30 minutes"),
)


@query
def evaluate_alerts_wide(spark, sf):
    """The same rules with windows that suit samples some hours apart."""
    out = indicators.alerts(m.price_points(spark, sf), WIDE_RULES, short="2 days", long="4 days")
    return rounded(out, "value", "rate_5m")


def _in_batches(points: DataFrame) -> list[DataFrame]:
    """All points as a stream would bring them: half of the span, the rest, and what was late of both."""
    lo, hi = points.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    if lo is None:
        return []
    late = F.hour("timestamp") == 3
    second = F.unix_micros("timestamp") > (lo + hi) // 2
    return [points.filter(~late & ~second), points.filter(~late & second), points.filter(late)]


def _resumed(spark, sf, rules, short: str, long: str):
    """The store after all batches, and what each batch returned."""
    points = m.price_points(spark, sf)
    store = resumed.open_store(spark, f"{checkpoint_root(spark).rstrip('/')}/resumed-{uuid.uuid4().hex}", points.schema, rules, buckets=4)
    out = [resumed.advance(store, batch, n, rules, short, long) for n, batch in enumerate(_in_batches(points))]
    return store, [df.withColumn("_batch", F.lit(n)) for n, df in enumerate(out) if df is not None]


@query
def indicators_resumed(spark, sf):
    """Indicators of points that came in three batches, the last one late, each from stored state."""
    _, parts = _resumed(spark, sf, indicators.RULES, "5 minutes", "1 hour")
    if not parts:
        return rounded(indicators.price_indicators(m.price_points(spark, sf)), "sma_7", "ema_14", "rsi_14")
    every = reduce(DataFrame.unionByName, parts)
    return rounded(series.latest_by(every, ["event_id"], ["_batch"]).drop("_batch"), "sma_7", "ema_14", "rsi_14")


@query
def alerts_resumed(spark, sf):
    """Alerts as they stand after three batches, the last one late: what it undoes is withdrawn."""
    store, _ = _resumed(spark, sf, WIDE_RULES, "2 days", "4 days")
    return rounded(resumed.read_alerts(store).drop("fired_at"), "value", "rate_5m")


# --- spines ----------------------------------------------------------------------------------

@query
def time_spine(spark, sf):
    """Events of every hour from the first to the last."""
    hours = m.table(spark, sf, "events").groupBy(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("stamp")).agg(F.count("*").alias("n"))
    ends = hours.agg(F.min("stamp").alias("lo"), F.max("stamp").alias("hi"))
    stamps = ends.select(generators.spine(F.col("lo"), F.col("hi"), "1 hour").alias("stamp"))
    return stamps.join(hours, "stamp", "left").select("stamp", F.coalesce("n", F.lit(0)).alias("n"))


@query
def number_series(spark, sf):
    """Parts of every size from 1 to the largest."""
    part = m.table(spark, sf, "part")
    top = part.agg(F.max("p_size")).first()[0]
    sizes = part.groupBy(F.col("p_size").cast("bigint").alias("n")).agg(F.count("*").alias("parts"))
    return generators.number_series(spark, top).join(sizes, "n", "left").select(
        "n", F.coalesce("parts", F.lit(0)).alias("parts"))


@query
def densify(spark, sf):
    """Users of each event type by hour from the first to the last, zero where there was none."""
    facts = m.hourly_facts(spark, sf).select("brand", "time_bucket", "products_count")
    kinds = facts.select("brand").distinct()
    start, end = _ends(facts, F.col("time_bucket"))
    return gaps.densify(facts, "time_bucket", ["brand"], start, end, "1 hour", ["products_count"], kinds)


@query
def moving_average_24(spark, sf):
    hourly = m.hourly_facts(spark, sf).select("brand", "time_bucket", "total_units")
    return rounded(series.moving_avg(hourly, "total_units", ["brand"], "time_bucket", 24, "units_ma"), "units_ma")
