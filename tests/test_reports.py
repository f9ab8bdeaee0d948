"""Reports on hand-computed rows."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import columns, series
from shelfmark.plans import reports
from shelfmark.schemas import ATTRIBUTES, IMAGES, PRODUCTS, SKUS, Catalog
from shelfmark.sources import generators

T0 = dt.datetime(2024, 3, 1, 10)


def product(item, category=1, created=T0, name="n"):
    return (item, name, created, created, category, "Active", created.date())


def sku(item, number, quantity=10, price=100, special=0):
    return (item, number, "s", "h", "active", quantity, quantity, D(price),
            None if special is None else D(special), T0.date())


@pytest.fixture(scope="module")
def catalog(spark):
    day = dt.timedelta(days=1)
    products = [product(1), product(2), product(3), product(4, category=2), product(5, category=None),
                product(6, category=3), product(7, created=T0 + 3 * day), product(8, created=T0 + 4 * day)]
    skus = [sku(1, 1, 10, 100000), sku(1, 2, 11, 100001), sku(2, 1, 25, 200000, 150000),
            sku(2, 7, 26, 500000, None), sku(4, 1, 50, 1000000, 900000), sku(4, 2, 51, 1000001),
            sku(5, 1, 100, 10), sku(7, 1, None, 0), sku(8, 1, 101, 100, 200), sku(7, 2, 4, 300, 120)]
    images = [(1, "u1", T0.date()), (1, "u2", T0.date()), (2, "u1", T0.date())]
    attributes = [(1, "B", "x" * 501, T0.date()), (2, "A", "y", T0.date()), (4, "A", None, T0.date()),
                  (7, "A", "z", T0.date()), (8, "A", "z", T0.date()), (5, None, "z", T0.date())]
    make = spark.createDataFrame
    return Catalog(make(products, PRODUCTS), make(skus, SKUS), make(images, IMAGES),
                   make(attributes, ATTRIBUTES))


def test_category_analytics(catalog):
    rows = {r.primary_category: r for r in reports.category_analytics(
        catalog.products, catalog.skus, catalog.images, catalog.attributes).collect()}
    assert set(rows) == {1, 2}  # the NULL category and the one without SKUs are dropped
    r = rows[1]
    assert (r.total_products, r.total_skus) == (4, 3)  # SKU ids 1, 2, 7
    assert r.total_images == 3 and r.products_with_images == 2 and r.avg_images_per_product == D("1.50")
    assert r.most_common_brand == "A" and r.unique_brands == 2 and r.detailed_descriptions == 1
    assert r.total_inventory == 10 + 11 + 25 + 26 + 101 + 4
    assert r.low_stock_items == 3 and r.high_stock_items == 1
    assert r.items_on_sale == 3 and r.sale_items_percentage == D("75.00")
    assert rows[2].avg_images_per_product is None and rows[2].total_images == 0


def test_sku_ids_counted_by_sketch(catalog):
    exact, about = ({r.primary_category: r.total_skus for r in reports.category_analytics(
        catalog.products, catalog.skus, catalog.images, catalog.attributes, approx=a).collect()} for a in (False, True))
    assert about == exact  # a sketch is exact for so few


def test_mode_takes_lowest_of_tied(spark, catalog):
    attributes = spark.createDataFrame([(1, "B", "", T0.date()), (2, "A", "", T0.date())], ATTRIBUTES)
    rows = reports.category_analytics(catalog.products, catalog.skus, catalog.images, attributes).collect()
    assert {r.primary_category: r.most_common_brand for r in rows} == {1: "A", 2: None}


def test_distributions(catalog):
    rows = {(r.metric_type.split()[0], r.range_bucket): r for r in
            reports.distributions(catalog.products, catalog.skus).collect()}
    counts = {k: r["count"] for k, r in rows.items()}
    assert counts == {
        ("Price", "0-100k"): 5, ("Price", "100k-200k"): 2, ("Price", "200k-500k"): 1,
        ("Price", "500k-1M"): 1, ("Price", "Over 1M"): 1,
        ("Stock", "0-10"): 2, ("Stock", "11-25"): 2, ("Stock", "26-50"): 2, ("Stock", "51-100"): 2,
        ("Stock", "Over 100"): 2,  # a NULL quantity falls to the last bucket
        ("Discount", "No Discount"): 6, ("Discount", "1-10%"): 2, ("Discount", "11-25%"): 1,
        ("Discount", "Over 50%"): 1,
    }
    for metric in ("Price", "Stock", "Discount"):
        assert sum(n for (m, _), n in counts.items() if m == metric) == 10
    assert rows["Discount", "No Discount"].total_quantity == 0


@pytest.mark.parametrize("price,special,label", [
    (100, 90, "1-10%"), ("100", "89.99", "11-25%"), ("100000", "89995.01", "1-10%"), ("100000", "89995", "11-25%"),
    (100, 75, "11-25%"), (100, 50, "26-50%"), (100, 40, "Over 50%"), (100, 0, "No Discount"),
    (100, None, "No Discount"), ("100000", "99996", "No Discount"), ("100000", "99995", "1-10%"),
    (0, 5, "Over 50%"), (100, 200, "1-10%"),
])
def test_discount_buckets_agree(spark, price, special, label):
    row = spark.createDataFrame([(D(price), None if special is None else D(special))],
                                "price decimal(18,2), special_price decimal(18,2)")
    got = row.select(columns.discount_range().alias("a"),
                     columns.discount_bucket(columns.discount_pct()).alias("b")).first()
    assert (got.a, got.b) == (label, label)


def test_kpi_and_roi(catalog):
    rows = reports.brand_kpi_impact(catalog.products, catalog.skus, catalog.attributes).collect()
    assert [r.impact_category for r in rows] == sorted(r.impact_category for r in rows)
    sales = [r for r in rows if r.metric_name == "Actual Revenue"]
    # Zero counts as a sale price by default: brand B sells at 0.
    assert min(r.value for r in sales) == 0
    guarded = reports.brand_kpi_impact(catalog.products, catalog.skus, catalog.attributes, True).collect()
    assert min(r.value for r in guarded if r.metric_name == "Actual Revenue") > 0
    roi = {(r.brand, r.primary_category): r for r in
           reports.brand_roi(catalog.products, catalog.skus, catalog.attributes).collect()}
    assert roi["B", 1].roi_percentage == D("-100.00") and roi["B", 1].units_per_product == D("21.00")


def test_daily_revenue_growth_is_by_previous_row(catalog):
    rows = reports.daily_brand_revenue(catalog.products, catalog.skus, catalog.attributes,
                                       "2024-03-31 00:00:00").collect()
    a = sorted((r for r in rows if r.brand == "A"), key=lambda r: r.sale_date)
    assert [r.sale_date.day for r in a] == [1, 4, 5]
    assert a[0].revenue_growth_pct == 0 and a[0].sales_growth_pct == 0
    assert a[1].gross_revenue == 1200 and a[1].total_discounts == 4 * 180
    assert a[2].revenue_growth_pct == D("741.67")  # (10100 - 1200) / 1200
    cut = reports.daily_brand_revenue(catalog.products, catalog.skus, catalog.attributes,
                                      "2024-03-31 00:00:00", integer_growth=True).collect()
    b = sorted((r for r in cut if r.brand == "A"), key=lambda r: r.sale_date)
    assert (a[2].sales_growth_pct, b[2].sales_growth_pct) == (D("2425.00"), D("2400.00"))
    assert [r.sale_date for r in rows] == sorted((r.sale_date for r in rows), reverse=True)


def test_trailing_window_edges(catalog):
    def days(as_of):
        return reports.daily_brand_revenue(catalog.products, catalog.skus, catalog.attributes, as_of).count()
    assert days("2024-03-31 10:00:00") == 5  # created exactly 30 days before: inside
    assert days("2024-03-31 10:00:01") == 2
    assert days("2024-03-01 09:59:59") == 0


def test_trend_fills_gaps(spark):
    facts = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1, 0), 2, 4, D(100), D(80), D(25), 1),
         ("a", dt.datetime(2024, 1, 1, 2), 1, 1, D(50), D(40), D(50), 0)],
        "brand string, time_bucket timestamp, products_count bigint, total_units bigint, "
        "gross_revenue decimal(18,2), actual_revenue decimal(18,2), avg_price decimal(18,2), items_on_sale bigint")
    rows = reports.hourly_brand_trend(facts, "2024-01-02 00:00:00", days=1).collect()
    assert len(rows) == 25
    by_hour = {r.time_bucket: r for r in rows}
    gap = by_hour[dt.datetime(2024, 1, 1, 1)]
    assert gap.units_sold == 0 and gap.discount_rate_pct is None and gap.average_price is None
    assert gap.revenue_growth_pct == D("-100.00") and gap.revenue_24h_ma == D("50.00")
    after = by_hour[dt.datetime(2024, 1, 1, 2)]
    assert after.revenue_growth_pct is None and after.units_24h_ma == D("1.67")
    assert by_hour[dt.datetime(2024, 1, 1)].revenue_growth_pct is None
    # 24 rows back from hour 24 leave hour 0 out
    assert by_hour[dt.datetime(2024, 1, 2)].revenue_24h_ma == D("2.08")


def test_seed_shaped_catalog(spark):
    n = generators.number_series(spark, 1001)
    date = F.lit("2024-01-01").cast("date").alias("created_date")
    products = n.select(F.col("n").alias("item_id"), F.concat(F.lit("Item "), F.col("n")).alias("name"),
                        F.lit(417).alias("primary_category"), date)
    skus = n.select(F.col("n").alias("item_id"), F.col("n").alias("sku_id"), F.lit(100).alias("quantity"),
                    F.lit(250000).cast("decimal(18,2)").alias("price"),
                    F.lit(0).cast("decimal(18,2)").alias("special_price"))
    images = generators.image_variants(
        n.select(F.col("n").alias("item_id"), F.concat(F.lit("u"), F.col("n")).alias("image_url")), ["-l", "-s"])
    labels = [f"brand {i}" for i in range(10)]
    attributes = n.select(F.col("n").alias("item_id"), columns.cycle_label("n", labels).alias("brand"),
                          F.lit("text").alias("description"))
    r = reports.category_analytics(products, skus, images, attributes).first()
    assert (r.total_products, r.total_images, r.unique_brands) == (1001, 2002, 10)
    assert r.inventory_value == 1001 * 100 * 250000 and r.most_common_brand == "brand 1"


def test_ratio_is_exact(spark):
    cases = [(1, 3, "0.33"), (-1, 3, "-0.33"), (5, 2, "2.50"), (1, 200, "0.01"), (-1, 200, "-0.01"),
             (1, -200, "-0.01"), (7, 0, None), (12345, 1000, "12.35"), (None, 2, None)]
    df = spark.createDataFrame(cases, "n bigint, d bigint, want string")
    for r in df.select(columns.ratio("n", "d").alias("got"), "want").collect():
        assert r.got == (None if r.want is None else D(r.want))


def test_wide_sum_passes_bigint(spark):
    big = 2**62
    df = spark.createDataFrame([(1, v) for v in (big, big, big, -5)] + [(2, -1), (2, -(2**40))], "k int, v bigint")
    got = {r.k: r.s for r in df.groupBy("k").agg(columns.wide_sum(F.col("v")).alias("s")).collect()}
    assert got == {1: 3 * big - 5, 2: -1 - 2**40}


def test_small_functions(spark):
    row = spark.sql("SELECT '1709287204738' ms, timestamp'2024-01-01 06:00:00' t, "
                    "timestamp'2024-01-01 06:00:00.000120' u, 2.5D x, 3.5D y, array() e").select(
        columns.epoch_ms("ms").cast("string").alias("ms"), columns.iso_text("t").alias("t"),
        columns.iso_text("u").alias("u"), columns.whole_number("x").alias("x"), columns.whole_number("y").alias("y"),
        columns.hour_of_day_cycle("t").alias("c"), columns.first_element("e").alias("e"),
        columns.epoch_ms(F.lit("soon")).alias("bad")).first()
    assert row.ms == "2024-03-01 10:00:04" and row.bad is None and row.e is None
    assert row.t == "2024-01-01T06:00:00" and row.u == "2024-01-01T06:00:00.000120"
    assert (row.x, row.y) == (2, 4) and row.c == pytest.approx(1.0)


def test_previous_of_single_row(spark):
    one = spark.createDataFrame([("a", 1, 5)], "k string, t int, v int")
    r = series.with_previous(one, ["v"], ["k"], "t").select(
        series.growth_pct("v", "prev_v").alias("zero"), series.growth_pct("v", "prev_v", first=None).alias("none")).first()
    assert r.zero == 0 and r.none is None
