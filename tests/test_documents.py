"""Nested documents, the flat table, messages and hot items."""

import dataclasses
import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.skew import find_heavy, salted_join
from shelfmark.plans import documents
from shelfmark.schemas import ATTRIBUTES, FULL_PRODUCTS, IMAGES, PRODUCTS, SKUS, Catalog
from shelfmark.sinks import publish
from shelfmark.streaming.flatten import flatten_stream, unmatched

T0 = dt.datetime(2024, 3, 1, 10)
AT = "2024-03-02 00:00:00"


@pytest.fixture(scope="module")
def catalog(spark):
    """Item 1 has 300 SKUs and 200 images, item 2 one of each, item 3 none, item 4 no attributes."""
    products = [(i, f"n{i}", T0, T0, 5, "Active", T0.date()) for i in (1, 2, 3, 4)]
    skus = [(1, n, "s", "h", "active", n % 7, n % 5, D(100 + n), D(0), T0.date()) for n in range(300, 0, -1)]
    skus += [(1, 9, "s", "h", "active", 2, 4, D(109), D(0), T0.date())]  # an exact copy
    skus += [(2, 7, "s", "h", "active", None, 1, D("12.50"), None, T0.date()), (4, 1, "s", "h", "a", 1, 1, D(1), D(0), T0.date())]
    images = [(1, f"u{n:04d}", T0.date()) for n in range(200)] + [(2, "only", T0.date())]
    attributes = [(1, "B", "d", T0.date()), (2, None, "d", T0.date()), (3, "C", "d", T0.date())]
    make = spark.createDataFrame
    return Catalog(make(products, PRODUCTS), make(skus, SKUS), make(images, IMAGES), make(attributes, ATTRIBUTES))


def test_documents(catalog):
    docs = {r.data.id: r for r in documents.product_documents(catalog, AT).collect()}
    assert len(docs) == 4 and {r.part for r in docs.values()} == {0}
    one = docs["1"].data
    assert [s.SkuId for s in one.skus] == list(range(1, 301))
    assert one.images == [f"u{n:04d}" for n in range(200)]
    assert docs["3"].data.skus == [] and docs["3"].data.images == []
    assert docs["4"].data.attributes.brand is None and docs["4"].data.attributes.name == "n4"
    assert docs["1"].timestamp == "2024-03-02T00:00:00" and one.created_time == "2024-03-01T10:00:00"


def test_oversized_product_continues_in_parts(catalog):
    docs = [r for r in documents.product_documents(catalog, AT, page=40).collect()]
    whole = {r.data.id: r.data for r in documents.product_documents(catalog, AT).collect()}
    parts = sorted((r for r in docs if r.data.id == "1"), key=lambda r: r.part)
    assert len(parts) == 8 and [r.part for r in parts] == list(range(8))
    assert {r.parts for r in parts} == {8} and max(len(r.data.skus) for r in parts) < 80
    assert sorted(s for r in parts for s in r.data.skus) == list(whole["1"].skus)
    assert parts[0].data.skus[0] == whole["1"].skus[0]
    assert sorted(u for r in parts for u in r.data.images) == list(whole["1"].images)
    assert parts[0].data.images[0] == "u0000"
    assert {r.data.id: r.part for r in docs if r.data.id != "1"} == {"2": 0, "3": 0, "4": 0}
    flat = flatten_stream(documents.document_json(documents.product_documents(catalog, AT, page=40)))
    assert {(r.item_id, r.image_url, r.price) for r in flat.collect()} == {
        (1, "u0000", D(101)), (2, "only", D("12.50")), (3, None, None), (4, None, D(1))}


@pytest.mark.parametrize("few", [documents.FEW_ITEMS, 0])
def test_parts_follow_distinct_children(spark, catalog, monkeypatch, few):
    """Repeated rows fill no page, children without item number are in no document, both joins agree."""
    monkeypatch.setattr(documents, "FEW_ITEMS", few)
    copies = catalog.skus.filter("item_id = 2").withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("_")
    stray = catalog.skus.filter("item_id = 1").withColumn("item_id", F.lit(None).cast("bigint"))
    skus = catalog.skus.unionByName(copies).unionByName(stray)
    got = documents.product_documents(dataclasses.replace(catalog, skus=skus), AT, page=40)
    want = documents.product_documents(catalog, AT, page=40)
    assert {r.parts for r in got.collect() if r.data.id == "2"} == {1}
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_children_are_shuffled_once(spark, catalog):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = documents.product_documents(catalog, AT)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Products, attributes, SKUs and images: each meets the others after one exchange.
    assert text.count("Exchange hashpartitioning") == 4


def test_message_text(catalog):
    lines = [json.loads(r.value) for r in documents.document_json(documents.product_documents(catalog, AT)).collect()]
    two = next(m for m in lines if m["data"]["id"] == "2")
    assert two == {"timestamp": "2024-03-02T00:00:00", "data": {
        "id": "2", "name": "n2", "created_time": "2024-03-01T10:00:00", "updated_time": "2024-03-01T10:00:00",
        "primary_category": 5, "status": "Active", "images": ["only"],
        "skus": [{"SkuId": 7, "SellerSku": "s", "ShopSku": "h", "Status": "active", "quantity": None,
                  "Available": 1, "price": 12.5, "special_price": None}],
        "attributes": {"name": "n2", "brand": None, "description": "d"}}, "part": 0, "parts": 1}


def test_publish_and_flatten_keep_ids(spark, catalog, tmp_path):
    publish.publish_products(documents.product_documents(catalog), "text", {"path": str(tmp_path / "out")})
    flat = flatten_stream(spark.read.text(str(tmp_path / "out")))
    assert sorted(r.item_id for r in flat.collect()) == [1, 2, 3, 4]
    publish.publish_snapshot(catalog, "text", {"path": str(tmp_path / "snap")})
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "snap")).collect()]
    assert len(rows) == 4 + 303 + 201 + 3
    image = next(r for r in rows if r["table"] == "images" and r["row"]["item_id"] == 2)
    assert image["row"] == {"item_id": 2, "image_url": "only", "created_date": "2024-03-01"}


def test_both_envelopes(spark):
    v0 = {"product": {"item_id": 5, "name": "n", "created_time": "2024-03-01T10:00:00", "primary_category": 1,
                      "status": "A"}, "skus": [{"item_id": 5, "sku_id": 1, "price": 2.5, "quantity": 3}],
          "images": [{"item_id": 5, "image_url": "u"}], "attributes": {"brand": "B"}}
    v1 = {"timestamp": "2024-03-01T10:00:00.000001", "data": {"id": "6", "name": "m", "skus": [], "images": [],
                                                             "created_time": "2024-03-01T10:00:00"}}
    df = spark.createDataFrame([(json.dumps(v0),), (json.dumps(v1),), ("nonsense",), ("{}",), (None,),
                                ('{"data":{"id":"x"}}',)], "value string")
    rows = {r.item_id: r for r in flatten_stream(df).collect()}
    assert set(rows) == {5, 6}
    assert (rows[5].price, rows[5].quantity, rows[5].image_url, rows[5].brand) == (D("2.50"), 3, "u", "B")
    assert rows[6].price is None and rows[6].image_url is None and str(rows[6].created_time) == "2024-03-01 10:00:00"
    assert unmatched(df).count() == 4
    assert [r.item_id for r in flatten_stream(df, "v0").collect()] == [5]
    assert [r.item_id for r in flatten_stream(df, "v1").collect()] == [6]


def test_full_products(catalog):
    plain = documents.full_products(catalog)
    assert plain.columns == FULL_PRODUCTS and plain.count() == 301 * 200 + 1 + 1 + 1
    salted = documents.full_products(catalog, max_rows=30)
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, how):
    left = spark.range(200).select(F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
                                   F.col("id").alias("a"))
    left = left.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) k, id a FROM range(50)"))
    right = spark.range(90).select(F.when(F.col("id") % 2 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
                                   F.col("id").alias("b"))
    right = right.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) k, id b FROM range(50)"))
    want = left.join(right, "k", how)
    got = salted_join(left, right, ["k"], how, find_heavy(left, ["k"], 10), find_heavy(right, ["k"], 10))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
