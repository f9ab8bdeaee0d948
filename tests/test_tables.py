"""Page ingest, merges, checks and versioned tables."""

import json

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import checks, merge
from shelfmark.schemas import KEYS, LENGTH_LIMITS, TABLES
from shelfmark.sinks import files, load, tables
from shelfmark.sources import pages, readers
from shelfmark.streaming.flatten import flatten_stream


def api_product(item, skus=(1,), images=("u1", "u2"), **extra):
    body = {"created_time": "1709287204738", "updated_time": "1709287204927", "images": images if images == "absent" else list(images),
            "skus": [{"Status": "active", "quantity": 100, "SellerSku": "SELL-7", "ShopSku": "x",
                      "special_price": 0, "price": 250000, "Available": 100, "SkuId": s} for s in skus],
            "item_id": item, "primary_category": 417,
            "attributes": {"name": f"n{item}", "brand": "Brand X", "description": "d"}, "status": "Active"}
    return {k: v for k, v in {**body, **extra}.items() if v != "absent"}


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("pages")
    page1 = [api_product(9100000001, skus=(88000000005,)), api_product(2, skus=(1, 2), images=())]
    page2 = [api_product(2, skus=(2, 3), images=("u9", "u9")), api_product(3, skus=[], images="absent"),
             api_product(4, attributes="absent"), api_product(5, created_time="soon"),
             api_product(6, attributes={"name": "x" * 300, "brand": "b", "description": "d"}),
             api_product(7, attributes={})]
    lines = [json.dumps({"data": {"total_products": len(p), "products": p}}) for p in (page1, page2, [])]
    (folder / "pages.json").write_text("\n".join([*lines, "not json"]))
    return str(folder)


def test_ingest(spark, landed):
    good, bad = pages.split_products(readers.read_api_pages(spark, landed))
    reasons = {(r.item_id, tuple(r.reasons)) for r in bad.collect()}
    assert reasons == {(None, ("not JSON", "no item_id", "no attributes")), (4, ("no attributes",)),
                       (5, ("created_time",)), (6, ("name too long",))}
    c = pages.normalize_pages(good, "2024-03-02")
    assert sorted(r.item_id for r in c.products.collect()) == [2, 2, 3, 7, 9100000001]
    assert sorted((r.item_id, r.sku_id) for r in c.skus.collect()) == [
        (2, 1), (2, 2), (2, 2), (2, 3), (7, 1), (9100000001, 88000000005)]
    assert c.images.count() == 6 and sorted(r.item_id for r in c.attributes.collect()) == [2, 2, 3, 9100000001]
    r = c.products.filter("item_id = 9100000001").first()
    assert (r.name, str(r.created_time), str(r.created_date)) == ("n9100000001", "2024-03-01 10:00:04", "2024-03-02")
    for name, schema in TABLES.items():
        assert getattr(c, name).schema.simpleString() == schema.simpleString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def small(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "item_id int, sku_id int, v string")
    updates = spark.createDataFrame([(1, 2, "new", 1), (1, 2, "newer", 2), (3, 1, "x", 1), (3, 1, "w", 0)],
                                    "item_id int, sku_id int, v string, t int")
    return target, updates


def test_upsert(small):
    target, updates = small
    once = merge.upsert(target, updates, ["item_id", "sku_id"], ["t"])
    assert rows(once) == [(1, 1, "a"), (1, 2, "newer"), (2, 1, "c"), (3, 1, "x")]
    assert rows(merge.upsert(once, updates, ["item_id", "sku_id"], ["t"])) == rows(once)


def test_insert_missing(small):
    target, updates = small
    out = merge.insert_missing(target, updates, ["item_id", "sku_id"], ["t"])
    assert rows(out) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 1, "w")]
    assert rows(merge.insert_missing(out, updates, ["item_id", "sku_id"])) == rows(out)


def test_replace_children(spark, small):
    target, updates = small
    out = merge.replace_children(target, updates.filter("t = 2"))
    assert rows(out) == [(1, 2, "newer"), (2, 1, "c")]
    assert rows(merge.replace_children(target, updates.limit(0))) == rows(target)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "dddd")], "item_id int, s string")
    assert rows(checks.check_key(df.filter("item_id is not null"), ["item_id"])) == [(1, 2)]
    assert checks.check_key(df.filter("item_id is null"), ["item_id"]).count() == 1
    parent = spark.createDataFrame([(1,)], "item_id int")
    assert rows(checks.check_reference(df, parent, "item_id")) == [(2, 1)]
    assert [r.s for r in checks.check_lengths(df, {"s": 3}).collect()] == ["dddd"]
    assert checks.check_lengths(df, {}).count() == 0
    with pytest.raises(ValueError, match="key"):
        checks.require("key", checks.check_key(df, ["item_id"]))


@pytest.fixture
def database(spark, tmp_path):
    name = "db_" + tmp_path.name.replace("-", "_")
    tables.create_tables(spark, name, str(tmp_path / "tables"), recreate=True)
    yield name, str(tmp_path / "tables")
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_load_twice_is_once(spark, landed, database, tmp_path):
    db, location = database
    good, _ = pages.split_products(readers.read_api_pages(spark, landed))
    c = pages.normalize_pages(good, "2024-03-02")
    tables.load_pages(c, db, location)
    before = {name: rows(spark.table(f"{db}.{name}")) for name in TABLES}
    tables.load_pages(c, db, location)
    assert {name: rows(spark.table(f"{db}.{name}")) for name in TABLES} == before
    for name in TABLES:
        assert checks.check_key(spark.table(f"{db}.{name}"), KEYS[name]).count() == 0
        assert checks.check_lengths(spark.table(f"{db}.{name}"), LENGTH_LIMITS[name]).count() == 0
    tables.load_pages(pages.normalize_pages(good.filter("item_id = 2"), "2025-04-01"), db, location, sample_style=True)
    dates = {r.image_url: str(r.created_date) for r in spark.table(f"{db}.images").filter("item_id = 2").collect()}
    assert dates == {"u9": "2025-04-01"}
    versions = lambda: {p.name for p in (tmp_path / "tables" / "skus").iterdir() if p.name.startswith("version=")}
    there, skus = len(versions()), spark.table(f"{db}.skus").count()
    assert len(tables.expire_versions(spark, f"{db}.skus", f"{location}/skus")) == there - 2 > 0
    assert len(versions()) == 2 and tables.read_current(spark, f"{db}.skus").count() == skus
    same = readers.read_catalog(spark, db, "table")
    assert same.skus.filter("item_id = 2").count() == 3
    tables.create_tables(spark, db, location)
    assert spark.table(f"{db}.products").count() == 4


def test_load_job(spark, landed, database, tmp_path):
    db, location = database
    aside, out = str(tmp_path / "aside"), str(tmp_path / "messages")
    for _ in range(2):
        load.load_job(spark, landed, db, location, aside, "2024-03-02", options={"path": out})
    bad = {(r.item_id, r.reasons) for r in spark.read.json(aside).collect()}
    assert bad == {(None, "not JSON,no item_id,no attributes"), (4, "no attributes"), (5, "created_time"), (6, "name too long")}
    assert spark.table(f"{db}.products").count() == 4
    flat = {r.item_id: r for r in flatten_stream(spark.read.text(out)).collect()}
    assert set(flat) == {2, 3, 7, 9100000001}
    assert (flat[2].image_url, flat[9100000001].quantity, flat[3].price) == ("u9", 100, None)


def test_bulk_load(spark, landed, database, tmp_path):
    db, location = database
    good, _ = pages.split_products(readers.read_api_pages(spark, landed))
    c = pages.normalize_pages(good.filter("item_id <> 2"), "2024-03-02")
    tables.bulk_load(c, db, location, str(tmp_path / "stage1"))
    assert spark.table(f"{db}.products").count() == 3
    files_before = set(spark.table(f"{db}.products").inputFiles())
    more = pages.normalize_pages(good.filter("item_id = 2").limit(1), "2024-03-02")
    tables.bulk_load(more, db, location, str(tmp_path / "stage0"))
    assert spark.table(f"{db}.products").count() == 4
    assert files_before < set(spark.table(f"{db}.products").inputFiles())
    with pytest.raises(ValueError, match="key of products"):
        tables.bulk_load(c, db, location, str(tmp_path / "stage2"))
    assert spark.table(f"{db}.products").count() == 4
    orphan = pages.normalize_pages(good.filter("item_id = 3").withColumn("item_id", F.lit(99).cast("bigint")), "2024-03-02")
    from dataclasses import replace
    with pytest.raises(ValueError, match="product of"):
        tables.bulk_load(replace(orphan, products=orphan.products.limit(0)), db, location, str(tmp_path / "stage3"))


def test_file_sinks(spark, tmp_path, small):
    target, _ = small
    files.write_partitioned(target, str(tmp_path / "p"), by="item_id")
    back = spark.read.parquet(str(tmp_path / "p"))
    assert rows(back.select("item_id", "sku_id", "v")) == rows(target)
    files.write_partitioned(target.filter("item_id = 1"), str(tmp_path / "p"), by="item_id")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    files.write_text(target.select("v"), str(tmp_path / "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a", "b", "c"]
    files.write_table(target.withColumn("price", F.lit(1.239)), "parquet", {"path": str(tmp_path / "k")})
    assert spark.read.parquet(str(tmp_path / "k")).schema["price"].dataType.simpleString() == "decimal(10,2)"


def test_schema_inference(spark):
    df = spark.createDataFrame([('{"Id": 1, "Ok": true, "Price": 2, "Name": "x", "Tags": [1], "Sub": {"a": 1}, "N": null}',),
                                ('{"Price": 2.5, "Name": 3}',)], "body string")
    inferred = readers.infer_table_schema(df, "body")
    got = {r.column_name: r.sql_type for r in inferred.collect()}
    assert got == {"id": "INTEGER", "ok": "BOOLEAN", "price": "DECIMAL", "name": "TEXT", "tags": "JSONB",
                   "sub": "JSONB", "n": "TEXT", "created_date": "DATE"}
    assert "`price` DECIMAL(38,6)" in readers.table_ddl(inferred, "t")


def test_upsert_table(spark, database):
    db, location = database
    new = spark.sql("SELECT 1L item_id, 'B' brand, 'd' description, date'2025-01-01' created_date, 1 seq "
                    "UNION ALL SELECT 1L, 'C', 'e', date'2025-01-02', 2")
    for _ in range(2):
        tables.upsert_table(f"{db}.attributes", new, ["item_id"], ["seq"], f"{location}/attributes")
        assert [(r.item_id, r.brand) for r in tables.read_current(spark, f"{db}.attributes").collect()] == [(1, "C")]
    text = tables.merge_statement("t1", "u1", ["k", "v"], ["k"])
    assert text == ("MERGE INTO t1 t USING u1 u ON t.`k` <=> u.`k` WHEN MATCHED THEN UPDATE SET t.`v` = u.`v` "
                    "WHEN NOT MATCHED THEN INSERT (`k`, `v`) VALUES (u.`k`, u.`v`)")
