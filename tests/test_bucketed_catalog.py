"""Catalog tables in buckets: touched buckets only, four tables in one commit."""

import pytest

from shelfmark.schemas import TABLES, Catalog
from shelfmark.sinks import bucketed_catalog as bc
from shelfmark.sinks.bucketed import BucketedTables


def catalog(spark, items, price=1, images=("u",)):
    def frame(name, rows):
        names = [f.name for f in TABLES[name].fields]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], TABLES[name])

    return Catalog(
        products=frame("products", [{"item_id": i, "name": f"n{price}", "primary_category": 1} for i in items]),
        skus=frame("skus", [{"item_id": i, "sku_id": i * 10 + k, "quantity": price} for i in items for k in range(2)]),
        images=frame("images", [{"item_id": i, "image_url": u} for i in items for u in images]),
        attributes=frame("attributes", [{"item_id": i, "brand": "b"} for i in items]))


def folders(tables):
    return {name: {k: [p for p, _ in v] for k, v in own.items()} for name, own in tables.manifest.folders.items()}


def test_load_touches_its_buckets_only(spark, tmp_path):
    tables = bc.open_catalog(spark, str(tmp_path), buckets=8)
    bc.load_catalog(tables, catalog(spark, range(40)))
    first = folders(tables)
    assert tables.manifest.version == 1 and {n: tables.read(n).count() for n in TABLES} == {"products": 40, "skus": 80, "images": 40, "attributes": 40}
    again = catalog(spark, [3, 100], 7, ("u", "w"))
    bc.load_catalog(tables, again)
    own = {str(k) for k in tables.touched("products", again.products)}
    now = folders(tables)
    for name in TABLES:
        assert {k for k in now[name] if now[name].get(k) != first[name].get(k)} == own
    assert tables.read("products").filter("name = 'n7'").count() == 2
    assert tables.read("skus").filter("item_id = 3").select("quantity").distinct().first()[0] == 7
    assert tables.read("images").count() == 43
    bc.load_catalog(tables, catalog(spark, [3], 9).__class__(**{**catalog(spark, [3], 9).tables(), "skus": catalog(spark, [3], 9).skus.limit(1)}), sample_style=True)
    assert tables.read("skus").filter("item_id = 3").count() == 1
    bc.upsert_rows(tables, "attributes", catalog(spark, [5]).attributes)
    assert tables.read("attributes").count() == 41


def test_bulk_append_is_all_or_nothing(spark, tmp_path, monkeypatch):
    tables = bc.open_catalog(spark, str(tmp_path), buckets=4)
    bc.bulk_append(tables, catalog(spark, range(10)))
    before = folders(tables)
    for broken in (catalog(spark, [3]), catalog(spark, [50, 50]),
                   Catalog(**{**catalog(spark, [60]).tables(), "skus": catalog(spark, [61]).skus})):
        with pytest.raises(ValueError):
            bc.bulk_append(tables, broken)
    real = BucketedTables._write
    monkeypatch.setattr(BucketedTables, "_write", lambda self, table, *a: 1 / 0 if table == "attributes" else real(self, table, *a))
    with pytest.raises(ZeroDivisionError):
        bc.bulk_append(tables, catalog(spark, [70]))
    monkeypatch.undo()
    assert folders(bc.open_catalog(spark, str(tmp_path), buckets=4)) == before
    bc.bulk_append(tables, catalog(spark, [70]))
    whole = bc.read_catalog(bc.open_catalog(spark, str(tmp_path), buckets=4))
    assert {n: df.count() for n, df in whole.tables().items()} == {"products": 11, "skus": 22, "images": 11, "attributes": 11}
