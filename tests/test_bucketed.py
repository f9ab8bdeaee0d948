"""Bucketed tables under one manifest: what a commit touches, and what a broken one leaves."""

import os
import threading

import pytest
from pyspark.sql import types as T

from shelfmark.sinks import bucketed
from shelfmark.sinks.bucketed import BucketedTables, Change, Layout

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def layouts(buckets=4):
    return {"a": Layout(SCHEMA, ("k",), buckets), "b": Layout(SCHEMA, ("k",), buckets)}


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k bigint, v string")


def content(tables, name):
    return sorted((r.k, r.v) for r in tables.read(name).collect())


def test_commit_and_replace(spark, tmp_path):
    tables = BucketedTables(spark, str(tmp_path), layouts())
    assert content(tables, "a") == []
    tables.commit([Change("a", rows(spark, [(i, "x") for i in range(20)])), Change("b", rows(spark, [(1, "y")]))], label=0)
    before = tables.manifest.folders["a"]
    own = tables.touched("a", rows(spark, [(3, "")]))
    left = [(r.k, r.v) for r in tables.read("a", own).collect() if r.k != 3]
    tables.commit([Change("a", rows(spark, [*left, (3, "new")]), own)], label=1)
    after = tables.manifest.folders["a"]
    assert {k for k in after if after[k] != before[k]} == {str(k) for k in own}
    again = BucketedTables(spark, str(tmp_path), layouts())
    assert again.manifest.label == 1 and content(again, "b") == [(1, "y")]
    assert content(again, "a") == sorted([(i, "x") for i in range(20) if i != 3] + [(3, "new")])
    with pytest.raises(ValueError, match="4 buckets"):
        BucketedTables(spark, str(tmp_path), layouts(8))
    with pytest.raises(ValueError, match="outside"):
        tables.commit([Change("a", rows(spark, [(i, "z") for i in range(20)]), own)])


def test_broken_and_rival_commits(spark, tmp_path, monkeypatch):
    tables = BucketedTables(spark, str(tmp_path), layouts())
    tables.commit([Change("a", rows(spark, [(1, "x")])), Change("b", rows(spark, [(1, "x")]))])
    real = BucketedTables._write

    def broken(self, table, *args):
        if table == "b":
            raise OSError("disk")
        return real(self, table, *args)

    monkeypatch.setattr(BucketedTables, "_write", broken)
    with pytest.raises(OSError):
        tables.commit([Change("a", rows(spark, [(2, "x")])), Change("b", rows(spark, [(2, "x")]))])
    monkeypatch.undo()
    fresh = BucketedTables(spark, str(tmp_path), layouts())
    assert content(fresh, "a") == content(fresh, "b") == [(1, "x")]
    # A manifest that its writer did not finish counts for nothing.
    (tmp_path / "manifest" / "2.json").write_text('{"version": 2, "fold')
    fresh = BucketedTables(spark, str(tmp_path), layouts())
    assert fresh.manifest.version == 1
    rival = BucketedTables(spark, str(tmp_path), layouts())
    monkeypatch.setattr(rival, "_versions", lambda: [1, 2])
    fresh.commit([Change("a", rows(spark, [(3, "x")]))])
    with pytest.raises(Exception):
        rival.commit([Change("a", rows(spark, [(4, "x")]))])
    assert content(BucketedTables(spark, str(tmp_path), layouts()), "a") == [(1, "x"), (3, "x")]


def test_folders_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bucketed, "FAN", 3)
    tables = BucketedTables(spark, str(tmp_path), layouts(2))
    for n in range(30):
        tables.commit([Change("a", rows(spark, [(2 * n, "x"), (2 * n + 1, "y")]))], label=n)
        assert all(len(found) <= 2 * 4 for found in tables.manifest.folders["a"].values())
        assert len(os.listdir(tmp_path / "manifest")) <= 2 * 2 + 1  # with checksums
        assert len(os.listdir(tmp_path / "a")) <= 2 * 8
    assert len(content(tables, "a")) == 60


def test_tables_of_a_commit_are_written_side_by_side(spark, tmp_path, monkeypatch):
    tables = BucketedTables(spark, str(tmp_path), layouts())
    real, both = BucketedTables._write, threading.Barrier(2, timeout=60)
    monkeypatch.setattr(BucketedTables, "_write", lambda self, *args: both.wait() < 2 and real(self, *args))
    tables.commit([Change("a", rows(spark, [(1, "x")])), Change("b", rows(spark, [(2, "y")]))])
    assert content(tables, "a") == [(1, "x")] and content(tables, "b") == [(2, "y")]
