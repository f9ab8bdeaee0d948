"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import (
    chat, decontamination, exact_dedup, licenses, near_dedup, packing, pii, quality, sharding, substring_dedup,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _t string, _digest string, kept string, node string, key string"
LONG = " ".join(f"word{i % 977} mail{i}@x.example.com" for i in range(20_000))
TEXTS = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (2, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (2, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (3, ""), (4, None), (None, "a text without id"), (None, None), (5, LONG), (6, "x" * 100_000), (7, "   \n\t "),
    (8, "Licensed under the Apache License, Version 2.0."),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, "s", None, "clash", "clash", "clash", "clash", "clash") for i, t in TEXTS], DOCS)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def labels(spark, rows=((1, 1, 0), (2, 0, 0), (2, 1, 0), (3, None, None), (None, 1, 0), (5, 0, 0))):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def bench(spark, rows=(("q1", "seven eight nine ten eleven twelve thirteen fourteen"), ("q2", None), (None, "x"), ("q3", ""))):
    return spark.createDataFrame(list(rows), "item_id string, text string")


def pii_of(docs):
    return pii.find_personal_data(docs, pii.train_field(pii.labelled_table()))


PER_ROW = {
    "licenses": licenses.scan_licenses,
    "packing": lambda d: packing.pack(d).filter("piece = 0"),
    "sharding": lambda d: sharding.shuffle_into_shards(d, shards=3),
    "pii": pii_of,
    "substring": substring_dedup.remove_repeats,
    "exact": exact_dedup.exact_duplicates,
    "near": near_dedup.near_duplicates,
    "quality": lambda d: quality.score_quality(d, quality.fit_quality(d, labels(d.sparkSession))),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_result_for_each_row(docs, none, name):
    got = [r["doc_id"] for r in PER_ROW[name](docs).collect()]
    assert sorted(got, key=str) == sorted([i for i, _ in TEXTS], key=str)
    assert PER_ROW[name](none).count() == 0


def by_id(rows):
    return {r["doc_id"]: r for r in rows if r["doc_id"] is not None}


def test_defined_results(spark, docs):
    rows = exact_dedup.exact_duplicates(docs).collect()
    assert sum(r["kept"] for r in rows if r["doc_id"] in (1, 2)) == 1
    assert {r["group_size"] for r in rows if r["doc_id"] == 2} == {3}
    assert by_id(rows)[4]["keep_id"] == 4 and by_id(rows)[3]["keep_id"] == 4
    assert [r["kept"] for r in rows if r["doc_id"] is None and r["keep_id"] == 4] == [False]

    rows = substring_dedup.remove_repeats(docs).collect()
    assert [r["n_removed"] for r in rows if r["doc_id"] == 2] == [14, 14]
    assert by_id(rows)[1]["n_removed"] == 0 and by_id(rows)[4]["n_words"] == 0

    rows = near_dedup.near_duplicates(docs).collect()
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert by_id(rows)[4]["n_shingles"] == 0 and by_id(rows)[4]["kept"]
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)

    rows = by_id(pii_of(docs).collect())
    assert rows[5]["n_email"] == 20_000 and rows[3]["spans"] == ""
    rows = by_id(packing.pack(docs).collect())
    assert rows[3]["length"] == rows[4]["length"] == rows[7]["length"] == 1
    rows = by_id(licenses.scan_licenses(docs).collect())
    assert (rows[8]["licenses"], rows[8]["status"], rows[3]["status"]) == ("Apache-2.0", "known", "none")
    rows = by_id(sharding.shuffle_into_shards(docs, shards=3).collect())
    assert (rows[4]["size"], rows[4]["text_crc32"]) == (16, 0)


def test_stages_keep_columns(spark, docs, none):
    trees = quality.fit_quality(docs, labels(spark))
    for stage in (
        lambda d: quality.keep_quality(d, trees), exact_dedup.drop_exact_duplicates, near_dedup.drop_near_duplicates,
        lambda d: decontamination.drop_contaminated(d, bench(spark)),
    ):
        assert stage(docs).columns == docs.columns
        assert stage(none).count() == 0
    left = exact_dedup.drop_exact_duplicates(docs).select("doc_id", "text").collect()
    assert (4, None) in {tuple(r) for r in left} and len(left) == 7


def test_decontamination_edges(spark, docs, none):
    found = decontamination.find_contaminated(docs, bench(spark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, "q1"), (2, "q1")}
    assert decontamination.find_contaminated(none, bench(spark)).count() == 0
    assert decontamination.find_contaminated(docs, bench(spark, (("q1", None),))).count() == 0
    assert decontamination.find_contaminated(docs, bench(spark).limit(0)).count() == 0


def test_chat_edges(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, state string, legal string"
    turns = [(1, 0, "user", "a\\0<b", "s", "l"), (1, 1, "assistant", None, "s", "l"), (2, None, None, "x", "s", "l"),
             (2, 0, "tool [TEXT]", "[/TEXT]", "s", "l"), (None, 0, "assistant", "", "s", "l"), (3, 0, "user", "q", "s", "l"),
             (3, 0, "user", "q", "s", "l")]
    given = spark.createDataFrame(turns, schema)
    made = chat.assemble(chat.format_turns(given)).withColumn("back", chat.parse_turns(F.col("formatted"))).collect()
    back = {r["conv_id"]: [(t["role"], t["text"]) for t in r["back"]] for r in made}
    assert back == {1: [("user", "a\\0<b"), ("assistant", "")], 2: [("", "x"), ("tool [TEXT]", "[/TEXT]")],
                    None: [("assistant", "")], 3: [("user", "q"), ("user", "q")]}
    assert {r["conv_id"]: r["valid"] for r in made} == {1: True, 2: False, None: False, 3: False}
    assert chat.assemble(chat.format_turns(given.limit(0))).count() == 0


def test_labels_without_rows(spark, docs):
    trees = quality.fit_quality(docs, labels(spark).limit(0))
    assert {r["score"] for r in quality.score_quality(docs, trees).collect()} == {0.5}
