"""Every stage of the pipeline against a plain version, each on what the stage before it kept."""

import re
from collections import defaultdict

import pytest
from test_methods import brute_near

import corpus_pipeline
from shelfmark.llm import packing, quality
from shelfmark.llm.common import read

SF = "/root/testdata/sf0.01"


def walk(trees, row):
    """Score of one document, node by node."""
    total = trees.base
    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
        total += leaf[node - len(feature)]
    return 1 / (1 + 2.718281828459045 ** -total)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and result of every stage, as the runner writes and rereads them."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = read(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns(spark, stages):
    columns = read(spark, SF, "documents").columns
    assert all(after.columns == columns for _, after in list(stages.values())[:-1])


def test_quality_stage(spark, stages):
    before, after = stages["quality_classifier"]
    trees = quality.fit_quality(before, read(spark, SF, "labels"))
    want = {i for i, t in texts(before).items() if walk(trees, quality.statistics(t or "")) >= quality.THRESHOLD}
    assert set(texts(after)) == want
    good = {r["doc_id"] for r in read(spark, SF, "labels").filter("quality = 1").collect()} & set(texts(before))
    assert len(good & want) > 0.97 * len(good)


def test_exact_stage(stages):
    before, after = stages["exact_dedup"]
    last = {t or "": i for i, t in sorted(texts(before).items())}
    assert set(texts(after)) == set(last.values())


def test_near_stage(stages):
    """Documents are linked from a similarity of 0.8 on."""
    before, after = stages["near_dedup"]
    ids = sorted(texts(before))
    found = brute_near([texts_of[i] for texts_of in [texts(before)] for i in ids], 80)
    assert set(texts(after)) == {ids[k] for k, (_, part) in found.items() if part == k}


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    grams = set()
    for r in read(spark, SF, "benchmark").collect():
        w = re.findall(r"\w+", r["text"].lower())
        grams |= {tuple(w[k:k + 8]) for k in range(len(w) - 7)}
    dirty = set()
    for i, t in texts(before).items():
        w = re.findall(r"\w+", (t or "").lower())
        if any(tuple(w[k:k + 8]) in grams for k in range(len(w) - 7)):
            dirty.add(i)
    assert dirty and set(texts(after)) == set(texts(before)) - dirty


def test_packing_stage(stages):
    before, after = stages["best_fit_packing"]
    encode = packing.encoder(None)
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in after.collect():
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in texts(before).items():
        assert sum(n for _, n in pieces[i]) == len(encode.whole(t or "")) // 4 + 1
    assert set(pieces) == set(texts(before))
    for places in sequences.values():
        assert sum(n for _, n in places) <= packing.CAPACITY
        assert [o for o, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:k]) for k in range(len(places))]
    total = sum(n for p in pieces.values() for _, n in p)
    assert len(sequences) <= -(-total // packing.CAPACITY) + 2


def test_run_is_the_stages_in_order(spark, stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "near_dedup", "decontamination", "best_fit_packing"]
    got = corpus_pipeline.run(spark, SF)
    assert got.count() == stages["best_fit_packing"][1].count()
