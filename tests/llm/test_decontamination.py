"""Recall of the candidates against the operator's own rule, tried on every window without a cosine."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import decontamination as d
from shelfmark.llm.common import read

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def search(spark):
    docs, benchmark = read(spark, SF, "documents"), read(spark, SF, "benchmark")
    texts = docs.select(F.lower(F.coalesce("text", F.lit(""))).alias("_t"))
    latent = d.latent_terms(texts, *d.document_frequencies(texts))
    queries = d.benchmark_queries(benchmark, latent)
    groups = []
    for scale in range(len(d.SCALES)):
        numbers = np.array([i for i, q in enumerate(queries) if q.scale == scale], np.int64)
        groups.append((numbers, np.array([queries[i].vector for i in numbers], np.float32).reshape(-1, d.RANK)))
    items = {r["item_id"]: re.findall(r"\w+", r["text"].lower()) for r in benchmark.collect()}
    grams = {tuple(w[k:k + 8]) for w in items.values() for k in range(len(w) - 7)}
    clean = []
    for r in docs.filter("length(text) between 1500 and 40000").orderBy("doc_id").collect():
        w = re.findall(r"\w+", r["text"].lower())
        if not any(tuple(w[k:k + 8]) in grams for k in range(len(w) - 7)):
            clean.append(r["text"].lower())
    return latent, queries, groups, items, clean[:300]


@pytest.mark.parametrize("changed", [0.1, 0.2, 0.3, 0.4])
def test_candidate_recall(search, changed):
    latent, queries, groups, items, clean = search
    rng, names, texts = random.Random(11), list(items), []
    vocabulary = " ".join(clean[:60]).split()
    planted = [names[k * 7 % len(names)] for k in range(len(clean))]
    for text, item in zip(clean, planted):
        w, z = list(items[item]), text.split()
        for p in rng.sample(range(len(w)), round(changed * len(w))):
            w[p] = rng.choice(vocabulary)
        at = rng.randrange(len(z))
        texts.append(" ".join([*z[:at], *w, *z[at:]]))
    words, at = d._words(pa.array(texts, pa.string()))

    def accepted(row, item):
        text = words[at[row]:at[row + 1]]
        for q in (q for q in queries if q.item == item):
            for low in range(0, len(text), 4):
                part = text[low:low + 2 * len(q.words) + 8]
                if (d.common_words(part, q.words) >= d.COMMON * len(q.words)
                        and d.common_words(part, q.answer) >= d.ANSWER * len(q.answer)):
                    return True
        return False

    truth = {(row, item) for row, item in enumerate(planted) if accepted(row, item)}
    got = {(row, q.item) for row, q, *_ in d.confirmed(words, at, latent, queries, groups)}
    assert len(truth) > 100 and len(got & truth) >= 0.9 * len(truth)
    assert got <= set(enumerate(planted))
    print(f"changed {changed}: {len(got)} of {len(planted)} planted, {len(got & truth)} of {len(truth)} that the word rule accepts")


def planted_copies(search, cut):
    """Share of 200 verbatim copies of a part of an item that are found, and what else is reported."""
    latent, queries, groups, items, clean = search
    rng, names, texts = random.Random(5), list(items), []
    planted = [names[k * 7 % len(names)] for k in range(200)]
    for text, item in zip(clean, planted):
        z = text.split()
        at = rng.randrange(len(z))
        texts.append(" ".join([*z[:at], *cut(items[item]), *z[at:]]))
    words, at = d._words(pa.array(texts, pa.string()))
    got = {(row, q.item) for row, q, *_ in d.confirmed(words, at, latent, queries, groups)}
    return len(got & set(enumerate(planted))) / 200, len(got - set(enumerate(planted)))


@pytest.mark.parametrize("share", [0.65, 0.75, 0.85, 1.0])
def test_verbatim_part_of_an_item(search, share):
    found, other = planted_copies(search, lambda w: w[:-(-len(w) * round(100 * share) // 100)])
    assert found >= 0.95 and other == 0


@pytest.mark.parametrize("size", [1, 3, 4, 5, 7, 8, 10])
def test_short_items(search, size):
    """Items of the first words of the given ones, each copied into a text of its own."""
    latent, _, _, items, clean = search
    short = {k: w[:size] for k, w in items.items()}
    hashes, at = d._words(pa.array([" ".join(w) for w in short.values()], pa.string()))
    queries = [d.Query(k, own, own[-max(3, size // 4):], d.EXACT if size < d.SHORT else 0, d.unit(latent[d.terms(own)].sum(0)))
               for k, own in zip(short, np.split(hashes, at[1:-1]))]
    groups = [(np.zeros(0, np.int64), np.zeros((0, d.RANK), np.float32))] * len(d.SCALES)
    if size >= d.SHORT:
        groups[0] = (np.arange(len(queries)), np.array([q.vector for q in queries], np.float32))
    names = list(short)
    texts = []
    for k, text in enumerate(clean[:100]):
        z = text.split()[:300]
        texts.append(" ".join([*z[:k], *short[names[k % len(names)]], *z[k:]]))
    words, at = d._words(pa.array(texts, pa.string()))
    got = {(row, q.item) for row, q, *_ in d.confirmed(words, at, latent, queries, groups)}
    want = {(k, names[k % len(names)]) for k in range(len(texts))}
    assert len(want & got) >= 0.9 * len(want)
    if size < d.SHORT:
        assert want <= got
        for row, item in got:
            own = [hash(tuple(x)) for x in (words[at[row]:at[row + 1]][i:i + size].tolist() for i in range(at[row + 1] - at[row] - size + 1))]
            assert hash(tuple(queries[names.index(item)].words.tolist())) in own
