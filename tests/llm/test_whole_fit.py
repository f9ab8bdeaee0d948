"""The latent space comes from all passages of the corpus."""

import random

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.llm import decontamination as d


def make_texts(n=150):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 300))) for _ in range(n)]
    return [*texts, texts[0], texts[0], "", None]


def test_the_fit_does_not_depend_on_how_passages_are_dealt(spark, monkeypatch):
    texts = [(t or "",) for t in make_texts()]
    docs = spark.createDataFrame(texts, "_t string").repartition(5)
    frequencies, passages = d.document_frequencies(docs)
    assert passages == sum(-(-len(t.split()) // d.PASSAGE) for t, in texts)
    common = np.argsort(frequencies)[-100:]

    def angles():
        latent = d.latent_terms(docs, frequencies, passages)[common].astype(np.float64)
        latent /= np.linalg.norm(latent, axis=1)[:, None]
        return latent @ latent.T

    whole = angles()
    monkeypatch.setattr(d, "FIT_PASSAGES", 1)
    assert np.allclose(angles(), whole, atol=0.01)


def test_equal_texts_count_each_in_frequencies(spark):
    docs = spark.createDataFrame([("one two",), ("one two",), ("one",), ("",)], "_t string")
    frequencies, passages = d.document_frequencies(docs)
    assert passages == 3 and sorted(frequencies[frequencies > 0]) == [2, 3]
    assert sorted(r["_n"] for r in d.term_rows(docs).collect()) == [1, 1, 2]


@pytest.mark.parametrize("width", [1, 5])
def test_product_with_all_passages(width, monkeypatch):
    """S'(A Q) in parts against whole matrices, for words that repeat in a passage and over many."""
    monkeypatch.setattr(d, "SIDE", 16)
    rows = [d.terms(d._words(pa.array([t], pa.string()))[0]).astype("<u2").tobytes() for t in make_texts(40)]
    passages, of_row = d._passages(pa.array(rows, pa.binary()))
    assert of_row.sum() == len(passages) and of_row[-1] == 0
    idf = np.append(np.random.default_rng(1).random(d.TERMS), 0.0)
    q = np.random.default_rng(2).standard_normal((d.TERMS, width))
    counts = np.zeros((len(passages), d.TERMS + 1))
    np.add.at(counts, (np.repeat(np.arange(len(passages)), d.PASSAGE), passages.ravel().astype(int)), 1)
    a = (counts * idf)[:, :d.TERMS]
    a /= np.linalg.norm(a, axis=1)[:, None]
    got = np.zeros((d.TERMS, width))
    term, product = d._gram(passages, idf, (q * idf[:-1, None]).astype(np.float32))
    got[term] = product
    assert len(set(term.tolist())) == len(term)
    assert np.allclose(got * idf[:-1, None], a.T @ (a @ q), rtol=1e-3, atol=1e-4)
