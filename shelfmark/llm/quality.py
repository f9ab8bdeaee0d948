"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed per text in Python tasks. The trees are trained in numpy on a bounded sample of
labelled documents and flattened into arrays (feature, threshold and leaf value by node number), so a
batch of documents is scored by a few vector operations per level. Neither label, id, language nor source
enters the statistics.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import clean_text

#: Labelled rows that training may use; with more, a share of them chosen by a hash of doc_id.
TRAIN_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
NAMES = (
    "chars", "words", "lines", "word_chars", "line_words", "upper", "lower", "digits", "spaces", "wide",
    "stops", "commas", "marks", "bangs", "symbols", "bars", "brackets", "quotes", "distinct_words",
    "top_word", "repeats", "distinct_pairs", "distinct_lines", "short_words", "long_words", "closed_lines",
)


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, in the order of NAMES; shares are 0 for an empty text."""
    words = text.split()
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    seen = np.bincount(raw, minlength=256)
    size, n = max(len(raw), 1), max(len(words), 1)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:]))) if len(words) > 1 else 1
    lines = [x for x in text.split("\n") if x.strip()]
    lengths = list(map(len, words))

    def share(chars: str) -> float:
        return float(sum(seen[ord(c)] for c in chars)) / size

    return [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)),
        sum(lengths) / n, n / max(len(lines), 1),
        float(seen[65:91].sum()) / size, float(seen[97:123].sum()) / size, float(seen[48:58].sum()) / size,
        share(" \n\t"), float(seen[128:].sum()) / size, share("."), share(","), share("?;:"), share("!"),
        share("*#%&$@^~"), share("|"), share("<>{}[]()"), share("\"'"),
        len(counts) / n, max(counts.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n, pairs / n,
        len(set(lines)) / max(len(lines), 1),
        sum(x < 3 for x in lengths) / n, sum(x > 14 for x in lengths) / n,
        sum(x.rstrip()[-1] in ".!?" for x in lines) / max(len(lines), 1),
    ]


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: arrays (tree, node); children of node i are 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, bins: int = 64,
          rate: float = 0.15, ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Boosted trees for the logistic loss, grown level by level from gradient histograms.

    Without rows of both labels the score is the smoothed share of label 1.
    """
    n, width = x.shape
    base = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    inner = 2**depth - 1
    if n == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), depth)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    columns = np.arange(width) * bins
    total = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (width * bins) + columns + binned).ravel()
            shape = (count, width, bins)
            g = np.bincount(at, np.repeat(gradient, width), count * width * bins).reshape(shape).cumsum(2)
            h = np.bincount(at, np.repeat(weight, width), count * width * bins).reshape(shape).cumsum(2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[(h < least) | (h_all - h < least)] = 0
            best = gain.reshape(count, -1).argmax(1)
            for k, b in enumerate(best):
                j, cut = divmod(int(b), bins)
                if gain[k, j, cut] > 1e-9 and cut < len(edges[j]):
                    feature[first + k], threshold[first + k] = j, edges[j][cut]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        g = np.bincount(node - inner, gradient, inner + 1)
        h = np.bincount(node - inner, weight, inner + 1)
        leaf = -rate * g / (h + ridge)
        total += leaf[node - inner]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(leaves), depth)


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(t.as_py() or "") for t in texts], np.float64).reshape(-1, len(NAMES))


def fold(column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the number of folds; 0 where the id is null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % FOLDS, F.lit(0))


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees trained on labelled documents outside the held-out fold.

    At most about `train_rows` labelled ids are used (chosen by hash where there are more), so what
    reaches the driver is a bounded table of statistics. Labels that are null or contradict each other
    are left out; a repeated label counts once.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold() != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("_y"), F.max("quality").alias("_z"))
    known = known.filter(F.col("_y") == F.col("_z"))
    share = min(1.0, train_rows / max(known.count(), 1))
    grid = 1 << 30
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(grid)) < int(grid * share)).select("doc_id", "_y")
    rows = docs.select("doc_id", clean_text().alias("_t")).join(F.broadcast(chosen), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("_t"))
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("doc_id"), "y": batch.column("_y"),
                "x": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))})

    schema = f"id {dict(rows.dtypes)['doc_id']}, y {dict(rows.dtypes)['_y']}, x array<double>"
    table = rows.select("doc_id", "_y", "_t").mapInArrow(measure, schema).toArrow()
    # One order of rows whatever the tasks were, so that sums and trees come out the same.
    got = sorted(zip(table.column("id").to_pylist(), table.column("y").to_pylist(), table.column("x").to_pylist()))
    x = np.array([r[2] for r in got], np.float64).reshape(-1, len(NAMES))
    return train(x, np.array([r[1] for r in got], np.float64))


def score_quality(docs: DataFrame, trees: Trees) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    A null text is scored as an empty one; a null doc_id counts as held out; repeated rows are scored
    each, an empty table gives an empty result, and other columns are ignored.
    """
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(trees.score(_matrix(batch.column(2))))],
                ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", (fold() == HELD_OUT).alias("held_out"), clean_text().alias("_t"))
    kind = dict(rows.dtypes)["doc_id"]
    out = rows.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_quality(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, with all columns of `docs`."""
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(trees.score(_matrix(batch.column(at))) >= threshold))

    return docs.mapInArrow(kept, docs.schema)
