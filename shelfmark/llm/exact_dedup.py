"""Exact duplicates by content sort.

Normalised texts are range-partitioned on sampled splitters and sorted, so that equal texts lie next to
each other; every row is compared in full with the row before it. The sort key starts with the first
characters of the text, then its digest, so that splitters stay short however long texts are and a
common beginning does not gather in one range; only rows of one digest compare whole texts.

A text with more than `hot_rows` copies is dealt over several ranges by a salt from the document's id;
the first row of every run of such a text, at most `MAX_SALTS` per text, then meets the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed, clean_text

HEAD_CHARS = 64
MAX_SALTS = 1024
#: Hot texts up to this many are sent to all tasks (40 bytes each); more are joined by shuffle.
BROADCAST_KEYS = 500_000


def exact_duplicates(docs: DataFrame, normalise: Callable[[Column], Column] = lambda text: text,
                     keep: str = "max", hot_rows: int = 512) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Equal means equal after `normalise`. Of equal texts the row with the largest (`keep="max"`) or
    smallest (`"min"`) doc_id stays.

    - null text counts as empty, and all empty texts form one group;
    - a row without doc_id never stays while its group has an id; a group without any id keeps one row
      and has a null keep_id;
    - of rows that share text and doc_id one stays, and group_size counts all of them;
    - an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select("doc_id", normalise(clean_text()).alias("_t"), F.lit(None).alias("_carry"))
    return _grouped(rows, keep, hot_rows, False).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("_digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, keep: str = "max", hot_rows: int = 512) -> DataFrame:
    """The rows that stay, with all columns of `docs` in their order."""
    others = [F.col(c) for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", clean_text().alias("_t"), F.struct(
        F.struct(*others).alias("rest"), F.col("text").isNull().alias("none")).alias("_carry"))
    kept = _grouped(rows, keep, hot_rows, True).filter("kept")
    text = F.when(~F.col("_carry.none"), F.col("_text"))
    return kept.select(*[text.alias(c) if c == "text" else F.col("_carry.rest")[c].alias(c) for c in docs.columns])


def _grouped(rows: DataFrame, keep: str, hot_rows: int, texts: bool) -> DataFrame:
    """Rows (doc_id, _t, _carry) with keep_id, group_size, kept, _digest and, for rows that begin a run
    of equal texts, `_text` (if `texts`)."""
    rows = rows.withColumn("_digest", F.sha2("_t", 256))
    counts = rows.groupBy("_digest").agg(F.count("*").alias("_n"))
    salts = F.least(F.ceil(F.col("_n") / hot_rows), F.lit(MAX_SALTS)).cast("int")
    hot = checkpointed(counts.filter(F.col("_n") > hot_rows).select("_digest", salts.alias("_salts")))
    n_hot = hot.count()
    if not n_hot:
        return _kept(_runs(rows.withColumn("_salt", F.lit(0)), keep, texts), F.lit(True))

    marked = rows.join(F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot, "_digest", "left")
    cold = marked.filter(F.col("_salts").isNull()).withColumn("_salt", F.lit(0))
    salt = F.pmod(F.xxhash64("doc_id"), F.col("_salts")).cast("int")
    runs = checkpointed(_runs(marked.filter(F.col("_salts").isNotNull()).withColumn("_salt", salt), keep, True))
    same = Window.partitionBy("_digest", "_text")
    best = _best("keep_id", keep)
    stitched = runs.filter(F.col("_text").isNotNull()).select(
        "_digest", "_salt", "_run", _pick(keep)("keep_id").over(same).alias("_keep"),
        F.sum("group_size").over(same).alias("_size"),
        (F.row_number().over(same.orderBy(best, "_salt")) == 1).alias("_first"))
    whole = runs.drop("group_size", "keep_id").join(stitched, ["_digest", "_salt", "_run"])
    whole = whole.withColumnsRenamed({"_keep": "keep_id", "_size": "group_size"})
    return _kept(_runs(cold, keep, texts), F.lit(True)).unionByName(_kept(whole, F.col("_first")))


def _best(column: str, keep: str) -> Column:
    return F.col(column).desc_nulls_last() if keep == "max" else F.col(column).asc_nulls_last()


def _pick(keep: str) -> Callable[[str], Column]:
    return F.max if keep == "max" else F.min


def _runs(rows: DataFrame, keep: str, texts: bool) -> DataFrame:
    """Sort the texts and number runs of equal ones; the result of a run is on each of its rows."""
    place = ["_head", "_digest", "_salt"]
    ranged = rows.withColumn("_head", F.left("_t", F.lit(HEAD_CHARS))).repartitionByRange(*place)
    order = Window.partitionBy(*place).orderBy("_t", _best("doc_id", keep))
    before = F.lag("_t").over(order)
    ranged = ranged.withColumn("_start", F.when(before.isNull() | (before != F.col("_t")), 1).otherwise(0))
    ranged = ranged.withColumn("_run", F.sum("_start").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.when(F.col("_start") == 1, F.col("_t")) if texts else F.lit(None).cast("string")
    slim = ranged.select("doc_id", *place, "_run", "_start", "_carry", text.alias("_text"))
    run = Window.partitionBy(*place, "_run")
    return slim.withColumns({"keep_id": _pick(keep)("doc_id").over(run), "group_size": F.count("*").over(run)})


def _kept(runs: DataFrame, first: Column) -> DataFrame:
    return runs.select("doc_id", "keep_id", "group_size", ((F.col("_start") == 1) & first).alias("kept"),
                       "_digest", "_carry", "_text")
