"""Uniform shuffle into shards of exact size by a communication matrix.

Rows sit in source partitions. How many of a source's rows go to each shard is drawn first, as a matrix
whose rows follow the multivariate hypergeometric distribution, so that the shard sizes come out exactly
as wanted and every arrangement is equally likely. Each source permutes its own rows and deals them out
by its matrix row; each shard then permutes what it got. Only the matrix (at most `MAX_SOURCES` rows) is
made on the driver; no task holds a whole shard, as the second permutation is a radix sort on random
keys, cut into blocks by their leading bits.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed, clean_text

MAX_SOURCES = 4096
HEADER_BYTES = 16


def hypergeometric(rng: np.random.Generator, total: int, marked: int, drawn: int) -> int:
    """Marked items among `drawn` of `total`, by inversion around the mode; any size.

    The window is twelve standard deviations to either side; what lies outside is below 1e-30.
    """
    low, high = max(0, drawn + marked - total), min(drawn, marked)
    if low >= high:
        return low
    mode = (drawn + 1) * (marked + 1) // (total + 2)
    share = marked / total
    spread = math.sqrt(drawn * share * (1 - share) * (total - drawn) / max(total - 1, 1))
    reach = int(12 * spread) + 60
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(marked - k) + np.log(drawn - k) - np.log(k + 1) - np.log(total - marked - drawn + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows from each source to each shard; row sums are `counts`, column sums `sizes`."""
    rng = np.random.default_rng(seed)
    left, matrix = list(sizes), []
    for count in counts:
        row, rest, pool = [], count, sum(left)
        for j, room in enumerate(left):
            n = hypergeometric(rng, pool, room, rest) if rest else 0
            row.append(n)
            pool, rest = pool - room, rest - n
            left[j] = room - n
        matrix.append(row)
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Counts at most one apart."""
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def shuffle_into_shards(docs: DataFrame, shards: int = 40, seed: int = 20_240_501,
                        source_rows: int = 1_024, block_rows: int = 65_536) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null).

    `size` is the UTF-8 length of the text plus a header of 16 bytes. Slots run from 0 without gaps in
    every shard. The same input files and seed give the same arrangement.

    A null text has no bytes (size 16, crc32 0), a null doc_id is dealt like any other, repeated rows
    are separate rows, and an empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = clean_text()
    # Row numbers are pinned, so that a recomputed task deals the same rows to the same places.
    base = checkpointed(docs.select(
        "doc_id", (F.octet_length(text).cast("long") + HEADER_BYTES).alias("size"),
        F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("_row"),
    ))
    n = base.count()
    sources = min(MAX_SOURCES, max(1, math.ceil(n / source_rows)))
    blocks = 1 << max(0, math.ceil(math.log2(max(1, n / shards / block_rows))))
    rows = base.withColumn("_source", F.pmod(F.xxhash64(F.lit(seed), "_row"), F.lit(sources)).cast("int"))
    counts = {r["_source"]: r["n"] for r in rows.groupBy("_source").agg(F.count("*").alias("n")).collect()}
    matrix = communication_matrix([counts.get(s, 0) for s in range(sources)], shard_sizes(n, shards), seed)
    bounds = spark.createDataFrame(
        [(s, [int(x) for x in np.cumsum([0, *row[:-1]])]) for s, row in enumerate(matrix)],
        "_source int, _from array<bigint>")

    first = Window.partitionBy("_source").orderBy(F.xxhash64(F.lit(seed + 1), "_row"), "_row")
    dealt = rows.withColumn("_at", F.row_number().over(first) - 1)
    dealt = dealt.join(F.broadcast(bounds), "_source")  # at most MAX_SOURCES x shards numbers
    shard = F.size(F.filter("_from", lambda start: start <= F.col("_at"))) - 1
    key = F.xxhash64(F.lit(seed + 2), "_row")
    block = F.shiftrightunsigned(key, 64 - int(math.log2(blocks))) if blocks > 1 else F.lit(0).cast("long")
    placed = checkpointed(dealt.select(
        "doc_id", "size", "text_crc32", "_row", shard.cast("int").alias("shard"),
        key.alias("_key"), block.alias("_block")))

    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "_block").agg(F.count("*").alias("_n")).select(
        "shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    second = Window.partitionBy("shard", "_block").orderBy("_key", "_row")
    out = placed.withColumn("_rank", F.row_number().over(second)).join(starts, ["shard", "_block"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("_start") + F.col("_rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
