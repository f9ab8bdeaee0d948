"""Lines that many documents repeat, by a sharded minimal perfect hash.

The distinct lines of the corpus are 128-bit digests, dealt into shards of bounded size. A shard is a minimal
perfect hash over its digests and three arrays in its order: a fingerprint, the number of documents (in as few
bytes as the shard needs) and the largest doc_id. A shard of 8,192 lines takes about 150 KB, whatever the lines
are, and travels as one row. Documents do not join lines: their digests are dealt to the shards and probe the
arrays there, and only digests of lines to drop come back.

A shard with a line that very many documents hold is copied (the arrays are small), and its probes are dealt
over the copies by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed
from shelfmark.llm.perfect_hash import PerfectHash
from shelfmark.llm.wordhash import bytes_of, slices

SPACE = b" \t\n\x0b\x0c\r"
SHORTEST, DOCUMENTS = 20, 3
#: Distinct lines of a shard, on average.
SHARD_LINES = 8_192
#: A shard is copied when it gets more probes than so many times the mean; at most HOT_SHARDS ones are.
HOT, HOT_SHARDS = 2, 100_000
#: Rows without doc_id count as one document, before all others.
FIRST = -(1 << 63)


def line_digest(line: bytes, shortest: int = SHORTEST) -> bytes | None:
    """128 bits of a line's key, or None for a key of fewer than `shortest` code points."""
    key = line.strip(SPACE)
    if len(key) < shortest or not key.isascii() and sum(b & 0xC0 != 0x80 for b in key) < shortest:
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()  # bytes.lower() is A-Z only


def _texts(column: pa.Array) -> Iterator[bytes]:
    raw, at = bytes_of(column)
    for begin, end in zip(at[:-1], at[1:]):
        yield raw[begin:end].tobytes()


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def document_lines(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(h, g, doc): the distinct line digests of each row, as two 64-bit halves."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found, counts = [], []
            for text in _texts(batch.column(1)):
                own = {d for line in text.split(b"\n") if (d := line_digest(line, shortest)) is not None}
                found += own
                counts.append(len(own))
            h, g = _halves(found)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(np.repeat(ids, counts), pa.int64())],
                ["h", "g", "doc"])

    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST)).alias("doc_id"), "text").mapInArrow(
        digest, "h bigint, g bigint, doc bigint")


def line_counts(lines: DataFrame) -> DataFrame:
    """(h, g, n, keeper) for (h, g, doc): documents that hold a line and the largest of them."""
    return lines.groupBy("h", "g").agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("keeper"))


def build_shards(counts: DataFrame, shards: int) -> DataFrame:
    """One row per shard: shard, hash, fingerprints, counts, width (bytes of a count), keepers."""
    def build(table: pa.Table) -> pa.Table:
        h, g, n, keeper = (table.column(c).to_numpy() for c in ("h", "g", "n", "keeper"))
        h, g = h.view(np.uint64), g.view(np.uint64)
        made = PerfectHash.build(h, g)
        order = np.argsort(made.numbers(h, g))
        kind = np.min_scalar_type(int(n.max()))
        row = {"shard": table.column("shard")[0].as_py(), "hash": made.to_bytes(), "fingerprints": g[order].tobytes(),
               "counts": n[order].astype(kind).tobytes(), "width": kind.itemsize, "keepers": keeper[order].tobytes()}
        return pa.Table.from_pylist([row], schema=schema)

    schema = pa.schema([("shard", pa.int64()), ("hash", pa.binary()), ("fingerprints", pa.binary()),
                        ("counts", pa.binary()), ("width", pa.int32()), ("keepers", pa.binary())])
    return counts.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(
        build, "shard bigint, hash binary, fingerprints binary, counts binary, width int, keepers binary")


def _shard(shards: int):
    return F.pmod(F.xxhash64("h", "g"), F.lit(shards)).cast("bigint")


def probe_shards(lines: DataFrame, index: DataFrame, loads: DataFrame, shards: int, documents: int = DOCUMENTS) -> DataFrame:
    """(doc, h, g) of the lines that a document loses: `documents` or more hold them, and it isn't the keeper.

    `loads` has the probes that each shard will get (shard, load).
    """
    def probe(key, probes: pa.Table, arrays: pa.Table) -> pa.Table:
        if not arrays.num_rows or not probes.num_rows:
            return probes.select(["doc", "h", "g"]).slice(0, 0)
        h, g = (probes.column(c).to_numpy().view(np.uint64) for c in ("h", "g"))
        doc, row = probes.column("doc").to_numpy(), arrays.slice(0, 1).to_pylist()[0]
        at = PerfectHash.from_bytes(row["hash"]).numbers(h, g)
        member = (at >= 0) & (np.frombuffer(row["fingerprints"], np.uint64)[at] == g)
        often = np.frombuffer(row["counts"], f"u{row['width']}")[at] >= documents
        lost = member & often & (np.frombuffer(row["keepers"], np.int64)[at] != doc)
        return probes.select(["doc", "h", "g"]).filter(pa.array(lost))

    total = loads.agg(F.sum("load").alias("all"), F.count("*").alias("n")).first()
    most = max(HOT * (total["all"] or 0) // max(total["n"], 1), (total["all"] or 0) // HOT_SHARDS, 1)
    # Fewer than HOT_SHARDS shards can be above the mark, so this table can always be broadcast.
    hot = F.broadcast(loads.filter(F.col("load") > most).select("shard", F.ceil(F.col("load") / most).cast("int").alias("copies")))
    copies = F.coalesce("copies", F.lit(1))
    dealt = lines.withColumn("shard", _shard(shards)).join(hot, "shard", "left").withColumn(
        "copy", F.pmod(F.xxhash64("doc"), copies).cast("int")).select("shard", "copy", "h", "g", "doc")
    copied = index.join(hot, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")
    return dealt.groupBy("shard", "copy").cogroup(copied.groupBy("shard", "copy")).applyInArrow(
        probe, "doc bigint, h bigint, g bigint")


def _kept(docs: DataFrame, shortest: int) -> DataFrame:
    """What is left of (doc_id, text, lost): number of lines, of dropped ones, and the text."""
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows, dropped, kept = [], [], []
            for text, lost in zip(_texts(batch.column(1)), batch.column(2)):
                lines = text.split(b"\n")
                gone = set()
                if lost.is_valid:
                    gone = {a.tobytes() for a in lost.values.flatten().to_numpy().reshape(-1, 2)}
                stay = [line for line in lines if not gone or line_digest(line, shortest) not in gone]
                rows.append(len(lines))
                dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string(), safe=False)], ["doc_id", "n_lines", "n_dropped", "kept"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(strip, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept string")


def drop_repeated_lines(docs: DataFrame, documents: int = DOCUMENTS, shortest: int = SHORTEST) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped and kept, the text that is left.

    A line's key is the line without ASCII white space at both ends, A-Z in lower case. Keys of `shortest` or
    more code points that `documents` or more documents hold are dropped with all their lines, except in the
    largest doc_id that holds them. The other lines stay as they are, joined by a line feed.

    - a null or empty text is one empty line;
    - rows that share a doc_id are one document: none of them loses a line that this id keeps;
    - rows without doc_id are one document, smaller than all others;
    - an empty table gives an empty result; other columns are ignored.
    """
    lines = document_lines(docs, shortest)
    counts = checkpointed(line_counts(lines))
    shards = max(1, -(-counts.count() // SHARD_LINES))
    index = checkpointed(build_shards(counts, shards))
    loads = checkpointed(counts.groupBy(_shard(shards).alias("shard")).agg(F.sum("n").alias("load")))
    lost = probe_shards(lines, index, loads, shards, documents).groupBy("doc").agg(
        F.array_sort(F.collect_set(F.struct("h", "g"))).alias("lost"))
    pairs = F.transform("lost", lambda x: F.array(x["h"], x["g"]))
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST))
    rows = docs.select("doc_id", "text", key.alias("doc")).join(lost, "doc", "left")
    return _kept(rows.select("doc_id", "text", pairs.alias("lost")), shortest)
