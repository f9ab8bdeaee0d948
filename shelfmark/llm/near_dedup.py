"""Near duplicates by bottom-k sketches.

The shingles of a text are hashed by one function; its sketch is the `SKETCH` smallest hashes. An
inverted list holds the documents that retain a value. Documents that share a list are candidates, the
sketch of their union estimates their similarity, and exact set comparison decides.

Documents with one and the same set are one class and enter as one vertex. A value retained by more than
`LIST_LIMIT` classes is common. A document with enough uncommon values is found through those: a partner
at the threshold shares all but a small part of its values. A document made of common values (boilerplate,
or one of a large family of copies) also enters the lists of the common ones among its `FEW` smallest.
Such a list is cut into blocks of bounded size, every pair of blocks is compared exactly in one task, and
only links that join two parts leave it, so a family of n copies gives about n rows and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed
from shelfmark.llm.components import components
from shelfmark.llm.wordhash import shingle_hashes, slices, word_hashes

WORDS = 5
SKETCH = 32
LIST_LIMIT = 32
#: Uncommon values among the retained that make a document findable through them alone. Of 32 retained
#: values at 0.85, all of 20 uncommon ones missing in the partner's sketch has odds below 1e-9. A set of
#: SMALL shingles or fewer is retained whole, as is any partner's: more than 15% of it is certain.
UNCOMMON, SMALL, SMALL_SHARE = 20, 27, 0.15
#: Smallest retained values whose lists other documents enter; none of 10 shared has odds of 0.15**10.
FEW = 10
#: Shared part of the union sketch below which a pair is dropped; 12 of 32 is eight deviations under 0.85.
ESTIMATE = 0.375
#: The threshold that these five hold for; `limits` has them for lower ones, down to LOWEST.
DERIVED, LOWEST = 0.85, 0.45
#: Shingles in a block of a common list (8 bytes each).
BLOCK_SHINGLES = 400_000
BROADCAST_VALUES = 1_000_000


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; fewer than WORDS words make one shingle of all."""
    words, _, _, at = word_hashes(column, lower=True)
    runs = shingle_hashes(words, WORDS)
    for begin, end in zip(at[:-1], at[1:]):
        if end - begin >= WORDS:
            yield np.unique(runs[begin:end - WORDS + 1])
        elif end > begin:
            yield shingle_hashes(words[begin:end], int(end - begin))
        else:
            yield np.zeros(0, np.uint64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    at = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values.view(np.int64)))


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit digest of the set, null when empty) and sketch."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = list(shingle_sets(batch.column(1)))
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                 _lists([s[:SKETCH] for s in sets])], ["doc_id", "n_shingles", "set_key", "sketch"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        measure, f"doc_id {kind}, n_shingles bigint, set_key binary, sketch array<bigint>")


def limits(threshold: tuple[int, int]) -> tuple[int, int, int, int, float]:
    """UNCOMMON, SMALL, FEW, SMALL_SHARE and ESTIMATE for a threshold, at the odds stated for 0.85."""
    num, den = threshold
    if num * 100 >= 85 * den:
        return UNCOMMON, SMALL, FEW, SMALL_SHARE, ESTIMATE
    share = num / den
    if share < LOWEST:
        raise ValueError(f"sketches of {SKETCH} values find no pairs with certainty below {LOWEST}")
    # A value is missing in a partner's sketch with odds of 1 - share: more of them are needed for the same odds.
    more = np.log(1 - DERIVED) / np.log(1 - share)
    deviations = (DERIVED - ESTIMATE) / np.sqrt(DERIVED * (1 - DERIVED))
    return (min(int(np.ceil(UNCOMMON * more)), SKETCH + 1), SKETCH * num // den, min(int(np.ceil(FEW * more)), SKETCH),
            (den - num) / den, float(max(0, share - deviations * np.sqrt(share * (1 - share)))))


def _close(a: Column, b: Column, threshold: tuple[int, int]) -> Column:
    """Set sizes that can reach the threshold at all."""
    return F.least(a, b) * threshold[1] >= F.greatest(a, b) * threshold[0]


def _estimated(pairs: DataFrame, classes: DataFrame, estimate: float) -> DataFrame:
    """Pairs (a, b) whose union sketch does not rule out a link."""
    left = classes.select(F.col("node").alias("a"), F.col("sketch").alias("_sa"), F.col("n").alias("_na"))
    right = classes.select(F.col("node").alias("b"), F.col("sketch").alias("_sb"), F.col("n").alias("_nb"))
    union = F.slice(F.array_sort(F.array_union("_sa", "_sb")), 1, SKETCH)
    shared = F.size(F.array_intersect(F.array_intersect("_sa", "_sb"), "_u"))
    return pairs.join(left, "a").join(right, "b").withColumn("_u", union).filter(
        shared >= F.size("_u") * estimate).select("a", "b").distinct()


def _full_sets(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The whole shingle sets of some ids: node, s (64-bit hashes, ascending)."""
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = pa.array([s.tobytes() for s in shingle_sets(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], ["node", "s"])

    kind = dict(docs.dtypes)["doc_id"]
    wanted = nodes.select(F.col("node").alias("doc_id")).distinct()
    return docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").mapInArrow(full, f"node {kind}, s binary")


def _verified(pairs: DataFrame, sets: DataFrame, kind: str, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    num, den = threshold

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if min(len(x), len(y)) * den < max(len(x), len(y)) * num:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    rows = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
    return rows.select("a", "b", "x", "y").mapInArrow(compare, f"a {kind}, b {kind}")


def joining_links(nodes: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Links within a block (all sides 0), or between two blocks, that join parts not yet joined."""
    num, den = threshold
    lengths = np.array([len(s) for s in sets])
    starts = np.cumsum([0, *lengths[:-1]])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    flags = np.zeros(ids.max() + 1, np.uint8)
    part = np.arange(len(sets))
    across = bool(sides.any())
    links = []
    for y in np.flatnonzero(sides == 1) if across else range(1, len(sets)):
        other = sides == 0 if across else np.arange(len(sets)) < y
        other &= (part != part[y]) & (np.minimum(lengths, lengths[y]) * den >= np.maximum(lengths, lengths[y]) * num)
        if not other.any():
            continue
        own = ids[starts[y]:starts[y] + lengths[y]]
        flags[own] = 1
        met = np.add.reduceat(flags[ids], starts, dtype=np.int64)
        flags[own] = 0
        for x in np.flatnonzero(other & (den * met >= num * (lengths + lengths[y] - met))):
            if part[x] != part[y]:
                part[part == part[x]] = part[y]
                links.append((int(nodes[x]), int(nodes[y])))
    return links


def _joined_in_lists(members: DataFrame, sets: DataFrame, kind: str, threshold: tuple[int, int]) -> DataFrame:
    """Links (a, b) among the members (v, node, n) of common lists, compared block by block."""
    blocks = members.groupBy("v").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("_g"))
    placed = members.join(blocks, "v").withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_g")).cast("int"))
    paired = placed.select("v", "node", "_own", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)).alias("_with"))
    paired = paired.select("v", "node", F.least("_own", "_with").alias("i"), F.greatest("_own", "_with").alias("j"),
                           (F.col("_own") > F.col("_with")).cast("int").alias("side"))

    def compare(table: pa.Table) -> pa.Table:
        links = joining_links(
            table.column("node").to_numpy(), table.column("side").to_numpy(),
            [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("s")], threshold)
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return paired.join(sets, "node").groupBy("v", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = (85, 100), list_limit: int = LIST_LIMIT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two ids are linked when the Jaccard similarity of their shingle sets reaches `threshold` (a fraction);
    component_id is the smallest id reachable and kept tells that it is the row's own.

    - texts without words, empty or null, have an empty set and are linked with nothing;
    - rows that share a doc_id are one vertex with the links of each of them;
    - a row without doc_id is no vertex: its component_id is null, and it is kept;
    - an empty table gives an empty result; other columns are ignored;
    - a threshold below LOWEST is an error.
    """
    uncommon, small_set, few, small_share, estimate = limits(threshold)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    kind = "bigint"
    rows = checkpointed(sketched(docs))
    classes = checkpointed(
        rows.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull()).groupBy("set_key").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")))
    postings = classes.select("node", "n", F.explode("sketch").alias("v"))
    common = checkpointed(postings.groupBy("v").agg(F.count("*").alias("c")).filter(F.col("c") > list_limit).select("v"))
    n_common = common.count()
    small = F.broadcast(common) if n_common <= BROADCAST_VALUES else common

    listed = postings.join(small, "v", "left_anti").groupBy("v").agg(
        F.array_sort(F.collect_list(F.struct("node", "n"))).alias("l")).filter(F.size("l") > 1)
    ordered = F.transform(F.col("l"), lambda x, i: F.struct(x["node"].alias("a"), x["n"].alias("na"), F.slice(F.col("l"), i + 2, F.size("l")).alias("r")))
    pairs = listed.select(F.explode(ordered).alias("p")).select("p.a", "p.na", F.explode("p.r").alias("q"))
    pairs = pairs.filter(_close(F.col("na"), F.col("q.n"), threshold) & (F.col("a") != F.col("q.node")))
    pairs = pairs.select("a", F.col("q.node").alias("b")).distinct()

    pairs = checkpointed(_estimated(pairs, classes, estimate))
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node"))

    members = None
    if n_common:
        retained = classes.select("node", "n", F.posexplode("sketch").alias("_at", "v"))
        mixed = retained.join(small.withColumn("_common", F.lit(1)), "v", "left")
        rare = F.count("*") - F.count("_common")
        heavy = mixed.groupBy("node").agg(rare.alias("_rare"), F.max("n").alias("_n")).filter(
            F.when(F.col("_n") <= small_set, F.col("_rare") <= F.col("_n") * small_share + 1e-9).otherwise(F.col("_rare") < uncommon))
        members = checkpointed(mixed.filter((F.col("_common") == 1) & (F.col("_at") < few)).join(
            heavy, "node", "left_semi").select("v", "node", "n"))
        nodes = nodes.unionByName(members.select("node"))
    sets = checkpointed(_full_sets(nodes, docs))
    found = _verified(pairs, sets, kind, threshold)
    if members is not None:
        found = found.unionByName(_joined_in_lists(members, sets, kind, threshold))

    # An id with several texts is one vertex: it joins the classes of all of them.
    several = rows.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.collect_set("set_key").alias("_keys")).filter(F.size("_keys") > 1)
    named = several.select("doc_id", F.explode("_keys").alias("set_key")).join(classes.select("set_key", "node"), "set_key")
    shared = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.collect_set("node").alias("_all")).select(
        "a", F.explode("_all").alias("b")).filter("a != b")
    found = components(found.unionByName(shared))

    # A class is named by its smallest id.
    by_class = classes.select("set_key", "node").join(found, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("_component"))
    out = rows.join(by_class, "set_key", "left")
    alone = F.col("doc_id").isNull() | F.col("set_key").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("_component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, threshold: tuple[int, int] = (85, 100)) -> DataFrame:
    """One row of each group, with all columns of `docs`; rows without doc_id stay."""
    gone = near_duplicates(docs, threshold).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
