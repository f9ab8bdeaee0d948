"""Trie of conversation prefixes, for sharing what conversations begin with.

A turn is a fixed-width id, 16 big-endian bytes of a digest of its role and text, and a conversation the
bytes of its turns. Conversations with the same turns are one class. Adaptive radix trees hold the classes;
byte depths that are whole turns are the trie's nodes.

The trie is cut so that no task sees more than a bounded part of it. A prefix that more than `limit` classes
begin with belongs to the top, where there are at most (turns / limit) nodes: each has more than `limit`
turns of its own. Below the top every subtree has at most `limit` classes; subtrees are dealt over buckets by
hash, one radix tree a bucket. Counts of the top come from one aggregation, and what depends on the subtree
(leaves, savings) is summed up from the subtrees below and then through the top, which is small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed
from shelfmark.llm.radix_tree import RadixTree

WIDTH = 16
ROOT = bytes(WIDTH)
#: Turns at the head of a rebuilt conversation come from the first conversation of its group of GROUP;
#: there are fewer than HEADS of them.
GROUP, HEADS = 5, 9
#: Classes under one prefix that one task takes, at least; and nodes of the top, at most.
LEAST, MOST_TOP = 128, 500_000
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): ids and UTF-8 bytes of the texts of a conversation, in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # The length of the role keeps ('a', 'bc') and ('ab', 'c') apart.
    name = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length(role), F.concat(role, text)), 256), 1, 2 * WIDTH))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"), name.alias("id"),
                 F.octet_length(text).alias("bytes")).alias("t"))
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns"))


def heads_of(conv_id: Column) -> Column:
    """Turns that a conversation takes over."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt(lists: DataFrame) -> DataFrame:
    """(conv_id, turns) with the first turns of each taken from the first conversation of its group."""
    head = lists.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    h = heads_of(F.col("conv_id"))
    turns = F.concat(F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0)),
                     F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1))))
    return lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(head, "base", "left").select(
        "conv_id", turns.alias("turns"))


def _chained(turns: DataFrame) -> DataFrame:
    """(conv_id, digest, key, bytes, chain): all ids as one key, and a digest of every prefix."""
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, chains = [], []
            for ids in batch.column(1).to_pylist():
                own, last = [], ROOT
                for one in ids:
                    last = hashlib.blake2b(last + one, digest_size=WIDTH).digest()
                    own.append(last)
                keys.append(b"".join(ids))
                chains.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c[-1] if c else ROOT for c in chains], pa.binary()), pa.array(keys, pa.binary()),
                 batch.column(2), pa.array(chains, pa.list_(pa.binary()))], ["conv_id", "digest", "key", "bytes", "chain"])

    return turns.select("conv_id", "turns.id", "turns.bytes").mapInArrow(
        chain, "conv_id bigint, digest binary, key binary, bytes array<int>, chain array<binary>")


def _ends(members: DataFrame) -> DataFrame:
    """(digest, ends_sha256) for (digest, conv_id): SHA-256 of the ascending ids, joined by commas.

    The ids of one digest are one text, so one task reads them, in order and without keeping them.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, running = None, None
        for batch in batches:
            done = []
            ids = batch.column(1).to_pylist()
            begin = 0
            names = batch.column(0).to_pylist()
            while begin < len(names):
                end = begin + 1
                while end < len(names) and names[end] == names[begin]:
                    end += 1
                text = ",".join(map(str, ids[begin:end])).encode()
                if names[begin] == name:
                    running.update(b"," + text)
                else:
                    if running is not None:
                        done.append((name, running.hexdigest()))
                    name, running = names[begin], hashlib.sha256(text)
                begin = end
            if done:
                yield _pairs(done)
        if running is not None:
            yield _pairs([(name, running.hexdigest())])

    def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
                                          ["digest", "ends_sha256"])

    return members.repartition("digest").sortWithinPartitions("digest", "conv_id").mapInArrow(
        digest, "digest binary, ends_sha256 string")


def subtree_nodes(classes: list[dict]) -> list[tuple]:
    """Nodes below the top for classes (key, bytes, n, low, ends_sha256, cut, top), as rows of NODE and the top's digest.

    A class is cut at the depth of its last prefix in the top; the digest stands on nodes right below the top
    and is None on the others. Classes of one subtree must come together.
    """
    tree = RadixTree()
    for k, c in enumerate(classes):
        tree.insert(c["key"], k)
    rows: list[list] = []
    #: By node: classes' conversations, class with the smallest, aligned nodes next below, their leaves, savings and rows.
    sums: dict[int, tuple] = {}
    for node, begin, end in tree.bottom_up():
        n, low, kids, leaves, saved, open_ = 0, None, 0, 0, 0, []
        for c in node.all_children():
            n_, low_, kids_, leaves_, saved_, rows_ = sums.pop(id(c))
            n, kids, leaves, saved = n + n_, kids + kids_, leaves + leaves_, saved + saved_
            open_ += rows_
            if low is None or classes[low_]["low"] < classes[low]["low"]:
                low = low_
        if node.value is not None:
            own = classes[node.value]
            n += own["n"]
            if low is None or own["low"] < classes[low]["low"]:
                low = node.value
        first = classes[low]
        for depth in range(end // WIDTH, begin // WIDTH, -1):
            if depth <= first["cut"]:
                # All above is the top; the open rows are the roots of its subtrees.
                open_ = []
                break
            ends = classes[node.value]["ends_sha256"] if node.value is not None and depth * WIDTH == end else NO_ENDS
            leaves = leaves if kids else 1
            saved += (n - 1) * first["bytes"][depth - 1]
            for k in open_:
                rows[k][2], rows[k][-1] = first["low"], None
            open_ = [len(rows)]
            rows.append([first["low"], depth, None, n, kids, leaves, saved, ends, first["top"]])
            kids = 1
        sums[id(node)] = (n, low, kids, leaves, saved, open_)
    return [tuple(r) for r in rows]


def _subtrees(classes: DataFrame) -> DataFrame:
    """NODE and top for class rows with a bucket."""
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in NODE.split(", ")] + [("top", pa.binary())])

    def build(table: pa.Table) -> pa.Table:
        rows = subtree_nodes(table.to_pylist())
        return pa.Table.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema) if rows else schema.empty_table()

    return classes.groupBy("bucket").applyInArrow(build, NODE + ", top binary")


def top_nodes(rows: list[dict]) -> list[tuple]:
    """Rows of NODE for the nodes of the top (node, parent, depth, bytes, n, low, ends_sha256, kids, leaves, saved).

    kids, leaves and saved are those of the subtrees below.
    """
    at = {r["node"]: dict(r) for r in rows}
    for r in sorted(at.values(), key=lambda r: -r["depth"]):
        r["leaves"] = r["leaves"] if r["kids"] else 1
        r["saved"] += (r["n"] - 1) * r["bytes"]
        if r["parent"] is not None:
            above = at[r["parent"]]
            above["kids"] += 1
            above["leaves"] += r["leaves"]
            above["saved"] += r["saved"]
    return [(r["low"], r["depth"], at[r["parent"]]["low"] if r["parent"] is not None else None, r["n"], r["kids"],
             r["leaves"], r["saved"], r["ends_sha256"] or NO_ENDS) for r in at.values()]


def _resolved(top: DataFrame) -> DataFrame:
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in NODE.split(", ")])

    def resolve(table: pa.Table) -> pa.Table:
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*top_nodes(table.to_pylist())), schema)], schema=schema)

    return top.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(resolve, NODE)


def trie(turns: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per node for (conv_id, turns), with conv_id unique; see `prefix_trie`."""
    spark = turns.sparkSession
    members = checkpointed(_chained(turns))
    classes = members.groupBy("digest").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("low"), F.first("key").alias("key"),
        F.first("bytes").alias("bytes"), F.first("chain").alias("chain"))
    classes = checkpointed(classes.join(_ends(members.select("digest", "conv_id")), "digest"))
    size = classes.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("chain")), F.lit(0)).alias("turns")).first()
    limit = max(least, size["turns"] // MOST_TOP)

    step = F.transform("chain", lambda x, i: F.struct(
        x.alias("node"), F.when(i == 0, F.lit(ROOT)).otherwise(F.get("chain", i - 1)).alias("parent"),
        (i + 1).alias("depth"), F.get("bytes", i).alias("bytes")))
    prefixes = classes.select("digest", "n", "low", F.inline(step))
    often = checkpointed(prefixes.groupBy("node").agg(F.count("*").alias("c")).filter(F.col("c") > limit).select("node"))
    # At most MOST_TOP digests of 16 bytes.
    top = prefixes.join(F.broadcast(often), "node").groupBy("node", "parent", "depth", "bytes").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"))
    root = classes.agg(F.sum("n").alias("n"), F.min("low").alias("low")).filter(F.col("n").isNotNull()).select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"), F.lit(0).alias("bytes"), "n", "low")
    top = checkpointed(top.unionByName(root))

    cuts = prefixes.join(F.broadcast(often), "node").groupBy("digest").agg(F.max(F.struct("depth", "node")).alias("_last"))
    buckets = max(1, -(-size["n"] // (2 * limit)))
    cut = F.coalesce("_last.depth", F.lit(0))
    dealt = classes.join(cuts, "digest", "left").filter(cut < F.size("chain")).select(
        F.pmod(F.xxhash64(F.get("chain", cut)), F.lit(buckets)).alias("bucket"), "key", "bytes", "n", "low", "ends_sha256",
        cut.alias("cut"), F.coalesce("_last.node", F.lit(ROOT)).alias("top"))
    below = checkpointed(_subtrees(dealt))

    roots = below.filter(F.col("top").isNotNull()).groupBy(F.col("top").alias("node")).agg(
        F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    ends = classes.select(F.col("digest").alias("node"), "ends_sha256")
    zero = F.lit(0).cast("bigint")
    whole = top.join(ends.join(F.broadcast(top.select("node")), "node", "left_semi"), "node", "left").join(roots, "node", "left").select(
        "node", "parent", "depth", "bytes", "n", "low", "ends_sha256", F.coalesce("kids", zero).alias("kids"),
        F.coalesce("leaves", zero).alias("leaves"), F.coalesce("saved", zero).alias("saved"))
    names = top.select(F.col("node").alias("top"), F.col("low").alias("_above"))
    under = below.join(F.broadcast(names), "top", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    columns = [c.split()[0] for c in NODE.split(", ")]
    return under.select(*columns).unionByName(_resolved(whole).select(*columns))


def prefix_trie(conversations: DataFrame, rebuild: bool = True) -> DataFrame:
    """One row per distinct prefix of the (rebuilt) conversations.

    conv_id: the smallest conversation that begins with it; depth: its turns; parent_conv_id; n_convs: the
    conversations that begin with it; n_children; n_leaves: childless nodes from here down; saved_tokens: bytes
    of text that would be stored once instead of n_convs times, from here down; ends_sha256: of the ascending
    ids of the conversations that end here, joined by commas.

    Turns are ordered by turn, null first; equal turns by the digest of role and text. Null role or text is
    empty.

    - a conversation whose turns are all replaced by fewer ones is a member of the root, or of where it ends;
    - rows without conv_id belong to no conversation; repeated rows are turns of their own;
    - the remainder of a negative conv_id has its sign, as in SQL;
    - an empty table has no root and gives no rows; other columns are ignored;
    - the ids of one conversation's turns meet in one row, 20 bytes a turn; its text does not.
    """
    lists = turn_lists(conversations)
    return trie(rebuilt(checkpointed(lists)) if rebuild else lists)
