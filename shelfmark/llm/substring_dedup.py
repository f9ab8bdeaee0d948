"""Repeated passages by relative Lempel-Ziv parsing.

A window is 13 consecutive words. Equal windows choose the same anchor, the smallest hash among the
`GRAM`-word runs inside, so a first pass over anchors alone (about two for nine words) finds those that
occur in different texts; only fragments of the texts around these go on. A fragment is a run of
neighbouring windows with one anchor. Fragments are dealt over reference blocks by anchor, so that all
places where a window occurs are in one block, and every fragment meets every block that can hold any of it.

A block is indexed by depth: a node stands for all places that go on with the same words, and knows the
smallest document among them. Each distinct fragment, in the first document that holds it, is parsed
greedily: the longest run of words that an earlier document of the block holds is a factor, and the next
factor begins at its end. Factors of 13 words or more are repeats. A window that straddles the end of a
factor lies in none, so the 12 starts before each end are looked up as well. Later documents repeat the
fragment as a whole. Blocks compare the words themselves (those beyond `LONG_WORD` bytes by SHA-256).

Equal fragments are made one before they meet in a block, so a passage that very many documents share is
one row there. An anchor with more than `CUT_ROWS` places has many different fragments: there each window is
a fragment of its own, dealt by its words. Documents with one and the same word sequence are parsed once;
all but the first of them repeat as a whole.

Anchors with more than `HOT_ROWS` documents are known from a sample beforehand and need no first pass. All
other anchors have so few rows that one task takes them, or (where the sample is too small to see
HOT_ROWS) a few thousandths of the documents at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed
from shelfmark.llm.wordhash import BASE, bytes_of, mix, shingle_hashes, slices, word_hashes

WINDOW = 13
GRAM = 6
#: Rows of one anchor that one task takes.
HOT_ROWS = 250_000
#: Places of one anchor beyond which its fragments are cut into single windows, and fragments of a block.
CUT_ROWS, BLOCK_ROWS = 20_000, 20_000
#: Windows of one fragment at most, and bytes of a word beyond which its digest stands for it.
LONGEST, LONG_WORD = 64, 64
#: Documents of the sample that common anchors are taken from, and the fewest of them that show one;
#: there are at most (anchors of the sample) / LEAST_COMMON common anchors.
SAMPLE_DOCS, LEAST_COMMON = 5_000, 20
#: Parts that the places of one window at a cut anchor are dealt into.
SALTS = 32
#: Order of rows without doc_id: after all others.
LAST = (1 << 63) - 1


def window_anchors(words: np.ndarray) -> np.ndarray:
    """For every window start the smallest hash of the word runs inside the window."""
    h = shingle_hashes(words, GRAM)
    span, done = WINDOW - GRAM + 1, 1
    while done < span and len(h):
        step = min(done, span - done)
        h = np.minimum(h[:-step], h[step:]) if len(h) > step else h[:0]
        done += step
    return h


def _rows(column: pa.Array) -> Iterator[tuple[np.ndarray, bytes, np.ndarray, np.ndarray]]:
    """Word hashes, bytes, first and end byte of each word, for each row."""
    raw, at = bytes_of(column)
    words, first, last, edges = word_hashes(column)
    for row in range(len(column)):
        b, e = edges[row], edges[row + 1]
        yield words[b:e], raw[at[row]:at[row + 1]].tobytes(), first[b:e] - at[row], last[b:e] - at[row]


def _key(words: bytes) -> tuple[int, int]:
    """128 bits of words joined by one space, as two signed numbers."""
    both = xxhash.xxh3_128_intdigest(words)
    return (both & ((1 << 64) - 1)) - (1 << 63), (both >> 64) - (1 << 63)


def _keys(raw: bytes) -> tuple[int, int]:
    """128 bits of the word sequence of a text."""
    return _key(b" ".join(raw.split()))


def _measured(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Row facts: number of words, both keys of the word sequence, digest of all words, whether a common anchor is in it."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            counts, keys, hashes, touched = [], [], [], []
            for words, raw, _, _ in _rows(batch.column(1)):
                counts.append(len(words))
                keys.append(_keys(raw) if len(words) >= WINDOW else (None, None))
                hashes.append(hashlib.sha256(b" ".join(raw.split())).hexdigest())
                touched.append(bool(len(common) and np.isin(window_anchors(words), common).any()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), *(pa.array(k, pa.int64()) for k in zip(*keys)),
                 pa.array(hashes, pa.string()), pa.array(touched, pa.bool_())],
                ["doc_id", "n_words", "key", "key2", "sha", "touched"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        measure, f"doc_id {kind}, n_words bigint, key bigint, key2 bigint, sha string, touched boolean")


def _anchors(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """(anchor, key) of all anchors that are not common; half of the key will do to see that texts differ."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            keys, found = [], []
            for words, raw, _, _ in _rows(batch.column(0)):
                if len(words) >= WINDOW:
                    own = np.setdiff1d(window_anchors(words), common)
                    found.append(own)
                    keys.append(np.full(len(own), _keys(raw)[0], np.int64))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(keys))], ["anchor", "key"])

    return docs.select("text").mapInArrow(find, "anchor bigint, key bigint")


def _common_anchors(docs: DataFrame) -> np.ndarray:
    """Anchors that many texts of a bounded sample share, ascending."""
    total = docs.count()
    if total < HOT_ROWS:
        return np.zeros(0, np.uint64)
    share = min(1.0, SAMPLE_DOCS / total)
    grid = 1 << 30
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(grid)) < int(grid * share))
    counts = _anchors(sample, np.zeros(0, np.uint64)).distinct().groupBy("anchor").agg(F.count("*").alias("n"))
    found = counts.filter(F.col("n") >= max(LEAST_COMMON, int(HOT_ROWS * share))).select("anchor").toArrow()
    return np.unique(found.column("anchor").to_numpy().view(np.uint64))


def fragments(anchors: np.ndarray, wanted: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each fragment of one text.

    `wanted` marks the windows that can repeat, `alone` those at anchors that are cut into single windows.
    """
    at = np.flatnonzero(wanted)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (np.diff(at) != 1) | (anchors[at[1:]] != anchors[at[:-1]]) | alone[at[1:]]
    begin = np.flatnonzero(fresh)
    place = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(fresh | (place % LONGEST == 0))
    return at[begin], np.diff(np.append(begin, len(at)))


def _split(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Words joined by one space, and the first and end byte of each."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        # No word holds a tab, so that no word is like a digest.
        words[i] = b"\t" + hashlib.sha256(words[i]).hexdigest().encode()
        size[i] = len(words[i])
    end = np.cumsum(size + 1) - 1
    return b" ".join(words), end - size, end


def _numbers(fragments: list[bytes]) -> np.ndarray:
    """128 bits of each fragment, as two rows of signed numbers."""
    both = b"".join(map(xxhash.xxh3_128_digest, fragments))
    return np.ascontiguousarray(np.frombuffer(both, "<i8").reshape(-1, 2).T)


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows and anchors of a column of anchor lists; null lists are empty."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), size), column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def _in_row(rows: np.ndarray, anchors: np.ndarray, column: pa.Array) -> np.ndarray:
    """Whether the list of its row holds an anchor."""
    of, listed = _listed(column)
    salt = np.uint64(BASE)
    return np.isin(mix(anchors + rows.astype(np.uint64) * salt), mix(listed + of.astype(np.uint64) * salt))


def _fragments(docs: DataFrame, common: np.ndarray, places: bool) -> DataFrame:
    """Fragments of (doc, key, text, anchors, cut): number, words and document, or (`places`) where they are."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            raw, at = bytes_of(batch.column(2))
            lists = [raw[i:j].tobytes().split() for i, j in zip(at[:-1], at[1:])]
            own = batch.column(1).to_pylist()
            fits = np.array([len(w) >= WINDOW and _key(b" ".join(w))[0] == k for w, k in zip(lists, own)])
            words, _, _, edges = word_hashes(batch.column(2))
            anchors = window_anchors(words)
            row = np.repeat(np.arange(len(lists)), np.diff(edges))[:len(anchors)]
            inside = fits[row] & (np.arange(len(anchors)) + WINDOW <= edges[row + 1])
            # Neighbours with one anchor are looked up once.
            head = np.ones(len(anchors), bool)
            head[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])
            run, lengths = np.flatnonzero(head), np.diff(np.append(np.flatnonzero(head), len(anchors)))
            often = np.isin(anchors[run], common)
            wanted = np.repeat(often | _in_row(row[run], anchors[run], batch.column(3)), lengths) & inside
            alone = np.repeat(often | _in_row(row[run], anchors[run], batch.column(4)), lengths)
            begin, n = fragments(anchors, wanted, alone)
            if not len(begin):
                continue
            joined, a, e = _split([w for one in lists for w in one])
            text = [joined[i:j] for i, j in zip(a[begin].tolist(), e[begin + n + WINDOW - 2].tolist())]
            doc, cut = batch.column(0).take(pa.array(row[begin])), pa.array(alone[begin])
            if places:
                h, g = _numbers(text)
                first, count = (begin - edges[row[begin]]).astype(np.int32), (n + WINDOW - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(g), cut, pa.array(first), pa.array(count), doc,
                     batch.column(1).take(pa.array(row[begin]))], ["h", "g", "cut", "pos", "n", "doc", "key"])
            else:
                # By anchor, or by its words where it is cut.
                deal = np.where(alone[begin], shingle_hashes(words, WINDOW)[begin], anchors[begin])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(deal.view(np.int64)), cut, pa.array(text, pa.binary()), doc], ["deal", "cut", "words", "doc"])

    # What stays the same from place to place comes last, where shuffle files compress it away.
    return docs.mapInArrow(find, "h bigint, g bigint, cut boolean, pos int, n int, doc bigint, key bigint" if places else
                           "deal bigint, cut boolean, words binary, doc bigint")


def longest_earlier(ids: np.ndarray, left: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of a block: words of the longest run that a smaller document holds too, and that document.

    `ids` are the words, `left` the words from each place to the end of its fragment, `docs` its document.
    """
    longest, reference = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    at, node, depth = np.arange(len(ids)), ids.astype(np.int64), 1
    base = int(ids.max(initial=0)) + 1
    while len(at):
        names, node = np.unique(node, return_inverse=True)
        own = docs[at]
        low, high = np.full(len(names), LAST), np.full(len(names), -LAST - 1)
        np.minimum.at(low, node, own)
        np.maximum.at(high, node, own)
        low, high = low[node], high[node]
        seen = low < own
        longest[at[seen]], reference[at[seen]] = depth, low[seen]
        # Nodes of one document hold nothing for others.
        deeper = (low < high) & (left[at] > depth)
        at, node = at[deeper], node[deeper] * base
        node += ids[at + depth]
        depth += 1
    return longest, reference


def greedy_factors(begin: np.ndarray, end: np.ndarray, longest: np.ndarray, reference: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Long factors of fragments [begin, end) and long runs over factor ends: fragment, first and end place, reference."""
    out = []

    def take(fragment: np.ndarray, at: np.ndarray) -> None:
        long = longest[at] >= WINDOW
        out.append((fragment[long], at[long], at[long] + longest[at[long]], reference[at[long]]))

    live, at = np.arange(len(begin)), begin
    while len(live):
        take(live, at)
        stop = at + np.maximum(longest[at], 1)
        for back in range(1, WINDOW):
            before = stop - back
            over = (before > at) & (before + WINDOW <= end[live])
            take(live[over], before[over])
        on = stop < end[live]
        live, at = live[on], stop[on]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def _parse(block: pa.Table) -> pa.Table:
    """Repeats inside each fragment of a block, as first and end words; fragments without any, in one document, are left out."""
    block = block.combine_chunks()
    words, docs = block.column("words").combine_chunks(), block.column("first").to_numpy()
    lists = pc.split_pattern(words, " ")
    edges = lists.offsets.to_numpy().astype(np.int64)
    begin, end = edges[:-1] - edges[0], edges[1:] - edges[0]
    ids = lists.flatten().dictionary_encode().indices.to_numpy()
    fragment, first, last, _ = greedy_factors(begin, end, *longest_earlier(
        ids, np.repeat(end, end - begin) - np.arange(len(ids)), np.repeat(docs, end - begin)))
    order = np.argsort(fragment, kind="stable")
    fragment, first, last = fragment[order], first[order] - begin[fragment[order]], last[order] - begin[fragment[order]]
    keep = np.flatnonzero((np.bincount(fragment, minlength=len(docs)) > 0) | (block.column("last").to_numpy() > docs))
    at = np.searchsorted(fragment, np.append(keep, len(docs))).astype(np.int32)
    h, g = _numbers(words.take(pa.array(keep)).to_pylist())
    return pa.table({
        "h": h, "g": g, "cut": block.column("cut").take(pa.array(keep)), "first": docs[keep],
        "begin": pa.ListArray.from_arrays(pa.array(at), pa.array(first.astype(np.int32))),
        "end": pa.ListArray.from_arrays(pa.array(at), pa.array(last.astype(np.int32)))})


def _kept(docs: DataFrame) -> DataFrame:
    """What is left of (doc, key, text, first words, end words)."""
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            ids, keys, removed, hashes = [], [], [], []
            for row, (words, raw, first, last) in enumerate(_rows(batch.column(2))):
                key = batch.column(1)[row].as_py()
                if _keys(raw)[0] != key:
                    continue
                begin, end = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (3, 4))
                cover = np.bincount(begin, minlength=len(words) + 1) - np.bincount(end, minlength=len(words) + 1)
                gone = np.cumsum(cover[:-1]) > 0
                stay = np.flatnonzero(~gone)
                ids.append(batch.column(0)[row].as_py())
                keys.append(key)
                removed.append(int(gone.sum()))
                hashes.append(hashlib.sha256(b" ".join(raw[first[i]:last[i]] for i in stay)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(removed, pa.int64()), pa.array(hashes, pa.string())],
                ["_id", "_key", "_removed", "_sha"])

    return docs.mapInArrow(strip, "_id bigint, _key bigint, _removed bigint, _sha string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256.

    A word is removed when a window of 13 words over it also starts in a document with a smaller doc_id;
    windows are judged on the input. Words are runs of characters other than ASCII white space.

    - a null or empty text has no words; a text of fewer than 13 words keeps them all;
    - rows that share a doc_id do not remove from each other;
    - a row without doc_id comes after all others, and such rows do not remove from each other;
    - an empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    common = _common_anchors(docs)
    rows = checkpointed(_measured(docs, common))
    order = F.coalesce("doc_id", F.lit(LAST))
    classes = rows.filter(F.col("key").isNotNull()).groupBy("key", "key2").agg(
        F.min(order).alias("doc"), F.max("touched").alias("touched"))

    texts_at = Window.partitionBy("anchor")
    shared = _anchors(docs, common).withColumns({
        "_lo": F.min("key").over(texts_at), "_hi": F.max("key").over(texts_at), "_n": F.count("*").over(texts_at)})
    wanted = shared.filter("_lo != _hi").groupBy("key").agg(
        F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("_n") > CUT_ROWS, F.col("anchor"))).alias("cut"))
    # The first document of each text is parsed; its copies repeat as a whole.
    wanted = checkpointed(classes.join(wanted, "key", "left").filter(F.col("anchors").isNotNull() | F.col("touched")))
    texts = docs.select(order.alias("doc"), "text").join(wanted, "doc").select("doc", "key", "text", "anchors", "cut")

    size = wanted.agg(F.sum(F.coalesce(F.size("anchors"), F.lit(0)))).first()[0] or 0
    block = F.pmod(F.xxhash64("deal"), F.lit(max(1, -(-size // BLOCK_ROWS)))).alias("block")
    distinct = _fragments(texts, common, places=False).groupBy(block, "cut", "words").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last"))
    parsed = distinct.groupBy("block").applyInArrow(
        _parse, "h bigint, g bigint, cut boolean, first bigint, begin array<int>, end array<int>")
    # Only fragments of cut anchors can have many places.
    parsed = parsed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col("cut"), SALTS - 1).otherwise(0)))).drop("cut")
    places = _fragments(texts, common, places=True).withColumn(
        "salt", F.when(F.col("cut"), F.pmod(F.xxhash64("doc"), F.lit(SALTS))).otherwise(0).cast("int")).drop("cut")
    later = F.col("doc") > F.col("first")
    hits = places.join(parsed, ["h", "g", "salt"]).filter(later | (F.size("begin") > 0)).select(
        "doc", "key",
        F.when(later, F.array("pos")).otherwise(F.transform("begin", lambda x: x + F.col("pos"))).alias("begin"),
        F.when(later, F.array(F.col("pos") + F.col("n"))).otherwise(F.transform("end", lambda x: x + F.col("pos"))).alias("end"))
    # Not checkpointed: in one job the texts shuffled for the fragments serve the next join as well.
    hits = hits.groupBy("doc", "key").agg(F.collect_list(F.struct("begin", "end")).alias("_hits")).select(
        "doc", "key", F.flatten("_hits.begin").alias("begin"), F.flatten("_hits.end").alias("end"))
    parsed = docs.select(order.alias("doc"), "text").join(hits, "doc").select("doc", "key", "text", "begin", "end")
    stripped = _kept(parsed).distinct()

    first = classes.select(F.col("key").alias("_k"), F.col("key2").alias("_k2"), F.col("doc").alias("_first"))
    out = rows.join(first, (F.col("key") == F.col("_k")) & (F.col("key2") == F.col("_k2")), "left").join(
        stripped, (order == F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    copy = F.col("_first") < order
    return out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("_sha", "sha")).alias("kept_sha256"))
