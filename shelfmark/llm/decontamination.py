"""Benchmark passages in documents, by latent semantic retrieval.

Document frequencies are counted over all passages of the corpus, and a distributed randomised SVD of the
TF-IDF of all passages of its distinct texts gives the latent space; every window of every document
is projected into it, window sums being differences of running sums, and compared by cosine with the
benchmark passages, which are a given, broadcast set of queries. Windows come in several lengths, each
benchmark passage meets those next to its own length. Candidates are then confirmed on their words: the
longest common subsequence must cover most of the passage, and either its answer, the end of the passage, is
there too or one run of consecutive words covers as much. Passages of fewer than SHORT words are looked up
word for word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfmark.llm.common import checkpointed, clean_text
from shelfmark.llm.wordhash import MARKS, bytes_of, shingle_hashes, slices, word_hashes

#: Terms are hashed to so many columns; size of the latent space and of the random sketch beyond it.
TERMS, RANK, EXTRA, POWER = 1 << 15, 64, 16, 1
#: Words of a passage that document frequencies and the SVD are taken over.
PASSAGE = 32
#: Fewest tasks that the passages are dealt over for the fit, and passages for which there is one more: each
#: sends TERMS x (RANK + EXTRA) numbers, so there are few.
FIT_TASKS, FIT_PASSAGES = 8, 1_000_000
#: Bytes of terms that a task takes at a time, and rows that it adds up side by side.
FIT_BYTES, SIDE = 4 << 20, 2_048
#: Words that share one running sum, and window length with stride, in such blocks.
BLOCK = 4
SCALES = ((4, 1), (6, 1), (10, 2), (16, 4))
LONGEST_WINDOW, STRIDES = max(n for n, _ in SCALES), max(k for _, k in SCALES)
#: Benchmark texts longer than this are looked for in parts; at most 64, a bit for each word.
LONGEST = 64
COSINE, COMMON, ANSWER = 0.4, 0.6, 0.5
#: Benchmark texts with fewer words say too little for a cosine: they are looked up word for word.
SHORT = 8
#: Words of a document that are projected at a time.
SEGMENT = 100_000


def terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - int(np.log2(TERMS)))).astype(np.int64)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    hashes, _, _, at = word_hashes(column, lower=True, space=MARKS)
    return hashes, at


def term_rows(docs: DataFrame) -> DataFrame:
    """The texts `_t` as their terms in order, 16 bits each, every text once with how often it occurs: _w, _n.

    Read, hashed and grouped once for all that is counted and fitted; rows that have this form are given back.
    """
    if docs.columns == ["_w", "_n"]:
        return docs

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            hashes, at = _words(batch.column(0))
            data = pa.py_buffer(terms(hashes).astype("<u2"))
            rows = pa.Array.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(2 * at.astype(np.int64)), data])
            yield pa.RecordBatch.from_arrays([rows.cast(pa.binary())], ["_w"])

    rows = docs.select("_t").mapInArrow(hashed, "_w binary").groupBy("_w").agg(F.count("*").alias("_n"))
    # In order, so that a repeated run adds up alike.
    return checkpointed(rows.sortWithinPartitions("_w"))


def _passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Terms of each passage of all rows, in order of terms and filled up with TERMS, and passages of each row."""
    raw, at = bytes_of(column)
    flat, lengths = np.frombuffer(raw.tobytes(), "<u2"), np.diff(at) // 2
    count = -(-lengths // PASSAGE)
    filled = np.full(int(count.sum()) * PASSAGE, TERMS, np.uint16)
    filled[np.arange(len(flat)) + np.repeat((np.cumsum(count) - count) * PASSAGE - at[:-1] // 2, lengths)] = flat
    out = filled.reshape(-1, PASSAGE)
    out.sort(axis=1)
    return out, count


def _fresh(passages: np.ndarray) -> np.ndarray:
    """First places of the terms of each passage."""
    out = np.ones(passages.shape, bool)
    out[:, 1:] = passages[:, 1:] != passages[:, :-1]
    return out


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Passages that hold each term, over the whole corpus, and the number of passages."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS + 1, np.int64)
        for batch in slices(batches, 0, FIT_BYTES):
            passages, of_row = _passages(batch.column(0))
            if not len(passages):
                continue
            times = np.repeat(batch.column(1).to_numpy(), of_row)
            fresh = _fresh(passages)
            found = np.bincount(passages[fresh], np.repeat(times, fresh.sum(1)), TERMS + 1).astype(np.int64)
            total[:TERMS] += found[:TERMS]
            total[TERMS] += times.sum()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "n"])

    rows = term_rows(docs).mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    found = np.zeros(TERMS + 1, np.int64)
    found[table.column("term").to_numpy()] = table.column("n").to_numpy()
    return found[:TERMS], int(found[TERMS])


def _sums(values: np.ndarray, own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the rows `values[own]` over consecutive groups of the given sizes, none of them empty.

    Groups are cut into parts of at most PASSAGE rows, which are added up side by side, longest first.
    """
    parts = -(-sizes // PASSAGE)
    first = np.cumsum(parts) - parts
    nth = np.arange(int(parts.sum())) - np.repeat(first, parts)
    begin = np.repeat(np.cumsum(sizes) - sizes, parts) + PASSAGE * nth
    length = np.minimum(np.repeat(sizes, parts) - PASSAGE * nth, PASSAGE)
    order = np.argsort(-length, kind="stable")
    out = np.empty((len(begin), values.shape[1]), np.float32)
    one = np.empty((SIDE, values.shape[1]), np.float32)
    for i in range(0, len(order), SIDE):
        rows = order[i:i + SIDE]
        at, longer = begin[rows], -length[rows]
        total = values[own[at]]
        for k in range(1, -int(longer[0])):
            n = int(np.searchsorted(longer, -k))
            total[:n] += np.take(values, own[at[:n] + k], axis=0, out=one[:n], mode="clip")
        out[rows] = total
    return out if len(out) == len(sizes) else np.add.reduceat(out, first, axis=0)


def _gram(passages: np.ndarray, idf: np.ndarray, weighted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms that the passages hold, and the rows of S'(A Q) for them: A the passages' TF-IDF scaled to unit
    length, S their counts so scaled, `weighted` the rows of Q times idf."""
    fresh = _fresh(passages)
    places = np.flatnonzero(fresh)
    times = np.diff(places, append=passages.size)
    square = np.add.reduceat((times * idf[passages[fresh]]) ** 2, np.searchsorted(places, np.arange(0, passages.size, PASSAGE)))
    held = passages < TERMS
    term, sizes = passages[held], held.sum(1)
    product = _sums(weighted, term, sizes) / np.maximum(square, 1e-12).astype(np.float32)[:, None]
    order = np.argsort(term, kind="stable")
    number, term = np.repeat(np.arange(len(passages)), sizes)[order], term[order]
    begin = np.flatnonzero(np.diff(term, prepend=-1))
    return term[begin], _sums(product, number, np.diff(begin, append=len(term)))


def latent_terms(docs: DataFrame, frequencies: np.ndarray, passages: int, seed: int = 7) -> np.ndarray:
    """Latent vector of every term, idf included, centred on the mean word; the row TERMS, of no word, is zero.

    Randomised range finder with power iteration over all passages: tasks return A'(A Q) in row blocks, the
    driver orthonormalises TERMS x (RANK + EXTRA) numbers, whatever the size of the corpus. Each text counts
    once here, however often it is repeated.
    """
    spark = docs.sparkSession
    idf = np.log((passages + 1) / (frequencies + 1)) * (frequencies > 0)
    width = RANK + EXTRA
    rows = term_rows(docs).coalesce(max(FIT_TASKS, -(-passages // FIT_PASSAGES)))
    rows_a_block = 1024

    def multiply(q: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(((q * idf[:, None]).astype(np.float32), np.append(idf, 0.0)))

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weighted, weights = sent.value
            total = np.zeros((TERMS, width), np.float32)
            for batch in slices(batches, 0, FIT_BYTES):
                held, _ = _passages(batch.column(0))
                # The passages of a long text are taken in turns.
                for i in range(0, len(held), FIT_BYTES // (2 * PASSAGE)):
                    term, product = _gram(held[i:i + FIT_BYTES // (2 * PASSAGE)], weights, weighted)
                    total[term] += product
            blocks = [total[i:i + rows_a_block].tobytes() for i in range(0, TERMS, rows_a_block)]
            own = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([own] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())],
                ["block", "task", "data"])

        def add(table: pa.Table) -> pa.Table:
            # In the order of the tasks, so that a repeated run rounds alike.
            total = sum(np.frombuffer(x.as_buffer(), np.float32).astype(np.float64) for x in table.sort_by("task").column("data"))
            data = pa.array([total.astype(np.float32).tobytes()], pa.binary())
            return pa.table({"block": table.column("block").slice(0, 1), "task": table.column("task").slice(0, 1), "data": data})

        schema = "block int, task int, data binary"
        table = rows.mapInArrow(part, schema).groupBy("block").applyInArrow(add, schema).toArrow()
        out = np.zeros((TERMS, width))
        for block, data in zip(table.column("block").to_pylist(), table.column("data").to_pylist()):
            out[block * rows_a_block:(block + 1) * rows_a_block] = np.frombuffer(data, np.float32).reshape(-1, width)
        sent.unpersist()
        return out * idf[:, None]

    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((TERMS, width)))
    for _ in range(POWER):
        q, _ = np.linalg.qr(multiply(q))
    # A'A restricted to the range: its eigenvectors are the right singular vectors.
    squares, turn = np.linalg.eigh(q.T @ multiply(q))
    top = np.argsort(squares)[::-1][:RANK]
    values = np.sqrt(np.maximum(squares[top], 1e-9))
    latent = (q @ turn[:, top]) / np.maximum(values, values[0] * 1e-3) * idf[:, None]
    share_of = frequencies / max(frequencies.sum(), 1)
    centred = (latent - share_of @ latent) * np.sqrt(max(passages, 1) / TERMS)
    return np.concatenate([centred, np.zeros((1, RANK))]).astype(np.float32)


#: Scale of passages that are looked up word for word.
EXACT = -1


@dataclass(frozen=True)
class Query:
    """A benchmark passage: its item, words and answer (the last quarter of its words)."""

    item: object
    words: np.ndarray
    answer: np.ndarray
    scale: int
    vector: np.ndarray


def benchmark_queries(benchmark: DataFrame, latent: np.ndarray) -> list[Query]:
    """Queries of all items; the benchmark is a given, small table, and each of its texts is used whole."""
    rows = benchmark.select("item_id", F.lower(clean_text()).alias("_t")).filter(
        F.col("item_id").isNotNull()).distinct().orderBy("item_id", "_t").toArrow()
    out = []
    texts = rows.column("_t").combine_chunks()
    hashes, at = _words(texts)
    for item, begin, end in zip(rows.column("item_id").to_pylist(), at[:-1], at[1:]):
        words = hashes[begin:end]
        for start in range(0, max(len(words), 1), LONGEST):
            part = words[start:start + LONGEST]
            if len(words) > LONGEST and len(part) < LONGEST:
                part = words[-LONGEST:]
            if not len(part):
                continue
            scale = int(np.argmin([abs(np.log(BLOCK * s / len(part))) for s, _ in SCALES])) if len(part) >= SHORT else EXACT
            out.append(Query(item, part, part[-max(3, len(part) // 4):], scale, unit(latent[terms(part)].sum(0))))
    return out


def unit(vector: np.ndarray) -> np.ndarray:
    return vector / max(float(np.linalg.norm(vector)), 1e-9)


def common_words(text: np.ndarray, query: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    places: dict[int, int] = {}
    for i, w in enumerate(query.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(query)) - 1
    free = full
    for w in text.tolist():
        hit = places.get(w)
        if hit:
            both = free & hit
            free = ((free + both) | (free - both)) & full
    return len(query) - free.bit_count()


def longest_run(text: np.ndarray, query: np.ndarray) -> int:
    """Length of the longest run of consecutive words that both hold."""
    same = text[:, None] == query[None, :]
    best, run = 0, np.zeros(len(query) + 1, np.int64)
    for row in same:
        run[1:] = np.where(row, run[:-1] + 1, 0)
        best = max(best, int(run.max()))
    return best


def _verbatim(words: np.ndarray, at: np.ndarray, queries: list[Query]) -> Iterator[tuple[int, Query, float, float, int]]:
    """Rows that hold a short passage word for word, each query once a row."""
    for size in sorted({len(q.words) for q in queries if q.scale == EXACT}):
        own = [q for q in queries if q.scale == EXACT and len(q.words) == size]
        names = np.array([shingle_hashes(q.words, size)[0] for q in own])
        runs = shingle_hashes(words, size)
        places = np.flatnonzero(np.isin(runs, names))
        rows = np.searchsorted(at, places, "right") - 1
        inside = places + size <= at[rows + 1]
        for q, name in zip(own, names):
            hit = inside & (runs[places] == name)
            for row in np.unique(rows[hit]):
                first = int(places[hit & (rows == row)][0])
                if np.array_equal(words[first:first + size], q.words):
                    yield int(row), q, 1.0, 1.0, first - int(at[row])


def _candidates(words: np.ndarray, at: np.ndarray, latent: np.ndarray, groups: list[tuple[np.ndarray, np.ndarray]],
                cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First word, end word, query number and cosine of windows near a query, in arrays."""
    pieces: list[tuple[int, int]] = []
    for begin, end in zip(at[:-1], at[1:]):
        for b in range(int(begin), int(end), SEGMENT - LONGEST):
            pieces.append((b, min(b + SEGMENT, int(end))))
            if b + SEGMENT >= end:
                break
    i = 0
    while i < len(pieces):
        j, size = i, 0
        while j < len(pieces) and (j == i or size + pieces[j][1] - pieces[j][0] <= 2 * SEGMENT):
            size += pieces[j][1] - pieces[j][0]
            j += 1
        batch, i = pieces[i:j], j
        flat = terms(np.concatenate([words[b:e] for b, e in batch]))
        lengths = np.array([e - b for b, e in batch])
        base = np.cumsum([0, *lengths[:-1]])
        shift = np.array([b for b, _ in batch]) - base
        blocks = -(-lengths // BLOCK)
        # Blocks of a piece, then empty ones, so that no window reaches into the next piece; all pieces begin
        # at a multiple of the strides.
        room = -(-(blocks + LONGEST_WINDOW - 1) // STRIDES) * STRIDES
        first_block = np.cumsum([0, *room])
        padded = np.full(first_block[-1] * BLOCK, TERMS)
        padded[np.arange(len(flat)) + np.repeat(first_block[:-1] * BLOCK - base, lengths)] = flat
        sums = latent[padded[::BLOCK]]
        for k in range(1, BLOCK):
            sums += latent[padded[k::BLOCK]]
        # Sums of 1, 2, 4 ... blocks from each on, of which every window length is put together.
        doubled = {1: sums}
        while 2 * max(doubled) <= LONGEST_WINDOW:
            n = max(doubled)
            doubled[2 * n] = doubled[n][:-n] + doubled[n][n:]
        count = len(sums) - LONGEST_WINDOW + 1
        owner = np.repeat(np.arange(len(batch)), room)[:count]
        within = np.arange(count) - first_block[owner]
        left = blocks[owner] - within
        for (length, stride), (numbers, vectors) in zip(SCALES, groups):
            if not len(numbers):
                continue
            window, done = None, 0
            for n, parts in reversed(doubled.items()):
                if length & n:
                    own = parts[done:done + count:stride]
                    window, done = own if window is None else window + own, done + n
            # Windows that only repeat the tail of the one before add nothing.
            rest, at_start = left[::stride], within[::stride] == 0
            fresh = (rest > 0) & ((rest >= length) | at_start | (length - rest < stride))
            norm = np.sqrt(np.einsum("ij,ij->i", window, window))
            least = np.where(fresh, np.maximum(norm, 1e-9) * np.float32(cosine), np.inf).astype(np.float32)
            score = window @ vectors.T
            hits = np.flatnonzero((score >= least[:, None]).ravel())
            if len(hits):
                row, column = np.divmod(hits, len(numbers))
                own, start = owner[row * stride], base[owner[row * stride]] + within[row * stride] * BLOCK
                stop = np.minimum(start + BLOCK * length, base[own] + lengths[own])
                yield start + shift[own], stop + shift[own], numbers[column], score[row, column] / np.maximum(norm[row], 1e-9)


def _may_share(term: np.ndarray, low: np.ndarray, high: np.ndarray, query: Query, table: np.ndarray) -> np.ndarray:
    """Which of the ranges hold enough words of the query, in any order: a bound on what they have in common.

    `table` is zero for all terms, before and after; one bit stands for each word of the query.
    """
    own = terms(query.words)
    np.bitwise_or.at(table, own, np.uint64(1) << np.arange(len(own), dtype=np.uint64))
    at = low[:, None] + np.arange(int((high - low).max()))
    bits = table[term[np.minimum(at, len(term) - 1)]]
    bits[at >= high[:, None]] = 0
    table[own] = 0
    return np.bitwise_count(np.bitwise_or.reduce(bits, axis=1)) >= COMMON * len(query.words)


def confirmed(words: np.ndarray, at: np.ndarray, latent: np.ndarray, queries: list[Query],
              groups: list[tuple[np.ndarray, np.ndarray]], cosine: float = COSINE) -> Iterator[tuple[int, Query, float, float, int]]:
    """(row, query, cosine, share of the passage in common, first word) of what is confirmed."""
    yield from _verbatim(words, at, queries)
    by_pair: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
    term, table = terms(words), np.zeros(TERMS, np.uint64)
    for begin, end, number, score in _candidates(words, at, latent, groups, cosine):
        row = np.searchsorted(at, begin, "right") - 1
        for n in np.unique(number):
            query, own = queries[n], np.flatnonzero(number == n)
            spare = len(query.words) // 2 + BLOCK
            low, high = np.maximum(begin[own] - spare, at[row[own]]), np.minimum(end[own] + spare, at[row[own] + 1])
            for k in np.flatnonzero(_may_share(term, low, high, query, table)):
                by_pair.setdefault((int(row[own[k]]), int(n)), []).append((float(score[own[k]]), int(low[k]), int(high[k])))
    for (row, number), windows in by_pair.items():
        query = queries[number]
        for score, low, high in sorted(windows, reverse=True):
            part = words[low:high]
            share = common_words(part, query.words) / len(query.words)
            if share >= COMMON and (common_words(part, query.answer) >= ANSWER * len(query.answer)
                                    or longest_run(part, query.words) >= COMMON * len(query.words)):
                yield row, query, score, share, low - int(at[row])
                break


def find_contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, common_share.

    `common_share` is the largest share of a passage of the item that a window holds in order.

    - a null or empty text, or an item without words, matches nothing; a null item_id is left out;
    - rows that share a doc_id are reported together; a null doc_id is reported as such;
    - items with the same text are reported each; an empty table on either side gives an empty result;
    - other columns are ignored.
    """
    kind, item_kind = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    texts = docs.select("doc_id", F.lower(clean_text()).alias("_t"))
    find = _searcher(texts, benchmark, cosine)
    return texts.mapInArrow(lambda batches: find(batches, 1, False), f"doc_id {kind}, item_id {item_kind}, common_share double").groupBy(
        "doc_id", "item_id").agg(F.max("common_share").alias("common_share"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """The rows that hold no benchmark passage, with all columns of `docs`."""
    texts = docs.select(F.lower(clean_text()).alias("_t"))
    find = _searcher(texts, benchmark, cosine)
    text = docs.columns.index("text")
    return docs.mapInArrow(lambda batches: find(batches, text, True), docs.schema)


def _searcher(texts: DataFrame, benchmark: DataFrame, cosine: float):
    """The search as a function of batches: found rows, or the batches without them."""
    rows = term_rows(texts)
    latent = latent_terms(rows, *document_frequencies(rows))
    queries = benchmark_queries(benchmark, latent)
    groups = []
    for scale in range(len(SCALES)):
        numbers = np.array([i for i, q in enumerate(queries) if q.scale == scale], np.int64)
        vectors = np.array([queries[i].vector for i in numbers], np.float32).reshape(-1, RANK)
        groups.append((numbers, vectors))
    # TERMS x RANK numbers and the benchmark: neither grows with the documents.
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    sent = texts.sparkSession.sparkContext.broadcast((latent, queries, groups))

    def find(batches: Iterator[pa.RecordBatch], text: int, drop: bool) -> Iterator[pa.RecordBatch]:
        latent, queries, groups = sent.value
        for batch in slices(batches, text):
            column = batch.column(text)
            if drop:
                column = pa.array([None if t is None else t.lower() for t in column.to_pylist()], pa.string())
            words, at = _words(column)
            found = list(confirmed(words, at, latent, queries, groups, cosine))
            if drop:
                keep = np.ones(len(column), bool)
                keep[[r for r, *_ in found]] = False
                yield batch.filter(pa.array(keep))
            elif found:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([r for r, *_ in found])), pa.array([q.item for _, q, *_ in found], item_type),
                     pa.array([share for *_, share, _ in found], pa.float64())], ["doc_id", "item_id", "common_share"])

    return find
