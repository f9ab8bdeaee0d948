"""Packing documents into sequences by bin completion.

Texts become token ids followed by id 0; only documents over the capacity are cut. Packing depends on
lengths alone, so the number of pieces of each length, at most `capacity` numbers however large the
corpus, is all that is planned with. The plan is a list of fillings, each with the number of sequences
it is used for; pieces take their places in it by their rank among the pieces of their length.

The plan is made by bin completion: the largest length that is left opens a sequence, its undominated
fillings are branches, a branch is cut when the sum of what is left and the waste so far cannot beat the
incumbent, and best-fit decreasing gives the first incumbent. A branch uses its filling as often as the
counts allow.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed
from shelfmark.llm.wordhash import slices

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
END_ID = (0).to_bytes(4, "little")
#: Words, and parts of words, whose ids a Python worker remembers, and as many from before.
REMEMBERED = 200_000
#: Search effort: nodes of the branch and bound, probes for the fillings of one node, branches of a node.
NODES, PROBES, BRANCHES = 6_000, 400, 3
#: Rows of one length that are ranked in one task.
RANK_ROWS = 4_096

Filling = tuple[int, ...]


class Memory(dict):
    """Results of a function by its argument, each made when it is first looked up."""

    def __init__(self, function: Callable[[str], bytes]) -> None:
        self.function, self.before = function, {}

    def __missing__(self, key: str) -> bytes:
        found = self.before.get(key)
        self[key] = out = self.function(key) if found is None else found
        return out

    def tidy(self) -> None:
        """When there are many, keep those from now on that are looked up again before there are many once more."""
        if len(self) > REMEMBERED:
            self.before = dict(self)
            self.clear()


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and splits words into letters and marks, so ids are remembered by
    word, and plain words are looked up in the vocabulary by their letters and marks. Other words take the
    tokenizer's own way, and a tokenizer for which a probe shows another result is used on whole texts.
    """

    #: Latin letters that lower-case one to one and stay composed, then ASCII marks but the apostrophe.
    PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-;=-@\[-`{-~]*)")
    PROBE = "The QUICK brown-fox, naïve Ünder\nit's 12 *** don't!!  ÉTÉ. a_b ##end"

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Memory(self.word)
        self.parts = Memory(self.part)
        # Byte-level vocabularies write printable bytes as themselves and the others from 256 on.
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self.signs = [chr(b if b in printable else next(others)) for b in range(256)]
        self.by_word = True
        self.by_word = next(self.encode([self.PROBE])) == self.whole(self.PROBE)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def part(self, part: str) -> bytes:
        """Ids of letters only or marks only."""
        signs = part if part.isascii() else "".join(map(self.signs.__getitem__, part.encode()))
        ids = [x.id for x in self.tokenizer.model.tokenize(signs)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.parts[word.lower()]
        plain = self.PLAIN.fullmatch(word)
        if not plain:
            return self.whole(word)
        ids = self.parts[plain[1].lower()]
        return ids + self.parts[plain[2]] if plain[2] else ids

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for memory in (self.known, self.parts):
            memory.tidy()
        ids_of = self.known.__getitem__
        for text in texts:
            yield b"".join(map(ids_of, text.replace("\n", " ").split(" "))) if self.by_word else self.whole(text)


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """The encoder of this Python worker."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in slices(batches, 1):
            rows: list[int] = []
            out: list[tuple[int, int, int, int]] = []
            for row, ids in enumerate(encode([t or "" for t in batch.column(1).to_pylist()])):
                ids = memoryview(ids + END_ID)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append(row)
                    out.append((piece, at // 4, len(part) // 4, zlib.crc32(part)))
            made = np.array(out, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(made[:, 0].astype(np.int32)),
                 *[pa.array(made[:, k]) for k in (1, 2, 3)]], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: whole sum, and large pieces that cannot share."""
    total = sum(n * c for n, c in counts.items())
    best = -(-total // capacity)
    half = sorted((n for n in counts if 2 * n <= capacity), reverse=True)
    large = sum(c for n, c in counts.items() if 2 * n > capacity)
    best = max(best, large)
    for k in half:
        over = sum(c for n, c in counts.items() if n > capacity - k)
        middle = [(n, c) for n, c in counts.items() if capacity - k >= n and 2 * n > capacity]
        room = sum(c for _, c in middle) * capacity - sum(n * c for n, c in middle)
        small = sum(n * c for n, c in counts.items() if k <= n and 2 * n <= capacity)
        best = max(best, over + sum(c for _, c in middle) + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing over equal lengths at once."""
    open_: list[tuple[int, Filling, int]] = []  # room, filling, sequences
    for n in sorted(counts, reverse=True):
        left = counts[n]
        rest: list[tuple[int, Filling, int]] = []
        for room, filling, m in sorted(open_):
            fit = room // n
            if not left or not fit:
                rest.append((room, filling, m))
                continue
            full = min(m, left // fit)
            if full:
                rest.append((room - fit * n, filling + (n,) * fit, full))
            left -= full * fit
            m -= full
            if m and 0 < left < fit:
                rest.append((room - left * n, filling + (n,) * left, 1))
                left, m = 0, m - 1
            if m:
                rest.append((room, filling, m))
        fit = capacity // n
        if left >= fit:
            rest.append((capacity - fit * n, (n,) * fit, left // fit))
        if left % fit:
            rest.append((capacity - left % fit * n, (n,) * (left % fit), 1))
        open_ = rest
    return [(filling, m) for _, filling, m in open_]


def dominates(a: Filling, b: Filling) -> bool:
    """Whether the lengths of b can be packed into those of a (checked by first fit)."""
    rooms = sorted(a)
    for n in b:
        for i, room in enumerate(rooms):
            if room >= n:
                rooms[i] -= n
                rooms.sort()
                break
        else:
            return False
    return True


def fillings(counts: dict[int, int], lengths: list[int], room: int, most_waste: int) -> list[Filling]:
    """Undominated ways to fill `room`, least waste first; `lengths` ascending, all with a count.

    Depth first from the largest length that fits, as many copies at once as fit. A length that fills the
    room exactly dominates every other filling.
    """
    if counts.get(room):
        return [(room,)]
    found: dict[Filling, int] = {}
    probes = exact = 0

    def extend(chosen: Filling, left: int, top: int) -> bool:
        """True to stop the search; `top` is the index below which lengths may be used."""
        nonlocal probes, exact
        i = min(bisect_right(lengths, left), top) - 1
        if i < 0:
            if left <= most_waste:
                found.setdefault(chosen, left)
            return False
        if chosen and counts.get(left) and lengths[i] == left:
            found[(*chosen, left)] = 0
            exact += 1
            return exact >= BRANCHES
        while i >= 0:
            probes += 1
            n = lengths[i]
            k = min(counts[n], left // n)
            if extend(chosen + (n,) * k, left - n * k, i) or probes > PROBES:
                return True
            i -= 1
        return False

    extend((), room, len(lengths))
    kept: list[Filling] = []
    for f in sorted(found, key=lambda f: (found[f], len(f), tuple(-n for n in f)))[:4 * BRANCHES]:
        if not any(len(k) < 40 and len(f) < 40 and dominates(k, f) for k in kept):
            kept.append(f)
        if len(kept) == BRANCHES:
            break
    return kept


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """Fillings and how many sequences use each; every piece is packed whatever the effort allows."""
    counts = {n: c for n, c in counts.items() if c}
    best = best_fit(counts, capacity)
    used = sum(m for _, m in best)
    bound = lower_bound(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    # A branch on the stack: what was left, the steps so far as a linked list, sequences, sum left.
    stack: list[tuple[dict[int, int], tuple | None, int, int]] = [(counts, None, 0, total)]
    while stack and used > bound and nodes > 0:
        left, steps, bins, rest = stack.pop()
        left = dict(left)
        lengths = sorted(left)
        while lengths and nodes > 0:
            nodes -= 1
            if bins + -(-rest // capacity) >= used:
                break
            n = lengths[-1]
            left[n] -= 1
            waste = (used - 1) * capacity - bins * capacity - rest
            ways = fillings(left, lengths if left[n] else lengths[:-1], capacity - n, waste) if capacity > n else [()]
            left[n] += 1
            if not ways:
                break
            for way in reversed(ways[1:]):
                after, step, m = _use(left, (n, *way))
                stack.append((after, (step, steps), bins + m, rest - m * sum(step[0])))
            left, step, m = _use(left, (n, *ways[0]))
            steps, bins, rest = (step, steps), bins + m, rest - m * sum(step[0])
            lengths = [x for x in lengths if x in left]
        if not lengths and bins < used:
            used, best = bins, []
            while steps is not None:
                step, steps = steps
                best.append(step)
        # Untried branches hold copies of the counts; the deepest ones are the ones to try.
        del stack[:-64]
    return best


def _use(left: dict[int, int], filling: Filling) -> tuple[dict[int, int], tuple[Filling, int], int]:
    need = {n: filling.count(n) for n in set(filling)}
    m = min(left[n] // k for n, k in need.items())
    after = dict(left)
    for n, k in need.items():
        after[n] -= m * k
        if not after[n]:
            del after[n]
    return after, (filling, m), m


@dataclass(frozen=True)
class Places:
    """Where the pieces of each length go: runs of ranks, sorted by (length, first rank)."""

    key: np.ndarray
    sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    SHIFT = 48

    @classmethod
    def of(cls, plan: list[tuple[Filling, int]]) -> Places:
        taken: dict[int, int] = {}
        rows, sequence = [], 0
        for filling, m in plan:
            offset = 0
            for n in sorted(set(filling), reverse=True):
                k = filling.count(n)
                rows.append(((n << cls.SHIFT) + taken.get(n, 0), sequence, k, offset))
                taken[n] = taken.get(n, 0) + m * k
                offset += n * k
            sequence += m
        return cls(*np.array(sorted(rows), np.int64).reshape(-1, 4).T.copy())

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = (length << self.SHIFT) + rank
        at = np.searchsorted(self.key, wanted, "right") - 1
        nth = wanted - self.key[at]
        return self.sequence[at] + nth // self.copies[at], self.offset[at] + nth % self.copies[at] * length


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece of id 0; a null doc_id is packed like any other; repeated rows are
    packed each; an empty table gives an empty result; other columns are ignored.
    """
    pieces = checkpointed(token_pieces(docs, capacity, path))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places.of(complete_bins(counts, capacity))
    buckets = max(1, -(-max(counts.values(), default=1) // RANK_ROWS))

    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))
    rows = pieces.withColumn("_bucket", bucket)
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("length", "_bucket").agg(F.count("*").alias("_n")).select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("_rank", F.row_number().over(order) - 1).join(starts, ["length", "_bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_first") + F.col("_rank")).alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.find(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = dict(docs.dtypes)["doc_id"]
    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                    "sequence_id bigint, offset bigint")
