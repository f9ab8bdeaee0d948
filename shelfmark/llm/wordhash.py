"""Word and shingle hashes of Arrow text columns in whole-array operations.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
Its hash takes eight bytes at a time into a state that is mixed after each (longer words end with xxh3), so
that no pattern of letters makes two words equal; a second seed gives an independent hash. Words, and runs of
words, that are equal have equal hashes in every process. Texts are read in pieces of bounded size, cut at
white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: All ASCII but letters and digits, for words without punctuation.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: The first 0 to 8 bytes of a little-endian 64-bit value.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes of a word that are taken in whole-array rounds.
LONG = 64


def _hashes(piece: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the words of a piece, given by their first and end bytes."""
    padded = np.zeros(len(piece) + 8, np.uint8)
    padded[:len(piece)] = piece
    eight = np.ndarray(len(piece) + 1, "<u8", padded, strides=(1,))
    length = last - first
    out = mix(length.astype(np.uint64) + np.uint64(BASE * (seed + 1) & ((1 << 64) - 1)))
    rows, at, left = slice(None), first, length
    for done in range(0, LONG, 8):
        out[rows] = mix(out[rows] ^ (eight[at] & FIRST[np.minimum(left, 8)]))
        more = left > 8
        rows = np.flatnonzero(more) if done == 0 else rows[more]
        if not len(rows):
            return out
        at, left = at[more] + 8, left[more] - 8
    rest = [xxhash.xxh3_64_intdigest(piece[a:a + n].tobytes(), seed) for a, n in zip(at.tolist(), left.tolist())]
    out[rows] = mix(out[rows] ^ np.array(rest, np.uint64))
    return out


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows (one more than rows); null counts as empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def word_hashes(column: pa.Array, lower: bool = False, space: np.ndarray = SPACE, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word of a column, and the row offsets in words.

    `space` marks the bytes between words.
    """
    raw, at = bytes_of(column)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    edges = at[1:-1]
    begin = 0
    while begin < len(raw):
        end = min(begin + PIECE, len(raw))
        while end < len(raw) and not space[raw[end - 1]]:
            # Grow to the next white space or row edge, so that no word is cut.
            ahead = np.flatnonzero(space[raw[end:end + 65536]])
            edge = edges[np.searchsorted(edges, end)] if len(edges) and edges[-1] >= end else len(raw)
            stop = end + int(ahead[0]) + 1 if len(ahead) else min(end + 65536, len(raw))
            end = min(stop, int(edge))
            if end == edge or len(ahead):
                break
        piece = raw[begin:end]
        word = ~space[piece]
        fresh = word.copy()
        fresh[1:] &= ~word[:-1]
        done = word.copy()
        done[:-1] &= ~word[1:]
        inner = edges[np.searchsorted(edges, begin, "right"):np.searchsorted(edges, end)] - begin
        if len(inner):
            # A row that begins inside a run of word bytes begins a new word there.
            cut = inner[word[inner]]
            fresh[cut] = True
            before = inner - 1
            done[before[word[before]]] = True
        first, last = np.flatnonzero(fresh), np.flatnonzero(done) + 1
        out.append((_hashes(LOWER[piece] if lower else piece, first, last, seed), first + begin, last + begin))
        begin = end
    if not out:
        out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)))
    hashes, first, last = (np.concatenate(x) for x in zip(*out))
    return hashes, first, last, np.searchsorted(first, at)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += words[k:k + n] * np.uint64(pow(BASE, k + 1, 1 << 64))
    return mix(out + np.uint64(size))


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts hold about `most` bytes, one row at least."""
    for batch in batches:
        column = batch.column(text)
        if not len(column):
            continue
        _, at = bytes_of(column)
        begin = 0
        while begin < len(column):
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + most, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end
