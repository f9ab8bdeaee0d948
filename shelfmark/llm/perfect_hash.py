"""Minimal perfect hash of 128-bit keys in whole-array operations.

Level by level, every key that is alone in its cell of a bit array is settled there; the others go on to the
next, smaller array. The number of a key is the rank of its bit among all set bits, so n keys get the numbers
0 to n - 1 at about four bits each. A foreign key gets some number or none: whoever looks a number up compares
a fingerprint.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from shelfmark.llm.wordhash import mix

#: Cells for each key that is left; the keys of so many levels that stay unsettled are listed instead.
SPREAD, LEVELS = 1.5, 48


def _cells(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    """Both halves of the key decide, differently on each level."""
    one, two = (np.uint64(k * (level + 1) & ((1 << 64) - 1)) for k in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))
    return ((mix(high + one) ^ mix(low ^ two)) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """Sizes of the levels, their bits one after the other, and the keys no level settled, ascending."""

    sizes: np.ndarray
    bits: np.ndarray
    rest: np.ndarray

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        """For distinct keys, given as two arrays of unsigned 64-bit halves."""
        sizes, levels = [], []
        while len(high) and len(sizes) < LEVELS:
            size = max(64, -(-int(len(high) * SPREAD) // 64) * 64)
            cells = _cells(high, low, len(sizes), size)
            alone = np.bincount(cells, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = ~alone[cells]
            high, low = high[left], low[left]
        bits = np.packbits(np.concatenate(levels)) if levels else np.zeros(0, np.uint8)
        rest = np.stack([high, low], 1)[np.lexsort((low, high))] if len(high) else np.zeros((0, 2), np.uint64)
        return cls(np.array(sizes, np.int64), bits, rest)

    def numbers(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for a foreign key that no level has a bit for."""
        found = np.full(len(high), -1, np.int64)
        flags = np.unpackbits(self.bits).astype(bool)
        ranks = np.cumsum(flags) - 1
        open_, begin = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            at = begin + _cells(high[open_], low[open_], level, int(size))
            here = flags[at]
            found[open_[here]] = ranks[at[here]]
            open_ = open_[~here]
            begin += int(size)
            if not len(open_):
                break
        if len(open_) and len(self.rest):
            listed = {(int(h), int(g)): k for k, (h, g) in enumerate(self.rest)}
            settled = int(flags.sum())
            for i in open_:
                k = listed.get((int(high[i]), int(low[i])))
                found[i] = -1 if k is None else settled + k
        return found

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.rest)], np.int64)
        return b"".join(a.tobytes() for a in (head, self.sizes, self.rest.astype(np.uint64), self.bits))

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        levels, rest = np.frombuffer(raw, np.int64, 2)
        sizes = np.frombuffer(raw, np.int64, levels, 16)
        at = 16 + 8 * int(levels)
        listed = np.frombuffer(raw, np.uint64, 2 * rest, at).reshape(-1, 2)
        return cls(sizes, np.frombuffer(raw, np.uint8, offset=at + 16 * int(rest)), listed)
