"""Which of many 64-bit fingerprints differ in few bits: vertical bit planes and carry-save counters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

ONES = ~np.uint64(0)


def planes_of(fingerprints: np.ndarray) -> np.ndarray:
    """(64, words): bit l of word w of plane b is bit b of fingerprint 64 w + l; short blocks end in zero lanes."""
    padded = np.zeros(-(-len(fingerprints) // 64) * 64, "<u8")
    padded[:len(fingerprints)] = fingerprints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def near_pairs(fingerprints: np.ndarray, ends: np.ndarray, radius: int = 3, step: int = 8,
               block: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j < ends[i] of fingerprints that differ in at most ``radius`` bits, in parts.

    Row i is held against the words of 64 lanes that cover rows i .. ends[i] - 1. For each
    (row, word) three sliced counters take up one plane after another; they start so that
    the last one overflows when a lane passes the radius. A pair of row and word whose 64 lanes have all
    passed it is abandoned, looked at after every ``step`` planes.
    """
    size = len(fingerprints)
    if size < 2:
        return
    planes, rows = planes_of(fingerprints), np.arange(size)
    first, last = rows // 64, (np.maximum(ends, rows + 1) - 1) // 64
    counts = np.where(ends > rows + 1, last - first + 1, 0)
    before = np.concatenate(([0], np.cumsum(counts)))
    width = int(radius).bit_length()
    start = (1 << width) - 1 - radius
    for begin in range(0, int(before[-1]), block):
        at = np.arange(begin, min(begin + block, int(before[-1])))
        q = np.searchsorted(before, at, side="right") - 1
        w = first[q] + at - before[q]
        counters = [np.full(len(at), ONES if start >> k & 1 else np.uint64(0)) for k in range(width)]
        over, mine = np.zeros(len(at), np.uint64), fingerprints[q]
        for plane in range(64):
            carry = planes[plane][w] ^ (np.uint64(0) - (mine >> np.uint64(plane) & np.uint64(1)))
            for k in range(width):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
            if plane % step == step - 1:
                alive = over != ONES
                if not alive.all():
                    q, w, over, mine = q[alive], w[alive], over[alive], mine[alive]
                    counters = [c[alive] for c in counters]
                if not len(q):
                    break
        if len(q):
            hit, lane = np.nonzero(np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            i, j = q[hit], w[hit] * 64 + lane
            good = (j > i) & (j < ends[i])
            if good.any():
                yield i[good], j[good]


def local_roots(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index of its component for each of ``size`` rows."""
    root = np.arange(size)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := root[root], root):
                root = up
    return root
