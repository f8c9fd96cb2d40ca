"""Words of a text as 64-bit hashes, many texts at a time, and sorted tables of them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np

#: Hashes of the text start and of words outside a vocabulary.
START, RARE = 1, 2
#: Characters that are hashed at once; a longer text is cut where a word ends.
PART = 1 << 19
NO_WORD = re.compile(r"\W")
MULTIPLIER, SPAN = 0x9E3779B97F4A7C15, 4096


@cache
def _letters() -> np.ndarray:
    """Which code points belong to words: letters, digits and the underscore."""
    known = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    known[ord("_")] = True
    return known


@cache
def _powers() -> np.ndarray:
    return np.cumprod(np.full(SPAN, MULTIPLIER, np.uint64))


def _parts(texts: list[bytes | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Lower-cased pieces of about PART characters together, with the text that each is from."""
    of, pieces, size = [], [], 0
    for k, t in enumerate(texts):
        whole, begin = (t or b"").decode("utf-8", "replace").lower(), 0
        while begin < len(whole):
            end = len(whole)
            if end - begin > PART:
                found = NO_WORD.search(whole, begin + PART)
                end = found.start() if found else end
            of.append(k)
            pieces.append(whole[begin:end])
            size, begin = size + end - begin, end
            if size >= PART:
                yield of, pieces
                of, pieces, size = [], [], 0
    if pieces:
        yield of, pieces


def hash_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts one after another, lower-cased, and how many each text has."""
    counts, out = np.zeros(len(texts), np.int64), []
    for of, pieces in _parts(texts):
        points = np.frombuffer("\n".join(pieces).encode("utf-32-le", "replace"), "<u4")
        inside = _letters()[points]
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        new = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
        sizes = np.diff(np.append(new, len(at)))
        place = np.arange(len(at)) - np.repeat(new, sizes)
        x = np.add.reduceat((points[at].astype(np.uint64) + np.uint64(1)) * _powers()[place & (SPAN - 1)], new)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x[x <= RARE] += np.uint64(RARE + 1)
        out.append(x)
        ends = np.cumsum([len(p) + 1 for p in pieces])
        np.add.at(counts, np.array(of)[np.searchsorted(ends, at[new], side="right")], 1)
    return np.concatenate(out) if out else np.empty(0, np.uint64), counts


def words(text: bytes | None) -> np.ndarray:
    return hash_words([text])[0]


def split_words(texts: list[bytes | None]) -> list[np.ndarray]:
    hashes, counts = hash_words(texts)
    return np.split(hashes, np.cumsum(counts)[:-1]) if texts else []


def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit code of two hashes in order."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


class Table:
    """Sorted hashes with columns of numbers; what is not there gives zeros."""

    def __init__(self, keys: np.ndarray, **columns: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys = keys[order]
        self.columns = {k: np.append(v[order], 0).astype(np.float32) for k, v in columns.items()}

    def at(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, len(self.keys))

    def __len__(self) -> int:
        return len(self.keys)
