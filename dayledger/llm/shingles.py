"""Distinct word shingles of whole texts as 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np

_WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BASE = np.uint64(0xC2B2AE3D27D4EB4F)

#: Bytes that separate words: space and the five controls from tab to carriage return.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to lower case, all other bytes as they are; one more than the byte, so that a zero byte counts.
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of words of each text; A-Z lower-cased, other characters as they are."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    gap = _SPACE[data]
    before = np.concatenate([[True], gap[:-1]])
    starts = np.flatnonzero(before & ~gap)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    ends = np.flatnonzero(gap & ~before)
    word = np.cumsum(before & ~gap) - 1
    inside = np.flatnonzero(~gap)
    place = inside - starts[word[inside]]
    values = _LOWER[data[inside]] * _powers(_PLACE_BASE, int((ends - starts).max()))[place]
    sums = np.add.reduceat(values, np.concatenate([[0], np.cumsum(ends - starts)[:-1]]))
    hashes = mix(sums + _WORD_BASE * (ends - starts).astype(np.uint64))
    limits = np.cumsum([len(r) + 1 for r in raw])
    counts = np.diff(np.concatenate([[0], np.searchsorted(starts, limits)]))
    return hashes, counts


def shingle_sets(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, text by text in order of hash, and their number for each text.

    A text with words but fewer than `width` has its whole word sequence as one shingle; one without words has none.
    """
    hashes, counts = word_hashes(texts)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    row = np.repeat(np.arange(len(texts)), n)
    at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    size = np.minimum(counts, width)[row]
    total = np.zeros(len(row), dtype=np.uint64)
    factor = _powers(_WORD_BASE, width + 1)
    for k in range(width):
        have = size > k
        total[have] += hashes[at[have] + k] * factor[k + 1]
    found = mix(total + size.astype(np.uint64))
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    return found[new], np.bincount(row[new], minlength=len(texts))


def shared_counts(left: list[str], right: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of texts: shingles in both, in the left, in the right."""
    found, counts = shingle_sets([t for pair in zip(left, right) for t in pair], width)
    pair = np.repeat(np.arange(len(counts)) >> 1, counts)
    order = np.lexsort((found, pair))
    found, pair = found[order], pair[order]
    both = (found[1:] == found[:-1]) & (pair[1:] == pair[:-1])
    return np.bincount(pair[1:][both], minlength=len(left)), counts[::2], counts[1::2]
