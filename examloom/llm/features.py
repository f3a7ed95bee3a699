"""Sparse hashed features of texts: one sorted list of distinct indices per document."""

from __future__ import annotations

import numpy as np

from examloom.llm import arrays as A

UPPER, LETTER, DIGIT, MARK = (np.zeros(256, np.int64) for _ in range(4))
UPPER[0x41:0x5B] = 1
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
DIGIT[0x30:0x3A] = 1
MARK[0x21:0x7F] = 1
MARK -= MARK * (LETTER | DIGIT)


def _sums(table: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(table[data])])
    return total[ends] - total[starts]


def _grams(parts: list, values: np.ndarray, at: np.ndarray, orders, tag: int) -> None:
    owner = A.owners(at)
    for n in orders:
        keep = A.whole_windows(at, n)
        parts.append((owner[keep], A.mix(A.rolling(values, n)[keep] ^ A.SEEDS[tag + n])))


def shape_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, at: np.ndarray):
    """A small code per word: case, length, marks, digits, and whether it repeats the one before."""
    length = ends - starts
    upper, letters, digits, marks = (_sums(t, data, starts, ends) for t in (UPPER, LETTER, DIGIT, MARK))
    case = np.where(upper == 0, 0, np.where((upper == letters) & (letters > 1), 2, 1))
    again = np.zeros(len(starts), np.int64)
    again[1:] = hashes[1:] == hashes[:-1]
    again[at[:-1][at[:-1] < len(again)]] = 0
    code = case
    for value, room in ((np.minimum(length // 3, 6), 7), (np.minimum(marks, 3), 4), (np.minimum(digits, 2), 3), (np.minimum(letters, 1), 2), (again, 2)):
        code = code * room + value
    return code.astype(np.uint64)


def quality_features(data: np.ndarray, borders: np.ndarray, bits: int):
    """(owner, index) of word 1- and 2-grams and word-shape 1- to 3-grams."""
    low = A.LOWER[data]
    starts, ends, at = A.words(data, borders)
    hashes = A.span_hashes(low, starts, ends)
    parts: list = []
    _grams(parts, hashes, at, (1, 2), 500)
    _grams(parts, A.mix(shape_codes(data, starts, ends, hashes, at)), at, (1, 2, 3), 510)
    return _indices(parts, bits)


def stem_features(data: np.ndarray, borders: np.ndarray, bits: int):
    """(owner, index) of words without edge marks and of their first 4, 5 and 6 bytes."""
    low = A.LOWER[data]
    outside = (LETTER | DIGIT) == 0
    starts, ends, at = A.words(low, borders, outside)
    owner = A.owners(at)
    parts = [(owner, A.mix(A.span_hashes(low, starts, ends) ^ A.SEEDS[520]))]
    for n in (4, 5, 6):
        keep = ends - starts > n
        stems = A.span_hashes(low, starts[keep], starts[keep] + n)
        parts.append((owner[keep], A.mix(stems ^ A.SEEDS[520 + n])))
    return _indices(parts, bits)


def _indices(parts, bits: int):
    owner = np.concatenate([o for o, _ in parts])
    value = np.concatenate([v for _, v in parts]) >> np.uint64(64 - bits)
    joined = (owner.astype(np.uint64) << np.uint64(bits)) | value
    joined.sort()
    if len(joined):
        new = np.ones(len(joined), bool)
        new[1:] = joined[1:] != joined[:-1]
        joined = joined[new]
    return (joined >> np.uint64(bits)).astype(np.int64), (joined & np.uint64((1 << bits) - 1)).astype(np.int64)
