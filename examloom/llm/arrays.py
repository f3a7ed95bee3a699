"""Whole-column work on text inside Arrow tasks: words, rolling hashes, packed buckets.

A task sees its texts as one run of UTF-8 bytes with document borders. Everything
below works on such runs with numpy, so no Python code runs per word or byte.
Runs are cut at document borders after about ``CHUNK`` bytes, which bounds the
memory of a task by ``CHUNK`` or by its longest single document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 21

# White space is the space and the five controls from tab to
# carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_random = np.random.Generator(np.random.PCG64(20240601))
BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SEEDS = _random.integers(1, 2**63, 1024, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15 | 5
BASE_INVERSE = pow(BASE, -1, 1 << 64)
WORD_BASE = 0xD1342543DE82EF95
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo ``2 ** 64``, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK + 4096), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 4 * CHUNK:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 borders of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    borders = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.zeros(0, np.uint8) if buffers[2] is None else np.frombuffer(buffers[2], np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def runs(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK):
    """(rows of the batch, bytes, borders) for runs of whole documents of about ``limit`` bytes."""
    for batch in batches:
        data, borders = text_bytes(batch.column(text))
        first, n = 0, batch.num_rows
        while first < n:
            last = int(np.searchsorted(borders, borders[first] + limit, "right")) - 1
            last = min(max(last, first + 1), n)
            own = borders[first : last + 1]
            yield batch.slice(first, last - first), data[own[0] : own[-1]], own - own[0]
            first = last


def words(data: np.ndarray, borders: np.ndarray, space: np.ndarray = SPACE):
    """Starts and ends of all words, and the n + 1 word borders of the documents."""
    inside = ~space[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    if len(data):
        cut = borders[1:-1]
        before[cut[cut < len(data)]] = False
        after[cut[cut > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, borders)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes wherever they stand."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers(BASE, len(data)), out=total[1:])
    own = (total[ends] - total[starts]) * powers(BASE_INVERSE, len(data) + 1)[starts]
    return mix(own + (ends - starts).astype(np.uint64) * SEEDS[0])


def rolling(values: np.ndarray, length: int, base: int = WORD_BASE) -> np.ndarray:
    """Hash of ``length`` consecutive values from each place; the last ``length - 1`` are void.

    Built by doubling: the hash over ``a + b`` values is the one over ``a`` plus
    a multiple of the one over ``b`` that stands ``a`` further.
    """
    n = len(values)
    done, width, out = np.zeros(n, np.uint64), 0, values.astype(np.uint64, copy=True)
    part = 1
    rest = length
    while rest:
        if rest & 1:
            if width == 0:
                done, width = out.copy(), part
            else:
                scale = np.uint64(pow(base, width, 1 << 64))
                done[: n - width] += scale * out[width:] if width < n else 0
                width += part
        rest >>= 1
        if rest:
            scale = np.uint64(pow(base, part, 1 << 64))
            nxt = out.copy()
            if part < n:
                nxt[: n - part] += scale * out[part:]
            out, part = nxt, part * 2
    return mix(done + np.uint64(length * int(SEEDS[1]) % 2**64))


def owners(borders: np.ndarray) -> np.ndarray:
    """For each element, the row it belongs to."""
    return np.repeat(np.arange(len(borders) - 1), np.diff(borders))


def whole_windows(borders: np.ndarray, length: int) -> np.ndarray:
    """True at each place whose ``length`` elements stay inside one row."""
    n = int(borders[-1])
    room = np.repeat(borders[1:], np.diff(borders)) - np.arange(n)
    return room >= length


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True at each of ``n`` places inside any of the half-open spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def distinct_pairs(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (owner, value) pairs; ``owner`` must not decrease."""
    if len(owner) == 0:
        return owner, value
    out = value.copy()
    cuts = np.flatnonzero(np.diff(owner)) + 1
    lo = 0
    for hi in [*cuts.tolist(), len(out)]:
        out[lo:hi].sort()
        lo = hi
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], out[new]


def lists(values: np.ndarray, borders: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and the borders of its rows."""
    return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(values, kind))


def blobs(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    """A binary column holding each row's values as raw bytes."""
    width = values.dtype.itemsize
    raw = np.ascontiguousarray(values)
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(borders) - 1,
        [None, pa.py_buffer((borders * width).astype(np.int64)), pa.py_buffer(raw)],
    ).cast(pa.binary())
