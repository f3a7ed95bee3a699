"""Packing of tokenised documents into sequences of bounded length.

Shortest-pack-first over the histogram of piece lengths: lengths are placed
longest first, each into the packs with most room, and packs of equal content are
one pattern with a count. The histogram has at most ``limit`` entries whatever the
input, so patterns are made on the driver; documents meet them by their rank
among the pieces of their length, inside the tasks that hold them.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from examloom.llm import arrays as A
from examloom.session import written


# Words whose letters and composed forms are the same everywhere, and how
# bytes are folded: capitals to small letters, line ends and tabs to blanks.
PLAIN = "^[a-zÀ-ÖØ-öø-ÿ]+$"
FOLD = A.LOWER.copy()
FOLD[[0x09, 0x0A, 0x0D]] = 0x20
TEXT_RUN = 8 << 20  # bytes of text encoded at once, or one longer text


@dataclass(frozen=True)
class Slots:
    """Where the pieces of each length go.

    Row k says: of the remainders of ``length`` tokens, those of rank
    ``lo <= rank < hi`` have their tokens ``start .. start + part`` in sequence
    ``sequence + rank - lo`` at ``offset``. Rows of one length and rank come in
    the order of ``start``.
    """

    length: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    start: np.ndarray
    part: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    n_sequences: int


def pack_histogram(counts: dict[int, int], limit: int) -> list[tuple[int, list[int]]]:
    """(count, lengths) patterns by shortest-pack-first, longest lengths first."""
    heap: list[tuple[int, int]] = []  # (tokens in the pack, pattern)
    patterns: list[list] = []  # [count, lengths]

    def push(count, lengths):
        patterns.append([count, lengths])
        heapq.heappush(heap, (sum(lengths), len(patterns) - 1))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not heap or heap[0][0] + length > limit:
                push(left, [length])
                left = 0
                continue
            _, k = heapq.heappop(heap)
            count, lengths = patterns[k]
            used = min(count, left)
            left -= used
            patterns[k][0] = 0
            push(used, [*lengths, length])
            if count > used:
                push(count - used, lengths)
    return [(c, lengths) for c, lengths in patterns if c]


def fill_gaps(patterns: list[tuple[int, list[int]]], limit: int, waste: float):
    """(count, parts) with parts (length, start, size), gaps filled by cut pieces.

    The emptiest packs are taken apart and their pieces cut to the gaps of the
    others, widest gap first, until at most ``waste`` of all room is padding.
    """
    packs = [(sum(x), c, [(n, 0, n) for n in x]) for c, x in patterns]
    packs.sort(key=_fill)
    total = sum(c * size for size, c, _ in packs)
    n = sum(c for _, c, _ in packs)
    while len(packs) > 1 and n * limit - total > waste * n * limit:
        size, count, parts = packs[0]
        room = sum(c * (limit - s) for s, c, _ in packs[1:])
        taken = min(count, room // size)
        if not taken:
            break
        kept = [(size, count - taken, parts)] if count > taken else []
        rest = packs[1:]
        for piece in parts:
            rest = _cut_into(rest, taken, piece, limit)
        packs = sorted(kept + rest, key=_fill)
        n -= taken
    return [(c, parts) for _, c, parts in packs]


def _fill(pack) -> int:
    return pack[0]


def _cut_into(packs, count, piece, limit):
    """Spread ``count`` copies of a piece over the gaps of sorted ``packs``."""
    length, start, size = piece
    todo, open_packs = [(count, start, size)], list(packs)
    while todo:
        n, at, tokens = todo.pop()
        filled, c, parts = open_packs.pop(0)
        part, used = min(limit - filled, tokens), min(n, c)
        bisect.insort(open_packs, (filled + part, used, [*parts, (length, at, part)]), key=_fill)
        if c > used:
            bisect.insort(open_packs, (filled, c - used, parts), key=_fill)
        if tokens > part:
            todo.append((used, at + part, tokens - part))
        if n > used:
            todo.append((n - used, at, tokens))
    return open_packs


def slots(packs, first: int) -> Slots:
    """Number sequences from ``first`` and hand out the ranks of each length.

    Copies of one length can be exchanged for one another, so a rank takes any
    chain of parts in which each begins where the one before ends.
    """
    rows, sequence = [], first
    given: dict[tuple[int, int], list] = {}
    for count, parts in packs:
        offset = 0
        for length, start, size in parts:
            given.setdefault((length, start), []).append((size, count, sequence, offset))
            offset += size
        sequence += count
    by_length: dict[int, list] = {}
    for (length, start), uses in given.items():
        by_length.setdefault(length, []).append((start, uses))
    for length, starts in by_length.items():
        pool = {start: [list(u) for u in uses] for start, uses in starts}
        rank = 0
        while pool.get(0):
            chain, at = [], 0
            while at < length:
                chain.append((at, pool[at][0]))
                at += pool[at][0][0]
            n = min(use[1] for _, use in chain)
            for at, use in chain:
                rows.append((length, rank, rank + n, at, use[0], use[2], use[3]))
                use[1] -= n
                use[2] += n
                if not use[1]:
                    pool[at].pop(0)
            rank += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 7)
    return Slots(*table.T, n_sequences=sequence - first)


class WordIds:
    """Ids of texts, word by word: a word between blanks always has the same ids.

    Texts are handled as one run of bytes: capitals are lowered and a closing mark
    behind a letter is set off by a blank, which changes no id, so that case and marks
    do not make new words. Arrow splits the run and numbers its distinct words; only
    those are looked up, and new ones are encoded many at a time. At most ``room`` words
    are kept, then the store starts anew.
    """

    def __init__(self, path: str, room: int = 1_000_000):
        from tokenizers import Tokenizer

        self.machine, self.room = Tokenizer.from_file(path), room
        vocabulary = self.machine.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self):
        self.number: dict[str, int] = {}
        self.ids, self.at, self.used = np.zeros(1 << 20, "<u4"), np.zeros(1 << 18, np.int64), 0

    def _store(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        n = len(self.number)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(words) >= len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.at[n + 1 : n + 1 + len(words)] = self.used + ends
        self.used += len(ids)
        self.number.update(zip(words, range(n, n + len(words))))

    def _learn(self, words: list[str], plain: bool) -> None:
        """Encode words together. ``plain`` ones are letters only: each ends with its first end mark."""
        got = self.machine.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(got.ids, "<u4")
        if plain:
            ends = np.flatnonzero(self.closes[ids]) + 1
        else:
            places = np.array([start for start, _ in got.offsets], np.int64)
            owner = np.searchsorted(np.cumsum([len(w) + 1 for w in words]), places, "right")
            ends = np.cumsum(np.bincount(owner, minlength=len(words)))
        self._store(words, ids, ends)

    def _learn_all(self, new: pa.Array) -> None:
        plain = pc.match_substring_regex(new, PLAIN)
        for words, kind in ((new.filter(plain), True), (new.filter(pc.invert(plain)), False)):
            words = words.to_pylist()
            for k in range(0, len(words), 1000):
                self._learn(words[k : k + 1000], kind)

    def _numbers(self, distinct: pa.Array) -> np.ndarray:
        """The number of each of these words in the store."""
        words = distinct.to_pylist()
        found = [self.number.get(w, -1) for w in words]
        new = np.array([k for k, n in enumerate(found) if n < 0], np.int64)
        if not len(new):
            return np.array(found, np.int64)
        if self.number and len(self.number) + len(new) > self.room:
            self._clear()
            new = np.arange(len(words))
        self._learn_all(distinct.take(pa.array(new)))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def encode(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, given as bytes with borders, and the borders of each text's ids."""
        data, borders = spaced_marks(FOLD[data], borders)
        texts = pa.Array.from_buffers(
            pa.large_string(), len(borders) - 1,
            [None, pa.py_buffer(np.ascontiguousarray(borders, np.int64)), pa.py_buffer(data)],
        )
        parts = pc.split_pattern(texts, " ")
        coded = pc.dictionary_encode(pc.list_flatten(parts))
        codes = self._numbers(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        begin = self.at[codes]
        sizes = self.at[codes + 1] - begin
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], sizes)]
        words = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])
        return ids, ends[words]


def spaced_marks(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and borders with a blank between a letter and a closing mark that ends a word.

    Letters are those of ``PLAIN``: before them and after the mark the tokenizer cuts
    anyway. Other marks, and marks behind anything else, stay where they are.
    """
    n = len(data)
    if not n:
        return data, borders
    last = np.append(data[1:] == 0x20, True)
    ends = borders[1:-1]
    last[ends[(ends > 0) & (ends < n)] - 1] = True
    mark = np.flatnonzero(last & ((data == 0x2E) | (data == 0x2C)))
    mark = mark[mark >= 2]
    one, two = data[mark - 1], data[mark - 2]
    letter = (one >= 0x61) & (one <= 0x7A)
    letter |= (two == 0xC3) & (one >= 0x80) & (one <= 0xBF) & (one != 0x97) & (one != 0xB7)
    mark = mark[letter]
    first = borders[np.searchsorted(borders, mark, "right") - 1]
    wide = data[mark - 1] >= 0x80
    mark = mark[mark - first > wide]  # the letter belongs to the same text
    moved = borders + np.searchsorted(mark, borders)
    return np.insert(data, mark, 0x20), moved


_encoders: dict[str, WordIds] = {}


def _tokens(path: str, end_id: int):
    def run(batches):
        if path not in _encoders:
            _encoders[path] = WordIds(path)
        encoder = _encoders[path]
        for rows, data, borders in A.runs(batches, limit=TEXT_RUN):
            ids, borders = encoder.encode(data, borders)
            ids = np.insert(ids, borders[1:], end_id)
            borders = borders + np.arange(len(borders))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(borders)), A.blobs(ids.astype("<u4"), borders)],
                names=["doc_id", "n", "ids"],
            )

    return run


PIECE = (
    "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def _pieces(shared, limit: int):
    def run(batches):
        s: Slots = shared.value
        keys = s.length << 40 | s.lo
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids, n = row["ids"], row["n"]
                whole = n // limit * limit
                cuts = [(k * limit, limit, row["full"] + k, 0) for k in range(n // limit)]
                rest = n - whole
                if rest:
                    k = int(np.searchsorted(keys, rest << 40 | row["rank"], "right")) - 1
                    lo = s.lo[k]
                    while k >= 0 and s.length[k] == rest and s.lo[k] == lo:
                        k -= 1
                    k += 1
                    while k < len(keys) and s.length[k] == rest and s.lo[k] == lo:
                        at = whole + int(s.start[k])
                        cuts.append((at, int(s.part[k]), int(s.sequence[k] + row["rank"] - lo), int(s.offset[k])))
                        k += 1
                for at, size, sequence, offset in cuts:
                    own = ids[4 * at : 4 * (at + size)]
                    out.append(
                        {
                            "doc_id": row["doc_id"], "start": at, "length": size, "ids": own,
                            "ids_crc32": zlib.crc32(own), "doc_tokens": n,
                            "sequence_id": sequence, "offset": offset,
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    return run


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    + [(c, pa.int64()) for c in ("ids_crc32", "doc_tokens", "sequence_id", "offset")]
)


def packed(
    docs: DataFrame, tokenizer: str, limit: int = 4096, end_id: int = 2, waste: float = 0.002, salts: int = 64
) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` in sequences of at most ``limit`` tokens.

    Returns doc_id, start, length, ids (little-endian unsigned 32-bit), ids_crc32,
    doc_tokens, sequence_id and offset. A document's ids end with ``end_id``; null
    and empty texts are that id alone. Every id lies in one piece, and offsets of a
    sequence are gapless from 0. Longer documents fill whole sequences with their
    first ids; remainders follow the packing patterns. ``waste`` is the share of
    padding from which on the emptiest packs are cut into the gaps of others.
    Rows that repeat a doc_id, or have none, are packed like any other.

    Each text is tokenised once; ids are written to the shared folder. Ranks among
    equal lengths are counted per salt of the document, so many documents of one
    length, copies for example, are numbered by many tasks. What the driver sees
    are counts by length and salt; what tasks get are the patterns. Both have a
    size set by ``limit`` and ``salts`` alone.
    """
    spark = docs.sparkSession
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tokens = wanted.mapInArrow(_tokens(tokenizer, end_id), "doc_id long, n long, ids binary")
    tokens = written(
        tokens.withColumns(
            {
                "rest": F.col("n") % limit,
                "salt": F.pmod(F.xxhash64("doc_id", F.crc32("ids")), F.lit(salts)).cast("int"),
            }
        ),
        "tokens",
    )
    groups = tokens.groupBy("rest", "salt").agg(
        F.count("*").alias("c"), F.sum(F.expr(f"n div {limit}")).alias("full")
    )
    counted = sorted(tuple(r) for r in groups.collect())
    counts: dict[int, int] = {}
    starts, full = [], 0
    for rest, salt, c, whole in counted:
        starts.append((rest, salt, counts.get(rest, 0), full))
        counts[rest] = counts.get(rest, 0) + c
        full += whole
    counts.pop(0, None)
    packs = fill_gaps(pack_histogram(counts, limit), limit, waste)
    shared = spark.sparkContext.broadcast(slots(packs, full))
    first = spark.createDataFrame(starts or [(0, 0, 0, 0)], "rest long, salt int, before long, full_before long")
    own = Window.partitionBy("rest", "salt").orderBy("doc_id", "n", F.crc32("ids"))
    ranked = tokens.join(F.broadcast(first), ["rest", "salt"]).withColumns(
        {
            "rank": F.col("before") + F.row_number().over(own) - 1,
            "full": F.col("full_before")
            + F.sum(F.expr(f"n div {limit}")).over(own.rowsBetween(Window.unboundedPreceding, 0))
            - F.expr(f"n div {limit}"),
        }
    )
    return ranked.select("doc_id", "n", "ids", "rank", "full").mapInArrow(_pieces(shared, limit), PIECE)
