"""Benchmark passages in documents, found by one automaton over all test items.

Items are normalised (ASCII lower case; words are runs of ASCII letters, digits
and everything beyond ASCII) and cut into windows of ten words. All windows form
one Aho-Corasick automaton that reads each text once; hits are mapped back to
characters of the original text.
"""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.llm import arrays as A
from examloom.session import written

# Bytes that part words.
GAP = np.zeros(256, bool)
GAP[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
NORMAL = bytes(np.where(GAP, 0x20, A.LOWER).astype(np.uint8))

OUT = (
    "doc_id long, n_words long, n_hit long, items array<string>, "
    "spans array<struct<start:int,end:int>>"
)
BETWEEN = "doc_id long, text string, items array<string>, runs array<int>"


def _squeezed(raw: bytes) -> tuple[str, int]:
    parts = raw.translate(NORMAL).split()
    return (" " + b" ".join(parts).decode("latin-1") + " ", len(parts)) if parts else (" ", 0)


def item_windows(items: list[tuple[str, str]], length: int) -> dict[str, tuple[int, list[str]]]:
    """Window text to (its number of words, the items that have it)."""
    found: dict[str, tuple[int, set]] = {}
    for item_id, text in items:
        parts = (text or "").encode().translate(NORMAL).split()
        if item_id is None or not parts:
            continue
        width = min(length, len(parts))
        for i in range(len(parts) - width + 1):
            key = " " + b" ".join(parts[i : i + width]).decode("latin-1") + " "
            found.setdefault(key, (width, set()))[1].add(item_id)
    return {k: (w, sorted(s)) for k, (w, s) in found.items()}


_built: dict[str, object] = {}


def _automaton(key: str, shared):
    """The automaton of one block, built once per worker process."""
    if key not in _built:
        _built.clear()
        machine = ahocorasick.Automaton()
        for window, value in shared.value.items():
            machine.add_word(window, value)
        if len(machine):
            machine.make_automaton()
        _built[key] = machine
    return _built[key]


def _scan(shared, last: bool):
    key = uuid.uuid4().hex

    def run(batches):
        machine = _automaton(key, shared)
        for rows, data, borders in A.runs(batches):
            n = rows.num_rows
            raw = data.tobytes()
            before = rows.schema.names[2:]
            old_items = rows.column("items").to_pylist() if before else [[]] * n
            old_runs = rows.column("runs").to_pylist() if before else [[]] * n
            n_words, n_hit = np.zeros(n, np.int64), np.zeros(n, np.int64)
            items, runs, spans = [], [], []
            for i in range(n):
                own = raw[borders[i] : borders[i + 1]]
                text, n_words[i] = _squeezed(own)
                names, word_runs, chars = old_items[i], old_runs[i], []
                if n_words[i] and len(machine):
                    names, word_runs = _hits(machine, text, names, word_runs)
                if word_runs and last:
                    hit = A.covered(int(n_words[i]), np.array(word_runs[::2]), np.array(word_runs[1::2]))
                    n_hit[i] = hit.sum()
                    chars = _original(own, hit)
                items.append(names)
                runs.append(word_runs)
                spans.append(chars)
            if last:
                pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])
                own = {"n_words": pa.array(n_words), "n_hit": pa.array(n_hit)}
                own |= {"items": pa.array(items, pa.list_(pa.string())), "spans": pa.array(spans, pa.list_(pair))}
            else:
                own = {"text": rows.column("text"), "items": pa.array(items, pa.list_(pa.string()))}
                own |= {"runs": pa.array(runs, pa.list_(pa.int32()))}
            yield pa.RecordBatch.from_pydict({"doc_id": rows.column("doc_id")} | own)

    return run


def _hits(machine, text: str, names: list[str], runs: list[int]):
    """The items found so far and the flat borders of hit word runs, with this scan's."""
    ends, widths, found = [], [], set(names)
    for end, (width, ids) in machine.iter(text):
        ends.append(end)
        widths.append(width)
        found.update(ids)
    if not ends:
        return names, runs
    blanks = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 0x20)
    stop = np.searchsorted(blanks, np.array(ends))
    flat = np.stack([stop - np.array(widths), stop], axis=1).reshape(-1)
    return sorted(found), [*runs, *flat.tolist()]


def _original(raw: bytes, hit: np.ndarray) -> list[dict]:
    """Character spans, in the text as it came, of the maximal runs of hit words."""
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = A.words(data, np.array([0, len(data)]), GAP)
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    first, past = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [
        {"start": int(chars[starts[f]]), "end": int(chars[ends[p - 1]])}
        for f, p in zip(first, past, strict=True)
    ]


def _blocks(items: DataFrame, bound: int) -> list[list[tuple[str, str]]]:
    """The items in blocks of at most about ``bound`` bytes of text each."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // bound))
    if n == 1:
        return [[tuple(r) for r in items.select("item_id", "text").collect()]]
    spread = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n)))
    spread = written(spread.select("item_id", "text", "block"), "items")
    return [
        [tuple(r) for r in spread.where(F.col("block") == k).select("item_id", "text").collect()]
        for k in range(n)
    ]


def contamination(
    docs: DataFrame, items: DataFrame, length: int = 10, block_bytes: int = 4 << 20
) -> DataFrame:
    """Hit words of ``docs(doc_id, text)`` by windows of ``items(item_id, text)``.

    Returns doc_id, n_words, n_hit, items (with occurring windows, sorted as
    strings) and spans (character ranges of the original text). Null and empty
    texts have no words. An item with fewer words than ``length`` is one window;
    one without words or id has none. Repeated items count once by id. Further
    columns are not read.

    The items are a stated query set. Up to ``block_bytes`` of item text they are
    one automaton, sent to each executor once; a larger set is scanned for in
    blocks of that size, one pass each, so what is broadcast has a fixed bound.
    No row moves.
    """
    ids = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    context = docs.sparkSession.sparkContext
    blocks = _blocks(ids, block_bytes)
    for k, block in enumerate(blocks):
        shared = context.broadcast(item_windows(block, length))
        last = k == len(blocks) - 1
        wanted = wanted.mapInArrow(_scan(shared, last), OUT if last else BETWEEN)
        wanted = wanted if last else written(wanted, "scan")
    return wanted
