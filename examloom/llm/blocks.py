"""Repeated word sequences by fixed-block anchors.

Each document is cut into blocks of ``block`` words that do not overlap; they are
the index. Every rolling window of that many words probes it. A window of
``length`` words holds at least one whole block of whichever document it stands
in, if ``block`` is at most half of ``length + 1``; so a repeated passage is hit at
least once in each place. Hits are extended: all windows of ``length`` words that
hold a hit are compared in full, and the union of those that occur elsewhere is
the union of the maximal exact repeats of at least that length.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.llm import arrays as A

RUN = 1 << 22  # bytes of text that are looked at together before anything is sent
LEAST = -(2**63)  # the id of documents without one

# kind 0: window hashes of one hash range; 1: the documents of a run; 2: places of a run
SENT = "part int, kind int, run long, a binary, b binary, c binary"
FOUND = "did long, key int, spans array<int>"


def _run_id(did: np.ndarray, key: np.ndarray) -> int:
    """A name of a run that any attempt of its task would give it."""
    each = A.mix(did.view(np.uint64) ^ A.mix(key.astype(np.uint64) ^ A.SEEDS[6]))
    place = A.SEEDS[7] * np.arange(1, 2 * len(each), 2, dtype=np.uint64)
    return int(np.sum(each * place).view(np.int64))


def _message(kind: int, part, run: int, *blobs) -> pa.RecordBatch:
    n = len(part)
    blobs = [b if isinstance(b, pa.Array) else pa.array([b] * n, pa.binary()) for b in (*blobs, *[b""] * (3 - len(blobs)))]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(part, np.int32)), pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, run, np.int64)), *blobs],
        names=["part", "kind", "run", "a", "b", "c"],
    )


def _probe(length: int, step: int, parts: int, width: int):
    """Messages about the windows of ``length`` words; index windows start every ``step`` words.

    A hash travels as its ``width`` low bytes, two bits of which are marks.
    """

    def run(batches):
        for rows, data, borders in A.runs(batches, limit=RUN):
            starts, ends, at = A.words(data, borders)
            whole = A.whole_windows(at, length)
            if "spans" in rows.schema.names:
                whole &= _wanted(rows.column("spans"), at)
            place = np.flatnonzero(whole)
            if not len(place):
                continue
            value = A.rolling(A.span_hashes(data, starts, ends), length)[place]
            did = np.asarray(rows.column("did"), np.int64)
            key = np.asarray(rows.column("key"), np.int32)
            name = _run_id(did, key)
            mine = abs(name) % parts
            yield _message(1, [mine], name, did.tobytes(), key.tobytes(), at.astype(np.int32).tobytes())
            doc = np.searchsorted(at, place, "right") - 1
            order = np.argsort(value, kind="stable")
            value, place, doc = value[order], place[order], doc[order]
            new = np.ones(len(value), bool)
            new[1:] = value[1:] != value[:-1]
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(value)))
            index = np.maximum.reduceat((place - at[doc]) % step == 0, first)
            twice = counts > 1  # a window that occurs twice in the run is a repeat already
            local = place[np.repeat(twice, counts)]
            if len(local):
                yield _message(2, [mine], name, np.sort(local).astype(np.int32).tobytes())
            value, place = value[first], place[first]
            part = ((value >> np.uint64(48)) * np.uint64(parts) >> np.uint64(16)).astype(np.int64)
            short = (value << np.uint64(2)) | (twice.astype(np.uint64) << np.uint64(1)) | index.astype(np.uint64)
            order = np.lexsort((place, part))
            part, short, place = part[order], short[order], place[order]
            edge = np.searchsorted(part, np.arange(parts + 1))
            used = np.flatnonzero(np.diff(edge))
            edge = np.append(edge[used], len(part))
            firsts = place[edge[:-1]]
            ahead = np.diff(place, prepend=0)
            ahead[edge[:-1]] = 0
            # Bytes of equal weight stand together: the higher ones are mostly zero.
            weights = 4 if len(ahead) and int(ahead.max()) >> 16 else 2
            planes = ahead.astype(np.uint32).view(np.uint8).reshape(-1, 4)[:, :weights]
            ahead = np.concatenate([planes[x:y].T.reshape(-1) for x, y in zip(edge, edge[1:])])
            short = short.view(np.uint8).reshape(-1, 8)[:, :width]
            yield _message(
                0, used, name,
                A.blobs(np.ascontiguousarray(short).reshape(-1), edge * width),
                A.blobs(ahead, edge * weights),
                A.blobs(np.stack([firsts, np.diff(edge)], axis=1).astype("<u4").reshape(-1).view(np.uint8), np.arange(len(used) + 1) * 8),
            )

    return run


def _wanted(spans: pa.ListArray, at: np.ndarray) -> np.ndarray:
    flat = np.asarray(spans.flatten()).reshape(-1, 2)
    owner = np.repeat(np.arange(len(spans)), np.diff(np.asarray(spans.offsets)) // 2)
    return A.covered(int(at[-1]), at[:-1][owner] + flat[:, 0], at[:-1][owner] + flat[:, 1])


def _answer(batches):
    """Of one hash range: places of windows that occur elsewhere and meet an index window."""
    value, own, name, place = [], [], [], []
    for batch in batches:
        for part, kind, run, a, b, c in zip(*(batch.column(k).to_pylist() for k in ("part", "kind", "run", "a", "b", "c"))):
            if kind:
                yield _message(kind, [part], run, a, b, c)
                continue
            first, n = np.frombuffer(c, "<u4").tolist()
            whole = np.zeros((n, 8), np.uint8)
            whole[:, : len(a) // n] = np.frombuffer(a, np.uint8).reshape(n, -1)
            value.append(whole.view(np.uint64).reshape(-1))
            own.append(np.full(n, part, np.int32))
            ahead = np.zeros((n, 4), np.uint8)
            ahead[:, : len(b) // n] = np.frombuffer(b, np.uint8).reshape(-1, n).T
            place.append(np.cumsum(ahead.view(np.uint32).reshape(-1)).astype(np.int32) + first)
            name.append(np.full(n, run, np.int64))
    if not value:
        return
    value, own, name, place = (np.concatenate(x) for x in (value, own, name, place))
    order = np.lexsort((value, own))
    value, own, name, place = value[order], own[order], name[order], place[order]
    bare = value >> np.uint64(2)
    new = np.ones(len(bare), bool)
    new[1:] = (bare[1:] != bare[:-1]) | (own[1:] != own[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(bare)))
    twice = (value >> np.uint64(1) & np.uint64(1)).astype(bool)
    index = (value & np.uint64(1)).astype(bool)
    hit = ((counts > 1) | np.logical_or.reduceat(twice, first)) & np.logical_or.reduceat(index, first)
    tell = np.repeat(hit, counts) & ~twice
    name, place = name[tell], place[tell]
    order = np.argsort(name, kind="stable")
    name, place = name[order], place[order]
    for lo, hi in _slices(name):
        yield _message(2, [0], int(name[lo]), np.sort(place[lo:hi]).astype(np.int32).tobytes())


def _slices(sorted_values):
    cuts = np.flatnonzero(np.diff(sorted_values)) + 1
    edges = [0, *cuts.tolist(), len(sorted_values)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]


def _by_document(batches):
    """Runs' places as spans of window starts, one row per document that has some."""
    tables: dict = {}
    places: dict = {}
    for batch in batches:
        for kind, run, a, b, c in zip(*(batch.column(k).to_pylist() for k in ("kind", "run", "a", "b", "c"))):
            if kind == 1:
                tables[run] = tuple(np.frombuffer(x, t) for x, t in ((a, np.int64), (b, np.int32), (c, np.int32)))
            else:
                places.setdefault(run, []).append(np.frombuffer(a, np.int32))
    for run, found in places.items():
        did, key, at = tables[run]
        place = np.sort(np.concatenate(found))
        doc = np.searchsorted(at, place, "right") - 1
        new = np.ones(len(place), bool)
        new[1:] = (np.diff(place) > 1) | (np.diff(doc) > 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place)) - 1
        own = doc[first]
        flat = np.stack([place[first] - at[own], place[last] + 1 - at[own]], axis=1).reshape(-1).astype(np.int32)
        docs_first = np.flatnonzero(np.append(True, np.diff(own) > 0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(did[own[docs_first]]), pa.array(key[own[docs_first]]),
                A.lists(flat, 2 * np.append(docs_first, len(own)), pa.int32()),
            ],
            names=["did", "key", "spans"],
        )


def repeated_windows(docs: DataFrame, length: int, step: int = 1, width: int = 8) -> DataFrame:
    """(did, key, spans): runs of places whose window of ``length`` words occurs elsewhere.

    With ``step`` over 1 a window counts only if it starts a block of the index in
    one of its places. With a column spans (flat start and end places) only windows
    that start there take part. Hashes of ``width`` bytes are compared inside hash
    ranges, whose number follows the number of shuffle partitions.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.mapInArrow(_probe(length, step, 4 * n, width), SENT)
    told = sent.repartition(n, "part").mapInArrow(_answer, SENT)
    found = told.repartition(n, "run").mapInArrow(_by_document, FOUND)
    return found.groupBy("did", "key").agg(F.flatten(F.collect_list("spans")).alias("spans"))


KEPT = "doc_id long, n_words long, n_removed long, kept string, spans array<int>"


def _cut(length: int):
    def run(batches):
        for batch in batches:
            for rows, _, _ in A.runs([batch]):
                ids, n_words, n_removed, kept, cuts = rows.column("doc_id"), [], [], [], []
                for text, spans in zip(rows.column("text").to_pylist(), rows.column("spans").to_pylist()):
                    parts = (text or "").encode().split()
                    n_words.append(len(parts))
                    if not spans:
                        kept.append(b" ".join(parts))
                        n_removed.append(0)
                        cuts.append([])
                        continue
                    flat = np.array(spans).reshape(-1, 2)
                    gone = A.covered(len(parts), flat[:, 0], flat[:, 1] + length - 1)
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    kept.append(b" ".join(itertools.compress(parts, ~gone)))
                    n_removed.append(int(gone.sum()))
                    cuts.append(edge.tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()), pa.array(cuts, pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept", "spans"],
                )

    return run


def without_repeated_passages(docs: DataFrame, length: int = 35, block: int | None = None) -> DataFrame:
    """``docs(doc_id, text)`` without words of windows of ``length`` that occur elsewhere.

    Returns doc_id, n_words, n_removed, kept (remaining words joined by blanks) and
    spans (removed word runs as flat start and end numbers). Elsewhere means any
    other place, the same document included; all copies of a passage go. Every row
    is a document: rows that repeat a doc_id repeat each other like any others, and
    a null doc_id is an id. Null and empty texts have no words. Further columns are
    not read.

    Window hashes travel packed by hash range, each once for a run of about 4 MB of
    text, so a passage shared by a third of all documents sends one entry per run.
    Answers go back by run. Texts are shuffled once: both joins read that shuffle.
    Blocks are compared by 30 bits inside a hash range, which leaves one false hit
    in thousands; whole windows by 62 bits inside theirs, and those decide.
    """
    block = (length + 1) // 2 if block is None else block
    if not 0 < 2 * block <= length + 1:
        raise ValueError("a window must hold a whole block: block <= (length + 1) / 2")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("did"),
        F.hash(F.coalesce("text", F.lit(""))).alias("key"),
        "text",
    )
    hits = repeated_windows(rows, block, block, width=4)
    reach = length - block
    near = F.transform("spans", lambda x, i: F.when(i % 2 == 0, F.greatest(x - reach, F.lit(0))).otherwise(x))
    seeded = rows.join(hits.select("did", "key", near.alias("spans")).hint("merge"), ["did", "key"])
    spans = repeated_windows(seeded, length)
    none = F.array().cast("array<int>")
    joined = rows.join(spans.hint("merge"), ["did", "key"], "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))
    return joined.mapInArrow(_cut(length), KEPT)
