"""Byte-level duplicate removal: every byte of a string that already occurred.

This replaces a prefix doubling: there are no ranks, rank pairs or doubled offsets.

First, each 100-byte string is represented by one of its 32-byte grams, the one
with the least hash; equal strings have equal representatives at equal offsets. A
gram stands for the strings around it (its context). Contexts seen before are
repeats as a whole, grams with a single context are settled, and only contexts of
grams that have several go on.

Second, these go through three fixed rounds as families: neighbouring string
starts with the piece that all of them share (the core). Spark groups digests of
cores and of whole stretches; a family whose core is unique drops out, one whose
whole stretch occurred before is a repeat, and the others are split, which makes
their cores longer, until cores are as long as the strings themselves.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.llm import arrays as A
from examloom.session import dropped, written

GRAM = 32
PART_BITS = 48  # bits of a hash that travel; the part holds the others
LEAST = -(2**63)  # the id of documents without one

SENT = "part int, grams binary, contexts binary, ids binary, keys binary, places binary, shapes binary"
FOUND = "repeat boolean, did long, key int, lo int, hi int, anchor int"
STEPS = (32, 8, 1)  # starts in a family, round by round


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` consecutive values from each place; the last ones are void."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        nxt = out.copy()
        if step < len(out):
            np.minimum(out[:-step], out[step:], out=nxt[:-step])
        out, done = nxt, done + step
    return out


def anchors(data: np.ndarray, borders: np.ndarray, length: int):
    """(owner, gram hash, context hash, anchor, first start, last start) of all string starts.

    Starts whose strings share a representative form one row: they are neighbours.
    """
    n = len(data)
    whole = A.whole_windows(borders, length)
    starts = np.flatnonzero(whole)
    if not len(starts):
        void = np.zeros(0, np.int64)
        return void, void.astype(np.uint64), void.astype(np.uint64), void, void, void
    grams = A.rolling(A.BYTE_VALUE[data], GRAM, A.BASE)
    bits = np.uint64(max(24, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    ordered = (grams & ~low) | np.arange(n, dtype=np.uint64)
    least = _sliding_least(ordered, length - GRAM + 1)[starts]
    anchor = (least & low).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    lo = starts[first]
    hi = starts[np.append(first[1:], len(starts)) - 1]
    anchor = anchor[first]
    owner = np.searchsorted(borders, lo, "right") - 1
    context = A.span_hashes(data, lo, hi + length)
    context = A.mix(context ^ ((anchor - lo).astype(np.uint64) * A.SEEDS[5]))
    return owner, grams[anchor], context, anchor, lo, hi


def _six(values: np.ndarray) -> np.ndarray:
    """The low six bytes of 64-bit values."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :6]


def _from_six(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view(np.uint64).reshape(-1)


def _classes(gram, context, did, key, pos):
    """Order by class and place; where classes and grams begin in that order."""
    order = np.lexsort((pos, key, did, context, gram))
    gram, context = gram[order], context[order]
    new_gram, new_class = np.ones(len(order), bool), np.ones(len(order), bool)
    new_gram[1:] = gram[1:] != gram[:-1]
    new_class[1:] = new_gram[1:] | (context[1:] != context[:-1])
    return order, new_gram, new_class


def _later(head: np.ndarray, *place: np.ndarray) -> np.ndarray:
    """True where the place differs from that of the class's head: same rows shown twice do not."""
    return np.any([x != x[head] for x in place], axis=0)


def _several(new_gram, new_class):
    """For each row: does its gram have more than one class?"""
    number = np.cumsum(new_gram) - 1
    return (np.bincount(number, new_class) > 1)[number]


def _send(length: int, parts: int):
    def run(batches):
        for rows, data, borders in A.runs(batches):
            owner, gram, context, anchor, lo, hi = anchors(data, borders, length)
            did = np.asarray(rows.column("did"), np.int64)[owner]
            key = np.asarray(rows.column("key"), np.int32)[owner]
            lo, hi, anchor = (x - borders[owner] for x in (lo, hi, anchor))
            order, new_gram, new_class = _classes(gram, context, did, key, lo)
            several = _several(new_gram, new_class) if len(order) else new_gram
            did, key, lo, hi, gram, context, anchor = (x[order] for x in (did, key, lo, hi, gram, context, anchor))
            # A gram with several contexts here is in doubt whatever others have: one
            # row tells them so, and its classes stay here.
            tell = new_gram & several
            go = (new_class & ~several) | tell
            flag = tell[go].astype(np.int64)
            part = ((gram[go] >> np.uint64(48)) * np.uint64(parts) >> np.uint64(16)).astype(np.int64)
            by_part = np.argsort(part, kind="stable")
            at = np.searchsorted(part[by_part], np.arange(parts + 1))
            used = np.flatnonzero(np.diff(at))
            edges = np.append(at[used], len(part))
            shape = np.stack([hi[go] - lo[go], anchor[go] - lo[go], flag], axis=1).astype(np.uint8)[by_part]
            columns = [
                _six(gram[go][by_part]), _six(context[go][by_part]), did[go][by_part], key[go][by_part],
                lo[go].astype(np.int32)[by_part], shape,
            ]
            yield _sent(used, [_rows(c, edges) for c in columns])
            head = np.flatnonzero(new_class)[np.cumsum(new_class) - 1]
            for mask, repeat in ((_later(head, did, key, lo), 1), (new_class & several, 0)):
                if mask.any():
                    yield _local(did[mask], key[mask], np.stack([lo, hi, anchor], axis=1)[mask], repeat, parts)

    return run


def _rows(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    width = values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    return A.blobs(np.ascontiguousarray(values).reshape(-1).view(np.uint8), edges * width)


NAMES = ["part", "grams", "contexts", "ids", "keys", "places", "shapes"]


def _sent(part, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *columns], names=NAMES)


def _local(did, key, spans, repeat: int, parts: int) -> pa.RecordBatch:
    """What is known without the others, as a row without grams that passes through."""
    part = zlib.crc32(did.tobytes()) % parts
    whole = np.array([0, len(did)])
    void = pa.array([b""], pa.binary())
    shape = np.full((len(did), 3), repeat, np.uint8)
    spans = spans.astype(np.int32)
    return _sent(
        np.array([part]),
        [void, void, _rows(did, whole), _rows(key, whole), _rows(spans, whole), _rows(shape, whole)],
    )


def _found(repeat, did, key, lo, hi, anchor) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(repeat, bool)), pa.array(did), *(pa.array(x.astype(np.int32)) for x in (key, lo, hi, anchor))],
        names=["repeat", "did", "key", "lo", "hi", "anchor"],
    )


def _meet(batches):
    """Of one hash range: whole repeats, and the first of each class in doubt."""
    kept: list[list] = []
    for batch in batches:
        for part, *blobs in zip(*(batch.column(c).to_pylist() for c in NAMES)):
            grams, contexts, ids, keys, places, shapes = blobs
            did, key = np.frombuffer(ids, np.int64), np.frombuffer(keys, np.int32)
            place = np.frombuffer(places, np.int32)
            shape = np.frombuffer(shapes, np.uint8).reshape(-1, 3)
            if not grams:
                yield _found(shape[:, 0] == 1, did, key, *place.reshape(-1, 3).T)
                continue
            gram = _from_six(grams)
            # the top bits are those of the part, or nearly: they only widen the key
            gram |= np.uint64(part & 0xFFFF) << np.uint64(48)
            kept.append([gram, _from_six(contexts), did, key, place, shape])
    if not kept:
        return
    gram, context, did, key, lo, shape = (np.concatenate(c) for c in zip(*kept))
    kept.clear()
    order, new_gram, new_class = _classes(gram, context, did, key, lo)
    did, key, lo, shape = did[order], key[order], lo[order], shape[order]
    hi, anchor, told = lo + shape[:, 0], lo + shape[:, 1], shape[:, 2] > 0
    number = np.cumsum(new_gram) - 1
    doubt = _several(new_gram, new_class) | (np.bincount(number, told) > 0)[number]
    # Rows that only tell are not classes of their own: theirs stayed behind.
    class_number = np.cumsum(new_class) - 1
    rank = np.where(told, len(order), np.arange(len(order)))
    head = np.full(class_number[-1] + 1, len(order))
    np.minimum.at(head, class_number, rank)
    first = np.arange(len(order)) == head[class_number]
    own_head = np.minimum(head, len(order) - 1)[class_number]
    for mask, repeat in ((_later(own_head, did, key, lo) & ~told, True), (first & doubt, False)):
        if mask.any():
            yield _found(np.full(mask.sum(), repeat), did[mask], key[mask], lo[mask], hi[mask], anchor[mask])


CONTEXTS = "did long, key int, anchor int, lo int, hi int, context binary"


def _contexts(length: int):
    """A row for each class in doubt: its starts lo .. hi and the bytes that they cover."""

    def run(batches):
        for rows, data, borders in A.runs(batches):
            spans = rows.column("spans")
            lo, hi, anchor = (np.asarray(spans.flatten().field(c)) for c in ("lo", "hi", "anchor"))
            owner = np.repeat(np.arange(rows.num_rows), np.diff(np.asarray(spans.offsets)))
            base, raw = borders[:-1][owner], data.tobytes()
            own = [raw[a:b] for a, b in zip((base + lo).tolist(), (base + hi + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.asarray(rows.column("did"))[owner]), pa.array(np.asarray(rows.column("key"))[owner]),
                    pa.array(anchor), pa.array(lo), pa.array(hi), pa.array(own, pa.binary()),
                ],
                names=["did", "key", "anchor", "lo", "hi", "context"],
            )

    return run


def _families(contexts: DataFrame, step: int, length: int) -> DataFrame:
    """Families of starts whose offset to the anchor lies in one block of ``step`` offsets.

    Each has its place (did, at), its number of starts beyond the first, the offset
    of the anchor and digests of its core and of its whole stretch, which are one
    at a single start; the bytes stay behind.
    """
    least, most = F.expr("anchor - hi"), F.expr("anchor - lo")
    block = F.explode(F.sequence(F.floor(least / step), F.floor(most / step))).alias("block")
    cut = contexts.select("*", block)
    first, last = F.col("block") * step, F.col("block") * step + step - 1
    cut = cut.withColumns({"from": F.greatest(F.col("lo"), F.col("anchor") - last), "to": F.least(F.col("hi"), F.col("anchor") - first)})
    core = _piece(F.col("anchor") - first, F.col("anchor") - last + length)
    whole = _piece(F.col("from"), F.col("to") + length)
    cores = [F.xxhash64(core).alias("c1"), F.hash(core).alias("c2")] if step > 1 else []
    return cut.select(
        "class", "did", (F.col("key").cast("long") * AT + F.col("from")).alias("at"),
        F.expr("int(to - from)").alias("size"), F.expr("int(anchor - from)").alias("offset"), F.col("block").cast("int").alias("block"),
        *cores, F.xxhash64(whole).alias("w1"), F.hash(whole).alias("w2"),
    )


AT = 1 << 32  # key and start in one number, in the order of the pair


def _piece(begin: Column, end: Column) -> Column:
    """The bytes begin .. end of the document, taken from the context."""
    return F.substring(F.col("context"), (begin - F.col("start") + 1).cast("int"), (end - begin).cast("int"))


def _round(contexts: DataFrame, step: int, length: int) -> DataFrame:
    """The families of ``step`` starts that are whole repeats, or still in doubt, after one round.

    Families whose core has no second place are gone. A family is a repeat
    (``again``) if an earlier one covers the same offsets with the same bytes; a
    single start that is none is in doubt no more. Cores and whole stretches are
    grouped in two steps, so that the shuffle files of one do not wait for the other.
    """
    rows = _families(contexts, step, length)
    if step > 1:
        sides = [f(c) for c in ("did", "at") for f in (F.min, F.max)]
        cores = rows.groupBy("block", "c1", "c2").agg(*(f.alias(x) for f, x in zip(sides, "abcd")))
        cores = cores.where("a <> b or c <> d").select("block", "c1", "c2")
        rows = rows.join(cores, ["block", "c1", "c2"], "left_semi")
    rows = written(rows.drop("block", "c1", "c2"), "cores", free=True)
    wholes, place = ["offset", "size", "w1", "w2"], F.struct("did", "at")
    firsts = rows.groupBy(*wholes).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = F.coalesce(place > F.col("first"), F.lit(False)).alias("again")
    told = rows.join(firsts, wholes, "left" if step > 1 else "inner")
    start = F.col("at").bitwiseAND(F.lit(AT - 1))
    told = told.select(
        "class", "did", F.shiftright("at", 32).cast("int").alias("key"),
        start.cast("int").alias("lo"), (start + F.col("size")).cast("int").alias("hi"), again,
    )
    told = written(told if step > 1 else told.where("again"), "families", free=True)
    dropped(rows)
    return told


def repeated_strings(docs: DataFrame, length: int) -> DataFrame:
    """(did, key, spans): string starts lo .. hi of each document that occurred before."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.mapInArrow(_send(length, 4 * n), SENT)
    found = written(sent.repartition(n, "part").mapInArrow(_meet, FOUND), "found", free=True)
    repeats = found.where("repeat").select("did", "key", "lo", "hi")
    doubt = found.where("not repeat").groupBy("did", "key")
    doubt = doubt.agg(F.collect_list(F.struct("lo", "hi", "anchor")).alias("spans"))
    texts = docs.join(doubt.hint("merge"), ["did", "key"]).select("did", "key", "text", "spans")
    rows = texts.mapInArrow(_contexts(length), CONTEXTS)
    numbered = rows.withColumns({"start": F.col("lo"), "class": F.monotonically_increasing_id()})
    contexts = rows = written(numbered, "contexts", free=True)
    for step in STEPS:
        told = _round(rows, step, length)
        repeats = repeats.unionByName(told.where("again").select("did", "key", "lo", "hi"))
        # the bytes of a class meet its families again for the next round
        rows = contexts.drop("lo", "hi").join(told.where("not again").select("class", "lo", "hi"), "class")
    dropped(contexts)
    return repeats.groupBy("did", "key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut(length: int):
    def run(batches):
        for rows, data, borders in A.runs(batches):
            n = rows.num_rows
            spans = rows.column("spans")
            sizes = np.diff(np.asarray(spans.offsets))
            lo, hi = (np.asarray(spans.flatten().field(c)) for c in ("lo", "hi"))
            base = borders[:-1][np.repeat(np.arange(n), sizes)]
            gone = A.covered(len(data), base + lo, base + hi + length)
            total = np.concatenate([[0], np.cumsum(gone)])
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = borders[:-1][np.diff(borders) > 0]
            begins[inner] = gone[inner]
            runs = np.concatenate([[0], np.cumsum(begins)])
            removed = total[borders[1:]] - total[borders[:-1]]
            kept = A.blobs(data[~gone], np.concatenate([[0], np.cumsum(np.diff(borders) - removed)]))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), pa.array(np.diff(borders)), pa.array(removed),
                    pa.array(runs[borders[1:]] - runs[borders[:-1]]), kept,
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def without_repeated_strings(docs: DataFrame, length: int = 100) -> DataFrame:
    """``docs(doc_id, text)`` without bytes of strings of ``length`` that occurred before.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept
    (the remaining bytes, which may part a character). A string counts as earlier
    by smaller doc_id, then by start; rows without doc_id come first. Rows equal in
    doc_id and text are one document shown several times and get equal results;
    rows that share only the doc_id are ordered by a hash of their text. Null texts
    are empty. Matches never cross documents. Further columns are not read.

    Positions travel as packed arrays by hash range. A gram that is common in a
    run of documents sends one row from there, so a passage that a third of all
    documents share does not pile up in one task. All equalities are of hashes of
    96 bits or more. ``length`` must be from 40 to 250.
    """
    if not 40 <= length <= 250:
        raise ValueError("length must be from 40 to 250")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("did"),
        F.hash(F.coalesce("text", F.lit(""))).alias("key"),
        "text",
    )
    spans = repeated_strings(rows.select("did", "key", "text"), length)
    none = F.array().cast("array<struct<lo:int,hi:int>>")
    joined = rows.join(spans.hint("merge"), ["did", "key"], "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))
    return joined.mapInArrow(_cut(length), KEPT)
