"""Compression of vectors to short codes by integer codebooks of vector parts.

Components become integers, a vector is cut into ``parts`` equal parts, and each part
is replaced by the number of the nearest of at most ``entries`` codebook entries of its
position. Codebooks are improved in rounds of assignment and averaging, all in integers,
so results are the same however rows are dealt.

Distances are looked up: for each dimension of a batch, the distinct integers form a
dictionary, the squared difference of every dictionary value to every entry is tabulated
once, and the distances of all rows are gathers from those tables by dictionary code,
added up over the dimensions of the part.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.session import written

MOST = 1 << 25  # integers are kept within this size, so that 64 bits hold all distances
ROWS = 4096  # vectors handled at once


@dataclass(frozen=True)
class VectorCodes:
    """Parameters: parts of a vector, entries of a codebook (at most 256), rounds and scale."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


@dataclass(frozen=True)
class Codebooks:
    """One (entries, width) integer array for each part position."""

    params: VectorCodes
    books: list[np.ndarray]

    @property
    def digest(self) -> str:
        """SHA-256 of all integers by part, entry and position, joined by commas."""
        flat = [str(x) for book in self.books for x in book.reshape(-1).tolist()]
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def _integers(scale: int):
    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = pc.fill_null(column.flatten(), np.nan).to_numpy(zero_copy_only=False)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            whole = (sizes > 0) & (odd[edges[1:]] == odd[edges[:-1]])
            kept = np.clip(np.floor(scale * x[np.repeat(whole, sizes)]), -MOST, MOST).astype(np.int32)
            at = np.concatenate([[0], np.cumsum(sizes[whole])]).astype(np.int32)
            rows = batch.select(["vec_id", "label"]).filter(pa.array(whole))
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(kept))
            yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=["vec_id", "label", "x"])

    return run


def borders(width: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end; parts are equal if ``width`` allows."""
    return [k * width // parts for k in range(parts + 1)]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the nearest entry to each row, ties to the lower entry."""
    total = np.zeros((len(x), len(book)), np.int64)
    for j in range(x.shape[1]):
        values, code = np.unique(x[:, j], return_inverse=True)
        table = (values.astype(np.int64)[:, None] - book[:, j]) ** 2
        total += table.take(code, axis=0)
    entry = total.argmin(axis=1)
    return entry, total[np.arange(len(x)), entry]


def _matrices(batches):
    """(rows, integers as a matrix) of bounded size."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            rows = batch.slice(first, ROWS)
            flat = rows.column("x").flatten().to_numpy(zero_copy_only=False)
            yield rows, flat.reshape(rows.num_rows, -1)


def _sums(shared):
    def run(batches):
        books = shared.value
        width = max(book.shape[1] for book in books)
        n = len(books[0])
        edges = np.cumsum([0, *(book.shape[1] for book in books)])
        sums = np.zeros((len(books), n, width), np.int64)
        counts = np.zeros((len(books), n), np.int64)
        for _, x in _matrices(batches):
            for k, book in enumerate(books):
                own = x[:, edges[k] : edges[k + 1]]
                entry, _ = nearest(own, book)
                own_counts = np.bincount(entry, minlength=n)
                counts[k] += own_counts
                used = np.flatnonzero(own_counts)
                if len(used):
                    first = (np.cumsum(own_counts) - own_counts)[used]
                    by_entry = own[entry.argsort(kind="stable")].astype(np.int64)
                    sums[k, used, : own.shape[1]] += np.add.reduceat(by_entry, first, axis=0)
        part, entry = np.nonzero(counts)
        totals = sums[part, entry].reshape(-1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * width), pa.array(totals))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(counts[part, entry]), lists], names=["part", "entry", "n", "sums"]
        )

    return run


def integer_vectors(vectors: DataFrame, p: VectorCodes = VectorCodes()) -> DataFrame:
    """vec_id, label and integers x of the rows of ``vectors(vec_id, embedding, label)`` that are kept.

    Dropped are null vectors, vectors with null or non-finite components, empty ones,
    and those of another length than the first kept vector in the order of vec_id.
    Integers beyond 2 ** 25 in size are held at that bound. Written once.
    """
    wanted = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    kind = vectors.schema["label"].dataType.simpleString()
    whole = written(wanted.mapInArrow(_integers(p.scale), f"vec_id long, label {kind}, x array<int>"), "integers")
    first = whole.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(1).collect()
    width = len(first[0]["x"]) if first else 0
    return whole.where(F.size("x") == width)


def fit_codebooks(integers: DataFrame, p: VectorCodes = VectorCodes()) -> Codebooks:
    """Codebooks of ``integers(vec_id, x)``, which all have one length.

    They start as the parts of the rows with the smallest vec_ids (null last, equal ids
    by their integers), as many as there are up to ``entries``. In each round every part
    of every row goes to its nearest entry, and entries become the floored means of
    their parts; an unused entry stays. A task sends one sum an entry, ``parts *
    entries`` rows whatever it holds, and so does the driver get.
    """
    start = integers.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(p.entries).collect()
    if not start:
        return Codebooks(p, [np.zeros((0, 0), np.int64)] * p.parts)
    x = np.array([r["x"] for r in start], np.int64)
    cuts = borders(x.shape[1], p.parts)
    books = [x[:, a:b].copy() for a, b in zip(cuts, cuts[1:])]
    width = max(b - a for a, b in zip(cuts, cuts[1:]))
    for _ in range(p.rounds):
        shared = integers.sparkSession.sparkContext.broadcast(books)
        found = (
            integers.select("x")
            .mapInArrow(_sums(shared), "part long, entry long, n long, sums array<long>")
            .groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]).alias("sums"))
            .collect()
        )
        books = [book.copy() for book in books]
        for r in found:
            book = books[r["part"]]
            book[r["entry"]] = np.array(r["sums"][: book.shape[1]], np.int64) // r["n"]
    return Codebooks(p, books)


def _coded(shared):
    def run(batches):
        books = shared.value
        edges = np.cumsum([0, *(book.shape[1] for book in books)])
        for rows, x in _matrices(batches):
            codes, error = [], np.zeros(len(x), np.int64)
            for k, book in enumerate(books):
                entry, distance = nearest(x[:, edges[k] : edges[k + 1]], book)
                codes.append(entry.astype(np.uint8))
                error += distance
            raw = np.stack(codes, axis=1).tobytes()
            own = [raw[i : i + len(books)].hex() for i in range(0, len(raw), len(books))]
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"), pa.array(own, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def encoded(integers: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of each of ``integers``, in one narrow pass."""
    kind = integers.schema["label"].dataType.simpleString()
    shape = f"vec_id long, label {kind}, code string, error long"
    if not len(books.books[0]):
        return integers.sparkSession.createDataFrame([], shape)
    shared = integers.sparkSession.sparkContext.broadcast(books.books)
    return integers.select("vec_id", "label", "x").mapInArrow(_coded(shared), shape)


def decoded(code: str, books: Codebooks) -> np.ndarray:
    """The vector of a code, its components at the middle of their integer steps."""
    parts = [book[entry] for book, entry in zip(books.books, bytes.fromhex(code))]
    return (np.concatenate(parts) + 0.5) / books.params.scale


def vector_codes(vectors: DataFrame, p: VectorCodes = VectorCodes()) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each kept row of ``vectors``.

    ``label_error`` is the sum of errors over rows of equal label, nulls together.
    Rows that repeat a vec_id, or have none, are coded like any other. An empty table,
    or one without a whole vector, gives no rows. Further columns are not read. Sums by
    label are formed before the shuffle; their table is written, so Spark joins it by
    its measured size and splits a label that holds many rows.
    """
    integers = integer_vectors(vectors, p)
    books = fit_codebooks(integers, p)
    rows = written(encoded(integers, books), "codes")
    sums = written(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    sums = sums.withColumnRenamed("label", "own")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("own")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest).alias("codebooks_sha256")
    )
