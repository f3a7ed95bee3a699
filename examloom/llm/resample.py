"""Resampling of documents towards a target distribution by hashed n-gram importance.

Every run of one to ``orders`` words falls into one of ``buckets`` by its CRC-32. A
bucket's gain is the scaled, floored log ratio of its smoothed shares in the target
and in the corpus; a document weighs the sum of the gains of its runs. Gumbel noise
keyed by the document is added, and the documents of greatest score are drawn, which
samples without replacement in proportion to the exponential of the weight.

Text is handled by Arrow kernels: lower case, a regular split, the flat list of words
and their dictionary. Longer runs are pairs of dictionary numbers, each the number of
the run one word shorter and that of the word behind it; only distinct pairs are
hashed, and gains are taken by number and summed over the segment of a document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.llm import arrays as A
from examloom.llm.rows import ranked
from examloom.session import written

# Fixed value: what stands between words, the ASCII range without digits and small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RUN = 4 << 20  # bytes of text handled at once, or one longer text


@dataclass(frozen=True)
class Resampling:
    """Parameters: longest run of words, hash buckets, and how documents are drawn."""

    orders: int = 1
    buckets: int = 10_000
    percent: int = 10  # share of the eligible documents that is drawn
    least_words: int = 20  # documents with fewer are not eligible
    seed: str = "2024"


def numbered_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, number of the word at each place, n + 1 borders of the texts)."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BETWEEN)
    owner = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    coded = pc.dictionary_encode(pc.list_flatten(parts))
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    if b"" in distinct:  # a split at the edge of a text leaves an empty part
        some = number != distinct.index(b"")
        owner, number = owner[some], number[some]
    return distinct, number, np.searchsorted(owner, np.arange(len(texts) + 1))


def hashed_runs(texts: pa.Array, orders: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of 1, 2 … ``orders`` words: (CRC-32 of the distinct runs, number at each place, borders).

    The CRC-32 of a run goes on from that of the run one word shorter, over a space
    and the last word, so no run is ever put together as text.
    """
    words, number, borders = numbered_words(texts)
    crc = [zlib.crc32(w) for w in words]
    yield np.array(crc, np.int64), number, borders
    behind = [b" " + w for w in words] if orders > 1 else []
    owner, n_words, runs = A.owners(borders), max(len(words), 1), number
    for order in range(2, orders + 1):
        pairs, runs = np.unique(runs[:-1] * n_words + number[order - 1 :], return_inverse=True)
        before, last = divmod(pairs, n_words)
        crc = [zlib.crc32(behind[b], crc[a]) for a, b in zip(before.tolist(), last.tolist())]
        inside = owner[: len(runs)] == owner[order - 1 :]
        places = owner[: len(runs)][inside]
        yield np.array(crc, np.int64), runs[inside], np.searchsorted(places, np.arange(len(texts) + 1))


def _counted(p: Resampling):
    def run(batches):
        total = np.zeros(p.buckets, np.int64)
        for rows, _, _ in A.runs(batches, limit=RUN):
            for crc, number, _ in hashed_runs(rows.column("text"), p.orders):
                own = np.bincount(number, minlength=len(crc))
                np.add.at(total, crc % p.buckets, own)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, p: Resampling) -> np.ndarray:
    """How many runs of all ``texts(text)`` fall into each bucket.

    A task sends at most one row a bucket, and the driver gets one sum a bucket.
    """
    found = (
        texts.select(F.col("text").cast("string").alias("text"))
        .mapInArrow(_counted(p), "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros(p.buckets, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of add-one smoothed shares) for each bucket."""
    n = len(corpus)
    all_corpus, all_target = float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_corpus + n) / ((s + 1) * (all_target + n))))
            for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())
        ],
        np.int64,
    )


def _weighed(shared, p: Resampling):
    def run(batches):
        gain = shared.value
        for rows, _, _ in A.runs(batches, limit=RUN):
            weight = np.zeros(rows.num_rows, np.int64)
            n_features = np.zeros(rows.num_rows, np.int64)
            n_words = None
            for crc, number, borders in hashed_runs(rows.column("text"), p.orders):
                total = np.concatenate([[0], np.cumsum(gain[crc % p.buckets].take(number))])
                weight += total[borders[1:]] - total[borders[:-1]]
                sizes = np.diff(borders)
                n_words = sizes if n_words is None else n_words
                n_features += sizes
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def importance_weights(docs: DataFrame, target: DataFrame, p: Resampling = Resampling()) -> DataFrame:
    """doc_id, n_words, n_features and weight of each of ``docs(doc_id, text)`` for ``target(text)``.

    Counts cover all documents and all target texts. What tasks get is one gain a
    bucket, ``8 * buckets`` bytes whatever the input.
    """
    gain = gains(bucket_counts(docs, p), bucket_counts(target, p))
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(_weighed(shared, p), "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: str) -> Column:
    """floor(1000 times a standard Gumbel variate) keyed by the seed and the id; a null id is an empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, p: Resampling = Resampling()) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank.

    ``rank`` counts the drawn documents from 1 in the order of falling score, ties to
    the smaller doc_id; it is null for documents that are not drawn or have fewer than
    ``least_words`` words. ``floor(percent * eligible / 100)`` documents are drawn.

    Null and empty texts, and texts without words, weigh 0 and are not eligible. Rows
    that repeat a doc_id are documents of their own, with equal noise; equal rows take
    ranks one after the other. A null doc_id comes last among equal scores. Further
    columns are not read. An empty target leaves every document with gains against
    nothing; an empty table of documents gives no rows. A task holds 4 MB of text at
    once, or one longer text, and about thirty bytes a byte of it.
    """
    weighed = written(importance_weights(docs, target, p), "weights")
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), p.seed))
    fit = F.col("n_words") >= p.least_words
    drawn = weighed.where(fit).count() * p.percent // 100
    order = [
        fit.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
        F.col("n_features").asc(), F.col("weight").asc(),
    ]
    return ranked(scored, order).select(
        "doc_id", "n_words", "n_features", "weight", "score",
        F.when(fit & (F.col("place") <= drawn), F.col("place")).alias("rank"),
    )
