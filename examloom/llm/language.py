"""Language of texts by multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased code points; runs of others than letters are one blank.
Every run of one to ``longest`` characters inside a text is hashed into one of
``2 ** bits`` buckets. Fitting counts buckets by language, which Spark adds up over
all training rows; scoring gathers, run by run of text, the log-probabilities of the
buckets that occur, from a matrix that every task gets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.llm import arrays as A
from examloom.llm.labelled import fold

UNKNOWN = "und"
BLANK = 0x20
GRAM_BASE = np.uint64(0x9E3779B97F4A7C15)
NOT_LETTER = np.ones(128, bool)
NOT_LETTER[0x61:0x7B] = False


@dataclass(frozen=True)
class LanguageId:
    """Parameters: longest n-gram, hash bits, smoothing, most languages, folds and the one held out."""

    longest: int = 4
    bits: int = 16
    smooth: float = 0.5
    most: int = 256
    folds: int = 4
    held_out: int = 2


@dataclass(frozen=True)
class LanguageModel:
    """Log prior and log-probabilities of buckets by language, in the order of ``names``."""

    params: LanguageId
    names: list[str]
    prior: np.ndarray
    log_probability: np.ndarray


def characters(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-case UTF-8 texts with a blank before and after each word, and text borders.

    ASCII characters that are no letters, and further white space and punctuation
    blocks, count as blanks; blanks are never repeated.
    """
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    at = leads[borders]
    if at[-1] != len(points):  # damaged UTF-8: bytes stand for themselves
        points, at = data.astype(np.uint32), borders
    # Each text gets a blank of its own in front and behind.
    n = len(borders) - 1
    spaced = np.full(len(points) + 2 * n, BLANK, np.uint32)
    own = np.arange(len(points)) + 2 * A.owners(at) + 1
    low = points < 128
    spaced[own] = np.where(low & NOT_LETTER[np.minimum(points, 127)], BLANK, points)
    between = (spaced >= 0x2000) & (spaced < 0x2070) | (spaced >= 0x80) & (spaced < 0xC0) | (spaced == 0x3000)
    spaced[between] = BLANK
    at = at + 2 * np.arange(n + 1)
    keep = np.ones(len(spaced), bool)
    keep[1:] = (spaced[1:] != BLANK) | (spaced[:-1] != BLANK)
    keep[at[:-1]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return spaced[keep], kept[at]


def gram_buckets(points: np.ndarray, at: np.ndarray, p: LanguageId) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket at each place, text borders) for each length of run; a run of blanks alone is none."""
    value = A.mix(points.astype(np.uint64) ^ A.SEEDS[600])
    room = np.repeat(at[1:], np.diff(at)) - np.arange(len(points))
    run = np.zeros(len(points), np.uint64)
    for n in range(1, p.longest + 1):
        run = run[: len(points) - n + 1] * GRAM_BASE + value[n - 1 :]
        inside = room[: len(run)] >= n
        if n == 1:
            inside &= points != BLANK
        kept = np.concatenate([[0], np.cumsum(inside)])
        bucket = A.mix(run[inside] ^ A.SEEDS[600 + n]) >> np.uint64(64 - p.bits)
        yield bucket.astype(np.int64), kept[np.minimum(at, len(run))]


def _counted(p: LanguageId):
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for rows, data, borders in A.runs(batches):
            points, at = characters(data, borders)
            coded = rows.column("lang").dictionary_encode()
            names, own = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for bucket, edges in gram_buckets(points, at, p):
                label = np.repeat(own, np.diff(edges))
                found = np.bincount(label << p.bits | bucket, minlength=len(names) << p.bits).reshape(len(names), -1)
                for name, counts in zip(names, found):
                    total[name] = total[name] + counts if name in total else counts
        for name, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(counts[some])],
                names=["lang", "bucket", "n"],
            )

    return run


def held_out(doc_id: Column, p: LanguageId) -> Column:
    """Is the id in the fold that is not learned from? False for a null id."""
    return F.coalesce(fold(doc_id, p.folds) == p.held_out, F.lit(False))


def fit_languages(docs: DataFrame, p: LanguageId = LanguageId()) -> LanguageModel:
    """A model of ``docs(doc_id, text, lang)`` from all rows outside the held-out fold.

    Rows with a null lang, a null id or a text without letters are not learned from.
    The ``most`` values of lang with most rows are learned, ties to the lesser value;
    that bounds the matrix to ``most * 2 ** bits`` numbers whatever the input. A task
    sends one row a language and bucket at most.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where("lang is not null and doc_id is not null and text is not null")
    rows = rows.where(~held_out(F.col("doc_id"), p)).where(has_letter(F.col("text"))).select("lang", "text")
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(p.most).collect()
    shares = dict(sorted((r["lang"], r["count"]) for r in common))
    names = list(shares)
    learned = rows.where(F.col("lang").isin(names)) if names else rows.limit(0)
    found = learned.mapInArrow(_counted(p), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(names), 1 << p.bits))
    place = {name: k for k, name in enumerate(names)}
    own = np.array([place[x] for x in found.column("lang").to_pylist()], np.int64)
    counts[own, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    counts += p.smooth
    prior = np.array([shares[name] for name in names], float)
    return LanguageModel(
        p, names, np.log(prior / max(prior.sum(), 1)), np.log(counts / counts.sum(axis=1, keepdims=True))
    )


def has_letter(text: Column) -> Column:
    """Does the text hold a letter of any script? False for null."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def posterior(model: LanguageModel, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """(texts, languages) probabilities; a text's row does not depend on its neighbours."""
    n = len(borders) - 1
    points, at = characters(data, borders)
    score = np.tile(model.prior, (n, 1))
    for bucket, edges in gram_buckets(points, at, model.params):
        some = np.flatnonzero(np.diff(edges))
        if len(some):
            for k, row in enumerate(model.log_probability):
                score[some, k] += np.add.reduceat(row.take(bucket), edges[some])
    score = np.exp(score - score.max(axis=1, keepdims=True))
    return score / score.sum(axis=1, keepdims=True)


def _predicted(shared):
    def run(batches):
        model: LanguageModel = shared.value
        names = np.array([*model.names, UNKNOWN], object)
        for rows, data, borders in A.runs(batches):
            known = rows.column("known").to_numpy(zero_copy_only=False).astype(bool) & bool(model.names)
            best = np.full(rows.num_rows, len(model.names))
            score = np.zeros(rows.num_rows)
            if known.any():
                chance = posterior(model, data, borders)
                best = np.where(known, chance.argmax(axis=1), best)
                score = np.where(known, chance.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"],
            )

    return run


def predicted_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) for each of ``docs(doc_id, text)``.

    ``lang_pred`` is the learned language of greatest probability, ties to the lesser
    name, and ``score`` that probability. Null texts and texts without a letter are
    ``und`` with score 0, and so is every text if nothing was learned. Rows that repeat
    a doc_id are scored one by one; a null id is never held out. Whole texts are read
    in one narrow pass; a task holds 2 MB of text at once, or one longer text, and about
    sixty bytes a character of it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    out = rows.withColumn("known", has_letter(F.col("text"))).mapInArrow(
        _predicted(shared), "doc_id long, lang_pred string, score double"
    )
    return out.select("doc_id", held_out(F.col("doc_id"), model.params).alias("held_out"), "lang_pred", "score")
