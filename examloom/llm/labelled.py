"""Labelled samples of bounded size for fitting classifiers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.llm import arrays as A


def fold(doc_id: Column, folds: int = 5) -> Column:
    """Remainder of the CRC-32 of the id's decimal text."""
    return F.crc32(doc_id.cast("string")) % folds


def _features(extract, bits: int):
    def run(batches):
        for rows, data, borders in A.runs(batches):
            owner, index = extract(data, borders, bits)
            at = np.searchsorted(owner, np.arange(rows.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("label"), A.blobs(index.astype("<i4"), at)],
                names=["doc_id", "label", "features"],
            )

    return run


def sample(docs: DataFrame, labels: DataFrame, label: str, extract, bits: int, rows: int):
    """(labels, row borders, feature indices) of at most ``rows`` training documents.

    Taken are the labelled documents outside fold 0 with the least hash of their
    id, a choice that does not depend on partitions. An id with several labels
    has the least of them. The bound makes the sample small enough to broadcast
    its ids and to fit on the driver.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label is not null")
        .where(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    got = (
        texts.join(F.broadcast(chosen), "doc_id")
        .mapInArrow(_features(extract, bits), "doc_id long, label int, features binary")
        .toArrow()
        .sort_by("doc_id")
    )
    blobs = got.column("features").to_pylist()
    index = np.frombuffer(b"".join(blobs), "<i4").astype(np.int64)
    at = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])]).astype(np.int64)
    return np.array(got.column("label").to_pylist(), np.int64), at, index
