"""From raw documents to packed sequences: five stages, each one operator.

Every stage reads what the one before kept, as Parquet, and passes on the columns
of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.llm.decontaminate import contamination
from examloom.llm.lines import without_similar_lines
from examloom.llm.minhash import NearDup, near_duplicates
from examloom.llm.packing import packed
from examloom.llm.quality import fit_quality, with_score
from examloom.llm.rows import free_name, with_row_key
from examloom.session import written

KEEP_FROM = 0.3  # least quality score of a kept document
PERCENT = 80  # similarity of near duplicates


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least ``KEEP_FROM``; the rest go. Columns keep their names and values."""
    model = fit_quality(docs, _table(spark, sf_dir, "labels"))
    score = free_name(docs, "quality_score")
    return with_score(docs, model, score).where(F.col(score) >= KEEP_FROM).drop(score)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that resemble an earlier one; n_chars follows the text.

    A document that had words and has none left repeats others line by line and goes.
    Further columns pass through, also those called n_lines or n_removed.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    held = docs.select("doc_id", "text", F.struct(F.lit(0), *[F.col(f"`{c}`") for c in rest]).alias("held"))
    cleaned = without_similar_lines(held).where("n_removed = 0 or rlike(text, '[^ \\\\t-\\\\r]')")
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return cleaned.select(*[new.get(c, F.col(f"held.`{c}`")).alias(c) for c in docs.columns])


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates.

    Rows that share a doc_id are documents of their own; rows without one stay.
    """
    key = free_name(docs, "row_key")
    keyed = with_row_key(docs, key)
    named = keyed.where("doc_id is not null").select(F.col(key).alias("doc_id"), "text")
    classes = near_duplicates(named, NearDup(percent=PERCENT))
    gone = classes.where("not kept").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(gone, key, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; rows that share a doc_id are judged one by one."""
    key = free_name(docs, "row_key")
    keyed = with_row_key(docs, key)
    hits = contamination(keyed.select(F.col(key).alias("doc_id"), "text"), _table(spark, sf_dir, "benchmark"))
    gone = hits.where("n_hit > 0").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(gone, key, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 4096 tokens."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_dup_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: The classifier and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
