"""Running scoreboards over a stream of verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.operators.boards import pairwise_tally


def stream_board(verdicts: DataFrame) -> DataFrame:
    """Running wins, ties and matches per model; write it in complete mode.

    The state holds one row per model, so it needs no watermark.
    """
    return pairwise_tally(verdicts)


def stream_best_of_n(verdicts: DataFrame) -> DataFrame:
    """Running wins per winner name over one row per task; write it in complete mode."""
    return verdicts.groupBy("winner").agg(F.count("*").alias("wins"))


def progress(done: DataFrame, total: int) -> DataFrame:
    """Finished rows against the planned total."""
    return done.agg(F.count("*").alias("done")).withColumn("total", F.lit(total).cast("bigint"))
