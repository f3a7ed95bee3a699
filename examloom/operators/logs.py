"""Round logs in the column layout of the comparison reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.functions.text import log_excerpt, log_text
from examloom.operators.blinding import blind_mapping
from examloom.operators.boards import rounds_with_total
from examloom.operators.grid import pivot_models


def geval_log(rounds: DataFrame, x: str, y: str) -> DataFrame:
    """Scored two-arm rounds with the arms named ``x`` and ``y``."""
    return rounds.select(
        F.col("task_id").alias("round"),
        "topic",
        F.col("a_is_x").alias(f"A_is_{x}"),
        "question_A",
        "question_B",
        "score_A",
        "score_B",
        F.col("score_x").alias(f"score_{x}"),
        F.col("score_y").alias(f"score_{y}"),
        log_text(F.col("judge_raw")).alias("judge_raw"),
    )


def choice_log(
    rounds: DataFrame, x: str, y: str, judge: str, side_scores: bool = False
) -> DataFrame:
    """Two-arm rounds decided by choice; ``side_scores`` adds two columns that stay empty."""
    nothing = F.lit(None).cast("int")
    sides = [nothing.alias("score_A"), nothing.alias("score_B")] if side_scores else []
    return rounds.select(
        F.col("task_id").alias("round"),
        "topic",
        F.col("a_is_x").alias(f"A_is_{x}"),
        "question_A",
        "question_B",
        log_text(F.col("judge_raw")).alias(f"{judge}_judge"),
        F.col("choice").alias(f"{judge}_choice"),
        *sides,
        F.col("score_x").alias(f"score_{x}"),
        F.col("score_y").alias(f"score_{y}"),
    )


def pairwise_log(judged: DataFrame, reason_chars: int) -> DataFrame:
    """Round-robin matches with the judge's reply, whole and as its first ``reason_chars``."""
    return judged.select(
        "task_id",
        "topic",
        "model_A",
        "model_B",
        "winner",
        log_excerpt(F.col("judge_raw"), reason_chars).alias("reason"),
        "judge_raw",
    )


def best_of_n_log(judged: DataFrame, cells: DataFrame, models: list[str], seed: int) -> DataFrame:
    """Best-of-N tasks with the blind mapping and every model's response, from cells or a long grid."""
    if "cells" in cells.columns:
        texts = [F.get("cells.text", F.lit(i)).alias(f"resp_{m}") for i, m in enumerate(models)]
        answers = cells.select("task_id", *texts)
    else:
        answers = pivot_models(cells, models, "text", "resp_")
    return (
        blind_mapping(judged, models, seed)
        .select(
            "task_id",
            "topic",
            "prompt",
            F.col("winner").alias("winner_model"),
            F.col("judge_raw").alias("judge_reason"),
            "model_mapping",
        )
        .join(answers, "task_id")
    )


def ratings_log(judged: DataFrame, scores: DataFrame, models: list[str]) -> DataFrame:
    """N-model rounds, one score column per model, and a last row with the totals."""
    rounds = judged.select("task_id", "topic", "prompt", F.col("judge_raw").alias("judge_raw_response"))
    done = rounds_with_total(scores.select("task_id", "model", "score"), rounds, models)
    return done.select(
        "round", "topic", "prompt", *[F.col(f"`score_{m}`") for m in models], "judge_raw_response"
    )


def latency_log(rounds: DataFrame, x: str, y: str) -> DataFrame:
    """Timed two-arm rounds with the arms named ``x`` and ``y``: both questions, both times."""
    return rounds.select(
        F.col("task_id").alias("round"),
        "topic",
        *[F.col(f"{arm}_text").alias(f"question_{arm}") for arm in (x, y)],
        *[F.col(f"{arm}_latency_s").alias(f"time_{arm}") for arm in (x, y)],
    )
