"""Generation records, review logs and token accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions.mcq import answer_line, explain_line
from examloom.functions.text import json_string
from examloom.schemas import STAGES, TOKEN_FIELDS, TOKENS

# Log headers and the user turn of flat records.
REVIEW_LOG_HEADER = ("Topic", "Keep", "Reason", "Question")
FLAT_REVIEW_LOG_HEADER = (
    "Topic", "Decision", "Reason", "Final", "Answer", "Explain", "Original", "Review JSON",
)
TOTAL_HEADER = ("TotalInput", "TotalOutput", "TotalTokens")
FLAT_USER_TURN = "MCQ generation"


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def assemble_record(stages: DataFrame) -> DataFrame:
    """Generation records from one row of stage outputs per task.

    Expects ``topic``, ``prompt``, ``keep``, ``reason``, ``_error`` and, per
    stage, ``<stage>_text``, ``<stage>_in`` and ``<stage>_out``. A row with an
    error keeps only topic and error.
    """
    ok = F.col("_error").isNull()

    def when_ok(value: Column, name: str) -> Column:
        return F.when(ok, value).alias(name)

    messages = F.array(
        _message("user", F.col("prompt")), _message("assistant", F.col("beautify_text"))
    )
    meta = F.struct(
        F.col("generator_text").alias("raw"),
        F.col("comment_text").alias("comment"),
        F.col("refine_text").alias("refined"),
    )
    tokens = F.struct(*[F.col(name).cast("int").alias(name) for name in TOKEN_FIELDS])
    passed_through = [
        c
        for c in stages.columns
        if c not in {"topic", "prompt", "keep", "reason", "_error", *TOKEN_FIELDS}
        and c not in {f"{s}_text" for s in STAGES}
    ]
    return stages.select(
        *passed_through,
        "topic",
        when_ok(F.col("prompt"), "question"),
        when_ok(messages, "messages"),
        when_ok(F.col("keep"), "keep"),
        when_ok(F.col("reason"), "reason"),
        when_ok(meta, "meta"),
        F.when(ok, tokens).cast(TOKENS).alias("tokens"),
        "_error",
        F.lit(None).cast("string").alias("content"),
    )


def _review_json(review: Column) -> Column:
    fields = [
        F.concat(F.lit(f'"{name}": '), json_string(review[name]))
        for name in ("decision", "reason", "final_question")
    ]
    return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))


def assemble_flat(stages: DataFrame) -> DataFrame:
    """Flat records from ``topic``, ``original``, ``fixed`` and a ``review`` struct."""
    return stages.select(
        *[c for c in stages.columns if c not in {"topic", "original", "fixed", "review"}],
        "topic",
        "original",
        F.col("fixed").alias("final"),
        answer_line(F.col("fixed")).alias("answer"),
        explain_line(F.col("fixed")).alias("explain"),
        F.col("review.decision").alias("decision"),
        F.col("review.reason").alias("reason"),
        _review_json(F.col("review")).alias("review_json"),
    )


def flat_dataset(flat_records: DataFrame) -> DataFrame:
    """Chat form of flat records; ``topic`` is kept so that later prompts can name it."""
    return flat_records.select(
        "topic",
        F.array(_message("user", F.lit(FLAT_USER_TURN)), _message("assistant", F.col("final")))
        .alias("messages"),
    )


def review_log(records: DataFrame) -> DataFrame:
    """Topic, Keep, Reason, Question; an error row reports its error as reason."""
    failed = F.coalesce("_error", F.lit("")) != ""
    return records.select(
        F.coalesce("topic", F.lit("")).alias("Topic"),
        F.when(failed, F.lit(False)).otherwise(F.col("keep")).alias("Keep"),
        F.when(failed, F.col("_error")).otherwise(F.col("reason")).alias("Reason"),
        F.when(failed, F.lit(""))
        .otherwise(F.try_element_at("messages", F.lit(2)).content)
        .alias("Question"),
    )


def flat_review_log(flat_records: DataFrame) -> DataFrame:
    """The eight review columns of flat records."""
    fields = (
        "topic", "decision", "reason", "final", "answer", "explain", "original", "review_json",
    )
    return flat_records.select(
        *[F.col(f).alias(h) for f, h in zip(fields, FLAT_REVIEW_LOG_HEADER)]
    )


def token_usage(records: DataFrame, keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """Tokens per stage and in total; null counts and error rows are zero.

    All fifteen columns are filled for error rows too.
    """
    failed = F.coalesce("_error", F.lit("")) != ""

    def count(stage: str, side: str) -> Column:
        value = F.coalesce(F.col(f"tokens.{stage}_{side}").cast("bigint"), F.lit(0))
        return F.when(failed, F.lit(0)).otherwise(value).cast("bigint")

    def total(*sides: str) -> Column:
        terms = [count(stage, side) for side in sides for stage in STAGES]
        return sum(terms[1:], terms[0])

    per_stage = [
        count(stage, side).alias(f"{stage.capitalize()}_{side}")
        for stage in STAGES
        for side in ("in", "out")
    ]
    return records.select(
        *keep_cols,
        F.coalesce("topic", F.lit("")).alias("Topic"),
        *per_stage,
        total("in").alias("TotalInput"),
        total("out").alias("TotalOutput"),
        total("in", "out").alias("TotalTokens"),
        F.when(failed, F.lit(False)).otherwise(F.coalesce("keep", F.lit(False))).alias("Keep"),
    )


def token_usage_by_topic(usage: DataFrame) -> DataFrame:
    """Totals of ``token_usage`` per topic."""
    return usage.groupBy("Topic").agg(
        F.count("*").alias("n_rows"), *[F.sum(c).alias(c) for c in TOTAL_HEADER]
    )
