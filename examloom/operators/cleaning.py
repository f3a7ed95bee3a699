"""Keep gates, content resolution, the kept/removed split and exact de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions import mcq
from examloom.functions.text import keyed_index, let, strip
from examloom.functions.prompts import render
from examloom.functions.verdicts import GATE_FAILED, parse_object, parse_verdict_json, truthy

# Drop reasons and review fallbacks.
KEEP_FALSE = "keep = false"
UNREADABLE = "題目內容無法讀取："
NO_CONTENT_FIELD = "'缺少 content 或 messages 欄位'"
SHORT_MESSAGES = "list index out of range"
NULL_CONTENT = "'NoneType' object has no attribute 'strip'"
ACCEPT = "accept"
CALL_ERROR = "error"
JSON_ERROR = "JSON parse error"
SUBJECT_SLOT = "{subject}"
# Where a record goes.
CLEAN, REMOVED, QUARANTINED = "clean", "removed", "quarantined"


def resolve_content(df: DataFrame, out: str = "full") -> DataFrame:
    """Add the question text and, where there is none, why not.

    ``content`` is used when present, else the second message.
    """
    reply = F.try_element_at("messages", F.lit(2))
    text = F.coalesce(F.col("content"), reply.content)
    problem = (
        F.when(text.isNotNull(), F.lit(None).cast("string"))
        .when(F.col("messages").isNull(), F.lit(NO_CONTENT_FIELD))
        .when(F.size("messages") < 2, F.lit(SHORT_MESSAGES))
        .otherwise(F.lit(NULL_CONTENT))
    )
    return df.withColumn(out, strip(text)).withColumn(
        "content_error", F.concat(F.lit(UNREADABLE), problem)
    )


def keep_gate(df: DataFrame, mode: str = "strict") -> DataFrame:
    """Add ``kept`` and ``gate_reason``; a missing flag drops the row.

    ``strict`` reads a BOOLEAN flag; ``truthy`` reads a VARIANT flag and keeps
    on any value that counts as true.
    """
    if mode not in ("strict", "truthy"):
        raise ValueError(f"unknown mode {mode!r}")
    flag = truthy(F.col("keep")) if mode == "truthy" else F.coalesce("keep", F.lit(False))
    return df.withColumn("kept", flag).withColumn(
        "gate_reason", F.when(~flag, F.coalesce("reason", F.lit(KEEP_FALSE)))
    )


def classify(records: DataFrame, mode: str = "strict") -> DataFrame:
    """Gate and content resolution in one narrow step: adds ``full``, ``drop_reason``."""
    gated = resolve_content(keep_gate(records, mode))
    return gated.withColumn("drop_reason", F.coalesce("gate_reason", "content_error")).drop(
        "kept", "gate_reason", "content_error"
    )


def split_keep_removed(
    records: DataFrame, mode: str = "strict", strict_mcq: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(clean, removed) of generation records; every input row is in exactly one.

    Clean rows hold the prompt and the extracted question, removed rows the
    reason and the whole record as JSON. No shuffle; with a columnar source
    the two sides read only the columns they need.
    """
    record_json = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "true"})
    done = classify(records, mode)
    clean = done.where(F.col("drop_reason").isNull()).select(
        F.coalesce("question", F.lit("")).alias("question"),
        mcq.extract_mcq(mcq.scrub_mcq(F.col("full"), strict_mcq), strict_mcq).alias("LLMans"),
    )
    removed = done.where(F.col("drop_reason").isNotNull()).select(
        F.col("drop_reason").alias("reason"), record_json.alias("content")
    )
    return clean, removed


def split_rows(records: DataFrame, mode: str = "strict", strict_mcq: bool = False) -> DataFrame:
    """One row for each record: side, question, LLMans, reason and content.

    ``side`` is clean, removed or quarantined. Clean rows hold the prompt and the
    extracted question, the others the reason and the record as text. Records read
    with ``checked_lines`` have the line itself as content, and those with a
    ``_problem`` are quarantined; others are written out as JSON. Narrow: one scan
    gives all sides.
    """
    lined = "_line" in records.columns
    own = [c for c in records.columns if c not in ("_line", "_problem")]
    content = F.col("_line") if lined else F.to_json(F.struct(*own), {"ignoreNullFields": "true"})
    problem = F.col("_problem") if lined else F.lit(None).cast("string")
    done = classify(records.withColumns({"_content": content, "_odd": problem}), mode)
    clean = F.col("_odd").isNull() & F.col("drop_reason").isNull()
    extracted = mcq.extract_mcq(mcq.scrub_mcq(F.col("full"), strict_mcq), strict_mcq)
    return done.select(
        F.when(clean, CLEAN).when(F.col("_odd").isNull(), REMOVED).otherwise(QUARANTINED).alias("side"),
        F.when(clean, F.coalesce("question", F.lit(""))).alias("question"),
        F.when(clean, extracted).alias("LLMans"),
        F.when(~clean, F.coalesce("_odd", "drop_reason")).alias("reason"),
        F.when(~clean, F.col("_content")).alias("content"),
    )


def gate_counts(classified: DataFrame) -> DataFrame:
    """Rows per outcome and reason."""
    return classified.groupBy(
        F.col("drop_reason").isNull().alias("kept"),
        F.coalesce("drop_reason", F.lit("")).alias("drop_reason"),
    ).agg(F.count("*").alias("n_rows"))


def judge_gate(
    df: DataFrame,
    replies: DataFrame,
    key: str,
    reply_col: str = "reply",
    mode: str = "strict",
) -> DataFrame:
    """Second-pass review: add ``ok`` and ``reason`` from each row's reply.

    A row without a reply, or with one that does not parse, is not kept.
    """
    verdict = parse_verdict_json(F.col(reply_col), mode, GATE_FAILED)
    parsed = replies.select(key, verdict.alias("_v"))
    return (
        df.join(parsed, key, "left")
        .withColumn("ok", F.coalesce("_v.keep", F.lit(False)))
        .withColumn("gate_reason", F.coalesce("_v.reason", F.lit(GATE_FAILED)))
        .drop("_v")
    )


def split_flat(
    gated: DataFrame,
    templates: list[str],
    seed: int,
    key: str,
    text_col: str = "full",
    topic_col: str = "topic",
) -> tuple[DataFrame, DataFrame]:
    """(clean, removed) of second-pass reviewed flat records.

    Clean rows get a prompt drawn from ``templates`` for their subject and the
    text without its answer lines.
    """
    pool = F.array(*[F.lit(t) for t in templates])
    drawn = F.try_element_at(
        pool, (keyed_index(len(templates), seed, "flat-prompt", F.col(key)) + 1).cast("int")
    )
    prompt = render(
        drawn, mcq.subject_prefixed(F.coalesce(topic_col, F.lit(""))), SUBJECT_SLOT
    )
    clean = gated.where("ok").select(
        key,
        prompt.alias("question"),
        mcq.strip_answer_lines(F.col(text_col)).alias("LLMans"),
    )
    removed = gated.where("not ok").select(
        key, F.col("gate_reason").alias("reason"), F.col(text_col).alias("content")
    )
    return clean, removed


def resolve_review(reply: Column, text: Column, call_failed: Column) -> Column:
    """STRUCT<decision, reason, final_question> of a first review.

    This review accepts on failure: a failed call or a reply that does not
    parse keeps the text as it was.
    """
    parsed = parse_object(reply, "decision: STRING, reason: STRING, final_question: STRING")

    def shape(p: Column) -> Column:
        fallback = F.when(call_failed, F.lit(CALL_ERROR)).when(p.isNull(), F.lit(JSON_ERROR))
        usable = fallback.isNull() & (F.coalesce(p.final_question, F.lit("")) != "")
        return F.struct(
            F.when(fallback.isNotNull(), F.lit(ACCEPT)).otherwise(p.decision).alias("decision"),
            F.coalesce(fallback, p.reason).alias("reason"),
            F.when(usable, p.final_question).otherwise(text).alias("final_question"),
        )

    return let(parsed, shape)


def dedup_exact(df: DataFrame, text_col: str, order_col: str) -> DataFrame:
    """First row, by the unique ``order_col``, of every distinct text.

    Only digest and order value are shuffled for the grouping, combined before
    the shuffle, so a text with very many copies is no hot group; whole rows
    move once, spread by the order value.
    """
    first = (
        df.select(F.sha2(text_col, 256).alias("_digest"), F.col(order_col))
        .groupBy("_digest")
        .agg(F.min(order_col).alias(order_col))
        .select(order_col)
    )
    return df.join(first, order_col, "left_semi")
