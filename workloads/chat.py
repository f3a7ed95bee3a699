"""Training examples and records from conversation turns.

An example is a turn with the turn after it, found by an equi-join on
(conversation, turn): no conversation is ever gathered whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.functions.text import json_string, ws_tokens
from examloom.operators import chat, records
from examloom.schemas import CHAT_MESSAGES, STAGES
from examloom.session import fresh_path
from workloads.registry import query, sql_lines, sql_strip, sql_tokens, table

BUDGET = 120


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    following = turns.select(
        "conv_id",
        (F.col("turn") - 1).alias("turn"),
        F.struct("role", F.col("text").alias("content")).alias("next"),
    )
    this = F.struct(F.col("role"), F.col("text").alias("content"))
    return turns.join(following, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        F.when(F.col("next").isNull(), F.array(this)).otherwise(F.array(this, "next"))
        .cast(CHAT_MESSAGES).alias("messages"),
        F.col("text").alias("question"),
        F.col("role").alias("LLMans"),
    )


EXAMPLES_SQL = """examples AS (
  SELECT a.conv_id, a.turn,
    CASE WHEN b.conv_id IS NULL THEN 'user' ELSE a.role END AS role_1, a.text AS content_1,
    CASE WHEN b.conv_id IS NULL THEN 'assistant' ELSE b.role END AS role_2,
    CASE WHEN b.conv_id IS NULL THEN a.role ELSE b.text END AS content_2
  FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""
RENDERED_SQL = (
    EXAMPLES_SQL
    + f""", rendered AS (
  SELECT conv_id, turn,
    CASE WHEN role_1 = 'system' THEN '' ELSE
      '<|im_start|>system' || chr(10) || '{chat.DEFAULT_SYSTEM}' || '<|im_end|>' || chr(10) END
    || '<|im_start|>' || role_1 || chr(10) || content_1 || '<|im_end|>' || chr(10)
    || '<|im_start|>' || role_2 || chr(10) || content_2 || '<|im_end|>' || chr(10) AS text
  FROM examples)"""
)


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_chat(chat.to_messages(examples(spark, sf_dir), ("conv_id", "turn")))


@query("to_messages", f"WITH {EXAMPLES_SQL} SELECT * FROM examples")
def to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = chat.to_messages(examples(spark, sf_dir), ("conv_id", "turn"))
    return done.select(
        "conv_id",
        "turn",
        *[
            F.col("messages")[i][field].alias(f"{field}_{i + 1}")
            for i in (0, 1)
            for field in ("role", "content")
        ],
    )


@query(
    "to_messages_mcq",
    """SELECT doc_id, '{' || chr(10) || '  "stem": ' || to_json(text)::VARCHAR || ',' || chr(10)
    || '  "options": {' || chr(10)
    || '    "A": ' || to_json(lang)::VARCHAR || ',' || chr(10)
    || '    "B": ' || to_json(source)::VARCHAR || ',' || chr(10)
    || '    "C": "",' || chr(10) || '    "D": "\\\"q\\\""' || chr(10) || '  }' || chr(10) || '}'
    AS content_2 FROM documents""",
)
def to_messages_mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = F.struct(
        F.col("lang").alias("A"),
        F.col("source").alias("B"),
        F.lit("").alias("C"),
        F.lit('"q"').alias("D"),
    )
    clean = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.lit("q").alias("question"),
        F.struct(F.col("text").alias("stem"), options.alias("options")).alias("LLMans"),
    )
    return chat.to_messages(clean, ("doc_id",)).select(
        "doc_id", F.col("messages")[1].content.alias("content_2")
    )


# Examples of one file: answers as objects, as texts that look like objects, and messages.
EXAMPLE_LINE_SQL = """CASE doc_id % 4
    WHEN 0 THEN '{"question": "Q' || doc_id || '", "LLMans": {"stem":' || j || ', "options" : {"B": "' || lang
      || '", "A": []},"n": ' || n_chars || ', "empty": {}, "ok": [true, null, {"x": "a\\"b,:"}]}}'
    WHEN 1 THEN '{"LLMans": ' || j || ', "question": "Q' || doc_id || '"}'
    WHEN 2 THEN '{"LLMans": "{\\"stem\\": 1}", "question": "' || source || '"}'
    ELSE '{"messages": [{"role": "user", "content": "' || lang || '"}, {"role": "assistant", "content": ' || j
      || '}], "LLMans": {"a": 1}}' END"""
_MIXED_SQL = """CASE doc_id % 4 WHEN 0 THEN '{' || chr(10) || '  "stem": ' || j || ',' || chr(10) || '  "options": {' || chr(10)
      || '    "B": "' || lang || '",' || chr(10) || '    "A": []' || chr(10) || '  },' || chr(10) || '  "n": ' || n_chars || ','
      || chr(10) || '  "empty": {},' || chr(10) || '  "ok": [' || chr(10) || '    true,' || chr(10) || '    null,' || chr(10)
      || '    {' || chr(10) || '      "x": "a\\"b,:"' || chr(10) || '    }' || chr(10) || '  ]' || chr(10) || '}'
    WHEN 2 THEN '{"stem": 1}' ELSE text END"""


@query(
    "mixed_completions",
    f"""WITH docs AS (SELECT *, to_json(text)::VARCHAR AS j FROM documents),
    lines AS (SELECT *, {EXAMPLE_LINE_SQL} AS line, {_MIXED_SQL} AS content_2 FROM docs)
    SELECT line, CASE doc_id % 4 WHEN 2 THEN source WHEN 3 THEN lang ELSE 'Q' || doc_id END AS content_1, content_2
    FROM lines""",
)
def mixed_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages from one file with all kinds of answers, next to the line they come from."""
    path = fresh_path(spark, "examples")
    docs = table(spark, sf_dir, "documents").withColumn("j", json_string(F.col("text")))
    docs.select(F.expr(EXAMPLE_LINE_SQL.replace("\\", "\\\\")).alias("value")).write.text(path)
    lines = spark.read.text(path).withColumn("line", F.col("value"))
    return chat.messages_of_lines(lines, ("line",)).select(
        "line", *[F.col("messages")[i].content.alias(f"content_{i + 1}") for i in (0, 1)]
    )


@query("render_chat", f"WITH {RENDERED_SQL} SELECT * FROM rendered")
def render_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir).select("conv_id", "turn", "text")


_MARK = "'<|im_start|>assistant'"


@query(
    "completion_span",
    f"""WITH {RENDERED_SQL},
    parts AS (SELECT *, string_split(text, {_MARK}) AS p FROM rendered),
    done AS (SELECT conv_id, turn, text,
      CASE WHEN len(p) > 1 THEN p[-1] ELSE '' END AS completion_text FROM parts)
    SELECT conv_id, turn, completion_text,
      left(text, length(text) - length(completion_text)) AS prompt_text,
      length(completion_text)::INTEGER AS length,
      (length(text) - length(completion_text) + 1)::INTEGER AS start FROM done""",
)
def completion_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.completion_span(_rendered(spark, sf_dir)).drop("messages", "text")


@query(
    "flag_over_budget",
    f"""WITH {RENDERED_SQL}, counted AS (
      SELECT conv_id, turn, {sql_tokens('text')}::INTEGER AS n_tokens FROM rendered)
    SELECT *, n_tokens > {BUDGET} AS over_budget FROM counted""",
)
def flag_over_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.flag_over_budget(_rendered(spark, sf_dir), BUDGET).drop("messages", "text")


@query("ws_tokens", f"SELECT doc_id, {sql_tokens('text')}::INTEGER AS n_tokens FROM documents")
def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", ws_tokens(F.col("text")).alias("n_tokens")
    )


def stage_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every five turns of a conversation as the five stages; one slot each, no gathering.

    Five turns that are not complete stand for a failed chain.
    """

    def slot(i: int, column: str = "text") -> F.Column:
        return F.max(F.when(F.col("turn") % 5 == i, F.col(column)))

    wide = (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id", F.expr("turn div 5").alias("chain"))
        .agg(
            slot(0, "role").alias("topic"),
            *[slot(i).alias(f"{s}_text") for i, s in enumerate(STAGES)],
        )
    )
    previous = ("generator", "generator", "comment", "refine", "beautify")
    return wide.select(
        "*",
        F.col("generator_text").alias("prompt"),
        F.when(F.col("review_text").isNull(), F.lit("short")).alias("_error"),
        (F.length("review_text") % 2 == 0).alias("keep"),
        F.col("topic").alias("reason"),
        *[ws_tokens(F.col(f"{s}_text")).alias(f"{s}_out") for s in STAGES],
        *[ws_tokens(F.col(f"{p}_text")).alias(f"{s}_in") for s, p in zip(STAGES, previous)],
    )


_SLOTS = ", ".join(
    f"max(CASE WHEN turn % 5 = {i} THEN text END) AS {s}_text" for i, s in enumerate(STAGES)
)
STAGES_SQL = f"""wide AS (
  SELECT conv_id, max(CASE WHEN turn % 5 = 0 THEN role END) AS topic, {_SLOTS}
  FROM conversations GROUP BY conv_id, turn // 5),
stages AS (SELECT *, CASE WHEN review_text IS NULL THEN 'short' END AS _error,
  length(review_text) % 2 = 0 AS keep FROM wide)"""


@query(
    "assemble_record",
    f"""WITH {STAGES_SQL} SELECT conv_id, topic, _error,
    CASE WHEN _error IS NULL THEN generator_text END AS question,
    CASE WHEN _error IS NULL THEN beautify_text END AS answer,
    CASE WHEN _error IS NULL THEN keep END AS keep,
    CASE WHEN _error IS NULL THEN comment_text END AS comment,
    CASE WHEN _error IS NULL THEN {sql_tokens('review_text')}::INTEGER END AS review_out
    FROM stages""",
)
def assemble_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.assemble_record(stage_outputs(spark, sf_dir)).select(
        "conv_id",
        "topic",
        "_error",
        "question",
        F.try_element_at("messages", F.lit(2)).content.alias("answer"),
        "keep",
        F.col("meta.comment").alias("comment"),
        F.col("tokens.review_out").alias("review_out"),
    )


@query(
    "review_log",
    f"""WITH {STAGES_SQL} SELECT topic AS "Topic",
    CASE WHEN _error IS NULL THEN keep ELSE false END AS "Keep",
    coalesce(_error, topic) AS "Reason",
    CASE WHEN _error IS NULL THEN beautify_text ELSE '' END AS "Question" FROM stages""",
)
def review_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.review_log(records.assemble_record(stage_outputs(spark, sf_dir)))


_IN = {"generator": "generator", "comment": "generator", "refine": "comment",
       "beautify": "refine", "review": "beautify"}


def _sql_count(stage: str, side: str) -> str:
    source = stage if side == "out" else _IN[stage]
    return f"CASE WHEN _error IS NULL THEN {sql_tokens(f'{source}_text')} ELSE 0 END"


_COUNTS = ", ".join(
    f"({_sql_count(s, side)})::BIGINT AS {s.capitalize()}_{side}"
    for s in STAGES
    for side in ("in", "out")
)
_TOTAL_IN = " + ".join(f"{s.capitalize()}_in" for s in STAGES)
_TOTAL_OUT = " + ".join(f"{s.capitalize()}_out" for s in STAGES)
USAGE_SQL = f"""{STAGES_SQL}, counted AS (SELECT conv_id, topic, keep, _error, {_COUNTS} FROM stages),
usage AS (SELECT * EXCLUDE (keep, _error, topic), topic AS "Topic",
  {_TOTAL_IN} AS "TotalInput", {_TOTAL_OUT} AS "TotalOutput",
  {_TOTAL_IN} + {_TOTAL_OUT} AS "TotalTokens",
  CASE WHEN _error IS NULL THEN coalesce(keep, false) ELSE false END AS "Keep" FROM counted)"""


def _usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_usage(
        records.assemble_record(stage_outputs(spark, sf_dir)), ("conv_id",)
    )


@query("token_usage", f"WITH {USAGE_SQL} SELECT * FROM usage")
def token_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usage(spark, sf_dir)


@query(
    "token_usage_by_topic",
    f"""WITH {USAGE_SQL} SELECT "Topic", count(*) AS n_rows,
    sum("TotalInput")::BIGINT AS "TotalInput", sum("TotalOutput")::BIGINT AS "TotalOutput",
    sum("TotalTokens")::BIGINT AS "TotalTokens" FROM usage GROUP BY 1""",
)
def token_usage_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_usage_by_topic(_usage(spark, sf_dir))


FIXED_SQL = "text || chr(10) || '答案：' || lang || chr(10) || '解析： ' || source"


def flat_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    review = F.struct(
        F.lit("accept").alias("decision"),
        F.col("lang").alias("reason"),
        F.col("text").alias("final_question"),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr("lang || ' - ' || source").alias("topic"),
        F.col("text").alias("original"),
        F.expr(FIXED_SQL).alias("fixed"),
        review.alias("review"),
    )


def _first_line(word: str) -> str:
    first = f"list_filter({sql_lines('fixed')}, lambda s: starts_with(s, '{word}'))[1]"
    inner = f"replace({first}, '{word}：', '')"
    return sql_strip(inner)


FLAT_SQL = f"""flat AS (SELECT *, lang || ' - ' || source AS topic, {FIXED_SQL} AS fixed FROM documents),
assembled AS (SELECT doc_id, topic, text AS original, fixed AS final,
  {_first_line('答案')} AS answer, {_first_line('解析')} AS explain,
  'accept' AS decision, lang AS reason,
  '{{"decision": "accept", "reason": ' || to_json(lang)::VARCHAR || ', "final_question": '
    || to_json(text)::VARCHAR || '}}' AS review_json
  FROM flat)"""


@query("assemble_flat", f"WITH {FLAT_SQL} SELECT * FROM assembled")
def assemble_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.assemble_flat(flat_stages(spark, sf_dir))


@query(
    "flat_review_log",
    f"""WITH {FLAT_SQL} SELECT topic AS "Topic", decision AS "Decision", reason AS "Reason",
    final AS "Final", answer AS "Answer", explain AS "Explain", original AS "Original",
    review_json AS "Review JSON" FROM assembled""",
)
def flat_review_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.flat_review_log(records.assemble_flat(flat_stages(spark, sf_dir)))
