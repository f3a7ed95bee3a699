"""Gates, extraction and splits over documents joined with their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.functions import mcq
from examloom.functions.verdicts import parse_verdict_json
from examloom.operators import cleaning
from examloom.schemas import CHAT_MESSAGES
from examloom.sources.readers import SUBJECT_TEMPLATES
from workloads.registry import (
    SQL_SPACE,
    query,
    sql_index,
    sql_lines,
    sql_strip,
    table,
)

SEED = 7

# The exam text of a document: its whole text as stem, then options and answer lines.
EXAM_SQL = (
    "'題目：' || text || chr(10) || '(A) ' || lang || ' ✓' || chr(10) || '(B) $O(' || n_chars"
    " || ')$ ← 正確' || chr(10) || '(C) k \\pmod N + 1' || chr(10) || 'D. ' || source || chr(10)"
    " || '答案：A' || chr(10) || '解析：' || source"
)
EXAM_SPARK = EXAM_SQL.replace("\\pmod", "\\\\pmod")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("exam", F.expr(EXAM_SPARK))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation records: the place of the text, and so its errors, follow the language."""
    docs = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    user = "named_struct('role', 'user', 'content', source)"
    reply = "named_struct('role', 'assistant', 'content', exam)"
    return docs.select(
        "doc_id",
        F.expr("lang || ' - ' || source").alias("topic"),
        F.expr("'Q' || doc_id").alias("question"),
        F.expr(
            f"CASE lang WHEN 'fr' THEN array({user}, {reply}) WHEN 'de' THEN array({user}) END"
        ).cast(CHAT_MESSAGES).alias("messages"),
        (F.col("quality") == 1).alias("keep"),
        F.expr("CASE WHEN toxic = 1 THEN 'toxic' END").alias("reason"),
        F.expr("CASE WHEN lang = 'en' THEN exam END").alias("content"),
    )


DOCS_SQL = f"docs AS (SELECT *, {EXAM_SQL} AS exam FROM documents)"
RECORDS_SQL = f"""{DOCS_SQL}, records AS (
  SELECT doc_id, lang || ' - ' || source AS topic, 'Q' || doc_id AS question, lang,
    coalesce(quality = 1, false) AS kept,
    CASE WHEN NOT coalesce(quality = 1, false)
         THEN CASE WHEN toxic = 1 THEN 'toxic' ELSE 'keep = false' END END AS gate_reason,
    CASE WHEN lang IN ('en', 'fr') THEN {sql_strip('exam')} END AS "full",
    CASE lang WHEN 'es' THEN '題目內容無法讀取：''缺少 content 或 messages 欄位'''
              WHEN 'de' THEN '題目內容無法讀取：list index out of range' END AS content_error
  FROM docs LEFT JOIN labels USING (doc_id)),
classified AS (SELECT *, coalesce(gate_reason, content_error) AS drop_reason FROM records)"""


def sql_scrub(expr: str) -> str:
    out = expr
    for pattern in (
        "(答案|正確答案|解析|解釋)[:：].*",
        "(?i)(正確為|正確選項|答案是|答案為|the correct answer is).*",
        "[✓✔✗✘→←★⭐•＊*]+",
        r"(?i)\(.*?(正確|錯誤|correct|incorrect).*?\)",
        f"^題目[:：]?[{SQL_SPACE}]*",
        f"^以下.*內容[:：][{SQL_SPACE}]*",
        f"^這.*版本.*?[{SQL_SPACE}]*",
        f"###[{SQL_SPACE}]*題目[{SQL_SPACE}]*",
    ):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    for token in ("###", "```", "$"):
        out = f"replace({out}, '{token}', '')"
    return f"replace({out}, '\\pmod', 'mod')"


def _sql_option(key: str) -> str:
    first = f"list_filter(parsed, lambda p: p.k = '{key}')[1].t"
    text = f"regexp_replace({sql_strip(first)}, '←|→|<-|->', '', 'g')"
    text = f"regexp_replace({sql_strip(text)}, '(正確|最佳選項|最合適).*', '', 'g')"
    mod = (
        rf"\b([A-Za-z0-9_]+)[{SQL_SPACE}]*mod[{SQL_SPACE}]*([A-Za-z0-9_]+)"
        rf"[{SQL_SPACE}]*\+[{SQL_SPACE}]*1\b"
    )
    return (
        f"coalesce(regexp_replace({sql_strip(text)}, '{mod}', '((\\1 mod \\2) + 1)', 'g'), '')"
        f" AS option_{key.lower()}"
    )


OPTION_SQL = rf"^\(?([A-Da-d])\)?[.)]?[{SQL_SPACE}]*(.*)"
TITLE_SQL = f"^題目[:：]?[{SQL_SPACE}]*"


def sql_extract(source: str, columns: str, text: str) -> str:
    """Stem and options of ``text`` for every row of ``source``."""
    lines = (
        f"list_transform(list_filter(list_transform({sql_lines(text)}, lambda s: {sql_strip('s')}),"
        f" lambda s: s <> ''), lambda s: regexp_replace(s, '{TITLE_SQL}', ''))"
    )
    parsed = (
        "list_transform(ls, lambda s: {'k': upper(regexp_extract(s, '" + OPTION_SQL + "', 1)),"
        " 't': CASE WHEN regexp_extract(s, '" + OPTION_SQL + "', 1) = '' THEN s"
        " ELSE regexp_extract(s, '" + OPTION_SQL + "', 2) END})"
    )
    stem = (
        "array_to_string(list_transform(list_slice(parsed, 1,"
        " coalesce(list_position(list_transform(parsed, lambda p: p.k <> ''), true), len(parsed) + 1)"
        " - 1), lambda p: p.t), ' ')"
    )
    options = ", ".join(_sql_option(k) for k in "ABCD")
    return (
        f"SELECT {columns}, regexp_replace({sql_strip(stem)}, '{TITLE_SQL}', '') AS stem, {options}"
        f" FROM (SELECT *, {parsed} AS parsed FROM (SELECT *, {lines} AS ls FROM {source}))"
    )


def _mcq_columns(struct: str) -> list:
    return [
        F.col(f"{struct}.stem").alias("stem"),
        *[F.col(f"{struct}.options.{k}").alias(f"option_{k.lower()}") for k in mcq.OPTION_KEYS],
    ]


@query(
    "resolve_content",
    f'WITH {RECORDS_SQL} SELECT doc_id, "full", content_error FROM records',
)
def resolve_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.resolve_content(records(spark, sf_dir)).select(
        "doc_id", "full", "content_error"
    )


@query("keep_gate", f"WITH {RECORDS_SQL} SELECT doc_id, kept, gate_reason FROM records")
def keep_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.keep_gate(records(spark, sf_dir)).select("doc_id", "kept", "gate_reason")


@query(
    "gate_counts",
    f"""WITH {RECORDS_SQL} SELECT drop_reason IS NULL AS kept,
    coalesce(drop_reason, '') AS drop_reason, count(*) AS n_rows FROM classified GROUP BY 1, 2""",
)
def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.gate_counts(cleaning.classify(records(spark, sf_dir)))


@query(
    "split_clean",
    f"WITH {RECORDS_SQL}, scrubbed AS (SELECT question, {sql_scrub('\"full\"')} AS t"
    " FROM classified WHERE drop_reason IS NULL) "
    + sql_extract("scrubbed", "question", "t"),
)
def split_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, _ = cleaning.split_keep_removed(records(spark, sf_dir))
    return clean.select("question", *_mcq_columns("LLMans"))


@query(
    "split_removed",
    f"""WITH {RECORDS_SQL} SELECT drop_reason AS reason, doc_id, topic, question
    FROM classified WHERE drop_reason IS NOT NULL""",
)
def split_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, removed = cleaning.split_keep_removed(records(spark, sf_dir))
    whole = F.from_json("content", "doc_id BIGINT, topic STRING, question STRING")
    return removed.select("reason", whole.alias("r")).select("reason", "r.*")


@query("scrub_mcq", f"WITH {DOCS_SQL} SELECT doc_id, {sql_scrub('exam')} AS scrubbed FROM docs")
def scrub_mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "doc_id", mcq.scrub_mcq(F.col("exam")).alias("scrubbed")
    )


@query(
    "extract_mcq",
    f"WITH {DOCS_SQL}, scrubbed AS (SELECT doc_id, {sql_scrub('exam')} AS t FROM docs) "
    + sql_extract("scrubbed", "doc_id", "t"),
)
def extract_mcq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        documents(spark, sf_dir)
        .select("doc_id", mcq.extract_mcq(mcq.scrub_mcq(F.col("exam"))).alias("q"))
        .select("doc_id", *_mcq_columns("q"))
    )


def _sql_labelled(word: str) -> str:
    first = f"list_filter({sql_lines('exam')}, lambda s: starts_with(s, '{word}'))[1]"
    return f"coalesce({sql_strip(f'''replace({first}, '{word}：', '')''')}, 'N/A')"


@query(
    "answer_line",
    f"WITH {DOCS_SQL} SELECT doc_id, {_sql_labelled('答案')} AS answer,"
    f" {_sql_labelled('解析')} AS explain FROM docs",
)
def answer_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    exam = F.col("exam")
    return documents(spark, sf_dir).select(
        "doc_id", mcq.answer_line(exam).alias("answer"), mcq.explain_line(exam).alias("explain")
    )


_KEPT_LINES = (
    f"array_to_string(list_filter({sql_lines('exam')}, lambda s: NOT starts_with(s, '答案')"
    " AND NOT starts_with(s, '解析')), chr(10))"
)


@query(
    "strip_answer_lines",
    f"WITH {DOCS_SQL} SELECT doc_id, {sql_strip(_KEPT_LINES)} AS stripped FROM docs",
)
def strip_answer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "doc_id", mcq.strip_answer_lines(F.col("exam")).alias("stripped")
    )


@query(
    "subject",
    """SELECT doc_id, '資訊工程' || lang AS flat_subject, lang AS subject,
    '資訊工程' AS flat_without_field FROM documents""",
)
def subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = F.expr("lang || ' - ' || source")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        mcq.subject_prefixed(topic).alias("flat_subject"),
        mcq.subject(topic).alias("subject"),
        mcq.subject_prefixed(F.col("lang")).alias("flat_without_field"),
    )


# Reviewer replies: the whole text, then an object whose defects follow language and label.
REPLY_SQL = """text || ' ' || CASE
    WHEN quality IS NULL AND lang = 'en' THEN '{"reason": "no flag"}'
    WHEN quality IS NULL AND lang = 'fr' THEN '{''keep'': true}'
    WHEN quality IS NULL AND lang = 'de' THEN '{"keep": true} and {"b": 1}'
    WHEN quality IS NULL THEN '{"keep": "false", "reason": "text flag"}'
    WHEN toxic = 1 THEN '{"keep": true'
    WHEN quality = 1 THEN '{"keep": true, "reason": "' || source || '"}'
    ELSE '{"keep": false, "reason": "low"}' END || ' end'"""
REPLIES_SQL = f"""replies AS (SELECT doc_id, lang, source, {REPLY_SQL} AS reply
  FROM documents LEFT JOIN labels USING (doc_id)),
sliced AS (SELECT *, regexp_extract(reply, '(?s)(\\{{.*\\}})', 1) AS s FROM replies),
verdicts AS (SELECT *, s <> '' AND json_valid(s) AS ok,
  CASE WHEN s <> '' AND json_valid(s) THEN s END AS j FROM sliced)"""


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select("doc_id", F.expr(REPLY_SQL.replace("''", "\\'")).alias("reply"))
    )


_KEEP_SQL = "coalesce(ok AND json_extract(j, '$.keep')::VARCHAR = 'true', false)"


@query(
    "parse_verdict_json",
    f"""WITH {REPLIES_SQL} SELECT doc_id, {_KEEP_SQL} AS keep,
    CASE WHEN ok THEN coalesce(json_extract_string(j, '$.reason'), '')
         ELSE 'JSON parse failed' END AS reason, ok FROM verdicts""",
)
def verdict_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies(spark, sf_dir).select(
        "doc_id", F.inline(F.array(parse_verdict_json(F.col("reply"))))
    )


@query(
    "parse_verdict_truthy",
    f"""WITH {REPLIES_SQL} SELECT doc_id,
    coalesce(ok AND json_extract(j, '$.keep')::VARCHAR IN ('true', '"false"'), false) AS keep
    FROM verdicts""",
)
def verdict_truthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = parse_verdict_json(F.col("reply"), mode="truthy")
    return replies(spark, sf_dir).select("doc_id", verdict.keep.alias("keep"))


@query(
    "judge_gate",
    f"""WITH {REPLIES_SQL} SELECT p.doc_id, coalesce({_KEEP_SQL}, false) AS ok,
    CASE WHEN coalesce(ok, false) THEN coalesce(json_extract_string(j, '$.reason'), '')
         ELSE '審查模型錯誤' END AS gate_reason
    FROM documents p LEFT JOIN verdicts v ON p.doc_id = v.doc_id""",
)
def judge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    return cleaning.judge_gate(rows, replies(spark, sf_dir), "doc_id").select(
        "doc_id", "ok", "gate_reason"
    )


_PROMPT_SQL = (
    "replace(["
    + ", ".join(f"'{t}'" for t in SUBJECT_TEMPLATES)
    + f"][{sql_index(str(len(SUBJECT_TEMPLATES)), SEED, 'flat-prompt', 'doc_id')} + 1],"
    " '{subject}', '資訊工程' || lang)"
)
_FLAT_SQL = f"""{DOCS_SQL}, {REPLIES_SQL},
flat AS (SELECT d.*, {_KEEP_SQL} AS gate,
  CASE WHEN ok THEN coalesce(json_extract_string(j, '$.reason'), '')
       ELSE '審查模型錯誤' END AS gate_reason
  FROM docs d JOIN verdicts v USING (doc_id))"""


def _flat_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    flat = documents(spark, sf_dir).select(
        "doc_id", F.expr("lang || ' - ' || source").alias("topic"), F.col("exam").alias("full")
    )
    gated = cleaning.judge_gate(flat, replies(spark, sf_dir), "doc_id")
    return cleaning.split_flat(gated, list(SUBJECT_TEMPLATES), SEED, "doc_id")


@query(
    "split_flat_clean",
    f"WITH {_FLAT_SQL} SELECT doc_id, {_PROMPT_SQL} AS question, {sql_strip(_KEPT_LINES)}"
    ' AS "LLMans" FROM flat WHERE gate',
)
def split_flat_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_split(spark, sf_dir)[0]


@query(
    "split_flat_removed",
    f"WITH {_FLAT_SQL} SELECT doc_id, gate_reason AS reason, exam AS content FROM flat"
    " WHERE NOT gate",
)
def split_flat_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_split(spark, sf_dir)[1]


# First-review replies: failed calls, broken objects and empty rewrites follow the label.
REVIEW_SQL = """CASE
    WHEN quality IS NULL THEN source || ' {"decision": "accept", "reason": "fine", "final_question": ""}'
    WHEN toxic = 1 THEN source || ' {"decision": '
    WHEN quality = 1 THEN source || ' {"decision": "rewrite", "reason": "' || lang || '", "final_question": "Q' || doc_id || '"} end'
    END"""


@query(
    "resolve_review",
    f"""SELECT doc_id,
    CASE WHEN r IS NULL OR NOT ok THEN 'accept' ELSE json_extract_string(s, '$.decision') END AS decision,
    CASE WHEN r IS NULL THEN 'error' WHEN NOT ok THEN 'JSON parse error'
         ELSE json_extract_string(s, '$.reason') END AS reason,
    CASE WHEN r IS NULL OR NOT ok OR json_extract_string(s, '$.final_question') = '' THEN text
         ELSE json_extract_string(s, '$.final_question') END AS final_question
    FROM (SELECT *, s <> '' AND json_valid(s) AS ok FROM (
      SELECT *, regexp_extract(r, '(?s)(\\{{.*\\}})', 1) AS s FROM (
        SELECT doc_id, text, {REVIEW_SQL} AS r FROM documents LEFT JOIN labels USING (doc_id))))""",
)
def resolve_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select("doc_id", "text", F.expr(REVIEW_SQL).alias("r"))
    )
    outcome = cleaning.resolve_review(F.col("r"), F.col("text"), F.col("r").isNull())
    return docs.select("doc_id", F.inline(F.array(outcome)))


@query(
    "dedup_exact",
    """SELECT doc_id, lang, source, text FROM documents
    WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)""",
)
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.dedup_exact(table(spark, sf_dir, "documents"), "text", "doc_id").select(
        "doc_id", "lang", "source", "text"
    )
