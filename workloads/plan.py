"""Task planning over orders, parts and nations; template merging over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.functions.prompts import parse_candidates
from examloom.plans import tasks
from workloads.registry import query, sql_index, sql_lines, sql_strip, table

SEED = 11


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("topic_id"), F.expr("p_type || ' - ' || p_name").alias("topic")
    )


def _templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("template_id"),
        F.expr("n_name || ' asks about {topic}, only {topic}'").alias("template"),
    )


def drawn_sql(catalogue: str, key: str) -> str:
    return sql_index(f"SELECT count(*) FROM {catalogue}", SEED, key, "task_id")


def _plan_sql(ids: str) -> str:
    topic, template = drawn_sql("part", "topic_id"), drawn_sql("nation", "template_id")
    return f"""SELECT task_id, topic, template_id, replace(template, '{{topic}}', topic) AS prompt
    FROM (SELECT task_id, {topic} AS topic_id, {template} AS drawn FROM ({ids}))
    LEFT JOIN (SELECT p_partkey AS topic_id, p_type || ' - ' || p_name AS topic FROM part) USING (topic_id)
    LEFT JOIN (SELECT n_nationkey AS template_id, n_name || ' asks about {{topic}}, only {{topic}}' AS template
          FROM nation) ON template_id = drawn"""


@query("plan_tasks", _plan_sql("SELECT o_orderkey AS task_id FROM orders"))
def plan_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task_id"))
    return tasks.plan_tasks(ids, topics(spark, sf_dir), _templates(spark, sf_dir), SEED)


@query(
    "plan_top_up",
    _plan_sql(
        "SELECT (SELECT max(doc_id) FROM documents) + unnest(range(1, (SELECT count(*) FROM orders)"
        " - (SELECT count(*) FROM labels) + 1)) AS task_id"
    ),
)
def plan_top_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.plan_top_up(
        spark,
        table(spark, sf_dir, "orders").count(),
        table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "task_id"),
        table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "task_id"),
        topics(spark, sf_dir),
        _templates(spark, sf_dir),
        SEED,
    )


@query(
    "pending_tasks",
    "SELECT doc_id AS task_id, source AS model FROM documents"
    " WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def pending_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("task_id"), F.col("source").alias("model")
    )
    done = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "task_id")
    return tasks.pending(todo, done)


CANDIDATE_SQL = "CASE lang WHEN 'de' THEN text ELSE text || ' {topic}' END"


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("ordinal"), F.expr("text || ' {topic}'").alias("template")
    )
    candidates = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ordinal"), F.expr(CANDIDATE_SQL).alias("template")
    )
    # the target grows with the input: half as many templates as there are candidates
    target = table(spark, sf_dir, "documents").count() // 2
    return tasks.merge_templates(seeds, candidates, target)


MERGED_SQL = f"""seeds AS (SELECT item_id AS ordinal, text || ' {{topic}}' AS template FROM benchmark),
candidates AS (SELECT min(doc_id) AS ordinal, {CANDIDATE_SQL} AS template FROM documents
  GROUP BY 2),
fresh AS (SELECT * FROM candidates WHERE contains(template, '{{topic}}')
  AND template NOT IN (SELECT template FROM seeds) ORDER BY ordinal
  LIMIT (SELECT greatest((SELECT count(*) // 2 FROM documents) - count(*), 0) FROM seeds)),
merged AS (SELECT origin, row_number() OVER (ORDER BY origin DESC, ordinal) - 1 AS template_id, template
  FROM (SELECT 'seed' AS origin, * FROM seeds UNION ALL SELECT 'augmented', * FROM fresh))"""


@query("merge_templates", f"WITH {MERGED_SQL} SELECT * FROM merged")
def merge_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)


@query(
    "accepted_templates",
    f"""WITH {MERGED_SQL} SELECT count(*) FILTER (WHERE origin = 'seed') AS seeds,
    count(*) FILTER (WHERE origin = 'augmented') AS augmented, count(*) AS total FROM merged""",
)
def accepted_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.accepted_count(_merged(spark, sf_dir))


# Candidate replies: bulleted text, a JSON array with a blank and a number, or another JSON value.
CANDIDATES_SQL = """CASE lang
    WHEN 'de' THEN '["' || source || ' {topic}", "  ", 5, " ' || lang || ' "]'
    WHEN 'es' THEN '{"templates": "' || source || '"}'
    WHEN 'fr' THEN '- "' || replace(text, chr(10), chr(10) || '* ') || '"'
    ELSE text END"""
_BARE = (
    f"list_transform({sql_lines('reply')}, lambda s:"
    f" trim(ltrim(ltrim({sql_strip('s')}, '- '), '* '), '\"''' ))"
)


@query(
    "parse_candidates",
    f"""WITH replies AS (SELECT doc_id, lang, source, {CANDIDATES_SQL} AS reply FROM documents),
    parsed AS (SELECT doc_id, CASE lang WHEN 'de' THEN [source || ' {{topic}}', lang]
      WHEN 'es' THEN []::VARCHAR[]
      ELSE list_filter({_BARE}, lambda s: length(s) > 5) END AS c FROM replies)
    SELECT doc_id, i::INTEGER AS place, c[i + 1] AS template
    FROM (SELECT *, unnest(range(len(c))) AS i FROM parsed)""",
)
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(CANDIDATES_SQL).alias("reply")
    )
    return replies.select(
        "doc_id", F.posexplode(parse_candidates(F.col("reply"))).alias("place", "template")
    )
