"""Round logs over the judging workloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.functions.verdicts import parse_multi_scores
from examloom.operators import blinding, boards, logs
from workloads import judging as j
from workloads.registry import query, table


def _rounds(spark: SparkSession, sf_dir: str, reply: str) -> DataFrame:
    rounds = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("task_id"),
        F.col("source").alias("topic"),
        F.col("text").alias("text_x"),
        F.col("lang").alias("text_y"),
        F.expr(reply).alias("judge_raw"),
    )
    return blinding.blind_ab(rounds, j.SEED, ["task_id"])


_SIDES = """d.source AS topic, CASE WHEN a_is_x THEN d.text ELSE d.lang END AS "question_A",
    CASE WHEN a_is_x THEN d.lang ELSE d.text END AS "question_B\""""
_LOG = "replace(judge_raw, chr(10), '\\n')"


@query(
    "geval_log",
    f"""WITH {j.SCORED_SQL} SELECT task_id AS round, a_is_x AS "A_is_tuned", {_SIDES},
    score_a AS "score_A", score_b AS "score_B", score_x AS score_tuned, score_y AS score_teacher,
    {_LOG} AS judge_raw FROM scored JOIN documents d ON d.doc_id = task_id""",
)
def geval_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = boards.two_arm_scores(_rounds(spark, sf_dir, j.SCORES_SQL))
    return logs.geval_log(rounds, "tuned", "teacher")


@query(
    "choice_log",
    f"""WITH {j.CHOSEN_SQL} SELECT task_id AS round, a_is_x AS "A_is_after", {_SIDES},
    {_LOG} AS first_judge, choice AS first_choice, NULL::INTEGER AS "score_A", NULL::INTEGER AS "score_B",
    score_x AS score_after, score_y AS score_before FROM chosen JOIN documents d ON d.doc_id = task_id""",
)
def choice_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = boards.two_arm_wins(_rounds(spark, sf_dir, j.CHOICE_SQL))
    return logs.choice_log(rounds, "after", "before", "first", side_scores=True)


@query(
    "pairwise_log",
    f"""WITH {j.JUDGED_PAIRS_SQL} SELECT task_id, topic, model_A AS "model_A", model_B AS "model_B", winner,
    substr(replace(judge_raw, chr(10), ' '), 1, 200) || '...' AS reason, judge_raw FROM judged""",
)
def pairwise_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.pairwise_log(j.judged_pairs(spark, sf_dir), 200)


_RESP = ", ".join(f"max(CASE WHEN model = '{m}' THEN text END) AS resp_{m}" for m in j.MODELS)
_TASK_REPLY = "'Judge of ' || topic || chr(10) || 'Winner: Model ' || (task_id % 23)"


@query(
    "best_of_n_log",
    f"""WITH {j.CELLS_SQL}, {j.shuffled_sql('cells')},
    wide AS (SELECT task_id, topic, {_RESP} FROM cells GROUP BY task_id, topic),
    mapped AS (SELECT task_id, string_agg('Model ' || label || ': ' || model, ' | ' ORDER BY label) AS model_mapping
      FROM labels_of GROUP BY task_id)
    SELECT w.*, 'about ' || topic AS prompt, coalesce(l.model, 'Unknown') AS winner_model,
      {_TASK_REPLY.replace('task_id', 'w.task_id')} AS judge_reason, model_mapping
    FROM wide w JOIN mapped m ON m.task_id = w.task_id
    LEFT JOIN labels_of l ON l.task_id = w.task_id AND l.label = w.task_id % 23""",
)
def best_of_n_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = (
        j.tasks(spark, sf_dir)
        .withColumn("prompt", F.concat(F.lit("about "), "topic"))
        .withColumn("judge_raw", F.expr(_TASK_REPLY))
    )
    verdicts = boards.best_of_n_verdicts(judged, j.MODELS, j.SEED)
    return logs.best_of_n_log(verdicts, j.cells(spark, sf_dir), j.MODELS, j.SEED)


@query(
    "ratings_log",
    f"""WITH {j.MULTI_SQL}, wide AS (SELECT task_id, {j._PIVOT} FROM scores GROUP BY task_id)
    SELECT task_id::VARCHAR AS round, source AS topic, lang AS prompt, {j._CAST}, judge_raw AS judge_raw_response
    FROM wide JOIN docs USING (task_id) JOIN documents ON doc_id = task_id
    UNION ALL SELECT 'TOTAL', 'SUM', '', {j._SUMS}, '' FROM wide""",
)
def ratings_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("task_id"),
        F.col("source").alias("topic"),
        F.col("lang").alias("prompt"),
        F.expr(j.RATINGS_SQL).alias("judge_raw"),
    )
    parsed = judged.select("task_id", parse_multi_scores(F.col("judge_raw"), j.N).alias("scores"))
    scores = blinding.unblind_scores(parsed, j.MODELS, j.SEED)
    return logs.ratings_log(judged, scores, j.MODELS)
