"""Sinks, sources and streams: tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom import schemas
from examloom.functions.text import json_string
from examloom.operators import grid
from examloom.operators.cleaning import CLEAN, QUARANTINED, REMOVED, split_rows
from examloom.operators.records import assemble_record, review_log
from examloom.plans import tasks
from examloom.session import fresh_path
from examloom.sources import readers, writers
from examloom.streaming.board import progress, stream_best_of_n, stream_board
from examloom.streaming.clean import stream_clean
from workloads import chat, cleaning, judging, plan
from workloads.registry import ORACLES, query, table


def _dealt(rows: DataFrame, *folders: str) -> DataFrame:
    """The rows of folders of small files, in a fixed number of tasks: files cost time one
    by one and have few bytes, so adaptive execution would leave them to one task."""
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(n, *folders)


def _write_folders(rows: DataFrame, path: str, *folders: str, order: tuple[str, ...] = ()) -> None:
    """Text files, one for each value of ``folders``; each task puts its own in place."""
    dealt = _dealt(rows, *folders)
    if order:
        dealt = dealt.sortWithinPartitions(*folders, *order)
    own = dealt.select(*folders, "value").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    own.partitionBy(*folders).text(path)


def _memory_result(spark: SparkSession, streamed: DataFrame, label: str) -> DataFrame:
    """Run a stream of aggregates to its end; the result has one row per group."""
    path = fresh_path(spark, label)

    def keep_last(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    (
        streamed.writeStream.outputMode("complete")
        .foreachBatch(keep_last)
        .option("checkpointLocation", fresh_path(spark, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(path)


@query("jsonl_round_trip", "SELECT doc_id, source AS topic, text AS content FROM documents")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "jsonl")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("topic"), F.col("text").alias("content")
    )
    writers.write_jsonl(rows, path)
    schema = f"doc_id BIGINT, {schemas.GEN_RECORD}"
    return readers.read_jsonl(spark, path, schema).select("doc_id", "topic", "content")


def _damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines; those labelled toxic are cut short."""
    docs = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    line = F.to_json(F.struct("doc_id", "text"))
    cut = F.substring(line, F.lit(1), F.length(line) - 2)
    return docs.select(
        "doc_id", F.when(F.col("toxic") == 1, cut).otherwise(line).alias("value")
    )


@query(
    "valid_prefix",
    """SELECT doc_id, coalesce(max(toxic) OVER (PARTITION BY doc_id // 100 ORDER BY doc_id
      ROWS UNBOUNDED PRECEDING), 0) = 0 AS valid FROM documents LEFT JOIN labels USING (doc_id)""",
)
def valid_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side of every line, in one file for each hundred documents."""
    path = fresh_path(spark, "damaged")
    lines = _damaged_lines(spark, sf_dir).withColumn("shard", F.expr("doc_id div 100"))
    _write_folders(lines, path, "shard", order=("doc_id",))
    valid, quarantined = readers.valid_prefix(spark, path)
    number = F.regexp_extract("line", r'^\{"doc_id":(\d+)', 1).cast("bigint").alias("doc_id")
    return valid.select(number, F.lit(True).alias("valid")).unionByName(
        quarantined.select(number, F.lit(False).alias("valid"))
    )


@query("review_log_csv", ORACLES["review_log"])
def review_log_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "review-log")
    writers.write_csv_log(review_log(assemble_record(chat.stage_outputs(spark, sf_dir))), path)
    return writers.read_csv_log(
        spark, path, "Topic STRING, Keep BOOLEAN, Reason STRING, Question STRING"
    )


@query("rounds_round_trip", ORACLES["two_arm_wins"])
def rounds_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "rounds")
    writers.write_rounds(judging.two_arm_wins(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("responses_by_model", ORACLES["fill_blank_response"])
def responses_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by-model")
    writers.write_responses(judging.fill_blank_response(spark, sf_dir), path)
    return spark.read.parquet(path).select("task_id", "model", "text")


@query(
    "saved_templates",
    f"WITH {plan.MERGED_SQL} SELECT template_id::INTEGER AS template_id, template, origin FROM merged",
)
def saved_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "templates")
    writers.save_templates(plan.merge_templates(spark, sf_dir), path)
    return writers.read_saved_templates(spark, path)


@query(
    "plan_from_merged",
    f"""WITH {plan.MERGED_SQL} SELECT task_id, template_id::INTEGER AS template_id,
    replace(template, '{{topic}}', topic) AS prompt
    FROM (SELECT o_orderkey AS task_id, {plan.drawn_sql('part', 'topic_id')} AS topic_id,
      {plan.drawn_sql('merged', 'template_id')} AS drawn FROM orders)
    LEFT JOIN (SELECT p_partkey AS topic_id, p_type || ' - ' || p_name AS topic FROM part) USING (topic_id)
    LEFT JOIN merged ON template_id = drawn""",
)
def plan_from_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks over templates that were merged, saved and loaded: one row for each task."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task_id"))
    templates = saved_templates(spark, sf_dir)
    planned = tasks.plan_tasks(ids, plan.topics(spark, sf_dir), templates, plan.SEED)
    return planned.select("task_id", "template_id", "prompt")


_RECORD = f"doc_id BIGINT, {schemas.GEN_RECORD}"


def _streamed_split(spark: SparkSession, sf_dir: str) -> str:
    """Records as JSONL files, cleaned by the stream; returns its output folder."""
    incoming, out, state = (fresh_path(spark, label) for label in ("incoming", "sides", "state"))
    writers.write_jsonl(cleaning.records(spark, sf_dir), incoming)
    stream_clean(spark, incoming, out, state, _RECORD).awaitTermination()
    return out


@query("stream_clean", ORACLES["split_clean"])
def streamed_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = writers.read_side(spark, _streamed_split(spark, sf_dir), CLEAN)
    return rows.select(
        "question",
        F.col("LLMans.stem").alias("stem"),
        *[F.col(f"LLMans.options.{k}").alias(f"option_{k.lower()}") for k in "ABCD"],
    )


@query("stream_removed", ORACLES["split_removed"])
def streamed_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = writers.read_side(spark, _streamed_split(spark, sf_dir), REMOVED)
    whole = F.from_json("content", "doc_id BIGINT, topic STRING, question STRING")
    return rows.select("reason", whole.alias("r")).select("reason", "r.*")


# Lines of a dataset as other programs leave them: most are records, some are cut
# short, quoted otherwise, of another type, or two records in one line.
LINE_SQL = """CASE
    WHEN toxic = 1 THEN '{"question": "Q' || doc_id || '", "content": ' || j
    WHEN doc_id % 13 = 5 THEN '{''question'': "Q' || doc_id || '", "content": ' || j || '}'
    WHEN doc_id % 13 = 6 THEN '{"question": "Q' || doc_id || '", "keep": "yes", "content": ' || j || '}'
    WHEN doc_id % 13 = 7 THEN '{"question": "Q' || doc_id || '", "keep": true, "content": ' || j || '} {"question": "next"}'
    WHEN doc_id % 13 = 8 THEN '[' || j || ']'
    WHEN doc_id % 13 = 9 THEN ' {"content": ' || j || ', "keep": true, "question": "Q' || doc_id || '"} '
    ELSE '{"question": "Q' || doc_id || '", "keep": ' || CASE WHEN quality = 1 THEN 'true' ELSE 'false' END
      || ', "reason": "low", "content": ' || j || '}' END"""
LINE_SIDES_SQL = f"""WITH {cleaning.DOCS_SQL}, lines AS (SELECT *, {LINE_SQL} AS line
    FROM (SELECT *, to_json(exam)::VARCHAR AS j FROM docs LEFT JOIN labels USING (doc_id))),
  sided AS (SELECT *, CASE WHEN toxic = 1 OR doc_id % 13 IN (5, 6, 7, 8) THEN 'quarantined'
    WHEN doc_id % 13 = 9 OR quality = 1 THEN 'clean' ELSE 'removed' END AS side FROM lines)
  SELECT side, CASE WHEN side = 'clean' THEN 'Q' || doc_id END AS question,
    CASE WHEN toxic = 1 THEN 'line is no JSON object' WHEN doc_id % 13 = 6 THEN 'field of another type'
      WHEN side = 'quarantined' THEN 'line is no JSON object' WHEN side = 'removed' THEN 'low' END AS reason,
    CASE WHEN side <> 'clean' THEN line END AS content FROM sided"""


def _loose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = cleaning.documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return docs.withColumn("j", json_string(F.col("exam"))).select(
        F.expr(LINE_SQL.replace("''", "\\'")).alias("value")
    )


def _all_sides(spark: SparkSession, path: str) -> DataFrame:
    nothing = F.lit(None).cast("string")
    clean = writers.read_side(spark, path, CLEAN).select(
        F.lit(CLEAN).alias("side"), "question", nothing.alias("reason"), nothing.alias("content")
    )
    for side in (REMOVED, QUARANTINED):
        rows = writers.read_side(spark, path, side)
        clean = clean.unionByName(
            rows.select(F.lit(side).alias("side"), nothing.alias("question"), "reason", "content")
        )
    return clean


@query("split_damaged_lines", LINE_SIDES_SQL)
def split_damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSONL file with broken lines, cleaned in one pass: every line is on one side."""
    lines, out = fresh_path(spark, "loose"), fresh_path(spark, "sides")
    _loose_lines(spark, sf_dir).write.text(lines)
    writers.write_sides(split_rows(readers.read_jsonl_lines(spark, lines)), out)
    return _all_sides(spark, out)


@query("stream_damaged_lines", LINE_SIDES_SQL)
def stream_damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines cleaned by the stream in four batches, each of files of bounded size."""
    lines, out, state = (fresh_path(spark, label) for label in ("loose", "sides", "state"))
    share = table(spark, sf_dir, "documents").rdd.getNumPartitions()  # grows with the table
    _loose_lines(spark, sf_dir).repartition(4 * share).write.text(lines)
    stream_clean(spark, lines, out, state, max_files_per_trigger=share).awaitTermination()
    return _all_sides(spark, out)


@query(
    "stream_board",
    f"WITH {judging.JUDGED_PAIRS_SQL} SELECT model, wins, ties, matches FROM board",
)
def streamed_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "verdicts")
    verdicts = judging.pairwise_verdicts_only(spark, sf_dir)
    verdicts.write.parquet(path)
    stream = spark.readStream.schema(verdicts.schema).parquet(path)
    return _memory_result(spark, stream_board(stream), "board")


@query(
    "stream_best_of_n",
    f"WITH {judging.BEST_SQL} SELECT winner, count(*) AS wins FROM verdicts GROUP BY winner",
)
def streamed_best_of_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "winners")
    judging.best_of_n_verdicts(spark, sf_dir).select("winner").write.parquet(path)
    stream = spark.readStream.schema("winner STRING").parquet(path)
    return _memory_result(spark, stream_best_of_n(stream), "winners-board")


@query(
    "progress",
    """SELECT (SELECT count(*) FROM labels) AS done, (SELECT count(*) FROM documents) AS total""",
)
def progress_of_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "documents").count()
    return progress(table(spark, sf_dir, "labels"), total)


# Catalogues, run configurations and response files, as other programs write them.
@query(
    "topics_from_files",
    """SELECT (row_number() OVER (PARTITION BY p_partkey // 100 ORDER BY p_partkey) - 1)::INTEGER AS topic_id, topic,
    CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_type END AS field, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name || ' - x' END AS detail
    FROM (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_type || ' -  ' || p_name || ' - x' END AS topic FROM part)""",
)
def topics_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of catalogue files, each a JSON list of up to a hundred."""
    topic = F.expr("CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_type || ' -  ' || p_name || ' - x' END")
    path = _json_lists(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), topic.alias("v")), 100)
    return readers.topics(spark, path)


@query(
    "templates_from_files",
    """SELECT (row_number() OVER (PARTITION BY s_suppkey // 50 ORDER BY s_suppkey) - 1)::INTEGER AS template_id,
    s_name || ' asks 「{topic}」' AS template, 'file' AS origin FROM supplier""",
)
def templates_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"), F.concat("s_name", F.lit(" asks 「{topic}」")).alias("v")
    )
    return readers.load_templates(spark, _json_lists(rows, 50), fallback=None)


def _json_lists(rows: DataFrame, size: int) -> str:
    """Files with one JSON list each, of the values whose keys share a range of ``size``."""
    path = fresh_path(rows.sparkSession, "lists")
    own = F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda s: s["v"])
    keyed = rows.withColumn("list", F.expr(f"k div {size}"))
    # dealt before the grouping, whose own shuffle would count as this one and be coalesced
    lists = _dealt(keyed, "list").groupBy("list").agg(F.to_json(own).alias("value"))
    _write_folders(lists, path, "list")
    return f"{path}/*"


@query(
    "run_configs",
    """SELECT 'run=' || s_suppkey AS run_id, CASE WHEN s_suppkey % 4 = 1 THEN 'own folder' ELSE 'base/' || s_name END AS base_model,
    CASE WHEN s_suppkey % 5 <> 2 THEN s_nationkey END::INTEGER AS r, s_name || ',q_proj' AS target_modules FROM supplier""",
)
def run_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "adapters")
    config = F.struct(
        F.expr("CASE WHEN s_suppkey % 4 <> 1 THEN 'base/' || s_name END").alias("base_model_name_or_path"),
        F.expr("CASE WHEN s_suppkey % 5 <> 2 THEN s_nationkey END").alias("r"),
        F.array("s_name", F.lit("q_proj")).alias("target_modules"),
        F.struct(F.lit(1).alias("unknown")).alias("extra"),
    )
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("run"), F.to_json(config).alias("value"))
    _write_folders(rows, path, "run")
    found = readers.read_run_configs(spark, f"{path}/*")
    base = F.when(F.col("base_model") == F.col("path"), "own folder").otherwise(F.col("base_model"))
    return found.select("run_id", base.alias("base_model"), "r", F.array_join("target_modules", ",").alias("target_modules"))


@query("valid_count", """SELECT count(*) AS n_valid FROM (SELECT coalesce(max(toxic) OVER (PARTITION BY doc_id // 100
    ORDER BY doc_id ROWS UNBOUNDED PRECEDING), 0) = 0 AS valid FROM documents LEFT JOIN labels USING (doc_id)) WHERE valid""")
def valid_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "damaged")
    lines = _damaged_lines(spark, sf_dir).withColumn("shard", F.expr("doc_id div 100"))
    _write_folders(lines, path, "shard", order=("doc_id",))
    return readers.valid_count(readers.valid_prefix(spark, path)[0])


RESPONSE_FOLDER = r"round=?(\d+)[/_]model[=_]([^/]*?)(?:\.txt|/[^/]+)$"


@query(
    "response_files",
    f"""WITH {judging.RAW_SQL} SELECT task_id, model, CASE WHEN task_id = 0 AND model IN ('src1', 'src2') THEN ''
    WHEN NOT present THEN 'No Output' ELSE text || chr(10) END AS text,
    present OR (task_id = 0 AND model IN ('src1', 'src2')) AS present FROM raw""",
)
def response_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file for each response of a run, two of the first round empty, others absent, against the plan."""
    path = fresh_path(spark, "responses")
    given = judging.responses(spark, sf_dir).where("not (task_id = 0 and model in ('src1', 'src2'))")
    named = given.select(F.col("task_id").alias("round"), "model", F.col("text").alias("value"))
    _write_folders(named, path, "round", "model")
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for model in ("src1", "src2"):
        files.createNewFile(hadoop.Path(folder, f"round0_model_{model}.txt"))
    found = readers.read_response_files(
        spark, f"{path}/{{round=*/model=*/*,*.txt}}", RESPONSE_FOLDER
    )
    full = grid.response_grid(judging.tasks(spark, sf_dir), judging.MODELS, found)
    return readers.with_missing_files(full).select("task_id", "model", "text", "present")
