"""JSONL datasets, catalogues, response files, training logs and run configurations."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from examloom import schemas
from examloom.functions.text import checked_object, is_blank, is_json, model_name, strip
from examloom.operators.grid import NO_OUTPUT
from examloom.session import written

# The built-in catalogues used when no file is given.
SMALL_TOPICS = (
    "資料結構 - 陣列(Array)",
    "資料結構 - 連結串列(Linked List)",
    "資料結構 - 堆疊(Stack)",
    "資料結構 - 佇列(Queue)",
    "資料結構 - Heap",
    "資料結構 - 二元搜尋樹(BST)",
    "演算法 - Sorting",
    "演算法 - Searching",
    "演算法 - Dynamic Programming",
    "演算法 - Greedy",
    "作業系統 - 排程(Scheduling)",
    "作業系統 - 死結(Deadlock)",
    "計算機網路 - TCP",
    "計算機網路 - Routing",
    "資料庫 - Transaction",
    "資料庫 - Index",
)
BASE_TEMPLATES = (
    "請幫我出一題有關 {topic} 的單選題(四個選項)",
    "你是一位大學的資工老師，幫我針對 {topic} 出一個考試用的單選題（四選一）",
    "我想要一題關於 {topic} 的單選題(四個選項)。",
    "以考古題風格出一題關於 {topic} 的單選題。",
    "請幫我設計一道有關 {topic} 的單選題（四個選項）。",
    "幫我生成一題選擇題，主題是 {topic}。",
)
SUBJECT_TEMPLATES = (
    "請幫我出{subject}的單選題",
    "我希望你根據{subject}，請給我一題四選一題目",
    "請生成與{subject}相關的題目",
    "可以出{subject}相關的考題嗎？四選一即可",
    "請給我一題{subject}領域的選擇題（四選一）",
)
# Why a line is no record.
NO_OBJECT = "line is no JSON object"
OTHER_TYPE = "field of another type"
RESPONSE_FILE = r"round(\d+)_model_(.*)\.txt$"
ADAPTER_CONFIG = "adapter_config.json"
CHECKPOINT_FOLDER = r"/checkpoint[-=](\d+)$"


def read_jsonl(spark: SparkSession, path: str, schema: str = schemas.GEN_RECORD) -> DataFrame:
    """One JSON object per line with an explicit schema; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def checked_lines(lines: DataFrame, schema: str = schemas.GEN_RECORD) -> DataFrame:
    """Records of JSON ``lines(value)`` with ``_line``, the line, and ``_problem``.

    ``_problem`` is null for a line that is one strict JSON object whose fields have
    the types of ``schema``; else it says why not, and the fields that could not be
    read are null. Blank lines are skipped. Narrow, for batches and streams alike.
    """
    some = lines.where(~is_blank(F.col("value")))
    found = some.select("value", checked_object(F.col("value"), schema).alias("_r"))
    problem = F.when(~F.col("_r.whole"), F.lit(NO_OBJECT)).when(~F.col("_r.fits"), F.lit(OTHER_TYPE))
    return found.select("_r.value.*", F.col("value").alias("_line"), problem.alias("_problem"))


def read_jsonl_lines(spark: SparkSession, path: str, schema: str = schemas.GEN_RECORD) -> DataFrame:
    """``read_jsonl`` that keeps every line: adds ``_line`` and ``_problem``."""
    return checked_lines(spark.read.text(path), schema)


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and a number that rises with the position in the file."""
    return (
        spark.read.text(path)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("place"),
        )
    )


def valid_prefix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) lines of JSONL files; a missing path gives no lines.

    Per file, lines before the first corrupt one are valid, that line and all
    after it are quarantined; blank lines are skipped. Lines are numbered and
    checked once and written; both results come from that table, so they do not
    depend on how later jobs split the files. The join with the first corrupt
    places, one row per damaged file, moves lines only if there are very many.
    The input files are not changed.
    """
    try:
        found = _text_lines(spark, path)
    except AnalysisException:
        empty = spark.createDataFrame([], "file STRING, line STRING")
        return empty, empty
    numbered = found.where(~is_blank(F.col("line"))).withColumn("line", strip(F.col("line")))
    checked = written(numbered.withColumn("ok", is_json(F.col("line"))), "lines")
    first_bad = checked.where(~F.col("ok")).groupBy("file").agg(F.min("place").alias("_bad"))
    placed = checked.join(first_bad, "file", "left")
    before = F.col("_bad").isNull() | (F.col("place") < F.col("_bad"))
    return (
        placed.where(before).select("file", "line"),
        placed.where(~before).select("file", "line"),
    )


def valid_count(valid: DataFrame) -> DataFrame:
    """Number of valid lines."""
    return valid.agg(F.count("*").alias("n_valid"))


def _json_strings(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, value) of a file that holds one JSON array of strings."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.from_json("value", "array<string>").alias("items"))
        .select(F.posexplode("items").alias("ordinal", "value"))
    )


def builtin(spark: SparkSession, values: tuple[str, ...], column: str) -> DataFrame:
    """A built-in list as ``<column>_id`` and ``<column>``."""
    return spark.createDataFrame(list(enumerate(values)), f"{column}_id INT, {column} STRING")


def load_templates(
    spark: SparkSession, path: str, fallback: tuple[str, ...] | None = BASE_TEMPLATES
) -> DataFrame:
    """Templates of a JSON array file (template_id, template, origin).

    A file that is absent, unreadable, no list or empty gives ``fallback``;
    with ``fallback=None`` it is an error.
    """
    try:
        loaded = _json_strings(spark, path)
        usable = not loaded.isEmpty()
    except AnalysisException:
        usable = False
    if usable:
        return loaded.select(
            F.col("ordinal").alias("template_id"),
            F.col("value").alias("template"),
            F.lit("file").alias("origin"),
        )
    if fallback is None:
        raise ValueError(f"no prompt templates in {path}")
    return builtin(spark, fallback, "template").withColumn("origin", F.lit("builtin"))


def topics(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Topic catalogue (topic_id, topic, field, detail) of a JSON array file.

    Without a path the small built-in catalogue is used. A topic without
    separator is all field.
    """
    if path is None:
        base = builtin(spark, SMALL_TOPICS, "topic")
    else:
        base = _json_strings(spark, path).select(
            F.col("ordinal").alias("topic_id"), F.col("value").alias("topic")
        )
    at = F.instr("topic", " - ")
    return base.withColumn(
        "field", strip(F.when(at > 0, F.substring("topic", F.lit(1), at - 1)).otherwise(F.col("topic")))
    ).withColumn(
        "detail",
        F.when(at > 0, strip(F.substring(F.col("topic"), at + 3, F.length("topic")))).otherwise(
            F.lit("")
        ),
    )


def _plain_path(encoded: Column) -> Column:
    """A path as users write it: Spark reports file metadata percent-encoded."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def read_response_files(spark: SparkSession, path: str, pattern: str = RESPONSE_FILE) -> DataFrame:
    """Responses (task_id, model, text) from files named by round and model.

    ``pattern`` finds the round and the model in the path of a file. Spark's scans
    leave out files without content, but its listing holds them: they are responses
    with an empty text. The listing is the one Spark makes on the driver for any scan.
    """
    whole = spark.read.text(path, wholetext=True)

    def named(name: Column, text: Column) -> list[Column]:
        found = [F.regexp_extract(name, pattern, k) for k in (1, 2)]
        return [found[0].cast("bigint").alias("task_id"), found[1].alias("model"), text.alias("text")]

    # input_file_name() spells a path as the listing does, the metadata column does not.
    read = whole.select(_plain_path(F.input_file_name()).alias("name"), F.col("value").alias("text"))
    read = read.where(F.col("name").rlike(pattern))
    listed = spark.createDataFrame([(f,) for f in whole.inputFiles()], "file STRING")
    listed = listed.select(_plain_path(F.col("file")).alias("name")).where(F.col("name").rlike(pattern))
    empty = listed.join(read.select("name"), "name", "left_anti")
    return read.select(*named(F.col("name"), F.col("text"))).unionByName(
        empty.select(*named(F.col("name"), F.lit("")))
    )


def with_missing_files(grid: DataFrame) -> DataFrame:
    """A grid's absent response files read as ``No Output``; empty ones stay empty."""
    return grid.withColumn(
        "text", F.when(F.col("present"), F.col("text")).otherwise(F.lit(NO_OUTPUT))
    )


def train_states(spark: SparkSession, path: str) -> DataFrame:
    """All log entries of trainer-state documents, with their run and checkpoint.

    ``run_id`` is the folder of the run, ``checkpoint`` the number of the checkpoint
    folder inside it, null for a state that lies in the run's folder itself. Runs whose
    checkpoints have equal names stay apart.
    """
    folder = F.regexp_replace(_plain_path(F.col("_metadata.file_path")), "/[^/]+$", "")
    return (
        spark.read.schema(schemas.TRAINER_STATE)
        .option("multiLine", True)
        .json(path)
        .select(
            F.regexp_replace(folder, CHECKPOINT_FOLDER, "").alias("run_id"),
            F.regexp_extract(folder, CHECKPOINT_FOLDER, 1).try_cast("bigint").alias("checkpoint"),
            F.inline("log_history"),
        )
    )


def read_train_log(spark: SparkSession, path: str) -> DataFrame:
    """Training log entries, each once: checkpoints of a run repeat what came before them.

    Of the entries of a step those of the greatest checkpoint count; a state in the
    run's folder itself is the last of all. Entries are compared per run and step, so
    no run is gathered.
    """
    rank = F.coalesce("checkpoint", F.lit(2**62))
    step = Window.partitionBy("run_id", "step")
    newest = train_states(spark, path).withColumn("_rank", rank).withColumn("_top", F.max("_rank").over(step))
    return newest.where("_rank = _top").drop("checkpoint", "_rank", "_top")


def read_run_configs(spark: SparkSession, path: str) -> DataFrame:
    """Run configurations with the base model, the run's own folder if none is named."""
    file_path = _plain_path(F.col("_metadata.file_path"))
    folder = F.regexp_replace(file_path, "/[^/]+$", "")
    return (
        spark.read.schema(schemas.RUN_CONFIG)
        .option("multiLine", True)
        .json(path)
        .select(
            model_name(folder).alias("run_id"),
            folder.alias("path"),
            F.coalesce("base_model_name_or_path", folder).alias("base_model"),
            "peft_type",
            "r",
            "lora_alpha",
            "lora_dropout",
            "target_modules",
            "task_type",
        )
    )
