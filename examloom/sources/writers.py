"""Sinks: JSONL, review and round logs, templates, responses, split datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom import schemas
from examloom.operators.cleaning import CLEAN

CSV_OPTIONS = {"header": "true", "quoteAll": "true", "escape": '"', "emptyValue": ""}
# A text no cell holds, so that an empty cell is read as empty text.
NO_NULL = "\x00"


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", null_keys: bool = False) -> None:
    """One JSON object per line, non-ASCII literal; ``null_keys`` writes null fields too."""
    df.write.mode(mode).option("ignoreNullFields", str(not null_keys).lower()).json(path)


def write_csv_log(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A log with header and every cell quoted, so that cells may hold line breaks."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log written by ``write_csv_log``; empty text cells stay empty text."""
    options = {**CSV_OPTIONS, "multiLine": "true", "nullValue": NO_NULL}
    return spark.read.schema(schema).options(**options).csv(path)


def write_rounds(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Evaluation rounds, appended; Parquet unless CSV is asked for."""
    if fmt == "csv":
        write_csv_log(df, path, mode)
    else:
        df.write.mode(mode).format(fmt).save(path)


def write_split(
    clean: DataFrame, removed: DataFrame, clean_path: str, removed_path: str, mode: str = "errorifexists"
) -> None:
    """Kept rows to the clean dataset, dropped rows with their reason to the removed log."""
    write_jsonl(clean, clean_path, mode)
    write_jsonl(removed, removed_path, mode)


def write_sides(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows of ``split_rows`` as JSONL, one folder a side, all by one scan and one write."""
    rows.write.mode(mode).partitionBy("side").json(path)


def read_side(spark: SparkSession, path: str, side: str) -> DataFrame:
    """The rows of one side that ``write_sides`` or the cleaning stream wrote."""
    clean = side == CLEAN
    schema = schemas.CLEAN_RECORD if clean else schemas.REMOVED_RECORD
    columns = ("question", "LLMans") if clean else ("reason", "content")
    found = spark.read.schema(f"{schema}, side STRING").json(path)
    return found.where(F.col("side") == side).select(*columns)


def save_templates(templates: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One template per line with its place, so that any number can be written at once."""
    templates.select("template_id", "template", "origin").write.mode(mode).json(path)


def read_saved_templates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("template_id INT, template STRING, origin STRING").json(path)


def write_responses(responses: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Responses as Parquet with one folder per model."""
    responses.write.mode(mode).partitionBy("model").parquet(path)
