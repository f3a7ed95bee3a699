"""Reproducible task plans: topic and template draws, top-up, resume, template merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from examloom.functions.prompts import TOPIC_SLOT, render
from examloom.functions.text import keyed_index
from examloom.session import written


def draw(
    df: DataFrame, dim: DataFrame, dim_id: str, seed: int, key: str
) -> DataFrame:
    """Join one uniformly drawn row of ``dim`` to every row, with replacement.

    ``dim_id`` numbers the rows of ``dim`` 0 .. n-1 without gaps or repeats; any
    other catalogue is refused, as it would lose or double tasks. The join is an
    equi-join on the drawn number: broadcast while the catalogue is small by
    measured size, sorted beyond that, and even by construction.
    """
    n, least, most, distinct = dim.agg(
        F.count("*"), F.min(dim_id), F.max(dim_id), F.count_distinct(dim_id)
    ).first()
    if n and (least, most, distinct) != (0, n - 1, n):
        raise ValueError(f"{dim_id} must number the {n} rows 0 .. {n - 1}, each once")
    return df.withColumn(dim_id, keyed_index(n, seed, dim_id, F.col(key))).join(
        dim.withColumn(dim_id, F.col(dim_id).cast("bigint")), dim_id
    )


def task_ids(spark: SparkSession, n: int, first: int = 1) -> DataFrame:
    """``n`` consecutive task ids."""
    return spark.range(first, first + max(n, 0)).withColumnRenamed("id", "task_id")


def plan_tasks(
    ids: DataFrame, topics: DataFrame, templates: DataFrame, seed: int
) -> DataFrame:
    """Tasks with topic and rendered prompt, fixed before any model answers."""
    with_topic = draw(ids, topics.select("topic_id", "topic"), "topic_id", seed, "task_id")
    both = draw(
        with_topic, templates.select("template_id", "template"), "template_id", seed, "task_id"
    )
    return both.select(
        "task_id",
        "topic",
        F.col("template_id").cast("int").alias("template_id"),
        render(F.col("template"), F.col("topic"), TOPIC_SLOT).alias("prompt"),
    )


def remaining(total: int, clean: DataFrame | None, raw: DataFrame | None) -> tuple[int, int]:
    """(existing, missing) rows; a non-empty clean dataset is counted before the raw one."""
    existing = clean.count() if clean is not None else 0
    if existing == 0 and raw is not None:
        existing = raw.count()
    return existing, max(total - existing, 0)


def plan_top_up(
    spark: SparkSession,
    total: int,
    clean: DataFrame | None,
    raw: DataFrame | None,
    topics: DataFrame,
    templates: DataFrame,
    seed: int,
) -> DataFrame:
    """Tasks for the rows still missing; empty once ``total`` is reached.

    Their ids follow the greatest task id of either dataset, so they repeat
    neither a stored row nor one that was dropped since.
    """
    _, missing = remaining(total, clean, raw)
    used = [df.agg(F.max("task_id")).first()[0] for df in (clean, raw) if df is not None]
    first = max((u for u in used if u is not None), default=0) + 1
    return plan_tasks(task_ids(spark, missing, first), topics, templates, seed)


def pending(tasks: DataFrame, done: DataFrame, key: str = "task_id") -> DataFrame:
    """Tasks without a finished row: exact and repeatable."""
    return tasks.join(done.select(key), key, "left_anti")


def merge_templates(
    seeds: DataFrame,
    candidates: DataFrame,
    target_total: int,
    slot: str = TOPIC_SLOT,
) -> DataFrame:
    """Seeds followed by new valid candidates, up to ``target_total`` templates.

    Both inputs have ``ordinal`` and ``template``. Seeds are taken as they are;
    a candidate must hold the slot and be neither a seed nor an earlier
    candidate. The result is numbered 0 .. n-1 by ``template_id``. Candidates are
    grouped and met by digest, and ranked by a distributed sort.
    """
    digest = F.sha2("template", 256).alias("digest")
    fresh = (
        candidates.where(F.col("template").contains(slot))
        .groupBy(digest)
        .agg(F.min(F.struct("ordinal", "template")).alias("first"))
        .join(seeds.select(digest).distinct(), "digest", "left_anti")
        .select(F.lit(1).alias("rank"), "first.*")
    )
    base = seeds.select(F.lit(0).alias("rank"), "ordinal", "template")
    merged = numbered(base.unionByName(fresh), ["rank", "ordinal", "template"], "template_id")
    origin = F.when(F.col("rank") == 0, "seed").otherwise("augmented").alias("origin")
    wanted = (F.col("rank") == 0) | (F.col("template_id") < target_total)
    return merged.where(wanted).select(origin, "template_id", "template")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the place 0 .. n-1 of each row in ``order``.

    Rows are sorted by ranges and written with their place inside the range;
    what meets in one task is one count per range.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = sorted_rows.withColumns(
        {"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}
    )
    placed = written(placed.withColumn("_row", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    starts = sizes.select("_range", before.alias("_before"))
    return placed.join(starts, "_range").withColumn(name, F.col("_before") + F.col("_row")).drop(
        "_range", "_row", "_before"
    )


def accepted_count(merged: DataFrame) -> DataFrame:
    """Seeds, new templates and their total after a merge."""
    return merged.agg(
        F.count_if(F.col("origin") == "seed").alias("seeds"),
        F.count_if(F.col("origin") == "augmented").alias("augmented"),
        F.count("*").alias("total"),
    )
