"""Task-by-model response grids, pairs and two-arm joins.

``models`` is always the ordered list of compared model names. It is a
parameter, not data, so everything built from it has a size known up front.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.functions.text import is_blank

# Markers of empty, failed and missing responses.
EMPTY_RESPONSE = "[EMPTY_RESPONSE]"
EMPTY_RESPONSE_SERIAL = "[EMPTY RESPONSE]"
ERROR = "[ERROR]"
ERROR_GENERATING = "[ERROR_GENERATING]"
NO_OUTPUT = "No Output"
# Why a response is in no cell.
UNLISTED_MODEL = "model is not compared"
UNPLANNED_TASK = "task is not planned"
SUPERSEDED = "a later response counts"

PAIR_LIST = "ARRAY<STRUCT<pair_id: INT, model_1: STRING, model_2: STRING, i: INT, j: INT>>"


def check_models(models: list[str]) -> list[str]:
    """The model list, refused when empty or with a name that stands for two models."""
    if not models or len(set(models)) != len(models):
        raise ValueError("model names must be given and unique")
    return list(models)


def models_table(spark: SparkSession, models: list[str]) -> DataFrame:
    """``model`` and its list position ``pos``."""
    rows = list(enumerate(check_models(models)))
    return spark.createDataFrame(rows, "pos INT, model STRING")


def model_array(models: list[str]) -> Column:
    return F.array(*[F.lit(m) for m in check_models(models)])


def response_cells(
    tasks: DataFrame, models: list[str], responses: DataFrame, order: str | None = None
) -> DataFrame:
    """One row per task with ``cells``: for each model, in list order, what it answered.

    A cell is STRUCT<model, text, further columns of the responses, present>; text is
    null where there is no response. Of several responses of a model to a task the
    last in ``order`` counts, then the one of greatest text. One aggregate with one slot
    per model reduces the responses, whatever the group size; texts are shuffled once,
    by task, and pairs, labels and prompts are then made inside the row.
    """
    extra = [c for c in responses.columns if c not in ("task_id", "model", "text")]
    first = [F.col(order).alias("_order")] if order else []
    response = F.struct(*first, "text", *extra)
    slots = [F.max(F.when(F.col("model") == m, response)) for m in check_models(models)]
    wide = responses.groupBy("task_id").agg(F.array(*slots).alias("_slots"))

    def cell(model: Column, i: Column) -> Column:
        given = F.get("_slots", i)
        fields = [given[c].alias(c) for c in ("text", *extra)]
        return F.struct(model.alias("model"), *fields, given.isNotNull().alias("present"))

    met = tasks.join(wide, "task_id", "left")
    return met.select(*tasks.columns, F.transform(model_array(models), cell).alias("cells"))


def response_grid(
    tasks: DataFrame, models: list[str], responses: DataFrame, order: str | None = None
) -> DataFrame:
    """The cells of ``response_cells``, one row for each task and model."""
    found = response_cells(tasks, models, responses, order)
    return found.select(*tasks.columns, F.inline_outer("cells"))  # "outer" spares a filter that makes the cells twice


def rejected_responses(
    tasks: DataFrame, models: list[str], responses: DataFrame, order: str
) -> DataFrame:
    """The responses that are in no cell, with the reason.

    A model outside the list, a task that is not planned, or a later response of the
    same model to the task. Groups are reduced to their last order value, not to texts.
    """
    model, task = F.col("model").isin(check_models(models)), F.col("_planned").isNotNull()
    planned = tasks.select("task_id", F.lit(True).alias("_planned")).distinct()
    last = responses.groupBy("task_id", "model").agg(
        F.max(F.struct(F.col(order).alias("_order"), F.xxhash64("text").alias("_h"))).alias("_top")
    )
    # Equal order values: the greatest text is in the cell, so those are told apart by it.
    same = responses.groupBy("task_id", "model", order).agg(
        F.max("text").alias("_text"), F.count("*").alias("_n")
    ).where("_n > 1").drop("_n")
    marked = (
        responses.join(planned, "task_id", "left")
        .join(last.select("task_id", "model", F.col("_top._order").alias("_last")), ["task_id", "model"], "left")
        .join(same, ["task_id", "model", order], "left")
    )
    earlier = ~F.col(order).eqNullSafe(F.col("_last")) | ~F.coalesce(F.col("_text"), F.col("text")).eqNullSafe(F.col("text"))
    reason = (
        F.when(~F.coalesce(model, F.lit(False)), UNLISTED_MODEL)
        .when(~task, UNPLANNED_TASK)
        .when(earlier, SUPERSEDED)
    )
    return marked.withColumn("reason", reason).where("reason is not null").select(*responses.columns, "reason")


def map_cells(cells: DataFrame, text: Callable[[Column], Column]) -> DataFrame:
    """``cells`` with the text of each cell replaced by ``text(cell)``."""
    return cells.withColumn("cells", F.transform("cells", lambda c: c.withField("text", text(c))))


def fill_blank_response(
    grid: DataFrame,
    empty_marker: str = EMPTY_RESPONSE,
    missing_marker: str = ERROR_GENERATING,
    whitespace_is_blank: bool = True,
) -> DataFrame:
    """Replace blank and missing texts of a grid, or of cells, by their markers."""

    def filled(text: Column, present: Column) -> Column:
        blank = is_blank(text) if whitespace_is_blank else F.coalesce(text, F.lit("")) == ""
        return F.when(~present, F.lit(missing_marker)).when(blank, F.lit(empty_marker)).otherwise(text)

    if "cells" in grid.columns:
        return map_cells(grid, lambda c: filled(c["text"], c["present"]))
    return grid.withColumn("text", filled(F.col("text"), F.col("present")))


def fail_whole_models(grid: DataFrame, failed: list[str], marker: str = ERROR) -> DataFrame:
    """Overwrite every cell of the models that failed during generation."""
    if not failed:
        return grid

    def marked(text: Column, model: Column) -> Column:
        return F.when(model.isin(*failed), F.lit(marker)).otherwise(text)

    if "cells" in grid.columns:
        return map_cells(grid, lambda c: marked(c["text"], c["model"]))
    return grid.withColumn("text", marked(F.col("text"), F.col("model")))


def fill_blank_question(df: DataFrame, text_col: str, placeholder: str) -> DataFrame:
    """Empty generated text becomes ``placeholder`` with its ``{topic}`` named."""
    filled = F.replace(F.lit(placeholder), F.lit("{topic}"), F.col("topic"))
    return df.withColumn(
        text_col, F.when(is_blank(F.col(text_col)), filled).otherwise(F.col(text_col))
    )


def model_pairs(models: list[str]) -> list[tuple[str, str]]:
    """All unordered pairs in list order."""
    return list(combinations(check_models(models), 2))


def model_pairs_table(spark: SparkSession, models: list[str]) -> DataFrame:
    rows = [(i, a, b) for i, (a, b) in enumerate(model_pairs(models), start=1)]
    return spark.createDataFrame(rows, "pair_id INT, model_1 STRING, model_2 STRING")


def task_texts(grid: DataFrame, models: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per task with ``texts``, the responses in model-list order.

    The aggregate holds one slot per model whatever the group size.
    """
    slots = [F.max(F.when(F.col("model") == m, F.col("text"))) for m in check_models(models)]
    return grid.groupBy("task_id").agg(
        F.array(*slots).alias("texts"), *[F.max(c).alias(c) for c in carry]
    )


def pair_grid(grid: DataFrame, models: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per task and model pair with both responses.

    From cells the pairs are made inside the row. The rows of a long grid first meet
    once per task. Then the fixed pair list is exploded: no shuffle beyond that.
    """
    order = check_models(models)
    position = {m: i for i, m in enumerate(order)}
    rows = [
        {"pair_id": n, "model_1": a, "model_2": b, "i": position[a], "j": position[b]}
        for n, (a, b) in enumerate(model_pairs(order), start=1)
    ]
    # One literal for the whole list: the optimizer folds it to a constant array.
    pairs = F.from_json(F.lit(json.dumps(rows)), PAIR_LIST)
    if "cells" in grid.columns:
        texts = grid.select("task_id", *carry, F.col("cells.text").alias("texts"))
    else:
        texts = task_texts(grid, order, carry)
    return (
        texts.select("task_id", *carry, "texts", F.inline(pairs))
        .select(
            "task_id",
            *carry,
            "pair_id",
            "model_1",
            "model_2",
            F.col("texts")[F.col("i")].alias("text_1"),
            F.col("texts")[F.col("j")].alias("text_2"),
        )
    )


def pair_arms(
    left: DataFrame,
    right: DataFrame,
    on: str = "task_id",
    text_col: str = "text",
    missing_marker: str = ERROR_GENERATING,
) -> DataFrame:
    """All rounds of either arm: ``text_x`` from left, ``text_y`` from right.

    An arm without a row for the round, or with a null text, has ``missing_marker``.
    """
    both = left.withColumnRenamed(text_col, "text_x").join(
        right.select(on, F.col(text_col).alias("text_y")), on, "full_outer"
    )
    return both.withColumns(
        {c: F.coalesce(c, F.lit(missing_marker)) for c in ("text_x", "text_y")}
    )


def pivot_models(
    df: DataFrame,
    models: list[str],
    value_col: str,
    prefix: str,
    carry: tuple[str, ...] = (),
    default: object = None,
) -> DataFrame:
    """One column ``<prefix><model>`` per model, one row per task."""
    columns = []
    for m in check_models(models):
        value = F.max(F.when(F.col("model") == m, F.col(value_col)))
        if default is not None:
            value = F.coalesce(value, F.lit(default))
        columns.append(value.alias(f"{prefix}{m}"))
    return df.groupBy("task_id").agg(*[F.max(c).alias(c) for c in carry], *columns)
