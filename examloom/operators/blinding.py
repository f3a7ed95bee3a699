"""Blind assignment, judge prompts and the way back to model names.

Every assignment is a pure function of (seed, task, models): it is computed in
the row, is the same on every rerun, and needs no look-up table to undo.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions.prompts import fill
from examloom.functions.text import keyed_hash, keyed_index
from examloom.operators.grid import model_array

# Names of outcomes without a model.
TIE = "Tie"
UNKNOWN = "Unknown"
PARSE_ERROR = "Parse Error"


def blind_ab(
    df: DataFrame, seed: int, keys: list[str], x: str = "text_x", y: str = "text_y"
) -> DataFrame:
    """Coin flip per row: adds ``a_is_x``, ``question_A`` and ``question_B``."""
    a_is_x = keyed_index(2, seed, "ab", *[F.col(k) for k in keys]) == 0
    flipped = df.withColumn("a_is_x", a_is_x)
    return flipped.withColumn(
        "question_A", F.when(F.col("a_is_x"), F.col(x)).otherwise(F.col(y))
    ).withColumn("question_B", F.when(F.col("a_is_x"), F.col(y)).otherwise(F.col(x)))


def blind_pairs(pairs: DataFrame, seed: int) -> DataFrame:
    """``blind_ab`` for model pairs: adds ``is_swapped``, ``model_A`` and ``model_B``."""
    blinded = blind_ab(pairs, seed, ["task_id", "model_1", "model_2"], "text_1", "text_2")
    a_is_first = F.col("a_is_x")
    return (
        blinded.withColumn("is_swapped", ~a_is_first)
        .withColumn(
            "model_A", F.when(a_is_first, F.col("model_1")).otherwise(F.col("model_2"))
        )
        .withColumn(
            "model_B", F.when(a_is_first, F.col("model_2")).otherwise(F.col("model_1"))
        )
        .drop("a_is_x")
    )


def shuffled_models(models: list[str], seed: int, task: Column) -> Column:
    """The models of one task in blind order: label ``i`` is element ``i``."""
    keyed = F.transform(
        model_array(models),
        lambda m: F.struct(keyed_hash(seed, "shuffle", task, m).alias("h"), m.alias("m")),
    )
    return F.transform(F.array_sort(keyed), lambda s: s.m)


def shuffled_cells(cells: DataFrame, seed: int) -> DataFrame:
    """The cells of each task in blind order: label ``i`` is element ``i``.

    The same order as ``shuffled_models``, from one digest for each cell of the task.
    """

    def keyed(cell: Column) -> Column:
        h = keyed_hash(seed, "shuffle", F.col("task_id"), cell["model"])
        return F.struct(h.alias("h"), cell["model"].alias("m"), cell.alias("cell"))

    ordered = F.array_sort(
        F.transform("cells", keyed),
        lambda a, b: F.when(a["h"] < b["h"], -1).when(a["h"] > b["h"], 1)
        .when(a["m"] < b["m"], -1).when(a["m"] > b["m"], 1).otherwise(0),
    )
    return cells.withColumn("cells", F.transform(ordered, lambda s: s["cell"]))


def blind_n(grid: DataFrame, models: list[str], seed: int) -> DataFrame:
    """Add ``label`` 1..N, a random permutation of the models per task. No shuffle.

    From cells the permutation is made once per task; a long grid makes it per row.
    """
    if "cells" in grid.columns:
        rest = [c for c in grid.columns if c != "cells"]
        spread = shuffled_cells(grid, seed).select(*rest, F.posexplode_outer("cells").alias("_i", "_cell"))
        return spread.select(*rest, "_cell.*", (F.col("_i") + 1).alias("label"))
    order = shuffled_models(models, seed, F.col("task_id"))
    return grid.withColumn("label", F.array_position(order, F.col("model")).cast("int"))


def blind_mapping(tasks: DataFrame, models: list[str], seed: int) -> DataFrame:
    """Add ``model_mapping``: ``Model 1: a | Model 2: b`` in label order."""
    order = shuffled_models(models, seed, F.col("task_id"))
    named = F.transform(
        order, lambda m, i: F.concat(F.lit("Model "), (i + 1).cast("string"), F.lit(": "), m)
    )
    return tasks.withColumn("model_mapping", F.array_join(named, " | "))


def unblind(
    verdicts: DataFrame, models: list[str], seed: int, label_col: str = "label", out: str = "winner"
) -> DataFrame:
    """Label to model name; ``Unknown`` outside 1..N, ``Parse Error`` for null."""
    order = shuffled_models(models, seed, F.col("task_id"))
    label = F.col(label_col)
    return verdicts.withColumn(
        out,
        F.when(label.isNull(), F.lit(PARSE_ERROR))
        .when(label.between(1, len(models)), F.try_element_at(order, label))
        .otherwise(F.lit(UNKNOWN)),
    )


def unblind_scores(
    scored: DataFrame, models: list[str], seed: int, scores_col: str = "scores"
) -> DataFrame:
    """One row per task and model from a label-to-score map, -1 where missing."""
    order = shuffled_models(models, seed, F.col("task_id"))
    rest = [c for c in scored.columns if c != scores_col]
    return scored.select(
        *rest, scores_col, F.posexplode(order).alias("_i", "model")
    ).select(
        *rest,
        (F.col("_i") + 1).alias("label"),
        "model",
        F.coalesce(F.try_element_at(scores_col, F.col("_i") + 1), F.lit(-1)).alias("score"),
    )


def judge_prompts_cells(cells: DataFrame, seed: int, rubric: str) -> DataFrame:
    """``judge_prompts_n`` of cells: the prompt is made inside the row of the task.

    ``rubric`` holds ``{responses}``, ``{n}`` and any column of the task by name.
    """
    blocks = F.transform(
        "cells",
        lambda c, i: F.concat(
            F.lit("=== Model "), (i + 1).cast("string"), F.lit(" ===\n"), c["text"], F.lit("\n\n")
        ),
    )
    blocked = shuffled_cells(cells, seed).select(
        *[c for c in cells.columns if c != "cells"],
        F.size("cells").alias("_n"),
        F.array_join(blocks, "").alias("_responses"),
    )
    values = {c: F.col(c) for c in blocked.columns if not c.startswith("_")}
    values |= {"responses": F.col("_responses"), "n": F.col("_n").cast("string")}
    return blocked.withColumn("judge_prompt", fill(rubric, values)).drop("_responses", "_n")


def judge_prompts_n(
    blinded: DataFrame, n_models: int, rubric: str, carry: tuple[str, ...] = ("topic",)
) -> DataFrame:
    """One prompt per task with a labelled block per model, in label order.

    ``rubric`` holds ``{responses}``, ``{n}`` and any carried column by name.
    """
    label = F.col("label")
    blocks = [
        F.concat(
            F.lit(f"=== Model {i} ===\n"), F.max(F.when(label == i, F.col("text"))), F.lit("\n\n")
        )
        for i in range(1, n_models + 1)
    ]
    per_task = blinded.groupBy("task_id").agg(
        F.concat(*blocks).alias("_responses"), *[F.max(c).alias(c) for c in carry]
    )
    values = {c: F.col(c) for c in carry}
    values |= {"responses": F.col("_responses"), "n": F.lit(n_models)}
    return per_task.withColumn("judge_prompt", fill(rubric, values)).drop("_responses")


def judge_prompts_ab(blinded: DataFrame, rubric: str, headings: bool = True) -> DataFrame:
    """One prompt per row with both sides.

    ``headings`` writes ``=== Response A ===`` blocks, else plain ``A:`` and
    ``B:`` ones. ``rubric`` holds ``{responses}`` and any column by name.
    """
    a, b = ("=== Response A ===\n", "=== Response B ===\n") if headings else ("A:\n", "B:\n")
    responses = F.concat(
        F.lit(a), F.col("question_A"), F.lit("\n\n" + b), F.col("question_B"), F.lit("\n\n")
    )
    values = {c: F.col(c) for c in blinded.columns}
    return blinded.withColumn("judge_prompt", fill(rubric, values | {"responses": responses}))
