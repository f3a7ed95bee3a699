"""End-to-end flows: dataset generation and cleaning, template growth, comparisons."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.functions.prompts import fill, parse_candidates
from examloom.functions.verdicts import parse_multi_scores
from examloom.operators import blinding, boards, grid
from examloom.operators.records import assemble_flat, assemble_record
from examloom.operators.stages import (
    FLAT_CHAIN,
    RICH_CHAIN,
    Client,
    Stage,
    apply_stage,
    run_stages,
    stored_once,
)
from examloom.plans.tasks import merge_templates, numbered

JUDGE = Stage("judge", "{judge_prompt}", on_error="error_row", tries=1)


def generate_rich(
    tasks: DataFrame, clients: dict[str, Callable[[], Client]], rules: dict[str, str], path: str
) -> DataFrame:
    """Five stages over planned tasks, assembled into generation records."""
    done = run_stages(tasks, RICH_CHAIN, clients, rules, "task_id", path)
    return assemble_record(done).select(
        "task_id", "topic", "question", "messages", "keep", "reason", "meta", "tokens",
        "_error", "content",
    )


def generate_flat(
    tasks: DataFrame, clients: dict[str, Callable[[], Client]], rules: dict[str, str], path: str
) -> DataFrame:
    """Four stages over planned tasks, assembled into flat records."""
    done = run_stages(tasks, FLAT_CHAIN, clients, rules, "task_id", path)
    return assemble_flat(
        done.select(
            "task_id",
            "topic",
            F.col("generate_text").alias("original"),
            F.col("fix_text").alias("fixed"),
            "review",
        )
    )


SEEDS_PER_PROMPT = 50


def augment_templates(
    seeds: DataFrame, client_factory: Callable[[], Client], instruction: str, per_template: int,
    target_total: int, path: str, seeds_per_prompt: int = SEEDS_PER_PROMPT,
) -> DataFrame:
    """Grow the template list by an ordinary model stage.

    Seeds, in the order of ``ordinal``, are told to the model in groups of at most
    ``seeds_per_prompt``, one prompt and one stored call a group; a list of up to that
    many is one prompt. ``instruction`` holds ``{seeds}`` and ``{per_template}``. New
    templates follow in the order of groups and of their place in the reply. A list
    that is long enough already is returned unchanged and asks nothing; a failed call
    gives no candidates, and a rerun asks it again.
    """
    if seeds.count() >= target_total:
        return merge_templates(seeds, seeds.limit(0), target_total)
    placed = numbered(seeds.select("ordinal", "template"), ["ordinal", "template"], "place")
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("place", "template"))), lambda s: F.concat(F.lit("- "), s["template"])
    )
    groups = placed.groupBy(F.expr(f"place div {seeds_per_prompt}").alias("group")).agg(
        F.array_join(lines, "\n").alias("seeds")
    )
    stage = Stage("augment", "{prompt}")
    values = {"seeds": F.col("seeds"), "per_template": F.lit(str(per_template))}
    prompts = groups.select("group", fill(instruction, values).alias("prompt"))

    def ask(rows: DataFrame) -> DataFrame:
        return apply_stage(rows, stage, client_factory)

    replies = stored_once(prompts, "group", path, ask, F.col("augment_error").isNotNull(), F.col("prompt"))
    said = replies.where("augment_error is null").select("group", "augment_text")
    candidates = said.select(
        "group", F.posexplode(parse_candidates(F.col("augment_text"))).alias("place", "template")
    ).select((F.col("group") * (1 << 32) + F.col("place")).alias("ordinal"), "template")
    return merge_templates(seeds.withColumn("ordinal", F.col("ordinal").cast("bigint")), candidates, target_total)


def _judge(prompts: DataFrame, client_factory: Callable[[], Client], path: str, key: str) -> DataFrame:
    """Judge replies stored once as ``judge_raw``; null where the call failed."""

    def ask(rows: DataFrame) -> DataFrame:
        asked = apply_stage(rows, JUDGE, client_factory)
        return asked.withColumnRenamed("judge_text", "judge_raw").drop("judge_in", "judge_out")

    failed = F.col("judge_error").isNotNull()
    judged = stored_once(prompts, key, path, ask, failed, F.col("judge_prompt"))
    return judged.drop("judge_prompt")


def pairwise_tournament(
    responses: DataFrame,
    tasks: DataFrame,
    models: list[str],
    client_factory: Callable[[], Client],
    rubric: str,
    seed: int,
    path: str,
) -> tuple[DataFrame, DataFrame]:
    """(judged pairs, board) of a round robin over all model pairs."""
    cells = grid.fill_blank_response(grid.response_cells(tasks, models, responses))
    pairs = blinding.blind_pairs(grid.pair_grid(cells, models, ("topic", "prompt")), seed)
    keyed = blinding.judge_prompts_ab(pairs, rubric).withColumn(
        "match_id", F.concat_ws("-", "task_id", "pair_id")
    )
    judged = boards.pairwise_verdicts(_judge(keyed, client_factory, path, "match_id"))
    return judged, boards.pairwise_board(judged, models)


def best_of_n_tournament(
    responses: DataFrame,
    tasks: DataFrame,
    models: list[str],
    client_factory: Callable[[], Client],
    rubric: str,
    seed: int,
    path: str,
    failed_models: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """(judged tasks, board) where one winner is chosen among all models.

    All responses of ``failed_models`` count as errors, also those they gave.
    """
    given = grid.fill_blank_response(
        grid.response_cells(tasks, models, responses), missing_marker=grid.ERROR
    )
    cells = grid.fail_whole_models(given, list(failed_models))
    prompts = blinding.judge_prompts_cells(cells.select("task_id", "topic", "prompt", "cells"), seed, rubric)
    judged = boards.best_of_n_verdicts(
        _judge(prompts, client_factory, path, "task_id"), models, seed
    )
    return judged, boards.best_of_n_board(judged, models)


def multi_judge(
    responses: DataFrame,
    tasks: DataFrame,
    models: list[str],
    client_factory: Callable[[], Client],
    rubric: str,
    seed: int,
    path: str,
) -> DataFrame:
    """Score of every model on every task, -1 where the judge gave none."""
    cells = grid.fill_blank_response(
        grid.response_cells(tasks, models, responses),
        grid.EMPTY_RESPONSE_SERIAL,
        grid.NO_OUTPUT,
        whitespace_is_blank=False,
    )
    prompts = blinding.judge_prompts_cells(cells.select("task_id", "topic", "prompt", "cells"), seed, rubric)
    judged = _judge(prompts, client_factory, path, "task_id").withColumn(
        "scores", parse_multi_scores(F.col("judge_raw"), len(models))
    )
    return blinding.unblind_scores(judged.select("task_id", "topic", "prompt", "scores"), models, seed)


def two_arm_comparison(
    arm_x: DataFrame,
    arm_y: DataFrame,
    client_factory: Callable[[], Client],
    rubric: str,
    seed: int,
    path: str,
    scored: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(rounds, totals) of two arms, by scores or by choice."""
    rounds = blinding.blind_ab(grid.pair_arms(arm_x, arm_y), seed, ["task_id"])
    prompts = blinding.judge_prompts_ab(rounds, rubric, headings=False)
    judged = _judge(prompts, client_factory, path, "task_id")
    if scored:
        done = boards.two_arm_scores(judged)
        return done, boards.geval_totals(done)
    done = boards.two_arm_wins(judged)
    return done, boards.arm_totals(done)
