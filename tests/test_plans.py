"""What the physical plans must and must not hold, and results under other partitionings."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from examloom.operators import blinding, boards, grid, trainlog

SF_DIR = "/root/testdata/sf0.001"
WRITES_FILES = {
    n for n in entry.queries()
    if re.match(r"(stream_|generate_|jsonl|valid_|split_damaged|augment_|response_files|.*_from_files|run_configs|smooth_loss_of|mixed_|review_log_csv|rounds_|responses_by|saved_|multi_judge"
                r"|two_arm_comparison|.*tournament)", n)
}
PYTHON_STAGES = {"apply_stage", "apply_stage_passthrough", "latency_log"}  # they call a client


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - WRITES_FILES))
def test_no_products_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_STAGES:
        assert "Python" not in plan and "Pandas" not in plan


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def inputs(spark):
    tasks = spark.range(40).select(F.col("id").alias("task_id"), F.lit("t").alias("topic"))
    responses = spark.range(40 * 3).select(
        (F.col("id") % 40).alias("task_id"),
        F.concat(F.lit("m"), F.floor(F.col("id") / 40).cast("string")).alias("model"),
        F.col("id").cast("string").alias("text"),
    )
    return tasks, responses, ["m0", "m1", "m2"]


def test_a_comparison_shuffles_texts_once(spark, no_broadcast):
    tasks, responses, models = inputs(spark)
    cells = grid.fill_blank_response(grid.response_grid(tasks, models, responses))
    prompts = blinding.judge_prompts_n(blinding.blind_n(cells, models, 1), 3, "{responses}")
    for df in (prompts, grid.pair_grid(cells, models)):
        # One exchange for the responses, one for the task ids.
        assert plan_of(df).count("Exchange hashpartitioning") == 2


def test_row_functions_need_no_shuffle(spark):
    _, responses, models = inputs(spark)
    blinded = blinding.unblind(blinding.blind_n(responses, models, 1), models, 1)
    assert "Exchange" not in plan_of(blinded)


def test_hot_groups(spark):
    """A third of all rows in one run, task or text; results as by plain windows."""
    log = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 500)).alias("run_id"),
        F.col("id").alias("step"),
        (F.col("id") % 97).cast("double").alias("loss"),
    )
    smooth = trainlog.smooth_loss(log, steps_per_range=1000)
    hot = {r.step: r.smooth_loss for r in smooth.where("run_id = 'hot'").collect()}
    steps = list(range(0, 30_000, 3))
    assert sorted(hot) == steps[4:]
    assert all(
        abs(hot[s] - sum((x % 97) for x in steps[i : i + 5]) / 5) < 1e-9 for i, s in enumerate(steps[4:])
    )
    plan = plan_of(smooth)
    assert "hashpartitioning(run_id#" in plan and "_range#" in plan

    tasks = spark.range(5).select(F.col("id").alias("task_id"), F.lit("t").alias("topic"))
    copies = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5).alias("task_id"),
        F.lit("m1").alias("model"),
        F.lit("same").alias("text"),
    )
    cells = grid.response_grid(tasks, ["m0", "m1"], copies)
    assert cells.count() == 10 and cells.where("present").count() == 5


@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_results_do_not_depend_on_partitions(spark, partitions):
    tasks, responses, models = inputs(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        cells = grid.response_grid(tasks.repartition(partitions), models, responses.repartition(partitions))
        pairs = blinding.blind_pairs(grid.pair_grid(cells, models), 3)
        replies = F.array(*[F.lit(x) for x in ("Winner: A", "Winner: B", "none")])
        judged = pairs.withColumn("judge_raw", replies[F.pmod(F.col("task_id") + F.col("pair_id"), F.lit(3)).cast("int")])
        board = boards.pairwise_board(boards.pairwise_verdicts(judged), models)
        got = sorted(map(tuple, board.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == EXPECTED.setdefault("board", got)


EXPECTED: dict = {}


@pytest.mark.parametrize("name, label", [("run_configs", "adapters"), ("templates_from_files", "lists")])
def test_many_small_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch, name, label):
    """The suppliers come in one partition, and as few bytes they would stay in one task."""
    monkeypatch.setattr("workloads.files.fresh_path", lambda _spark, made: str(tmp_path / made))
    entry.queries()[name](spark, "/root/testdata/sf0.1")
    tasks = {re.match(r"part-(\d+)", f.name).group(1) for f in (tmp_path / label).glob("*/part-*")}
    assert len(tasks) > 1
