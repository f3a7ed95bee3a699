import random

import pytest
from pyspark.sql import functions as F

from examloom.operators import blinding, boards, grid
from workloads import judging

MODELS = ["m-b", "m-a", "m-c", "m-d"]


@pytest.fixture
def tasks(spark):
    return spark.range(1, 31).select(
        F.col("id").alias("task_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("topic"),
        F.lit("p").alias("prompt"),
    )


@pytest.fixture
def full(spark, tasks):
    rows = [
        (t, m, f"{m} on {t}") for t in range(1, 31) for m in MODELS if not (t == 2 and m == "m-a")
    ]
    rows = [(t, m, " 　" if (t, m) == (3, "m-c") else x) for t, m, x in rows]
    responses = spark.createDataFrame(rows + [(1, "m-b", "a dup"), (1, "other", "no")],
                                      "task_id LONG, model STRING, text STRING")
    return grid.response_grid(tasks, MODELS, responses)


def test_grid_is_complete_and_unique(full):
    rows = full.collect()
    assert len(rows) == 120 and len({(r.task_id, r.model) for r in rows}) == 120
    missing = [(r.task_id, r.model) for r in rows if not r.present]
    assert missing == [(2, "m-a")]


def test_the_last_response_counts_and_the_rest_is_told(spark, tasks):
    rows = [
        (1, "m-a", "z first", 1), (1, "m-a", "a last", 2), (1, "m-b", "x", 5), (1, "m-b", "y", 5), (1, "m-b", "y", 5),
        (2, "m-c", None, 3), (2, "m-c", "t", 1), (99, "m-a", "no task", 1), (1, "other", "no model", 1), (None, "m-a", "q", 1), (1, None, "r", 1),
    ]
    responses = spark.createDataFrame(rows, "task_id LONG, model STRING, text STRING, at INT").repartition(5)
    cells = {(r.task_id, r.model): (r.text, r.at) for r in grid.response_grid(tasks, MODELS, responses, "at").where("present").collect()}
    assert cells == {(1, "m-a"): ("a last", 2), (1, "m-b"): ("y", 5), (2, "m-c"): (None, 3)}
    out = [(r.task_id, r.model, r.text, r.reason) for r in grid.rejected_responses(tasks, MODELS, responses, "at").collect()]
    assert sorted(out, key=str) == sorted([
        (1, "m-a", "z first", grid.SUPERSEDED), (1, "m-b", "x", grid.SUPERSEDED), (2, "m-c", "t", grid.SUPERSEDED),
        (99, "m-a", "no task", grid.UNPLANNED_TASK), (1, "other", "no model", grid.UNLISTED_MODEL),
        (None, "m-a", "q", grid.UNPLANNED_TASK), (1, None, "r", grid.UNLISTED_MODEL),
    ], key=str)


def test_cells_and_the_long_grid_agree(spark, tasks):
    rows = [(t, m, f"{m} on {t}" if t % 4 else " ") for t in range(1, 31) for m in MODELS if (t + len(m)) % 5]
    responses = spark.createDataFrame(rows, "task_id LONG, model STRING, text STRING")
    long = grid.fail_whole_models(grid.fill_blank_response(grid.response_grid(tasks, MODELS, responses)), ["m-c"])
    cells = grid.fail_whole_models(grid.fill_blank_response(grid.response_cells(tasks, MODELS, responses)), ["m-c"])
    same = lambda a, b: sorted(map(tuple, a.select(sorted(b.columns)).collect())) == sorted(map(tuple, b.select(sorted(b.columns)).collect()))
    assert same(cells.select("task_id", "topic", "prompt", F.inline("cells")), long)
    assert same(grid.pair_grid(cells, MODELS, ("topic",)), grid.pair_grid(long, MODELS, ("topic",)))
    assert same(blinding.blind_n(cells, MODELS, 9), blinding.blind_n(long, MODELS, 9))
    rubric = "{topic}|{n}|{responses}end {x}"
    prompts = blinding.judge_prompts_n(blinding.blind_n(long, MODELS, 9), 4, rubric)
    assert same(blinding.judge_prompts_cells(cells, 9, rubric), prompts)


def test_texts_are_aggregated_once_and_digests_made_once_a_cell(spark, tasks):
    responses = spark.createDataFrame([(1, "m-a", "x")], "task_id LONG, model STRING, text STRING")
    cells = grid.fill_blank_response(grid.response_cells(tasks, MODELS, responses))
    for df in (
        grid.pair_grid(cells, MODELS, ("topic",)), blinding.blind_n(cells, MODELS, 9), blinding.judge_prompts_cells(cells, 9, "{responses}"),
    ):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate [") == 1
        assert plan.count("md5(") <= 1


def test_fill_blank(full):
    texts = {(r.task_id, r.model): r.text for r in grid.fill_blank_response(full).collect()}
    assert texts[2, "m-a"] == "[ERROR_GENERATING]" and texts[3, "m-c"] == "[EMPTY_RESPONSE]"
    falsy = grid.fill_blank_response(full, "[EMPTY RESPONSE]", "No Output", whitespace_is_blank=False)
    texts = {(r.task_id, r.model): r.text for r in falsy.collect()}
    assert texts[2, "m-a"] == "No Output" and texts[3, "m-c"] == " 　"
    failed = grid.fail_whole_models(full, ["m-d"])
    assert {r.text for r in failed.where("model = 'm-d'").collect()} == {"[ERROR]"}


def test_fill_blank_question(spark):
    df = spark.createDataFrame([("x", ""), ("y", "q")], "topic STRING, text STRING")
    out = grid.fill_blank_question(df, "text", "ask {topic}").orderBy("topic").collect()
    assert [r.text for r in out] == ["ask x", "q"]


def test_pairs_follow_list_order(spark, full):
    assert grid.model_pairs(MODELS)[:3] == [("m-b", "m-a"), ("m-b", "m-c"), ("m-b", "m-d")]
    assert grid.model_pairs_table(spark, MODELS).count() == 6
    pairs = grid.pair_grid(grid.fill_blank_response(full), MODELS, ("topic",))
    assert pairs.count() == 180
    row = pairs.where("task_id = 5 and pair_id = 2").first()
    assert (row.model_1, row.model_2, row.text_1, row.text_2, row.topic) == (
        "m-b", "m-c", "m-b on 5", "m-c on 5", "t5",
    )


def test_model_list_is_checked():
    with pytest.raises(ValueError):
        grid.check_models(["a", "a"])
    with pytest.raises(ValueError):
        grid.check_models([])


def test_ab_blinding_is_undone_by_unswap(spark, full):
    pairs = blinding.blind_pairs(grid.pair_grid(grid.fill_blank_response(full), MODELS), 4)
    rows = pairs.collect()
    assert {r.is_swapped for r in rows} == {True, False}
    for r in rows:
        first, second = (r.question_B, r.question_A) if r.is_swapped else (r.question_A, r.question_B)
        assert (first, second) == (r.text_1, r.text_2)
        assert {r.model_A, r.model_B} == {r.model_1, r.model_2}


def test_n_blinding_is_a_permutation_and_unblinds(spark, full):
    blinded = blinding.blind_n(full, MODELS, 9)
    back = blinding.unblind(blinded, MODELS, 9)
    rows = back.collect()
    assert all(r.winner == r.model for r in rows)
    per_task = {}
    for r in rows:
        per_task.setdefault(r.task_id, []).append(r.label)
    assert all(sorted(ls) == [1, 2, 3, 4] for ls in per_task.values())
    assert len({tuple(ls) for ls in per_task.values()}) > 1
    again = blinding.blind_n(full.repartition(17), MODELS, 9).collect()
    assert {(r.task_id, r.model, r.label) for r in rows} == {
        (r.task_id, r.model, r.label) for r in again
    }


def test_unblind_outside_labels(spark):
    df = spark.createDataFrame([(1, 9), (1, None), (1, -1)], "task_id LONG, label INT")
    assert [r.winner for r in blinding.unblind(df, MODELS, 9).collect()] == [
        "Unknown", "Parse Error", "Unknown",
    ]


def test_prompts(spark, full, tasks):
    filled = grid.fill_blank_response(full)
    blinded = blinding.blind_n(filled, MODELS, 9)
    prompt = blinding.judge_prompts_n(blinded, 4, "{topic}|{n}|{responses}end {x}").where(
        "task_id = 7"
    ).first().judge_prompt
    order = {r.label: r.text for r in blinded.where("task_id = 7").collect()}
    blocks = "".join(f"=== Model {i} ===\n{order[i]}\n\n" for i in range(1, 5))
    assert prompt == f"t7|4|{blocks}end {{x}}"
    mapping = blinding.blind_mapping(tasks, MODELS, 9).where("task_id = 7").first().model_mapping
    models = {r.label: r.model for r in blinded.where("task_id = 7").collect()}
    assert mapping == " | ".join(f"Model {i}: {models[i]}" for i in range(1, 5))


def test_pairwise_board_sums(spark, full):
    random.seed(3)
    pairs = blinding.blind_pairs(grid.pair_grid(grid.fill_blank_response(full), MODELS), 4)
    replies = F.array(*[F.lit(x) for x in ("Winner: A", "Winner: B", "Winner: Tie", "nothing")])
    judged = pairs.withColumn(
        "judge_raw",
        F.when(F.col("task_id") == 1, F.lit(None)).otherwise(
            replies[F.pmod(F.hash("task_id", "pair_id"), F.lit(4))]
        ),
    )
    verdicts = boards.pairwise_verdicts(judged)
    assert verdicts.where("task_id = 1 and winner is not null").count() == 0
    board = boards.pairwise_board(verdicts, MODELS + ["m-none"]).collect()
    wins, ties, matches = (sum(r[c] for r in board) for c in ("wins", "ties", "matches"))
    assert wins + ties / 2 == matches / 2 and matches == 2 * 29 * 6
    zero = next(r for r in board if r.model == "m-none")
    assert (zero.wins, zero.matches, zero.win_rate) == (0, 0, 0.0)


def test_best_of_n_counts_every_task(spark):
    df = spark.createDataFrame(
        [(1, "Winner: Model 1"), (2, "none"), (3, None), (4, "Winner: Model 9"), (5, "Winner: Model3")],
        "task_id LONG, judge_raw STRING",
    )
    verdicts = boards.best_of_n_verdicts(df, MODELS, 9)
    assert [r.winner for r in verdicts.orderBy("task_id").collect()][1:] == [
        "Parse Error", None, "Unknown", "Unknown",
    ]
    board = boards.best_of_n_board(verdicts, MODELS)
    assert {r.tasks for r in board.collect()} == {5}
    assert sum(r.wins for r in board.collect()) == 1
    top = boards.leaderboard(board).collect()
    assert top[0].wins == 1 and [r.pos for r in top[1:]] == sorted(r.pos for r in top[1:])
    assert boards.champion(board).first().win_rate == 20.0
    report = boards.leaderboard_report(board).first()
    assert report["Win Rate"] == "20.0%" and report["Total Wins"] == 1


def test_two_arm_scores_and_totals(spark):
    rows = [(1, True, "Score: 7\nScore: 3"), (2, False, "Score: 7\nScore: 3"), (3, True, "Score: 5"),
            (4, False, "none")]
    df = spark.createDataFrame(rows, "task_id LONG, a_is_x BOOLEAN, judge_raw STRING")
    scored = boards.two_arm_scores(df)
    assert [(r.score_A, r.score_B, r.score_x, r.score_y) for r in scored.orderBy("task_id").collect()] == [
        (7, 3, 7, 3), (7, 3, 3, 7), (5, -1, 5, -1), (-1, -1, -1, -1),
    ]
    assert tuple(boards.geval_totals(scored).first()) == (4, 15, 10)
    chosen = boards.two_arm_wins(
        df.withColumn("judge_raw", F.when(F.col("task_id") < 3, "Winner: A").otherwise("Winner: Tie"))
    )
    assert tuple(boards.arm_totals(chosen).first()) == (4, 1, 1)


def test_multi_scores_round(spark):
    df = spark.createDataFrame([(1, {1: 10, 3: 1}), (2, {2: 0})], "task_id LONG, scores MAP<INT,INT>")
    long = blinding.unblind_scores(df, MODELS, 9)
    assert long.count() == 8 and long.where("score = -1").count() == 5
    assert sum(r.total for r in boards.multi_totals(long).collect()) == 11
    wide = grid.pivot_models(long, MODELS, "score", "score_", default=-1)
    rounds = wide.select("task_id").withColumn("topic", F.lit("t"))
    total = boards.rounds_with_total(long, rounds, MODELS)
    plan = total._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand [") == 1
    got = {r["round"]: tuple(r)[1:] for r in total.collect()}
    want = {str(r.task_id): ("t", *[r[f"score_{m}"] for m in MODELS]) for r in wide.collect()}
    sums = tuple(sum(max(w[k + 1], 0) for w in want.values()) for k in range(len(MODELS)))
    assert got == want | {"TOTAL": ("SUM", *sums)}
    done = boards.with_total_row(
        wide.select(F.col("task_id").alias("round"), F.lit("x").alias("topic"), *[f"`score_{m}`" for m in MODELS])
    )
    total = done.where("round = 'TOTAL'").first()
    assert total.topic == "SUM" and sum(total[f"score_{m}"] for m in MODELS) == 11
    assert done.count() == 3


def test_latency(spark):
    df = spark.createDataFrame([(1, 1.0, 3.0), (2, 2.0, 5.0)], "round INT, time_x DOUBLE, time_y DOUBLE")
    long = boards.latency_wide_to_long(df, {"x": "time_x", "y": "time_y"})
    out = {r.arm: r for r in boards.latency_summary(long).collect()}
    assert (out["x"].mean_s, out["y"].max_s, out["x"].rounds) == (1.5, 5.0, 2)


def test_percentiles_are_exact_at_any_size(spark):
    n = 300_000
    rounds = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("arm"),
        F.when(F.col("id") % 3 == 1, F.col("id") % 5).otherwise(F.col("id") * 7919 % 1_000_003).cast("double").alias("latency_s"),
    )
    rounds = rounds.unionByName(spark.createDataFrame([("a", None), ("none", None)], "arm STRING, latency_s DOUBLE"))
    got = {r.arm: r for r in boards.latency_summary(rounds, accuracy=1000).collect()}
    for arm, k in (("a", 0), ("b", 1), (None, 2)):
        values = sorted(i % 5 if k == 1 else i * 7919 % 1_000_003 for i in range(k, n, 3))
        rank = lambda q: values[-(-len(values) * q // 100) - 1]
        assert (got[arm].rounds, got[arm].p50_s, got[arm].p95_s) == (len(values), rank(50), rank(95))
    assert (got["none"].rounds, got["none"].p50_s) == (0, None)


def test_serial_markers_take_no_text_of_another_document(spark, tmp_path):
    """Documents 4 and 5 answer task 0 for one model; only document 4 is empty."""
    rows = [(4, "src1", "four"), (5, "src1", "five"), (6, "src2", "six"), (11, "src5", "eleven")]
    spark.createDataFrame(rows, "doc_id BIGINT, source STRING, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    found = judging.fill_serial_markers(spark, str(tmp_path)).where("model in ('src1', 'src2', 'src5', 'src0', 'src3')").collect()
    assert sorted((r.model, r.text) for r in found) == [
        ("src0", "No Output"), ("src1", "five"), ("src2", "six"), ("src3", "[ERROR]"), ("src5", "[EMPTY RESPONSE]")
    ]
