"""Verdicts to scoreboards, totals, leaderboards and latency summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examloom.functions import verdicts as v
from examloom.functions.text import rate_str
from examloom.operators.blinding import TIE, unblind
from examloom.operators.grid import check_models, models_table

# Summary header and the totals row.
LEADERBOARD_HEADER = ("Model Name", "Total Wins", "Win Rate")
TOTAL_ROUND, TOTAL_TOPIC = "TOTAL", "SUM"


def pairwise_verdicts(judged: DataFrame, reply_col: str = "judge_raw") -> DataFrame:
    """Add ``tag`` and ``winner`` to blinded pairs; a null reply has no winner."""
    tag = v.parse_winner_ab(F.col(reply_col))
    return judged.withColumn(
        "tag", F.when(F.col(reply_col).isNotNull(), tag)
    ).withColumn(
        "winner",
        F.when(F.col("tag") == "A", F.col("model_A"))
        .when(F.col("tag") == "B", F.col("model_B"))
        .when(F.col("tag") == TIE, F.lit(TIE)),
    )


def pairwise_tally(judged: DataFrame) -> DataFrame:
    """Wins, ties and matches per model; works on streams too.

    Pairs that were not judged (null winner) are no match.
    """
    winner, model = F.col("winner"), F.col("model")
    sides = F.explode(F.array("model_1", "model_2"))
    played = judged.select("winner", "model_1", "model_2", sides.alias("model"))
    return played.groupBy("model").agg(
        F.count_if(winner == model).alias("wins"),
        F.count_if(~winner.isin(F.col("model_1"), F.col("model_2"))).alias("ties"),
        F.count("winner").alias("matches"),
    )


def _rate(wins: Column, total: Column) -> Column:
    return F.when(total > 0, wins * F.lit(100.0) / total).otherwise(F.lit(0.0))


def pairwise_board(judged: DataFrame, models: list[str]) -> DataFrame:
    """Round-robin board over all models, 100 * wins / matches."""
    board = models_table(judged.sparkSession, models).join(
        pairwise_tally(judged), "model", "left"
    )
    board = board.select(
        "pos",
        "model",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("wins", "ties", "matches")],
    )
    return board.withColumn("win_rate", _rate(F.col("wins"), F.col("matches")))


def best_of_n_verdicts(
    judged: DataFrame, models: list[str], seed: int, reply_col: str = "judge_raw"
) -> DataFrame:
    """Add the winning ``label`` and ``winner``; a null reply has neither."""
    labelled = judged.withColumn("label", v.parse_winner_n(F.col(reply_col)))
    named = unblind(labelled, models, seed)
    return named.withColumn(
        "winner", F.when(F.col(reply_col).isNotNull(), F.col("winner"))
    )


def best_of_n_board(verdicts: DataFrame, models: list[str]) -> DataFrame:
    """Wins per model over one row per task; every task counts in the rate.

    One global aggregate with a counter per model: no shuffle of rows.
    """
    order = check_models(models)
    counts = verdicts.agg(
        F.count("*").alias("tasks"),
        F.array(*[F.count_if(F.col("winner") == m) for m in order]).alias("wins"),
    )
    names = F.array(*[F.lit(m) for m in order])
    return (
        counts.select("tasks", F.posexplode(F.arrays_zip(names.alias("model"), F.col("wins"))))
        .select("pos", "col.model", "col.wins", "tasks")
        .withColumn("win_rate", _rate(F.col("wins"), F.col("tasks")))
    )


def leaderboard(board: DataFrame) -> DataFrame:
    """Wins descending; equal wins keep the order of the model list."""
    return board.orderBy(F.desc("wins"), F.asc("pos"))


def champion(board: DataFrame) -> DataFrame:
    """The first row of the leaderboard."""
    return leaderboard(board).limit(1)


def leaderboard_report(board: DataFrame) -> DataFrame:
    """The three summary columns, the rate written as ``12.3%``."""
    return leaderboard(board).select(
        F.col("model").alias(LEADERBOARD_HEADER[0]),
        F.col("wins").alias(LEADERBOARD_HEADER[1]),
        rate_str(F.col("win_rate")).alias(LEADERBOARD_HEADER[2]),
    )


def two_arm_scores(judged: DataFrame, reply_col: str = "judge_raw") -> DataFrame:
    """Scores of one two-arm round, as shown (A, B) and by arm (x, y)."""
    scores = v.parse_two_scores(F.col(reply_col))
    a, b = F.col("score_A"), F.col("score_B")
    return (
        judged.withColumn("_s", scores)
        .withColumn("score_A", F.col("_s.a"))
        .withColumn("score_B", F.col("_s.b"))
        .drop("_s")
        .withColumn("score_x", v.unswapped(F.col("a_is_x"), a, b))
        .withColumn("score_y", v.unswapped(F.col("a_is_x"), b, a))
    )


def two_arm_wins(judged: DataFrame, reply_col: str = "judge_raw") -> DataFrame:
    """Choice of one two-arm round and a point for the chosen arm; a tie gives none."""
    choice = v.parse_winner_ab(F.col(reply_col))
    chose_a, chose_b = F.col("choice") == "A", F.col("choice") == "B"
    return (
        judged.withColumn("choice", choice)
        .withColumn(
            "score_x", v.unswapped(F.col("a_is_x"), chose_a, chose_b).cast("int")
        )
        .withColumn(
            "score_y", v.unswapped(F.col("a_is_x"), chose_b, chose_a).cast("int")
        )
    )


def _positive_sum(column: str) -> Column:
    value = F.col(column)
    return F.coalesce(F.sum(F.when(value > 0, value)), F.lit(0)).cast("bigint")


def geval_totals(rounds: DataFrame) -> DataFrame:
    """Score totals of both arms; unscored rounds do not count."""
    return rounds.agg(
        F.count("*").alias("rounds"),
        _positive_sum("score_x").alias("total_x"),
        _positive_sum("score_y").alias("total_y"),
    )


def arm_totals(rounds: DataFrame) -> DataFrame:
    """Rounds won by each arm."""
    return geval_totals(rounds)


def multi_totals(scores: DataFrame) -> DataFrame:
    """Score total per model from one row per task and model."""
    return scores.groupBy("model").agg(
        _positive_sum("score").alias("total"), F.count("*").alias("rounds")
    )


def rounds_with_total(scores: DataFrame, rounds: DataFrame, models: list[str]) -> DataFrame:
    """One row for each round, a score column per model, and a last row with the totals.

    ``scores(task_id, model, score)`` are read once: one aggregate by grouping sets gives
    the rounds' scores and the totals. ``rounds`` has task_id, which becomes ``round``,
    topic and further texts, which are empty in the last row. A model without a score
    has -1 in a round, and rounds without any score are left out.
    """
    own = [F.col("model") == m for m in check_models(models)]
    names = [f"score_{m}" for m in models]
    score = F.col("score")
    seen = [F.coalesce(F.max(F.when(x, score)), F.lit(-1)) for x in own]
    sums = [F.coalesce(F.sum(F.when(x & (score > 0), score)), F.lit(0)) for x in own]
    total = F.grouping("task_id") == 1
    wide = scores.groupingSets([["task_id"], []], "task_id").agg(
        total.alias("_total"),
        *[F.when(total, t).otherwise(s).cast("bigint").alias(c) for s, t, c in zip(seen, sums, names)],
    )
    rest = [c for c in rounds.columns if c != "task_id"]
    fixed = {"topic": TOTAL_TOPIC}
    told = rounds.withColumn("_known", F.lit(True))
    key = told["task_id"].eqNullSafe(wide["task_id"]) & ~wide["_total"]
    joined = wide.join(told, key, "left").where("_total or _known")
    return joined.select(
        F.when(F.col("_total"), TOTAL_ROUND).otherwise(wide["task_id"].cast("string")).alias("round"),
        *[F.when(F.col("_total"), fixed.get(c, "")).otherwise(F.col(c).cast("string")).alias(c) for c in rest],
        *[F.col(f"`{c}`") for c in names],
    )


def with_total_row(pivoted: DataFrame, prefix: str = "score_") -> DataFrame:
    """The rounds and a last ``TOTAL`` row with the positive score sums."""
    names = [c for c in pivoted.columns if c.startswith(prefix)]
    rest = [c for c in pivoted.columns if c not in names]
    fixed = {"round": TOTAL_ROUND, "topic": TOTAL_TOPIC}
    rounds = pivoted.select(
        *[F.col(c).cast("string").alias(c) for c in rest],
        *[F.col(f"`{c}`").cast("bigint").alias(c) for c in names],
    )
    total = pivoted.agg(*[_positive_sum(f"`{c}`").alias(c) for c in names]).select(
        *[F.lit(fixed.get(c, "")).alias(c) for c in rest], *[f"`{c}`" for c in names]
    )
    return rounds.unionByName(total)


def latency_summary(rounds: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Latency per arm: count, mean, extremes, exact median and 95th percentile.

    A percentile is the least value that at least that share of the rounds does
    not exceed. Approximate percentiles on either side bracket it; values below
    the bracket are only counted, those inside are counted by value, and the
    rank is found among these. ``accuracy`` sets the width of the brackets, a
    few parts in ``accuracy`` of the rounds, and never the result.
    """
    asked = {"p50_s": 0.5, "p95_s": 0.95}
    slack = 2 / accuracy
    edges = [min(max(q + s, 0.0), 1.0) for q in asked.values() for s in (-slack, slack)]
    stats = rounds.groupBy("arm").agg(
        F.count("latency_s").alias("rounds"),
        F.avg("latency_s").alias("mean_s"),
        F.min("latency_s").alias("min_s"),
        F.max("latency_s").alias("max_s"),
        F.percentile_approx("latency_s", edges, accuracy).alias("edges"),
    )
    brackets = [
        F.struct(
            F.lit(name).alias("name"),
            F.greatest(F.ceil(F.col("rounds") * q), F.lit(1)).alias("rank"),
            F.col("edges")[2 * k].alias("lo"),
            F.col("edges")[2 * k + 1].alias("hi"),
        )
        for k, (name, q) in enumerate(asked.items())
    ]
    wanted = stats.where("rounds > 0").select(F.col("arm").alias("_arm"), F.inline(F.array(*brackets)))
    # nulls stand for all values below the bracket and sort before those inside
    value = F.when(F.col("latency_s") >= F.col("lo"), F.col("latency_s")).alias("value")
    near = rounds.join(wanted, F.col("arm").eqNullSafe(F.col("_arm"))).where("latency_s <= hi")
    counted = near.groupBy("_arm", "name", "rank", value).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("_arm", "name").orderBy("value"))
    reached = counted.withColumn("upto", upto).where("upto >= rank").groupBy("_arm")
    exact = reached.agg(*[F.min(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in asked])
    return (
        stats.join(exact, F.col("arm").eqNullSafe(F.col("_arm")), "left")
        .select("arm", "rounds", "mean_s", "min_s", "max_s", *asked)
    )


def latency_wide_to_long(rounds: DataFrame, arms: dict[str, str]) -> DataFrame:
    """One row per round and arm from one time column per arm."""
    entries = [
        F.struct(F.lit(arm).alias("arm"), F.col(c).alias("latency_s")) for arm, c in arms.items()
    ]
    kept = [c for c in rounds.columns if c not in arms.values()]
    return rounds.select(*kept, F.inline(F.array(*entries)))
