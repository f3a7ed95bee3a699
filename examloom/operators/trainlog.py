"""Training-log series: smoothing, sampling for labels, last value.

A run may hold a large share of all points, so no window spans a whole run:
points are ordered inside fixed step ranges, and a small table with one row
per range carries what crosses a border.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STEPS_PER_RANGE = 100_000


def loss_points(train_log: DataFrame) -> DataFrame:
    """Log entries that carry a loss."""
    return train_log.where(F.col("loss").isNotNull())


def _ranged(points: DataFrame, steps_per_range: int) -> DataFrame:
    """Points with their step range.

    The null filter is what the join on these columns would add on one side
    only; with it on both, the two sides share one shuffle.
    """
    return points.withColumn("_range", F.expr(f"step div {steps_per_range}")).where(
        F.col("run_id").isNotNull() & F.col("_range").isNotNull()
    )


def _in_range() -> Window:
    return Window.partitionBy("run_id", "_range").orderBy("step")


def _with_borders(ordered: DataFrame, tail: int) -> DataFrame:
    """Add to each range the points before it, the run size and the last ``tail`` losses.

    ``ordered`` is partitioned by (run_id, _range) already; the table joined
    back has one row per range.
    """
    last = F.slice(
        F.array_sort(
            F.collect_list(F.when(F.col("_from_end") <= tail, F.struct("step", "loss")))
        ),
        1,
        max(tail, 1),
    )
    ranges = ordered.groupBy("run_id", "_range").agg(
        F.count("*").alias("_n"), F.transform(last, lambda s: s.loss).alias("_last")
    )
    by_run = Window.partitionBy("run_id").orderBy("_range")
    earlier = F.flatten(F.collect_list("_last").over(by_run.rowsBetween(-max(tail, 1), -1)))
    borders = ranges.select(
        "run_id",
        "_range",
        F.coalesce(
            F.sum("_n").over(by_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.sum("_n").over(Window.partitionBy("run_id")).alias("_run_size"),
        earlier.alias("_earlier"),
    )
    return ordered.join(borders, ["run_id", "_range"])


def smooth_loss(
    train_log: DataFrame, k: int = 5, steps_per_range: int = STEPS_PER_RANGE
) -> DataFrame:
    """Trailing mean of ``k`` losses by step, from the k-th point of each run.

    Runs with no more than ``k`` points give no rows. (run_id, step) is unique.
    """
    points = loss_points(train_log).select("run_id", "step", "loss")
    window = _in_range()
    ordered = (
        _ranged(points, steps_per_range)
        .withColumn("_pos", F.row_number().over(window))
        .withColumn("_sum", F.sum("loss").over(window.rowsBetween(1 - k, 0)))
        .withColumn("_from_end", F.count("*").over(window.rowsBetween(0, k - 1)))
    )
    bordered = _with_borders(ordered, k - 1)
    missing = F.greatest(F.lit(k) - F.col("_pos"), F.lit(0))
    earlier_sum = F.aggregate(
        F.slice(
            "_earlier",
            F.greatest(F.size("_earlier") - missing + 1, F.lit(1)),
            missing,
        ),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    return bordered.where(
        (F.col("_before") + F.col("_pos") >= k) & (F.col("_run_size") > k)
    ).select("run_id", "step", ((F.col("_sum") + earlier_sum) / k).alias("smooth_loss"))


def annotate_every(
    train_log: DataFrame, n: int = 5, steps_per_range: int = STEPS_PER_RANGE
) -> DataFrame:
    """Every n-th point of each run by step, starting with the first."""
    points = loss_points(train_log)
    ranged = _ranged(points, steps_per_range)
    ordered = ranged.withColumn("_pos", F.row_number().over(_in_range()))
    ranges = ranged.groupBy("run_id", "_range").agg(F.count("*").alias("_n"))
    by_run = Window.partitionBy("run_id").orderBy("_range")
    before = F.coalesce(
        F.sum("_n").over(by_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    borders = ranges.select("run_id", "_range", before.alias("_before"))
    return (
        ordered.join(borders, ["run_id", "_range"])
        .where(F.pmod(F.col("_before") + F.col("_pos") - 1, F.lit(n)) == 0)
        .select(*train_log.columns)
    )


def final_loss(train_log: DataFrame) -> DataFrame:
    """Loss at the last step of each run."""
    return loss_points(train_log).groupBy("run_id").agg(
        F.max("step").alias("step"), F.max_by("loss", "step").alias("final_loss")
    )
