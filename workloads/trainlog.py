"""Loss series and latencies over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.operators import boards, trainlog
from examloom.session import fresh_path
from examloom.sources import readers
from workloads.registry import query, table

# Small ranges, so that series cross many range borders at every scale.
STEPS_PER_RANGE = 2048


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs are users, steps are event ids; error events carry no loss."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("step"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("loss"),
    )


POINTS_SQL = """points AS (SELECT user_id AS run_id, event_id AS step, value AS loss FROM events
  WHERE event_type <> 'error' AND value IS NOT NULL)"""


@query(
    "smooth_loss",
    f"""WITH {POINTS_SQL}, w AS (SELECT run_id, step,
      avg(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS m,
      row_number() OVER (PARTITION BY run_id ORDER BY step) AS r,
      count(*) OVER (PARTITION BY run_id) AS n FROM points)
    SELECT run_id, step, round(m, 6) AS smooth_loss FROM w WHERE r >= 5 AND n > 5""",
)
def smooth_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    smooth = trainlog.smooth_loss(train_log(spark, sf_dir), steps_per_range=STEPS_PER_RANGE)
    return smooth.withColumn("smooth_loss", F.round("smooth_loss", 6))


ENTRIES_PER_RUN = 5000
CHECKPOINTS_SQL = f"""points AS (SELECT event_id // {ENTRIES_PER_RUN} AS run, event_id AS step,
  CASE WHEN event_id % 5 = 0 THEN value + 1 ELSE value END AS loss FROM events
  WHERE event_type <> 'error' AND value IS NOT NULL)"""


def _train_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of some thousand entries with two checkpoints each: the later one lacks every fifth step
    and has other losses for the rest, and every step has an entry without a loss as well."""
    events = train_log(spark, sf_dir).withColumn("run", F.expr(f"step div {ENTRIES_PER_RUN}"))
    early = events.select("run", F.lit(10).alias("checkpoint"), "step", (F.col("loss") + 1).alias("loss"))
    late = events.where("step % 5 <> 0").select("run", F.lit(200).alias("checkpoint"), "step", "loss")
    entry = F.struct("step", "loss", (F.col("step") / 1000).alias("epoch"))
    other = F.struct("step", F.lit(None).cast("double").alias("loss"), F.lit(0.5).alias("epoch"))
    entries = early.unionByName(late).select("run", "checkpoint", F.explode(F.array(entry, other)).alias("e"))
    state = F.to_json(F.struct(F.lit(1.0).alias("epoch"), F.collect_list("e").alias("log_history")))
    path = fresh_path(spark, "states")
    states = entries.groupBy("run", "checkpoint").agg(state.alias("value"))
    states.write.partitionBy("run", "checkpoint").text(path)
    return readers.read_train_log(spark, f"{path}/*/*")


@query(
    "smooth_loss_of_checkpoints",
    f"""WITH {CHECKPOINTS_SQL}, w AS (SELECT run, step,
      avg(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS m,
      row_number() OVER (PARTITION BY run ORDER BY step) AS r,
      count(*) OVER (PARTITION BY run) AS n FROM points)
    SELECT run, step, round(m, 6) AS smooth_loss FROM w WHERE r >= 5 AND n > 5""",
)
def smooth_loss_of_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    smooth = trainlog.smooth_loss(_train_states(spark, sf_dir), steps_per_range=STEPS_PER_RANGE)
    run = F.regexp_extract("run_id", r"/run=(\d+)$", 1).cast("bigint")
    return smooth.select(run.alias("run"), "step", F.round("smooth_loss", 6).alias("smooth_loss"))


@query(
    "annotate_every",
    f"""WITH {POINTS_SQL}, w AS (SELECT *,
      row_number() OVER (PARTITION BY run_id ORDER BY step) AS r FROM points)
    SELECT run_id, step, loss FROM w WHERE (r - 1) % 5 = 0""",
)
def annotate_every(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trainlog.annotate_every(train_log(spark, sf_dir), steps_per_range=STEPS_PER_RANGE)


@query(
    "final_loss",
    f"""WITH {POINTS_SQL} SELECT run_id, max(step) AS step, max_by(loss, step) AS final_loss
    FROM points GROUP BY run_id""",
)
def final_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trainlog.final_loss(train_log(spark, sf_dir))


@query(
    "latency_summary",
    """SELECT event_type AS arm, count(value) AS rounds, round(avg(value), 6) AS mean_s,
    min(value) AS min_s, max(value) AS max_s, quantile_disc(value, 0.5) AS p50_s,
    quantile_disc(value, 0.95) AS p95_s FROM events GROUP BY 1""",
)
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("arm"), F.col("value").alias("latency_s")
    )
    return boards.latency_summary(rounds).withColumn("mean_s", F.round("mean_s", 6))
