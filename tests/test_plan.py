import pytest
from pyspark.sql import functions as F

from examloom.functions.prompts import fill, has_other_slots, render
from examloom.plans import tasks
from examloom.sources.readers import builtin, topics


def catalogues(spark):
    templates = builtin(spark, ("ask {topic}", "{topic} and {topic}", "plain"), "template")
    return topics(spark), templates


def test_plan_is_reproducible_and_rendered(spark):
    top, tem = catalogues(spark)
    plan = tasks.plan_tasks(tasks.task_ids(spark, 500), top, tem, 3)
    rows = {r.task_id: r for r in plan.collect()}
    assert sorted(rows) == list(range(1, 501))
    again = tasks.plan_tasks(tasks.task_ids(spark, 500).repartition(9), top, tem, 3)
    assert {r.task_id: r for r in again.collect()} == rows
    texts = {r.template_id: r.template for r in tem.collect()}
    assert all(r.prompt == texts[r.template_id].replace("{topic}", r.topic) for r in rows.values())
    assert len({r.topic for r in rows.values()}) == 16 and {r.template_id for r in rows.values()} == {0, 1, 2}


def test_top_up_prefers_a_non_empty_clean_dataset(spark):
    top, tem = catalogues(spark)
    clean, raw, empty = (tasks.task_ids(spark, n) for n in (4, 9, 0))
    assert tasks.remaining(10, clean, raw) == (4, 6)
    assert tasks.remaining(10, empty, raw) == (9, 1)
    assert tasks.remaining(5, None, raw) == (9, 0)
    assert tasks.remaining(5, None, None) == (0, 5)
    ids = [r.task_id for r in tasks.plan_top_up(spark, 6, clean, raw, top, tem, 1).collect()]
    assert sorted(ids) == [10, 11]
    assert sorted(r.task_id for r in tasks.plan_top_up(spark, 2, None, None, top, tem, 1).collect()) == [1, 2]
    assert tasks.plan_top_up(spark, 3, clean, raw, top, tem, 1).count() == 0


def test_pending(spark):
    todo = tasks.pending(tasks.task_ids(spark, 5), spark.createDataFrame([(2,), (5,)], "task_id LONG"))
    assert sorted(r.task_id for r in todo.collect()) == [1, 3, 4]


def test_merge_templates(spark):
    seeds = spark.createDataFrame([(0, "s {topic}"), (1, "s {topic}"), (2, "no slot")], "ordinal INT, template STRING")
    new = ["s {topic}", "a {topic}", "without", "b {topic}", "a {topic}", "c {topic}"]
    candidates = spark.createDataFrame(list(enumerate(new)), "ordinal INT, template STRING")

    def merged(total):
        rows = tasks.merge_templates(seeds, candidates, total)
        found = rows.orderBy("template_id").collect()
        assert [r.template_id for r in found] == list(range(len(found)))
        return [(r.origin, r.template) for r in found]

    base = [("seed", "s {topic}"), ("seed", "s {topic}"), ("seed", "no slot")]
    assert merged(5) == base + [("augmented", "a {topic}"), ("augmented", "b {topic}")]
    assert merged(99) == base + [("augmented", f"{x} {{topic}}") for x in "abc"]
    assert merged(2) == base
    counts = tasks.accepted_count(tasks.merge_templates(seeds, candidates, 5)).first()
    assert tuple(counts) == (3, 2, 5)


def test_inserted_text_is_not_expanded_again(spark):
    df = spark.createDataFrame([("{topic} {a}", "{b}")], "a STRING, b STRING")
    row = df.select(
        render(F.lit("x {topic}"), F.col("a")).alias("r"),
        fill("{a}-{b}-{c}", {"a": F.col("a"), "b": F.col("b")}).alias("f"),
        has_other_slots(F.lit("{topic} {other}")).alias("bad"),
        has_other_slots(F.lit("{topic} ok")).alias("good"),
    ).first()
    assert tuple(row) == ("x {topic} {a}", "{topic} {a}-{b}-{c}", True, False)


def test_a_catalogue_with_gaps_or_repeats_is_refused(spark):
    top, _ = catalogues(spark)
    for ids in ([1, 2, 3], [0, 2], [0, 0, 1], [0, None]):
        bad = spark.createDataFrame([(i, f"{i} {{topic}}") for i in ids], "template_id INT, template STRING")
        with pytest.raises(ValueError, match="template_id"):
            tasks.plan_tasks(tasks.task_ids(spark, 5), top, bad, 1)


def test_tasks_over_a_merged_catalogue(spark):
    top, tem = catalogues(spark)
    seeds = tem.withColumnRenamed("template_id", "ordinal")
    new = spark.createDataFrame([(i, f"n{i} {{topic}}") for i in range(0, 40, 3)], "ordinal INT, template STRING")
    merged = tasks.merge_templates(seeds, new, 12)
    plan = tasks.plan_tasks(tasks.task_ids(spark, 1000), top, merged, 5)
    assert plan.count() == 1000 and plan.select("task_id").distinct().count() == 1000


def test_numbers_follow_the_order_whatever_the_partitions(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x")).repartition(7)
    got = {r.x: r.n for r in tasks.numbered(rows, ["x"], "n").collect()}
    assert got == {x: n for n, x in enumerate(sorted(got))}
