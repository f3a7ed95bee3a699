import json

from pyspark.sql import functions as F

from examloom.operators import boards, cleaning
from examloom.sources.readers import NO_OBJECT, OTHER_TYPE, read_jsonl, read_jsonl_lines
from examloom.sources.writers import read_side, write_sides
from examloom.streaming.board import stream_best_of_n, stream_board
from examloom.streaming.clean import stream_clean


def write_records(path, start, n):
    with open(path, "w", encoding="utf-8") as f:
        for i in range(start, start + n):
            rec = {"topic": f"t{i}", "question": f"q{i}", "keep": i % 3 != 0, "content": f"題目：問{i}\n(A) x{i}"}
            f.write(json.dumps(rec, ensure_ascii=False) + "\n")


def test_stream_clean_equals_batch_across_a_restart(spark, tmp_path):
    src, out, state = (tmp_path / d for d in ("in", "out", "state"))
    src.mkdir()
    write_records(src / "1.jsonl", 0, 10)
    write_records(src / "2.jsonl", 10, 10)

    def run():
        stream_clean(spark, str(src), str(out), str(state), max_files_per_trigger=1).awaitTermination()

    run()
    write_records(src / "3.jsonl", 20, 7)
    run()
    run()
    b_clean, b_removed = cleaning.split_keep_removed(read_jsonl(spark, str(src)))
    s_clean, s_removed = (read_side(spark, str(out), side) for side in (cleaning.CLEAN, cleaning.REMOVED))
    assert sorted(s_clean.collect()) == sorted(b_clean.collect())
    as_record = lambda df: sorted((r.reason, sorted(json.loads(r.content).items())) for r in df.collect())
    assert as_record(s_removed) == as_record(b_removed)
    assert s_clean.count() + s_removed.count() == 27


def test_a_batch_run_twice_leaves_no_duplicates(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    write_records(src / "1.jsonl", 0, 9)
    for state in ("s1", "s2"):
        stream_clean(spark, str(src), str(out), str(tmp_path / state)).awaitTermination()
    assert read_side(spark, str(out), cleaning.CLEAN).count() == 6
    assert read_side(spark, str(out), cleaning.REMOVED).count() == 3


DAMAGED = [
    '{"question": "a", "keep": true, "content": "題目：x\\n(A) 1"}', "", "   ", '{"question": "b", "keep": tr', "{'keep': true}",
    "null", "5", '[{"keep": true}]', '{"keep": true} {}', '{"keep": true},"x":2', '{"keep": true}],[', '{"keep": true, "messages": [5]}',
    '{"keep": false, "reason": "r"}', '{"keep": true}', ' {"keep": null, "content": "c"} ', '{"tokens": {"review_in": "x"}, "keep": true, "content": "c"}',
]
SIDES = {
    cleaning.QUARANTINED: [(NO_OBJECT, x) for x in DAMAGED[3:11]] + [(OTHER_TYPE, DAMAGED[k]) for k in (11, 15)],
    cleaning.REMOVED: [
        ("r", DAMAGED[12]), (cleaning.UNREADABLE + cleaning.NO_CONTENT_FIELD, DAMAGED[13]), (cleaning.KEEP_FALSE, DAMAGED[14]),
    ],
}


def sides_of(spark, out):
    found = {side: sorted(map(tuple, read_side(spark, out, side).collect())) for side in SIDES}
    return found, read_side(spark, out, cleaning.CLEAN).collect()


def test_no_line_is_lost_in_batch_or_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("\n".join(DAMAGED[:8]), encoding="utf-8")
    (src / "b.jsonl").write_text("\n".join(DAMAGED[8:]) + "\n", encoding="utf-8")
    write_sides(cleaning.split_rows(read_jsonl_lines(spark, str(src))), str(tmp_path / "batch"))
    stream_clean(spark, str(src), str(tmp_path / "stream"), str(tmp_path / "s"), max_bytes_per_trigger=10).awaitTermination()
    for out in ("batch", "stream"):
        found, clean = sides_of(spark, str(tmp_path / out))
        assert found == {side: sorted(rows) for side, rows in SIDES.items()}
        assert [(r.question, r.LLMans.stem, r.LLMans.options.A) for r in clean] == [("a", "x", "1")]


def test_one_scan_and_no_shuffle_for_all_sides(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(DAMAGED[0])
    plan = cleaning.split_rows(read_jsonl_lines(spark, str(tmp_path / "a.jsonl")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan


def run_board(spark, stream, name):
    query = stream.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted(spark.table(name).collect(), key=str)


def test_stream_board_equals_batch(spark, tmp_path):
    pairs = spark.range(60).select(
        F.concat(F.lit("m"), (F.col("id") % 3).cast("string")).alias("model_1"),
        F.concat(F.lit("m"), (F.col("id") % 3 + 1).cast("string")).alias("model_2"),
    )
    verdicts = pairs.withColumn(
        "winner",
        F.expr("CASE abs(hash(model_1, rand(1))) % 4 WHEN 0 THEN model_1 WHEN 1 THEN model_2 WHEN 2 THEN 'Tie' END"),
    )
    for i in range(3):
        verdicts.where(F.hash("model_1", "model_2") % 3 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "v"))
    schema = "model_1 STRING, model_2 STRING, winner STRING"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "v"))
    batch = spark.read.schema(schema).parquet(str(tmp_path / "v"))
    assert run_board(spark, stream_board(stream), "board") == sorted(boards.pairwise_tally(batch).collect(), key=str)
    expected = sorted(batch.groupBy("winner").count().withColumnRenamed("count", "wins").collect(), key=str)
    assert run_board(spark, stream_best_of_n(stream), "winners") == expected


def test_files_of_the_stream_grow_in_number_with_the_table(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setattr("workloads.files.fresh_path", lambda _spark, made: str(tmp_path / made))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = entry.queries()["stream_damaged_lines"](spark, "/root/testdata/sf0.01").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == 1000 and len(list((tmp_path / "loose").glob("part-*"))) > 4
