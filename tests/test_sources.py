import json

import pytest
from pyspark.sql import functions as F

from examloom import schemas
from examloom.operators.grid import response_grid
from examloom.sources import readers, writers


def test_valid_prefix(spark, tmp_path):
    lines = ['{"a": 1}', "", '  {"a": 2}  ', '{"a": ', '{"a": 3}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (tmp_path / "b.jsonl").write_text('[1]\n5\n"x"\nNaN\n\n', encoding="utf-8")
    (tmp_path / "c.jsonl").write_text("{'a': 1}\n{}\n", encoding="utf-8")
    (tmp_path / "d.jsonl").write_text('{"a": 1, "a": 2}\r\nnull\n{"b": {}} {}\n', encoding="utf-8")
    valid, bad = readers.valid_prefix(spark, str(tmp_path / "*.jsonl"))

    def by_file(df):
        return sorted((r.file.rsplit("/", 1)[1], r.line) for r in df.collect())

    assert by_file(valid) == [
        ("a.jsonl", '{"a": 1}'), ("a.jsonl", '{"a": 2}'), ("b.jsonl", '"x"'), ("b.jsonl", "5"),
        ("b.jsonl", "NaN"), ("b.jsonl", "[1]"), ("d.jsonl", "null"), ("d.jsonl", '{"a": 1, "a": 2}'),
    ]
    assert by_file(bad) == [
        ("a.jsonl", '{"a":'), ("a.jsonl", '{"a": 3}'), ("c.jsonl", "{'a': 1}"), ("c.jsonl", "{}"),
        ("d.jsonl", '{"b": {}} {}'),
    ]
    assert readers.valid_count(valid).first().n_valid == 8


def test_valid_prefix_of_a_file_in_many_splits(spark, tmp_path):
    lines = [json.dumps({"i": i, "pad": "x" * 50}) for i in range(5000)]
    lines[3210] = lines[3210][:-3]
    (tmp_path / "big.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        valid, bad = readers.valid_prefix(spark, str(tmp_path / "big.jsonl"))
        assert valid.rdd.getNumPartitions() > 4
        assert (valid.count(), bad.count()) == (3210, 1790)
        top = valid.select(F.max(F.get_json_object("line", "$.i").cast("int"))).first()[0]
        assert top == 3209
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_valid_prefix_when_splits_change_before_the_action(spark, tmp_path):
    lines = [f'{{"n":{i}}}' if i != 3000 else '{"n":' for i in range(4000)]
    (tmp_path / "one.jsonl").write_text("\n".join(lines))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "4096")
        valid, bad = readers.valid_prefix(spark, str(tmp_path / "one.jsonl"))
        spark.conf.set(key, "16384")
        assert (valid.count(), bad.count()) == (3000, 1000)
    finally:
        spark.conf.set(key, before)


def test_valid_prefix_of_a_missing_path(spark, tmp_path):
    valid, bad = readers.valid_prefix(spark, str(tmp_path / "none.jsonl"))
    assert (valid.count(), bad.count()) == (0, 0)


def test_templates(spark, tmp_path):
    good = tmp_path / "p.json"
    good.write_text(json.dumps(["甲 {topic}", "b"], ensure_ascii=False, indent=2), encoding="utf-8")
    rows = readers.load_templates(spark, str(good)).orderBy("template_id").collect()
    assert [tuple(r) for r in rows] == [(0, "甲 {topic}", "file"), (1, "b", "file")]
    for name, text in {"x": "[]", "y": '{"a": 1}', "z": "no json"}.items():
        (tmp_path / name).write_text(text)
        got = readers.load_templates(spark, str(tmp_path / name))
        assert got.count() == 6 and {r.origin for r in got.collect()} == {"builtin"}
        with pytest.raises(ValueError):
            readers.load_templates(spark, str(tmp_path / name), fallback=None)
    assert readers.load_templates(spark, str(tmp_path / "missing")).count() == 6


def test_topics(spark, tmp_path):
    assert readers.topics(spark).count() == 16
    path = tmp_path / "t.json"
    path.write_text(json.dumps(["網路 - OSI/TCP-IP 模型 - x", "單獨", ""], ensure_ascii=False), encoding="utf-8")
    rows = readers.topics(spark, str(path)).orderBy("topic_id").collect()
    assert [(r.field, r.detail) for r in rows] == [("網路", "OSI/TCP-IP 模型 - x"), ("單獨", ""), ("", "")]


def test_response_files(spark, tmp_path):
    for name, text in {
        "round1_model_qwen a+b.txt": "line 1\nline 2", "round2_model_模型_x.txt": "m", "round1_model_模型_x.txt": "", "other.txt": "z",
    }.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    found = readers.read_response_files(spark, str(tmp_path))
    assert sorted((r.task_id, r.model, r.text) for r in found.collect()) == [
        (1, "qwen a+b", "line 1\nline 2"), (1, "模型_x", ""), (2, "模型_x", "m"),
    ]
    tasks = spark.createDataFrame([(1,), (2,)], "task_id LONG")
    grid = readers.with_missing_files(response_grid(tasks, ["qwen a+b", "模型_x"], found))
    assert sorted((r.task_id, r.model, r.text) for r in grid.collect()) == [
        (1, "qwen a+b", "line 1\nline 2"), (1, "模型_x", ""),
        (2, "qwen a+b", "No Output"), (2, "模型_x", "m"),
    ]


def test_train_log_and_run_config(spark, tmp_path):
    run = tmp_path / "checkpoint-100"
    run.mkdir()
    (run / "trainer_state.json").write_text(
        '{"epoch": 1.0, "log_history": [\n {"epoch": 0.1, "grad_norm": NaN, "learning_rate": 1e-4, "loss": 12.2,'
        ' "step": 10},\n {"epoch": 0.2, "step": 20, "eval_loss": 1.0}\n]}'
    )
    rows = readers.read_train_log(spark, str(tmp_path / "*" / "trainer_state.json")).orderBy("step").collect()
    assert [(r.run_id.endswith(tmp_path.name), r.step, r.loss) for r in rows] == [(True, 10, 12.2), (True, 20, None)]
    assert rows[0].grad_norm != rows[0].grad_norm
    (run / readers.ADAPTER_CONFIG).write_text(json.dumps(
        {"base_model_name_or_path": "base/x", "r": 8, "lora_alpha": 16, "target_modules": ["q"], "extra": {}}, indent=1
    ))
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / readers.ADAPTER_CONFIG).write_text(json.dumps({"base_model_name_or_path": None}))
    got = {r.run_id: r for r in readers.read_run_configs(spark, str(tmp_path / "*" / "adapter_config.json")).collect()}
    assert (got["checkpoint-100"].base_model, got["checkpoint-100"].r) == ("base/x", 8)
    assert got["plain"].base_model.endswith("/plain")


def test_runs_with_overlapping_checkpoints(spark, tmp_path):
    def state(folder, entries):
        folder.mkdir(parents=True)
        log = [{"step": s, "loss": x, "epoch": s / 10} if x is not None else {"step": s, "eval_loss": 1.0} for s, x in entries]
        (folder / "trainer_state.json").write_text(json.dumps({"log_history": log}, indent=1))

    for run, add in (("a b", 0.0), ("b", 100.0)):
        state(tmp_path / run / "checkpoint-90", [(10, 1.0 + add), (20, 2.0 + add), (20, None)])
        state(tmp_path / run / "checkpoint-100", [(10, 1.5 + add), (20, 2.5 + add), (20, None), (30, 3.5 + add)])
    state(tmp_path / "c", [(10, 7.0)])
    state(tmp_path / "c" / "checkpoint-5", [(10, 6.0), (5, 5.0)])
    path = str(tmp_path / "{*,*/checkpoint-*}" / "trainer_state.json")
    rows = sorted((r.run_id.rsplit("/", 1)[1], r.step, r.loss or 0.0) for r in readers.read_train_log(spark, path).collect())
    assert rows == [
        ("a b", 10, 1.5), ("a b", 20, 0.0), ("a b", 20, 2.5), ("a b", 30, 3.5),
        ("b", 10, 101.5), ("b", 20, 0.0), ("b", 20, 102.5), ("b", 30, 103.5), ("c", 5, 5.0), ("c", 10, 7.0),
    ]
    every = readers.train_states(spark, path)
    assert every.count() == 17 and {r.checkpoint for r in every.collect()} == {90, 100, 5, None}


def test_jsonl_round_trip(spark, tmp_path):
    row = ("題", "q", [{"role": "user", "content": "多\n行"}], None, None)
    schema = f"topic STRING, question STRING, messages {schemas.CHAT_MESSAGES}, keep BOOLEAN, reason STRING"
    df = spark.createDataFrame([row], schema)
    writers.write_jsonl(df, str(tmp_path / "a"))
    assert readers.read_jsonl(spark, str(tmp_path / "a"), schema).collect() == df.collect()
    text = spark.read.text(str(tmp_path / "a")).first().value
    assert "題" in text and "keep" not in text
    writers.write_jsonl(df, str(tmp_path / "b"), null_keys=True)
    assert '"keep":null' in spark.read.text(str(tmp_path / "b")).first().value


def test_csv_log_round_trip(spark, tmp_path):
    rows = [("a,\"b\"", 'multi\n"line"', "反斜線\\"), ("", "x", "\\\"y")]
    df = spark.createDataFrame(rows, "Topic STRING, Reason STRING, Question STRING")
    writers.write_csv_log(df, str(tmp_path / "log"))
    back = writers.read_csv_log(spark, str(tmp_path / "log"), df.schema.simpleString()[7:-1].replace(":", " "))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    writers.write_rounds(df, str(tmp_path / "rounds"), "csv")
    writers.write_rounds(df, str(tmp_path / "rounds"), "csv")
    assert writers.read_csv_log(spark, str(tmp_path / "rounds"), "Topic STRING, Reason STRING, Question STRING").count() == 4


def test_templates_and_responses_round_trip(spark, tmp_path):
    t = spark.createDataFrame([(0, "甲 {topic}", "seed")], "template_id INT, template STRING, origin STRING")
    writers.save_templates(t, str(tmp_path / "t"))
    assert writers.read_saved_templates(spark, str(tmp_path / "t")).collect() == t.collect()
    r = spark.createDataFrame([(1, "m", "x"), (1, "n", "y")], "task_id LONG, model STRING, text STRING")
    writers.write_responses(r, str(tmp_path / "r"))
    back = spark.read.parquet(str(tmp_path / "r")).select("task_id", "model", "text")
    assert sorted(back.collect()) == sorted(r.collect())
    only = back.where("model = 'm'")
    assert "PartitionFilters: [isnotnull(model" in only._jdf.queryExecution().toString()
