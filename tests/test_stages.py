import collections
import pathlib

import pytest
from pyspark.sql import functions as F

from examloom.operators import stages
from examloom.operators.logs import latency_log
from examloom.operators.records import assemble_record, flat_dataset, review_log, token_usage
from examloom.plans import flows
from examloom.plans.tasks import task_ids


def calls_of(folder):
    """Client calls as written by logging clients, one line per call."""
    found = collections.Counter()
    for f in pathlib.Path(folder).glob("*.log"):
        found.update(f.read_text(encoding="utf-8").splitlines())
    return found


def logging(folder, name, answer, fail=None):
    def factory():
        import uuid

        log = pathlib.Path(folder) / f"{uuid.uuid4().hex}.log"

        def ask(prompt):
            with log.open("a", encoding="utf-8") as f:
                f.write(f"{name}|{prompt.splitlines()[-1]}\n")
            if fail and fail in prompt:
                raise RuntimeError(f"{name} failed")
            return answer(prompt)

        return ask

    return factory


@pytest.fixture
def tasks(spark):
    return task_ids(spark, 40).select(
        "task_id", F.concat(F.lit("topic"), F.col("task_id").cast("string")).alias("topic"),
        F.lit("please").alias("prompt"),
    )


RULES = {f"{s}_rules": s for s in ("generator", "comment", "refine", "beautify", "review", "generate", "fix")}


def test_rich_chain_calls_every_client_once_and_resumes(spark, tasks, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    clients = {
        s: logging(log, s, lambda p, s=s: stages.Reply(f"{s} text", 7, 9))
        for s in ("generator", "refine", "beautify")
    }
    clients["comment"] = logging(log, "comment", lambda p: "c", fail=None)
    clients["review"] = logging(log, "review", lambda p: '{"keep": true, "reason": "ok"}')
    clients["generator"] = logging(
        log, "generator", lambda p: stages.Reply("generator text", 7, 9), fail="「topic7」"
    )
    path = str(tmp_path / "rich")
    quick = tuple(
        stages.Stage(**{**s.__dict__, "wait_s": 0.0, "tries": 2}) for s in stages.RICH_CHAIN
    )
    done = stages.run_stages(tasks.where("task_id <= 30"), quick, clients, RULES, "task_id", path)
    assert done.count() == 30 and done.count() == 30
    per_stage = collections.Counter(k.split("|")[0] for k in calls_of(log).elements())
    # a refused prompt costs one call, although the stage has two tries
    assert per_stage == {"generator": 30, "comment": 29, "refine": 29, "beautify": 29, "review": 29}
    more = stages.run_stages(tasks, quick, clients, RULES, "task_id", path)
    assert more.count() == 40
    more = spark.createDataFrame(more.collect(), more.schema)
    per_stage = collections.Counter(k.split("|")[0] for k in calls_of(log).elements())
    # ten new tasks, and the failed one again
    assert per_stage["generator"] == 41 and per_stage["review"] == 39

    clients["generator"] = logging(log, "generator", lambda p: stages.Reply("late text", 7, 9))
    healed = stages.run_stages(tasks, quick, clients, RULES, "task_id", path).where("task_id = 7").first()
    assert (healed.generator_text, healed.review_text is None, healed._error) == ("late text", False, None)

    records = assemble_record(more)
    failed = records.where("task_id = 7").first()
    assert (failed._error, failed.topic, failed.messages, failed.keep) == ("generator failed", "topic7", None, None)
    good = records.where("task_id = 8").first()
    assert good.keep is True and good.messages[1].content == "beautify text"
    assert good.meta.raw == "generator text" and good.tokens.generator_in == 9
    usage = {r.Topic: r for r in token_usage(records).collect()}
    assert usage["topic7"].TotalTokens == 0 and usage["topic7"].Keep is False
    assert usage["topic8"].Generator_out == 7 and usage["topic8"].Comment_out == 1
    assert len(token_usage(records).columns) == 15
    log_row = review_log(records).where("Topic = 'topic7'").first()
    assert tuple(log_row) == ("topic7", False, "generator failed", "")


def test_flat_chain(spark, tasks, tmp_path):
    def no(prompt):
        raise RuntimeError("down")

    clients = {
        "generate": lambda: lambda p: "  " if "topic3」" in p else "題目：x\n答案：B\n解析：why",
        "beautify": lambda: no,
        "review": lambda: lambda p: '{"decision":"rewrite","reason":"r","final_question":""}',
        "fix": lambda: lambda p: p.split("\n", 1)[1],
    }
    quick = tuple(stages.Stage(**{**s.__dict__, "wait_s": 0.0}) for s in stages.FLAT_CHAIN)
    flows_chain, flows.FLAT_CHAIN = flows.FLAT_CHAIN, quick
    try:
        flat = flows.generate_flat(tasks, clients, RULES, str(tmp_path / "flat"))
    finally:
        flows.FLAT_CHAIN = flows_chain
    row = flat.where("task_id = 1").first()
    assert (row.answer, row.explain, row.decision, row.reason) == ("B", "why", "rewrite", "r")
    assert row.final == row.original == "題目：x\n答案：B\n解析：why"
    blank = flat.where("task_id = 3").first()
    assert "topic3" in blank.original and blank.answer == "N/A"
    chat = flat_dataset(flat).where("topic = 'topic1'").first()
    assert [m.role for m in chat.messages] == ["user", "assistant"]


def test_retry_and_error_modes(spark):
    df = spark.createDataFrame([(1, "bad"), (2, "good")], "id INT, q STRING").coalesce(1)

    def flaky():
        seen = collections.Counter()

        def ask(prompt):
            seen[prompt] += 1
            if prompt == "bad" and seen[prompt] < 3:
                raise ConnectionError("busy")
            return f"{prompt} {seen[prompt]}"

        return ask

    def run(**kw):
        stage = stages.Stage("s", "{q}", **kw)
        return [tuple(r) for r in stages.apply_stage(df, stage, flaky).orderBy("id").select("s_text", "s_error").collect()]

    assert run(tries=3) == [("bad 3", None), ("good 1", None)]
    assert run(tries=2) == [(None, "busy"), ("good 1", None)]
    assert run(tries=3, retry_on=(KeyError,)) == [(None, "busy"), ("good 1", None)]
    assert run(tries=3, retry_on=(Exception,)) == [("bad 3", None), ("good 1", None)]
    assert run(tries=1, on_error="blank")[0] == ("", "busy")
    assert run(tries=1, on_error="passthrough", passthrough="q")[0] == ("bad", "busy")
    with pytest.raises(Exception, match="busy"):
        run(tries=1, on_error="raise")
    with pytest.raises(ValueError):
        run(on_error="other")


def test_tokens_and_timing(spark):
    def counting():
        seen = []

        def ask(prompt):
            seen.append(prompt)
            return str(len(seen))

        return ask

    df = spark.createDataFrame([(1, "a b c")], "id INT, q STRING")
    stage = stages.Stage("s", "{q}")
    row = stages.apply_stage(df, stage, lambda: lambda p: " x y ", timed=True, warm_up=True).first()
    assert (row.s_text, row.s_in, row.s_out) == ("x y", 3, 2) and row.s_latency_s >= 0
    calls = stages.apply_stage(df, stage, counting, timed=True, warm_up=True).first()
    assert calls.s_text == "2"
    row = stages.apply_stage(df, stage, lambda: lambda p: stages.Reply(None, 5, 6)).first()
    assert (row.s_text, row.s_in, row.s_out) == ("", 6, 5)


def test_replay(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, q STRING")
    stored = spark.createDataFrame(
        [(1, "reply", 3, 4, None)], "id INT, text STRING, in_tokens INT, out_tokens INT, error STRING"
    )
    rows = stages.replay_stage(df, stages.Stage("s", ""), stored, "id").orderBy("id").collect()
    assert (rows[0].s_text, rows[0].s_in, rows[0]._error) == ("reply", 3, None)
    assert (rows[1].s_text, rows[1]._error) == (None, "no stored reply")


def test_generate_responses_loads_models_one_at_a_time(spark, tmp_path):
    cells = spark.range(200).select(
        F.col("id").alias("task_id"), F.when(F.col("id") % 10 < 7, "hot").otherwise("cold").alias("model"),
        F.lit("p").alias("prompt"),
    )
    folder = str(tmp_path)

    def factory(model):
        import uuid

        (pathlib.Path(folder) / f"{uuid.uuid4().hex}.log").write_text(model + "\n")
        return lambda prompt: f"{model}:{prompt}"

    done = stages.generate_responses(cells, factory, partitions=4)
    rows = done.collect()
    assert len(rows) == 200 and all(r.text == f"{r.model}:p" and r.status == "ok" for r in rows)
    loads = calls_of(folder)
    assert loads["hot"] <= 4 and loads["cold"] <= 4


def test_generate_responses_resumes(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    cells = spark.range(20).select(
        F.col("id").alias("task_id"), F.lit("m").alias("model"), F.col("id").cast("string").alias("prompt")
    )
    make = logging(log, "m", lambda p: p)
    path = str(tmp_path / "responses")
    stages.generate_responses(cells.where("task_id < 12"), lambda model: make(), path=path)
    done = stages.generate_responses(cells, lambda model: make(), path=path)
    assert sorted((r.task_id, r.text) for r in done.collect()) == [(i, str(i)) for i in range(20)]
    assert set(calls_of(log).values()) == {1}


def test_generate_responses_failing_rows_are_data(spark):
    cells = spark.createDataFrame([(1, "m", "x"), (2, "m", "boom")], "task_id LONG, model STRING, prompt STRING")

    def factory(model):
        def ask(prompt):
            if prompt == "boom":
                raise RuntimeError("no")
            return prompt

        return ask

    rows = {r.task_id: (r.text, r.status) for r in stages.generate_responses(cells, factory).collect()}
    assert rows == {1: ("x", "ok"), 2: (None, "error")}


def test_augment_templates(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    path = str(tmp_path / "store")
    seeds = spark.createDataFrame([(0, "s {topic}")], "ordinal INT, template STRING")
    make = logging(log, "a", lambda p: '["new {topic}", "s {topic}", "no slot"]' if p == "seeds:\n- s {topic}\nwrite 4 {topic}" else "?")
    grow = lambda df, total, make=make, **kw: flows.augment_templates(
        df, make, "seeds:\n{seeds}\nwrite {per_template} {topic}", 4, total, path, **kw
    )
    assert sorted(r.template for r in grow(seeds, 10).collect()) == ["new {topic}", "s {topic}"]
    assert sum(calls_of(log).values()) == 1
    assert grow(seeds, 1).count() == 1 and grow(seeds, 10).count() == 2
    assert sum(calls_of(log).values()) == 1

    many = spark.createDataFrame([(i * 3, f"t{i} {{topic}}") for i in range(23)], "ordinal INT, template STRING").repartition(4)
    def answer(prompt):
        own = [x[2:] for x in prompt.splitlines() if x.startswith("- ")]
        if "t7 {topic}" in own:
            raise ValueError("refused")
        return "\n".join(f"* more of {x}" for x in own)

    path = str(tmp_path / "groups")
    log2 = tmp_path / "more"
    log2.mkdir()
    grown = grow(many, 40, logging(log2, "b", answer), seeds_per_prompt=5)
    texts = [r.template for r in grown.orderBy("template_id").collect()]
    asked = [i for i in range(23) if not 5 <= i < 10]
    assert texts == [f"t{i} {{topic}}" for i in range(23)] + [f"more of t{i} {{topic}}" for i in asked][:17]
    assert sum(calls_of(log2).values()) == 5


MODELS = ["m1", "m2", "m3"]


@pytest.fixture
def responses(tasks):
    return tasks.select("task_id", F.explode(F.array(*map(F.lit, MODELS))).alias("model")).withColumn(
        "text", F.concat_ws("-", "model", "task_id")
    )


def test_tournaments(spark, tasks, responses, tmp_path):
    def prefers_m2():
        def ask(prompt):
            parts = prompt.split("=== ")
            for part in parts:
                head, _, body = part.partition(" ===\n")
                if body.startswith("m2-"):
                    return f"Winner: {head.replace('Response ', '')}"
            return "Winner: Tie"

        return ask

    judged, board = flows.pairwise_tournament(
        responses, tasks, MODELS, prefers_m2, "{topic} {responses}", 1, str(tmp_path / "pairs")
    )
    rows = {r.model: r for r in board.collect()}
    assert (rows["m2"].wins, rows["m2"].matches, rows["m1"].ties, rows["m3"].wins) == (80, 80, 40, 0)
    assert judged.count() == 120

    _, board = flows.best_of_n_tournament(
        responses, tasks, MODELS, prefers_m2, "{responses}", 1, str(tmp_path / "best")
    )
    assert {r.model: r.wins for r in board.collect()} == {"m1": 0, "m2": 40, "m3": 0}

    def rates_by_text():
        def ask(prompt):
            out = "Final Ratings:\n"
            for part in prompt.split("=== Model ")[1:]:
                label, _, body = part.partition(" ===\n")
                if not body.startswith("m3"):
                    out += f"Model {label} Score: {body[1]}\n"
            return out

        return ask

    scores = flows.multi_judge(
        responses, tasks, MODELS, rates_by_text, "{responses}", 1, str(tmp_path / "multi")
    )
    assert {(r.model, r.score) for r in scores.collect()} == {("m1", 1), ("m2", 2), ("m3", -1)}
    assert scores.count() == 120


def test_two_arm_comparison(spark, responses, tmp_path):
    x, y = (responses.where(F.col("model") == m).select("task_id", "text") for m in ("m1", "m2"))

    def judge():
        def ask(prompt):
            a = "m1" in prompt.split("B:\n")[0]
            return "Score: 9\nScore: 4" if a else "Score: 4\nScore: 9"

        return ask

    rounds, totals = flows.two_arm_comparison(x, y, judge, "{responses}", 2, str(tmp_path / "two"))
    assert rounds.count() == 40 and tuple(totals.first()) == (40, 360, 160)

    def chooser():
        return lambda prompt: "Winner: A" if "m1" in prompt.split("B:\n")[0] else "Winner: B"

    _, totals = flows.two_arm_comparison(
        x, y, chooser, "{responses}", 2, str(tmp_path / "choice"), scored=False
    )
    assert tuple(totals.first()) == (40, 40, 0)


def test_an_interrupted_run_keeps_its_slices(spark, tmp_path):
    from functools import partial

    stored_once = partial(stages.stored_once, slice_rows=10)
    path = str(tmp_path / "store")
    todo = spark.range(40).select(F.col("id").alias("task_id"), F.lit("long text").alias("text"))
    asked = []

    def step(rows):
        if len(asked) == 2:
            raise RuntimeError("stopped")
        asked.append(rows.count())
        return rows.withColumns({"reply": F.lit("r"), "error": F.lit(None).cast("string")})

    with pytest.raises(RuntimeError):
        stored_once(todo, "task_id", path, step, F.col("error").isNotNull())
    before = list(asked)
    asked[:] = [0, 0, 0]
    done = stored_once(todo, "task_id", path, step, F.col("error").isNotNull())
    assert done.count() == 40 and sum(asked) == 40 - sum(before)
    assert "text" not in spark.read.parquet(path).columns


def test_a_killed_run_computes_its_input_once_and_asks_no_row_twice(spark, tmp_path):
    log, seen = tmp_path / "calls", tmp_path / "rows"
    log.mkdir(), seen.mkdir()
    folder = str(seen)

    @F.udf("string")
    def counted(i):
        import uuid

        (pathlib.Path(folder) / f"{uuid.uuid4().hex}.log").write_text(f"{i}\n")
        return f"prompt {i}"

    tasks = spark.range(60).select(F.col("id").alias("task_id"), counted("id").alias("q"))
    stage, path = stages.Stage("s", "{q}"), str(tmp_path / "store")
    make = logging(log, "s", lambda p: p.upper())
    runs, killed = [], []

    def ask(rows):
        runs.append(rows.count())
        if len(runs) == 4 and not killed:
            killed.append(True)
            raise RuntimeError("killed")
        return stages.apply_stage(rows, stage, make)

    todo = lambda df: stages.stored_once(df, "task_id", path, ask, F.col("s_error").isNotNull(), stages.stage_prompt(df, stage), slice_rows=15)
    with pytest.raises(RuntimeError, match="killed"):
        todo(tasks)
    assert all(n <= 15 for n in runs) and set(calls_of(seen).values()) == {1}
    lost = runs.pop()
    assert sum(calls_of(log).values()) == sum(runs) == 60 - lost
    done = todo(tasks)
    assert sorted((r.task_id, r.s_text) for r in done.collect()) == [(i, f"PROMPT {i}") for i in range(60)]
    assert set(calls_of(log).values()) == {1} and len(calls_of(log)) == 60
    assert set(calls_of(seen).values()) == {2}  # once in each run


def test_a_slice_has_no_more_files_than_tasks_and_is_planned_ahead(spark, tmp_path):
    path, folder, files = str(tmp_path / "store"), str(tmp_path), []

    @F.udf("string")
    def waits(i):  # the first slice ends only when the second one has been planned
        import time

        for _ in range(600):
            if (pathlib.Path(folder) / "second").exists():
                return "r"
            time.sleep(0.1)
        return "alone"

    def step(rows):
        files.append(len(rows.inputFiles()))
        if len(files) == 2:
            (tmp_path / "second").write_text("")
        return rows.withColumns({"reply": waits("task_id"), "error": F.lit(None).cast("string")})

    tasks = spark.sparkContext.defaultParallelism
    todo = spark.range(0, 200 * tasks, 1, 1).select(F.col("id").alias("task_id"))
    done = stages.stored_once(todo, "task_id", path, step, F.col("error").isNotNull(), slice_rows=100 * tasks)
    assert [r.reply for r in done.select("reply").distinct().collect()] == ["r"]
    assert files == [tasks, tasks] and done.count() == 200 * tasks


def test_a_changed_prompt_is_asked_again(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    make, path = logging(log, "m", lambda p: p), str(tmp_path / "responses")

    def run(prompts):
        cells = spark.createDataFrame(prompts, "task_id LONG, model STRING, prompt STRING")
        done = stages.generate_responses(cells, lambda model: make(), path=path)
        return sorted((r.task_id or 0, r.text or "") for r in done.collect())

    assert run([(1, "m", "a"), (2, "m", "b"), (None, "m", "n")]) == [(0, "n"), (1, "a"), (2, "b")]
    assert run([(1, "m", "a"), (2, "m", "c"), (None, "m", "n")]) == [(0, "n"), (1, "a"), (2, "c")]
    assert run([(2, "m", "b")]) == [(2, "b")]
    assert calls_of(log) == {"m|a": 1, "m|b": 1, "m|c": 1, "m|n": 1}
    assert run([(5, "m", "x"), (5, "m", "x"), (1, "m", "a")]) == [(1, "a"), (5, "x"), (5, "x")]
    assert run([]) == []


def test_batched_clients_and_calls_in_flight(spark, tmp_path):
    folder = str(tmp_path)

    class Many:
        def ask_many(self, prompts):
            import uuid

            (pathlib.Path(folder) / f"{uuid.uuid4().hex}.log").write_text(f"{len(prompts)}\n")
            if "p13" in prompts and len(prompts) == 1:
                raise RuntimeError("alone")
            return [ValueError("odd") if p.endswith("7") else stages.Reply(p + "!", 1, 2) for p in prompts]

    df = spark.range(40).select(F.col("id"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("q")).coalesce(1)
    got = stages.apply_stage(df, stages.Stage("s", "{q}", batch=16), Many).collect()
    assert {r.id: (r.s_text, r.s_error) for r in got} == {
        i: (None, "odd") if i % 10 == 7 else (f"p{i}!", None) for i in range(40)
    }
    assert calls_of(folder) == {"16": 2, "8": 1}
    short = stages.ask_all(type("Short", (), {"ask_many": lambda self, p: p[1:]})(), ["a", "b"], stages.Stage("s", ""))
    assert [r["error"] for r in short] == ["1 replies to 2 prompts"] * 2

    import threading

    now, most, lock = [0], [0], threading.Lock()

    def slow(prompt):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        import time

        time.sleep(0.02)
        with lock:
            now[0] -= 1
        if prompt == "3":
            raise RuntimeError("three")
        return prompt

    rows = stages.ask_all(slow, [str(i) for i in range(12)], stages.Stage("s", "", in_flight=4))
    assert [r["text"] for r in rows] == [None if i == 3 else str(i) for i in range(12)] and 1 < most[0] <= 4


def test_only_errors_of_the_server_are_tried_again(spark, tasks, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    state = tmp_path / "state"
    state.mkdir()

    def answer(prompt):
        name = prompt.splitlines()[-1].strip()
        if "topic5」" in name:
            raise ValueError("refused")
        if "topic6」" in name or "topic8」" in name:
            tries = state / ("6" if "topic6" in name else "8")
            n = int(tries.read_text()) if tries.exists() else 0
            tries.write_text(str(n + 1))
            if "topic8" in name or n < 2:
                raise stages.TryAgain("busy")
        return "text"

    clients = {s: logging(log, s, answer) for s in ("generator", "comment", "refine", "beautify")}
    clients["review"] = logging(log, "review", lambda p: '{"keep": true}')
    quick = tuple(stages.Stage(**{**s.__dict__, "wait_s": 0.0}) for s in stages.RICH_CHAIN)
    done = stages.run_stages(tasks, quick, clients, RULES, "task_id", str(tmp_path / "rich"))
    rows = {r.task_id: (r.review_text, r._error) for r in done.collect()}
    kept = '{"keep": true}'
    assert (rows[5], rows[6], rows[8], rows[9]) == ((None, "refused"), (kept, None), (None, "busy"), (kept, None))
    calls = {k.split("」")[0].rsplit("topic", 1)[-1]: n for k, n in calls_of(log).items() if k.startswith("generator|")}
    assert (calls["5"], calls["6"], calls["8"], calls["9"]) == (1, 3, 3, 1)
    assert not [c for c in done.columns if c.endswith("_again") or c == "_digest"]


def test_failed_rows_are_asked_again_and_other_rows_stay_out(spark, tmp_path):
    from examloom.operators.stages import stored_once

    path = str(tmp_path / "store")
    todo = spark.range(10).select(F.col("id").alias("task_id"))
    bad = F.when(F.col("task_id") % 2 == 0, F.lit("no"))
    run = lambda rows, error: stored_once(
        rows, "task_id", path, lambda x: x.withColumns({"reply": F.lit("r"), "error": error.cast("string")}), F.col("error").isNotNull()
    )
    assert run(todo, bad).where("error is not null").count() == 5
    assert run(todo, bad).count() == 10
    again = run(todo.where("task_id < 4"), F.lit(None))
    assert sorted((r.task_id, r.error) for r in again.collect()) == [(i, None) for i in range(4)]
    assert spark.read.parquet(path).where("task_id = 0").count() == 3


def test_a_missing_prompt_is_an_error(spark):
    df = spark.createDataFrame([(1, None), (2, "p")], "task_id LONG, q STRING")
    rows = df.withColumn("model", F.lit("m")).withColumnRenamed("q", "prompt")
    got = {r.task_id: r for r in stages.generate_responses(rows, lambda m: lambda p: p).collect()}
    assert (got[1].status, got[1].text) == ("error", None) and got[2].status == "ok"


def test_both_arms_of_a_round_are_timed_in_one_task(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    df = spark.createDataFrame([(i, f"t{i}", f"p{i}" if i else None) for i in range(12)], "task_id LONG, topic STRING, prompt STRING").repartition(3)
    arms = {"x": logging(log, "x", lambda p: p + "x"), "y": logging(log, "y", lambda p: p + "y", fail="p5")}
    done = stages.timed_arms(df, arms)
    rows = {r.round: r for r in latency_log(done, "x", "y").collect()}
    assert list(rows[1].asDict()) == ["round", "topic", "question_x", "question_y", "time_x", "time_y"]
    assert (rows[7].question_x, rows[7].question_y) == ("p7x", "p7y") and min(rows[7].time_x, rows[7].time_y) >= 0
    assert (rows[5].question_x, rows[5].question_y, rows[5].time_y) == ("p5x", None, None)
    assert tuple(rows[0])[2:] == (None, None, None, None)
    calls = calls_of(log)
    assert sum(calls.values()) == 2 * 11 + 2 * len({f.name for f in log.glob("*.log")}) // 2


def test_a_task_holds_a_bounded_piece_of_prompts():
    import pyarrow as pa

    prompts = ["x" * 100_000] * 100 + [None, "", "y" * (stages.PIECE_BYTES + 1), "z"]
    names = [str(k) for k in range(len(prompts))]
    pieces = list(stages._pieces((pa.array(names), pa.array(prompts))))
    assert [p for _, part in pieces for p in part] == prompts and [n for part, _ in pieces for n in part] == names
    assert all(sum(len(p or "") for p in part) <= stages.PIECE_BYTES for _, part in pieces if len(part) > 1)
    assert len(pieces) >= 4


def test_replies_of_pieces_are_in_order(spark):
    """Every prompt has its own reply when a batch is cut into pieces."""
    rows = spark.range(40).select("id", F.when(F.col("id") != 7, F.concat(F.repeat(F.lit("p"), 300_000), F.col("id").cast("string"))).alias("p"))
    done = stages.apply_stage(rows.coalesce(1), stages.Stage("s", "{p}"), lambda: lambda prompt: prompt[300_000:])
    found = {r.id: (r.s_text, r.s_in, r._error) for r in done.select("id", "s_text", "s_in", "_error").collect()}
    assert found == {k: (str(k), 1, None) if k != 7 else (None, None, stages.NO_PROMPT) for k in range(40)}
