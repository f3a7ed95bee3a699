import json
import random

import pandas as pd
from pyspark.sql import functions as F

from examloom.functions.text import json_indented
from examloom.operators import chat
from examloom.schemas import CHAT_MESSAGES, MCQ

DEFAULT = f"<|im_start|>system\n{chat.DEFAULT_SYSTEM}<|im_end|>\n"


def messages(spark, *lists):
    rows = [(i, [{"role": r, "content": c} for r, c in m] if m is not None else None)
            for i, m in enumerate(lists)]
    return spark.createDataFrame(rows, f"id INT, messages {CHAT_MESSAGES}").coalesce(1)


def test_to_messages(spark):
    mcq = {"stem": "幹", "options": {"A": "1", "B": "2", "C": "", "D": "4"}}
    rows = [
        (0, [], "q0", mcq), (1, [{"role": "user", "content": "x"}], "q1", None), (2, None, None, mcq),
        (3, [{"role": "a", "content": "x"}, {"role": "b", "content": "y"}], "q3", mcq),
    ]
    df = spark.createDataFrame(rows, f"id INT, messages {CHAT_MESSAGES}, question STRING, LLMans {MCQ}")
    out = {r.id: [tuple(m) for m in r.messages] for r in chat.to_messages(df, ("id",)).collect()}
    text = json.dumps(mcq, ensure_ascii=False, indent=2)
    assert out == {
        0: [("user", "q0"), ("assistant", text)], 1: [("user", "q1"), ("assistant", "")],
        2: [("user", ""), ("assistant", text)], 3: [("a", "x"), ("b", "y")],
    }
    assert chat.to_messages(df).columns == ["messages"]


def test_to_messages_of_texts_and_of_nothing(spark):
    flat = spark.createDataFrame([("q", "a")], "question STRING, LLMans STRING")
    assert [tuple(m) for m in chat.to_messages(flat).first().messages] == [("user", "q"), ("assistant", "a")]
    none = spark.createDataFrame([(1,)], "other INT")
    assert [tuple(m) for m in chat.to_messages(none).first().messages] == [("user", ""), ("assistant", "")]


def test_render_chat(spark):
    df = messages(
        spark,
        [("user", "u"), ("assistant", "a")],
        [("system", "s"), ("user", "u")],
        [("user", "u"), ("system", "late"), ("other", "x")],
        [],
        [("user", "u"), ("tool", "r1"), ("tool", "r2"), ("assistant", "a"), ("tool", "r3")],
    )
    texts = [r.text for r in chat.render_chat(df).collect()]

    def turn(role, content):
        return f"<|im_start|>{role}\n{content}<|im_end|>\n"

    def tool(content):
        return f"\n<tool_response>\n{content}\n</tool_response>"

    assert texts[0] == DEFAULT + turn("user", "u") + turn("assistant", "a")
    assert texts[1] == turn("system", "s") + turn("user", "u")
    assert texts[2] == DEFAULT + turn("user", "u") + turn("system", "late")
    assert texts[3] == DEFAULT
    assert texts[4] == (
        DEFAULT + turn("user", "u") + "<|im_start|>user" + tool("r1") + tool("r2") + "<|im_end|>\n"
        + turn("assistant", "a") + "<|im_start|>user" + tool("r3") + "<|im_end|>\n"
    )
    prompted = chat.render_chat(df, add_generation_prompt=True).first().text
    assert prompted == texts[0] + "<|im_start|>assistant\n"


def test_completion_span_is_after_the_last_marker(spark):
    df = messages(
        spark, [("user", "u"), ("assistant", "a1"), ("user", "v"), ("assistant", "題2")], [("user", "u")]
    )
    multi, none = chat.completion_span(chat.render_chat(df)).collect()
    assert multi.completion_text == "\n題2<|im_end|>\n"
    assert multi.prompt_text + multi.completion_text == multi.text
    assert multi.text[multi.start - 1 : multi.start - 1 + multi.length] == multi.completion_text
    assert (none.completion_text, none.length, none.prompt_text) == ("", 0, none.text)


def test_budget_with_own_counter(spark):
    df = spark.createDataFrame([("a b c",), ("a",)], "text STRING").coalesce(1)
    assert [r.over_budget for r in chat.flag_over_budget(df, 2).collect()] == [True, False]

    @F.pandas_udf("int")
    def chars(s: pd.Series) -> pd.Series:
        return s.str.len()

    assert [r.n_tokens for r in chat.flag_over_budget(df, 2, chars).collect()] == [5, 1]


def random_json(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind == 0:
        return rng.choice([None, True, False])
    if kind == 1:
        return rng.choice([0, -5, 12345678901, 1.5])
    if kind < 5:
        return "".join(rng.choice('ab"\\{}[],: \n\t題é') for _ in range(rng.randrange(9)))
    if kind == 5:
        return [random_json(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i} {rng.choice('x,}\"')}": random_json(rng, depth + 1) for i in range(rng.randrange(4))}


def test_indented_json_is_what_a_json_writer_gives(spark):
    rng = random.Random(3)
    values = [{}, [], {"a": {}}, {"a": [[], {}, [1]]}, *({"v": random_json(rng)} for _ in range(300))]
    rows = [(i, json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i INT, j STRING").withColumn("out", json_indented(F.col("j")))
    got = {r.i: r.out for r in df.collect()}
    assert got == {i: json.dumps(v, ensure_ascii=False, indent=2) for i, v in enumerate(values)}


def test_one_file_with_objects_texts_and_messages(spark):
    rng = random.Random(4)
    answers = [{"stem": "é", "options": {"B": "1", "A": []}}, '{"a": 1}', "plain\n題", {}, None, 5, True, [1, "x"]]
    answers += [random_json(rng) for _ in range(60)]
    lines = [json.dumps({"question": f"q{i}", "LLMans": a}, ensure_ascii=False) for i, a in enumerate(answers)]
    lines += ['{"question": "only"}', '{"LLMans": "x"}', '{"messages": [{"role": "a", "content": "b"}], "LLMans": {"z": 1}}']
    lines += [json.dumps({"messages": [{"role": "r", "content": c} for c in "ab"], "LLMans": "x"})]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i INT, value STRING")
    got = {r.i: [m.content for m in r.messages] for r in chat.messages_of_lines(df, ("i",)).collect()}

    def text(a):
        if isinstance(a, dict):
            return json.dumps(a, ensure_ascii=False, indent=2)
        return "" if a is None else a if isinstance(a, str) else json.dumps(a, ensure_ascii=False, separators=(",", ":"))

    for i, a in enumerate(answers):
        assert got[i] == [f"q{i}", text(a)]
    n = len(answers)
    assert [got[n + k] for k in range(4)] == [["only", ""], ["", "x"], ["", '{\n  "z": 1\n}'], ["a", "b"]]
