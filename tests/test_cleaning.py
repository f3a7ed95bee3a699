import pytest
from pyspark.sql import functions as F

from examloom import schemas
from examloom.operators import cleaning
from examloom.sources.readers import SUBJECT_TEMPLATES, read_jsonl

RECORDS = """
{"topic":"t1","question":"q1","messages":[{"role":"user","content":"u"},{"role":"assistant","content":" 題目：s\\n(A) x "}],"keep":true,"reason":"fine"}
{"topic":"t2","question":"q2","messages":[{"role":"user","content":"u"},{"role":"assistant","content":"m"}],"keep":true,"content":"c wins"}
{"topic":"t3","question":"q3","keep":false,"reason":"bad"}
{"topic":"t4","question":"q4"}
{"_error":"boom","topic":"t5"}
{"topic":"t6","keep":true}
{"topic":"t7","keep":true,"messages":[{"role":"user","content":"only"}]}
{"topic":"t8","keep":"false","content":"text flag"}
{"topic":"t9","keep":1,"content":"number flag"}
""".strip()


@pytest.fixture
def records(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text(RECORDS + "\n", encoding="utf-8")
    return lambda schema=schemas.GEN_RECORD: read_jsonl(spark, str(tmp_path / "r.jsonl"), schema)


def reasons(df, mode):
    return {r.topic: r.drop_reason for r in cleaning.classify(df, mode).collect()}


UNREADABLE_NONE = "題目內容無法讀取：'缺少 content 或 messages 欄位'"
UNREADABLE_SHORT = "題目內容無法讀取：list index out of range"


def test_strict_gate(records):
    assert reasons(records(), "strict") == {
        "t1": None, "t2": None, "t3": "bad", "t4": "keep = false", "t5": "keep = false",
        "t6": UNREADABLE_NONE, "t7": UNREADABLE_SHORT, "t8": "keep = false", "t9": "keep = false",
    }


def test_truthy_gate(records):
    got = reasons(records(schemas.GEN_RECORD_VARIANT_KEEP), "truthy")
    assert got["t8"] is None and got["t9"] is None
    assert got["t3"] == "bad" and got["t4"] == "keep = false"


def test_split_is_complete_and_disjoint(records):
    clean, removed = cleaning.split_keep_removed(records())
    rows = {r.question: r.LLMans for r in clean.collect()}
    assert set(rows) == {"q1", "q2"}
    assert rows["q1"].stem == "s" and tuple(rows["q1"].options) == ("x", "", "", "")
    # A stem line starting with the letter c is an option line.
    assert rows["q2"].options.C == "wins"
    assert clean.count() + removed.count() == 9
    by_reason = {r.reason for r in removed.collect()}
    assert "bad" in by_reason and UNREADABLE_NONE in by_reason
    whole = removed.where("reason = 'bad'").first().content
    assert whole == '{"topic":"t3","question":"q3","keep":false,"reason":"bad"}'


def test_gate_counts(records):
    counts = cleaning.gate_counts(cleaning.classify(records()))
    assert {(r.kept, r.drop_reason): r.n_rows for r in counts.collect()} == {
        (True, ""): 2, (False, "bad"): 1, (False, "keep = false"): 4,
        (False, UNREADABLE_NONE): 1, (False, UNREADABLE_SHORT): 1,
    }


def test_judge_gate_and_flat_split(spark):
    df = spark.createDataFrame(
        [(1, "a - b", "q\n答案：A"), (2, "a", "r"), (3, "x", "s")], "id INT, topic STRING, full STRING"
    )
    replies = spark.createDataFrame(
        [(1, '{"keep": true, "reason": "ok"}'), (2, "broken")], "id INT, reply STRING"
    )
    gated = cleaning.judge_gate(df, replies, "id")
    clean, removed = cleaning.split_flat(gated, list(SUBJECT_TEMPLATES), 3, "id")
    assert [(r.id, r.LLMans) for r in clean.collect()] == [(1, "q")]
    prompt = clean.first().question
    assert prompt in {t.replace("{subject}", "資訊工程a") for t in SUBJECT_TEMPLATES}
    assert sorted((r.id, r.reason, r.content) for r in removed.collect()) == [
        (2, "審查模型錯誤", "r"), (3, "審查模型錯誤", "s"),
    ]


def test_resolve_review_accepts_on_failure(spark):
    rows = [
        (None, True), ("no json", False), ('{"decision":"rewrite","reason":"r","final_question":"F"}', False),
        ('{"decision":"accept","reason":"r","final_question":""}', False), ('{"final_question":"G"}', False),
    ]
    df = spark.createDataFrame(rows, "reply STRING, failed BOOLEAN").coalesce(1)
    out = df.select(
        cleaning.resolve_review(F.col("reply"), F.lit("T"), F.col("failed")).alias("r")
    ).collect()
    assert [tuple(r.r) for r in out] == [
        ("accept", "error", "T"), ("accept", "JSON parse error", "T"), ("rewrite", "r", "F"),
        ("accept", "r", "T"), (None, None, "G"),
    ]


def test_dedup_exact_with_a_hot_text(spark):
    df = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("t")
    )
    kept = cleaning.dedup_exact(df, "t", "id")
    assert kept.count() == 2001
    assert [r.id for r in kept.where("t = 'same'").collect()] == [0]
