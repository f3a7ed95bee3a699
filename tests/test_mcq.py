import pytest

from examloom.functions import mcq


def question(apply, text, strict=False):
    row = apply(lambda c: mcq.extract_mcq(c, strict), [text])[0]
    return row.stem, tuple(row.options)


QUESTION = "題目：堆疊的特性？\n(A) LIFO\n(B) FIFO\n(C) 隨機\n(D) 優先\n答案：A\n解析：後進先出"


def test_scrub_removes_title_answer_and_explanation(apply):
    out = apply(mcq.scrub_mcq, [QUESTION])[0]
    assert out == "堆疊的特性？\n(A) LIFO\n(B) FIFO\n(C) 隨機\n(D) 優先\n\n"
    assert question(apply, out) == ("堆疊的特性？", ("LIFO", "FIFO", "隨機", "優先"))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("(B) $O(\\log n)$ ← 正確", "(B) O(\\log n)  正確"),
        ("Q?\n(A) x (correct)\n(B) y", "Q?\n\n(B) y"),
        ("(A) 這是 correct 的 (x) 尾", " 尾"),
        ("答案：X\rY", ""),
        ("正確答案: B\nnext", "\nnext"),
        ("### 題目 z", "z"),
        ("以下是內容： rest", "rest"),
        ("這個版本 rest", "rest"),
        ("x The Correct Answer is B\ny", "x \ny"),
        ("k \\pmod N ✓★", "k mod N "),
        ("```code```", "code"),
    ],
)
def test_scrub_cases(apply, text, expected):
    assert apply(mcq.scrub_mcq, [text]) == [expected]


def test_bracket_rule_takes_the_label(apply):
    assert apply(mcq.scrub_mcq, ["(A) this is correct (x) end"]) == [" end"]


def test_strict_scrub_keeps_the_label(apply):
    out = apply(lambda c: mcq.scrub_mcq(c, strict=True), ["Q?\n(A) x (correct)\n(B) y"])[0]
    assert question(apply, out, strict=True) == ("Q?", ("x", "y", "", ""))


def test_option_verdict_is_cut(apply):
    scrubbed = apply(mcq.scrub_mcq, ["(B) $O(\\log n)$ ← 正確"])[0]
    assert question(apply, scrubbed)[1] == ("", "O(\\log n)", "", "")


def test_any_line_starting_like_an_option_counts(apply):
    assert question(apply, "Binary search 的複雜度？") == (
        "", ("", "inary search 的複雜度？", "", ""),
    )
    assert question(apply, "Binary search 的複雜度？", strict=True) == (
        "Binary search 的複雜度？", ("", "", "", ""),
    )


def test_first_option_wins_and_stem_ends_at_it(apply):
    text = "題 x\nline2\n(A) a1\ncont\nB. b1\n(A) dup\nc) c1\nD d1\n(A) late"
    assert question(apply, text) == ("題 x line2", ("a1", "b1", "ont", "d1"))


def test_no_options_and_no_text(apply):
    assert question(apply, "only\n\nstem") == ("only stem", ("", "", "", ""))
    assert question(apply, "") == ("", ("", "", "", ""))


def test_title_is_removed_per_line(apply):
    assert question(apply, "  題目： e\n題目:f\n(A) x") == ("e f", ("x", "", "", ""))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("k mod N + 1", "((k mod N) + 1)"),
        ("令k mod N + 1", "令k mod N + 1"),
        ("k \\pmod N+1", "((k mod N) + 1)"),
        ("k mod N + 12", "k mod N + 12"),
    ],
)
def test_normalize_option(apply, text, expected):
    assert apply(mcq.normalize_option, [text]) == [expected]


def test_answer_lines(apply):
    text = "q\n答案：B \n解析： why\n答案：C"
    assert apply(mcq.answer_line, [text, "none"]) == ["B", "N/A"]
    assert apply(mcq.explain_line, [text, "none"]) == ["why", "N/A"]
    assert apply(mcq.strip_answer_lines, [" q\n答案：B\nx 答案：C\n解析z\n"]) == ["q\nx 答案：C"]


def test_subjects(apply):
    topics = ["資料結構 - 陣列(Array)", "計算機網路 - OSI/TCP-IP 模型", "單獨", ""]
    assert apply(mcq.subject_prefixed, topics) == [
        "資訊工程資料結構", "資訊工程計算機網路", "資訊工程", "資訊工程",
    ]
    assert apply(mcq.subject, topics) == ["資料結構", "計算機網路", "單獨", "資料結構"]


def test_mcq_json_matches_python(spark):
    import json

    from pyspark.sql import functions as F

    from examloom.schemas import MCQ

    options = {"A": 'q"uo\\te', "B": "tab\there", "C": "題目\n二", "D": ""}
    value = {"stem": "幹 a/b", "options": options}
    df = spark.createDataFrame([(value,)], f"m {MCQ}")
    out = df.select(mcq.mcq_json(F.col("m")).alias("j")).first().j
    assert out == json.dumps(value, ensure_ascii=False, indent=2)
