from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from examloom.functions import text as t


def as_line_feeds(text):
    ended = text != "" and len((text + "x").splitlines()) > len(text.splitlines())
    return "\n".join(text.splitlines()) + ("\n" if ended else "")


def test_breaks(apply):
    cases = ["a\x0bb\x0cc\x1cd\x85e f\r\ng\rh\n", "a\n\n", "", "a", "\n", "a\u2028b\u2029"]
    assert apply(t.one_break, cases) == [as_line_feeds(c) for c in cases]
    assert apply(t.raw_lines, ["a\r\nb\x0b", "", None]) == [["a", "b", ""], [""], None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \n\r\t\x0b\x1c\x85 　ab題é", max_size=12), min_size=40, max_size=80))
def test_breaks_strip_tokens_match_python(apply, values):
    assert apply(t.one_break, values) == [as_line_feeds(v) for v in values]
    assert apply(t.strip, values) == [v.strip() for v in values]
    assert apply(t.ws_tokens, values) == [len(v.split()) for v in values]
    assert apply(t.is_blank, values) == [not v.strip() for v in values]


def test_ws_tokens_null(apply):
    assert apply(t.ws_tokens, [None]) == [0]


def test_keyed_index_is_stable_and_in_range(spark):
    df = spark.range(2000).select(t.keyed_index(7, 1, "x", F.col("id")).alias("i"), "id")
    first = {r.id: r.i for r in df.collect()}
    again = {r.id: r.i for r in df.repartition(13).collect()}
    assert first == again
    counts = [list(first.values()).count(k) for k in range(7)]
    assert sum(counts) == 2000 and min(counts) > 200
    other = {r.i for r in spark.range(50).select(t.keyed_index(7, 2, "x", F.col("id")).alias("i")).collect()}
    assert other == set(range(7))


def test_log_forms(apply):
    assert apply(t.log_text, ["a\nb", "x" * 10001]) == ["a\\nb", "x" * 10001]
    assert apply(lambda c: t.log_text(c, 3), ["a\nb", "wxyz"]) == ["a\\n", "wxy"]
    assert apply(lambda c: t.log_excerpt(c, 200), ["a\nb", "y" * 201]) == ["a b...", "y" * 200 + "..."]


CLOSERS = ['{"a":1}]', '{"a":1}],[', "1],[2", '{"a":1},"end":1', '1,"end":1}', '{"a":1}}', '{"a":1},', ',{"a":1}', ""]


def test_json_that_closes_its_wrapper(apply):
    assert apply(t.is_json, CLOSERS) == [False] * len(CLOSERS)
    whole = ['{"a":1,"a":2}', "[]", "1", '"x]"', "null", '{"end":{"value":1}}', " [1] "]
    assert apply(t.is_json, whole) == [True] * len(whole)


def test_model_name(apply):
    paths = ["/m/qwen-a/", "qwen-b", "a/b\\/", "x/y//"]
    assert apply(t.model_name, paths) == ["qwen-a", "qwen-b", "b", "y"]


def test_rate_str(apply):
    assert apply(t.rate_str, [0.0, 33.3333333, 6.25, 100.0], "c DOUBLE") == [
        "0.0%", "33.3%", "6.2%", "100.0%",
    ]
