"""Whole-text searches against the line-by-line SQL on random texts full of borders."""

import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from examloom.functions import mcq
from examloom.functions.verdicts import parse_two_scores
from workloads import chat, cleaning, judging
from workloads.registry import sql_lines, sql_strip

PIECES = [
    "A", "b", "C", "d", "(", ")", ".", "題目", ":", "：", " ", "  ", "　", "\t", "\n", "\n\n", "\r\n", "\r",
    "\x0b", "\x1c", "\x1f", "\x85", " ", "x", "題", "答案", "解析", "答案：", "正確", "→", "y z", "mod", "1",
]
SCORE_PIECES = ["Score", "score", ":", " ", "\n", "\r", "\x85", "7", "10", "12", "0", "x", "　", "s"]


def texts(pieces, n, seed):
    rng = random.Random(seed)
    return pd.DataFrame(
        {"doc_id": range(n), "exam": ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(n)]}
    )


def compare(spark, data, sql, select):
    con = duckdb.connect()
    con.register("docs", data)
    expected = {r[0]: r[1:] for r in con.sql(sql).fetchall()}
    got = {r[0]: tuple(r)[1:] for r in select(spark.createDataFrame(data)).collect()}
    wrong = {k: (data.exam[k], got[k], expected[k]) for k in got if got[k] != expected[k]}
    assert not wrong and len(got) == len(expected), list(wrong.values())[:3]


def test_extraction(spark):
    def select(df):
        done = df.select("doc_id", mcq.extract_mcq(F.col("exam")).alias("q"))
        return done.select("doc_id", "q.stem", *[f"q.options.{k}" for k in "ABCD"])

    compare(spark, texts(PIECES, 20000, 1), cleaning.sql_extract("docs", "doc_id", "exam"), select)


def test_answer_lines(spark):
    sql = f"""SELECT doc_id, {cleaning._sql_labelled('答案')}, {cleaning._sql_labelled('解析')},
        {sql_strip(cleaning._KEPT_LINES)} FROM docs"""
    compare(
        spark,
        texts(PIECES, 8000, 2),
        sql,
        lambda df: df.select(
            "doc_id", mcq.answer_line(F.col("exam")), mcq.explain_line(F.col("exam")),
            mcq.strip_answer_lines(F.col("exam")),
        ),
    )


def test_scrub(spark):
    pieces = PIECES + ["以下", "內容", "這", "版本", "###", "$", "`", "the correct answer is", "Correct", "\\pmod"]
    compare(
        spark,
        texts(pieces, 8000, 3),
        f"SELECT doc_id, {cleaning.sql_scrub('exam')} FROM docs",
        lambda df: df.select("doc_id", mcq.scrub_mcq(F.col("exam"))),
    )


def test_two_scores(spark):
    sql = f"""SELECT doc_id, coalesce(v[1], -1), coalesce(v[2], -1) FROM (SELECT doc_id,
        list_filter(list_transform({sql_lines('exam')}, lambda s: {judging._LINE_SCORE}),
        lambda v: v BETWEEN 1 AND 10) AS v FROM docs)"""

    def select(df):
        return df.select("doc_id", parse_two_scores(F.col("exam")).alias("s")).select("doc_id", "s.*")

    compare(spark, texts(SCORE_PIECES, 8000, 4), sql, select)


def test_token_counts(spark):
    from examloom.functions.text import ws_tokens
    from workloads.registry import sql_tokens

    assert chat.BUDGET > 0
    compare(
        spark,
        texts(PIECES, 4000, 5),
        f"SELECT doc_id, {sql_tokens('exam')} FROM docs",
        lambda df: df.select("doc_id", ws_tokens(F.col("exam"))),
    )
