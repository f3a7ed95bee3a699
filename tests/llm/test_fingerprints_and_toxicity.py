import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from examloom.llm import fingerprints as P
from examloom.llm.queries import QUERIES
from examloom.llm.toxicity import fit_ordinal, fit_severity, severities

SF = "/root/testdata/sf0.001"


def prints(spark, rows):
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, identity string").repartition(3)
    return P.fingerprints(df, ["doc_id"])


def test_order_equality_and_increments(spark):
    rows = [(1, "a b c\nd e\nf g"), (2, "f g\na b c\nd e"), (3, "a b c\nd e"), (4, "f g"), (5, None), (6, ""), (7, "a b c\na b c"),
            (8, "a b c"), (None, "a b c"), (9, "\n\na b c\n"), (10, "w " * 50_000)]
    found = prints(spark, rows)
    text = {r.doc_id: r.t for r in found.select("doc_id", P.as_text(F.col("identity"), F.col("content")).alias("t")).collect()}
    assert len(text) == len(rows)
    assert text[1] == text[2] and text[5] == text[6] and text[8] == text[None] == text[9]
    assert len({text[k] for k in (1, 3, 4, 5, 7, 8, 10)}) == 7
    assert {len(t) for t in text.values()} == {8 * (16 + 128)}
    x, y, z = (found.where(f"doc_id = {k}").select(F.col("identity").alias(f"i{k}"), F.col("content").alias(f"c{k}")) for k in (1, 3, 4))
    row = x.join(y).join(z).select(
        (P.added(F.col("i3"), F.col("i4")) == F.col("i1")).alias("a"), (P.removed(F.col("i1"), F.col("i4")) == F.col("i3")).alias("b"),
        (P.content_added(F.col("c3"), F.col("c4")) == F.col("c1")).alias("c"), (P.content_removed(F.col("c1"), F.col("c4")) == F.col("c3")).alias("d"),
    ).first()
    assert all(row)


def test_rows_of_one_key_are_one_document(spark):
    parts = prints(spark, [(1, "a b"), (1, "c d")]).collect()
    whole = prints(spark, [(1, "c d\na b")]).collect()
    assert parts == whole
    assert prints(spark, []).count() == 0


def test_next_ids(spark):
    ids = [5, -3, 100, 7, 8, 9, 2**40]
    got = {r.k: r.next_key for r in P.next_ids(spark.createDataFrame([(i,) for i in ids], "k long"), "k", 4).collect()}
    down = sorted(ids, reverse=True)
    assert got == dict(zip(down, down[1:] + down[:1]))
    one = P.next_ids(spark.createDataFrame([(4,)], "k long"), "k").collect()
    assert [(r.k, r.next_key) for r in one] == [(4, 4)]
    assert P.next_ids(spark.createDataFrame([], "k long"), "k").count() == 0


def test_rows_without_an_id_of_their_own(spark, tmp_path):
    rows = [(3, "abc def"), (2, "abcdef g"), (2, "xyz uvw"), (2, "xyz uvw"), (None, "first one"), (None, None), (1, "")]
    spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, key string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op2_document_fingerprints"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == sorted((d or 0, len(t or "")) for d, t in rows)
    assert len({r.fingerprint for r in got if (r.doc_id, r.n_chars) == (2, 7)}) == 1
    three = next(r for r in got if r.doc_id == 3)
    ends = {hashlib.sha256(f"abc d{t[:2]}".encode()).hexdigest() for d, t in rows if d == 2}
    assert three.edited_sha256 in ends


def test_query_on_the_table(spark):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in QUERIES["op2_document_fingerprints"](spark, SF).collect()}
    assert len(got) == len(docs)
    by_print = {}
    for (d, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (sorted(filter(None, text.split("\n"))) == sorted(filter(None, edited.split("\n"))))
        by_print.setdefault(r.fingerprint, set()).add(tuple(sorted(filter(None, text.split("\n")))))
        if text == after:
            assert r.near_next == 1
    assert all(len(v) == 1 for v in by_print.values())
    near = np.mean([r.near_edited for r in got.values()]), np.mean([r.near_next for r in got.values()])
    assert near[0] > 0.5 > 0.2 > near[1]


def test_severity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op6_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("toxic", "label"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.toxic == (r.label > 0) for r in held) >= 0.93 * len(held)
    assert np.mean([r.expected_severity for r in held if r.label]) > 0.5 > 0.1 > np.mean([r.expected_severity for r in held if not r.label])
    assert {r.grade for r in rows} <= {0, 1, 2, 3}


def test_severity_of_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, "idiot"), (4, "fine " * 50_000), (None, "idiot"), (6, "fine")]
    docs = spark.createDataFrame([(d, t, 0.5) for d, t in rows], "doc_id long, text string, grade double")
    labels = spark.createDataFrame([(3, 1), (3, 1), (4, 0), (6, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    got = severities(docs, fit_severity(docs, labels)).collect()
    assert len(got) == 6 and all(0 <= r.expected_severity <= 3 for r in got)
    none = severities(docs, fit_severity(docs, labels.limit(0))).collect()
    assert all(r.grade == 0 and not r.toxic for r in none)
    assert severities(docs.limit(0), fit_severity(docs.limit(0), labels)).count() == 0


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 600)
    lists = [np.sort(rng.choice(20, 3, replace=False)) if g == 0 else np.concatenate([np.sort(rng.choice(20, 3, replace=False)), 20 + np.arange(g)]) for g in grade]
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    w, cuts = fit_ordinal(at, np.concatenate(lists), grade, 4, 23)
    assert (np.diff(cuts) > 0).all()
    score = np.array([w[x].sum() for x in lists])
    got = (score[:, None] > cuts[None, :]).sum(axis=1)
    assert (got == grade).mean() > 0.95


@pytest.mark.parametrize("name", ["op2_document_fingerprints"])
def test_native_plan(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
