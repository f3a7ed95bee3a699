import math

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as P
from examloom.llm.queries import QUERIES

from . import brute
from .test_pairs_and_packing import check_pieces

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").selectExpr("cast(item_id as string)", "text").collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            pieces = out.collect()
            check_pieces(sorted(before.items()), pieces, 4096)
            # No packing can do with fewer sequences than the tokens fill; 0.002 of the room may stay empty.
            least = math.ceil(sum(r.length for r in pieces) / 4096 / (1 - 0.002))
            assert len({r.sequence_id for r in pieces}) <= least
            break
        assert sorted(out.columns) == sorted(COLUMNS)
        after = {r.doc_id: r.text for r in out.collect()}
        assert out.where(F.length("text") != F.col("n_chars")).count() == 0
        if name == "quality_classifier":
            kept = {r.doc_id for r in QUERIES["op10_quality_classifier"](spark, SF).where("predicted = 1").collect()}
            assert after == {d: t for d, t in before.items() if d in kept}
        elif name == "line_dedup":
            gone = brute.similar_lines(before.items())
            want = {d: "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone) for d, t in before.items()}
            assert after == {d: t for d, t in want.items() if brute.words(t) or t == before[d]}
        elif name == "minhash_near_dedup":
            classes = brute.classes(list(before.items()), P.PERCENT)
            assert after == {d: t for d, t in before.items() if classes[d][1] == d}
        else:
            hits = brute.contamination(list(before.items()), items)
            assert after == {d: t for d, t in before.items() if not hits[d][1]}
        docs, before = out, after


def test_near_duplicates_meet_their_stage(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (2, text + " more"), (3, "something else entirely, on its own here"), (4, None), (5, ""), (None, text)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in P.near_dup_stage(spark, docs, SF).collect()} == {1, 3, 4, 5, None}


def tables(spark, tmp_path, docs):
    """A folder with these documents and two labels and one benchmark item."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    item = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), item


def test_stages_keep_rows_that_share_an_id_and_clashing_columns(spark, tmp_path):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(80))
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, text(1)), (5, text(1)), (5, text(2)), (5, text(3)), (None, text(2)), (None, text(4)), (6, f"{text(6)} {item}"), (6, text(7)), (8, None)]
    extra = "quality_score double, n_lines string, n_removed int, digest string, row_key string, held string"
    docs = spark.createDataFrame(
        [(d, t, "en", "s", len(t or ""), 0.5, "a", 3, "d", "k", "h") for d, t in rows],
        f"doc_id long, text string, lang string, source string, n_chars long, {extra}",
    )
    sf, _ = tables(spark, tmp_path, docs)
    texts = lambda df: sorted((r.doc_id or 0, r.text or "") for r in df.collect())
    given = sorted((d or 0, t or "") for d, t in rows)
    for stage, gone in (
        (P.near_dup_stage, {(5, text(1))}), (P.benchmark_stage, {(6, rows[6][1])}), (P.quality_stage, set()),
    ):
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        assert texts(out) == [r for r in given if r not in gone]
        assert {tuple(r)[5:] for r in out.collect()} == {(0.5, "a", 3, "d", "k", "h")}
    out = P.line_stage(spark, docs, sf)
    assert out.columns == docs.columns and {tuple(r)[5:] for r in out.collect()} == {(0.5, "a", 3, "d", "k", "h")}
    assert {r.text for r in out.collect()} == {t for _, t in rows}


def test_run_is_its_stages(spark):
    got = P.run(spark, SF)
    assert got.count() > 0
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    assert public_tokenizers.path("word_bpe_49k.json").endswith(".json")
