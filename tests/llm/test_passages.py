import glob
import os
import random
import time

import pytest

from examloom import session
from examloom.llm.blocks import without_repeated_passages
from examloom.llm.queries import QUERIES
from examloom.llm.suffixes import without_repeated_strings

from . import brute

SF = "/root/testdata/sf0.001"


def table(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def passages(seed, n=40):
    """Texts that share passages at random places, some with passages of their own repeated."""
    rng = random.Random(seed)
    vocabulary = ["a", "bb", "é", "ddd", "E,", "\U0001f600"] + ["w%d" % i for i in range(400)]
    fresh = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    shared = [fresh(rng.randrange(20, 60)) for _ in range(6)]
    out = []
    for d in range(n):
        own = fresh(rng.randrange(0, 30))
        for _ in range(rng.randrange(3)):
            own += rng.choice(shared) + fresh(rng.randrange(0, 20))
        out.append((d * 3 - 10, rng.choice([" ", "\n", "  "]).join(own)))
    return out + [(500, None), (501, ""), (502, " \t "), (503, "x " * 100), (504, "the same " * 30), (505, out[1][1])]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 0, "k") for d, t in rows], "doc_id long, text string, spans int, key string").repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_against_all_windows(spark, seed):
    import hashlib

    rows = passages(seed)
    got = without_repeated_passages(frame(spark, rows), length=12).collect()
    mine = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got}
    assert mine == brute.repeated_windows(rows, 12)
    text = dict(rows)
    for r in got:
        words = brute.words(text[r.doc_id])
        cut = [w for a, b in zip(r.spans[::2], r.spans[1::2]) for w in words[a:b]]
        assert len(cut) == r.n_removed


def test_passages_on_the_table(spark):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op4_substring_dedup"](spark, SF).collect()}
    assert got == brute.repeated_windows(table(spark))


def test_passages_of_odd_tables(spark):
    same = [(None, "a b c d e f"), (7, "x y z"), (7, "x y z")]
    df = spark.createDataFrame(same, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in without_repeated_passages(df, length=3).collect())
    assert got == [(0, 6, 0), (7, 3, 3), (7, 3, 3)]
    assert without_repeated_passages(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        without_repeated_passages(df, length=10, block=6)


@pytest.mark.parametrize("seed,length", [(1, 100), (2, 40), (3, 60)])
def test_strings_against_all_windows(spark, seed, length):
    import hashlib

    rows = passages(seed)
    got = without_repeated_strings(frame(spark, rows), length).collect()
    mine = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got}
    assert mine == brute.repeated_bytes(rows, length)


def test_strings_on_the_table(spark):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op5_suffix_array_dedup"](spark, SF).collect()}
    assert got == brute.repeated_bytes(table(spark))


def test_strings_of_odd_tables(spark):
    same = [(None, "q" * 30 + "abcdefghij" * 9), (7, "0123456789" * 4 + "tail"), (7, "0123456789" * 4 + "tail")]
    df = spark.createDataFrame(same, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in without_repeated_strings(df, 40).collect())
    # a document that repeats itself loses its later strings; rows shown twice are one
    assert got == [(0, 120, 80), (7, 44, 0), (7, 44, 0)]
    assert without_repeated_strings(df.limit(0)).count() == 0


def test_strings_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    """Room is needed for the tables and the step at work, not for all steps before it."""
    import hashlib

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for d in manager.localDirs() for f in glob.glob(f"{d}/*/shuffle_*") if os.path.getsize(f)}
    rows = passages(4)
    df, before = frame(spark, rows), files()
    cleaned = without_repeated_strings(df, 60)  # every table of the rounds is written by now
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left
    assert {os.path.basename(f).split("-")[0] for f in glob.glob(f"{tmp_path}/*")} == {"found", "families"}
    mine = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in cleaned.collect()}
    assert mine == brute.repeated_bytes(rows, 60)


def test_strings_of_documents_with_one_id(spark):
    """They count in the order of a hash of the text, also where only single starts repeat."""
    rng = random.Random(6)
    shared, own = ("".join(rng.choices("abcdefghij", k=k)) for k in (75, 4000))
    texts = [own[200 * i : 200 * i + 90 + i] + x + shared + x + own[200 * i + 110 : 200 * i + 190] for i, x in enumerate("ABCDEFGHIJKL")]
    df = spark.createDataFrame([(3, t) for t in texts * 2], "doc_id long, text string").repartition(5)
    keys = {t: k for t, k in df.selectExpr("text", "hash(text)").collect()}
    assert min(keys.values()) < 0 < max(keys.values())
    first = min(texts, key=keys.get)
    want = sorted((len(t), 0 if t == first else 75) for t in texts * 2)
    assert sorted((r.n_bytes, r.n_removed) for r in without_repeated_strings(df, 60).collect()) == want
