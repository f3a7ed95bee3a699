import collections
import hashlib
import math
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from examloom.llm.queries import QUERIES
from examloom.llm.resample import Resampling, hashed_runs, numbered_words, resampled
from examloom.llm.rows import ranked
from tests.llm.brute import bench_words

SF = "/root/testdata/sf0.001"


def runs(text, orders):
    w = bench_words(text)
    return [" ".join(w[i : i + n]).encode() for n in range(1, orders + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, p):
    """(doc_id, n_words, n_features, weight, score, rank) of each row, by dictionaries."""
    corpus = collections.Counter(zlib.crc32(r) % p.buckets for _, t in docs for r in runs(t, p.orders))
    aim = collections.Counter(zlib.crc32(r) % p.buckets for t in target for r in runs(t, p.orders))
    s_all, t_all = sum(corpus.values()), sum(aim.values())
    rows = []
    for d, text in docs:
        own = [zlib.crc32(r) % p.buckets for r in runs(text, p.orders)]
        weight = sum(
            math.floor(1000 * math.log((aim[b] + 1) * (s_all + p.buckets) / ((corpus[b] + 1) * (t_all + p.buckets)))) for b in own
        )
        h = int(hashlib.sha256(f"{p.seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((d, len(bench_words(text)), len(own), weight, score))
    fit = [r for r in rows if r[1] >= p.least_words]
    fit.sort(key=lambda r: (-r[4], r[0] is None, r[0], r[2], r[3]))
    drawn = len(fit) * p.percent // 100
    left = collections.Counter()
    out = [(*r, k + 1 if k < drawn else None) for k, r in enumerate(fit)]
    left.update(out)
    left.update((*r, None) for r in rows if r[1] < p.least_words)
    return left


def found(spark, docs, target, p):
    d = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, weight string, place int").repartition(3)
    t = spark.createDataFrame([(x, "y") for x in target], "text string, bucket string")
    return collections.Counter(tuple(r) for r in resampled(d, t, p).collect())


TEXTS = [
    "The cat, the dog: the CAT.", "", None, "...", "Éa é x 12a3", "a", "one two three four five six seven eight nine ten", "a b\x00c\x7fd", "cat dog cat dog cat dog",
]


@pytest.mark.parametrize("orders", [1, 2, 3])
def test_against_brute_force(spark, orders):
    docs = [(k, t) for k, t in enumerate(TEXTS)] + [(3, "cat dog the cat"), (3, "cat dog the cat"), (None, "the dog"), (None, None)]
    docs += [(100 + k, f"w{k % 7} w{k % 5} cat w{k % 3} dog {'the ' * (k % 4)}") for k in range(60)] + [(900, "very long " * 30_000)]
    p = Resampling(orders=orders, buckets=97, percent=30, least_words=3)
    target = ["the cat the dog", None, "", "w1 w2 cat"]
    assert found(spark, docs, target, p) == plain(docs, target, p)


def test_empty_tables(spark):
    p = Resampling(buckets=11, least_words=1, percent=50)
    assert not found(spark, [], ["a"], p)
    docs = [(1, "a b"), (2, "c")]
    assert found(spark, docs, [], p) == plain(docs, [], p)
    assert found(spark, [(1, None), (None, "")], [None], p) == plain([(1, None), (None, "")], [None], p)


def test_runs_end_with_their_text():
    texts = pa.array(["a b", "c", None, "", "b c d"])
    words, number, borders = numbered_words(texts)
    assert [words[k] for k in number] == [b"a", b"b", b"c", b"b", b"c", b"d"] and borders.tolist() == [0, 2, 3, 3, 3, 6]
    for order, (crc, number, borders) in enumerate(hashed_runs(texts, 4), 1):
        own = [crc[number[a:b]].tolist() for a, b in zip(borders, borders[1:])]
        assert own == [[zlib.crc32(r) for r in runs(t, order) if r.count(b" ") == order - 1] for t in texts.to_pylist()]


def test_places_over_partitions(spark):
    rows = spark.range(0, 5000, 1, 7).withColumn("v", F.col("id") % 13)
    got = ranked(rows, [F.desc("v"), F.col("id")]).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, 5001))
    assert [(r.v, r.id) for r in got] == sorted(((k % 13, k) for k in range(5000)), key=lambda x: (-x[0], x[1]))


def test_query_on_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = collections.Counter((r[0], *r[2:]) for r in plain(docs, target, Resampling()))
    assert collections.Counter(tuple(r) for r in QUERIES["op11_importance_resampling"](spark, SF).collect()) == expected
