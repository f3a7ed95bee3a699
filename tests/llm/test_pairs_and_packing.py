import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from examloom.llm import arrays as A
from examloom.llm.components import components
from examloom.llm.decontaminate import contamination
from examloom.llm.features import quality_features
from examloom.llm.labelled import fold
from examloom.llm.minhash import NearDup, near_duplicates, shingle_sets, sketch
from examloom.llm.packing import WordIds, fill_gaps, pack_histogram, packed
from examloom.llm.quality import fit_quality, scored
from examloom.llm.queries import QUERIES

from . import brute

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b c d"), (7, "a b c d"),
    (8, "xäß " * 40), (9, "w " * 50_000), (10, "été\x0bA\x1fB C"), (11, "\U0001f600 z"),
]
DOCS = "doc_id long, text string, sketch string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "s", None) for d, t in ODD]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def near_copies(n=60, seed=1):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)]
    out, bases = [], [[rng.choice(vocabulary) for _ in range(80)] for _ in range(8)]
    for i in range(n):
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        out.append((i + 20, " ".join(own)))
    return out


def test_near_duplicates_against_all_pairs(spark):
    rows = ODD + near_copies()
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, keys int").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df).collect()}
    assert got == brute.classes(rows)


def test_near_duplicates_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op1_minhash_near_dedup"](spark, SF).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in brute.classes(rows).items()}


def test_near_duplicates_of_no_rows_and_null_ids(spark):
    empty = spark.createDataFrame([], DOCS)
    assert near_duplicates(empty).count() == 0
    some = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in near_duplicates(some).collect())
    assert got == [(-1, -1, True), (3, 3, True), (3, 3, True)]


@pytest.mark.parametrize("percent", [60, 80, 85, 95, 100])
def test_pairs_at_the_threshold_share_a_band(percent):
    p = NearDup(percent=percent)
    assert (1 - (percent / 100) ** p.rows) ** p.bands <= 1e-8
    assert p.size % 8 == 0 and 16 + 2 * p.size <= len(A.SEEDS) and 300 + p.bands <= len(A.SEEDS)


def test_sketch_fills_and_concentrates():
    rng = np.random.default_rng(3)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1000, 125, 125))
    sets = [np.concatenate([common, a]), np.concatenate([common, b]), common[:1], common[:3]]
    owner = np.repeat(np.arange(4), [len(s) for s in sets])
    got = sketch(owner, np.concatenate(sets), 4, 256)
    assert (got != np.uint64(2**64 - 1)).all()
    assert abs((got[0] == got[1]).mean() - 0.8) < 0.1


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51), (51, 50), (60, 60)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(31)}, 50: 50, 51: 50}


def test_rolling_hash_is_positional():
    values = np.arange(50, dtype=np.uint64)
    twice = np.concatenate([values, values])
    h = A.rolling(twice, 7)
    assert (h[:44] == h[50:94]).all() and len(set(h[:44].tolist())) == 44


def test_contamination_against_search(spark, docs):
    items = [("i1", "One two, three-four FIVE six seven eight nine ten eleven twelve"), ("i2", "short one"), ("i3", None),
             ("i4", " .,"), (None, "six seven"), ("i5", "short one"), ("i10", "äß 12")]
    rows = ODD + [
        (30, "zero one two three four five six seven eight nine ten, eleven twelve thirteen"),
        (31, "x. SHORT one short-one"), (32, "one two three four five six seven eight nine"), (33, "Ä äß 12 äß 123"),
    ]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, items int")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id string, text string, doc_id string")
    want = brute.contamination(rows, [(i, t) for i, t in items if i])
    for block in (4 << 20, 30):
        got = {r.doc_id: r for r in contamination(df, bench, block_bytes=block).collect()}
        assert {d: (r.n_words, r.n_hit, len(r["items"])) for d, r in got.items()} == {d: v[:3] for d, v in want.items()}
    text = dict(rows)
    assert [text[31][s.start : s.end] for s in got[31].spans] == ["SHORT one short-one"]
    assert [text[33][s.start : s.end] for s in got[33].spans] == ["äß 12"]
    none = contamination(df, bench.limit(0)).collect()
    assert len(none) == len(rows) and all(r.n_hit == 0 for r in none)


def test_contamination_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").selectExpr("cast(item_id as string)", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in QUERIES["op8_benchmark_decontamination"](spark, SF).collect()}
    assert got == brute.contamination(rows, items)


def check_pieces(rows, pieces, limit):
    machine = Tokenizer.from_file(BPE)
    want = {d: [*machine.encode(t or "", add_special_tokens=False).ids, 2] for d, t in rows}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == want.keys()
    for d, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        at = 0
        for p in own:
            assert (p.start, p.doc_tokens) == (at, len(want[d])) and p.length > 0
            ids = np.array(want[d][at : at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(ids)
            at += p.length
        assert at == len(want[d])
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        at = 0
        for p in own:
            assert p.offset == at
            at += p.length
        assert at <= limit
    total = sum(len(x) for x in want.values())
    return 1 - total / (limit * len(by_sequence))


ALPHABET = [*"aAbzIſßKk", *"éÉèÈñØ×÷ÿªµº", "e\u0301", "\u0301", "\u0307", "İ", "ı", "日", "е", "ﬁ", "\ufeff", "\u200b", "\u00a0",
            *".,.,;'’!#*&|-0123456789", "'s", "'t", "'re", " ", " ", " ", "\n", "\t", "\r", "\x0b", "\x0c", "\x00", "\u3000", "\u2028", "😀"]


@pytest.mark.parametrize("room", [40, 1_000_000])
def test_ids_by_words_are_those_of_whole_texts(room):
    rng = random.Random(room)
    texts = ["", ".", "a.", "é,", "a. b.", "é.", "×.", "A.,", "ab.\u0301", *("".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(4000))]
    words, machine = WordIds(BPE, room), Tokenizer.from_file(BPE)
    for k in range(0, len(texts), 900):
        part = texts[k : k + 900]
        ids, borders = words.encode(*A.text_bytes(pa.array(part)))
        assert len(borders) == len(part) + 1
        for t, a, b in zip(part, borders, borders[1:]):
            assert ids[a:b].tolist() == machine.encode(t, add_special_tokens=False).ids, repr(t)


def test_packing_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    waste = check_pieces(rows, QUERIES["op7_packing"](spark, SF).collect(), 4096)
    assert waste < 0.01


@pytest.mark.parametrize("limit", [7, 64])
def test_packing_of_odd_texts(spark, docs, limit):
    waste = check_pieces(ODD, packed(docs, BPE, limit).collect(), limit)
    assert waste < 0.2
    assert packed(docs.limit(0), BPE, limit).count() == 0


def test_packing_of_repeated_rows(spark, docs):
    twice = packed(docs.union(docs), BPE, 32).collect()
    assert sum(p.length for p in twice) == 2 * sum(p.length for p in packed(docs, BPE, 32).collect())
    assert len({(p.sequence_id, p.offset) for p in twice}) == len(twice)


@pytest.mark.parametrize("seed", range(5))
def test_patterns_hold_all_pieces(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 100): rng.randrange(1, 50) for _ in range(30)}
    packs = pack_histogram(counts, 100)
    seen = {}
    for c, lengths in packs:
        assert sum(lengths) <= 100
        for n in lengths:
            seen[n] = seen.get(n, 0) + c
    assert seen == counts
    full = fill_gaps(packs, 100, 0.01)
    tokens = sum(n * c for n, c in counts.items())
    assert sum(c * sum(p[2] for p in parts) for c, parts in full) == tokens
    assert all(sum(p[2] for p in parts) <= 100 for _, parts in full)
    assert sum(c for c, _ in full) * 100 - tokens <= max(100, 0.011 * tokens)


def test_quality_held_out(spark):
    got = QUERIES["op10_quality_classifier"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)
    assert got.count() == got.select("doc_id").distinct().count()


def test_quality_folds_and_odd_texts(spark, docs):
    labels = spark.createDataFrame([(d, d % 2, None) for d in range(1, 12)] + [(None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    rows = scored(docs, fit_quality(docs, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    one = scored(docs, fit_quality(docs, labels.where("quality = 1"))).collect()
    assert all(r.predicted == 1 for r in one)
    assert scored(docs.limit(0), fit_quality(docs.limit(0), labels.limit(0))).count() == 0
    changed = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality")
    again = {r.doc_id: r.score for r in scored(docs, fit_quality(docs, changed)).collect()}
    assert again == {r.doc_id: r.score for r in rows}


def test_an_open_pair_leaves_the_join_once_however_many_keys_it_shares(spark):
    from examloom.llm import minhash

    same = [7] * (minhash.BITS // 64)
    keys = {1: [10, 11, 12], 2: [11, 12, 13], 3: [10, 11, 12, 13], 4: [13]}
    rows = [(k, k, own, i, 100, i if i < 4 else 3, same) for i, own in keys.items() for k in own]
    left = spark.createDataFrame(rows, "key long, at long, keys array<long>, id long, n long, c long, bits array<long>")
    pairs = sorted(map(tuple, minhash._open_pairs(left, minhash.NearDup()).collect()))
    assert pairs == [(1, 2), (1, 3), (2, 3), (2, 4)]  # 3 and 4 are in one component
