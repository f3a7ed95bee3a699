import collections
import hashlib
import math
import random

import numpy as np
import pytest

from examloom.llm.vectorcodes import VectorCodes, borders, decoded, encoded, fit_codebooks, integer_vectors, nearest, vector_codes

SF = "/root/testdata/sf0.001"


def plain(rows, p):
    """(vec_id, code, error, label_error, digest) of each kept row, with lists and loops."""
    kept = [
        (v, label, [min(max(math.floor(p.scale * x), -(2**25)), 2**25) for x in e])
        for v, e, label in rows
        if e and all(x is not None and math.isfinite(x) for x in e)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return collections.Counter()
    width = len(kept[0][2])
    kept = [r for r in kept if len(r[2]) == width]
    cuts = [k * width // p.parts for k in range(p.parts + 1)]
    books = [[r[2][a:b] for r in kept[: p.entries]] for a, b in zip(cuts, cuts[1:])]

    def assign(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))

    for _ in range(p.rounds):
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            own = collections.defaultdict(list)
            for r in kept:
                own[assign(r[2][a:b], books[k])[1]].append(r[2][a:b])
            books[k] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if e in own else book for e, book in enumerate(books[k])]
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    coded = []
    for v, label, x in kept:
        best = [assign(x[a:b], book) for a, b, book in zip(cuts, cuts[1:], books)]
        coded.append((v, label, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    by_label = collections.Counter()
    for _, label, _, error in coded:
        by_label[label] += error
    return collections.Counter((v, code, error, by_label[label], digest) for v, label, code, error in coded)


def found(spark, rows, p, kind="float"):
    df = spark.createDataFrame([(*r, "c", 7) for r in rows], f"vec_id long, embedding array<{kind}>, label int, code string, x int").repartition(3)
    return collections.Counter(tuple(r) for r in vector_codes(df, p).collect())


@pytest.mark.parametrize("width, entries, kind", [(8, 5, "float"), (8, 256, "double"), (6, 3, "float"), (3, 4, "float")])
def test_against_brute_force(spark, width, entries, kind):
    r = random.Random(width * entries)
    value = lambda: float(np.float32(r.gauss(0, 0.02)))
    rows = [(k, [value() for _ in range(width)], r.choice([0, 1, None])) for k in range(80)]
    rows += [(k, rows[7][1], 2) for k in range(200, 230)]  # copies
    rows += [(5, rows[3][1], 1), (5, rows[3][1], 1), (None, rows[4][1], None), (None, None, None), (-1, None, 1), (-2, [], 1)]
    rows += [(-3, [None] + rows[0][1][1:], 1), (-4, [math.nan] + rows[0][1][1:], 1), (-5, rows[0][1][1:] + [math.inf], 0), (300, rows[0][1] + [1.0], 0)]
    rows += [(400, [3e30] + rows[0][1][1:], 3), (401, [-3e30] + rows[0][1][1:], 3)]
    p = VectorCodes(entries=entries)
    assert found(spark, rows, p, kind) == plain(rows, p)


def test_empty_and_nothing_whole(spark):
    assert not found(spark, [], VectorCodes())
    assert not found(spark, [(1, None, 1), (2, [None], 1), (3, [], None)], VectorCodes())
    one = [(9, [0.5, -0.5, 0.25, 0.0], None)]
    assert found(spark, one, VectorCodes()) == plain(one, VectorCodes())


def test_tables_equal_distances():
    rng = np.random.default_rng(1)
    x, book = rng.integers(-40, 40, (300, 7)), rng.integers(-40, 40, (20, 7))
    direct = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    entry, distance = nearest(x, book)
    assert (entry == direct.argmin(axis=1)).all() and (distance == direct.min(axis=1)).all()
    assert nearest(x, np.repeat(book[:1], 9, axis=0))[0].max() == 0
    assert borders(64, 4) == [0, 16, 32, 48, 64]


def test_codes_lead_back(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    integers = integer_vectors(vectors)
    books = fit_codebooks(integers)
    given = {r.vec_id: np.array(r.embedding) for r in vectors.collect()}
    got = encoded(integers, books).collect()
    assert len(got) == len(given)
    for r in got:
        assert np.abs(decoded(r.code, books) - given[r.vec_id]).max() < 1
        assert ((1024 * (decoded(r.code, books) - 0.5 / 1024) - np.floor(1024 * given[r.vec_id])) ** 2).sum() == r.error
