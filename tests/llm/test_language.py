import collections
import functools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from examloom.llm import arrays as A
from examloom.llm.language import LanguageId, characters, fit_languages, gram_buckets, posterior, predicted_languages
from examloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
P = LanguageId(longest=3, bits=9)


def fold(d, n=4):
    return zlib.crc32(str(d).encode()) % n


def spaced(text):
    """The characters that n-grams are taken from."""
    out = " "
    for c in text.lower() + " ":
        blank = not ("a" <= c <= "z") if ord(c) < 128 else 0x80 <= ord(c) < 0xC0 or 0x2000 <= ord(c) < 0x2070 or c == "　"
        c = " " if blank else c
        if c != " " or out[-1] != " ":
            out += c
    return out


@functools.cache
def grams(text, p):
    """Bucket of each n-gram, each hashed on its own."""
    s, out = spaced(text), []
    with np.errstate(over="ignore"):
        for n in range(1, p.longest + 1):
            for i in range(len(s) - n + 1):
                if n == 1 and s[i] == " ":
                    continue
                run = np.zeros(1, np.uint64)
                for c in s[i : i + n]:
                    run = run * np.uint64(0x9E3779B97F4A7C15) + A.mix(np.array([ord(c)], np.uint64) ^ A.SEEDS[600])
                out.append(int(A.mix(run ^ A.SEEDS[600 + n])[0] >> np.uint64(64 - p.bits)))
    return out


def plain(docs, p):
    """(doc_id, held out, language, probability) by counting in dictionaries."""
    counts, rows = collections.defaultdict(collections.Counter), collections.Counter()
    for d, text, lang in docs:
        if lang is not None and d is not None and fold(d) != 2 and text and any(c.isalpha() for c in text):
            counts[lang].update(grams(text, p))
            rows[lang] += 1
    out = []
    for d, text, _ in docs:
        held = d is not None and fold(d) == 2
        if not counts or not text or not any(c.isalpha() for c in text):
            out.append((d, held, "und", 0.0))
            continue
        score = {}
        for lang in sorted(counts):
            total = sum(counts[lang].values()) + p.smooth * (1 << p.bits)
            score[lang] = math.log(rows[lang] / sum(rows.values())) + sum(math.log((counts[lang][b] + p.smooth) / total) for b in grams(text, p))
        best = max(score, key=score.get)
        out.append((d, held, best, 1 / sum(math.exp(v - score[best]) for v in score.values())))
    return out


def found(spark, docs, p):
    df = spark.createDataFrame([(*r, "z", 0.5) for r in docs], "doc_id long, text string, lang string, known string, score double").repartition(3)
    return [tuple(r) for r in predicted_languages(df, fit_languages(df, p)).collect()]


def same(a, b):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    assert len(a) == len(b)
    for x, y in zip(sorted(a, key=key), sorted(b, key=key)):
        assert x[:3] == y[:3] and x[3] == pytest.approx(y[3], abs=1e-9)


def test_against_brute_force(spark):
    docs = [(k, t, lang) for k, (t, lang) in enumerate([
        ("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("die Katze und der Hund", "de"), ("ÉLÉPHANT à l'eau", "fr"), ("This. IS — it　", "en"),
        ("über Straße", "de"), (None, "en"), ("", "fr"), ("12 345 ...", "de"), ("the chat", None), ("日本", "ja"), ("x", "en"), ("ein Hund", "de"), ("a b", ""),
    ])]
    docs += [(2, "the dog", "en"), (2, "le chien", "fr"), (None, "der Hund", "de"), (None, None, None)]
    docs += [(50 + k, t, lang) for k, (_, t, lang) in enumerate(docs[:14])] + [(200, "long words " * 300, "en")]
    got = found(spark, docs, P)
    same(got, plain(docs, P))
    assert {r[2] for r in got} >= {"en", "fr", "de", "und"}


def test_nothing_learned_and_empty(spark):
    assert found(spark, [], P) == []
    docs = [(1, "the cat", None), (2, None, "en"), (3, "77", "en")]
    same(found(spark, docs, P), [(1, False, "und", 0.0), (2, fold(2) == 2, "und", 0.0), (3, fold(3) == 2, "und", 0.0)])


def test_most_languages_bounds_the_matrix(spark):
    docs = [(k, "abc", f"l{k % 9}") for k in range(90)] + [(k, "xyz", "main") for k in range(100, 140)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = fit_languages(df, LanguageId(bits=8, most=3))
    assert "main" in model.names and len(model.names) == 3 and model.log_probability.shape == (3, 256)


def test_texts_do_not_touch():
    texts = ["ab", "", "c d", "日"]
    together = characters(*A.text_bytes(pa.array(texts)))
    for k, t in enumerate(texts):
        alone, _ = characters(*A.text_bytes(pa.array([t])))
        assert "".join(map(chr, together[0][together[1][k] : together[1][k + 1]])) == "".join(map(chr, alone)) == spaced(t)
    for n, (bucket, at) in enumerate(gram_buckets(*together, P), 1):
        for k, t in enumerate(texts):
            own = [g for m, (b, e) in enumerate(gram_buckets(*characters(*A.text_bytes(pa.array([t]))), P), 1) if m == n for g in b.tolist()]
            assert bucket[at[k] : at[k + 1]].tolist() == own


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    lang = {r.doc_id: r.lang for r in docs}
    got = QUERIES["op12_language_id"](spark, SF).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) == sum(fold(r.doc_id) == 2 for r in docs)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_a_text_scores_alike_in_any_company(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_languages(df, P)
    texts = [r.text for r in df.limit(20).collect()]
    whole = posterior(model, *A.text_bytes(pa.array([t.lower() for t in texts])))
    for k, t in enumerate(texts):
        assert (posterior(model, *A.text_bytes(pa.array([t.lower()])))[0] == whole[k]).all()
