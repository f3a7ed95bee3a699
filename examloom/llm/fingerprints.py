"""Homomorphic fingerprints of documents: sums of wide vectors hashed from paragraphs.

A paragraph is a line of text. Its vector has two parts: identity lanes drawn from
its digest, and content lanes that count, for each hash bit, the word pairs in it
whose hash has that bit. A document's fingerprint is the lane-wise sum over its
paragraphs modulo 2^32. So it does not depend on their order, two documents with
the same paragraphs have the same fingerprint, and paragraphs are inserted and
deleted by adding and subtracting their vectors, without the rest of the text.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examloom.functions.text import let

MODULUS = 1 << 32
MASK = MODULUS - 1
IDENTITY = 16  # lanes drawn from a paragraph's digest
SUMS = 64  # columns of content lanes, two 32-bit lanes in each
PAIR = (1 << 32) | 1  # the lowest bit of either lane


def _spread(hashes: list[Column]) -> list[Column]:
    """Of each hash, bits k and k + 32 as the lowest bits of two lanes, for every k."""
    return [F.shiftrightunsigned(h, k).bitwiseAND(F.lit(PAIR)) for h in hashes for k in range(32)]


def _paragraph_hashes(text: Column) -> Column:
    """A digest of each paragraph; paragraphs without characters count as none."""
    paragraphs = F.filter(F.split(text, "\n"), lambda p: p != "")
    return F.transform(paragraphs, lambda p: F.struct(F.xxhash64(p).alias("x"), F.hash(p).alias("y")))


def _identity(text: Column) -> Column:
    """The identity lanes, each a sum of 32-bit draws modulo 2^32."""
    start = F.array(*[F.lit(0).cast("long")] * IDENTITY)
    digests = _paragraph_hashes(text)

    def add(lanes: Column, p: Column) -> Column:
        return F.zip_with(
            lanes, F.transform(F.sequence(F.lit(1), F.lit(IDENTITY)), lambda k: F.xxhash64(p["x"], p["y"], k)),
            lambda a, b: (a + b.bitwiseAND(F.lit(MASK))).bitwiseAND(F.lit(MASK)),
        )

    return F.aggregate(digests, start, add)


def _word_pairs(text: Column) -> Column:
    """A hash of each word with the next one of its paragraph, the last with nothing."""

    def of(paragraph: Column) -> Column:
        return let(
            F.filter(F.split(paragraph, " "), lambda w: w != ""),
            lambda words: F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1))),
        )

    return F.flatten(F.transform(F.split(text, "\n"), of))


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per key: its columns, n_pairs, identity (16 lanes) and content (64 pairs of lanes).

    Rows that repeat a key are one document with the paragraphs of all of them; a
    null key is a key like any other. Null and empty texts have the zero
    fingerprint. Texts become word rows inside the task that reads them and are
    summed up there, so what is shuffled is one fixed-size row per document.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    # Both parts are columns before rows are multiplied, so that each is made once a text.
    parts = docs.select(*keys, _identity(own).alias("identity"), _word_pairs(own).alias("pairs"))
    rows = parts.select(*keys, "identity", F.posexplode_outer("pairs").alias("i", "h"))
    bits = _spread([F.col("h"), F.xxhash64("h")])
    first = F.coalesce(F.col("i"), F.lit(0)) == 0
    lanes = [F.when(first, F.col("identity")[k]).otherwise(F.lit(0)) for k in range(IDENTITY)]
    summed = rows.groupBy(*keys).agg(
        F.count("h").alias("n_pairs"),
        *[F.sum(x).alias(f"l{k}") for k, x in enumerate(lanes)],
        *[F.sum(F.coalesce(x, F.lit(0))).alias(f"c{k}") for k, x in enumerate(bits)],
    )
    return summed.select(
        *keys,
        "n_pairs",
        F.array(*[F.col(f"l{k}").bitwiseAND(F.lit(MASK)) for k in range(IDENTITY)]).alias("identity"),
        F.array(*[F.col(f"c{k}") for k in range(2 * 32)]).alias("content"),
    )


def added(a: Column, b: Column) -> Column:
    """Identity lanes of the union of two disjoint sets of paragraphs."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MASK)))


def removed(a: Column, b: Column) -> Column:
    """Identity lanes of what is left of ``a`` after its paragraphs ``b`` are deleted."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MASK)))


def content_added(a: Column, b: Column) -> Column:
    """Content lanes of the union; lanes stay apart below 2^31 word pairs in all."""
    return F.zip_with(a, b, lambda x, y: x + y)


def content_removed(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def as_text(identity: Column, content: Column) -> Column:
    """A fingerprint as lower-case hexadecimal digits: 8 for each lane."""
    lanes = F.transform(identity, lambda x: F.substring(F.hex(x + F.lit(MODULUS)), 2, 8))
    pairs = F.transform(content, lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.lower(F.concat(F.array_join(lanes, ""), F.array_join(pairs, "")))


def _signed(content: Column, n: Column) -> Column:
    """Content lanes as sums of +1 and -1 over the ``n`` word pairs."""
    low = F.transform(content, lambda x: (2 * x.bitwiseAND(F.lit(MASK)) - n).cast("double"))
    high = F.transform(content, lambda x: (2 * F.shiftrightunsigned(x, 32) - n).cast("double"))
    return F.concat(low, high)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, n_a: Column, b: Column, n_b: Column) -> Column:
    """Likeness from 0 to 1 of two content parts: the cosine of their signed lanes.

    It estimates the share of common word pairs with an error of about 0.09; equal
    fingerprints give 1, and one without word pairs is like nothing but another.
    """
    cosine = let(
        F.struct(_signed(a, n_a).alias("x"), _signed(b, n_b).alias("y")),
        lambda v: _dot(v["x"], v["y"]) / F.sqrt(_dot(v["x"], v["x"]) * _dot(v["y"], v["y"])),
    )
    return (
        F.when((n_a == 0) | (n_b == 0), F.when(n_a == n_b, 1.0).otherwise(0.0))
        .when(a == b, 1.0)
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(cosine, F.lit(0.0)))))
    )


def next_ids(ids: DataFrame, key: str, parts: int = 64) -> DataFrame:
    """(key, next_key): the next smaller key, and the greatest one after the smallest.

    Keys must be distinct. They are cut into ranges by quantiles, so that windows
    run inside a range; only one row per range meets the others.
    """
    steps = [k / parts for k in range(1, parts)]
    cuts = sorted({*(ids.agg(F.percentile_approx(key, steps, 10_000)).first()[0] or [])})
    below = F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<long>"), lambda c: c <= F.col(key))
    ranged = ids.select(key, F.size(below).alias("part"))
    inside = ranged.withColumn("next_key", F.lead(key).over(Window.partitionBy("part").orderBy(F.desc(key))))
    tops = ranged.groupBy("part").agg(F.max(key).alias("top"))
    tops = tops.groupBy().agg(F.sort_array(F.collect_list("top"), False).alias("tops"))
    # at most one greatest key per range: the next range's, or the first one's after the last
    tops = tops.select(F.posexplode("tops").alias("k", "top"), "tops").select(
        "top", F.coalesce(F.get("tops", F.col("k") + 1), F.get("tops", F.lit(0))).alias("below")
    )
    last = ranged.groupBy("part").agg(F.min(key).alias(key), F.max(key).alias("top"))
    bridges = last.join(tops, "top").select(key, F.col("below").alias("next_key"))
    return inside.where("next_key is not null").select(key, "next_key").unionByName(bridges)
