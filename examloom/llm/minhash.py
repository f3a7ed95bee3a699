"""Near-duplicate documents by fast similarity sketching, banding and exact checks.

A document is the set of its distinct five-word shingles. Its sketch has
``size`` coordinates. In the first ``size`` rounds every shingle is hashed into
one random bin with a value that grows with the round; a further ``size`` rounds
hash all shingles into one fixed bin each. The rounds stop when every bin is
full, so every coordinate is filled, and the share of equal coordinates of two
sketches has the mean (the Jaccard similarity) and the concentration of
independent samples. Equal bands of coordinates propose pairs, sketches discard
those that cannot be similar, and whole sets decide.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.llm import arrays as A
from examloom.llm.components import components
from examloom.session import written


MISS = 1e-8  # greatest chance that a pair at exactly the threshold is not proposed, or not checked
MOST_BANDS = 64
BITS = 2048  # coordinates of the bit sketch of documents that are still open


@dataclass(frozen=True)
class NearDup:
    """Parameters: shingle words and similarity in percent; the others follow from it.

    A band has 5 rows, or as many fewer as keep the bands within ``MOST_BANDS``, and
    there are as few bands as let a pair at the similarity share none with a chance
    of at most ``MISS``: 32 bands of 5 at 85 (7e-9), 48 of 5 at 80 (5e-9). A pair is
    checked on its sets when the share of equal coordinates is at most ``slack``
    below the similarity; by the Chernoff bound a pair at the similarity fails that
    with a chance of at most ``MISS`` too. Pairs between open documents are tested on
    one bit of each of ``BITS`` further coordinates, which agree with a chance of
    (1 + similarity) / 2; ``most_flips`` of them may differ, by the same bound.
    """

    shingle: int = 5
    percent: int = 85

    def missed(self, bands: int, rows: int) -> float:
        """The chance that a pair at the similarity shares none of the bands."""
        return (1 - (self.percent / 100) ** rows) ** bands

    def failed(self, slack: float) -> float:
        """Bound of the chance that so many coordinates of such a pair differ."""
        return _below(self.percent / 100, slack, self.size)

    @property
    def most_flips(self) -> int:
        """The most bits in which a pair at the similarity may differ, but for that chance."""
        p = (1 + self.percent / 100) / 2
        return next(k for k in range(BITS + 1) if _below(p, p - 1 + k / BITS, BITS) <= MISS)

    @property
    def shape(self) -> tuple[int, int]:
        for rows in (5, 4, 3, 2, 1):
            # whole longs of coordinates: a multiple of 8
            for bands in range(8, MOST_BANDS + 1, 8):
                if self.missed(bands, rows) <= MISS:
                    return bands, rows
        raise ValueError(f"no {MOST_BANDS} bands find pairs at {self.percent} percent")

    @property
    def bands(self) -> int:
        return self.shape[0]

    @property
    def rows(self) -> int:
        return self.shape[1]

    @property
    def slack(self) -> float:
        return next(k / 100 for k in range(1, 101) if self.failed(k / 100) <= MISS)

    @property
    def size(self) -> int:
        return self.bands * self.rows


def _below(p: float, slack: float, n: int) -> float:
    """Chernoff bound of the chance that a share of ``n`` draws of chance ``p`` falls ``slack`` below it."""
    q = p - slack
    if slack <= 0:
        return 1.0
    if q <= 0:
        return 0.0
    rest = (1 - q) * math.log((1 - q) / (1 - p)) if p < 1 else math.inf
    return math.exp(-n * (q * math.log(q / p) + rest))


def shingle_sets(data: np.ndarray, borders: np.ndarray, length: int):
    """(owner, hash) of the distinct shingles of each text, sorted.

    A text with fewer words than ``length`` but at least one has its whole
    sequence as its only shingle.
    """
    low = A.LOWER[data]
    starts, ends, at = A.words(low, borders)
    hashes = A.span_hashes(low, starts, ends)
    whole = A.whole_windows(at, length)
    owner, value = A.owners(at)[whole], A.rolling(hashes, length)[whole]
    counts = np.diff(at)
    extra_owner, extra_value = [], []
    for n in range(1, length):
        short = np.flatnonzero(counts == n)
        if len(short):
            extra_owner.append(short)
            extra_value.append(A.rolling(hashes, n)[at[short]])
    if extra_owner:
        owner = np.concatenate([owner, *extra_owner])
        value = np.concatenate([value, *extra_value])
        order = np.argsort(owner, kind="stable")
        owner, value = owner[order], value[order]
    return A.distinct_pairs(owner, value)


def sketch(owner: np.ndarray, value: np.ndarray, n: int, size: int, seed: int = 0) -> np.ndarray:
    """The (n, size) sketches of ``n`` sets; sets without elements stay void."""
    empty = np.uint64(2**64 - 1)
    bins = np.full(n * size, empty, np.uint64)
    active = np.zeros(n, bool)
    active[owner] = True
    low = np.uint64(2**51 - 1)
    for step in range(2 * size):
        keep = active[owner]
        if not keep.any():
            break
        if not keep.all():
            owner, value = owner[keep], value[keep]
        h = A.mix(value ^ A.mix(A.SEEDS[16:17] + np.uint64(step + seed)))
        own = ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        if step >= size:
            own[:] = step - size
        key = (np.uint64(step) << np.uint64(51)) | (A.mix(h ^ A.SEEDS[2]) & low)
        np.minimum.at(bins, owner * size + own, key)
        full = (bins.reshape(n, size) != empty).all(axis=1)
        active &= ~full
    return bins.reshape(n, size)


def _sketch_rows(p: NearDup):
    def run(batches):
        for rows, data, borders in A.runs(batches):
            n = rows.num_rows
            owner, value = shingle_sets(data, borders, p.shingle)
            counts = np.bincount(owner, minlength=n)
            edges = np.concatenate([[0], np.cumsum(counts)])
            digests = []
            for seed in (3, 4):
                total = np.concatenate([[0], np.cumsum(A.mix(value ^ A.SEEDS[seed]))]).astype(np.uint64)
                digests.append((total[edges[1:]] - total[edges[:-1]]).view(np.int64))
            bins = sketch(owner, value, n, p.size)
            keys = np.zeros((n, p.bands), np.uint64)
            for r in range(p.rows):
                keys = keys * np.uint64(A.WORD_BASE) + bins[:, r :: p.rows]
            keys = A.mix(keys ^ A.SEEDS[300 : 300 + p.bands])
            some = np.where(counts > 0, p.bands, 0)
            flat = keys[counts > 0].reshape(-1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(counts.astype(np.int64)),
                    pa.array(digests[0]),
                    pa.array(digests[1]),
                    A.lists(_low_bytes(bins), np.arange(n + 1) * (p.size // 8), pa.int64()),
                    A.lists(flat, np.concatenate([[0], np.cumsum(some)]), pa.int64()),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "sketch", "keys"],
            )

    return run


def _low_bytes(bins: np.ndarray) -> np.ndarray:
    """The low byte of every coordinate, eight of them in one long."""
    return np.ascontiguousarray((bins & np.uint64(255)).astype(np.uint8).reshape(-1)).view(np.int64)


def _bit_rows(p: NearDup):
    """(id, bits): one bit of each of ``BITS`` coordinates that ``_sketch_rows`` does not use."""

    def run(batches):
        few = (b.slice(k, 1024) for b in batches for k in range(0, b.num_rows, 1024))  # 16 KB a document
        for rows, data, borders in A.runs(few):
            n = rows.num_rows
            owner, value = shingle_sets(data, borders, p.shingle)
            bins = sketch(owner, value, n, BITS, seed=1 << 20)
            packed = np.packbits((bins & np.uint64(1)).astype(np.uint8), axis=1)
            longs = np.ascontiguousarray(packed).reshape(-1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), A.lists(longs, np.arange(n + 1) * (BITS // 64), pa.int64())], names=["id", "bits"]
            )

    return run


def _few_flips(a: str, b: str, p: NearDup) -> Column:
    """Do few enough bits of two bit sketches differ?"""
    flips = F.lit(0)
    for k in range(BITS // 64):
        flips = flips + F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k]))
    return flips <= p.most_flips


def _alike(a: str, b: str, p: NearDup) -> Column:
    """Do enough coordinates of two sketches agree? Counts the bytes that differ."""
    differ = F.lit(0)
    for k in range(p.size // 8):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return differ <= int(p.size * (1 - p.percent / 100 + p.slack))


def _links(p: NearDup):
    def run(batches):
        for batch in batches:
            first = 0
            sizes = [len(x or "") + len(y or "") for x, y in zip(*(batch.column(c).to_pylist() for c in ("text_a", "text_b")))]
            while first < batch.num_rows:
                last, room = first, 0
                while last < batch.num_rows and (last == first or room + sizes[last] <= A.CHUNK):
                    room += sizes[last]
                    last += 1
                part = batch.slice(first, last - first)
                n = part.num_rows
                both = pa.concat_arrays([part.column("text_a"), part.column("text_b")])
                owner, value = shingle_sets(*A.text_bytes(both), p.shingle)
                counts = np.bincount(owner, minlength=2 * n)
                pair, _ = A.distinct_pairs(*_by_pair(owner % n, value))
                union = np.bincount(pair, minlength=n)
                shared = counts[:n] + counts[n:] - union
                keep = (100 * shared >= p.percent * union) & (union > 0)
                yield part.select(["a", "b"]).filter(pa.array(keep))
                first = last

    return run


def _by_pair(pair, value):
    order = np.argsort(pair, kind="stable")
    return pair[order], value[order]


def _lengths_fit(p: NearDup, a: str, b: str) -> Column:
    return (100 * F.least(a, b)) >= (p.percent * F.greatest(a, b))


def _verified(docs: DataFrame, near: DataFrame, p: NearDup) -> DataFrame:
    """Those (a, b) whose sets reach the similarity.

    Texts are joined by sorting at every size, as a hint says: the number of
    proposed documents grows with the input.
    """
    near = written(near, "near")
    if near.isEmpty():
        return near
    ids = near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = written(docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi"), "texts")
    return written(
        near.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_links(p), "a long, b long")
        .distinct(),
        "links",
    )


def _checked_leads(docs: DataFrame, asked: DataFrame, side: DataFrame, p: NearDup) -> DataFrame:
    """The links among ``asked(id, lead)``, by sketches and then by whole sets."""
    a = side.select(F.col("doc_id").alias("lead"), F.col("sketch").alias("sketch_a"))
    b = side.select(F.col("doc_id").alias("id"), F.col("sketch").alias("sketch_b"))
    near = asked.join(b, "id").join(a, "lead").where(_alike("sketch_a", "sketch_b", p))
    return _verified(docs, near.select(F.col("lead").alias("a"), F.col("id").alias("b")), p)


def _open_pairs(left: DataFrame, p: NearDup) -> DataFrame:
    """Pairs (a, b) of ``left(key, at, keys, id, n, c, bits)`` in different components that may be links.

    A pair that shares several keys leaves the join at the least of them only: ``keys``
    are all those of a member, sorted, and ``at`` is ``key`` once more, as a test on ``key``
    would be copied to the other side and made before the cheaper ones. One test in the
    join itself, so that no other pair leaves it.
    """
    l, r = left.alias("l"), left.alias("r")
    fits = F.expr("l.key = r.key and l.id < r.id and l.c <> r.c")
    once = F.expr("l.at = get(filter(l.keys, k -> array_contains(r.keys, k)), 0)")
    alike = _lengths_fit(p, "l.n", "r.n") & _few_flips("l.bits", "r.bits", p)
    return l.join(r, fits & alike & once).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))


def reps_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents in ``ids(id)``."""
    named = docs.select(F.col("doc_id").alias("id"), "text")
    return named.join(ids.hint("merge"), "id", "left_semi")


def near_duplicates(docs: DataFrame, params: NearDup = NearDup()) -> DataFrame:
    """Similarity classes of ``docs(doc_id, text)``: one row per document.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable over
    links, itself included) and kept (doc_id = component_id). Texts without words
    and null texts have no shingles and link with nothing. A null doc_id has a
    null component and is kept. Rows that repeat a doc_id count as one document
    if their texts agree. Further columns are not read.

    Documents with equal sets are one class from the start and only its smallest
    id goes on, so a group of copies costs one row however large it is. In every
    band the smallest id is the lead. Members are first checked against the least of
    their leads, one pair each, then against those leads that are still in another
    component; that is linear and settles groups of near copies. Only members that
    are still in different components are then met pair by pair, on bit sketches made
    for them alone and once a pair, so no proposed link between different components is left out. Full
    sets decide; they are taken from the texts of proposed documents alone, so they
    are never stored.
    """
    p = params
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = written(
        wanted.mapInArrow(
            _sketch_rows(p),
            "doc_id long, n_shingles long, d1 long, d2 long, sketch array<long>, keys array<long>",
        ),
        "sketches",
    )
    full = sketches.where("n_shingles > 0 and doc_id is not null")
    reps = full.groupBy("d1", "d2", "n_shingles").agg(
        F.min(F.struct("doc_id", "sketch", "keys")).alias("r")
    )
    reps = written(
        reps.select(F.col("r.doc_id").alias("doc_id"), "d1", "d2", "n_shingles", "r.sketch", "r.keys"),
        "sets",
    )
    rows = reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"))
    shared = rows.groupBy("key").agg(F.min(F.struct("id", "n")).alias("first"), F.count("*").alias("c"))
    members = written(
        rows.join(shared.where("c > 1").select("key", "first"), "key").select(
            "key", "id", "n", F.col("first.id").alias("lead"), F.col("first.n").alias("lead_n")
        ),
        "members",
    )
    side = reps.select("doc_id", "sketch")
    asked = members.where("id <> lead").where(_lengths_fit(p, "n", "lead_n")).select("id", "lead")
    least = asked.groupBy("id").agg(F.min("lead").alias("lead"))
    links = _checked_leads(wanted, least, side, p)
    found = components(links)
    known = written(found.withColumnRenamed("component", "c"), "known")
    own = asked.join(known, "id", "left").withColumn("c", F.coalesce("c", "id"))
    other = own.join(known.select(F.col("id").alias("lead"), F.col("c").alias("d")), "lead", "left")
    apart = other.where(F.col("c") != F.coalesce("d", "lead")).select("id", "lead").distinct()
    more = _checked_leads(wanted, apart.join(least, ["id", "lead"], "left_anti"), side, p)
    if not more.isEmpty():
        links = links.unionByName(more)
        found = components(links)
    labelled = members.join(found.withColumnRenamed("component", "c"), "id", "left").select(
        "key", "id", "n", F.coalesce("c", "id").alias("c")
    )
    mixed = labelled.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    left = labelled.join(mixed.where("lo < hi").select("key"), "key", "left_semi")
    left = written(left, "mixed")
    texts = reps_texts(wanted, left.select("id").distinct())
    bits = written(texts.mapInArrow(_bit_rows(p), "id long, bits array<long>"), "bits")
    shared = left.groupBy("id", "n").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    left = written(left.join(shared, ["id", "n"]).join(bits, "id").withColumn("at", F.col("key")), "mixed_bits")
    others = _open_pairs(left, p).distinct()
    more = _verified(wanted, others, p)
    found = found if more.isEmpty() else components(links.unionByName(more))
    classes = reps.join(found, reps.doc_id == found.id, "left").select(
        "d1", "d2", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    classes = classes.withColumnRenamed("n_shingles", "n")
    # A set's size is part of its digest, so that a void set cannot meet another.
    out = sketches.select("doc_id", "n_shingles", "d1", "d2").join(
        classes,
        (sketches.d1 == classes.d1) & (sketches.d2 == classes.d2) & (sketches.n_shingles == classes.n),
        "left",
    )
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce(component, F.col("doc_id")).alias("component_id"),
        F.coalesce(F.coalesce(component, F.col("doc_id")) == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
