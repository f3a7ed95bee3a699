"""Places and keys of rows: a total order over partitions, and ids that tell rows apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.session import written


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or the first of base_2, base_3 …, that no column of ``df`` has in any case."""
    taken, n, name = {c.lower() for c in df.columns}, 1, base
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def ranked(rows: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """``rows`` with their place, from 1, in a total order.

    Spark sorts by ranges and the sorted table is written with each row's partition
    and place inside it; the driver sees one count a partition.
    """
    numbered = written(rows.orderBy(*order).withColumn(name, F.monotonically_increasing_id()), "sorted")
    part = F.shiftright(F.col(name), 33)
    sizes = dict(numbered.groupBy(part.alias("part")).count().collect())
    before, pairs = 0, []
    for k in sorted(sizes):
        pairs += [F.lit(k), F.lit(before)]
        before += sizes[k]
    if not pairs:
        return numbered
    start = F.create_map(*pairs)[part]
    return numbered.withColumn(name, start + F.col(name).bitwiseAND(F.lit((1 << 33) - 1)) + 1)


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a long ``name`` that no two rows share and that rises with doc_id.

    It is the doc_id itself if all are distinct and not null, which one aggregate of
    ids finds out. Otherwise rows are sorted by doc_id, null last, and a hash of the
    text, and the key is their place; that writes the table once.
    """
    key = F.col("doc_id").cast("long")
    counts = docs.select(key.alias("k")).groupBy("k").count()
    if counts.where("count > 1 or k is null").isEmpty():
        return docs.withColumn(name, key)
    return ranked(docs, [key.asc_nulls_last(), F.xxhash64("text").asc()], name)
