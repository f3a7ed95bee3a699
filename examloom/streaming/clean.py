"""Cleaning a growing JSONL folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from examloom import schemas
from examloom.operators.cleaning import split_rows
from examloom.sources.readers import checked_lines

BATCH_BYTES = 64 << 30


def stream_clean(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    schema: str = schemas.GEN_RECORD,
    max_bytes_per_trigger: int = BATCH_BYTES,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Clean every file not cleaned before, then stop.

    Lines go to the folders ``side=clean``, ``side=removed`` and ``side=quarantined``
    of ``out_dir``; ``read_side`` reads them back. Lines that are no record are
    quarantined as they stand. The checkpoint remembers finished files, and the file
    sink commits a batch as a whole and once, so a run that is killed and started
    again leaves neither gaps nor duplicates. A batch takes files up to
    ``max_bytes_per_trigger``, one file at least; each line is read once and written
    once, and nothing is kept on executors.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    rows: DataFrame = split_rows(checked_lines(reader.text(in_dir), schema))
    return (
        rows.writeStream.partitionBy("side")
        .format("json")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
