"""Session defaults and durable lineage cuts."""

from __future__ import annotations

import importlib
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "examloom", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with the settings the operators are designed for.

    Adaptive execution chooses joins by measured size, splits skewed join
    partitions and coalesces small ones. Recording a Python call site for every
    column is turned off, as it takes most of the time of building a plan.
    ``master`` and ``shuffle_partitions`` are for local runs; a cluster
    supplies its own.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session of one process without that setting gets a temporary folder, one per
    application; on a cluster a missing setting is an error, as executors share no
    local disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="examloom-")
    return _own_dirs[context.applicationId]


_own_dirs: dict[str, str] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, free: bool = False) -> DataFrame:
    """``df`` written once as a Parquet table and read back.

    With ``free`` the shuffle files of this one write go as soon as it ends, and
    not when the driver next collects its garbage: chains of large steps then need
    room for their tables and the step at work. A lost file would be made again.
    """
    path = fresh_path(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    if free:
        conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if free and before is None:
            conf.unset(CLEANUP)
        elif free:
            conf.set(CLEANUP, before)
    return df.sparkSession.read.parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove the folders of tables made by ``written`` that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(folder))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship_packages(spark: SparkSession, *names: str) -> None:
    """Send Python packages to the executors, once per application.

    Needed for stages whose client is defined in a package that was not
    submitted with ``--py-files``.
    """
    context = spark.sparkContext
    for name in names:
        if (context.applicationId, name) in _shipped:
            continue
        folder = os.path.dirname(importlib.import_module(name).__file__)
        target = os.path.join(tempfile.mkdtemp(prefix="ship-"), name)
        context.addPyFile(
            shutil.make_archive(target, "zip", os.path.dirname(folder), name)
        )
        _shipped.add((context.applicationId, name))


_shipped: set[tuple[str, str]] = set()
