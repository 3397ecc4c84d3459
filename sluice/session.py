"""Session settings and the shared folder that jobs may write working files to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
MIN_PARTITIONS = "spark.sql.files.minPartitionNum"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
SPARK_METHOD_LIMIT = "65535"  # Spark's default
JIT_METHOD_LIMIT = "8000"  # HotSpot interprets methods above this many bytecodes
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SMALL_BATCH = "4m"


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A session for tests and laptops; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluice")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a purely local session may fall back to a temporary folder: there the
    one machine is the whole cluster.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or sc.getConf().get(CHECKPOINT_DIR)
    if named is None:
        named = sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="sluice-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package's code to the executors, whatever folder they were started in."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="sluice-code-")), "sluice-code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (with `__` for each point of their names) for the actions within, put back afterwards."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def pin_split_plan(spark: SparkSession) -> None:
    """Keep file splits the same between two passes over one source.

    Spark sizes splits from the cores registered at planning time, which can
    change under dynamic allocation. Writing the present value down fixes it.
    """
    if spark.conf.get(MIN_PARTITIONS, None) is None:
        spark.conf.set(MIN_PARTITIONS, str(spark.sparkContext.defaultParallelism))


def prefer_compiled_methods(spark: SparkSession) -> None:
    """Keep wide typed projections within what the JIT compiles.

    A strict projection of a dozen columns fused into one generated method is
    too large for HotSpot, which then interprets it: measured at more than
    twice the time. Below the limit Spark splits the projection into small
    methods instead. A value the user has set is left alone.
    """
    if spark.conf.get(METHOD_LIMIT, SPARK_METHOD_LIMIT) == SPARK_METHOD_LIMIT:
        spark.conf.set(METHOD_LIMIT, JIT_METHOD_LIMIT)


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python workers by size, not only by number of rows.

    A batch of 10 000 rows, Spark's default, has no limit of size: it is held
    whole on both sides, by every running task. A value the user has set is left alone.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, SMALL_BATCH)
