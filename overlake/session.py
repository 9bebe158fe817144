"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import SparkSession

# Runtime SQL settings the plans rely on.  Each one is set only where the session
# does not already carry an explicit value, so a cluster's own choice wins.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot match may hold a large share of all balls: split it even where that
    # costs one more exchange further down.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Broadcast a side only when its measured size is small against an executor; beyond
    # that the join is by shuffle.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Derived and joined rows are many times as wide in memory as in a packed file or an
    # exchange: smaller shares for a task, so that sorts stay in memory however large the input.
    "spark.sql.files.maxPartitionBytes": "4m",
    "spark.sql.files.openCostInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # So that exchanges have shares that small, they are dealt into more than a small session asks for
    # and joined again.  Up to 200, map tasks write without holding rows; beyond, they sort them and spill.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    # The JVM never compiles a method of more bytes than this; generated code that is larger
    # runs interpreted, several times slower than the plain operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Documents and archives travel to Python: a worker's memory follows the rows of a batch.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}

#: Names the scratch folder where it should not follow ``spark.checkpoint.dir``.
SCRATCH = "overlake.scratch.dir"


def configure(spark: SparkSession) -> SparkSession:
    explicit = spark.conf.getAll
    for key, value in RUNTIME_CONF.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Folder for tables that cut lineage, unique to this application.

    Below the folder that ``overlake.scratch.dir`` names, else ``spark.checkpoint.dir``, else
    the context's checkpoint folder, else the warehouse: all of them shared by all executors,
    so what is written outlives any of these.
    """
    context = spark.sparkContext
    root = (
        spark.conf.get(SCRATCH, None)
        or spark.conf.get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    )
    path = f"{root.rstrip('/')}/overlake-{context.applicationId}"
    if path not in _used:
        _used.add(path)
        local = urlparse(path)
        if context.master.startswith("local") and local.scheme in ("", "file"):
            atexit.register(shutil.rmtree, local.path, ignore_errors=True)
    return path


_used: set[str] = set()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder for what is done inside, deleted at its end: for the steps of a load."""
    from overlake.sources.files import Folder

    before = spark.conf.get(SCRATCH, None)
    own = fresh_path(spark, "step")
    spark.conf.set(SCRATCH, own)
    try:
        yield own
    finally:
        spark.conf.unset(SCRATCH) if before is None else spark.conf.set(SCRATCH, before)
        Folder(spark, own).delete()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
