"""Cut points. A staged table is plain Parquet in the shared checkpoint folder.

It outlives lost executors, cuts lineage, and gives the planner true sizes, so
that the automatic broadcast threshold acts as the size check on every join
against it.
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from wordloom import storage

_scratch: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def workspace(spark: SparkSession) -> str:
    """Shared folder for cut points, read from ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="wordloom-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        sc.setCheckpointDir(root)
    return f"{root}/wordloom-{sc.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and return a reader of what was written."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if (paths := _scratch.get()) is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged within are deleted at the end; what is computed from them has to be written by then."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            storage.delete(spark, path)
