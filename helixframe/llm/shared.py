"""Tables between jobs, kept where the driver and every executor can read them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Only a local master without one (a test) gets a temporary folder."""
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: its lineage ends there, so
    a lost executor costs a reread and not the work before it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def memory_returned() -> None:
    """Gives back to the system what a Python worker has freed: workers live on between tasks, and Arrow and the C library keep pages otherwise."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def long_rows(df: DataFrame, rows: int = 1000) -> DataFrame:
    """df, in whose session Arrow batches have at most so many rows from now on.

    Spark's default of 10,000 is meant for short rows; as many texts would
    fill a task's Python worker. A smaller setting of the user's stays."""
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, str(rows))
    return df


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it Arrow batches have at most so many rows; for jobs that run inside, not for lazy results."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows if int(old) <= 0 else min(rows, int(old))))
    try:
        yield
    finally:
        spark.conf.set(key, old)
