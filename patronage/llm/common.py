"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.session import ensure_checkpoint_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Make sure the session has a checkpoint folder and that Python workers
    started from a checkout (not an installed package) find the library."""
    ensure_checkpoint_dir(spark)
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage into the shared checkpoint folder. Spark deletes these
    files itself once no plan refers to them any more (when
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on)."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that nothing refers to any
    more. It does so when the driver's garbage is collected, which may be long
    after a table has replaced them; a job of several large steps asks for it."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs of DataFrames made inside delete their shuffle files when they end,
    so that a job of several stored steps doesn't keep those of all its steps."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder made under :func:`scratch_path`, on any Hadoop store."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unsigned(column):
    """A 64-bit hash held in a signed long, shown as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
