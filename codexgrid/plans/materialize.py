"""Lineage cuts that survive the loss of executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.

    A session without one gets a folder of this machine, but only if all its
    executors are on it (local mode); on a cluster it is an error, as executors
    would write to disks that the others can't read.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = f"file://{tempfile.gettempdir()}/codexgrid-checkpoint"
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back with its schema."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/codexgrid/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for files that are deleted with the written tables."""
    path = f"{shared_dir(spark)}/codexgrid/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def drop_written(keep: int = 0) -> None:
    """Delete the tables of ``written`` but for the first ``keep`` (all at the end of the driver)."""
    while len(_written) > keep:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session is gone; its folder is the cluster's to clean
            pass


@contextmanager
def scope() -> Iterator[None]:
    """Deletes at its end what was written inside; results that read those tables must have been used up by then."""
    have = len(_written)
    try:
        yield
    finally:
        drop_written(have)


atexit.register(drop_written)
