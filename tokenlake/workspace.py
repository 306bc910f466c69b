"""Tables that iterative jobs write to the shared folder of the cluster.

A written table cuts lineage, survives the loss of executors and is computed
once, so loops use it instead of in-memory checkpoints.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
# Spark deletes shuffle files at the end of the query that wrote them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A folder of our own is used only where the setting is absent and Spark runs
    in local mode; on a cluster a machine-local folder would not be readable
    from every executor, so that case is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can read")
    if sc.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="tokenlake-")
    return _LOCAL_ROOTS[sc.applicationId]


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for as long as this lasts."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Workspace:
    """A private subfolder of the shared folder, holding named Parquet tables.

    A ``tidy`` one deletes the shuffle files of a table as soon as it is written, instead of when the driver's garbage
    collection finds them, and packs its tables tighter.
    """

    def __init__(self, spark: SparkSession, name: str, root: str | None = None, tidy: bool = False):
        self.spark, self.tidy = spark, tidy
        self.path = f"{root or shared_root(spark)}/tokenlake/{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Write ``df`` and return a frame that reads it back."""
        target = f"{self.path}/{name}"
        writer = df.write.mode("overwrite")
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        if self.tidy:
            writer = writer.option("compression", "zstd")
        with _setting(self.spark, CLEANUP, "true") if self.tidy else nullcontext():
            writer.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self, name: str) -> None:
        """Delete one table of this workspace once nothing reads it any more."""
        fs, path = hadoop_path(self.spark, f"{self.path}/{name}")
        fs.delete(path, True)


def hadoop_path(spark: SparkSession, location: str):
    """(file system, path) handles for a location on any Hadoop-supported store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path
