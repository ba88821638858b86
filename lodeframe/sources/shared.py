"""Folders that all executors share: the one named in ``spark.checkpoint.dir``.

It is read from the session; only where it is unset and the master is local
(single-machine tests) a temporary folder of the driver is set for the session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(DIR, None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{DIR} must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lodeframe-")
        spark.conf.set(DIR, folder)
    return folder.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """A path and its file system, as the JVM's objects."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, name: str) -> str:
    """A new shared folder's path; it goes when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    p, files = file_system(spark, path)
    files.mkdirs(p)
    files.deleteOnExit(p)
    return path


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to a new shared folder and read again, and the folder; this cuts its lineage."""
    path = scratch(df.sparkSession, name) + "/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of ``stored`` that nothing reads any more."""
    p, files = file_system(spark, path)
    files.delete(p, True)


def byte_batches(spark: SparkSession, most: int = 16_000_000) -> None:
    """Bound the bytes of a batch that goes to Python, where rows are large; a smaller bound is kept.  It stays set in the session."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))
    if now <= 0 or now > most:
        spark.conf.set(key, str(most))
