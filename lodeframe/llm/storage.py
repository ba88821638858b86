"""Tables shared by all executors: the folder named in ``spark.checkpoint.dir``.

A written table cuts lineage and survives the loss of an executor.  Tables that
no step deletes go when the driver's JVM ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import file_system, shared_folder

INTEGERS = ("tinyint", "smallint", "int", "bigint")


def integer_ids(docs: DataFrame, column: str = "doc_id") -> None:
    """Refuse ids that have no order as integers."""
    kind = dict(docs.dtypes)[column]
    if kind not in INTEGERS:
        raise TypeError(f"{column} must be an integer column, not {kind}")


#: Rows and bytes that go to Python at once.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 16_000_000}


def text_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of a batch that goes to Python: whole texts are long, and their batches take memory on both sides.

    Spark reads the bounds from the session when a query runs, so they stay set; smaller ones are kept.
    """
    read = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in ARROW.items():
        now = int(read(spark.conf.get(key)))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def write_shared(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet into the shared folder; the reread table and its path."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    p, files = file_system(spark, path)
    files.deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``write_shared`` for tables that a lazy result still reads; they go with the driver's JVM."""
    return write_shared(df, name)[0]


def forget(spark: SparkSession, path: str) -> None:
    """Delete a shared table that nothing reads any more."""
    p, files = file_system(spark, path)
    files.delete(p, True)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
