"""Event-time windows and replays, for batch frames and streams alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import scratch


def tumbling(events: DataFrame, time: str, width: str, keys: Sequence[str], value: str, late: str | None = None) -> DataFrame:
    """Count and sum of a value by window; with ``late``, a stream drops what comes later than that."""
    marked = events.withWatermark(time, late) if late and events.isStreaming else events
    return marked.groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def sliding(events: DataFrame, time: str, width: str, step: str, keys: Sequence[str], late: str | None = None) -> DataFrame:
    marked = events.withWatermark(time, late) if late and events.isStreaming else events
    return marked.groupBy(F.window(time, width, step), *keys).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, time: str, gap: str, keys: Sequence[str], late: str | None = None) -> DataFrame:
    marked = events.withWatermark(time, late) if late and events.isStreaming else events
    return marked.groupBy(F.session_window(time, gap).alias("window"), *keys).agg(F.count("*").alias("n"))


def first_seen(events: DataFrame, keys: Sequence[str], time: str, late: str) -> DataFrame:
    """Each key once; a stream forgets keys older than ``late``."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys)) if events.isStreaming else events.dropDuplicates(list(keys))


def read_stream(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """The Parquet files of a path, replayed as a stream with their own schema."""
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    # a single file is watched by its folder and name
    folder, _, name = path.rstrip("/").rpartition("/")
    return source.option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") and not _is_folder(spark, path) else source.parquet(path)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).isDirectory()


def run_to_table(stream: DataFrame, mode: str = "complete", folder: str | None = None) -> DataFrame:
    """Run a stream over what is there and return its output as a table.

    ``folder`` holds the checkpoint and the output: a run that was stopped goes on
    where it was when it is started with the same folder.  A complete output
    replaces the one before, others are added; a batch that is written again after
    a failure replaces its own part.
    """
    spark = stream.sparkSession
    folder = folder or scratch(spark, "stream")
    schema = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        part = "all" if mode == "complete" else f"batch-{number}"
        batch.write.mode("overwrite").parquet(f"{folder}/output/part={part}")

    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    out = spark.read.schema(schema).parquet(f"{folder}/output/part=*") if _exists(spark, f"{folder}/output") else spark.createDataFrame([], schema)
    return out.select(*schema.names)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def replay_counts(spark: SparkSession, path: str, key: str, order: str, folder: str | None = None) -> DataFrame:
    """Counts and first places by key of the files of a path, kept up to date by a stream."""
    stream = read_stream(spark, path).groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("first_id"))
    return run_to_table(stream, folder=folder)
