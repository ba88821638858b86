"""Generation that can be stopped at any time and goes on from what was accepted.

A run's folder holds its identity, the hash of all that decides its results, and a
table of accepted rows to which every batch adds once.  A run with another identity
is refused.  Requests whose ids are in the table aren't asked again; an answer whose
fingerprint is there already, from this or an earlier attempt, isn't accepted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import file_system
from .provenance import cache_key


class IdentityError(ValueError):
    """A folder that belongs to a run of another identity."""


class Run:
    """Accepted rows ``id, fingerprint, batch, <payload>`` of one identity in a folder that executors share."""

    def __init__(self, spark: SparkSession, folder: str, config: Mapping[str, Any], payload: str):
        self.spark, self.folder, self.payload = spark, folder.rstrip("/"), payload
        self.identity = cache_key(config, "generation", {})
        self._claim()

    @property
    def schema(self) -> str:
        return f"id string, fingerprint string, batch int, {self.payload}"

    def _claim(self) -> None:
        """Write the identity, or read the one that is there; the file appears whole or not at all."""
        path, files = file_system(self.spark, f"{self.folder}/identity")
        jvm = self.spark.sparkContext._jvm
        if not files.exists(path):
            own, _ = file_system(self.spark, f"{self.folder}/identity.{self.identity}")
            out = files.create(own, True)
            out.write(bytearray(self.identity.encode()))
            out.close()
            try:
                files.rename(own, path)
            except Py4JJavaError:
                # another driver was first: what it wrote is read below
                if not files.exists(path):
                    raise
        stream = files.open(path)
        found = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if found != self.identity:
            raise IdentityError(f"{self.folder} belongs to the run {found[:12]}, not to {self.identity[:12]}")

    def _batches(self) -> list[int]:
        path, files = file_system(self.spark, f"{self.folder}/accepted")
        if not files.exists(path):
            return []
        names = [s.getPath() for s in files.listStatus(path)]
        # a batch counts once its marker is there; what a stopped attempt left is written over
        return sorted(int(p.getName().removeprefix("batch=")) for p in names if p.getName().startswith("batch=") and files.exists(file_system(self.spark, f"{p}/_SUCCESS")[0]))

    def accepted(self) -> DataFrame:
        done = self._batches()
        if not done:
            return self.spark.createDataFrame([], self.schema)
        columns = self.spark.createDataFrame([], self.schema).columns
        rows = self.spark.read.option("basePath", f"{self.folder}/accepted").schema(self.schema).parquet(*[f"{self.folder}/accepted/batch={b}" for b in done])
        return rows.select(columns)

    def pending(self, requests: DataFrame) -> DataFrame:
        """Requests (with a text column ``id``; rows without one are never asked) that have no accepted row."""
        return requests.where("id is not null").join(self.accepted().select("id"), "id", "left_anti")

    def add(self, answers: DataFrame, fingerprint: Column, valid: Column) -> int:
        """Accept a batch of ``answers(id, <payload>)``: valid ones, the smallest id of each fingerprint, none that was accepted before.  Returns the batch's number."""
        done = self._batches()
        batch = done[-1] + 1 if done else 0
        names = [c for c in self.spark.createDataFrame([], self.payload and f"{self.payload}").columns]
        known = self.accepted()
        rows = answers.where(valid).withColumn("fingerprint", fingerprint).where(F.col("id").isNotNull() & F.col("fingerprint").isNotNull())
        fresh = rows.join(known.select("id"), "id", "left_anti").join(known.select("fingerprint"), "fingerprint", "left_anti")
        # one row an id, then one id a fingerprint
        one = fresh.groupBy("id").agg(F.min(F.struct("fingerprint", *names)).alias("x"))
        first = one.groupBy("x.fingerprint").agg(F.min(F.struct("id", "x")).alias("y"))
        first.select("y.id", "fingerprint", *[F.col(f"y.x.{c}").alias(c) for c in names]).write.mode("overwrite").parquet(f"{self.folder}/accepted/batch={batch}")
        return batch


def generate(run: Run, requests: DataFrame, answer: Callable[[DataFrame], DataFrame], part: Column, parts: int, fingerprint: Column, valid: Column, stop_after: int | None = None) -> DataFrame:
    """Accepted rows after every part of the requests was asked once more.

    ``part`` numbers the requests from 0 to ``parts`` - 1.  ``answer`` turns pending
    requests into answers.  A part whose batch was added by an earlier attempt of the
    run is skipped; ``stop_after`` ends the attempt after so many batches.
    """
    for number in range(len(run._batches()), parts):
        if stop_after is not None and number >= stop_after:
            break
        run.add(answer(run.pending(requests.where(part == number))), fingerprint, valid)
    return run.accepted()
