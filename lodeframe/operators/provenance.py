"""Hashes, manifests, stage reuse and ancestry."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..facets import compact
from ..functions.text import canonical_json

VERSION = re.compile(r"v?\d+(\.\d+)*")


#: Bytes up to which a file is hashed as one value by a task; larger ones are streamed by the driver.
ONE_VALUE = 2**28


def file_hashes(spark: SparkSession, path: str, one_value: int = ONE_VALUE) -> DataFrame:
    """``(path, bytes, sha256)`` of every file below a path, read in chunks where it is large."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = files.where(F.col("length") <= one_value).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > one_value).select("path", "length").collect()  # names alone, a few a folder
    rows = [(r.path, r.length, streamed_hash(spark, r.path)) for r in large]
    return found.unionByName(spark.createDataFrame(rows, "path string, bytes long, sha256 string"))


def streamed_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of one file, read in chunks."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def verify_manifest(manifest: DataFrame, hashes: DataFrame) -> DataFrame:
    """Each manifest row ``(name, sha256)`` with its status: ok, changed or missing; names are path ends."""
    named = hashes.select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), F.col("sha256").alias("found"))
    status = F.when(F.col("found").isNull(), "missing").when(F.col("found") == F.lower("sha256"), "ok").otherwise("changed")
    return manifest.join(named, "name", "left").withColumn("status", status)


def checksum_lines(lines: DataFrame) -> DataFrame:
    """Rows of a checksum file, ``hash  name``."""
    parts = F.regexp_extract("value", r"^([0-9a-fA-F]{64})[ *]+(.+)$", 1), F.regexp_extract("value", r"^([0-9a-fA-F]{64})[ *]+(.+)$", 2)
    return lines.where(F.trim("value") != "").select(F.lower(parts[0]).alias("sha256"), parts[1].alias("name"))


def cache_key(lineage: Mapping[str, Any], stage: str, parameters: Mapping[str, Any]) -> str:
    import hashlib

    return hashlib.sha256(compact({"lineage": lineage, "parameters": parameters, "stage": stage}).encode()).hexdigest()


def cache_keys(lineage: Mapping[str, Column], stage: str, parameters: Mapping[str, Column]) -> Column:
    """``cache_key`` of each row, from columns."""
    inside = lambda parts: F.struct(*[parts[k].alias(k) for k in sorted(parts)])
    return F.sha2(canonical_json({"lineage": inside(lineage), "parameters": inside(parameters), "stage": F.lit(stage)}), 256)


def check_version(version: str, exists: Callable[[str], bool], targets: Sequence[str]) -> None:
    """A version name must be well formed and none of its targets may exist."""
    if not VERSION.fullmatch(version):
        raise ValueError(f"bad version {version!r}")
    if taken := [t for t in targets if exists(t)]:
        raise FileExistsError(f"already there: {taken}")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cached_stage(spark: SparkSession, root: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage's table under its content key, built once.

    Beside it stands the hash of its files; a table whose files aren't those
    any more, or that never was finished, is built anew.
    """
    path, seal = f"{root.rstrip('/')}/{key}", f"{root.rstrip('/')}/{key}.sealed"
    hashes = lambda: sorted((r.path.rsplit("/", 1)[-1], r.sha256) for r in file_hashes(spark, path).collect() if not r.path.rsplit("/", 1)[-1].startswith(("_", ".")))
    if path_exists(spark, f"{path}/_SUCCESS") and path_exists(spark, seal):
        kept = sorted((r.name, r.sha256) for r in spark.read.parquet(seal).collect())  # one row a file
        if kept == hashes():
            return spark.read.parquet(path)
    build().write.mode("overwrite").parquet(path)
    spark.createDataFrame(hashes(), "name string, sha256 string").coalesce(1).write.mode("overwrite").parquet(seal)
    return spark.read.parquet(path)


#: What the registry profile of the model matrix asks for.
MATRIX_PROFILE, MATRIX_TARGETS, MATRIX_ANCHORS = "phase05_matrix", 8, 2
MODEL_DDL = (
    "model_id string, family string, size_b double, stage string, variant string, base_model string, base_revision string, adapter_run_id string, "
    "parent_model_id string, artifact_kind string, artifact_path string, manifest_path string, is_anchor boolean, server_args array<string>, adapter_path string"
)
OPTIONAL = ("adapter_run_id", "parent_model_id", "is_anchor", "server_args", "adapter_path")


def model_registry(spark: SparkSession, data: Mapping[str, Any]) -> DataFrame:
    """The models of a registry file as a table; a missing key, a repeated id or a matrix that isn't whole is an error.

    The matrix profile wants eight quantisation targets (models of kind
    ``q4_k_m`` that are no anchors) and two anchors, both of stage ``sft``.
    """
    columns = [c.split()[0] for c in MODEL_DDL.split(", ")]
    rows = []
    for record in data["models"]:
        if missing := [c for c in columns if c not in record and c not in OPTIONAL]:
            raise ValueError(f"{record.get('model_id')}: missing {missing}")
        full = dict.fromkeys(OPTIONAL) | {"is_anchor": False, "server_args": []} | dict(record)
        rows.append(tuple(float(full[c]) if c == "size_b" else [str(x) for x in full[c]] if c == "server_args" else full[c] for c in columns))
    models = spark.createDataFrame(rows, MODEL_DDL)
    target = (F.col("artifact_kind") == "q4_k_m") & ~F.col("is_anchor")
    n = models.agg(F.count("*").alias("all"), F.countDistinct("model_id").alias("ids"), F.count_if(target).alias("targets"), F.count_if("is_anchor").alias("anchors"), F.count_if(F.col("is_anchor") & (F.col("stage") != "sft")).alias("odd")).first()
    if n["all"] != n["ids"]:
        raise ValueError("repeated model_id")
    if data.get("registry_profile", MATRIX_PROFILE) == MATRIX_PROFILE and (n["targets"], n["anchors"], n["odd"]) != (MATRIX_TARGETS, MATRIX_ANCHORS, 0):
        raise ValueError(f"the matrix has {n['targets']} targets and {n['anchors']} anchors, {n['odd']} of another stage")
    return models


def run_matrix(jobs: Mapping[str, Callable[[], Any]]) -> list[tuple[str, str, str | None]]:
    """Run every job; one that fails doesn't stop the others. ``(name, completed or failed, error)``."""
    out = []
    for name, job in jobs.items():
        try:
            job()
            out.append((name, "completed", None))
        except Exception as e:
            out.append((name, "failed", f"{type(e).__name__}: {e}"))
    return out


def pending(grid: Mapping[str, Sequence[Any]], done: DataFrame, spark: SparkSession) -> DataFrame:
    """Combinations of a benchmark grid that have no result yet."""
    cells = spark.range(1).select(*[F.explode(F.array(*map(F.lit, v))).alias(k) for k, v in list(grid.items())[:1]])
    for k, v in list(grid.items())[1:]:
        cells = cells.withColumn(k, F.explode(F.array(*map(F.lit, v))))
    return cells.join(done.select(*grid), list(grid), "left_anti")


def incomplete(ids: DataFrame, files: DataFrame, required: Sequence[str]) -> DataFrame:
    """Ids that lack one of their required files; ``files(id, name)``."""
    done = files.where(F.col("name").isin(*required)).groupBy("id").agg(F.countDistinct("name").alias("n")).where(F.col("n") == len(required))
    return ids.join(done, "id", "left_anti")


def ancestry(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """``(node, depth, root)``: steps to the root of each node of a forest."""
    from .hierarchies import closure

    pairs = closure(edges, child, parent)
    depth = pairs.groupBy(F.col("descendant").alias("node")).agg((F.count("*") - 1).alias("depth"))
    roots = edges.where(F.col(parent).isNull()).select(F.col(child).alias("root"))
    root_of = pairs.join(roots, F.col("ancestor") == F.col("root")).select(F.col("descendant").alias("node"), "root")
    return depth.join(root_of, "node", "left")
