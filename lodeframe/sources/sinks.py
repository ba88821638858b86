"""Sinks: JSON lines, reports, event streams and result folders. Spark's committer makes each write atomic."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..operators.reports import effective_pass

NULLS = {"ignoreNullFields": "false"}
#: Keys that result rows must not carry, at any depth.
FORBIDDEN = ("api_key", "authorization", "password", "secret", "token")


def _ordered(value: Column, kind: DataType, first: Sequence[str]) -> Column:
    """A value whose structs, at any depth, have the known fields first, in the order given."""
    if isinstance(kind, StructType):
        names = [n for n in first if n in kind.names] + [n for n in kind.names if n not in first]
        if len(names) == 0:
            return value
        return F.when(value.isNotNull(), F.struct(*[_ordered(value[n], kind[n].dataType, first).alias(n) for n in names]))
    if isinstance(kind, ArrayType) and _holds_struct(kind.elementType):
        return F.transform(value, lambda x: _ordered(x, kind.elementType, first))
    if isinstance(kind, MapType) and _holds_struct(kind.valueType):
        return F.transform_values(value, lambda _, x: _ordered(x, kind.valueType, first))
    return value


def _holds_struct(kind: DataType) -> bool:
    return isinstance(kind, StructType) or (isinstance(kind, ArrayType) and _holds_struct(kind.elementType)) or (isinstance(kind, MapType) and _holds_struct(kind.valueType))


def in_order(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Known columns, and known fields of nested records, first and in the order given, the others after them."""
    known = [c for c in first if c in df.columns]
    columns = known + [c for c in df.columns if c not in known]
    return df.select(*[_ordered(F.col(f"`{c}`"), df.schema[c].dataType, first).alias(c) for c in columns])


def as_json(df: DataFrame) -> DataFrame:
    """Rows as compact JSON with nulls kept."""
    return df.select(F.to_json(F.struct("*"), NULLS).alias("value"))


def write_jsonl(df: DataFrame, path: str, first: Sequence[str] = (), files: int | None = None) -> None:
    """JSON lines; the number of files is that of the partitions unless asked otherwise."""
    lines = as_json(in_order(df, first))
    (lines.coalesce(files) if files else lines).write.mode("errorifexists").text(path)


def finite_columns(df: DataFrame) -> DataFrame:
    """NaN and infinity of number columns as null, for reports."""
    real = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)) for c in real}) if real else df


def write_report(df: DataFrame, path: str) -> None:
    """A report-sized frame as one JSON file."""
    as_json(finite_columns(df)).coalesce(1).write.mode("errorifexists").text(path)


def events(df: DataFrame, side: str, seq: str, kind: str, payload: Column) -> DataFrame:
    """NDJSON events with side, sequence number, type and payload."""
    return df.select(F.to_json(F.struct(F.col(side).alias("side"), F.col(seq).alias("seq"), F.col(kind).alias("type"), payload.alias("payload")), NULLS).alias("value"))


def forbidden_keys(values: DataFrame, column: str, names: Sequence[str] = FORBIDDEN) -> DataFrame:
    """Rows whose VARIANT holds a forbidden key at any depth, by its JSON text outside string values."""
    pattern = '"(?:' + "|".join(names) + r')"\s*:'
    return values.where(F.to_json(column).rlike("(?i)" + pattern))


def write_results(frames: Mapping[str, DataFrame], path: str) -> None:
    """The parts of a result folder, then the marker that says it is whole."""
    spark: SparkSession | None = None
    for name, df in frames.items():
        spark = df.sparkSession
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
    if spark is not None:
        spark.createDataFrame([("complete",)], "value string").coalesce(1).write.text(f"{path}/complete")


def registration(name: str, path: str, columns: Mapping[str, str]) -> str:
    """The trainer's entry for a data set: relative path and column mapping."""
    if path.startswith("/") or ".." in path.split("/"):
        raise ValueError("the path must be relative")
    return json.dumps({name: {"file_name": path, "formatting": "sharegpt", "columns": dict(columns)}}, sort_keys=True)


def dataset_manifest(parts: Mapping[str, DataFrame], key: str, groups: Sequence[str]) -> DataFrame:
    """Rows, group counts and the set's hash sum of each part."""
    out = None
    for name, df in parts.items():
        counted = df.groupBy(*groups).agg(F.count("*").alias("n"), F.sum(F.xxhash64(key).cast("decimal(38,0)")).alias("hash_sum")).withColumn("part", F.lit(name))
        out = counted if out is None else out.unionByName(counted)
    if out is None:
        raise ValueError("no parts")
    return out


#: Bytes of a diagnostics file, and older files that are kept.
MOST_BYTES, BACKUPS = 10 * 2**20, 5


def rotating_append(df: DataFrame, path: str, most_bytes: int = MOST_BYTES, backups: int = BACKUPS) -> bool:
    """Append diagnostics as JSON lines to ``path/current``.

    What has ``most_bytes`` or more becomes ``path/backup-1`` first, older backups
    move up by one and the last goes.  A failure is swallowed: diagnostics never
    stop what they are about.  Whether the rows were written.
    """
    try:
        jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        files = at("current").getFileSystem(conf)
        if files.exists(at("current")) and files.getContentSummary(at("current")).getLength() >= most_bytes:
            files.delete(at(f"backup-{backups}"), True)
            for k in range(backups - 1, 0, -1):
                if files.exists(at(f"backup-{k}")):
                    files.rename(at(f"backup-{k}"), at(f"backup-{k + 1}"))
            files.rename(at("current"), at("backup-1"))
        as_json(df).write.mode("append").text(f"{path}/current")
        return True
    except Exception:
        return False


def write_run(path: str, predictions: DataFrame, scores: DataFrame, cases: DataFrame, least: float = 0.95) -> None:
    """The artifacts of a run: predictions, long scores, the effective pass rate and means by kind, and a detailed row a case.

    ``cases(case_id, kind, protocol, task)`` has the two scores that decide whether a
    case passes; the detail joins a case's answer, verdict, reasons and scores.
    """
    passed, reasons = effective_pass(F.col("protocol"), F.col("task"), least)
    judged = cases.withColumns({"passed": passed, "reasons": reasons})
    listed = scores.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("name", "field", "score", "detail"))).alias("scores"))
    detail = judged.join(predictions, "case_id", "left").join(listed, "case_id", "left")
    summary = judged.groupBy("kind").agg(F.count("*").alias("cases"), F.avg(F.col("passed").cast("double")).alias("pass_rate"), F.avg("protocol").alias("protocol"), F.avg("task").alias("task"))
    write_results({"predictions": predictions, "scores": scores, "summary": summary, "detail": detail}, path)
