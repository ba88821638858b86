"""Sources: JSON lines with places, predictions, scorecards, event streams, remote and replayed completions."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .strict_json import StrictJSONError, parse, strict_object


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, line)`` of the lines that aren't blank, of every ``*.jsonl`` below a path, or of one file of any name.

    Files are read in splits.  A split numbers its own lines; the numbers of lines
    in the splits before it, one small row a split, are added.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
    if not re.search(r"\.[a-z]+$", path):
        reader = reader.option("pathGlobFilter", "*.jsonl")
    block = F.col("_metadata.file_block_start")
    raw = reader.text(path).select(F.col("_metadata.file_path").alias("file"), block.alias("block"), F.regexp_replace("value", r"\r$", "").alias("line"))
    # rows of a split follow each other in their task
    raw = raw.withColumn("at", F.monotonically_increasing_id())
    splits = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    numbered = raw.join(splits, ["file", "block"]).withColumn("line_no", (F.col("at") + F.col("shift")).cast("int"))
    return numbered.where(F.trim("line") != "").select("file", "line_no", "line")


def jsonl(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, value VARIANT)``; a bad line is an error that names file and line."""
    lines = text_lines(spark, path).withColumn("value", strict_object(F.col("line")))
    where = F.concat(F.lit("not a JSON object: "), "file", F.lit(":"), F.col("line_no").cast("string"))
    return lines.where(F.assert_true(F.col("value").isNotNull(), where).isNull()).drop("line")


def jsonl_with_errors(spark: SparkSession, path: str) -> DataFrame:
    """All lines, the bad ones with a null value."""
    return text_lines(spark, path).withColumn("value", strict_object(F.col("line")))


def typed(rows: DataFrame, ddl: str) -> DataFrame:
    """VARIANT rows as columns of a fixed schema; what doesn't fit is an error."""
    out = rows.withColumn("_t", F.from_json(F.to_json("value"), ddl, {"mode": "FAILFAST"}))
    return out.select("file", "line_no", "_t.*")


def user_text() -> Column:
    """What the user said, from either layout of a corpus row in the column ``value``."""
    chats = F.expr("cast(variant_get(value, '$.conversations', 'variant') as array<struct<`from`:string,value:string>>)")
    first = F.try_element_at(F.filter(chats, lambda c: c["from"] == "human"), F.lit(1))["value"]
    return F.coalesce(F.expr("try_variant_get(value, '$.input.user_input', 'string')"), first)


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """``(run_id, case_id, text)`` of prediction files; the run's name comes from the row or from the folder."""
    rows = jsonl(spark, path)
    run = F.coalesce(F.expr("try_variant_get(value, '$.run_id', 'string')"), F.regexp_extract("file", r"([^/]+)/[^/]*$", 1))
    case = F.coalesce(*[F.expr(f"try_variant_get(value, '$.{k}', 'string')") for k in ("case_id", "id")])
    return rows.select(run.alias("run_id"), case.alias("case_id"), F.expr("try_variant_get(value, '$.text', 'string')").alias("text"))


def scorecards(spark: SparkSession, glob: str, ddl: str) -> DataFrame:
    """One row a scorecard file, its run and size from the folder's name."""
    cards = spark.read.option("multiLine", "true").schema(ddl).json(glob).select("*", F.col("_metadata.file_path").alias("file"))
    run = F.regexp_extract("file", r"([^/]+)/[^/]*$", 1)
    return cards.withColumns({"run_id": run, "size": F.regexp_extract(run, r"(\d+(?:\.\d+)?)b", 1).cast("double")})


def calendar(data: Mapping[str, Any], spark: SparkSession, target_date: str | None = None) -> DataFrame:
    """Providers of an availability fixture: unique names, windows apart, all dates moved so that the first is ``target_date``."""
    names = [p["name"] for p in data["providers"]]
    if len(set(names)) != len(names):
        raise ValueError("repeated provider")
    rows = [(p["name"], p["group"], list(p["skills"]), w["start"], w["end"]) for p in data["providers"] for w in p["windows"]]
    flat = spark.createDataFrame(rows, "name string, grp string, skills array<string>, start string, end string")
    flat = flat.withColumns({c: F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz") for c in ("start", "end")})
    if target_date is not None:
        shift = flat.agg(F.date_diff(F.lit(target_date).cast("date"), F.min(F.col("start").cast("date")))).first()[0]
        flat = flat.withColumns({c: F.col(c) + F.expr(f"interval {shift} days") for c in ("start", "end")})
    ordered = F.array_sort(F.collect_list(F.struct("start", "end")))
    out = flat.groupBy("name", "grp").agg(F.first("skills").alias("skills"), ordered.alias("windows"))
    apart = F.forall(F.sequence(F.lit(1), F.size("windows")), lambda k: (k == F.size("windows")) | (F.get("windows", k - 1)["end"] <= F.coalesce(F.get("windows", k)["start"], F.get("windows", k - 1)["end"])))
    return out.where(F.assert_true(apart, F.concat(F.lit("overlapping windows of "), "name")).isNull())


def sse(lines: DataFrame) -> DataFrame:
    """One row a response from ``lines(request_id, seq, ts, line)``: text, time to the first text, usage.

    Lines are server-sent events; deltas are joined in order, ``[DONE]`` and
    comments carry nothing, and the last usage object wins.
    """
    data = lines.where(F.startswith("line", F.lit("data:")) & (F.trim(F.substr("line", F.lit(6))) != "[DONE]"))
    v = F.try_parse_json(F.trim(F.substr("line", F.lit(6))))
    read = data.withColumn("v", v).select(
        "request_id",
        "seq",
        "ts",
        F.coalesce(F.expr("try_variant_get(v, '$.choices[0].delta.content', 'string')"), F.expr("try_variant_get(v, '$.content', 'string')")).alias("piece"),
        F.expr("try_variant_get(v, '$.usage.completion_tokens', 'long')").alias("tokens"),
        F.expr("try_variant_get(v, '$.timings.predicted_ms', 'double')").alias("decode_ms"),
    )
    spoken = (F.col("piece").isNotNull()) & (F.col("piece") != "")
    pieces = F.array_sort(F.collect_list(F.when(spoken, F.struct("seq", "piece"))))
    return read.groupBy("request_id").agg(
        F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("text"),
        F.min(F.when(spoken, F.col("ts"))).alias("first_text_at"),
        F.max("ts").alias("ended_at"),
        F.max_by("tokens", F.when(F.col("tokens").isNotNull(), F.col("seq"))).alias("tokens"),
        F.max_by("decode_ms", F.when(F.col("decode_ms").isNotNull(), F.col("seq"))).alias("decode_ms"),
    )


# --- remote completions ---------------------------------------------------------------------------------------------

#: Sends one request and gives (status, body).
Transport = Callable[[str, Mapping[str, Any]], tuple[int, Mapping[str, Any]]]
RETRY_STATUS = (502, 503, 504)


def complete(send: Transport, url: str, body: Mapping[str, Any], attempts: int = 3, secret: str = "", sleep: Callable[[float], None] = time.sleep) -> dict[str, Any]:
    """One completion: retried on gateway errors after 1 and 2 seconds; a cut text gets twice the room; the secret never shows in an error."""
    body = dict(body)
    for k in range(attempts):
        status, answer = send(url, body)
        if status in RETRY_STATUS and k + 1 < attempts:
            sleep(2.0**k)
            continue
        if status != 200:
            message = str(answer).replace(secret, "***") if secret else str(answer)
            raise RuntimeError(f"status {status}: {message[:4000]}")
        choice = answer["choices"][0]
        if choice.get("finish_reason") == "length" and k + 1 < attempts and "max_tokens" in body:
            body["max_tokens"] *= 2
            continue
        return {"text": choice["message"]["content"], "finish_reason": choice.get("finish_reason"), "usage": answer.get("usage") or {}, "attempts": k + 1}
    raise RuntimeError("no answer")


def complete_items(send: Transport, url: str, body: Mapping[str, Any], attempts: int = 3, secret: str = "", sleep: Callable[[float], None] = time.sleep) -> dict[str, Any]:
    """One completion by the item protocol: the texts of all output items; an answer without text is asked for again."""

    def as_chat(at: str, asked: Mapping[str, Any]) -> tuple[int, Mapping[str, Any]]:
        status, answer = send(at, asked)
        if status != 200:
            return status, answer
        text = "".join(c.get("text", "") for item in answer.get("output", ()) for c in item.get("content") or () if c.get("type") == "output_text")
        return 200, {"choices": [{"message": {"content": text}, "finish_reason": answer.get("status")}], "usage": answer.get("usage")}

    for k in range(attempts):
        done = complete(as_chat, url, body, attempts, secret, sleep)
        if done["text"].strip():
            return done | {"attempts": k + done["attempts"]}
    raise RuntimeError("the answer was empty")


def as_items(messages: Iterable[Mapping[str, str]], schema: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """Chat messages as the item list of a responses request, with a closed schema as the output format."""
    out: dict[str, Any] = {"input": [{"role": m["role"], "content": [{"type": "output_text" if m["role"] == "assistant" else "input_text", "text": m["content"]}]} for m in messages]}
    if schema is not None:
        out["text"] = {"format": {"type": "json_schema", "name": "change", "strict": True, "schema": schema}}
    return out


def complete_all(requests: DataFrame, send: Transport, url: str, concurrency: int) -> DataFrame:
    """Responses of ``requests(case_id, body)``; as many in flight as partitions.

    Calls are side effects: write the result once and read it back; rows already
    answered are kept out by an anti join before.
    """

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for case_id, body in zip(batch["case_id"], batch["body"], strict=True):
                try:
                    done = complete(send, url, json.loads(body))
                    rows.append((case_id, done["text"], done["finish_reason"], done["attempts"], None))
                except RuntimeError as e:
                    rows.append((case_id, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["case_id", "text", "finish_reason", "attempts", "error"])

    return requests.select("case_id", "body").repartition(concurrency).mapInPandas(call, "case_id string, text string, finish_reason string, attempts int, error string")


def validate_and_retry(ask: Callable[[str | None], str], accept: Callable[[dict[str, Any]], list[str]], attempts: int) -> tuple[dict[str, Any] | None, list[str]]:
    """Ask until an answer is accepted, the errors of one attempt being told to the next."""
    told: list[str] = []
    for _ in range(attempts):
        try:
            answer = parse(ask("; ".join(told) or None))
            told = accept(answer)
        except StrictJSONError as e:
            told = [str(e)]
            continue
        if not told:
            return answer, []
    return None, told


SOURCES: dict[str, Callable[..., DataFrame]] = {"jsonl": jsonl, "predictions": predictions, "scorecards": scorecards}


def source(kind: str, spark: SparkSession, *args: Any, **options: Any) -> DataFrame:
    """A source by name; Spark's own formats are taken too."""
    if kind in SOURCES:
        return SOURCES[kind](spark, *args, **options)
    return spark.read.format(kind).options(**options).load(*args)
