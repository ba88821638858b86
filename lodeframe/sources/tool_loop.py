"""The bounded tool loop: an answer may ask for a tool, whose result is told to the next question."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

from .strict_json import StrictJSONError, parse

#: Gives the next answer's text for the messages so far.
Ask = Callable[[list[dict[str, Any]]], str]
Tool = Callable[[Mapping[str, Any]], Mapping[str, Any]]
LOOP_DDL = "case_id string, status string, calls int, answer string, messages string"


def run_loop(messages: list[dict[str, Any]], ask: Ask, tools: Mapping[str, Tool], most_calls: int) -> tuple[str, int, str | None, list[dict[str, Any]]]:
    """``(status, calls, answer, messages)``.

    A final answer ends the loop (``completed``); one that isn't JSON, a tool that
    nobody knows or that fails (``failed``), or one call more than ``most_calls``
    (``too_many_calls``) end it too.  Nothing is asked after the end.
    """
    log = list(messages)
    calls = 0
    while True:
        text = ask(log)
        try:
            answer = parse(text)
        except StrictJSONError:
            return "invalid", calls, text, log
        if answer.get("action") != "tool_call":
            return "completed", calls, text, log
        if calls == most_calls:
            return "too_many_calls", calls, text, log
        calls += 1
        name = f"call-{calls}"
        arguments = answer.get("arguments") or {}
        log.append({"role": "assistant", "content": None, "tool_calls": [{"id": name, "type": "function", "function": {"name": answer.get("tool_name"), "arguments": json.dumps(arguments, ensure_ascii=False)}}]})
        try:
            result = tools[answer["tool_name"]](arguments)
        except Exception as e:
            return "failed", calls, f"{type(e).__name__}: {e}", log
        log.append({"role": "tool", "tool_call_id": name, "content": json.dumps(result, ensure_ascii=False)})


def run_all(requests: DataFrame, ask: Ask, tools: Mapping[str, Tool], most_calls: int, concurrency: int) -> DataFrame:
    """The loop for every row of ``requests(case_id, text)``; as many at a time as partitions."""

    def loop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for case_id, text in zip(batch["case_id"], batch["text"], strict=True):
                status, calls, answer, log = run_loop([{"role": "user", "content": text}], ask, tools, most_calls)
                rows.append((case_id, status, calls, answer, json.dumps(log, ensure_ascii=False)))
            yield pd.DataFrame(rows, columns=["case_id", "status", "calls", "answer", "messages"])

    return requests.select("case_id", "text").repartition(concurrency).mapInPandas(loop, LOOP_DDL)
