"""The session fold as a stream: state by session, committed turn by turn."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..facets import Catalog
from ..plans.compiler import State, merge, patch_problems, query_parameters, read_state
from ..plans.predicates import PredicateError
from ..sources.strict_json import StrictJSONError, parse

OUT = "session string, seq long, committed boolean, error string, state string, filter string"


def step(state: State, text: str, catalog: Catalog, currency: str | None) -> tuple[State, str | None, str | None]:
    """The next state: only if the change is read, validated, merged and compiled; else the state before."""
    try:
        patch, problems = patch_problems(parse(text), catalog)
        if patch is None:
            return state, "; ".join(f"{p.path}: {p.message}" for p in problems), None
        after = merge(state, patch, catalog)
        parameters, _ = query_parameters(after, catalog, currency)
    except (StrictJSONError, PredicateError) as e:
        return state, str(e), None
    return after, None, parameters.get("filter_by")


def fold_turns(start: State, turns: list[tuple[int, str]], catalog: Catalog, currency: str | None) -> tuple[State, list[tuple[int, bool, str | None, str, str | None]]]:
    out = []
    state = start
    for seq, text in sorted(turns):
        state, error, filter_by = step(state, text, catalog, currency)
        out.append((seq, error is None, error, json.dumps(state.write(), ensure_ascii=False, sort_keys=True), filter_by))
    return state, out


def fold_batch(turns: DataFrame, catalog: Catalog, currency: str | None = None) -> DataFrame:
    """The fold over ``turns(session, seq, text)`` in batch."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        _, out = fold_turns(State(), list(zip(rows["seq"], rows["text"], strict=True)), catalog, currency)
        return pd.DataFrame([(rows["session"].iloc[0], *r) for r in out], columns=["session", "seq", "committed", "error", "state", "filter"])

    return turns.select("session", "seq", "text").groupBy("session").applyInPandas(run, OUT)


def fold_stream(turns: DataFrame, catalog: Catalog, currency: str | None = None, idle_ms: int | None = None) -> DataFrame:
    """The fold over a stream; with ``idle_ms``, a session that was idle for so long is forgotten."""

    def run(key: tuple[str], batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        kept: dict[str, Any] | None = json.loads(held.get[0]) if held.exists else None
        state = State() if kept is None else read_state(kept, catalog)
        rows = [pair for b in batches for pair in zip(b["seq"], b["text"], strict=True)]
        state, out = fold_turns(state, rows, catalog, currency)
        held.update((json.dumps(state.write(), ensure_ascii=False),))
        if idle_ms is not None:
            held.setTimeoutDuration(idle_ms)
        yield pd.DataFrame([(key[0], *r) for r in out], columns=["session", "seq", "committed", "error", "state", "filter"])

    grouped = turns.select("session", "seq", "text").groupBy("session")
    return grouped.applyInPandasWithState(run, OUT, "state string", "append", GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout)
