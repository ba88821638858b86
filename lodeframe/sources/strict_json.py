"""Strict JSON: no fences, trailing text, repeated keys, NaN, infinity or overflow; the root is an object."""

from __future__ import annotations

import json
import math
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A number outside a double's range, as it may stand in JSON text outside strings.
HUGE = r"""[eE]\+?(?:3(?:0[89]|[1-9]\d)|[4-9]\d\d|\d{4,})"""


class StrictJSONError(ValueError):
    """Text that isn't one strict JSON object."""


def _unique(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise StrictJSONError("repeated key")
    return out


def _no_constant(name: str) -> Any:
    raise StrictJSONError(f"{name} is not JSON")


def _finite(text: str) -> float:
    x = float(text)
    if not math.isfinite(x):
        raise StrictJSONError("number out of range")
    return x


def parse(text: str) -> dict[str, Any]:
    """One object of a text, on the driver or in a function."""
    try:
        out = json.loads(text, object_pairs_hook=_unique, parse_constant=_no_constant, parse_float=_finite)
    except json.JSONDecodeError as e:
        raise StrictJSONError(str(e)) from e
    if not isinstance(out, dict):
        raise StrictJSONError("the root must be an object")
    return out


def strict_object(text: Column) -> Column:
    """The text as VARIANT, null unless it is one strict object.

    The built-in parser refuses repeated keys, NaN and fences; what it lets pass
    (text after the object, numbers beyond a double) is refused here.
    """
    trimmed = F.regexp_replace(text, r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    outside = F.regexp_replace(trimmed, r'"(?:[^"\\]|\\.)*"', "")
    depth_only = F.regexp_replace(outside, r"[^{}]", "")
    closes_once = _one_root(depth_only)
    v = F.try_parse_json(trimmed)
    ok = F.startswith(trimmed, F.lit("{")) & F.endswith(trimmed, F.lit("}")) & closes_once & ~outside.rlike(HUGE)
    return F.when(ok, v)


def _one_root(braces: Column) -> Column:
    """Whether a string of braces closes its first brace with its last."""
    depth = F.aggregate(
        F.filter(F.split(braces, ""), lambda b: b != ""),
        F.struct(F.lit(0).alias("d"), F.lit(0).alias("roots")),
        lambda acc, b: F.struct(
            (acc["d"] + F.when(b == "{", 1).otherwise(-1)).cast("int").alias("d"),
            (acc["roots"] + F.when((b == "}") & (acc["d"] == 1), 1).otherwise(0)).cast("int").alias("roots"),
        ),
    )
    return (depth["d"] == 0) & (depth["roots"] == 1)
