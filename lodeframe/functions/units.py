"""Unit conversion on columns, for data that isn't normalised yet."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_base_unit(amount: Column, unit: Column, factors: Mapping[str, Decimal]) -> Column:
    """``amount`` in base units by decimal arithmetic; unknown units and results that aren't positive give null."""
    factor = F.lit(None).cast("decimal(20,10)")
    for name, x in factors.items():
        factor = F.when(unit == name, F.lit(x).cast("decimal(20,10)")).otherwise(factor)
    out = (amount.cast("decimal(18,6)") * factor).cast("double")
    return F.when(out > 0, out)


def throughput(tokens: Column, milliseconds: Column) -> Column:
    """Tokens a second; null without both or for no time."""
    return F.try_divide(tokens * 1000.0, milliseconds)
