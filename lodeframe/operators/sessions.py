"""Session state from change logs, without a user function.

A valid change replaces a field whole, so a field's value after a turn is that
of the last valid turn that touched it, if no reset came after.  A reset applies
its own conditions after emptying the state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .generation import small
from .ranking import distributed_rank


def fold(
    changes: DataFrame, session: str, order: Sequence[str], fields: Sequence[str], resets: Column, field: str = "field", value: str = "value", bucket: Column | None = None
) -> DataFrame:
    """State rows ``(session, turn, field, value)`` after every turn.

    ``changes`` has one row a turn; ``resets`` marks turns that empty the state
    first.  A null value clears its field.  With ``bucket``, which must not fall as
    the order rises, a session is folded bucket by bucket, each by a task of its
    own, and the last values of the buckets before, one row a bucket, are added: so
    a session with a third of all turns is folded by many tasks.
    """
    marked = changes.withColumn("_bucket", F.lit(0) if bucket is None else bucket).withColumn("_reset", F.coalesce(resets, F.lit(False)))
    turns = distributed_rank(marked, [session], [F.col(c) for c in order], F.col("_bucket"), "turn").withColumn("turn", F.col("turn").cast("int"))
    turns = turns.select(session, "turn", "_reset", F.col(field).alias("_field"), F.col(value).alias("_value"), *([] if bucket is None else [bucket.alias("_bucket")]))
    if bucket is None:
        turns = turns.withColumn("_bucket", F.lit(0))
    # turns rise, so the last of something is the greatest by turn
    reset = F.max(F.when(F.col("_reset"), F.col("turn")))
    last = {f"_f{k}": F.max(F.when(F.col("_field") == f, F.struct("turn", F.col("_value").alias("value")))) for k, f in enumerate(fields)}
    inside = Window.partitionBy(session, "_bucket").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wide = turns.select(session, "_bucket", "turn", reset.over(inside).alias("_r"), *[c.over(inside).alias(n) for n, c in last.items()])
    sums = turns.groupBy(session, "_bucket").agg(reset.alias("_r"), *[c.alias(n) for n, c in last.items()])
    earlier = Window.partitionBy(session).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.col(session).alias("_s"), F.col("_bucket").alias("_b"), *[F.max(n).over(earlier).alias(f"{n}_before") for n in ("_r", *last)])
    both = wide.join(carried, wide[session].eqNullSafe(carried["_s"]) & wide["_bucket"].eqNullSafe(carried["_b"]))
    now = lambda n: F.coalesce(F.col(n), F.col(f"{n}_before"))
    cells = F.array(*[F.struct(F.lit(f).alias("field"), now(f"_f{k}")["turn"].alias("at"), now(f"_f{k}")["value"].alias("value")) for k, f in enumerate(fields)])
    alive = F.filter(cells, lambda c: c["at"].isNotNull() & (c["at"] >= F.coalesce(now("_r"), F.lit(0))) & c["value"].isNotNull())
    return both.select(session, "turn", F.explode(alive).alias("c")).select(session, "turn", F.col("c.field").alias("field"), F.col("c.value").alias("value"))


def state_diff(states: DataFrame, session: str) -> DataFrame:
    """Fields whose value differs from the turn before, with both values; null where the field was or is absent."""
    now = states.withColumnRenamed("value", "after")
    before = states.select(session, (F.col("turn") + 1).alias("turn"), "field", F.col("value").alias("before"))
    last = states.groupBy(session).agg(F.max("turn").alias("_last"))
    both = now.join(before, [session, "turn", "field"], "full_outer").join(last, session)
    # a value that no later turn of the session follows wasn't removed
    return both.where((F.col("turn") <= F.col("_last")) & ~F.col("before").eqNullSafe(F.col("after"))).select(session, "turn", "field", "before", "after")


def merge_arrays(before: Column, after: Column, cleared: Column, reset: Column) -> Column:
    """Conditions after a change, over arrays of structs with ``field``: touched fields are dropped, new conditions appended."""
    touched = F.array_union(F.transform(after, lambda c: c["field"]), cleared)
    kept = F.filter(before, lambda c: ~F.array_contains(touched, c["field"]))
    return F.when(reset, after).otherwise(F.concat(kept, after))


def contradictions(conditions: DataFrame, keys: Sequence[str], factor: Column | None = None) -> DataFrame:
    """Groups of numeric conditions ``(keys, op, value, min_value, max_value)`` whose range is empty."""
    scale = F.lit(1.0) if factor is None else factor
    low = F.when(F.col("op").isin("eq", "gte"), F.col("value")).when(F.col("op") == "between", F.col("min_value")) * scale
    high = F.when(F.col("op").isin("eq", "lte"), F.col("value")).when(F.col("op") == "between", F.col("max_value")) * scale
    return conditions.groupBy(*keys).agg(F.max(low).alias("low"), F.min(high).alias("high")).where("low > high")


def set_contradictions(conditions: DataFrame, keys: Sequence[str], closure: DataFrame) -> DataFrame:
    """Groups of set conditions ``(keys, op, values)`` where all that one ``in`` wants is excluded, descendants included."""
    numbered = conditions.withColumn("_c", F.monotonically_increasing_id())
    codes = numbered.select(*keys, "op", "_c", F.explode("values").alias("code")).join(small(closure), "code")
    excluded = codes.where("op = 'not_in'").select(*keys, F.col("descendant").alias("gone")).distinct()
    wanted = codes.where("op = 'in'").select(*keys, "_c", "descendant").distinct()
    on = [F.col(f"w.{k}").eqNullSafe(F.col(f"x.{k}")) for k in keys] + [F.col("w.descendant") == F.col("x.gone")]
    left = wanted.alias("w").join(excluded.alias("x"), on, "left").groupBy(*[F.col(f"w.{k}").alias(k) for k in keys], "_c")
    return left.agg(F.count_if(F.col("gone").isNull()).alias("open")).where("open = 0").select(*keys).distinct()
