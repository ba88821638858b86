"""Queries of session state, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sessions
from ..streaming import idle_sessions
from ..streaming import windows as stream
from .catalog import register, table

FIELDS = ("click", "error", "purchase", "signup", "view")

_STATES = (
    """
WITH turns AS (SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id))::INT AS turn, event_type, value, value < 3 AS resets FROM events),
marked AS (SELECT *, coalesce(max(CASE WHEN resets THEN turn END) OVER w, 0) AS reset_at FROM turns WINDOW w AS (PARTITION BY user_id ORDER BY turn)),
"""
    + ",\n".join(
        f"f{k} AS (SELECT user_id, turn, reset_at, '{f}' AS field, max(CASE WHEN event_type = '{f}' THEN turn END) OVER w AS seen_at, last_value(CASE WHEN event_type = '{f}' THEN value END IGNORE NULLS) OVER w AS value FROM marked WINDOW w AS (PARTITION BY user_id ORDER BY turn))"
        for k, f in enumerate(FIELDS)
    )
    + ",\nstates AS ("
    + " UNION ALL ".join(f"SELECT user_id, turn, field, value FROM f{k} WHERE seen_at >= reset_at" for k in range(len(FIELDS)))
    + ")\n"
)


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as turns: the type is the field, values under 3 reset the state first."""
    day = F.date_trunc("day", "ts")
    return sessions.fold(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], FIELDS, F.col("value") < 3, field="event_type", bucket=day)


@register(_STATES + "SELECT * FROM states")
def state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir)


@register(
    _STATES
    + """
SELECT user_id, turn, field, b.value AS before, a.value AS after
FROM states a FULL JOIN (SELECT user_id, (turn + 1)::INT AS turn, field, value FROM states) b USING (user_id, turn, field)
WHERE turn <= (SELECT max(turn) FROM states s WHERE s.user_id = coalesce(a.user_id, b.user_id)) AND a.value IS DISTINCT FROM b.value
"""
)
def state_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.state_diff(_states(spark, sf_dir), "user_id")


@register("""
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL
""")
def hourly_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stream.tumbling(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"], "value")
    return out.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))


@register("""
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, count(*) AS n FROM (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events)) GROUP BY user_id, s
""")
def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stream.sessions(table(spark, sf_dir, "events"), "ts", "6 hours", ["user_id"])
    return out.select("user_id", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("started"), "n")


@register("""
SELECT user_id, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY user_id
""")
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts by session from the events replayed as a stream with the files at hand, read from its last state."""
    return stream.replay_counts(spark, f"{sf_dir}/events.parquet", "user_id", "event_id")


@register("""
WITH e AS (SELECT user_id, ts, event_type, value, ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR AS fresh FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL),
s AS (SELECT *, sum(coalesce(fresh, false)::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM e),
spans AS (SELECT user_id, session, min(ts) AS started, max(ts) AS ended FROM s GROUP BY ALL),
over_ AS (SELECT * FROM spans WHERE ended + INTERVAL 6 HOUR < (SELECT max(ts) FROM e) - INTERVAL 10 MINUTE)
SELECT user_id, started, ended, event_type AS field, count(*) AS n, arg_max(value, (ts, value)) AS value FROM s JOIN over_ USING (user_id, session) GROUP BY ALL
""")
def ended_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' sessions that a timer has ended, with the count and the latest value of each event type."""
    events = stream.read_stream(spark, f"{sf_dir}/events.parquet")
    found = idle_sessions.idle_sessions(events, "user_id", "ts", "event_type", "value", "6 hours", "10 minutes")
    return idle_sessions.run_idle_sessions(spark, found).withColumnRenamed("key", "user_id")
