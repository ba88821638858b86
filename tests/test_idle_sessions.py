"""Sessions ended by timers against a plain walk, over several batches with late rows."""

import datetime as d
import random

from pyspark.sql import functions as F

from lodeframe.streaming import idle_sessions as I
from lodeframe.streaming import windows

START = d.datetime(2026, 1, 1)


def plain(rows, gap, watermark):
    """Sessions of rows ``(key, minute, field, value)`` that end before the watermark."""
    out = set()
    for key in {r[0] for r in rows}:
        own = sorted((m, v, f) for k, m, f, v in rows if k == key)
        sessions, last = [], None
        for m, v, f in own:
            if last is None or m > last + gap:
                sessions.append([])
            sessions[-1].append((m, v, f))
            last = m
        for s in sessions:
            if s[-1][0] + gap < watermark:
                for field in {f for *_, f in s}:
                    mine = [(m, v) for m, v, f in s if f == field]
                    out.add((key, s[0][0], s[-1][0], field, len(mine), max(mine)[1]))
    return out


def test_sessions_end_by_timer(spark, tmp_path):
    rng = random.Random(7)
    schema = "key string, minute long, field string, value double"
    batches = [[(rng.choice("abc"), m, rng.choice("xyz"), float(rng.randrange(50))) for m in sorted(rng.sample(range(lo, lo + 400), 60))] for lo in (0, 400, 800)]
    late = ("a", 5, "x", 99.0)  # long before the watermark when it comes
    lost = [(None, 810, "x", 1.0), ("a", None, "x", 1.0), ("a", 811, None, 1.0)]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows + ([late, *lost] if k == 2 else []), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    moment = F.expr("timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, minute)")
    stream = windows.read_stream(spark, str(tmp_path / "in")).withColumn("ts", moment)
    found = I.idle_sessions(stream, "key", "ts", "field", "value", "15 minutes", "30 minutes")
    minutes = lambda t: int((t - START).total_seconds() // 60)
    out = I.run_idle_sessions(spark, found, str(tmp_path / "run")).collect()
    got = {(r.key, minutes(r.started), minutes(r.ended), r.field, r.n, r.value) for r in out}
    rows = [r for b in batches for r in b]
    assert len(got) == len(out) and got == plain(rows, 15, max(r[1] for r in rows) - 30)
    # nothing new: the same folder gives the same rows
    assert len(I.run_idle_sessions(spark, found, str(tmp_path / "run")).collect()) == len(out)
