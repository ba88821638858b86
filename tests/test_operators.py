"""Operators on small frames, with the facts that fix their meaning."""

import json
import random
from datetime import datetime
from decimal import Decimal
from difflib import SequenceMatcher

import numpy as np
import pytest
from lodeframe.functions import text as T
from lodeframe.functions import times, units, vectors
from lodeframe.operators import corpus, generation, hierarchies, matching, pairing, provenance, ranking, reports, sessions
from lodeframe.sources import readers, sinks
from lodeframe.sources.strict_json import StrictJSONError, parse, strict_object
from lodeframe.streaming import session_state, windows
from pyspark.sql import functions as F

from .shelf import CATALOG, condition, patch

BAD_JSON = ['{"a":1} x', '{"a":1e400}', '{"a":1,"a":2}', '{"a":NaN}', "[1]", "```json\n{}\n```", "", '{"a":1}{"b":2}', "{'a':1}", "{"]
GOOD_JSON = ['{"a":1}', ' {"a":{"b":"} {"}} \n', '{"a":"1e400"}', "{}", '{"e":1e30}']


def test_strict_json(spark):
    df = spark.createDataFrame([(x,) for x in BAD_JSON + GOOD_JSON], "t string")
    got = {r.t: r.ok for r in df.select("t", strict_object(F.col("t")).isNotNull().alias("ok")).collect()}
    assert [got[x] for x in BAD_JSON] == [False] * len(BAD_JSON) and all(got[x] for x in GOOD_JSON)
    for x in BAD_JSON:
        with pytest.raises(StrictJSONError):
            parse(x)
    assert all(isinstance(parse(x), dict) for x in GOOD_JSON)


def test_jsonl_and_sinks(spark, tmp_path):
    (tmp_path / "run-1").mkdir()
    (tmp_path / "run-1" / "p.jsonl").write_text('{"id":"a","text":"x"}\n\n{"case_id":"b","text":"y","run_id":"r"}\n')
    out = {tuple(r) for r in readers.predictions(spark, str(tmp_path)).collect()}
    assert out == {("run-1", "a", "x"), ("r", "b", "y")}
    (tmp_path / "run-1" / "bad.jsonl").write_text('{"id":1}\n[2]\n')
    bad = readers.jsonl_with_errors(spark, str(tmp_path)).where("value is null").collect()
    assert [(r.line_no, r.line) for r in bad] == [(2, "[2]")]
    with pytest.raises(Exception, match="bad.jsonl:2"):
        readers.jsonl(spark, str(tmp_path)).collect()
    df = spark.createDataFrame([("é", None, float("nan"))], "b string, a string, x double")
    sinks.write_jsonl(df.drop("x"), str(tmp_path / "out"), first=["a"])
    assert spark.read.text(str(tmp_path / "out")).first()[0] == '{"a":null,"b":"é"}'
    sinks.write_report(df, str(tmp_path / "report"))
    assert json.loads(spark.read.text(str(tmp_path / "report")).first()[0])["x"] is None
    sinks.write_results({"one": df}, str(tmp_path / "res"))
    assert provenance.path_exists(spark, str(tmp_path / "res" / "complete" / "_SUCCESS"))
    v = spark.createDataFrame([('{"a":{"Token":1}}',), ('{"a":"token"}',)], "t string").select(F.parse_json("t").alias("v"))
    assert sinks.forbidden_keys(v, "v").count() == 1
    with pytest.raises(ValueError):
        sinks.registration("x", "/abs", {})


def test_user_text_layouts(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"input":{"user_input":"one"}}\n{"conversations":[{"from":"system","value":"s"},{"from":"human","value":"two"}]}\n')
    assert [r[0] for r in readers.jsonl(spark, str(tmp_path)).orderBy("line_no").select(readers.user_text()).collect()] == ["one", "two"]


def test_sse(spark):
    lines = [("r", 0, 10, ": hi"), ("r", 1, 11, 'data: {"choices":[{"delta":{"content":""}}]}'), ("r", 2, 15, 'data: {"choices":[{"delta":{"content":"Hel"}}]}'), ("r", 3, 16, 'data: {"choices":[{"delta":{"content":"lo"}}],"usage":{"completion_tokens":2}}'), ("r", 4, 20, "data: [DONE]")]
    r = readers.sse(spark.createDataFrame(lines, "request_id string, seq int, ts int, line string")).first()
    assert (r.text, r.first_text_at, r.ended_at, r.tokens) == ("Hello", 15, 16, 2)


def test_completion_retries_and_redacts():
    answers = [(503, {}), (200, {"choices": [{"message": {"content": "cut"}, "finish_reason": "length"}]}), (200, {"choices": [{"message": {"content": "whole"}, "finish_reason": "stop"}]})]
    seen, slept = [], []
    out = readers.complete(lambda u, b: (seen.append(b["max_tokens"]), answers[len(seen) - 1])[1], "u", {"max_tokens": 5}, sleep=slept.append)
    assert out["text"] == "whole" and seen == [5, 5, 10] and slept == [1.0]
    with pytest.raises(RuntimeError, match=r"\*\*\*"):
        readers.complete(lambda u, b: (401, {"key": "abc"}), "u", {}, secret="abc")
    told = []
    answer, errors = readers.validate_and_retry(lambda e: (told.append(e), "x" if e is None else '{"a":1}')[1], lambda a: [], 3)
    assert answer == {"a": 1} and errors == [] and told[0] is None and told[1]
    assert readers.as_items([{"role": "user", "content": "q"}])["input"][0]["content"][0]["type"] == "input_text"
    # by the item protocol: an answer without text is asked for again
    answers = iter([{"output": []}, {"output": [{"type": "message", "content": [{"type": "output_text", "text": "a"}, {"type": "other"}]}, {"type": "reasoning"}, {"content": [{"type": "output_text", "text": "b"}]}]}])
    done = readers.complete_items(lambda url, body: (200, next(answers)), "u", {}, sleep=lambda s: None)
    assert (done["text"], done["attempts"]) == ("ab", 2)
    with pytest.raises(RuntimeError, match="empty"):
        readers.complete_items(lambda url, body: (200, {"output": []}), "u", {}, sleep=lambda s: None)


def test_replay(spark):
    samples = spark.createDataFrame([("a", "x"), ("b", "y")], "sample_id string, user_input string")
    stored = spark.createDataFrame([("a", None, "1"), (None, "y", "2")], "sample_id string, user_input string, response string")
    assert {r.sample_id: r.response for r in matching.lookup_replay(samples, stored).collect()} == {"a": "1", "b": "2"}
    with pytest.raises(Exception, match="no response for b"):
        matching.lookup_replay(samples, stored.where("sample_id = 'a'")).collect()


def test_text_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(T.squeeze(F.lit("　 a \n\t b　"))) == "a b"
    assert get(T.ngrams(F.lit("abcd"), 3)) == ["abc", "bcd"] and get(T.ngrams(F.lit("a"), 2)) == ["a"] and get(T.ngrams(F.lit(""), 2)) == []
    assert get(T.similarity(F.lit("abcd"), F.lit("abcd"))) == 1 and get(T.similarity(F.lit("aaa"), F.lit("ab"))) == 0
    assert get(T.multiset_overlap(F.array(*map(F.lit, "aab")), F.array(*map(F.lit, "aac")))) == 2
    assert get(T.normalize_reply(F.lit(" 一个半小时， OK！"))) == "90分钟ok"
    assert get(T.normalize_reply(F.lit("十二点"))) == "十2点"
    assert get(T.mentions(F.lit("a Dark-chocolate bar"), "dark chocolate")) and not get(T.mentions(F.lit("pineapples"), "apple"))
    assert get(T.numbers_in(F.lit("3.5 kg or 12, v1.2.3"))) == [Decimal("3.5"), Decimal("12")]
    assert get(T.redact(F.lit("key abc"), "abc", 6)) == "key **"
    import hashlib

    assert all(get(T.hash_choice(F.lit(s), 7)) == int(hashlib.sha256(s.encode()).hexdigest(), 16) % 7 for s in ("a", "b", "case"))
    assert get(T.fingerprint(F.lit(" a  b"))) == get(T.fingerprint(F.lit("a b ")))
    assert get(T.reply_score(F.lit(1), F.lit(2), F.lit(0.5))) == pytest.approx(0.5)
    said = lambda t: get(T.acts_of(F.lit(t)))
    assert said("请问您什么时候方便？") == ["ask_for_start_time"] and said("已确认60分钟服务") == ["request_confirmation"]
    assert said("已经为您预约") == ["claim_booking_success"] and said("技师排满了") == ["inform_technician_unavailable"]
    acts = lambda *a: F.array(*map(F.lit, a)) if a else F.array().cast("array<string>")
    judged = get(T.judge_reply(F.lit("请问什么时候？已经预约"), acts("ask_for_start_time"), acts("claim_booking_success"), acts()))
    assert (judged.score, judged.passed, judged.forbidden) == (1.0, False, ["claim_booking_success"])
    stamp = lambda *a: F.lit(datetime(*a)).cast("timestamp_ntz")
    forms = get(times.time_forms(stamp(2026, 3, 2, 15, 30), stamp(2026, 3, 1, 9)))
    assert {"2026-03-02 15:30", "3月2日15点30分", "3月2号15点30分", "15:30", "15点30分", "下午3点30分", "明天15点30分", "明天下午3点30分", "2026年03月02日15点30分"} == set(forms)
    assert not any("天" in f for f in get(times.time_forms(stamp(2026, 3, 4, 12), stamp(2026, 3, 1, 9)))) and "上午9点" in get(times.time_forms(stamp(2026, 3, 4, 9)))
    assert get(units.to_base_unit(F.lit(8), F.lit("oz"), {"oz": Decimal("28.349523125")})) == pytest.approx(226.796185)
    assert get(vectors.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)))) == pytest.approx(0.5**0.5)
    now = F.lit(datetime(2026, 3, 1, 10)).cast("timestamp_ntz")
    when = lambda s: str(get(times.resolve_relative(F.lit(s), F.lit(None).cast("timestamp_ntz"), now)))
    assert when("明天下午三点30分") == "2026-03-02 15:30:00" and when("今天中午12点") == "2026-03-01 12:00:00" and when("后天上午12点") == "2026-03-03 00:00:00"
    assert when("today\x01x\x01y\x01z\x01w") == "None" and when("明天\n吧，上午\n9:05 ok 后天10点") == "2026-03-02 09:05:00"
    assert when("明天25点") == "None" and when("三点") == "None" and when("今天下午的按摩，时间2点钟") == "2026-03-01 14:00:00"


def test_ranks_spread_and_agree(spark):
    df = spark.range(500).selectExpr("id", "case when id % 3 = 0 then 'hot' else concat('g', id % 7) end g")
    got = {(r.g, r.id): r["rank"] for r in ranking.hashed_rank(df, ["g"], "s", "id").collect()}
    import hashlib

    for g in {k for k, _ in got}:
        ids = sorted((i for x, i in got if x == g), key=lambda i: hashlib.sha256(f"s:{g}:{i}".encode()).hexdigest())
        assert [got[g, i] for i in ids] == list(range(1, len(ids) + 1))
    order = [r.id for r in ranking.interleave(spark.createDataFrame([(0, "b"), (1, "b"), (2, "a"), (3, "b"), (4, "a")], "id int, g string"), "g", "id").orderBy("position").collect()]
    assert order == [0, 2, 1, 4, 3]


def test_least_used_against_a_plain_walk(spark):
    import hashlib

    rows = [(k, f"g{k % 3}" if k % 7 else None) for k in range(120)]
    used = [("g0", "b", 5), ("g0", "c", 2), (None, "a", 40), ("g1", "zz", 3)]
    choices = ["a", "b", "c", "d"]
    out = generation.least_used(spark.createDataFrame(rows, "id int, g string"), "g", "id", choices, spark.createDataFrame(used, "g string, choice string, n int"), "s")
    got = {r.id: r.choice for r in out.collect()}
    for g in {g for _, g in rows}:
        counts = {c: next((n for x, y, n in used if (x, y) == (g, c)), 0) for c in choices}
        # Spark concatenates a null group to null, which hashes no choice: they stay in order of name
        order = sorted(choices, key=lambda c: (hashlib.sha256(f"s:{c}:{g}".encode()).hexdigest() if g else "", c))
        for i, x in rows:
            if x == g:
                want = min(choices, key=lambda c: (counts[c], order.index(c)))
                assert got[i] == want, (g, i)
                counts[want] += 1


def test_null_groups_lose_no_row(spark):
    """Groups of any number and with null among them; both ways of interleaving agree with a plain round robin."""
    rows = [(k, None if k % 4 == 0 else f"g{k % 3}") for k in range(50)]
    df = spark.createDataFrame(rows, "id int, g string")
    waiting = {}
    for i, g in rows:
        waiting.setdefault(g, []).append(i)
    want = [ids[turn] for turn in range(50) for ids in waiting.values() if turn < len(ids)]
    for few in (1, 1000):
        out = ranking.interleave(df, "g", "id", width=4, few_groups=few)
        assert out.columns == ["id", "g", "position"]
        assert [(r.id, r.position) for r in out.orderBy("position").collect()] == [(i, k + 1) for k, i in enumerate(want)]
    assert ranking.simple_split(df, "g", "id", 0.2, "s").count() == 50
    assert ranking.stratified_split(df, ["g"], "id", 0.2, "s").count() == 50
    pairs = df.selectExpr("id", "g as target", "if(id % 5 < 2, 'validation', 'train') split", "4 as wanted")
    assert {r.target for r in ranking.select_pairs(pairs, "id", 0.5, "s").collect()} == set(waiting)


def test_splits(spark):
    assert ranking.split_quotas({("a",): 1, ("b",): 2, ("c",): 30}, 0.1) == {("a",): 0, ("b",): 1, ("c",): 2}
    quotas = ranking.split_quotas({("a",): 15, ("b",): 15, ("c",): 15, ("d",): 15}, 0.1)
    assert sum(quotas.values()) == 6 and max(quotas.values()) == 2
    df = spark.range(103).selectExpr("id", "id % 4 = 0 even", "cast(id % 5 as string) s")
    split = ranking.stratified_split(df, ["s", "even"], "id", 0.2, "x")
    again = ranking.stratified_split(df.repartition(7), ["s", "even"], "id", 0.2, "x")
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, again.collect()))
    assert split.where("split = 'validation'").count() == 21
    assert ranking.remainder_split({"a": 14, "b": 16}, 0.1) == {"a": 1, "b": 2}
    pairs = spark.createDataFrame([("t", "train", k, 10) for k in range(20)] + [("t", "validation", 100, 10)], "target string, split string, id int, wanted int")
    picked = ranking.select_pairs(pairs, "id", 0.2, "s")
    assert picked.count() == 10 or picked.where("split = 'validation'").count() == 1


def test_reports(spark):
    x = spark.createDataFrame([(57.0,), (59.0,), (float("nan"),), (-1.0,)], "v double")
    r = reports.workload_summary(x.where("v > 0 and not isnan(v)").withColumn("g", F.lit(1)), ["g"], ["v"]).first()
    assert (r["mean"], r["median"], r.p90) == (58.0, 58.0, 58.8)
    assert reports.workload_summary(x.limit(0).withColumn("g", F.lit(1)), ["g"], ["v"]).collect() == []
    assert reports.timing_summary(x, "v").first()["count"] == 2
    f = reports.micro_f1(spark.createDataFrame([(0, 0, 3)], "tp int, fp int, fn int")).first()
    assert (f.precision, f.recall, f.f1) == (0.0, 0.0, 0.0)
    f = reports.micro_f1(spark.createDataFrame([(0, 0, 0)], "tp int, fp int, fn int")).first()
    assert (f.precision, f.recall, f.f1) == (None, None, None)
    a = spark.createDataFrame([(1, True), (2, False)], "id int, p boolean")
    with pytest.raises(Exception, match="different cases"):
        reports.run_diff(a, a.where("id = 1"), "id", "p").collect()
    with pytest.raises(ValueError):
        reports.deficits(reports.counters(a, {"id": F.array("id")}), {"nope": {"1": 1}})
    runs = spark.createDataFrame([("a", None, "completed", 10, 0.9, 2.0), ("b", "a", "completed", 12, 0.87, 1.0), ("c", "a", "completed", 9, 0.9, 1.0)], "run_id string, parent_run_id string, status string, passed int, score double, size double")
    assert ranking.winner(runs).first().run_id == "c"
    table = reports.markdown_table(runs, ["run_id", "passed"], "run_id").first()[0]
    assert table.splitlines()[2] == "| a | 10 |"


def test_exact_percentiles(spark):
    rows = [("a", float(k % 13) / 7) for k in range(101)] + [("b", 5.0)] + [("c", 1e9), ("c", 0.0)] + [("d", float("nan"))] + [(None, 2.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.fraction): r.percentile for r in reports.exact_percentiles(df, ["g"], "v", [0.0, 0.25, 0.5, 0.95, 1.0]).collect()}
    want = df.where("not isnan(v)").groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, [0.0, 0.25, 0.5, 0.95, 1.0]))).alias("p")).collect()
    for r in want:
        for f, p in zip([0.0, 0.25, 0.5, 0.95, 1.0], r.p, strict=True):
            assert got[r.g, f] == pytest.approx(p), (r.g, f)
    assert len(got) == 20


def test_sessions_and_sets(spark):
    log = spark.createDataFrame([("s", 1, "a", 1, False), ("s", 2, "b", 2, False), ("s", 3, "a", 3, True), ("s", 4, "a", None, False)], "s string, t int, field string, value int, r boolean")
    got = sorted((r.turn, r.field, r.value) for r in sessions.fold(log, "s", ["t"], ["a", "b"], F.col("r")).collect())
    assert got == [(1, "a", 1), (2, "a", 1), (2, "b", 2), (3, "a", 3)]
    changes = sorted((r.turn, r.field, r.before, r.after) for r in sessions.state_diff(sessions.fold(log, "s", ["t"], ["a", "b"], F.col("r")), "s").collect())
    assert changes == [(1, "a", None, 1), (2, "b", None, 2), (3, "a", 1, 3), (3, "b", 2, None)]
    ranges = spark.createDataFrame([(1, "gte", 5.0, None, None), (1, "between", None, 1.0, 4.0), (2, "eq", 3.0, None, None)], "k int, op string, value double, min_value double, max_value double")
    assert [r.k for r in sessions.contradictions(ranges, ["k"]).collect()] == [1]


def test_matching(spark):
    scored = spark.createDataFrame([(1, 0, 0, 0.9), (1, 0, 1, 0.95), (1, 1, 1, 0.9), (1, 1, 0, 0.5)], "c int, i int, j int, score double")
    assert {(r.i, r.j) for r in pairing.greedy_pairs(scored, "c", 0.7).collect()} == {(0, 1)}
    w = spark.sql("select array(named_struct('start', timestamp_ntz'2026-01-01 09:00:00', 'end', timestamp_ntz'2026-01-01 10:00:00')) w")
    fits = lambda a, b: w.select(matching.contained(F.col("w"), F.expr(f"timestamp_ntz'{a}'"), F.expr(f"timestamp_ntz'{b}'"))).first()[0]
    assert fits("2026-01-01 09:00:00", "2026-01-01 10:00:00") and not fits("2026-01-01 09:00:00", "2026-01-01 10:01:00")
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", None)], "c string, p string")
    assert {tuple(r) for r in hierarchies.closure(edges, "c", "p").collect()} == {("a", "a"), ("b", "b"), ("c", "c"), ("x", "x"), ("a", "b"), ("b", "c"), ("a", "c")}
    sizes = spark.createDataFrame([(1, 2, 1), (2, 0, 0), (3, 1, 0)], "c int, expected int, actual int")
    f1 = {r.c: r.f1 for r in matching.pair_f1(spark.createDataFrame([(1,)], "c int"), sizes, "c").collect()}
    assert f1 == {1: pytest.approx(2 / 3), 2: 1.0, 3: 0.0}
    similar = matching.similar_texts(spark.createDataFrame([(1, "the quick brown fox jumps"), (2, "the quick brown fox jumped"), (3, "nothing like it")], "id int, t string"), "id", "t").collect()
    assert [(r.a, r.b) for r in similar] == [(1, 2)]
    data = {"providers": [{"name": "n", "group": "g", "skills": ["s"], "windows": [{"start": "2026-01-05 09:00", "end": "2026-01-05 12:00"}]}]}
    assert str(readers.calendar(data, spark, "2026-02-01").first()["windows"][0]["start"]) == "2026-02-01 09:00:00"


def test_windows_through_midnight_serve_both_days(spark):
    import datetime as d

    at = lambda day, hour: d.datetime(2026, 1, day, hour)
    providers = spark.createDataFrame([("n", "Night", "g", ["s"], [(at(5, 22), at(6, 6))]), ("l", "Long", "g", [], [(at(5, 0), at(8, 0)), (at(5, 0), at(6, 12))])], "provider string, name string, grp string, skills array<string>, windows array<struct<start timestamp_ntz, end timestamp_ntz>>")
    asked = [(1, None, None, ["s"], at(6, 1), at(6, 3)), (2, None, None, [], at(5, 23), at(6, 7)), (3, "Night", None, [], at(6, 5), at(6, 7)), (4, None, None, [], at(9, 10), at(9, 11)), (5, "Night", "g", [], at(5, 22), at(6, 6)), (6, "Nobody", None, [], at(6, 10), at(6, 11)), (7, None, None, [], at(6, 10), at(6, 11))]
    requests = spark.createDataFrame(asked, "request_id int, wanted_name string, wanted_group string, wanted_skills array<string>, start timestamp_ntz, end timestamp_ntz")
    trace = {(r.request_id, r.provider): (r.matched, r.reasons) for r in matching.match_providers(requests, providers).collect()}
    assert trace[1, "n"] == (True, []) and trace[1, "l"] == (False, ["skills:s"]) and trace[3, "n"] == (False, ["time"]) and trace[5, "l"] == (False, ["name"])
    assert (4, "n") not in trace and trace[2, "l"] == (True, [])
    matched = {k for k, v in trace.items() if v[0]}
    assert {tuple(r) for r in matching.providers_in_time(requests, providers).collect()} == matched
    status = {r.request_id: r.status for r in matching.match_status(requests, providers).collect()}
    assert status[4] == "coverage_miss" and status[6] == "not_found" and status[7] == "matched"


def test_pairs_of_a_day_are_judged_plainly_and_in_many_tasks(spark):
    """A match is told without making reasons, and is where there are none; days keep their partitions."""
    import datetime as d

    rng = random.Random(5)
    at = lambda: d.datetime(2026, 1, 5) + d.timedelta(minutes=30 * rng.randrange(96))
    window = lambda: (lambda a: (a, a + d.timedelta(hours=rng.randrange(0, 9))))(at())
    some = lambda: rng.choice([None, [], ["a"], ["a", "b"], [None]])
    providers = spark.createDataFrame([(k, rng.choice(["x", "y", None]), rng.choice(["g", "h", None]), some(), [window() for _ in range(rng.randrange(1, 4))]) for k in range(40)], "provider int, name string, grp string, skills array<string>, windows array<struct<start timestamp_ntz, end timestamp_ntz>>")
    requests = spark.createDataFrame([(k, rng.choice(["x", None, "z"]), rng.choice(["g", None]), some(), *window()) for k in range(60)], "request_id int, wanted_name string, wanted_group string, wanted_skills array<string>, start timestamp_ntz, end timestamp_ntz")
    trace = matching.match_providers(requests, providers)
    rows = trace.collect()
    assert len({r.matched for r in rows}) == 3 and all(r.matched == (None if r.considered is None else r.considered and not r.reasons) for r in rows)
    assert "array_compact" not in trace.select("provider", "matched")._jdf.queryExecution().optimizedPlan().toString()


def test_providers_alike_on_a_day_are_judged_once(spark):
    """A request meets a row for each class of providers, whatever their number, and is told of each of them."""
    import datetime as d

    at = lambda hour: d.datetime(2026, 1, 5, hour)
    providers = spark.createDataFrame([(k, f"n{k % 50}", "gh"[k % 2], ["a"], [(at(9), at(12))]) for k in range(200)], "provider int, name string, grp string, skills array<string>, windows array<struct<start timestamp_ntz, end timestamp_ntz>>")
    requests = spark.createDataFrame([(1, None, "g", ["a"], at(9), at(10)), (2, "n7", None, [], at(9), at(10))], "request_id int, wanted_name string, wanted_group string, wanted_skills array<string>, start timestamp_ntz, end timestamp_ntz")
    trace = matching.match_providers(requests, providers)
    got = {(r.request_id, r.provider): (r.considered, r.matched, r.reasons) for r in trace.collect()}
    want = {(1, k): (True, k % 2 == 0, ["group"] * (k % 2)) for k in range(200)}
    assert got == want | {(2, k): (k % 50 == 7, k % 50 == 7, [] if k % 50 == 7 else ["name"]) for k in range(200)}
    plan = trace._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("Generate inline") < plan.find("Join Inner")


def test_matches_are_counted_without_pairs(spark):
    """Against the pairs themselves: overlapping, nested, repeated and empty windows, groups, skills and names that are null."""
    import datetime as d

    rng = random.Random(21)
    at = lambda: d.datetime(2026, 1, 5) + d.timedelta(minutes=30 * rng.randrange(96))
    providers = [(f"p{k}", rng.choice(["a", "b", None, f"n{k}"]), rng.choice(["g", "h", None]), rng.choice([["s"], ["s", "t", "s"], [], None]), [(at(), at()) for _ in range(rng.randrange(7))] * rng.choice([1, 2])) for k in range(40)]
    providers = spark.createDataFrame(providers, "provider string, name string, grp string, skills array<string>, windows array<struct<start timestamp_ntz, end timestamp_ntz>>")
    asked = [(k, rng.choice([None, None, "a", "b", "zz"]), rng.choice([None, "g", "h"]), rng.choice([[], ["s"], ["s", "t"], None]), start := at(), start + d.timedelta(minutes=rng.choice([-30, 0, 30, 60, 300]))) for k in range(150)]
    asked += [(200 + k, *asked[k][1:]) for k in range(20)]
    requests = spark.createDataFrame(asked, "request_id int, wanted_name string, wanted_group string, wanted_skills array<string>, start timestamp_ntz, end timestamp_ntz")
    pairs = matching.providers_in_time(requests, providers).groupBy("request_id").count().collect()
    want = dict.fromkeys((r[0] for r in asked), 0) | {r[0]: r[1] for r in pairs}
    assert max(want.values()) > 5 and {r.request_id: r.matches for r in matching.match_status(requests, providers).collect()} == want
    asks = requests.drop("request_id").distinct()
    counted = matching.count_matches(asks, providers)
    assert sum(r.matches for r in counted.collect()) == sum(want[k] for k in {repr(r[1:]): r[0] for r in asked}.values())
    # windows in hours are never broadcast
    assert "strategy=merge" in counted._jdf.queryExecution().optimizedPlan().toString()


def test_reasons_are_traced_once_for_like_requests(spark):
    """The counts of the trace itself, for requests of which many ask for the same, and a trace of as many rows however many they are."""
    import datetime as d

    rng = random.Random(22)
    at = lambda: d.datetime(2026, 1, 5) + d.timedelta(hours=rng.randrange(48))
    providers = [(f"p{k}", rng.choice(["a", "b", f"n{k}"]), rng.choice(["g", "h"]), rng.choice([["s"], ["s", "t"], []]), [(start := at(), start + d.timedelta(hours=8))]) for k in range(30)]
    providers = spark.createDataFrame(providers, "provider string, name string, grp string, skills array<string>, windows array<struct<start timestamp_ntz, end timestamp_ntz>>")
    asks = [(rng.choice([None, None, "a", "zz"]), rng.choice([None, "g"]), rng.choice([[], ["s"], ["s", "t"]]), start := at(), start + d.timedelta(microseconds=1 + k % 2)) for k in range(25)]
    requests = spark.createDataFrame([(k, *asks[k % 25]) for k in range(100)], "request_id int, wanted_name string, wanted_group string, wanted_skills array<string>, start timestamp_ntz, end timestamp_ntz")
    want = {}
    for r in matching.provider_trace(requests, providers).collect():
        key = r.request_id, ",".join(x.split(":")[0] for x in r.reasons)
        want[key] = want.get(key, 0) + r.providers
    found = matching.trace_reasons(requests, providers)
    assert {(r.request_id, r.reasons): r.providers for r in found.collect()} == want
    assert found.groupBy("request_id").sum("providers").where("`sum(providers)` <> 30").isEmpty() and len(want) > 100


def test_sketches_leave_few_pairs_and_lose_none():
    rng = random.Random(31)
    stems = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "or", "ti", "hi", "as", "to"]
    word = lambda: "".join(rng.choice(stems) for _ in range(rng.randrange(1, 5)))
    texts = []
    for n in (30, 60, 150, 400):
        for _ in range(12):
            base = [word() for _ in range(n)]
            texts += [" ".join(word() if rng.random() < p else w for w in base) + ("." if p else "") for p in (0, 0.02, 0.1)]
    texts.sort(key=len)
    shapes, lengths = [matching.Shape(t) for t in texts], np.array([len(t) for t in texts])
    left = 0
    for size in (matching.LONG_GRAM, matching.SHORT_GRAM):
        bits = matching._Bits([matching.sketch(s, size) for s in shapes], lengths, 1.5)
        grams = lengths - size + 1
        for i in range(len(texts)):
            js = np.arange(i + 1, np.searchsorted(lengths, lengths[i] * 1.5, "right"))
            for j, most in zip(js, bits.at_most(grams, i, js), strict=True):
                (x, n), (y, m) = shapes[i].counted(size), shapes[j].counted(size)
                _, p, q = np.intersect1d(x, y, return_indices=True)
                shared = np.minimum(n[p], m[q]).sum()
                assert shared <= most
                left += size == matching.LONG_GRAM and most > shared + 0.2 * lengths[i]
    assert left == 0


def test_common_characters_in_order():
    rng = random.Random(8)
    for _ in range(200):
        x, y = ("".join(rng.choices("abcé ", k=rng.randrange(20))) for _ in range(2))
        row = [0] * (len(y) + 1)
        for c in x:
            new = [0]
            for k, d in enumerate(y):
                new.append(row[k] + 1 if c == d else max(row[k + 1], new[k]))
            row = new
        got = matching.in_order(x, len(y), matching.places_of(y))
        assert got == row[-1] and 2 * got >= SequenceMatcher(None, x, y).ratio() * (len(x) + len(y)) - 1e-9


def test_similar_texts_miss_no_pair(spark):
    rng = random.Random(4)
    words = ["lorem", "dolor", "sit", "amet", "tempor", "magna", "quis", "velit", "x1", "zj,"]
    texts = ["abcde", "abXde", "ab", "abc", "", "", "ABC", None]
    for n in (3, 12, 40, 120):
        for _ in range(5):
            base = [rng.choice(words) for _ in range(n)]
            texts += [" ".join(rng.choice(words) if rng.random() < p else w for w in base) for p in (0, 0.03, 0.12, 0.25)]
    rng.shuffle(texts)
    got = {(r.a, r.b): r.ratio for r in matching.similar_texts(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), "id", "t", block=12).collect()}
    lowered = [(k, t.lower()) for k, t in enumerate(texts) if t is not None]
    first = {}
    for k, t in lowered:
        first.setdefault(t, k)
    want = {(first[t], k): 1.0 for k, t in lowered if first[t] != k}
    for x, a in first.items():
        for y, b in first.items():
            if a < b and (ratio := SequenceMatcher(None, x, y).ratio()) >= 0.8:
                want[a, b] = ratio
    assert got == want and {tuple(sorted((first[x], first[y]))) for x, y in (("abcde", "abxde"), ("ab", "abc"))} <= got.keys()


def test_similar_texts_write_each_text_a_few_times(spark):
    """However many blocks a text meets, it is shuffled as often: what is written doesn't grow with the pairs."""
    rng = random.Random(6)
    texts = spark.createDataFrame([(k, "".join(rng.choice("abcdefghij ") for _ in range(90 + k % 40))) for k in range(160)], "id int, t string").localCheckpoint()
    gateway = spark.sparkContext._gateway

    def written() -> int:
        found = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return sum(found.apply(k).shuffleWriteRecords() for k in range(found.size()))

    before = written()
    assert matching.similar_texts(texts, "id", "t", block=8).count() == 0
    assert written() - before < 8 * 160


def test_similar_vectors_compares_every_pair(spark):
    rng = random.Random(8)
    rows = [(k * 3, [rng.gauss(0, 1) for _ in range(4)], k % 2) for k in range(60)]
    rows += [(1000, rows[0][1], None), (1001, [0.0] * 4, 0), (1002, None, 0), (1003, [1.0, None, 0.0, 0.0], 0), (1004, [1.0, 2.0], 0), (None, rows[0][1], 0)]
    frame = spark.createDataFrame(rows, "id long, v array<float>, label int")
    got = {(r.a, r.b): (r.cosine, r.a_label, r.b_label) for r in matching.similar_vectors(frame, "id", "v", 0.6, ["label"], block=5).collect()}
    cosine = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True)) / (sum(p * p for p in x) * sum(q * q for q in y)) ** 0.5
    whole = [r for r in rows[:61]]
    want = {(a[0], b[0]): (cosine(a[1], b[1]), a[2], b[2]) for a in whole for b in whole if a[0] < b[0] and cosine(a[1], b[1]) >= 0.6}
    assert got.keys() == want.keys() and (0, 1000) in got and any(b - a > 3 for a, b in got)
    assert all(got[k] == (pytest.approx(want[k][0], abs=1e-6), *want[k][1:]) for k in want)
    assert matching.similar_vectors(frame.limit(0), "id", "v", 0.6).collect() == []


def test_corpus(spark):
    docs = spark.createDataFrame([(1, "xx alpha beta gamma delta yy"), (2, "alpha beta"), (3, "xalpha beta gammax"), (4, None)], "id int, t string")
    items = spark.createDataFrame([(10, "alpha beta gamma"), (11, "zzz")], "item int, it string")
    assert sorted((r.id, r.item) for r in corpus.containing(docs, items, "t", "it").collect()) == [(1, 10), (3, 10)]
    texts = ["the cat sat", "a", "ab", "xaby", "a b", "", "cat  sat on the cat sat", None, "sat\non", "éa b"]
    wanted = ["a", "ab", "a b", "cat", "t s", "sat on the", "cat sat", "at s", "é", "on", "sat\non", " ", "the cat sat"]
    docs, items = spark.createDataFrame(list(enumerate(texts)), "id int, t string"), spark.createDataFrame(list(enumerate(wanted)), "item int, it string")
    brute = {(i, k) for i, t in enumerate(texts) for k, w in enumerate(wanted) if t is not None and w.strip() and w in t}
    for most in (20_000, 1):
        got = [(r.id, r.item) for r in corpus.containing(docs, items, "t", "it", most_keys=most).collect()]
        assert sorted(got) == sorted(brute)
    turns = spark.createDataFrame([(1, 0, "user"), (1, 1, "assistant"), (2, 0, "assistant"), (2, 2, "call")], "c int, t int, role string")
    got = {r.c: (r.illegal, r.has_gap, r.ends_well) for r in corpus.history_status(turns, "c", "t", "role").collect()}
    assert got == {1: (0, False, True), 2: (2, True, False)}
    steps = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 3)], "c string, s int")
    assert [r.c for r in corpus.chain_gaps(steps, "c", "s").collect()] == ["b"]
    checked = spark.createDataFrame([(1, 5), (1, 50)], "id int, x int").withColumn("e", corpus.errors_of({"small": F.col("x") < 10}))
    assert sorted(tuple(r) for r in corpus.dataset_errors(checked, "id", "e").collect()) == [(1, "duplicate_id"), (1, "small")]


def test_provenance(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text("hello")
    hashes = provenance.file_hashes(spark, str(tmp_path / "d"))
    lines = spark.createDataFrame([("2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824  a.txt",), ("0" * 64 + "  b.txt",)], "value string")
    assert {r.name: r.status for r in provenance.verify_manifest(provenance.checksum_lines(lines), hashes).collect()} == {"a.txt": "ok", "b.txt": "missing"}
    built = []
    build = lambda: (built.append(1), spark.range(3))[1]
    key = provenance.cache_key({"a": 1}, "stage", {"p": [1, 2]})
    assert [provenance.cached_stage(spark, str(tmp_path / "c"), key, build).count() for _ in range(2)] == [3, 3] and len(built) == 1
    assert provenance.run_matrix({"x": lambda: 1 / 0, "y": lambda: 1})[1] == ("y", "completed", None)
    done = spark.createDataFrame([("q8", 128)], "quant string, n int")
    assert provenance.pending({"quant": ["q8", "q4"], "n": [128, 512]}, done, spark).count() == 3
    with pytest.raises(FileExistsError):
        provenance.check_version("v1.0", lambda t: True, ["x"])
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    files = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "id string, name string")
    assert [r.id for r in provenance.incomplete(ids, files, ["x", "y"]).collect()] == ["b"]


def test_stream_equals_batch(spark, tmp_path):
    turns = [
        ("s1", 1, json.dumps(patch(hard_filters=[condition("flavor", "in", values=["matcha"])]))),
        ("s1", 2, "not json"),
        ("s1", 3, json.dumps(patch(hard_filters=[condition("price", "lte", value=5, unit="USD")]))),
        ("s1", 4, json.dumps(patch(hard_filters=[condition("price", "lte", value=5, unit="EUR")]))),
        ("s2", 1, json.dumps(patch(reset=True, query_text="tea"))),
    ]
    schema = "session string, seq long, text string"
    spark.createDataFrame(turns[:2], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame(turns[2:], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    batch = session_state.fold_batch(spark.createDataFrame(turns, schema), CATALOG, "USD").collect()
    out = session_state.fold_stream(windows.read_stream(spark, str(tmp_path / "in"), files=10), CATALOG, "USD")
    streamed = windows.run_to_table(out, "append").collect()
    assert sorted(map(str, batch)) == sorted(map(str, streamed))
    by = {(r.session, r.seq): r for r in batch}
    assert [by["s1", k].committed for k in (1, 2, 3, 4)] == [True, False, True, False]
    assert by["s1", 4].state == by["s1", 3].state and by["s1", 3]["filter"] == "flavor:=[matcha] && price:<=5"


def answer(**parts):
    base = dict.fromkeys(("gender_preference", "technician_gender", "start_time", "duration_minutes", "technician_name")) | {
        "action": "final", "preferences": [], "technician_status": "not_checked", "confirmation": False, "info_complete": False, "unrelated": False,
        "missing_info": ["start_time", "duration_minutes"], "reply_type": "ask_start_time_and_duration", "reply": "when?",
    }
    return base | parts


def test_output_contracts(spark):
    from lodeframe.operators import appointments as A

    call = {"action": "tool_call", "tool_name": "find", "arguments": {"technician_name": None, "start_time": "2026-01-01 10:00", "duration_minutes": 60, "gender_preference": "female", "preferences": ["x"]}}
    cases = {
        "": [answer(), call, answer(reply_type="handoff", reply=None), answer(preferences=["a", "b"], start_time="2026-01-01 10:00", missing_info=["duration_minutes"])],
        "keys": [answer(more=1)],
        "missing_info": [answer(missing_info=["duration_minutes", "start_time"])],
        "duration_minutes": [answer(duration_minutes=True), answer(duration_minutes=0), call | {"arguments": call["arguments"] | {"duration_minutes": None}}],
        "reply": [answer(reply=None), answer(reply="```x"), answer(reply_type="handoff")],
        "preferences": [answer(preferences=["a", "a"]), answer(preferences=[" "]), answer(preferences=[1])],
        "flags": [answer(unrelated=0)],
        "start_time": [answer(start_time="soon")],
        "arguments": [call | {"arguments": {}}],
    }
    rows = [(name, json.dumps(x)) for name, group in cases.items() for x in group] + [("json", "nope")]
    df = spark.createDataFrame(rows, "want string, t string").withColumn("v", strict_object(F.col("t")))
    for r in df.select("want", "t", A.output_errors(F.col("v")).alias("e")).collect():
        assert (r.want in r.e) if r.want else r.e == [], (r.want, r.t, r.e)
    raw = spark.createDataFrame([(json.dumps(answer()), ["N"]), (json.dumps(answer(missing_info=[], technician_name="M", technician_status="available")), ["N"])], "t string, q array<string>").withColumn("v", strict_object(F.col("t")))
    found = [r[0] for r in raw.select(A.consistency_errors(F.col("v"), F.col("q"))).collect()]
    assert found[0] == [] and set(found[1]) == {"missing_info", "name_source"}


def test_replies(spark):
    from lodeframe.operators import appointments as A

    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(A.names_in(F.lit("已找到王芳技师，老师李明。一位技师"))) == ["王芳", "李明"]
    gold = F.parse_json(F.lit(json.dumps(answer(technician_name="王芳", duration_minutes=90, start_time="2026-03-01 14:30", preferences=["安静"]))))
    need = F.array(*map(F.lit, ("technician_name", "duration_minutes", "start_time", "preferences")))
    good = A.reply_errors(F.lit("为您安排王芳技师，下午2点30分，一个半小时，安静"), gold, need)
    assert get(good[1]) == [] and get(good[0]) == 6
    now = F.lit("2026-02-28 10:00").cast("timestamp_ntz")
    near = lambda when: get(A.reply_errors(F.lit(f"王芳技师，{when}，90分钟，安静"), gold, need, now)[1])
    assert near("明天下午2点30分") == [] and near("明天14点30分") == [] and near("3月1号14点30分") == [] and near("后天") == ["start_time"]
    bad = A.reply_errors(F.lit("安排李明技师，3点"), gold, need)
    assert set(get(bad[1])) == {"technician_name", "duration_minutes", "start_time", "unsupported_technician_name", "preference:安静"}
    assert get(A.faithfulness(bad[0], bad[1])) == pytest.approx(1 / 6)


def test_generation(spark):
    from lodeframe.operators import generation as G

    cells = G.grid(spark, {"a": ["x", "y"], "b": [1, 2, 3]})
    assert cells.count() == 6
    turns = G.rotate(spark.range(9).withColumn("g", F.lit("g")), "g", "id", ["p", "q", "r"], "s")
    assert {r.choice: r["count"] for r in turns.groupBy("choice").count().collect()} == {"p": 3, "q": 3, "r": 3}
    assert [r.grp for r in G.plan_errors(cells, {"x": 3, "z": 1}, "a").collect()] == ["z"]
    prefix = G.prompt_prefix(CATALOG, ["rule"])
    rows = G.render_prompts(spark.createDataFrame([(None, "hi")], "s string, t string"), prefix, "s", "t")
    m = rows.first().messages
    assert m[0].content.endswith("State: null") and m[1].content == "hi" and "size_g" not in prefix
    assert rows.select(G.render_template(F.col("messages"))).first()[0].endswith("<|im_start|>user\nhi<|im_end|>\n")
    talk = spark.sql("select array(named_struct('role','system','content','s'), named_struct('role','user','content','q'), named_struct('role','assistant','content','a')) m")
    r = G.sharegpt(talk, "m").first()
    assert r.system == "s" and [c["from"] for c in r.conversations] == ["human", "gpt"]
    with pytest.raises(Exception, match="alternate"):
        G.sharegpt(spark.sql("select array(named_struct('role','user','content','q')) m"), "m").collect()
    assert G.config_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    with pytest.raises(ValueError):
        G.config_merge({}, {"z": 1}, frozenset("a"))
    with pytest.raises(KeyError):
        G.tool_schema("x", {})
    assert spark.createDataFrame([("a b",), (None,)], "t string").select(F.sum(G.pluggable_count(lambda t: len(t.split()))(F.col("t")))).first()[0] == 2
