"""Plans of changes, scans of appointment records, the tool loop, sinks and streams."""

import json
from collections import Counter

import pytest
from lodeframe.facets import CatalogError, load_catalog
from lodeframe.operators import provenance, records, reports
from lodeframe.plans import evaluation, intents, queries_engine
from lodeframe.plans.queries_engine import POOLS, SCENARIOS
from lodeframe.plans.queries_engine import CATALOG as SHOP
from lodeframe.sources import readers, sinks, tool_loop
from lodeframe.streaming import windows
from pyspark.sql import functions as F

from .conftest import SMALL
from .shelf import CATALOG, TEXT


@pytest.mark.parametrize("scenario", SCENARIOS)
def test_plans_are_legal_and_balanced(scenario):
    pools = intents.Pools(["gift", "party", "tea"], ["fancy", "quick"], {"level": [1, 2, 3, 4], "price": [5, 10, 20], "size": [1, 2, 3]})
    rows = [intents.plan_row(f"p-{k}", scenario, k, CATALOG, pools, "s") for k in range(48)]
    assert rows == [intents.plan_row(f"p-{k}", scenario, k, CATALOG, pools, "s") for k in range(48)]
    for r in rows:
        change = json.loads(r["expected"])
        record = {"id": r["request_id"], "scenario": scenario, "tags": r["tags"], "input": {"current_search_state": r["state"] and json.loads(r["state"]), "user_input": r["draft"]}, "expected": change, "assertions": json.loads(r["assertions"])}
        assert evaluation.sample_errors(record, CATALOG) == []
    # the first choice of a scenario goes round evenly
    first = Counter(r["draft"].split(" ")[0] for r in rows)
    if scenario in ("query_text", "unmapped", "single_filter", "reset"):
        assert max(first.values()) - min(first.values()) <= 1
    with pytest.raises(ValueError):
        intents.plan_row("x", "no such scenario", 0, CATALOG, POOLS, "s")


def sample(**parts):
    call = {"id": "c", "type": "function", "function": {"name": "find", "arguments": "{}"}}
    history = [{"role": "user", "content": "hi"}, {"role": "assistant", "content": None, "tool_calls": [call]}, {"role": "tool", "tool_call_id": "c", "content": "{}"}, {"role": "assistant", "content": "ok"}]
    wants = {k: [] for k in ("required_acts", "forbidden_acts", "required_fields", "references")}
    base = {"id": "s", "output_kind": "final", "conversation_kind": "multi_turn", "input": {"history": history, "user_input": "yes", "current_state": None}, "expected": {"action": "final"}, "reply_expectations": wants, "assertions": [], "tags": ["x"]}
    return base | parts


def with_history(*turns, **more):
    return sample(input={"history": list(turns), "current_state": None} | more)


def test_sample_scan(spark):
    user, said = {"role": "user", "content": "hi"}, {"role": "assistant", "content": "ok"}
    call = lambda **parts: {"role": "assistant", "content": None, "tool_calls": [{"id": "c", "type": "function", "function": {"name": "f", "arguments": "{}"}} | parts]}
    told = {"role": "tool", "tool_call_id": "c", "content": "{}"}
    cases = [
        ("", sample()),
        ("", with_history(user_input="x")),
        ("", with_history(user, call(), told)),
        ("", sample(output_kind="tool_call", reply_expectations=None)),
        ("id", sample(id="")),
        ("output_kind", sample(output_kind="other")),
        ("conversation_kind", sample(conversation_kind=None)),
        ("expected", sample(expected=[])),
        ("tags", sample(tags=["x", 1])),
        ("assertions", sample(assertions=None)),
        ("reply_expectations", sample(reply_expectations={"required_acts": []})),
        ("reply_expectations", sample(output_kind="tool_call")),
        ("current_state", with_history(user, said, user_input="x", current_state=3)),
        ("start", with_history(said, user_input="x")),
        ("steps", with_history(user, user, said, user_input="x")),
        ("end", with_history(user, user_input="x")),
        ("end", with_history(user, said)),
        ("user_input", with_history(user, call(), told, user_input=" ")),
        ("turns", with_history(user, {"role": "assistant", "content": "{\"a\": 1}"}, user_input="x")),
        ("turns", with_history({"role": "user", "content": "hi", "more": 1}, said, user_input="x")),
        ("turns", with_history(user, call(type="other"), told)),
        ("results,calls", with_history(user, call(id="d"), told)),
        ("calls", with_history(user, call(), said, user_input="x")),
        ("results", with_history(user, call(), told, said, user, said, told)),
    ]
    frame = spark.createDataFrame([(k, json.dumps(s)) for k, (_, s) in enumerate(cases)], "k int, t string").withColumn("value", F.parse_json("t"))
    got = {r.k: set(r.errors) for r in records.scan(frame).collect()}
    for k, (want, _) in enumerate(cases):
        names = set(want.split(",")) - {""}
        # a broken history may break the rule of its steps too
        assert names <= got[k] and got[k] - names <= ({"steps"} if names else set()), (k, want, got[k])


def test_raw_scan_wants_exact_keys(spark):
    raw = sample(tags=["确认"], dpo_targets=["P5"])
    raw = {k: v for k, v in raw.items() if k not in ("reply_expectations", "assertions")}
    cases = [raw, raw | {"more": 1}, raw | {"dpo_targets": ["P5", "P5"]}, raw | {"tags": ["x"]}, raw | {"output_kind": "tool_call"}]
    frame = spark.createDataFrame([(k, json.dumps(c)) for k, c in enumerate(cases)], "k int, t string").withColumn("value", F.parse_json("t"))
    got = {r.k: set(r.errors) for r in records.scan(frame, raw=True).collect()}
    assert got[0] == set() and got[1] == {"keys"} and got[2] == {"dpo_targets"} and "tags" in got[3] and got[4] == {"action"}


def test_scan_reads_a_record_once_and_walks_long_histories(spark):
    """No rule renders a record as JSON or a schema to learn its keys, a text that can't be JSON isn't parsed, and the walk keeps each call beside its results."""
    user, said = {"role": "user", "content": "hi"}, {"role": "assistant", "content": "ok"}
    call = lambda k: {"role": "assistant", "content": None, "tool_calls": [{"id": f"c{k}", "type": "function", "function": {"name": "f", "arguments": "{}"}}]}
    told = lambda k: {"role": "tool", "tool_call_id": f"c{k}", "content": "{}"}
    rounds = [t for k in range(500) for t in (user, call(k), told(k), said)]
    cases = [
        (set(), rounds),
        ({"results"}, [*rounds[:1000], user, call(0), told(1), said, *rounds[1000:]]),
        ({"steps", "results"}, [*rounds, user, call(0), told(0), told(0), said]),
        ({"calls"}, [*rounds, user, call(9), said]),
        ({"turns", "results"}, [*rounds, user, call(9), {"role": "tool", "content": "{}"}, said]),
        ({"turns"}, [*rounds, user, {"role": "assistant", "content": " [1]"}]),
        (set(), [*rounds, user, {"role": "assistant", "content": "[no JSON"}]),
    ]
    texts = [(k, json.dumps(with_history(*turns, user_input="x"))) for k, (_, turns) in enumerate(cases)]
    frame = spark.createDataFrame(texts, "k int, t string").withColumn("value", F.parse_json("t"))
    found = records.scan(frame)
    got = {r.k: set(r.errors) for r in found.collect()}
    for k, (want, _) in enumerate(cases):
        # two calls' steps: an assistant may not follow an assistant
        assert got[k] - {"steps"} == want - {"steps"}, (k, want, got[k])
    assert found.columns == ["k", "t", "value", "errors"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [f for f in ("to_json", "json_object_keys", "jsonObjectKeys", "regexp_extract", "structstojson") if f.lower() in plan.lower()]


def test_raw_samples_are_dealt_over_all_tasks(spark):
    found = queries_engine.raw_sample_scan(spark, SMALL)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_tool_loop_ends():
    ask = lambda texts: (lambda log, it=iter(texts): next(it))
    call = '{"action":"tool_call","tool_name":"t","arguments":{"x":1}}'
    tools = {"t": lambda a: {"got": a["x"]}}
    status, calls, answer, log = tool_loop.run_loop([], ask([call, '{"action":"final"}']), tools, 2)
    assert (status, calls, answer) == ("completed", 1, '{"action":"final"}') and json.loads(log[-1]["content"]) == {"got": 1}
    assert tool_loop.run_loop([], ask([call] * 3), tools, 2)[:2] == ("too_many_calls", 2)
    assert tool_loop.run_loop([], ask(["not json"]), tools, 2)[0] == "invalid"
    assert tool_loop.run_loop([], ask([call]), {}, 2)[0] == "failed"


def test_lines_are_numbered_over_splits(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [f'{{"n":{k}}}' if k % 50 else "" for k in range(3000)]
    (folder / "a.jsonl").write_text("\r\n".join(lines))
    (folder / "b.jsonl").write_text("\n".join(lines[:7]) + "\n")
    (folder / "c.txt").write_text("no")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        read = readers.text_lines(spark, str(folder))
        assert read.rdd.getNumPartitions() > 1
        got = {(r.file.rsplit("/", 1)[-1], r.line_no): r.line for r in read.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {("a.jsonl", k + 1): x for k, x in enumerate(lines) if x} | {("b.jsonl", k + 1): x for k, x in enumerate(lines[:7]) if x}
    assert got == want


def test_diagnostics_rotate(spark, tmp_path):
    path = str(tmp_path / "log")
    row = spark.createDataFrame([("x" * 100,)], "text string")
    assert all(sinks.rotating_append(row, path, most_bytes=250, backups=2) for _ in range(12))
    assert sorted(p.name for p in (tmp_path / "log").iterdir()) == ["backup-1", "backup-2", "current"]
    assert spark.read.text(f"{path}/backup-1").count() == 3
    assert not sinks.rotating_append(row, "nosuchscheme://x/y")


def test_fields_are_ordered_at_every_depth(spark):
    frame = spark.createDataFrame([((1, [(2, 3)]), 4)], "z struct<b:int,a:array<struct<d:int,c:int>>>, a int")
    assert sinks.in_order(frame, ("a", "c")).schema.simpleString() == "struct<a:int,z:struct<a:array<struct<c:int,d:int>>,b:int>>"


def test_large_files_are_streamed_and_stages_sealed(spark, tmp_path):
    import hashlib

    (tmp_path / "f").write_bytes(b"abc" * 1000)
    for most in (10, 10**6):
        assert [r.sha256 for r in provenance.file_hashes(spark, str(tmp_path / "f"), most).collect()] == [hashlib.sha256(b"abc" * 1000).hexdigest()]
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    root = str(tmp_path / "stages")
    for _ in range(2):
        assert provenance.cached_stage(spark, root, "k", build).count() == 3
    assert len(built) == 1
    for f in (tmp_path / "stages" / "k").glob("part-*"):
        f.write_bytes(b"broken")
    for f in (tmp_path / "stages" / "k").glob(".part-*"):
        f.unlink()
    assert provenance.cached_stage(spark, root, "k", build).count() == 3 and len(built) == 2


def test_model_registry_invariants(spark):
    base = {"family": "f", "variant": "v", "base_model": "b", "base_revision": "1", "artifact_path": "a", "manifest_path": "m", "size_b": 1, "stage": "sft", "artifact_kind": "q4_k_m"}
    models = [base | {"model_id": f"m{k}"} for k in range(8)] + [base | {"model_id": f"a{k}", "is_anchor": True} for k in range(2)]
    assert provenance.model_registry(spark, {"models": models}).count() == 10
    for bad in (models[:9], [*models[:9], models[0]], [*models[:9], models[9] | {"stage": "base"}]):
        with pytest.raises(ValueError):
            provenance.model_registry(spark, {"models": bad})
    assert provenance.model_registry(spark, {"models": models[:2], "registry_profile": "other"}).count() == 2
    with pytest.raises(ValueError, match="missing"):
        provenance.model_registry(spark, {"models": [{"model_id": "x"}]})


@pytest.mark.parametrize(
    ("old", "new"),
    [
        ("minimum: 1\n", "minimum: 1.5\n"), ("minimum: 1\n", "minimum: true\n"), ("minimum: 1\n", "minimum: x\n"), ("maximum: 5\n", "maximum: 0\n"),
        ("exclusive_minimum: true", "exclusive_minimum: yes please"), ("    hard_operators: [eq]\n", "    hard_operators: []\n"), ("unit_kind: mass", "unit_kind: length"),
        ("    base_unit: g\n", "    base_unit: g\n    unit_pattern: x\n"), ("    type: boolean\n", "    type: boolean\n    minimum: 0\n"),
    ],
)
def test_field_rules(old, new):
    assert old in TEXT
    with pytest.raises(CatalogError):
        load_catalog(TEXT.replace(old, new, 1))


def test_percentiles_of_any_numbers(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    for numbers in (rng.normal(0, 100, 501), rng.integers(-3, 4, 1000).astype(float), np.array([2.0]), np.array([-5.0, 5.0])):
        frame = spark.createDataFrame([(float(x),) for x in numbers] + [(float("nan"),), (None,)], "x double")
        got = {r.fraction: r.percentile for r in reports.exact_percentiles(frame, [], "x", [0.0, 0.5, 0.9, 1.0]).collect()}
        assert got == pytest.approx({f: float(np.quantile(numbers, f)) for f in (0.0, 0.5, 0.9, 1.0)})


def test_late_events_are_dropped_by_the_stream_only(spark, tmp_path):
    """The watermark follows the batches: what comes an hour late is left out of the stream's windows."""
    rows = [["2026-01-01 10:00:00", "2026-01-01 10:30:00"], ["2026-01-01 14:00:00"], ["2026-01-01 10:05:00", "2026-01-01 14:10:00"], ["2026-01-01 18:00:00"]]
    folder, state = tmp_path / "in", str(tmp_path / "state")
    schema = "ts timestamp, k string, v int"
    out = None
    for batch in rows:
        spark.createDataFrame([(t, "a", 1) for t in batch], "t string, k string, v int").select(F.to_timestamp("t").alias("ts"), "k", "v").coalesce(1).write.mode("append").parquet(str(folder))
        stream = windows.tumbling(spark.readStream.schema(schema).parquet(str(folder)), "ts", "1 hour", ["k"], "v", late="1 hour")
        out = windows.run_to_table(stream, "append", state)
    got = {str(r.window.start)[11:13]: r.n for r in out.collect()}
    assert got == {"10": 2, "14": 2}
    assert {str(r.window.start)[11:13]: r.n for r in windows.tumbling(spark.read.parquet(str(folder)), "ts", "1 hour", ["k"], "v").collect()} == {"10": 3, "14": 2, "18": 1}


def test_shop_catalog_has_no_unknown_parts():
    assert SHOP["flavor"].codes == ("sweet", "honey", "sour")
