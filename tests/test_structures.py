"""Hierarchies, one-to-one matching, overlapping views and resumed generation against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from lodeframe.operators import hierarchies as H
from lodeframe.operators import covering, matching, pairing, provenance, resume, views
from lodeframe.sources.shared import scratch

EDGES = "c string, p string"


def plain_closure(edges):
    up = {}
    for c, p in edges:
        for n in (c, p):
            if n is not None:
                up.setdefault(n, set())
        if c is not None and p is not None:
            up[c].add(p)
    out = set()
    for node in up:
        seen, todo = {node}, [node]
        while todo:
            for p in up[todo.pop()] - seen:
                seen.add(p)
                todo.append(p)
        out |= {(a, node) for a in seen}
    return out


def random_edges(rng, forest):
    rows = [(f"n{k}", f"n{rng.randrange(max(0, k - 6), k)}") for k in range(1, 60) for _ in range(1 if forest else rng.randrange(1, 3))]
    return rows + [("lone", None), (None, None), ("n0", None)] + [("n61", "n62"), ("n63", "n62")]


@pytest.mark.parametrize("small", [H.SMALL_EDGES, 0])
def test_closure_of_any_shape(spark, small):
    rng = random.Random(1)
    for forest in (True, False):
        rows = random_edges(rng, forest)
        out = H.closure(spark.createDataFrame(rows + rows[:5], EDGES), "c", "p", small).collect()
        assert len(out) == len(set(map(tuple, out))) and {tuple(r) for r in out} == plain_closure(rows)
    chain = [(f"{k + 1}", f"{k}") for k in range(80)]
    assert H.closure(spark.createDataFrame(chain, EDGES), "c", "p", small).count() == 81 * 82 // 2
    for cycle in ([("a", "a")], [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a")]):
        with pytest.raises(H.CycleError):
            H.closure(spark.createDataFrame(cycle, EDGES), "c", "p", small).count()
    assert H.closure(spark.createDataFrame([], EDGES), "c", "p", small).count() == 0


def test_below_is_a_range(spark):
    rng = random.Random(2)
    rows = random_edges(rng, True)
    for buckets in (256, 2):
        out = H.intervals(spark.createDataFrame(rows + rows[:3], EDGES), "c", "p", buckets).collect()
        nodes = {r.node: r for r in out}
        below = {(a, d) for a in nodes for d in nodes if nodes[a].low <= nodes[d].low <= nodes[a].high}
        closed = plain_closure(rows)
        assert len(out) == len(nodes) and below == closed
        assert sorted(r.low for r in out) == list(range(len(out)))
        assert all(nodes[d].depth + 1 == sum(x == d for _, x in closed) for d in nodes)
    for wrong in ([("a", "b"), ("b", "a"), ("x", None)], [("a", "a")]):
        with pytest.raises(H.CycleError):
            H.intervals(spark.createDataFrame(wrong, EDGES), "c", "p")
    with pytest.raises(Exception, match="several parents"):
        H.intervals(spark.createDataFrame([("a", "b"), ("a", "c")], EDGES), "c", "p").collect()
    assert H.intervals(spark.createDataFrame([], EDGES), "c", "p").collect() == []


def test_jumps_to_a_root_meet_in_no_single_partition(spark):
    rows = [(0, None, 1), *((k, 0, 2) for k in range(1, 2001)), *((k, k - 2000, 3) for k in range(2001, 2101)), *((k, None, 4) for k in range(3000, 5000))]
    walk = spark.createDataFrame(rows, "node int, jump int, depth int")
    roots = walk.where("jump is null").selectExpr("node as root", "cast(depth as long) as more")
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in off.items():
        spark.conf.set(name, value)
    try:
        out = H._ahead(walk, walk, "depth", roots).withColumn("part", F.spark_partition_id()).collect()
    finally:
        for name in off:
            spark.conf.unset(name)
    up, depth = {n: j for n, j, _ in rows}, {n: d for n, _, d in rows}
    assert {(r.node, r.jump, r.depth) for r in out} == {(n, up.get(j), d + depth.get(j, 0)) for n, j, d in rows}
    parts = [r.part for r in out]
    assert max(map(parts.count, set(parts))) < 0.35 * len(rows)


def test_a_deep_hierarchy(spark):
    chain = spark.range(1, 3000).selectExpr("id as c", "id - 1 as p")
    out = H.intervals(chain, "c", "p").agg(F.count("*"), F.max("depth"), F.sum(F.col("high") - F.col("low"))).first()
    assert tuple(out) == (3000, 2999, 3000 * 2999 // 2)


def plain_pairs(rows, least):
    left, right, taken = set(), set(), set()
    for s, i, j in sorted({(s, i, j) for i, j, s in rows if s is not None and s >= least}, reverse=True):
        if i not in left and j not in right:
            left.add(i)
            right.add(j)
            taken.add((i, j, s))
    return taken


@pytest.mark.parametrize("few", [pairing.FEW_PAIRS, 0])
def test_pairs_equal_a_walk(spark, few):
    rng = random.Random(4)
    cases = {c: [(rng.randrange(6), rng.randrange(6), rng.choice([0.1, 0.5, 0.5, 0.9, rng.random(), None])) for _ in range(rng.randrange(40))] for c in range(12)}
    cases[20] = [(k, k + d, 1 - k / 100) for k in range(20) for d in (0, 1)]  # a chain: each pair waits for the one before
    rows = [(c, *r) for c, found in cases.items() for r in found] + [(None, 1, 1, 0.9), (1, None, 2, 0.9), (2, 9, 9, float("nan"))]
    out = pairing.greedy_pairs(spark.createDataFrame(rows, "c int, i int, j int, score double"), "c", 0.2, few).collect()
    got = {c: {(r.i, r.j, r.score) for r in out if r.c == c} for c in cases}
    assert got == {c: plain_pairs(found, 0.2) for c, found in cases.items()} and len(out) == sum(map(len, got.values()))


def test_one_large_case(spark):
    n = 120
    scored = spark.range(n * n).select(F.lit(1).alias("c"), F.floor(F.col("id") / n).alias("i"), (F.col("id") % n).alias("j"), (F.abs(F.xxhash64("id")) % 1000 / 1000).alias("score"))
    rows = [(r.i, r.j, r.score) for r in scored.collect()]
    assert {(r.i, r.j, r.score) for r in pairing.greedy_pairs(scored, "c", 0.0).collect()} == plain_pairs(rows, 0.0)


def test_views_share_a_core(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *"abcdefgh"]), rng.randrange(4), k) for k in range(40)]
    df = spark.createDataFrame(rows, "key string, n int, views int")
    tests = {"small": lambda n: n < 2, "even": lambda n: n % 2 == 0, "none": lambda n: n > 9}
    held = {name: {k for k, n, _ in rows if test(n)} for name, test in tests.items()}
    members = views.membership(df, ["key"], {"small": F.col("n") < 2, "even": F.col("n") % 2 == 0, "none": F.col("n") > 9})
    names = list(tests)
    assert members.count() == len(set.union(*held.values()))
    for name in names:
        assert {r.key for r in views.of_view(members, names, name).collect()} == held[name]
    assert {r.key for r in views.core(members, names, ["small", "even"]).collect()} == held["small"] & held["even"]
    sizes = views.overlaps(members, names)
    assert {(r.a, r.b): r["keys"] for r in sizes.collect()} == {(a, b): len(held[a] & held[b]) for k, a in enumerate(names) for b in names[k:]}
    assert views.view_errors(sizes, 0, {"small": len(held["small"])}) == []
    assert len(views.view_errors(sizes, 1, {"even": -1})) == 3
    with pytest.raises(ValueError, match="unknown"):
        views.core(members, names, ["other"])
    with pytest.raises(ValueError, match="between"):
        views.membership(df, ["key"], {})
    assert views.membership(df.limit(0), ["key"], {"a": F.lit(True)}).count() == 0


def test_a_stopped_run_goes_on(spark):
    texts = [(str(k), f"text {k % 17}" if k % 5 else "", k % 3) for k in range(40)] + [("3", "again", 0), (None, "lost", 1)]
    requests = spark.createDataFrame(texts, "id string, asked string, part int")
    asked = []

    def answer(pending):
        asked.append({r.id for r in pending.collect()})
        return pending.select("id", F.upper("asked").alias("text"))

    def attempt(folder, stop=None, config=None):
        run = resume.Run(spark, folder, config or {"model": "m", "seed": 1}, "text string")
        return run, resume.generate(run, requests, answer, F.col("part"), 3, F.sha2("text", 256), F.col("text") != "", stop)

    whole, stopped = scratch(spark, "run"), scratch(spark, "run")
    expected = {tuple(r) for r in attempt(whole)[1].collect()}
    first = {tuple(r) for r in attempt(stopped, 1)[1].collect()}
    assert first < expected and {r[2] for r in first} == {0}
    run, done = attempt(stopped)
    assert {tuple(r) for r in done.collect()} == expected and done.count() == len(expected)
    assert len({r[1] for r in expected}) == len(expected) == len({r[0] for r in expected})
    before = len(asked)
    assert attempt(stopped)[1].count() == len(expected) and len(asked) == before
    assert {r.id for r in run.pending(requests).collect()} == {str(k) for k, _, _ in [(t[0], 0, 0) for t in texts if t[0]]} - {r[0] for r in expected}
    # a batch without its marker was not finished
    run.accepted().limit(1).drop("batch").write.parquet(f"{stopped}/accepted/batch=7")
    from lodeframe.sources.shared import file_system

    path, files = file_system(spark, f"{stopped}/accepted/batch=7/_SUCCESS")
    files.delete(path, False)
    assert run.accepted().count() == len(expected)
    with pytest.raises(resume.IdentityError):
        attempt(stopped, config={"model": "other", "seed": 1})


def test_ancestry_of_a_forest(spark):
    edges = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", None)], EDGES)
    assert {tuple(r) for r in provenance.ancestry(edges, "c", "p").collect()} == {("a", 0, "a"), ("b", 1, "a"), ("c", 2, "a"), ("x", 0, "x")}


def test_keys_of_rows_equal_the_key_of_a_stage(spark):
    df = spark.createDataFrame([("b", 1, "é"), ("c", 2, 'q"\\')], "base string, revision int, note string")
    key = provenance.cache_keys({"revision": F.col("revision"), "base": F.col("base"), "note": F.col("note")}, "build", {"group": F.array(F.lit(1), F.lit(2)), "bits": F.lit(4)})
    expected = [provenance.cache_key({"revision": r.revision, "base": r.base, "note": r.note}, "build", {"bits": 4, "group": [1, 2]}) for r in df.collect()]
    assert [r[0] for r in df.select(key).collect()] == expected


@pytest.mark.parametrize("sizes", [(3,), (2, 5), (4, 3, 3), (1, 6, 2, 5, 3, 2, 2)])
def test_every_pair_of_values_is_covered(spark, sizes):
    factors = {f"f{j}": spark.createDataFrame([(v,) for v in [None, *range(n), 0]], "v int") for j, n in enumerate(sizes)}
    rows = covering.covering_rows(spark, factors)
    found = rows.collect()
    for i in range(len(sizes)):
        assert {r[f"f{i}"] for r in found} == set(range(sizes[i]))
        for j in range(i):
            assert len({(r[f"f{i}"], r[f"f{j}"]) for r in found}) == sizes[i] * sizes[j]
    q = covering.prime_from(max(*sizes, len(sizes) - 1))
    assert len(found) == (q * q if len(sizes) > 1 else sizes[0]) == len({r.combination for r in found})
    pairs = covering.pairs_covered(rows, list(factors)).collect()
    assert sum(r.pairs for r in pairs) == sum(sizes[i] * sizes[j] for i in range(len(sizes)) for j in range(i))


def test_texts_of_rows(spark):
    rows = spark.createDataFrame([(0, "x", 1), (1, "y", 2)], "combination long, a string, b int")
    assert [r[0] for r in rows.select(covering.texts_of(rows, ["{a} {b} {c}", "b{b}a{a}"], ["a", "b"])).collect()] == ["x 1 {c}", "b2ay"]
    with pytest.raises(ValueError, match="values"):
        covering.covering_rows(spark, {"a": rows.select("a").limit(0)})
    with pytest.raises(ValueError, match="factors"):
        covering.covering_rows(spark, {})
    with pytest.raises(ValueError, match="templates"):
        covering.texts_of(rows, [], [])


def test_every_provider_has_a_part_in_every_request(spark):
    import datetime as d

    at = lambda day, hour: d.datetime(2026, 1, day, hour)
    calendars = [[(at(5, 9), at(5, 12))], [(at(5, 9), at(5, 12)), (at(6, 9), at(6, 18))], [], [(at(5, 22), at(6, 6))]]
    rng = random.Random(9)
    people = [(k, rng.choice(["Ann", "Bob", "Cy"]), rng.choice("gh"), rng.sample(["s", "t"], rng.randrange(3)), rng.choice(calendars)) for k in range(40)]
    providers = spark.createDataFrame(people, "provider int, name string, grp string, skills array<string>, windows array<struct<start timestamp_ntz, end timestamp_ntz>>")
    asked = [(k, rng.choice([None, None, "Ann", "Zed"]), rng.choice([None, "g"]), rng.sample(["s", "t"], rng.randrange(2)), at(day := rng.randrange(4, 8), hour := rng.randrange(8, 22)), at(day, hour + 1)) for k in range(60)]
    requests = spark.createDataFrame(asked, "request_id int, wanted_name string, wanted_group string, wanted_skills array<string>, start timestamp_ntz, end timestamp_ntz")
    trace = matching.provider_trace(requests, providers).collect()
    members = {}
    for r in matching.provider_classes(providers)[1].collect():
        members.setdefault(r.class_id, []).append(r.provider)
    assert sorted(p for own in members.values() for p in own) == list(range(40))
    people = {p[0]: p for p in people}
    for k, name, group, skills, start, end in asked:
        own = [r for r in trace if r.request_id == k]
        assert sum(r.providers for r in own) == 40
        matched = {p for r in own if r.matched for p in members[r.class_id] if name is None or people[p][1] == name}
        fits = {p for p, who, g, has, windows in people.values() if (name is None or who == name) and group in (None, g) and set(skills) <= set(has) and any(a <= start and end <= b for a, b in windows)}
        assert matched == fits
    assert matching.provider_trace(requests.limit(0), providers).count() == 0 and matching.provider_trace(requests, providers.limit(0)).count() == 0
