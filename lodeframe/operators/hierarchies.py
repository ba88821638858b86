"""Hierarchies of any depth: all ancestors by doubling, and intervals in which "below" is a range.

Both walk in steps that double, so a depth of 10,000 takes 14 rounds; each round is
written to the shared folder, which keeps lineage short, and the round before goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import discard, stored

#: Edges of a hierarchy, and pairs of its closure, up to which the driver closes it itself.
SMALL_EDGES, SMALL_PAIRS = 10_000, 200_000
#: Roots that all tasks may know, and parts over which the jumps to them are dealt.
ROOTS, PARTS = 10_000, 4096
#: Longest path that has no cycle for certain; a longer one is refused.
DEEPEST = 2**24


class CycleError(ValueError):
    """A node that is its own ancestor."""


def _closed_here(edges: list[tuple]) -> list[tuple] | None:
    """The closure of a few edges, or None where it has too many pairs."""
    above: dict[object, set] = {}
    for c, p in edges:
        if c is not None:
            above.setdefault(c, set()).update(() if p is None else (p,))
        if p is not None:
            above.setdefault(p, set())
    done: dict[object, set] = {}
    pairs = 0
    for start in above:
        # depth first, a node after all that are above it
        path: list[tuple[object, bool]] = [(start, False)]
        inside: set = set()
        while path:
            node, ready = path.pop()
            if node in done:
                continue
            if ready:
                inside.discard(node)
                done[node] = {node}.union(*(done[p] for p in above[node]))
                pairs += len(done[node])
                if pairs > SMALL_PAIRS:
                    return None
                continue
            if node in inside:
                raise CycleError(f"{node!r} is its own ancestor")
            inside.add(node)
            path.append((node, True))
            for p in above[node]:
                if p in inside:
                    raise CycleError(f"{p!r} is its own ancestor")
                path.append((p, False))
    return [(a, node) for node, found in done.items() for a in found]


def closure(edges: DataFrame, child: str, parent: str, small: int = SMALL_EDGES) -> DataFrame:
    """``(ancestor, descendant)`` of a hierarchy, each node its own; a node may have several parents, or none (null).

    Up to ``small`` edges (counted) and ``SMALL_PAIRS`` pairs are closed on the
    driver; else by doubling: pairs of up to 2^k steps, continued by those of exactly
    2^k steps, give pairs of up to 2^(k+1).  A cycle is an error at every size.
    """
    spark = edges.sparkSession
    kinds = dict(edges.dtypes)
    few = edges.select(child, parent).limit(small + 1).collect()
    if len(few) <= small:
        found = _closed_here([tuple(r) for r in few])
        if found is not None:
            return spark.createDataFrame(found, f"ancestor {kinds[parent]}, descendant {kinds[child]}")
    single = edges.where(F.col(child).isNotNull() & F.col(parent).isNotNull()).select(F.col(parent).alias("ancestor"), F.col(child).alias("descendant")).distinct()
    nodes = edges.select(F.col(child).alias("n")).union(edges.select(F.col(parent).alias("n"))).where("n is not null").distinct()
    upto, upto_path = stored(single, "closure")
    jumps, jumps_path = upto, None
    steps, known = 1, -1
    while True:
        if not upto.where(F.col("ancestor") == F.col("descendant")).isEmpty():
            raise CycleError("a node is its own ancestor")
        further = upto.select("ancestor", F.col("descendant").alias("m")).join(jumps.select(F.col("ancestor").alias("m"), "descendant"), "m")
        wider, wider_path = stored(upto.unionByName(further.select("ancestor", "descendant")).distinct(), "closure")
        n = wider.count()
        longer, longer_path = stored(jumps.select("ancestor", F.col("descendant").alias("m")).join(jumps.select(F.col("ancestor").alias("m"), "descendant"), "m").select("ancestor", "descendant").distinct(), "jumps")
        for path in (upto_path, jumps_path):
            if path:
                discard(spark, path)
        upto, upto_path, jumps, jumps_path, steps = wider, wider_path, longer, longer_path, steps * 2
        if n == known or longer.isEmpty():
            break
        known = n
        if steps > DEEPEST:
            raise CycleError(f"a path has more than {DEEPEST} steps")
    if not upto.where(F.col("ancestor") == F.col("descendant")).isEmpty():
        raise CycleError("a node is its own ancestor")
    return upto.unionByName(nodes.select(F.col("n").alias("ancestor"), F.col("n").alias("descendant")))


def _ahead(walk: DataFrame, below: DataFrame, column: str, roots: DataFrame | None) -> DataFrame:
    """``walk(node, jump, ...)`` with each jump replaced by the jump of the node that it leads to in ``below``, and that node's ``column`` added to its own.

    ``roots(root, more)`` has the roots' values in that column, which stay the same.
    Most jumps of a walk that is nearly done lead to a root: these, and nodes without
    a jump, are dealt over all partitions instead of meeting in one.
    """
    if roots is None:
        roots = walk.limit(0).select(F.col("node").alias("root"), F.lit(0).cast("long").alias("more"))
    known = walk.join(F.broadcast(roots), F.col("jump") == F.col("root"), "left")
    done = F.col("jump").isNull() | F.col("root").isNotNull()
    known = known.withColumns({"_key": F.when(~done, F.col("jump")), "_part": F.when(done, F.pmod(F.xxhash64("node"), F.lit(PARTS))).otherwise(F.lit(0).cast("long"))})
    # zero, though no literal: the planner would take that out of the join's keys
    ahead = below.select(F.col("node").alias("_to"), F.pmod(F.xxhash64("node"), F.lit(1)).cast("long").alias("_zero"), F.col("jump").alias("_next"), F.col(column).alias("_more"))
    joined = known.join(ahead, (F.col("_key") == F.col("_to")) & (F.col("_part") == F.col("_zero")), "left")
    moved = {"jump": F.col("_next"), column: F.col(column) + F.coalesce("more", "_more", F.lit(0))}
    return joined.select(*[moved.get(c, F.col(c)).alias(c) for c in walk.columns])


def intervals(edges: DataFrame, child: str, parent: str, buckets: int = 256) -> DataFrame:
    """``(node, low, high, depth)`` of a forest: d is a or below a where ``a.low <= d.low <= a.high``.

    Every node has one parent at most (else an error); roots may be named by a null
    parent or by being a parent alone.  One row a node, whatever the depth: subtree
    sizes and the places of a preorder are summed up along paths that double.  The
    children of a node are placed in ``buckets``, so a node with very many children
    is no single task.
    """
    spark = edges.sparkSession
    named = edges.where(F.col(child).isNotNull()).groupBy(F.col(child).alias("node")).agg(F.min(parent).alias("up"), F.count_distinct(parent).alias("parents"))
    own = edges.where(F.col(parent).isNotNull()).select(F.col(parent).alias("node")).distinct()
    tree = named.join(own, "node", "full")
    sure = F.when(F.coalesce("parents", F.lit(0)) > 1, F.raise_error(F.concat(F.lit("several parents: "), F.col("node").cast("string")))).otherwise(F.lit(1))
    # a node's jump, the nodes below it that are nearer than the jump is long, and its depth so far
    walk, path = stored(tree.select("node", F.col("up").alias("jump"), sure.cast("long").alias("size"), F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long").alias("depth")), "intervals")
    parents, parents_path = stored(tree.select("node", "up"), "parents")
    steps, nodes = 1, walk.count()
    few = walk.where("jump is null").limit(ROOTS + 1).count() <= ROOTS
    roots, roots_path = stored(walk.where("jump is null").select(F.col("node").alias("root"), F.lit(0).cast("long").alias("more")), "roots") if few else (None, None)
    while not walk.where("jump is not null").isEmpty():
        if steps >= nodes:
            raise CycleError("a node is its own ancestor")
        moved = walk.where("jump is not null").groupBy(F.col("jump").alias("node")).agg(F.sum("size").alias("below"))
        larger = walk.join(moved, "node", "left").select("node", "jump", (F.col("size") + F.coalesce("below", F.lit(0))).alias("size"), "depth")
        new, new_path = stored(_ahead(larger, walk, "depth", roots), "intervals")
        discard(spark, path)
        walk, path, steps = new, new_path, steps * 2
    # the places of a node's children follow each other; the roots are children of none
    placed = parents.join(walk.select("node", "size", "depth"), "node").withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets)))
    sums = placed.groupBy("up", "bucket").agg(F.sum("size").alias("taken"))
    earlier = Window.partitionBy("up").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("up").alias("_up"), F.col("bucket").alias("_bucket"), F.coalesce(F.sum("taken").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("up", "bucket").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    offset = F.col("_inside") + F.col("before") + F.when(F.col("up").isNotNull(), 1).otherwise(0)
    placed = local.join(sums, local["up"].eqNullSafe(sums["_up"]) & (local["bucket"] == sums["_bucket"]))
    walk2, path2 = stored(placed.select("node", F.col("up").alias("jump"), "size", "depth", offset.alias("low")), "preorder")
    discard(spark, path)
    discard(spark, parents_path)
    if few:
        discard(spark, roots_path)
        roots, roots_path = stored(walk2.where("jump is null").select(F.col("node").alias("root"), F.col("low").alias("more")), "roots")
    while not walk2.where("jump is not null").isEmpty():
        new, new_path = stored(_ahead(walk2, walk2, "low", roots), "preorder")
        discard(spark, path2)
        walk2, path2 = new, new_path
    return walk2.select("node", "low", (F.col("low") + F.col("size") - 1).alias("high"), "depth")
