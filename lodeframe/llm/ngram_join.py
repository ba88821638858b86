"""N-gram Jaccard join: groups of documents whose n-gram sets are alike.

Two documents link when ``100 * intersection >= 80 * union`` of their sets of
distinct n-word shingles.  Nothing is lost on the way from all pairs to few:

1. A count-min sketch, merged over blocks of documents (``windows``), estimates in
   how many places a shingle occurs, never too low.  The estimate, ties by hash, is
   one order of all shingles, rarest first.  Two alike sets of size n share a
   shingle among the first ``n // 5 + 1`` of each, in any fixed order; so a
   document keeps those of them as keys that aren't its own, and without any it
   links with nothing.
2. Equal sets form a class; only one member, the smallest id, goes on.
3. A key is a shingle and a band of set sizes that can be alike.  Keys that the
   same classes hold are one.
4. ``STARS`` times, every class joins the group of one key's hub (its smallest
   member, whose copy is in every part of the group).  A part of a group is stored
   in one trie, common shingles first, so near copies share their paths; each set
   walks the trie with the overlap so far; a subtree is pruned when the lengths
   that remain below it can't reach the threshold or when all below it is already
   in the set's component.  Large families become components here, with each set
   sent once a time.
5. Only keys that still hold several components are left.  Their classes are walked
   in tries against each other, each pair of parts in one task (``_left_over``).
   So every pair with a common key is linked, or compared, or of one component.
6. The links found span the components, which are then named by smallest id.

Texts travel, not sets: a task builds the sets that it needs.

Defined cases: a document with fewer than n words has its whole word sequence as
its only shingle; one without words, or with a null text, has the empty set and
links with nothing; rows without an id take no part and have no component; rows
that repeat an id are one document, whose texts are all linked; extra columns
are ignored.  Ids must be integers; others raise ``TypeError``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected
from .storage import forget, integer_ids, materialize, text_batches, write_shared
from .windows import CELLS_PER_WINDOW, Answers, Sizes, block_answers, block_number, concatenated, mixed, window_hashes, word_hashes

SIZE = 5
#: Likeness as a ratio of whole numbers.
NUMERATOR, DENOMINATOR = 4, 5
#: Sets, and shingles, that a part of a group holds about; a larger group has more parts.
PART, PART_SHINGLES = 250, 1_000_000
STARS = 1
BAND = math.log(DENOMINATOR / NUMERATOR)


def shingle_set(data: bytes, size: int = SIZE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    ids = word_hashes(data.lower())
    if not len(ids):
        return np.zeros(0, np.uint64)
    if len(ids) < size:
        return window_hashes(ids, len(ids)) ^ mixed(np.array([len(ids)], np.uint64))
    return np.unique(window_hashes(ids, size))


def prefix_length(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


class Trie:
    """Sets in one order, as ranges of their sorted sequences.

    Sets of one ``label`` are known to be connected.  With ``sides``, only sets of
    different sides are compared.
    """

    def __init__(self, sets: list[np.ndarray], labels: list[int] | None = None, sides: list[int] | None = None):
        every = np.concatenate(sets)
        names, places, counts = np.unique(every, return_inverse=True, return_counts=True)
        rank = np.empty(len(names), np.int64)
        rank[np.lexsort((names, -counts))] = np.arange(len(names))
        ends = np.cumsum([len(s) for s in sets])
        sequences = [np.sort(rank[places[b - len(s) : b]]) for s, b in zip(sets, ends, strict=True)]
        self.order = sorted(range(len(sets)), key=lambda k: sequences[k].astype(">u4").tobytes())
        self.sequences = [sequences[k] for k in self.order]
        self.sizes = np.array([len(s) for s in self.sequences])
        self.labels = np.unique(labels, return_inverse=True)[1][self.order] if labels is not None else np.arange(len(sets))
        #: how many sets before a place are on the second side
        self.second = np.concatenate([[0], np.cumsum(np.array(sides)[self.order])]) if sides is not None else None
        self.words = len(names)
        shared = [0]
        for a, b in zip(self.sequences, self.sequences[1:], strict=False):
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            shared.append(int(differ[0]) if len(differ) else n)
        self.shared = np.array(shared)
        #: low, high, depth above, depth below, shortest, longest, first child, next sibling
        self.nodes: list[list[int]] = []
        self._build()

    def _build(self) -> None:
        todo = [(0, len(self.sequences), 0, -1)]
        last_child: dict[int, int] = {}
        while todo:
            low, high, above, parent = todo.pop()
            below = int(self.shared[low + 1 : high].min()) if high - low > 1 else int(self.sizes[low])
            me = len(self.nodes)
            sizes = self.sizes[low:high]
            self.nodes.append([low, high, above, below, int(sizes.min()), int(sizes.max()), -1, -1])
            if parent >= 0:
                if parent in last_child:
                    self.nodes[last_child[parent]][7] = me
                else:
                    self.nodes[parent][6] = me
                last_child[parent] = me
            if high - low > 1:
                cuts = [low, *(low + 1 + np.flatnonzero(self.shared[low + 1 : high] == below)).tolist(), high]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    if b - a > 1 or self.sizes[a] > below:
                        todo.append((a, b, below, me))

    def _same_side(self, x: int, low: int, high: int) -> bool:
        """Whether all sets of a range are on the side of ``x``."""
        if self.second is None:
            return False
        return self.second[high] - self.second[low] == (high - low) * (self.second[x + 1] - self.second[x])

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that span the components of the sets, as places in the order given."""
        label = self.labels.copy()
        inside = np.zeros(self.words, bool)
        nodes = self.nodes
        for x, own in enumerate(self.sequences):
            n = len(own)
            inside[own] = True
            todo = [(0, 0)]
            while todo:
                at, overlap = todo.pop()
                low, high, above, below, shortest, longest, child, _ = nodes[at]
                if high <= x + 1 or DENOMINATOR * longest < NUMERATOR * n or DENOMINATOR * n < NUMERATOR * shortest:
                    continue
                if self._same_side(x, low, high) or (label[low:high] == label[x]).all():
                    continue
                if below > above:
                    overlap += int(np.count_nonzero(inside[self.sequences[low][above:below]]))
                # words of the path that the set lacks, and words of the set that the path has passed
                lacking = below - overlap
                passed = int(np.searchsorted(own, self.sequences[low][below - 1], "right")) - overlap if below else 0
                size = min(max(n - passed + lacking, shortest), longest)
                if (NUMERATOR + DENOMINATOR) * min(n - passed, size - lacking) < NUMERATOR * (n + size):
                    continue
                # sets that end here: equal ones lie side by side
                ends = low
                while ends < high and self.sizes[ends] == below:
                    if ends > x and label[ends] != label[x] and not self._same_side(x, ends, ends + 1):
                        if (NUMERATOR + DENOMINATOR) * overlap >= NUMERATOR * (n + below):
                            yield self.order[x], self.order[ends]
                            label[label == label[ends]] = label[x]
                    ends += 1
                while child >= 0:
                    todo.append((child, overlap))
                    child = nodes[child][7]
            inside[own] = False


def group_documents(
    docs: DataFrame, size: int = SIZE, part: int = PART, cells_per_window: float = CELLS_PER_WINDOW, stars: int = STARS
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``.

    ``part``, ``cells_per_window`` and ``stars`` change the work, not the result.
    """
    integer_ids(docs)
    spark = docs.sparkSession
    text_batches(spark)
    id_type = dict(docs.dtypes)["doc_id"]
    data = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data"))
    sizes = Sizes.of(data, cells_per_window)
    blocked = data.withColumn("block", block_number(sizes.blocks, "doc_id", F.when(F.col("doc_id").isNull(), F.col("data"))))

    def sets_of(table: pa.Table) -> list[np.ndarray]:
        return [shingle_set(x.as_py() or b"", size) for x in table["data"]]

    def keyed(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        sets = sets_of(left)
        estimates = Answers(right, sizes).levels(concatenated(sets)) if any(map(len, sets)) else None
        keys, done = [], 0
        for s in sets:
            own = estimates[done : done + len(s)] if len(s) else None
            done += len(s)
            if not len(s):
                keys.append(None)
                continue
            first = np.lexsort((s, own))[: prefix_length(len(s))]
            first = s[first[own[first] > 1]].view(np.int64)
            keys.append(first if len(first) else None)
        texts = [x if k is not None else None for x, k in zip(left["data"].to_pylist(), keys, strict=True)]
        columns = [
            left["doc_id"],
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            pa.array(keys, pa.list_(pa.int64())),
            pa.array(texts, pa.binary()),
        ]
        return pa.table(columns, ["doc_id", "n", "digest", "keys", "data"])

    answers = block_answers(blocked, lambda table: concatenated(sets_of(table)), sizes)
    sets = blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(keyed, "doc_id long, n long, digest binary, keys array<long>, data binary")
    sets = materialize(sets, "ngram-sets")
    found = sets.where("doc_id is not null and n > 0")
    classes = found.where("keys is not null").groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("data").alias("data"))
    classes, classes_path = write_shared(classes.drop("digest"), "ngram-classes")
    links = _links(classes, size, part, stars)
    # the texts of one id belong together
    texts_of = found.groupBy("digest").agg(F.min("doc_id").alias("node"))
    texts_of = materialize(texts_of, "ngram-class-names")
    joined = found.select("doc_id", "digest").join(texts_of, "digest")
    components = connected(links.unionByName(_same_id(joined)), "ngram-links")
    forget(spark, classes_path)
    by_class = texts_of.join(components, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    named = sets.select("doc_id", "n", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("digest")).alias("digest"))
    out = named.join(by_class, "digest", "left")
    component = F.coalesce("component", F.when(F.col("n") == 0, F.col("doc_id")))
    return out.select(F.col("doc_id").cast(id_type).alias("doc_id"), F.col("n").alias("n_shingles"), component.cast(id_type).alias("component_id"))


def _same_id(rows: DataFrame) -> DataFrame:
    """Edges between the classes of one document's texts."""
    several = rows.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("a")).where("a <> b")
    return rows.join(several.select("doc_id", "b"), "doc_id").where("node <> b").select(F.col("node").alias("a"), "b")


KEY = ["shingle", "band"]


def _links(classes: DataFrame, size: int, part: int, stars: int) -> DataFrame:
    """Links that span the components of ``classes(node, n, keys, data)``."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(BAND)).cast("int")
    # alike sizes lie in one band or in neighbours
    keys = classes.select("node", "n", F.explode("keys").alias("shingle")).select("node", "n", "shingle", F.explode(F.array(band, band + 1)).alias("band"))
    keys, keys_path = write_shared(keys, "ngram-keys")
    # keys with the same members are one: 128 bits tell different members apart
    members = keys.groupBy(*KEY).agg(
        F.min("node").alias("hub"), F.max("node").alias("far"), F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    )
    once = members.where("hub < far").groupBy("hub", "far", "members", "x", "y").agg(F.min(F.struct(*KEY)).alias("key"))
    once = materialize(once.select("key.*", "hub"), "ngram-hubs")
    held = materialize(keys.join(once, KEY).select(*KEY, "node", "n", "hub"), "ngram-members")
    forget(classes.sparkSession, keys_path)
    links = None
    labels = None
    for _ in range(stars):
        open_ = _several(held, labels)
        to_hub = open_.where("component <> hub_component").groupBy("node", "n").agg(F.min("hub").alias("hub"))
        found = _star_links(materialize(to_hub, "ngram-stars"), classes, labels, size, part)
        labels = connected(found if links is None else links.unionByName(found), "ngram-stars")
        # what is known of the links from here on is who belongs to whom
        links = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = _left_over(_several(held, labels), classes, size, part)
    return found if links is None else links.unionByName(found)


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the component of each node so far."""
    if labels is None:
        return rows.withColumn("component", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _several(held: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of the keys that hold several components, with the key's hub: the first member of its first component."""
    if labels is None:
        return held.select(*KEY, "node", "n", "hub", F.col("node").alias("component"), F.col("hub").alias("hub_component"))
    rows = materialize(_labelled(held.drop("hub"), labels), "ngram-labelled")
    hubs = rows.groupBy(*KEY).agg(F.min(F.struct("component", "node")).alias("first"), F.max("component").alias("last")).where("first.component < last")
    hubs = materialize(hubs.select(*KEY, F.col("first.node").alias("hub"), F.col("first.component").alias("hub_component")), "ngram-open")
    return rows.join(hubs, KEY)


def _parts(rows: str, shingles: str, part: int) -> Column:
    """In how many parts so many sets with so many shingles are dealt."""
    return F.greatest(F.ceil(F.col(rows) / part), F.ceil(F.col(shingles) / PART_SHINGLES)).cast("int")


def _star_links(to_hub: DataFrame, classes: DataFrame, labels: DataFrame | None, size: int, part: int) -> DataFrame:
    """Links inside the parts of each hub's group."""
    groups = to_hub.groupBy("hub").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    groups = materialize(groups.select("hub", _parts("rows", "shingles", part).alias("parts")), "ngram-groups")
    dealt = to_hub.join(groups, "hub").select("node", "hub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("i"))
    heads = groups.select(F.col("hub").alias("node"), "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"))
    rows = _labelled(dealt.unionByName(heads), labels).select("node", "component", F.col("hub").alias("group"), "i", F.col("i").alias("j"))
    return _walk(rows.withColumn("side", F.lit(0)), classes, size)


def _left_over(open_: DataFrame, classes: DataFrame, size: int, part: int) -> DataFrame:
    """Links between different components of each key, every pair of parts in one task.

    Keys that chain together are walked as one group where that sends less than
    walking them one by one, since a member is often held by many of them.  A
    component that fills parts of its own isn't compared with itself.
    """
    open_ = materialize(open_.select(*KEY, "node", "n", "component"), "ngram-left")
    if open_.isEmpty():
        return open_.select(F.col("node").alias("a"), F.col("component").alias("b"))
    heads = open_.groupBy(*KEY).agg(F.min("node").alias("head"))
    chained = connected(open_.join(materialize(heads, "ngram-heads"), KEY).select(F.col("node").alias("a"), F.col("head").alias("b")), "ngram-chains")
    chained = chained.select("node", F.col("component").alias("chain"))
    rows = materialize(open_.join(chained, "node"), "ngram-chained")
    sizes = rows.select("chain", "node").distinct().groupBy("chain").agg(F.count("*").alias("nodes")).join(rows.groupBy("chain").agg(F.count("*").alias("held")), "chain")
    whole = materialize(sizes.select("chain", (F.ceil(F.col("nodes") / (2 * part)) * F.col("nodes") <= F.col("held")).alias("whole")), "ngram-whole")
    rows = rows.join(whole, "chain")
    group = F.when(F.col("whole"), F.concat(F.lit("chain "), F.col("chain").cast("string"))).otherwise(F.concat_ws(" ", F.lit("key"), F.col("shingle").cast("string"), F.col("band").cast("string")))
    rows = materialize(rows.select(group.alias("group"), "node", "n", "component").distinct(), "ngram-grouped")
    # components that fill a part have parts of their own, the others share
    own = rows.groupBy("group", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    own = own.select("group", "component", "rows", "shingles", F.when(F.col("rows") >= part, F.col("component")).alias("large"))
    parts = own.groupBy("group", "large").agg(F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"))
    parts = materialize(parts.select("group", "large", _parts("rows", "shingles", 2 * part).alias("parts")), "ngram-parts")
    listed = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.col("large").alias("large"), k.alias("k")))
    all_parts = parts.groupBy("group").agg(F.flatten(F.collect_list(listed)).alias("all"))
    placed = rows.join(own.select("group", "component", "large"), ["group", "component"])
    placed = placed.join(parts, placed["group"].eqNullSafe(parts["group"]) & placed["large"].eqNullSafe(parts["large"])).select(
        placed["group"], "node", "component", placed["large"], F.pmod(F.xxhash64(F.when(placed["large"].isNotNull(), F.col("node")).otherwise(F.col("component"))), F.col("parts")).cast("int").alias("k")
    )
    me = F.struct("large", "k")
    name = lambda p: F.concat_ws(".", F.coalesce(p["large"].cast("string"), F.lit("")), p["k"].cast("string"))
    # parts of one large component aren't compared
    meets = lambda p: ~F.coalesce(p["large"] == F.col("large"), F.lit(False))
    pairs = F.transform(F.filter("all", meets), lambda p: F.struct(F.least(name(p), name(me)).alias("i"), F.greatest(name(p), name(me)).alias("j"), (name(p) < name(me)).cast("int").alias("side")))
    rows = placed.join(all_parts, "group").select("node", "component", "group", F.explode(pairs).alias("p"))
    return _walk(rows.select("node", "component", "group", "p.i", "p.j", "p.side"), classes, size)


def _walk(rows: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """Links between the sets of each ``group, i, j`` of ``rows(node, component, side, group, i, j)``: inside a part if i = j, else from side to side."""
    texts = rows.join(classes.select("node", "data"), "node")

    def walked(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        labels: list[int] = []
        sides: list[int] = []
        sets: list[np.ndarray] = []
        for batch in batches:
            ids += batch["node"].to_pylist()
            labels += batch["component"].to_pylist()
            sides += batch["side"].to_pylist()
            sets += [shingle_set(x.as_py(), size) for x in batch["data"]]
        if len(sets) > 1 and len(set(labels)) > 1:
            inside = key[1].as_py() == key[2].as_py()
            found = list(Trie(sets, labels, None if inside else sides).links())
            yield pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in found], pa.int64()), pa.array([ids[b] for _, b in found], pa.int64())], ["a", "b"])

    return texts.groupBy("group", "i", "j").applyInArrow(walked, "a long, b long")
