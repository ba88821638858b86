"""The pipeline's stages against brute force on the smallest tables."""

import base64
import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from lodeframe.llm import mixing, queries, toxicity
from lodeframe.llm.storage import documents, materialize
from pyspark.sql import functions as F

from ..conftest import SMALL
from .test_operators import brute_groups


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and gives; the input also has rows with null texts, repeated texts and a null id."""
    docs = documents(spark, SMALL)
    extra = spark.createDataFrame([(90001, None, "en", "src1", 0), (None, "a text without an id", "en", None, 20), (90002, "", "en", "src1", 0)], docs.schema)
    again = docs.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 80000)
    frame = materialize(docs.unionByName(extra).unionByName(again), "test-docs")
    found = [frame]
    for name, stage in corpus_pipeline.STAGES:
        found.append(materialize(stage(spark, found[-1], SMALL), f"test-{name}"))
    return found


def rows(df, *columns):
    return Counter(map(tuple, df.select(*columns).collect()))


def test_columns_stay(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns


def test_toxic_documents_go(spark, stages):
    model = queries.toxicity_model(documents(spark, SMALL), documents(spark, SMALL, "labels"))
    score = toxicity.Scorer(model)
    want = Counter({k: n for k, n in rows(stages[0], "doc_id", "text").items() if score(k[1]) < queries.TOXIC_AT})
    assert rows(stages[1], "doc_id", "text") == want


def test_one_of_each_group_stays(stages):
    given = [tuple(r) for r in stages[1].select("doc_id", "text").collect()]
    gone = {i for i, _, c in brute_groups(given, 5) if i is not None and c < i}
    assert rows(stages[2], "doc_id") == Counter((i,) for i, _ in given if i not in gone)


def brute_cut(given, size=13):
    words = {i: (t or "").encode().split() for i, t in given if i is not None}
    least = {}
    for i, w in sorted(words.items(), reverse=True):
        for k in range(len(w) - size + 1):
            least[tuple(w[k : k + size])] = i
    out = []
    for i, t in given:
        w = (t or "").encode().split()
        gone = {p for k in range(len(w) - size + 1) if i is not None and least[tuple(w[k : k + size])] < i for p in range(k, k + size)}
        if len(gone) == len(w) and w:
            continue
        out.append((i, b" ".join(x for k, x in enumerate(w) if k not in gone).decode() if gone else t))
    return out


def test_repeats_are_cut(stages):
    given = [tuple(r) for r in stages[2].select("doc_id", "text").collect()]
    assert rows(stages[3], "doc_id", "text") == Counter(brute_cut(given))
    assert stages[3].where("n_chars <> char_length(text)").join(stages[2].select("doc_id", F.col("text").alias("t")), "doc_id").where("t <> text").count() == 0


def test_sources_are_mixed(stages):
    given = stages[3]
    decided = {r.doc_id: r.copies for r in mixing.mixed(given).collect()}
    want = Counter({k: n * decided[k[0]] for k, n in rows(given, "doc_id", "text").items() if decided[k[0]]})
    assert rows(stages[4], "doc_id", "text") == want
    taken = Counter()
    for (_, source, text), n in rows(stages[4], "doc_id", "source", "text").items():
        taken[source] += n * len((text or "").encode().split())
    targets = {r.source: r.target for r in mixing.mixed(given).select("source", "target").distinct().collect()}
    assert sum(abs(taken[s] - t) for s, t in targets.items()) < 0.2 * sum(targets.values())


def test_texts_are_encoded(stages):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for (i, t), n in rows(stages[4], "doc_id", "text").items():
        want[i, tuple(library.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()] += n
    assert Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in stages[5].collect()) == want


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 0 and out.columns[:2] == ["doc_id", "n_tokens"]
