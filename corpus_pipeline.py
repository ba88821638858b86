"""A corpus pipeline over ``documents``: five stages, each written and read again.

1. toxicity: documents scored at 0.7 or more by the classifier go;
2. n-gram Jaccard join: of each group of near copies the smallest id stays;
3. substring dedup: words in repeated 13-word windows are cut from the texts;
   a document of which no word is left goes, one that had none before stays;
4. source mixing: each document is emitted as often as its source's target asks;
5. byte-level BPE: texts are encoded; the result adds ``n_tokens, ids_sha256,
   decoded_sha256`` and the ids.

Rows without an id pass stages 2 and 3 as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeframe.llm import byte_bpe, mixing, ngram_join, queries, substring_dedup, toxicity
from lodeframe.llm.storage import documents, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # fitted on the labelled rows of the corpus, so a document's own copies can't tilt it
    model = queries.toxicity_model(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
    score = toxicity.score_column(spark, model)
    return docs.where(score(F.col("text")) < queries.TOXIC_AT)


def keep_first_of_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = ngram_join.group_documents(docs.select("doc_id", "text"))
    gone = groups.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.deduplicated(docs)
    left = cut.where((F.col("dedup.n_removed") < F.col("dedup.n_words")) | (F.col("dedup.n_words") == 0))
    changed = F.when(F.col("dedup.n_removed") > 0, F.char_length("text").cast(dict(docs.dtypes).get("n_chars", "long")))
    return left.withColumn("n_chars", F.coalesce(changed, F.col("n_chars"))).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_first_of_groups),
    ("substring_dedup", cut_repeats),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: A trained classifier and a tokenizer aren't SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
