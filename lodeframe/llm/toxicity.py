"""Toxicity: a linear classifier with counterfactual regularisation.

Features are the distinct lower-cased words of a text and their leading
letters (``PREFIXES``), so inflected insults share a feature.  A bounded,
stratified sample of labelled documents (``sample`` a class, chosen by a hash of
the id among those with texts of at most ``longest`` bytes) fits the model in one
executor task, which so holds at most ``2 * sample * longest`` bytes:

1. features that are seen often enough are kept where their chi-square against the
   label is significant;
2. toxic texts also enter sentence by sentence, where a sentence holds a feature
   that hardly a clean text has: one insult is enough (all such sentences count,
   those of one text at most as much as four);
3. logistic weights minimise log loss + ridge + ``lam`` times the squared score
   change that swapping identity terms causes.  Pairs come from the labelled
   sentences that name a group: the sentence and the sentence with the term
   replaced by each other term of its set.  All pairs of the sample are used;
   those that change the same features count once a text.

A text that merely names a group then scores as if it named another one, so
neutral mentions aren't punished for the company that a term keeps in the
sample.  Scoring reads every text whole, batch by batch, with the bounded model.

Defined cases: null and empty texts have no features and get the base score;
labels that are null, and labelled ids without a document, are ignored; equal
labelled rows count once, however often they occur; without rows of both classes every score is
the share of toxic labels (0 where there are none).  Label, language, source and
id are never features.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import text_batches

PREFIXES = (4, 5, 6)
WORDS = re.compile(r"[^\W\d_]+")
SENTENCES = re.compile(r"[^.!?\n]+")
MEMORY = 100_000

#: Sets of words for groups of people that may replace each other.
IDENTITY_SETS: tuple[tuple[str, ...], ...] = (
    ("woman", "man"),
    ("women", "men"),
    ("girl", "boy"),
    ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european", "american"),
    ("immigrant", "refugee", "native", "citizen"),
    ("immigrants", "refugees", "natives", "citizens"),
    ("old", "young", "disabled", "blind", "deaf"),
    ("frau", "mann"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femme", "homme"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujer", "hombre"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


def features_of(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


def words_of(text: str | None) -> set[str]:
    return set(WORDS.findall((text or "").lower()))


def counterfactuals(text: str, index: dict[str, int], sets: Sequence[Sequence[str]]) -> set[tuple[tuple[int, int], ...]]:
    """The distinct changes of features (number, 1 for gone or -1 for new) by swapping one identity term in a sentence of the text."""
    others = {term: [x for x in group if x != term] for group in sets for term in group}
    known = {term: {f for f in features_of(term) if f in index} for term in others}
    found = set()
    for sentence in SENTENCES.findall(text.lower()):
        words = words_of(sentence)
        terms = words & others.keys()
        if not terms:
            continue
        seen = Counter(f for w in words for f in features_of(w) if f in index)
        for term in terms:
            for other in others[term]:
                after = {f for f in known[term] | known[other] if f in known[other] or seen[f] > (f in known[term])}
                change = [(index[f], (seen[f] > 0) - (f in after)) for f in known[term] | known[other]]
                found.add(tuple(sorted((k, d) for k, d in change if d)))
    return found - {()}


def features_in(text: str | None) -> set[str]:
    return {f for w in words_of(text) for f in features_of(w)}


def select_features(texts: Sequence[str], labels: np.ndarray, least: int) -> list[str]:
    """The features of toxic texts that are significant by chi-square, the highest first, ties by name.

    Only what ``least`` toxic texts have is counted in the others, so memory
    follows the toxic part of the sample.
    """
    n, pos = len(texts), int(labels.sum())
    toxic: Counter[str] = Counter()
    for text, label in zip(texts, labels, strict=True):
        if label:
            toxic.update(features_in(text))
    toxic = Counter({f: c for f, c in toxic.items() if c >= least})
    seen = Counter(toxic)
    for text, label in zip(texts, labels, strict=True):
        if not label:
            seen.update(toxic.keys() & features_in(text))
    scored = []
    for f, c in seen.items():
        if c == n:
            continue
        a, e = toxic[f], c * pos / n
        chi = (a - e) ** 2 / (e * (1 - c / n) * (1 - pos / n))
        # one chance in 100,000 for a feature without relation to the label: there are many features
        if a > e and chi >= 19.5:
            scored.append((-chi, f))
    return [f for _, f in sorted(scored)]


def strong_features(texts: Sequence[str], labels: np.ndarray, names: Sequence[str]) -> set[str]:
    """Features that are a sign of toxicity by themselves: in five toxic texts and two in a hundred at least, hardly in others."""
    toxic: Counter[str] = Counter()
    clean: Counter[str] = Counter()
    wanted = set(names)
    for text, label in zip(texts, labels, strict=True):
        (toxic if label else clean).update(wanted & features_in(text))
    least = max(5, 0.02 * labels.sum())
    return {f for f in names if toxic[f] >= least and toxic[f] >= 50 * clean[f]}


def telling_sentences(text: str, strong: set[str], most: int = 4, words_most: int = 2) -> Iterator[tuple[set[str], float]]:
    """Words of the sentences of a toxic text that hold a strong feature, each also cut down to its telling words; and their weights.

    Every sentence and word counts; those of a text with more than ``most``
    sentences weigh as much as ``most`` together, those of a sentence with more
    than ``words_most`` telling words as much as ``words_most``.
    """
    found = []
    for sentence in SENTENCES.findall(text.lower()):
        words = words_of(sentence)
        telling = {w for w in words if not strong.isdisjoint(features_of(w))}
        if telling:
            found.append((words, telling))
    share = min(1.0, most / max(1, len(found)))
    for words, telling in found:
        yield words, share
        yield from (({w}, share * min(1.0, words_most / len(telling))) for w in sorted(telling))


def fit(texts: Sequence[str], labels: Sequence[int], lam: float, ridge: float, least: int, sets: Sequence[Sequence[str]]) -> dict:
    """Bias and weights by feature."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        share = min(max(share, 1e-9), 1 - 1e-9)
        return {"bias": math.log(share / (1 - share)), "weights": {}}
    names = select_features(texts, y, least)
    index = {f: k for k, f in enumerate(names)}

    # one insult is enough: toxic texts also count by the sentences that tell, so no weight relies on repetition
    strong = strong_features(texts, y, names)
    numbers = lambda words: tuple(sorted({index[f] for w in words for f in features_of(w) if f in index}))
    rows: dict[tuple[tuple[int, ...], int], float] = defaultdict(float)  # equal rows are one with their weights' sum
    changes: Counter[tuple[tuple[int, int], ...]] = Counter()
    for text, label in zip(texts, labels, strict=True):
        rows[numbers(words_of(text)), int(label)] += 1
        if label:
            for words, share in telling_sentences(text or "", strong):
                rows[numbers(words), 1] += share
        changes.update(counterfactuals(text or "", index, sets))
    y = np.array([label for _, label in rows], float)
    weight = np.array(list(rows.values()))
    # both classes weigh the same, so the score doesn't depend on how rare toxic rows are
    weight *= np.where(y == 1, 0.5 / weight[y == 1].sum(), 0.5 / weight[y == 0].sum())
    m_rows = np.repeat(np.arange(len(rows)), [len(r) for r, _ in rows])
    m_cols = np.array([k for r, _ in rows for k in r], int)
    # changes reach few features, and their squares are summed: each counts once a text, so no text outweighs the others
    reached = {k: n for n, k in enumerate(sorted({k for c in changes for k, _ in c}))}
    columns = np.array(list(reached), int)
    squares = np.zeros((len(reached), len(reached)))
    for change, n in changes.items():
        for k, d in change:
            for j, e in change:
                squares[reached[k], reached[j]] += n * d * e
    squares *= 2 * lam / max(1, changes.total())
    w = np.zeros(len(names) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, 501):
        z = np.bincount(m_rows, w[m_cols], len(rows)) + w[-1]
        off = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.append(np.bincount(m_cols, off[m_rows], len(names)) + ridge * w[:-1], off.sum())
        grad[columns] += squares @ w[columns]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {"bias": float(w[-1]), "weights": {f: float(w[k]) for f, k in index.items() if abs(w[k]) > 1e-6}}


def train(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    sample: int = 1500,
    lam: float = 1.0,
    ridge: float = 2e-5,
    least: int = 3,
    longest: int = 200_000,
    identity_sets: Sequence[Sequence[str]] = IDENTITY_SETS,
    label_col: str = "toxic",
) -> dict:
    """Fit on at most ``sample`` labelled documents of each class, those with the lowest id hash among ``use``.

    Bounds of the fit: ``sample`` documents a class, and ``longest`` bytes a text
    (longer labelled texts aren't learnt from; all texts are scored whole).  The
    sample is taken from distinct ids that have a document of at most that length,
    so repeated rows, labels without a document and long texts take no places; of
    several texts of one id the one with the lowest hash is learnt from.  Without
    labelled documents the score is 0 everywhere.
    """
    text_batches(docs.sparkSession)
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.where(use) if use is not None else marked
    readable = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
    marked = marked.select("doc_id", F.col(label_col).cast("int").alias("label")).distinct().join(readable.select("doc_id"), "doc_id", "left_semi")
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    picked = None
    for value in (0, 1):
        part = marked.where(F.col("label") == value).orderBy(*order).limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * sample rows of two integers are broadcast
    joined = readable.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    joined = joined.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            ((r["doc_id"], r["text"] or "", r["label"]) for b in batches for r in b.to_pylist()),
            key=lambda r: (str(r[0]), r[1], r[2]),
        )
        model = fit([r[1] for r in rows], [r[2] for r in rows], lam, ridge, least, identity_sets)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(model)])], ["model"])

    # the sample is bounded, so one task may hold it
    found = joined.repartition(1).mapInArrow(fitted, "model string").collect()
    # an empty side may leave no partition at all
    return json.loads(found[0][0]) if found else fit([], [], lam, ridge, least, identity_sets)


class Scorer:
    def __init__(self, model: dict):
        self.bias, self.weights = model["bias"], model["weights"]
        self.memory: dict[str, tuple[str, ...]] = {}

    def known(self, word: str) -> tuple[str, ...]:
        found = tuple(f for f in features_of(word) if f in self.weights)
        if len(self.memory) >= MEMORY:
            self.memory.clear()
        self.memory[word] = found
        return found

    def __call__(self, text: str | None) -> float:
        memory, known = self.memory, self.known
        features: set[str] = set()
        for word in words_of(text):
            found = memory.get(word)
            if found is None:
                found = known(word)
            if found:
                features.update(found)
        z = self.bias + math.fsum(self.weights[f] for f in features)
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def score_column(spark, model: dict) -> Callable[[Column | str], Column]:
    """A column function that scores texts by ``model`` in Arrow batches."""
    text_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = Scorer(sent.value)
        for texts in batches:
            yield pa.array([score(t.as_py()) for t in texts], pa.float64())

    return toxicity
