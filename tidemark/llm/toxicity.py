"""Toxicity of whole texts by a counterfactual-regularised classifier.

Method: logistic regression on the words of a text, present or not, and on their
beginnings, as far as a feature goes with the label more often or less than
chance allows. Labelled sentences that name a group of people are repeated with the
name swapped for another group's; the training penalises the square of every
change of score that the swap causes, so that naming a group does not make a
text toxic. Into a sentence that names no group, a name is put first.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import TEXT, added, mapped, wider, with_text

#: Bound of the sample the model is fitted on: labelled documents, and features of one of them.
SAMPLE = 8_000
SAMPLE_FEATURES = 20_000
#: Naming sentences of a text that are swapped; of more, those that come first by hash.
TEXT_PAIRS = 32
BUCKETS = 1 << 20
STARTS = (3, 4, 5, 6)
#: A feature counts if it occurs in so many texts and its toxic share is so many standard errors from the mean.
LEAST_TEXTS = 2
LEAST_Z = 3.5
STEPS = 200
RATE = 0.1
RIDGE = 1e-5
SWAP_PENALTY = 5.0
PREDICT_FROM = 0.7
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")

#: Names of groups that may take each other's place in a sentence.
IDENTITY = (
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("women", "men"),
    ("woman", "man"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("blind", "deaf", "disabled"),
    ("old", "young"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("christen", "muslime", "juden"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("chrétiens", "musulmans", "juifs"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("cristianos", "musulmanes", "judíos"),
)
SWAPS = {name: [other for other in group if other != name] for group in IDENTITY for name in group}
NAMES = tuple(SWAPS)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features_of(word: str) -> list[int]:
    """Buckets of a word and its beginnings."""
    names = [word, *(f"{word[:k]}^" for k in STARTS if len(word) >= k)]
    return [zlib.crc32(x.encode()) % BUCKETS for x in names]


def feature_set(words: set[str]) -> np.ndarray:
    return np.unique(np.array([f for w in words for f in features_of(w)], np.int64))


def swapped(words: set[str], number: int) -> set[str] | None:
    """The same words with every group name replaced; ``number`` turns the choice. None without a name."""
    named = words & SWAPS.keys()
    if not named:
        return None
    return words - named | {SWAPS[n][(number + k) % len(SWAPS[n])] for k, n in enumerate(sorted(named))}


def pairs_of(text: str, most: int = TEXT_PAIRS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each sentence of a text that names a group, the features that only it and that only its swapped form has; the
    others cancel. A text that names none gives one pair, of a sentence with a name put in. Which name comes is
    told by a hash of the text. Of more than ``most`` naming sentences those that come first by hash are taken."""
    number = zlib.crc32(text.encode())
    sentences = SENTENCE.split(text)
    parts = [set(words_of(s)) for s in sentences]
    order = [k for k, p in enumerate(parts) if p & SWAPS.keys()]
    if len(order) > most:
        order = sorted(sorted(order, key=lambda k: (zlib.crc32(sentences[k].encode()), k))[:most])
    named = [parts[k] for k in order]
    if not named:  # a neutral mention, put into a sentence that has none
        named = [next((p for p in parts if p), set()) | {NAMES[number % len(NAMES)]}]
    both = [(feature_set(p), feature_set(swapped(p, number + k))) for k, p in enumerate(named)]
    return [(np.setdiff1d(a, b, True), np.setdiff1d(b, a, True)) for a, b in both]


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[int, float]


def _entries(sets: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every feature of the sets that has a column in ``place``."""
    columns = [c[c >= 0] for c in (place[s] for s in sets)]
    row = np.repeat(np.arange(len(sets), dtype=np.int32), [len(c) for c in columns])
    return row, np.concatenate([*columns, np.empty(0, np.int32)])


def train(texts: list[np.ndarray], toxic: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """Logistic regression by Adam steps on feature sets ``texts`` with labels ``toxic``.

    ``pairs`` are sets before and after a swap, or what differs in them.
    """
    n = len(texts)
    share = min(max(float(toxic.mean()), 1e-6), 1 - 1e-6)
    bias = math.log(share / (1 - share))
    seen, hit = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for x, label in zip(texts, toxic, strict=True):  # every feature once a text
        seen[x] += 1
        hit[x] += label
    z = (hit - seen * share) / np.sqrt(np.maximum(seen * share * (1 - share), 1e-9))
    names = np.flatnonzero((seen >= LEAST_TEXTS) & (np.abs(z) >= LEAST_Z))
    place = np.full(BUCKETS, -1, np.int32)
    place[names] = np.arange(len(names), dtype=np.int32)
    d, m = len(names), max(len(pairs), 1)
    if not d:
        return Model(bias, {})
    row, column = _entries(texts, place)
    a_row, a = _entries([x for x, _ in pairs], place)
    b_row, b = _entries([x for _, x in pairs], place)
    theta = np.append(np.zeros(d), bias)
    first, second = np.zeros(d + 1), np.zeros(d + 1)
    for k in range(1, STEPS + 1):
        w = theta[:-1]
        score = np.bincount(row, w[column], minlength=n) + theta[-1]
        error = (1 / (1 + np.exp(-np.clip(score, -35, 35))) - toxic) / n
        change = np.bincount(a_row, w[a], minlength=m) - np.bincount(b_row, w[b], minlength=m)
        change *= 2 * SWAP_PENALTY / m
        g = np.bincount(column, error[row], minlength=d) + RIDGE * w
        g += np.bincount(a, change[a_row], minlength=d) - np.bincount(b, change[b_row], minlength=d)
        g = np.append(g, error.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta = theta - RATE * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
    return Model(float(theta[-1]), dict(zip(names.tolist(), theta[:-1].tolist(), strict=True)))


def learn(
    documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_features: int = SAMPLE_FEATURES, text_pairs: int = TEXT_PAIRS
) -> Model | None:
    """A model from ``documents`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Fitted on the ``sample`` labelled ids that come first by hash, less texts of
    more than ``most_features`` features; feature sets, no texts, reach the driver. Of each of these
    texts ``text_pairs`` sentences that name a group are swapped, all if there are no more. So both bounds of what reaches the
    driver are parameters. Of repeated labels
    the larger counts, of repeated documents any one; null ids, labels and texts teach nothing. None if
    nothing is left to learn from.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .where("id is not null and toxic is not null")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        sets = [feature_set(set(words_of(t))).astype(np.int32).tobytes() for t in texts]
        pairs = [pairs_of(t, text_pairs) for t in texts]
        sides = {
            name: pa.array([[p[side].astype(np.int32).tobytes() for p in of] for of in pairs], pa.list_(pa.binary()))
            for side, name in enumerate("ab")
        }
        rest = {"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"), "x": pa.array(sets, pa.binary())}
        return pa.record_batch(rest | sides)

    schema = "doc_id long, toxic int, x binary, a array<binary>, b array<binary>"
    found = mapped(rows.select("doc_id", "toxic", "text"), features, schema)
    got = found.where(F.length("x") <= 4 * most_features).dropDuplicates(["doc_id"]).toArrow()
    if not got.num_rows:
        return None
    order = np.argsort(np.asarray(got.column("doc_id")))
    sets = [np.frombuffer(x.as_buffer(), np.int32) for x in got.column("x")]
    toxic = (np.asarray(got.column("toxic")) > 0).astype(float)
    before, after = (got.column(c).take(pa.array(order)).combine_chunks().flatten() for c in "ab")
    pairs = [tuple(np.frombuffer(x.as_py(), np.int32) for x in pair) for pair in zip(before, after, strict=True)]
    return train([sets[k] for k in order], toxic[order], pairs)


CACHED_WORDS = 200_000


class _Known(dict):
    """Weighted features of each word; most words have none."""

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = tuple(f for f in features_of(word) if f in self.weights)
        return found


def text_score(model: Model, text: str, known: dict) -> float:
    hits = {f for w in set(words_of(text)) for f in known[w]}
    z = model.bias + math.fsum(model.weights[f] for f in hits)
    return 1 / (1 + math.exp(-min(max(z, -35.0), 35.0)))


def score(documents: DataFrame, model: Model | None, keep: str | StructType) -> DataFrame:
    """Columns ``keep`` (a schema), score and predicted for every row of ``documents``.

    Only ``text`` decides; a null text counts as empty and gets the score of the
    bias. Without a model every score is 0. predicted is 1 from ``PREDICT_FROM``. Every row is scored, repeated ones alike; an
    empty table gives no rows. Other columns of ``documents`` are not read, whatever their names.
    """

    def batches(stream):
        known = _Known(model.weights if model else {})
        for batch in stream:
            texts = batch.column(TEXT).to_pylist()
            value = np.array([text_score(model, t or "", known) if model else 0.0 for t in texts], np.float64)
            yield added(batch, score=pa.array(value), predicted=pa.array((value >= PREDICT_FROM).astype(np.int32)))

    return with_text(documents, keep).mapInArrow(batches, wider(keep, "score double, predicted int"))
