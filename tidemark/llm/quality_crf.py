"""Quality of whole documents from a linear-chain CRF over their lines.

Method: every line is a position of a chain with the states bad and good. Its
features describe the line and its two neighbours; two states in a row have
transition weights. Training climbs the conditional log-likelihood of the
labelled documents' lines; forward and backward passes give each line's marginal
of being good. Their mean, weighted by line length, is the document's quality, which a
logistic line fitted to the same labels turns into a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import TEXT, added, mapped, wider, with_text

#: Bound of the sample the model is fitted on: labelled documents, and lines of one of them.
SAMPLE = 6_000
SAMPLE_LINES = 200
STEPS = 200
RATE = 0.1
RIDGE = 1e-3
PREDICT_FROM = 0.3

#: Classes of bytes, told apart by a table: upper and lower case letters, digits, space,
#: closing marks, other marks, and bytes of letters outside ASCII.
UPPER, LOWER, DIGIT, SPACE, CLOSING, MARK, OTHER = range(7)
_CLASS = np.full(256, MARK, np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = UPPER
_CLASS[ord("a") : ord("z") + 1] = LOWER
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = CLOSING
_CLASS[128:] = OTHER
OWN = 13
FEATURES = 3 * OWN + 3


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, feature) values, byte length of each line, and each text's first line.

    Lines part at line feeds; an empty text is one empty line. The last columns of a row
    repeat the line's own values for the line before and after it, and say where
    there is none.
    """
    data = [t.encode() for t in texts]
    lines = [line for d in data for line in d.split(b"\n")]
    per_text = np.array([d.count(b"\n") + 1 for d in data], np.int64)
    first = np.concatenate([[0], np.cumsum(per_text)[:-1]]).astype(np.int64)
    n = len(lines)
    length = np.fromiter(map(len, lines), np.int64, n)
    joined = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    kind = _CLASS[joined]
    start = np.concatenate([[0], np.cumsum(length + 1)[:-1]]).astype(np.int64)
    count = np.stack([np.add.reduceat(kind == k, start, dtype=np.int64) for k in range(7)], 1).astype(np.float64)
    count[:, SPACE] -= 1  # the line feed itself
    blank = kind == SPACE
    head = ~blank & np.concatenate([[True], blank[:-1]])
    words = np.add.reduceat(head, start, dtype=np.int64)
    chars = np.maximum(length, 1)
    share = count / chars[:, None]

    own = np.zeros((n, OWN))
    own[:, :7] = share
    own[:, 7] = np.log1p(length) / 6
    own[:, 8] = np.minimum((length - count[:, SPACE]) / np.maximum(words, 1), 40) / 10
    # Shares in line of distinct words, and of marks that stand at word ends.
    distinct = np.fromiter((len(set(x.split())) for x in lines), np.int64, n)
    own[:, 9] = 1 - distinct / np.maximum(words, 1)
    marked = (kind == MARK) & np.concatenate([blank[1:], [True]])
    own[:, 10] = np.minimum(np.add.reduceat(marked, start, dtype=np.int64) / np.maximum(words, 1), 1)
    # Whether the same line stands elsewhere in the document.
    owner = np.repeat(np.arange(len(texts)), per_text)
    hashed = np.fromiter(map(hash, lines), np.int64, n)
    _, group, size = np.unique(np.stack([owner, hashed], 1), axis=0, return_inverse=True, return_counts=True)
    own[:, 11] = (size[group.ravel()] > 1) & (words > 0)
    own[:, 12] = length == 0

    last = first + per_text - 1
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[last] = 0, 0
    ends = np.zeros((n, 3))
    ends[first, 0], ends[last, 1], ends[:, 2] = 1, 1, 1
    return np.concatenate([own, before, after, ends], 1), chars, first


@dataclass(frozen=True)
class Chain:
    """Weights of the state good per feature and of state pairs (before, after), and the
    line from the logit of a document's mean to that of its score."""

    weights: np.ndarray
    transitions: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return _passes(x @ self.weights, self.transitions, first)[0]


def _columns(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts by falling number of lines, and that number."""
    length = np.diff(np.append(first, n))
    order = np.argsort(-length, kind="stable")
    return order, length[order]


def _passes(emission: np.ndarray, transitions: np.ndarray, first: np.ndarray, weight: np.ndarray | None = None):
    """Marginal of good for each line; with a ``weight`` per text also the expected transitions.

    All texts take a step together; those that have ended drop out.
    """
    n = len(emission)
    order, length = _columns(first, n)
    heads = first[order]
    move = np.exp(transitions - transitions.max())
    local = np.stack([np.exp(-np.maximum(emission, 0)), np.exp(np.minimum(emission, 0))], 1)
    forward, backward = np.empty((n, 2)), np.ones((n, 2))
    most = length[0] if len(length) else 0
    still = np.searchsorted(-length, -np.arange(most))
    for t in range(most):
        at = heads[: still[t]] + t
        step = local[at] if t == 0 else (forward[at - 1] @ move) * local[at]
        forward[at] = step / step.sum(1, keepdims=True)
    expected = np.zeros((2, 2))
    for t in range(most - 1, 0, -1):
        at = heads[: still[t]] + t
        ahead = local[at] * backward[at]
        step = ahead @ move.T
        backward[at - 1] = step / step.sum(1, keepdims=True)
        if weight is not None:
            both = forward[at - 1][:, :, None] * move * ahead[:, None, :]
            both *= (weight[order[: still[t]]] / both.sum((1, 2)))[:, None, None]
            expected += both.sum(0)
    state = forward * backward
    return state[:, 1] / state.sum(1), expected


def train(x: np.ndarray, chars: np.ndarray, first: np.ndarray, good: np.ndarray) -> Chain:
    """Fit to lines ``x`` of texts that start at ``first`` and carry a label ``good`` each.

    Adam steps up the conditional log-likelihood, in which every line has its text's label;
    each text weighs one. Then a line through the texts' scores, on the
    logistic scale, is fitted to the same labels.
    """
    n, texts = len(x), len(first)
    length = np.diff(np.append(first, n))
    label = np.repeat(good.astype(float), length)
    per_text = 1.0 / length
    weight = np.repeat(per_text, length)
    seen = np.zeros((2, 2))
    seen[0, 0], seen[1, 1] = np.bincount(good.astype(int), (length - 1) * per_text, minlength=2)
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, STEPS + 1):
        p, expected = _passes(x @ theta[:-4], theta[-4:].reshape(2, 2), first, per_text)
        up = np.concatenate([x.T @ (weight * (label - p)), (seen - expected).ravel()]) / texts - RIDGE * theta
        m, v = 0.9 * m + 0.1 * up, 0.999 * v + 0.001 * up * up
        theta = theta + RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    chain = Chain(theta[:-4], theta[-4:].reshape(2, 2))
    z = _logit(document_means(chain, x, chars, first))
    slope, offset = 1.0, 0.0
    for _ in range(50):  # Newton steps with a small ridge towards the scores as they are
        p = 1 / (1 + np.exp(-np.clip(slope * z + offset, -35, 35)))
        q = p * (1 - p)
        grad = np.array([((p - good) * z).sum() + slope - 1, (p - good).sum() + offset])
        hess = np.array([[(q * z * z).sum() + 1, (q * z).sum()], [(q * z).sum(), q.sum() + 1]])
        slope, offset = np.array([slope, offset]) - np.linalg.solve(hess, grad)
    return Chain(chain.weights, chain.transitions, max(float(slope), 1e-3), float(offset))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def document_means(chain: Chain, x: np.ndarray, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' marginals."""
    p = chain.marginals(x, first)
    return np.add.reduceat(p * chars, first) / np.add.reduceat(chars, first)


def document_scores(chain: Chain, x: np.ndarray, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of a good document, from the mean of its lines."""
    z = chain.slope * _logit(document_means(chain, x, chars, first)) + chain.offset
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain | None:
    """A chain from ``documents`` (doc_id, text) and ``labels`` (doc_id, quality).

    Fitted on the ``sample`` labelled ids that come first by hash, less texts of
    more than ``SAMPLE_LINES`` lines. Only their line features reach the driver. Of
    repeated labels the smaller counts; null ids, labels and texts teach
    nothing. None if nothing is left to learn from.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality"))
        .where("id is not null and quality is not null")
        .groupBy("id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    rows = rows.where(F.length("text") - F.length(F.translate("text", "\n", "")) < SAMPLE_LINES)

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, chars, first = line_features(batch.column("text").to_pylist())
        parts = np.split(np.concatenate([x, chars[:, None]], 1).astype(np.float32), first[1:])
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "quality": batch.column("quality"),
                "x": pa.array([p.tobytes() for p in parts], pa.binary()),
            }
        )

    found = mapped(rows.select("doc_id", "quality", "text"), features, "doc_id long, quality int, x binary")
    got = sorted(((r.doc_id, r.quality, bytes(r.x)) for r in found.dropDuplicates(["doc_id"]).collect()))
    if not got:
        return None
    parts = [np.frombuffer(x, np.float32).reshape(-1, FEATURES + 1).astype(float) for _, _, x in got]
    first = np.cumsum([0] + [len(p) for p in parts[:-1]])
    lines = np.concatenate(parts)
    return train(lines[:, :-1], lines[:, -1], first, np.array([q > 0 for _, q, _ in got]))


def score(documents: DataFrame, chain: Chain | None, keep: str | StructType) -> DataFrame:
    """Columns ``keep`` (a schema), score and predicted for every row of ``documents``.

    Only ``text`` decides. Null and empty texts are one empty line. Without a
    model every score is 0.5. predicted is 1 from a score of ``PREDICT_FROM``.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(TEXT).to_pylist()]
        if chain is None:
            value = np.full(len(texts), 0.5)
        else:
            value = np.clip(document_scores(chain, *line_features(texts)), 0, 1)
        return added(batch, score=pa.array(value), predicted=pa.array((value >= PREDICT_FROM).astype(np.int32)))

    return mapped(with_text(documents, keep), one, wider(keep, "score double, predicted int"))
