"""Periodic runs of words in whole texts: detection by seeds on diagonals, and texts without the repeats.

A run is a stretch of words that repeats with its smallest period ``q`` for at least ``max(6, 4 * q)`` words, as
long as the period holds.

Method: at a lag ``q`` a run agrees with itself over no fewer than ``max(6 - q, 3 * q)`` words. So for the lags up to a
power of two ``K``, every run holds two equal ``K``-grams at its lag (``K`` starts at 4: five words agree for lag 1). All ``K``-grams of a
document are indexed, by doubling: a ``2 K``-gram is a pair of ``K``-grams, numbered exactly, without hashes. A ``K``-gram
that is no shorter than the period comes again after exactly one period (were it sooner, the run would have a
smaller period), so each occurrence has only to be paired with the next one of its document: pairs grow with the
text, however often a word is repeated. Each pair of a lag in ``(K / 2, K]`` is a seed; it is extended along its diagonal both ways, and a
table of the furthest word covered at each lag leaves out seeds that an extension has been over.

The ``K``-grams that occur once are left out of the next level, which ends the search early in ordinary text. The
texts of a piece of a batch are worked on together; a document counts as an alphabet of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidemark.llm.common import TEXT, added, mapped, wider, with_text

LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Shortest grams that are indexed: what a run of lag 1 to 4 agrees on at least.
SEED = 4
#: Bytes of text that are worked on at a time; a longer text stays whole.
PIECE = 4 << 20
#: Words compared at a time when a seed is extended; doubled at each step.
REACH = 64
RUNS = "runs array<struct<start:bigint,length:bigint,period:bigint>>, n_words bigint, collapsed binary"


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts with at most ``PIECE`` bytes, or one text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(size, PIECE + (size[start - 1] if start else 0), "right")))
        yield texts.slice(start, stop - start)
        start = stop


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _reach(codes: np.ndarray, a: int, b: int, most: int, step: int) -> int:
    """How many words agree from positions ``a`` and ``b`` on, at most ``most``, going by ``step`` (1 or -1)."""
    done, width = 0, REACH
    while done < most:
        n = min(width, most - done)
        x, y = (codes[p + done : p + done + n] if step > 0 else codes[p - done - n + 1 : p - done + 1][::-1] for p in (a, b))
        differ = np.flatnonzero(x != y)
        if len(differ):
            return done + int(differ[0])
        done, width = done + n, width * 2
    return most


def _paired(gram: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of equal grams (position by position), and for each occurrence the distance to the next one, or 0."""
    order = np.argsort(gram, kind="stable")
    ordered, place = gram[order], at[order]
    same = ordered[1:] == ordered[:-1]
    number, after = np.empty(len(gram), np.int64), np.zeros(len(gram), np.int64)
    number[order] = np.concatenate([[0], np.cumsum(~same)])
    after[order[:-1][same]] = (place[1:] - place[:-1])[same]
    return number, after


def find_runs(codes: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First position, length and period of all runs of the documents that make up ``codes`` (one after the other,
    ``length`` words each); sorted by position, then period."""
    stop = np.repeat(np.cumsum(length), length)
    owner = np.repeat(np.arange(len(length)), length)
    longest = int(length.max(initial=0))
    found: list[tuple[int, int, int]] = []
    # Grams of one word: of the same word in the same document.
    at, k = np.arange(len(codes)), 1
    gram = owner * (int(codes.max(initial=0)) + 1) + codes if len(codes) else codes
    while len(at) and (k <= SEED or (k // 2 + 1) * LEAST_PERIODS <= longest):
        number, after = _paired(gram, at)
        if k >= SEED:
            found += _extended(codes, owner, length, at, after, k)
        # Of the grams of 2 k words, those may come twice whose halves do.
        often = np.bincount(number)[number] > 1
        slot = np.full(len(codes) + 1, -1)
        slot[at[often]] = number[often]
        first = at[often]
        first = first[(first + 2 * k <= stop[first])]
        second = slot[np.minimum(first + k, len(codes))]
        first, second = first[second >= 0], second[second >= 0]
        gram, at, k = slot[first] * (int(number.max(initial=0)) + 1) + second, first, 2 * k
    out = np.array(sorted(found), np.int64).reshape(-1, 3)
    out = out[np.lexsort((out[:, 2], out[:, 0]))]
    return out[:, 0], out[:, 1], out[:, 2]


def _extended(codes, owner, length, at, after, k) -> list[tuple[int, int, int]]:
    """Runs through seeds of ``k`` words whose lag belongs to this level."""
    low = 0 if k == SEED else k // 2
    seed = np.flatnonzero((after > low) & (after <= k))
    lag, place = after[seed], at[seed]
    order = np.lexsort((place, lag))
    lag, place = lag[order], place[order]
    # A seed next to one before it lies on what that one covers.
    head = np.ones(len(lag), bool)
    head[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
    ends = np.cumsum(length)
    covered: dict[int, int] = {}
    out = []
    for q, i in zip(lag[head].tolist(), place[head].tolist(), strict=True):
        if i < covered.get(q, -1):
            continue
        end = int(ends[owner[i]])
        start = end - int(length[owner[i]])
        right = i + k + _reach(codes, i + k, i + k + q, end - i - k - q, 1)
        left = i - _reach(codes, i - 1, i + q - 1, i - start, -1)
        covered[q] = right
        size = right + q - left
        if size >= max(LEAST_WORDS, LEAST_PERIODS * q):
            out.append((left, size, q))
    return out


def _of_texts(texts: pa.Array) -> tuple[list, list, list]:
    """Runs, numbers of words and collapsed texts."""
    numbers = _Numbers()
    words = [t.split() if t else [] for t in texts.to_pylist()]
    length = np.array([len(w) for w in words], np.int64)
    codes = np.fromiter((numbers[w] for text in words for w in text), np.int64, int(length.sum()))
    start, size, period = find_runs(codes, length)
    first = np.cumsum(length) - length
    which = np.searchsorted(np.cumsum(length), start, "right")
    # A word after a run's first period goes; steps up and down at the ends of those parts.
    step = np.zeros(len(codes) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + size, -1)
    gone = np.cumsum(step)[:-1] > 0
    runs: list[list[dict]] = [[] for _ in words]
    rows = zip(which.tolist(), (start - first[which]).tolist(), size.tolist(), period.tolist(), strict=True)
    for n, a, b, c in rows:
        runs[n].append({"start": a, "length": b, "period": c})
    collapsed = []
    for n, text in enumerate(words):
        if runs[n]:
            keep = ~gone[first[n] : first[n] + len(text)]
            text = [w for w, k in zip(text, keep.tolist(), strict=True) if k]
        collapsed.append(b" ".join(text))
    return runs, length.tolist(), collapsed


def _detect(batch: pa.RecordBatch) -> pa.RecordBatch:
    runs, n_words, collapsed = [], [], []
    for piece in pieces(batch.column(TEXT)):
        for out, new in zip((runs, n_words, collapsed), _of_texts(piece), strict=True):
            out += new
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    return added(
        batch,
        runs=pa.array(runs, pa.list_(run)),
        n_words=pa.array(n_words, pa.int64()),
        collapsed=pa.array(collapsed, pa.binary()),
    )


def detect(texts: DataFrame, keep: str | StructType, column: str = "text") -> DataFrame:
    """Columns ``keep`` (a schema) of ``texts`` with ``runs`` (by start, then period; in word numbers from 0),
    ``n_words``, and ``collapsed``: the words outside the repeats, joined by one space, as UTF-8.

    Words are runs of anything but ASCII white space. A word is left out of ``collapsed`` if any run holds it after
    the run's first period. Null and empty texts have no words, no runs and an empty ``collapsed``; every
    row, repeated ones included, is answered on its own, and an empty table gives no rows. Only the columns named in
    ``keep`` and ``column`` are read, so others may have any name; a kept column must not be called like a new one.
    Work and memory of a task grow with its longest text, times the logarithm of the longest period.
    """
    return mapped(with_text(texts, keep, column, "binary"), _detect, wider(keep, RUNS))
