"""Exact top k of every query over a whole table, without making the pairs.

A join of queries with rows would emit one row per matching pair, and a common
word matches nearly every chunk. Instead each task scores a block of rows
against a block of queries as one array, and keeps the k best per query while
it reads on. Only the key and the scored column of a row go to Python. What
leaves a task is at most k keys per query; those are limited within salted
groups and then per query, so that no task ever takes what all tasks have found
for one query. Label, source and text are joined to the final rows.

Two ways to bring the sides together, chosen by the measured size of the
queries:

* ``scan``  - the queries fit the bound below: they are broadcast, the rows are
  read where they lie and never shuffled.
* ``grid``  - they do not: rows and queries are hashed into blocks of bounded
  size and every pair of blocks is one co-grouped task. Nothing goes through
  the driver.

Both are exact and use the same scorer.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialise

# Bounds of the broadcast: number of queries, and numbers or characters in them.
MAX_QUERIES = 4096
MAX_QUERY_CELLS = 4_000_000
# One block of the grid: rows, and how many times the bounds above its queries
# may reach. Larger query blocks mean fewer copies of the rows.
BLOCK_ROWS = 50_000
BLOCK_FACTOR = 4
# Cells of the score array held at a time by one task, and of these queries where scores are sifted.
SCORE_CELLS = 250_000
SIFT_QUERIES = 1024
# Found cells that are put in order together, and not before.
PENDING = 50_000
# Tasks for each pair of blocks, at most: so many that pairs hardly ever share one, however the keys fall.
SPREAD, MOST_TASKS = 4, 2000
# Scores are compared to this many significant digits, so that the order of a
# sum of floats never decides between equal texts. Nothing is cut off: small
# scores keep as many digits as large ones.
SCORE_DIGITS = 12
SLACK = 1e-10
# Groups in which the rows of one query are limited first.
SALTS = 32
# Rows of a result that may be broadcast to fetch their text.
MAX_RESULT = 100_000

KEY = ["doc_id", "chunk_no"]
CARRY = ["chunk_id", "source", "text"]


@dataclass(frozen=True)
class Size:
    """Measured size of a query table: may it be broadcast, and if not, into
    how many blocks it has to be cut."""

    fits: bool
    blocks: int
    queries: int


def measure(queries: DataFrame, cells: Column, factor: int = 1) -> Size:
    """One small job: count the queries and their numbers or characters. Blocks may be ``factor`` times as large as elsewhere."""
    n, total = queries.agg(F.count("*"), F.coalesce(F.sum(cells), F.lit(0))).first()
    load = max(n / MAX_QUERIES, int(total) / MAX_QUERY_CELLS)
    return Size(fits=load <= 1, blocks=max(1, ceil(load / BLOCK_FACTOR / factor)), queries=n)


def significant(x: np.ndarray, digits: int = SCORE_DIGITS) -> np.ndarray:
    """Rounded to so many significant digits; zero and non-finite values stay."""
    fine = np.isfinite(x) & (x != 0)
    power = np.floor(np.log10(np.abs(x), where=fine, out=np.zeros(x.shape)))
    # In two factors, as neither 10^300 nor 10^-300 times a score may overflow.
    step = digits - 1 - power
    half = np.trunc(step / 2)
    a, b = 10.0**half, 10.0 ** (step - half)
    return np.where(fine, np.rint(x * a * b) / a / b, x)


def significant_column(score: Column, digits: int = SCORE_DIGITS) -> Column:
    """``significant`` for a column of finite scores."""
    return F.format_string(f"%.{digits - 1}e", score).cast("double")


def part_of(parts: int) -> Column:
    """Folder of a key among ``parts``, for rows that are fetched by key later."""
    return F.pmod(F.xxhash64(*KEY), F.lit(parts)).cast("int")


def only_parts(rows: DataFrame, found: DataFrame, parts: int) -> DataFrame:
    """``rows``, stored in folders ``part=<n>``, restricted to the folders of the keys of ``found``.

    At most ``parts`` numbers reach the driver; the filter prunes the scan's folders before any file is opened.
    """
    numbers = [r["part"] for r in found.select(part_of(parts).alias("part")).distinct().collect()]
    return rows.filter(F.col("part").isin(numbers)) if numbers else rows.filter(F.lit(False))


@dataclass(frozen=True)
class Scorer:
    """``prepare`` turns the query rows into arrays once per task (its result
    must have ``query_ids``); ``score`` gives the (rows x queries) array from
    the column ``reads``, the only one sent to it besides the key. Where that
    array is only near the scores, it comes with an array of bounds of the error, and
    ``refine`` gives the scores of single cells. ``sift`` gives the rows and queries of the cells that may reach the
    queries' bars or be among the k best, looking at so many queries at a time, or None if it cannot tell."""

    reads: str
    prepare: Callable[[pa.Table], Any]
    score: Callable[[Any, pa.RecordBatch], np.ndarray]
    positive_only: bool
    refine: Callable[[Any, pa.RecordBatch, np.ndarray, np.ndarray], np.ndarray] | None = None
    sift: Callable[[Any, pa.RecordBatch, np.ndarray, int, int], tuple[np.ndarray, np.ndarray] | None] | None = None


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    scorer: Scorer,
    k: int,
    size: Size,
    parts: int | None = None,
) -> DataFrame:
    """RANKED rows: (query_id, rank, doc_id, chunk_no, chunk_id, source, text, score).

    ``rows`` has KEY, CARRY and the column the scorer reads. ``queries`` has
    ``query_id`` and what the scorer reads; a query may have several rows.
    Ties go to the earlier row in corpus order. Rows that are stored in ``parts`` folders by
    their key are fetched from the folders of the results only.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    id_type = queries.schema["query_id"].dataType
    sent = rows.select(*KEY, scorer.reads)
    schema = T.StructType(
        [T.StructField("query_id", id_type)]
        + [sent.schema[c] for c in KEY]
        + [T.StructField("score", T.DoubleType())]
    )
    partial = (
        _scan(sent, queries, scorer, k, schema)
        if size.fits
        else _grid(sent, queries, scorer, k, schema, size.blocks)
    )
    found = limit(partial, k)
    if parts:
        found = materialise(found, "found")
        rows = only_parts(rows, found, parts)
    side = F.broadcast(found) if size.queries * k <= MAX_RESULT else found
    return rows.select(*KEY, *CARRY).join(side, KEY).select("query_id", "rank", *KEY, *CARRY, "score")


def limit(found: DataFrame, k: int) -> DataFrame:
    """The k best of (query_id, KEY, score) per query: within salted groups, then of what those leave."""
    salted = found.withColumn("_salt", F.pmod(F.xxhash64(*KEY), F.lit(SALTS)))
    return _limit(_limit(salted, k, "query_id", "_salt").drop("rank", "_salt"), k, "query_id")


def _limit(found: DataFrame, k: int, *groups: str) -> DataFrame:
    w = Window.partitionBy(*groups).orderBy(F.col("score").desc(), *KEY)
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _scan(rows, queries, scorer, k, schema) -> DataFrame:
    # The caller has measured the queries against the bounds above.
    side = rows.sparkSession.sparkContext.broadcast(queries.toArrow())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(scorer, side.value, k)
        for batch in batches:
            best.offer(batch)
        yield from best.result(schema.fieldNames())

    return rows.mapInArrow(task, schema)


def _grid(rows, queries, scorer, k, schema, query_blocks) -> DataFrame:
    row_blocks = max(1, -(-rows.select(*KEY).count() // BLOCK_ROWS))

    def all_blocks(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def block_of(n: int, *cols: str):
        return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")

    left = rows.withColumn("_r", block_of(row_blocks, *KEY)).withColumn(
        "_q", all_blocks(query_blocks)
    )
    right = queries.withColumn("_q", block_of(query_blocks, "query_id")).withColumn(
        "_r", all_blocks(row_blocks)
    )

    tasks = min(SPREAD * row_blocks * query_blocks, MOST_TASKS)
    left, right = (side.repartition(tasks, "_r", "_q") for side in (left, right))
    return cogrouped(left, right, ["_r", "_q"], scorer, k, schema)


def _compare_all(best: "_Best", rows: pa.Table, queries: pa.Table) -> None:
    for batch in rows.to_batches():
        best.offer(batch)


def cogrouped(
    left: DataFrame,
    right: DataFrame,
    groups: list[str],
    scorer: Scorer,
    k: int,
    schema: T.StructType,
    compare: Callable[["_Best", pa.Table, pa.Table], None] = _compare_all,
) -> DataFrame:
    """The k best rows of ``left`` for each query of ``right`` within each group of both; each group is one task's block.

    ``compare`` offers the rows of a block; by default all rows to all its queries."""

    def task(left_block: pa.Table, right_block: pa.Table) -> pa.Table:
        if left_block.num_rows and right_block.num_rows:
            best = _Best(scorer, right_block, k)
            compare(best, left_block, right_block)
            found = list(best.result(schema.fieldNames()))
            if found:
                return pa.Table.from_batches(found)
        out_schema = [
            (right_block if c == "query_id" else left_block).schema.field(c)
            for c in schema.fieldNames()[:-1]
        ] + [pa.field("score", pa.float64())]
        return pa.schema(out_schema).empty_table()

    # Sides made of one table share attributes, which Catalyst renames on the right, but not in what the task is given; it
    # would then leave those columns out.
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    return left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInArrow(task, schema)


def _last(keys: np.ndarray) -> float | int:
    """What no key of this kind comes after."""
    return np.iinfo(keys.dtype).max if keys.dtype.kind in "iu" else np.inf


class _Best:
    """The k best rows per query among those offered so far; keys and scores only."""

    def __init__(self, scorer: Scorer, query_rows: pa.Table, k: int):
        self.scorer, self.k = scorer, k
        self.side = scorer.prepare(query_rows)
        self.n = len(self.side.query_ids)
        self.bar, self.started = np.full(self.n, -np.inf), False
        self.q = np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.keys: list[np.ndarray] | None = None
        self.worst: list[np.ndarray] | None = None
        self.types: list[pa.DataType] = []
        self.pending: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def start(self, bar: np.ndarray) -> None:
        """Only rows that reach ``bar`` are wanted; k rows that do are known elsewhere, or it is not finite."""
        self.bar, self.started = bar.copy(), True

    def offer(self, batch: pa.RecordBatch, only: np.ndarray | None = None) -> None:
        """Compare the rows with all queries, or with those numbered in ``only``; this takes a ``side`` with ``take``."""
        side, n = (self.side, self.n) if only is None else (self.side.take(only), len(only))
        wide = min(n, SIFT_QUERIES) if self.scorer.sift else n
        step = max(1, SCORE_CELLS // max(1, wide))
        for at in range(0, batch.num_rows if n else 0, step):
            self._offer_block(batch.slice(at, step), side, only)

    def _cells(self, batch: pa.RecordBatch, side: Any, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, query and score of every cell that may be among the best."""
        scorer = self.scorer
        sifted = scorer.sift(side, batch, bar, self.k, SIFT_QUERIES) if scorer.sift else None
        if sifted is not None:
            r, q = sifted
            scores = significant(scorer.refine(side, batch, r, q))
            keep = scores >= bar[q]
            return r[keep], q[keep], scores[keep]
        if scorer.sift and len(bar) > SIFT_QUERIES:  # not more cells at a time than elsewhere
            step = max(1, SCORE_CELLS // len(bar))
            parts = ((at, self._near_cells(batch.slice(at, step), side, bar)) for at in range(0, batch.num_rows, step))
            each = [(r + at, q, scores) for at, (r, q, scores) in parts]
            return tuple(np.concatenate(c) for c in zip(*each, strict=True))
        return self._near_cells(batch, side, bar)

    def _near_cells(self, batch: pa.RecordBatch, side: Any, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        scorer = self.scorer
        near = scorer.score(side, batch)
        if scorer.refine is None:
            bar = self._bar_with(near, held)
            slack = np.where(np.isfinite(bar), np.abs(bar) * SLACK, 0)  # what the last digits may move it by
            r, q = np.nonzero(near >= bar - slack)
            scores = near[r, q]
        else:
            near, error = near
            r, q = np.nonzero(near + error >= self._bar_with(near - error, held))
            scores = scorer.refine(side, batch, r, q)
        scores = significant(scores)
        keep = scores >= held[q]
        if scorer.positive_only:
            keep &= scores > 0
        return r[keep], q[keep], scores[keep]

    def _bar_with(self, least: np.ndarray, bar: np.ndarray) -> np.ndarray:
        """The bar, raised by what k rows of this block reach at least."""
        n = len(least)
        if n <= self.k:
            return bar
        return np.maximum(bar, np.partition(least, n - self.k, axis=0)[n - self.k])

    def _offer_block(self, batch: pa.RecordBatch, side: Any, only: np.ndarray | None) -> None:
        if not batch.num_rows:
            return
        r, q, scores = self._cells(batch, side, self.bar if only is None else self.bar[only])
        q = q if only is None else only[q]
        own = [batch.column(c).to_numpy(zero_copy_only=False) for c in KEY]
        if self.keys is None:
            self.types = [batch.column(c).type for c in KEY]
            self.keys = [c[:0] for c in own]
            self.worst = [np.full(self.n, _last(c), c.dtype) if self.started else np.resize(c[:1], self.n) for c in own]
        # What equals the worst kept score has to come before that row in corpus order.
        doc, no = (c[r] for c in own)
        later = (scores == self.bar[q]) & (
            (doc > self.worst[0][q]) | ((doc == self.worst[0][q]) & (no > self.worst[1][q]))
        )
        r, q, scores = r[~later], q[~later], scores[~later]
        if not len(r):
            return
        self.pending.append((q, scores, *(c[r] for c in own)))
        self.waiting += len(r)
        if not self.scorer.sift or self.waiting >= max(PENDING, len(self.q)):
            self._settle()

    def _settle(self) -> None:
        """The found cells put in order with those held, and the bars raised."""
        if not self.pending:
            return
        q, s, doc, no = (
            np.concatenate(c) for c in zip((self.q, self.score, *self.keys), *self.pending, strict=True)
        )
        self.pending, self.waiting = [], 0
        order = np.lexsort((no, doc, -s, q))
        starts = np.searchsorted(q[order], q[order], side="left")
        place = np.arange(len(order)) - starts
        order, place = order[place < self.k], place[place < self.k]
        self.q, self.score, self.keys = q[order], s[order], [doc[order], no[order]]
        # A query with k rows only needs what reaches its worst one.
        kth = place == self.k - 1
        at = self.q[kth]
        self.bar[at] = self.score[kth]
        for worst, held in zip(self.worst, self.keys, strict=True):
            worst[at] = held[kth]

    def result(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        self._settle()
        if self.keys is None or not len(self.q):
            return
        ids = self.side.query_ids.take(pa.array(self.q))
        keys = [pa.array(c, t) for c, t in zip(self.keys, self.types, strict=True)]
        yield from pa.Table.from_arrays([ids, *keys, pa.array(self.score)], names=names).to_batches()
