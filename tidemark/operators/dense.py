"""Vectors: encode text, keep a vector table, exact nearest neighbours."""

from collections.abc import Callable, Iterator
from copy import copy
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as X
from tidemark.operators import topk
from tidemark.schemas import VECTOR
from tidemark.sources.tables import read_table, replace_table

METRICS = ("l2sq", "dot")
# Cells whose scores a task works out at a time.
CELLS = 100_000
# Query blocks of vectors, beside those of texts.
FACTOR = 4
# A half of the last place of 32 bits, and the smallest number there.
HALF, LEAST = 2.0**-24, 2.0**-149


class BadVectorError(Exception):
    """A vector table would hold a null vector, or vectors of several lengths."""


class RepeatedIdError(Exception):
    """A vector table would hold an id more than once."""


def buckets(tokens: Column, dim: int) -> Column:
    """Bucket number of every token: its md5, first 8 hex digits, modulo ``dim``."""
    return F.transform(
        tokens,
        lambda t: (
            F.conv(F.substring(F.md5(F.encode(t, "UTF-8")), 1, 8), 16, 10).cast("bigint") % dim
        ).cast("int"),
    )


def hash_tokens(
    rows: DataFrame, dim: int, text: str = "text", mode: str = "word", tokens: str | None = None
) -> DataFrame:
    """Add ``buckets`` unless the rows have them already; of the token column
    ``tokens`` where there is one, else of the tokens of ``text``."""
    if "buckets" in rows.columns:
        return rows
    found = F.col(tokens) if tokens else X.tokens(F.col(text), mode)
    return rows.withColumn("buckets", buckets(found, dim))


def bucket_idf(rows: DataFrame, dim: int, text: str = "text", mode: str = "word") -> list[float]:
    """Smoothed idf of each of the ``dim`` buckets: ln((1 + N) / (1 + df)) + 1.

    ``dim`` + 1 rows reach the driver, whatever the size of the corpus.
    """
    every = F.lit(-1)
    seen = hash_tokens(rows, dim, text, mode).select(
        F.explode(F.array_append(F.array_distinct("buckets"), every)).alias("b")
    )
    df = dict(seen.groupBy("b").count().collect())
    n = df.pop(-1, 0)
    return [float(np.log((1 + n) / (1 + df.get(b, 0))) + 1) for b in range(dim)]


def vectorise(
    rows: DataFrame,
    dim: int = 256,
    idf: list[float] | None = None,
    text: str = "text",
    mode: str = "word",
    encoder: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
) -> DataFrame:
    """``embedding`` in place of any token columns: a unit vector of hashed
    term counts, weighted by ``idf`` where given; zero for text without tokens.

    A vector depends on its own row only, so this is a map without a shuffle.
    ``encoder`` replaces the hashing: a ``mapInArrow`` function that appends a
    ``list<float>`` column to the columns of ``rows``.
    """
    names = [c for c in rows.columns if c not in ("tokens", "dl", "buckets")]
    schema = T.StructType(
        [rows.schema[c] for c in names] + [T.StructField("embedding", T.ArrayType(T.FloatType()))]
    )
    if encoder is not None:
        return rows.select(*names).mapInArrow(encoder, schema)
    if idf is not None and len(idf) != dim:
        raise ValueError(f"idf has {len(idf)} entries for {dim} buckets")
    weights = np.ones(dim) if idf is None else np.array(idf)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            n = batch.num_rows
            row = np.repeat(np.arange(n), lists.value_lengths().fill_null(0).to_numpy())
            cell = row * dim + lists.flatten().to_numpy()
            counts = np.bincount(cell, minlength=n * dim).reshape(n, dim) * weights
            norm = np.sqrt((counts**2).sum(axis=1, keepdims=True))
            unit = (counts / np.where(norm == 0, 1, norm)).astype(np.float32)
            ends = pa.array(np.arange(0, n * dim + 1, dim, dtype=np.int32))
            vectors = pa.ListArray.from_arrays(ends, pa.array(unit.ravel()))
            columns = [batch.column(c) for c in names] + [vectors]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "embedding"])

    hashed = hash_tokens(rows, dim, text, mode).select(*names, "buckets")
    return hashed.mapInArrow(task, schema)


def normalise(vector: Column) -> Column:
    """Unit length, in double; a zero vector stays zero."""
    wide = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(wide, lambda x: x / norm)).otherwise(wide)


def vector_table(chunks: DataFrame) -> DataFrame:
    """Chunks with ``embedding`` as VECTOR records (id, document, embedding, metadata).

    The id is unique over the whole table; the printed label is in the metadata.
    """
    return chunks.select(
        _vector_id().alias("id"),
        F.col("text").alias("document"),
        "embedding",
        F.struct("source", "chunk_id", *topk.KEY).alias("metadata"),
    )


def stored_vectors(table: DataFrame) -> DataFrame:
    """VECTOR records as rows to search."""
    return table.select(
        *[f"metadata.{c}" for c in (*topk.KEY, "chunk_id", "source")],
        F.col("document").alias("text"),
        "embedding",
    )


def rebuild_vectors(
    chunks: DataFrame, path: str, dim: int = 256, idf: list[float] | None = None, encoder=None
) -> int:
    """Encode the chunks and replace the vector table; its row count.

    The ids are checked first, from the chunks alone, so that nothing has been
    encoded or written when one of them is repeated. A vector that is null, or of another
    length than the rest, is refused before the table is replaced.
    """
    repeated = repeated_ids(chunks.select(_vector_id().alias("id")))
    found = repeated.limit(3).collect()
    if found:
        raise RepeatedIdError(", ".join(r["id"] for r in found))
    spark = chunks.sparkSession
    made = vector_table(vectorise(chunks, dim, idf, encoder=encoder))
    replace_table(made, path, VECTOR, check=_fit_vectors)
    return read_table(spark, path, VECTOR).count()


def _fit_vectors(written: DataFrame) -> None:
    length = F.size("embedding")
    bad = written.agg(F.count_if(F.col("embedding").isNull()), F.min(length), F.max(length)).first()
    if bad[0] or bad[1] != bad[2]:
        raise BadVectorError(f"{bad[0]} null vectors, lengths {bad[1]} to {bad[2]}")


def _vector_id() -> Column:
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.col("chunk_id"))


def repeated_ids(vectors: DataFrame, key: str = "id") -> DataFrame:
    """Ids that occur more than once; a vector table must have none."""
    return vectors.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def dense_search(
    queries: DataFrame, vectors: DataFrame, k: int = 5, metric: str = "l2sq"
) -> DataFrame:
    """RANKED exact nearest vectors; ``queries`` is (query_id, embedding).

    ``l2sq`` adds ``distance``, smallest first; ``dot`` adds ``score``, largest
    first. No vectors, or no queries, give an empty result; a null vector on
    either side takes no part. Vectors of different lengths are an error.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    asked = queries.select("query_id", "embedding").filter(F.col("embedding").isNotNull())
    size = topk.measure(asked, F.size("embedding"), FACTOR)
    there = vectors.filter(F.col("embedding").isNotNull())
    found = topk.top_k(there, asked, scorer(metric), k, size)
    return found if metric == "dot" else as_distance(found)


def scorer(metric: str) -> topk.Scorer:
    """Scores of vectors, larger ones first: the product, or the negative squared distance."""
    return topk.Scorer(
        reads="embedding",
        prepare=_QueryVectors,
        score=partial(_score, metric=metric),
        positive_only=False,
        refine=partial(_refine, metric=metric),
        sift=partial(_sift, metric=metric),
    )


def as_distance(found: DataFrame) -> DataFrame:
    """``distance`` in place of a negative score."""
    distance = F.when(F.col("score") == 0, 0.0).otherwise(-F.col("score"))
    return found.withColumn("distance", distance).drop("score")


class _QueryVectors:
    """Query vectors as one matrix."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        self.query_ids = rows["query_id"].combine_chunks()
        self.matrix = _matrix(rows["embedding"].combine_chunks())
        self.largest = float(np.abs(self.matrix).max(initial=0))
        self.raised: tuple | None = None

    def take(self, only: np.ndarray) -> "_QueryVectors":
        """The queries numbered in ``only``."""
        if len(only) == len(self.matrix):
            return self
        part = copy(self)
        part.query_ids, part.matrix = self.query_ids.take(pa.array(only)), self.matrix[only]
        if self.raised is not None:
            part.raised = (self.raised[0], *(a[only] for a in self.raised[1:]))
        return part


def _matrix(lists: pa.ListArray) -> np.ndarray:
    lengths = np.unique(lists.value_lengths().to_numpy(zero_copy_only=False))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths.tolist()}")
    width = int(lengths[0]) if len(lengths) else 0
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), width)


def _score(side: _QueryVectors, batch: pa.RecordBatch, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """All scores as one matrix product, and how far rounding may have moved each."""
    rows = _matrix(batch.column("embedding"))
    dot = rows @ side.matrix.T
    square = (rows**2).sum(axis=1)[:, None] + (side.matrix**2).sum(axis=1)[None, :]
    error = square * (4 * np.finfo(float).eps * (rows.shape[1] + 4)) + np.finfo(float).tiny
    return (dot if metric == "dot" else 2 * dot - square), error


def _sift(
    side: _QueryVectors, batch: pa.RecordBatch, bar: np.ndarray, k: int, wide: int, metric: str
) -> tuple[np.ndarray, np.ndarray] | None:
    """Cells that may reach the bar of their query, from products in 32 bits that are no less than the scores.

    Both sides are first brought near 1 by a power of two. What rounding may take away is added by two more columns, so a
    matrix product and a comparison are all that a cell costs. Queries without a bar get one from the k-th of these rows.
    """
    rows = _matrix(batch.column("embedding"))
    largest = max(side.largest, float(np.abs(rows).max(initial=0)))
    if not np.isfinite(largest) or (len(rows) and len(side.matrix) and rows.shape[1] != side.matrix.shape[1]):
        return None
    power = -int(np.frexp(largest)[1])
    if side.raised is None or side.raised[0] != power:
        side.raised = (power, *_raised(side.matrix, power, metric, True))
    _, queries, room = side.raised
    raised, own_room = _raised(rows, power, metric, False)
    with np.errstate(over="ignore"):
        low = np.ldexp(bar, 2 * power)
        low = np.nextafter(np.where(np.isfinite(low), low, np.where(low > 0, np.finfo(np.float32).max, -np.inf)).astype(np.float32), np.float32(-np.inf))
    first, second = [], []
    for at in range(0, len(queries), wide):
        high = raised @ queries[at : at + wide].T
        reach = low[at : at + wide]
        if len(rows) >= k and not np.isfinite(reach).all():
            kth = np.partition(high, len(rows) - k, axis=0)[len(rows) - k]
            under = kth - 3 * (own_room.max() + room[at : at + wide]).astype(np.float32)
            reach = np.maximum(reach, under)
        cell = np.flatnonzero(high >= reach)
        first.append(cell // high.shape[1])
        second.append(cell % high.shape[1] + at)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *first]), np.concatenate([none, *second])


def _raised(x: np.ndarray, power: int, metric: str, query: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows in 32 bits whose products are at least the scores, times four to the ``power``, and the room that each side has added."""
    x = np.ldexp(x, power)
    square, width = (x**2).sum(axis=1), x.shape[1]
    room = (4 * HALF * (width + 8)) * square + 8 * (width + 8) * LEAST
    own = room if metric == "dot" else room - square
    one = np.ones(len(x))
    left, right = (one, own) if query else (own, one)
    factor = 2 if metric != "dot" and not query else 1
    return np.concatenate([factor * x, left[:, None], right[:, None]], axis=1).astype(np.float32), room


def _refine(
    side: _QueryVectors, batch: pa.RecordBatch, r: np.ndarray, q: np.ndarray, metric: str
) -> np.ndarray:
    """Scores of single cells, summed in the same order for equal vectors."""
    rows = _matrix(batch.column("embedding"))
    out = np.empty(len(r))
    for at in range(0, len(r), CELLS):
        x, y = rows[r[at : at + CELLS]], side.matrix[q[at : at + CELLS]]
        out[at : at + CELLS] = (x * y).sum(axis=1) if metric == "dot" else -((x - y) ** 2).sum(axis=1)
    return out


def approximate_search(
    queries: DataFrame, vectors: DataFrame, k: int = 5, reach: float = 1.0, tables: int = 8, seed: int = 1
) -> DataFrame:
    """RANKED near vectors by random projections, for callers who may miss some.

    The library's bucketed join finds the pairs within ``reach`` (Euclidean);
    farther vectors are never returned, nearer ones may be missed. More ``tables``
    miss fewer and cost more. Adds ``distance``, squared as in ``dense_search``.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    def as_vectors(df: DataFrame, *columns: str) -> DataFrame:
        there = df.filter(F.col("embedding").isNotNull())
        return there.select(*columns, array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))

    rows, asked = as_vectors(vectors, *topk.KEY), as_vectors(queries, "query_id")
    lsh = BucketedRandomProjectionLSH(
        inputCol="v", outputCol="h", bucketLength=2 * reach, numHashTables=tables, seed=seed
    )
    pairs = lsh.fit(rows).approxSimilarityJoin(asked, rows, reach, "d")
    near = pairs.select(
        "datasetA.query_id", *[f"datasetB.{c}" for c in topk.KEY], (-F.col("d") * F.col("d")).alias("score")
    )
    found = topk.limit(near, k)
    carried = vectors.select(*topk.KEY, *topk.CARRY).join(found, topk.KEY)
    distance = F.when(F.col("score") == 0, 0.0).otherwise(-F.col("score"))
    return carried.withColumn("distance", distance).select("query_id", "rank", *topk.KEY, *topk.CARRY, "distance")
