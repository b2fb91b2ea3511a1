"""Vectors stored as bytes with a bound of the error; exact nearest vectors from them.

``vectors``  one row a distinct vector: digest, smallest key, ``codes`` (a byte a component), ``scale``, ``err``, ``embedding``
``members``  (digest, KEY, CARRY): the rows that have it

Both lie in folders ``part=<n>`` by the digest. ``scale * codes`` is near the vector, and ``err`` is the length of the difference. So a
product with a query q is known to within ``err * |q|``, a distance to within ``err``. A search reads the codes of all vectors, a quarter of
the floats' bytes, and keeps per query what may still be among the best: whatever reaches the k-th largest of all lower bounds.
Only those vectors are read in full, from their folders, and scored exactly. The results are those of ``dense.dense_search``.

Copies of one vector are compared once; a result takes its members in order of their keys.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import dense, topk
from tidemark.session import exists, materialise

# Folders, and rows that one task writes to a folder.
PARTS = 64
PART_ROWS = 200_000
LEVELS = 127
EPS = np.finfo(float).eps
# Room for rounding of the error's length and of the last digits of a score.
SLACK = 1e-10
# Candidates a task holds before it drops those that the bar has passed.
HELD = 200_000

CODED = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        T.StructField("codes", T.BinaryType()),
        T.StructField("scale", T.DoubleType()),
        T.StructField("err", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Index:
    """A stored index: two tables, their number of folders, and the metric."""

    vectors: DataFrame
    members: DataFrame
    parts: int
    metric: str


def _usable(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(wrong, F.lit(False))


def encoded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scale and error of each row of ``x``."""
    scale = np.abs(x).max(axis=1, initial=0) / LEVELS
    codes = np.rint(x / np.where(scale > 0, scale, 1)[:, None]).clip(-LEVELS, LEVELS).astype(np.int8)
    err = np.sqrt(((x - scale[:, None] * codes) ** 2).sum(axis=1))
    length = np.sqrt((x**2).sum(axis=1))
    return codes, scale, err * (1 + SLACK) + length * 8 * EPS


def _binary(cells: np.ndarray) -> pa.Array:
    n, width = cells.shape
    ends = np.arange(0, n * width + 1, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(cells))])


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        x = dense._matrix(batch.column("embedding"))
        codes, scale, err = encoded(x)
        digests = pa.array([hashlib.sha256(row.tobytes()).digest() for row in x], pa.binary())
        names = [*batch.schema.names, *CODED.fieldNames()]
        yield pa.RecordBatch.from_arrays([*batch.columns, digests, _binary(codes), pa.array(scale), pa.array(err)], names=names)


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int")


def _deal(rows: DataFrame, path: str, key: list[str]) -> None:
    """Write ``rows`` into their folders, a large folder by several tasks."""
    sizes = rows.groupBy("part").agg(F.ceil(F.count("*") / PART_ROWS).alias("_salts"))  # a row a folder
    salted = rows.join(F.broadcast(sizes), "part").withColumn("_salt", F.pmod(F.xxhash64(*key), "_salts"))
    salted.repartition("part", "_salt").drop("_salts", "_salt").write.partitionBy("part").parquet(path)


def build(vectors: DataFrame, path: str, metric: str = "l2sq", parts: int = PARTS) -> None:
    """Write an index of ``vectors`` (KEY, CARRY, embedding) under ``path``.

    Vectors that are null or hold null or non-finite components are left out; vectors of different lengths are an error.
    """
    if metric not in dense.METRICS:
        raise ValueError(f"metric must be one of {dense.METRICS}, not {metric!r}")
    spark = vectors.sparkSession
    there = vectors.select(*topk.KEY, *topk.CARRY, "embedding").filter(_usable(F.col("embedding")))
    schema = T.StructType(there.schema.fields + CODED.fields)
    coded = materialise(there.mapInArrow(_encode, schema).withColumn("part", _part(parts)), "coded")
    length = F.octet_length("codes")
    least, most = coded.agg(F.min(length), F.max(length)).first()
    if least != most:
        raise dense.BadVectorError(f"lengths {least} to {most}")
    kept = ["codes", "scale", "err", "embedding"]
    distinct = coded.groupBy("part", "digest").agg(
        F.min(F.struct(*topk.KEY)).alias("first"), *[F.any_value(c).alias(c) for c in kept]
    )
    distinct = materialise(distinct.select("part", "digest", *[f"first.{c}" for c in topk.KEY], *kept), "distinct")
    _deal(distinct, f"{path}/vectors", ["digest"])
    _deal(coded.select("part", "digest", *topk.KEY, *topk.CARRY), f"{path}/members", topk.KEY)
    spark.createDataFrame([(metric, parts)], "metric string, parts int").write.parquet(f"{path}/meta")


def load(spark: SparkSession, path: str) -> Index:
    meta = spark.read.parquet(f"{path}/meta").first()
    keys = "doc_id long, chunk_no int"
    shapes = {
        "vectors": f"digest binary, {keys}, codes binary, scale double, err double, embedding array<float>, part int",
        "members": f"digest binary, {keys}, chunk_id string, source string, text string, part int",
    }

    def table(name: str) -> DataFrame:
        there = exists(spark, f"{path}/{name}/_SUCCESS")
        return spark.read.schema(shapes[name]).parquet(f"{path}/{name}") if there else spark.createDataFrame([], shapes[name])

    return Index(table("vectors"), table("members"), meta["parts"], meta["metric"])


def bounds(side, batch: pa.RecordBatch, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible score of every row for every query."""
    scale, err = (batch.column(c).to_numpy()[:, None] for c in ("scale", "err"))
    codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.int8).reshape(batch.num_rows, -1)
    q = side.matrix
    if codes.shape[1] != q.shape[1]:
        raise ValueError(f"vectors of different lengths: {codes.shape[1]} and {q.shape[1]}")
    x = codes * scale
    x2, q2 = (x**2).sum(axis=1)[:, None], (q**2).sum(axis=1)[None, :]
    return _limits(x @ q.T, x2, q2, err, codes.shape[1], metric)


def _limits(near, x2, q2, err, width: int, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of cells with the product ``near`` of decoded rows and queries."""
    rounding = (x2 + q2) * 4 * EPS * (width + 4) + np.finfo(float).tiny
    if metric == "dot":
        room = err * np.sqrt(q2) * (1 + SLACK) + rounding
        low, high = near - room, near + room
    else:
        square = x2 + q2 - 2 * near
        least = np.sqrt(np.maximum(square - rounding, 0)) - err
        low, high = -((np.sqrt(np.maximum(square, 0) + rounding) + err) ** 2), -(np.maximum(least, 0) ** 2)
    return low - np.abs(low) * SLACK, high + np.abs(high) * SLACK


class _Band:
    """What may be among the k best of each query: every row whose largest possible score reaches the k-th least possible one.

    Cells are first sifted as ``dense`` sifts them, by a product in 32 bits that is no less than the score of the decoded row,
    and a bar lowered by what decoding may miss; bounds are worked out for what is left."""

    def __init__(self, query_rows: pa.Table, k: int, metric: str):
        self.side, self.k, self.metric = dense._QueryVectors(query_rows), k, metric
        self.n = len(self.side.query_ids)
        self.square = (self.side.matrix**2).sum(axis=1)
        self.lows = np.full((self.n, k), -np.inf)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.count, self.limit, self.waiting = 0, HELD, 0

    def offer(self, batch: pa.RecordBatch) -> None:
        step = max(1, topk.SCORE_CELLS // max(1, min(self.n, topk.SIFT_QUERIES)))
        for at in range(0, batch.num_rows if self.n else 0, step):
            block = batch.slice(at, step)
            r, q, low, high = self._cells(block)
            keep = high >= self.lows[q, 0]
            r, q, low, high = r[keep], q[keep], low[keep], high[keep]
            keys = [block.column(c).to_numpy(zero_copy_only=False)[r] for c in ("digest", *topk.KEY)]
            self.held.append((q, low, high, *keys))
            self.found.append((q, low))
            self.count, self.waiting = self.count + len(r), self.waiting + len(r)
            if self.waiting > topk.PENDING or not np.isfinite(self.lows[:, 0]).all():
                self._raise()
            if self.count > self.limit:
                self._drop()
                self.limit = max(HELD, 2 * self.count)

    def _cells(self, block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, query and bounds of the cells that may reach the bars."""
        scale, err = (block.column(c).to_numpy() for c in ("scale", "err"))
        codes = np.frombuffer(b"".join(block.column("codes").to_pylist()), np.int8).reshape(block.num_rows, -1)
        if codes.shape[1] != self.side.matrix.shape[1]:
            raise ValueError(f"vectors of different lengths: {codes.shape[1]} and {self.side.matrix.shape[1]}")
        x = codes * scale[:, None]
        x2, bar = (x**2).sum(axis=1), self.lows[:, 0]
        sifted = self._sifted(x, x2, err, bar) if np.isfinite(bar).all() else None
        if sifted is None:
            step = max(1, topk.SCORE_CELLS // self.n)
            each = [self._whole(block.slice(at, step), at) for at in range(0, block.num_rows, step)]
            return tuple(np.concatenate(c) for c in zip(*each, strict=True))
        none = np.zeros(0)
        parts = [(none.astype(int), none.astype(int), none, none)]
        for at in range(0, len(sifted[0]), dense.CELLS):
            r, q = (c[at : at + dense.CELLS] for c in sifted)
            near = (x[r] * self.side.matrix[q]).sum(axis=1)
            low, high = _limits(near, x2[r], self.square[q], err[r], codes.shape[1], self.metric)
            parts.append((r, q, low, high))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def _whole(self, block: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All cells of some rows; those that k of the rows themselves rule out are left out."""
        low, high = bounds(self.side, block, self.metric)
        n = len(low)
        reach = np.partition(low, n - self.k, axis=0)[n - self.k] if n >= self.k else np.full(self.n, -np.inf)
        r, q = np.nonzero(high >= np.maximum(reach, self.lows[:, 0]))
        return r + at, q, low[r, q], high[r, q]

    def _sifted(self, x: np.ndarray, x2: np.ndarray, err: np.ndarray, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Rows and queries whose largest score may reach ``bar``, or None if 32 bits do not hold them.

        A distance d of the decoded row matters up to reach + err, so d^2 up to reach^2 + 2 reach err + err^2; a product up to err |q| below
        the bar. ``err`` is that of the row and goes with one more column of the query."""
        largest = max(self.side.largest, float(np.abs(x).max(initial=0)))
        worst = max(float(np.abs(bar).max(initial=0)), float(err.max(initial=0)) ** 2)
        power = -int(np.frexp(max(largest, np.sqrt(worst)))[1])
        if not 1e-60 < largest < 1e60 or not np.isfinite(worst):
            return None
        unit = 2.0**power
        length = np.sqrt(self.square) if self.metric == "dot" else 2 * np.sqrt(np.maximum(-bar, 0))
        rows, _ = dense._raised(x, power, self.metric, False)
        queries, _ = dense._raised(self.side.matrix, power, self.metric, True)
        # Room for the cells' rounding once more, and for the two columns and the bar.
        own = (err * unit * (1 + 1e-6)).astype(np.float32)
        extra = 0 if self.metric == "dot" else (err * unit) ** 2
        slack = 1e-5 + 8 * dense.HALF * (x.shape[1] + 16)
        room = slack * ((x2 * unit**2) + (err * unit) ** 2) + extra + 1e-30
        rows = np.concatenate([rows, own[:, None], room[:, None].astype(np.float32)], axis=1)
        length = (length * unit * (1 + 1e-6)).astype(np.float32)
        queries = np.concatenate([queries, length[:, None], np.ones((self.n, 1), np.float32)], axis=1)
        under = bar * unit**2
        under = (under - slack * (np.abs(under) + self.square * unit**2) - 1e-30).astype(np.float32)
        first, second = [], []
        for at in range(0, self.n, topk.SIFT_QUERIES):
            cell = np.flatnonzero(rows @ queries[at : at + topk.SIFT_QUERIES].T >= under[at : at + topk.SIFT_QUERIES])
            wide = min(topk.SIFT_QUERIES, self.n - at)
            first.append(cell // wide)
            second.append(cell % wide + at)
        return np.concatenate(first), np.concatenate(second)

    def _raise(self) -> None:
        """The bars from what was found since they were last raised."""
        q, low = (np.concatenate(c) for c in zip(*self.found, strict=True))
        self.found, self.waiting = [], 0
        some = np.unique(q)
        q = np.concatenate([np.repeat(some, self.k), q])
        low = np.concatenate([self.lows[some].ravel(), low])
        order = np.lexsort((-low, q))
        place = np.arange(len(order)) - np.searchsorted(q[order], q[order], side="left")
        best = order[place < self.k]
        self.lows[some] = low[best].reshape(-1, self.k)[:, ::-1]

    def _drop(self) -> None:
        if self.found:
            self._raise()
        columns = [np.concatenate(c) for c in zip(*self.held, strict=True)]
        still = columns[2] >= self.lows[columns[0], 0]
        self.held = [tuple(c[still] for c in columns)]
        self.count = int(still.sum())

    def result(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        self._drop()
        q, low, high, digest, doc, no = self.held[0]
        ids = self.side.query_ids.take(pa.array(q))
        columns = [ids, pa.array(digest, pa.binary()), pa.array(doc, pa.int64()), pa.array(no, pa.int32()), pa.array(low), pa.array(high)]
        yield from pa.Table.from_arrays(columns, names=["query_id", "digest", *topk.KEY, "low", "high"]).to_batches()


def _banded(rows: DataFrame, asked: DataFrame, k: int, metric: str, size: topk.Size) -> DataFrame:
    id_type = asked.schema["query_id"].dataType
    schema = T.StructType(
        [T.StructField("query_id", id_type), rows.schema["digest"], *[rows.schema[c] for c in topk.KEY]]
        + [T.StructField(c, T.DoubleType()) for c in ("low", "high")]
    )
    if size.fits:
        side = rows.sparkSession.sparkContext.broadcast(asked.toArrow())  # measured by the caller

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            band = _Band(side.value, k, metric)
            for batch in batches:
                band.offer(batch)
            yield from band.result()

        return rows.mapInArrow(task, schema)

    blocks = max(1, ceil(rows.count() / topk.BLOCK_ROWS))
    left = rows.withColumn("_r", F.pmod(F.xxhash64("digest"), F.lit(blocks))).withColumn(
        "_q", F.explode(F.sequence(F.lit(0), F.lit(size.blocks - 1)))
    )
    right = asked.withColumn("_q", F.pmod(F.xxhash64("query_id"), F.lit(size.blocks)).cast("int")).withColumn(
        "_r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )

    tasks = min(topk.SPREAD * blocks * size.blocks, topk.MOST_TASKS)
    left, right = (side.repartition(tasks, "_r", "_q") for side in (left, right))

    def block(left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
        band = _Band(right_rows, k, metric)
        for batch in left_rows.to_batches():
            band.offer(batch)
        found = list(band.result())
        if found:
            return pa.Table.from_batches(found)
        types = [right_rows.schema.field("query_id").type, pa.binary(), pa.int64(), pa.int32(), pa.float64(), pa.float64()]
        return pa.schema(list(zip(schema.fieldNames(), types, strict=True))).empty_table()

    return left.groupBy("_r", "_q").cogroup(right.groupBy("_r", "_q")).applyInArrow(block, schema)


def candidates(queries: DataFrame, index: Index, k: int = 5) -> DataFrame:
    """(query_id, digest, KEY) of the distinct vectors that a search has to score exactly, written once."""
    if k < 1:
        raise ValueError("k must be at least 1")
    asked = queries.select("query_id", "embedding").filter(_usable(F.col("embedding")))
    size = topk.measure(asked, F.size("embedding"))
    rows = index.vectors.select("digest", *topk.KEY, "codes", "scale", "err")
    band = materialise(_banded(rows, asked, k, index.metric, size), "band")
    lows = topk.limit(band.select("query_id", *topk.KEY, F.col("low").alias("score")), k)
    bar = lows.filter(F.col("rank") == k).select("query_id", F.col("score").alias("bar"))
    left = band.join(bar, "query_id", "left").filter(F.col("bar").isNull() | (F.col("high") >= F.col("bar")))
    return materialise(left.select("query_id", "digest", *topk.KEY), "candidates")


def _in_parts(rows: DataFrame, found: DataFrame, parts: int) -> DataFrame:
    """``rows`` of the folders that the digests of ``found`` fall into; at most ``parts`` numbers reach the driver."""
    numbers = [r["part"] for r in found.select(_part(parts).alias("part")).distinct().collect()]
    return rows.filter(F.col("part").isin(numbers)) if numbers else rows.limit(0)


def _scored(pairs: DataFrame, metric: str) -> DataFrame:
    """``score`` in place of ``embedding`` and ``asked``, summed as the scan sums it, to the last digit."""
    names = ["query_id", "digest", *topk.KEY]
    schema = T.StructType([pairs.schema[c] for c in names] + [T.StructField("score", T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (dense._matrix(batch.column(c)) for c in ("embedding", "asked"))
                score = (x * y).sum(axis=1) if metric == "dot" else -((x - y) ** 2).sum(axis=1)
                columns = [*(batch.column(c) for c in names), pa.array(topk.significant(score))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return pairs.select(*names, "embedding", "asked").mapInArrow(task, schema)


def search(queries: DataFrame, index: Index, k: int = 5) -> DataFrame:
    """RANKED exact nearest vectors of ``queries`` (query_id, embedding), as ``dense.dense_search`` gives them.

    Null or non-finite queries, and an empty side, give no rows.
    """
    left = candidates(queries, index, k)
    vectors = _in_parts(index.vectors.select("part", "digest", "embedding"), left, index.parts)
    asked = queries.select("query_id", F.col("embedding").alias("asked")).filter(_usable(F.col("asked")))
    scored = _scored(left.join(vectors, "digest").join(asked, "query_id"), index.metric)
    # The k best rows belong to the k best distinct vectors, each placed by its smallest key.
    best = materialise(topk.limit(scored, k).select("query_id", "digest", "score"), "best-vectors")
    wanted = best.select("digest").distinct()
    members = _in_parts(index.members, best, index.parts).join(wanted, "digest", "left_semi")
    # Of a vector with many members no query takes more than k.
    first = topk.limit(members.select(F.col("digest").alias("query_id"), *topk.KEY, *topk.CARRY, F.lit(0.0).alias("score")), k)
    first = first.select(F.col("query_id").alias("digest"), *topk.KEY, *topk.CARRY)
    found = topk.limit(best.select("query_id", "digest", "score").join(first, "digest"), k)
    out = found.select("query_id", "rank", *topk.KEY, *topk.CARRY, "score")
    return out if index.metric == "dot" else dense.as_distance(out)

