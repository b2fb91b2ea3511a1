"""Exact nearest vectors from a stored index of pivots, leaving out what the triangle inequality rules out.

Vectors are kept with their nearest of some pivots, in rings by their distance to it:

``vectors``  the rows with ``dist``, ``ring`` and ``salt``, in folders ``pivot=<n>``
``cells``    (pivot, ring, n, least, most): rows of a ring and the range of their distances
``pivots``   (pivot, centre)
``meta``     one row: metric and, for dot products, the largest length

A vector at distance r of a pivot is no nearer to a query at distance d of it than ``|d - r|``. So a search first compares each query with the
nearest cells that hold k vectors, which gives a distance that the k-th result does not exceed, and then with those cells alone
whose least possible distance is within it. The results are those of ``dense.dense_search``.

Dot products become distances by one more dimension: with ``sqrt(M^2 - |x|^2)`` added to each vector and 0 to each query, the largest product is
the smallest distance.

Pivots are taken from a bounded sample; whatever they are, the results are the same, only more or less is compared. A cell with many rows, such as copies of
one vector, is dealt into salts of bounded size.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import dense, topk
from tidemark.session import materialise

# Most pivots, the sample they are taken from, rings of each, and rows of a salt.
PIVOTS = 64
SAMPLE = 4096
RINGS = 4
CELL_ROWS = 20_000
# Rows of the cells that a task compares, and queries that it compares them with.
BLOCK_ROWS = 50_000
QUERY_ROWS = 16_384
# What rounding may move a distance by, as a part of the lengths involved.
SLACK = 1e-9


@dataclass(frozen=True)
class Index:
    """A stored index; ``cells`` and ``centres`` are arrays of bounded size, the vectors a table."""

    vectors: DataFrame
    cells: np.ndarray  # pivot, ring, n
    ranges: np.ndarray  # least, most
    centres: np.ndarray
    metric: str
    longest: float


def _raised(x: np.ndarray, metric: str, longest: float, query: bool) -> np.ndarray:
    """Rows in the space where smaller distances are better results."""
    if metric != "dot":
        return x
    rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * x @ centres.T
    return np.sqrt(np.maximum(square, 0))


def _far_apart(x: np.ndarray, most: int) -> np.ndarray:
    """Rows of ``x``, each the farthest from those before it."""
    chosen, left = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < most and left.max() > 0:
        chosen.append(int(left.argmax()))
        left = np.minimum(left, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def build(
    vectors: DataFrame, path: str, metric: str = "l2sq", pivots: int = PIVOTS, sample: int = SAMPLE, rings: int = RINGS
) -> None:
    """Write an index of ``vectors`` (KEY, CARRY, embedding) under ``path``. Null vectors are left out; vectors of
    different lengths are an error.

    ``sample`` vectors, the first by hash, reach the driver, of which at most ``pivots``, and no more than the root of
    the sample, become pivots."""
    if metric not in dense.METRICS:
        raise ValueError(f"metric must be one of {dense.METRICS}, not {metric!r}")
    spark = vectors.sparkSession
    there = vectors.filter(F.col("embedding").isNotNull())
    wide = F.col("embedding").cast("array<double>")
    length = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda s, x: s + x * x))
    longest = float(there.agg(F.coalesce(F.max(length), F.lit(0.0))).first()[0]) * (1 + SLACK)
    some = there.select("embedding").orderBy(F.xxhash64(*topk.KEY)).limit(sample).toArrow().column("embedding")
    x = _raised(dense._matrix(some.combine_chunks()), metric, longest, False) if len(some) else np.zeros((0, 0))
    centres = _far_apart(x, min(pivots, max(1, ceil(sqrt(len(x)))))) if len(x) else x
    spark.createDataFrame(
        [(k, c.tolist()) for k, c in enumerate(centres)], "pivot int, centre array<double>"
    ).write.parquet(f"{path}/pivots")
    spark.createDataFrame([(metric, longest)], "metric string, longest double").write.parquet(f"{path}/meta")

    schema = T.StructType(there.schema.fields + [T.StructField("pivot", T.IntegerType()), T.StructField("dist", T.DoubleType())])
    names = there.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_raised(dense._matrix(batch.column("embedding")), metric, longest, False), centres)
                near = d.argmin(axis=1)
                columns = [pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *columns], names=[*names, "pivot", "dist"])

    dealt = materialise(there.mapInArrow(assign, schema), "pivot-rows")
    # Edges of the rings by distance, a few numbers for each pivot.
    edges = dealt.groupBy("pivot").agg(F.percentile_approx("dist", [k / rings for k in range(1, rings)]).alias("edges"))
    ringed = dealt.join(F.broadcast(edges), "pivot").withColumn(
        "ring", F.size(F.filter("edges", lambda e: e < F.col("dist")))
    )
    cells = ringed.groupBy("pivot", "ring").agg(F.count("*").alias("n"), F.min("dist").alias("least"), F.max("dist").alias("most"))
    cells.write.parquet(f"{path}/cells")
    sizes = spark.read.parquet(f"{path}/cells").select("pivot", "ring", F.ceil(F.col("n") / CELL_ROWS).alias("salts"))
    salted = ringed.join(F.broadcast(sizes), ["pivot", "ring"]).withColumn(
        "salt", F.pmod(F.xxhash64(*topk.KEY), "salts").cast("int")
    )
    salted.drop("edges", "salts").repartition("pivot", "ring", "salt").sortWithinPartitions("pivot", "ring", "salt").write.partitionBy(
        "pivot"
    ).parquet(f"{path}/vectors")


def load(spark: SparkSession, path: str) -> Index:
    """The index under ``path``; pivots and cells, whose number ``build`` bounds, are held as arrays."""
    centres = spark.read.parquet(f"{path}/pivots").orderBy("pivot").toArrow().column("centre").to_pylist()
    cells = spark.read.parquet(f"{path}/cells").orderBy("pivot", "ring").toArrow()
    meta = spark.read.parquet(f"{path}/meta").first()
    numbers = np.array([cells.column(c).to_numpy() for c in ("pivot", "ring", "n")]).T.reshape(-1, 3)
    ranges = np.array([cells.column(c).to_numpy() for c in ("least", "most")]).T.reshape(-1, 2)
    vectors = spark.read.parquet(f"{path}/vectors") if len(centres) else spark.createDataFrame([], "doc_id long")
    return Index(vectors, numbers, ranges, np.array(centres), meta["metric"], meta["longest"])


def _dealt(index: Index) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """(pivot, ring, salt, cell, block) of all parts of cells, dealt in order into blocks of BLOCK_ROWS, and the distinct (block, cell, rows)."""
    parts, cells, block, held = [], [], 0, 0
    for cell, (pivot, ring, n) in enumerate(index.cells.tolist()):
        salts = ceil(n / CELL_ROWS)
        for salt in range(salts):
            if held and held + n / salts > BLOCK_ROWS:
                block, held = block + 1, 0
            held += n / salts
            parts.append((pivot, ring, salt, cell, block))
            if not cells or cells[-1][:2] != (block, cell):
                cells.append((block, cell, 0 if salt else n))  # the rows of a cell count once
    return parts, np.array(cells, np.int64).reshape(-1, 3)


def _choose(index: Index, which: Callable[[np.ndarray, np.ndarray, pa.RecordBatch], np.ndarray]):
    """Rows (query_id, embedding, bar, block, cells, rows) of the blocks with cells that ``which`` picks from the least possible distances."""
    pivot = index.cells[:, 0]
    least, most = index.ranges.T
    centres, metric, longest = index.centres, index.metric, index.longest  # without the table
    blocks, cells, rows = _dealt(index)[1].T

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _raised(dense._matrix(batch.column("embedding")), metric, longest, True)
            d = _distances(x, centres)[:, pivot]
            room = SLACK * (d + most + 1)
            bound = np.maximum(np.maximum(d - most, least - d) - room, 0)
            q, at = np.nonzero(which(bound, d, batch)[:, cells])
            if not len(q):
                continue
            new = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (blocks[at[1:]] != blocks[at[:-1]])]))
            lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(q)).astype(np.int32)), pa.array(cells[at].astype(np.int32)))
            asked = batch.take(pa.array(q[new]))
            yield pa.RecordBatch.from_arrays(
                [
                    asked.column("query_id"),
                    asked.column("embedding"),
                    asked.column("bar"),
                    pa.array(blocks[at[new]].astype(np.int32)),
                    lists,
                    pa.array(np.add.reduceat(rows[at], new)),
                ],
                names=["query_id", "embedding", "bar", "block", "cells", "rows"],
            )

    return task


def _first(n: np.ndarray, k: int):
    """The cells that come first by least possible distance, then by distance, until they hold k rows."""

    def which(bound: np.ndarray, d: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        order = np.lexsort((d, bound), axis=1)
        before = np.cumsum(n[order], axis=1) - n[order]
        out = np.zeros(bound.shape, bool)
        np.put_along_axis(out, order, before < k, axis=1)
        return out

    return which


def _within(n: np.ndarray, k: int):
    """Those that may hold something as near as the k-th so far (column ``reach``), without the first ones."""
    first = _first(n, k)

    def which(bound: np.ndarray, d: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        reach = np.array(batch.column("reach").to_pylist(), np.float64)[:, None]
        return (bound <= np.where(np.isnan(reach), np.inf, reach)) & ~first(bound, d, batch)

    return which


def _compare_cells(best: topk._Best, rows: pa.Table, queries: pa.Table) -> None:
    """Each cell's rows with the queries that chose it, of which only what reaches a query's bar is wanted."""
    best.start(np.array(queries["bar"].fill_null(-np.inf)))
    rows = rows.sort_by([(c, "ascending") for c in ("cell", *topk.KEY)]).combine_chunks()
    lists = queries["cells"].combine_chunks()
    asker = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    wanted = lists.flatten().to_numpy()
    order = np.argsort(wanted, kind="stable")
    asker, wanted = asker[order], wanted[order]
    numbers, starts = np.unique(rows["cell"].to_numpy(), return_index=True)
    for cell, at, end in zip(numbers, starts, [*starts[1:], rows.num_rows], strict=True):
        only = asker[np.searchsorted(wanted, cell) : np.searchsorted(wanted, cell, side="right")]
        if len(only):
            for batch in rows.slice(at, end - at).to_batches():
                best.offer(batch, only)


def _compared(index: Index, asked: DataFrame, scorer: topk.Scorer, k: int, schema: T.StructType) -> DataFrame:
    """The k best rows of each block for the queries that chose cells of it, of those cells alone.

    A query goes once to each block with a cell of its choice, not to each cell; a block's queries are dealt into parts of QUERY_ROWS."""
    spark = asked.sparkSession
    asked = materialise(asked.drop("rows"), "chosen-cells")
    most = max(1, min(QUERY_ROWS, topk.BLOCK_FACTOR * topk.MAX_QUERY_CELLS // max(1, index.centres.shape[1])))
    sizes = {r["block"]: ceil(r["count"] / most) for r in asked.groupBy("block").count().collect()}  # a row a block of vectors
    if not sizes:
        return spark.createDataFrame([], schema)
    parts = [p for p in _dealt(index)[0] if p[4] in sizes]
    cells = spark.createDataFrame(
        [(*p, sizes[p[4]]) for p in parts], "pivot int, ring int, salt int, cell int, block int, parts int"
    )
    rows = index.vectors.filter(F.col("pivot").isin(sorted({p[0] for p in parts})))
    left = rows.join(F.broadcast(cells), ["pivot", "ring", "salt"]).select(
        *topk.KEY, "embedding", "cell", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    right = asked.join(F.broadcast(cells.select("block", "parts").distinct()), "block")
    right = right.withColumn("part", F.pmod(F.xxhash64("query_id"), "parts").cast("int")).drop("parts")
    tasks = min(topk.SPREAD * sum(sizes.values()), topk.MOST_TASKS)
    left, right = (side.repartition(tasks, "block", "part") for side in (left, right))
    return topk.cogrouped(left, right, ["block", "part"], scorer, k, schema, _compare_cells)


def search(queries: DataFrame, index: Index, k: int = 5) -> DataFrame:
    """RANKED exact nearest vectors of ``queries`` (query_id, embedding), as ``dense.dense_search`` gives them."""
    spark, id_type = queries.sparkSession, queries.schema["query_id"].dataType
    asked = queries.select("query_id", "embedding").filter(F.col("embedding").isNotNull())
    schema = T.StructType(
        [
            T.StructField("query_id", id_type),
            T.StructField("doc_id", T.LongType()),
            T.StructField("chunk_no", T.IntegerType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    if not len(index.centres):
        found = spark.createDataFrame([], schema)
        return _ranked(found.withColumn("rank", F.lit(1)), found.select("*", *[F.lit("").alias(c) for c in topk.CARRY]), index.metric)
    scorer = dense.scorer(index.metric)
    near, far = _chosen(asked, index, k, lambda chosen: _compared(index, chosen, scorer, k, schema))
    other = _compared(index, far, scorer, k, schema)
    found = materialise(topk.limit(near.unionByName(other), k), "nearest")
    return _ranked(found, index.vectors, index.metric)


def _ranked(found: DataFrame, rows: DataFrame, metric: str) -> DataFrame:
    out = rows.select(*topk.KEY, *topk.CARRY).join(found, topk.KEY).select("query_id", "rank", *topk.KEY, *topk.CARRY, "score")
    return out if metric == "dot" else dense.as_distance(out)


def _chosen(asked: DataFrame, index: Index, k: int, compare) -> tuple[DataFrame, DataFrame]:
    """What comparing the first cells found, and the further cells that have to be compared."""
    fields = [asked.schema["query_id"], asked.schema["embedding"]]
    chosen = T._parse_datatype_string("bar double, block int, cells array<int>, rows long").fields
    schema, n = T.StructType(fields + chosen), index.cells[:, 2]
    first = asked.withColumn("bar", F.lit(None).cast("double"))
    near = materialise(compare(first.mapInArrow(_choose(index, _first(n, k)), schema)), "near")
    best = near.groupBy("query_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(-F.col("score"))).alias("s"))
    kth = best.filter(F.col("n") >= k).select("query_id", (-F.col("s")[k - 1]).alias("kth"))
    if index.metric == "dot":
        square = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x)
        square = square + index.longest**2 - 2 * F.col("kth")
    else:
        square = -F.col("kth")
    # Room for what the rounding to significant digits may have moved.
    reach = F.sqrt(F.greatest(square, F.lit(0.0)) * (1 + SLACK)) + SLACK * (1 + index.longest)
    reached = asked.join(kth, "query_id", "left").select("query_id", "embedding", F.col("kth").alias("bar"), reach.alias("reach"))
    return near, reached.mapInArrow(_choose(index, _within(n, k)), schema)


def compared(queries: DataFrame, index: Index, k: int = 5) -> DataFrame:
    """(query_id, vectors, compared): the vectors of the index, and how many of them a query is compared with."""
    asked = queries.select("query_id", "embedding").filter(F.col("embedding").isNotNull())
    seen = []

    def compare(chosen: DataFrame) -> DataFrame:
        seen.append(materialise(chosen, "first-cells"))
        schema = "query_id: long, doc_id: long, chunk_no: int, score: double"
        return _compared(index, seen[0], dense.scorer(index.metric), k, T._parse_datatype_string(schema))

    _, far = _chosen(asked, index, k, compare)
    total = int(index.cells[:, 2].sum()) if len(index.cells) else 0
    return (
        seen[0].unionByName(far).groupBy("query_id").agg(F.sum("rows").alias("compared"))
        .select("query_id", F.lit(total).cast("long").alias("vectors"), "compared")
    )
