"""Near-duplicate vectors by PCA-ordered tiled comparison, within one label.

Method: unit vectors are turned into the order of their principal components.
Linked vectors are close in each component, so only vectors of the same or
neighbouring cells of the first two are compared. Cells are cut into tiles of
limited size, and every pair of tiles is one task. In it the products of the leading dimensions
come first; what the rest can add is bounded by the norms of the remaining
parts, and a pair whose bound is below the threshold goes no further.

A task returns one row per linked vector: how many links it has there, and the
smallest vector of its connected part. So a group of n copies costs n rows a
tile, not n squared links, and no link is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, mapped
from tidemark.llm.graph import components

THRESHOLD = 0.93
TILE = 4096
STRIP = 512
#: Leading dimensions after which a pair's bound is looked at.
STAGES = (8, 24)
#: Rounding of products of turned vectors; closer cases are decided on the given vectors.
NEAR = 1e-9
#: Vectors the principal components are taken from; any turn gives the same links.
SAMPLE = 4096
LARGEST_TURN = 1024


def _valid(batch: pa.RecordBatch) -> pa.RecordBatch:
    kept_rows, packed, dims = [], [], []
    for v in batch.column("v").to_pylist():
        x = None if any(c is None for c in v) else np.array(v, np.float64)
        norm = 0.0 if x is None or not np.isfinite(x).all() else float(np.linalg.norm(x / max(np.abs(x).max(initial=0), 1e-300)))
        kept_rows.append(norm > 0)
        packed.append(x.tobytes() if norm > 0 else b"")
        dims.append(len(v))
    out = pa.record_batch(
        {
            "rid": batch.column("rid"),
            "label": batch.column("label"),
            "dim": pa.array(dims, pa.int32()),
            "v": pa.array(packed, pa.binary()),
        }
    )
    return out.filter(pa.array(kept_rows, pa.bool_()))


def _matrix(column) -> np.ndarray:
    return np.array([np.frombuffer(x, np.float64) for x in column.to_pylist()])


def _units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that very small or large rows neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def turns(sample: list[tuple[int, bytes]]) -> dict[int, np.ndarray]:
    """For each vector length of the sample, an orthogonal matrix to its principal components."""
    by_dim: dict[int, list[np.ndarray]] = {}
    for dim, v in sample:
        by_dim.setdefault(dim, []).append(np.frombuffer(v, np.float64))
    out = {}
    for dim, rows in by_dim.items():
        if dim <= LARGEST_TURN:
            x = _units(np.array(rows))
            _, axes = np.linalg.eigh(np.cov(x.T).reshape(dim, dim) if len(x) > 1 else np.eye(dim))
            out[dim] = axes[:, ::-1].copy()
    return out


def _cells(turn: dict[int, np.ndarray], width: float):
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        dims = np.asarray(batch.column("dim"))
        vectors = batch.column("v")
        cell = np.zeros((len(dims), 2), np.int64)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            y = _units(_matrix(vectors.take(pa.array(at))))
            y = y @ turn[int(dim)][:, :2] if int(dim) in turn else y[:, :2]
            cell[at, : y.shape[1]] = np.floor(y / width)
        return pa.record_batch(
            {c: batch.column(c) for c in ("rid", "label", "dim", "v")} | {"c1": cell[:, 0], "c2": cell[:, 1]}
        )

    return one


def _linked(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) of turned unit vectors that may reach the threshold, and their products."""
    ends = [e for e in STAGES if e < a.shape[1]] + [a.shape[1]]
    rest = lambda x, e: np.linalg.norm(x[:, e:], axis=1)
    e = ends[0]
    product = a[:, :e] @ b[:, :e].T
    i, j = np.nonzero(product + rest(a, e)[:, None] * rest(b, e) >= threshold - NEAR)
    if len(i) * 8 > product.size:  # most go on: the rest as one product
        product += a[:, e:] @ b[:, e:].T
        i, j = np.nonzero(product >= threshold - NEAR)
        return i, j, product[i, j]
    value = product[i, j]
    for s, e in zip(ends, ends[1:], strict=False):
        value = value + np.einsum("ij,ij->i", a[i, s:e], b[j, s:e])
        go = value + rest(a, e)[i] * rest(b, e)[j] >= threshold - NEAR
        i, j, value = i[go], j[go], value[go]
    return i, j, value


def cosine(x: np.ndarray, y: np.ndarray) -> float:
    """In double precision, with sums rounded once."""
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest number of each connected part, after the links (a, b) are added."""
    while len(a):
        x, y = root[a], root[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, up := root[root]):
            root = up
    return root


def _tile_pair(turn: dict[int, np.ndarray], threshold: float):
    def pair(key, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("rid", "links", "root")})
        same = key[0].as_py() == key[1].as_py()
        if not left.num_rows or not (same or right.num_rows):
            return empty
        x = _matrix(left.column("v"))
        y = x if same else _matrix(right.column("v"))
        rid = np.asarray(left.column("rid"))
        names = rid if same else np.concatenate([rid, np.asarray(right.column("rid"))])
        shift = 0 if same else len(rid)
        rotate = turn.get(x.shape[1])
        a = _units(x) if rotate is None else _units(x) @ rotate
        b = a if same else (_units(y) if rotate is None else _units(y) @ rotate)
        order = np.argsort(names)
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        root, links = np.arange(len(names)), np.zeros(len(names), np.int64)
        for start in range(0, len(a), STRIP):
            i, j, value = _linked(a[start : start + STRIP], b, threshold)
            i = i + start
            if same:
                i, j, value = (c[i < j] for c in (i, j, value))
            close = np.flatnonzero(np.abs(value - threshold) <= NEAR)
            sure = np.ones(len(i), bool)
            sure[close] = [cosine(x[i[k]], y[j[k]]) >= threshold for k in close]
            i, j = i[sure], j[sure] + shift
            links += np.bincount(i, minlength=len(names)) + np.bincount(j, minlength=len(names))
            root = _join(root, place[i], place[j])
        found = np.flatnonzero(links)
        return pa.table({"rid": names[found], "links": links[found], "root": names[order][root[place[found]]]})

    return pair


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Two rows are linked if their labels are equal and not null, their vectors are of
    equal length, and the cosine is at least ``threshold`` (above 0). Null and zero
    vectors, vectors with a null or non-finite component, and rows without vec_id
    link with nothing: component_id is their own id. Repeated rows are rows of
    their own. Other columns are not read; an empty table gives no rows.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    rows = kept(rows, "vectors")
    usable = rows.where("vec_id is not null and label is not null and size(v) > 0").select("rid", "label", "v")
    ready = kept(mapped(usable, _valid, "rid long, label string, dim int, v binary"), "unit-vectors")
    sample = ready.orderBy(F.xxhash64("rid")).limit(SAMPLE).select("dim", "v").collect()
    turn = turns([(r.dim, bytes(r.v)) for r in sample])

    width = math.sqrt(2 - 2 * threshold) + NEAR
    placed = mapped(ready, _cells(turn, width), "rid long, label string, dim int, v binary, c1 long, c2 long")
    cell = ["label", "dim", "c1", "c2"]
    placed = kept(placed, "cells")
    cells = placed.groupBy(*cell).agg(F.count("*").alias("n")).withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    cells = kept(cells, "cell-sizes")
    # Every cell with itself and with the four neighbours that come after it.
    steps = F.array(*[F.struct(F.lit(x).alias("d1"), F.lit(y).alias("d2")) for x, y in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    near = cells.withColumn("step", F.explode(steps)).select(
        "label", "dim", "tiles", "c1", "c2",
        (F.col("c1") + F.col("step.d1")).alias("o1"), (F.col("c2") + F.col("step.d2")).alias("o2"),
    )
    other = cells.select("label", "dim", F.col("c1").alias("o1"), F.col("c2").alias("o2"), F.col("tiles").alias("o_tiles"))
    near = near.join(other, ["label", "dim", "o1", "o2"])
    same = (F.col("c1") == F.col("o1")) & (F.col("c2") == F.col("o2"))
    near = near.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    near = near.withColumn("u", F.explode(F.sequence(F.when(same, F.col("t")).otherwise(0), F.col("o_tiles") - 1)))
    name = lambda *c: F.concat_ws("|", *c, "dim", "label")
    pairs = kept(
        near.select(name("c1", "c2", "t").alias("left_tile"), name("o1", "o2", "u").alias("right_tile")), "tile-pairs"
    )
    tiles = placed.join(cells.select(*cell, "tiles"), cell).withColumn("t", F.pmod(F.xxhash64("rid"), F.col("tiles")))
    tiles = tiles.select(name("c1", "c2", "t").alias("tile"), "rid", "v")
    side = ["left_tile", "right_tile"]
    left = tiles.join(pairs, F.col("tile") == F.col("left_tile")).select(*side, "rid", "v").groupBy(*side)
    others = pairs.where("left_tile <> right_tile")  # a tile with itself needs its rows once
    right = tiles.join(others, F.col("tile") == F.col("right_tile")).select(*side, "rid", "v")
    right = right.toDF("of", "with", "rid", "v").groupBy("of", "with")
    found = left.cogroup(right).applyInArrow(_tile_pair(turn, threshold), "rid long, links long, root long")
    found = kept(found, "tile-links")

    counts = found.groupBy("rid").agg(F.sum("links").alias("n_links"))
    comps = components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    named = rows.select("rid", "vec_id").join(comps, F.col("rid") == F.col("nid")).select("rid", "vec_id", "comp")
    label = named.groupBy("comp").agg(F.min("vec_id").alias("component_id"))
    named = named.join(label, "comp").select("rid", "component_id")
    return (
        rows.select("rid", "vec_id")
        .join(counts, "rid", "left")
        .join(named, "rid", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
