"""Vectors as bytes, reranking by tokens, expectations counted while writing."""

import glob

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import compact, dense, fusion, late, quality, topk
from tidemark.sources import tables

VECTORS = "doc_id long, chunk_no int, chunk_id string, source string, text string, embedding array<float>"
RESULTS = "query_id long, rank int, doc_id long, chunk_no int, chunk_id string, source string, text string"


def rows_of(x):
    return [(i // 2, i % 2, f"c{i}", f"s{i % 3}", f"t{i}", v if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(x)]


def ranked(df, value):
    return sorted(tuple(r) for r in df.select("query_id", "rank", *topk.KEY, *topk.CARRY, F.round(value, 6)).collect())


@pytest.fixture(scope="module")
def vectors(spark):
    """Spread-out vectors of several lengths, near copies, and one vector that a third of all rows have."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 24)) * rng.choice([0.01, 1, 50], size=(1200, 1))
    x[::3] = x[0]
    x[1::30] = x[1] + rng.normal(size=(40, 24)) * 1e-4
    return spark.createDataFrame(rows_of([*x.tolist(), [0.0] * 24, None, [float("nan")] * 24, [None] * 24, [float("inf")] * 24]), VECTORS)


def finite(df):
    return df.filter("embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < 1e30)")


@pytest.fixture(scope="module")
def asked(spark, vectors):
    chosen = vectors.filter("doc_id % 40 < 3 and chunk_no = 0 or doc_id = 0")
    own = finite(chosen).select((F.col("doc_id") * 2 + F.col("chunk_no")).alias("query_id"), "embedding")
    return own.unionByName(spark.createDataFrame([(9000, [0.0] * 24), (9001, None), (9002, [float("nan")] * 24)], own.schema))


@pytest.mark.parametrize("metric, value", [("dot", "score"), ("l2sq", "distance")])
@pytest.mark.parametrize("k", [1, 7])
def test_bytes_equal_the_scan(spark, vectors, asked, tmp_path, metric, value, k):
    compact.build(vectors, str(tmp_path / "i"), metric, parts=4)
    index = compact.load(spark, str(tmp_path / "i"))
    found = ranked(compact.search(asked, index, k), value)
    assert found == ranked(dense.dense_search(finite(asked), finite(vectors), k, metric), value)
    assert len(found) == k * finite(asked).count()


def test_blocks_of_queries_equal_the_scan(spark, vectors, asked, tmp_path, monkeypatch):
    compact.build(vectors, str(tmp_path / "i"), "dot", parts=4)
    index = compact.load(spark, str(tmp_path / "i"))
    one = ranked(compact.search(asked, index, 4), "score")
    monkeypatch.setattr(topk, "MAX_QUERIES", 5)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 300)
    assert not topk.measure(asked, F.lit(1)).fits
    assert ranked(compact.search(asked, index, 4), "score") == one


@pytest.mark.parametrize("metric", ["dot", "l2sq"])
@pytest.mark.parametrize("size", [1e-20, 1.0, 1e12])
def test_bounds_hold(metric, size):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 17)) * size
    x[0], x[1] = 0, size
    codes, scale, err = compact.encoded(x)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([compact._binary(codes), pa.array(scale), pa.array(err)], names=["codes", "scale", "err"])

    class Side:
        matrix = x[:50]

    low, high = compact.bounds(Side, batch, metric)
    exact = x @ x[:50].T if metric == "dot" else -(((x[:, None] - x[None, :50]) ** 2).sum(axis=2))
    assert (low <= exact).all() and (exact <= high).all()
    assert np.median(high - low) < 0.2 * np.median(np.abs(exact))


@pytest.mark.parametrize("metric", ["dot", "l2sq"])
@pytest.mark.parametrize("size", [1.0, 1e-12, 1e-70, 1e20, 1e100])
def test_cells_are_sifted_before_their_bounds(metric, size, monkeypatch):
    """Of random, repeated, tiny and large vectors the k best are in the band, and bounds are worked out for few cells."""
    monkeypatch.setattr(topk, "SCORE_CELLS", 9 * 40)
    monkeypatch.setattr(topk, "SIFT_QUERIES", 9)
    monkeypatch.setattr(topk, "PENDING", 60)
    rng = np.random.default_rng(3)
    x, y = (rng.normal(size=(n, 12)) * size for n in (2000, 31))
    x[1::50], x[2::60], x[3::70], y[5] = x[0], x[4] * 1e-9, x[4] * 9, x[0]
    codes, scale, err = compact.encoded(x)
    names = ["digest", "doc_id", "chunk_no", "codes", "scale", "err"]
    digests = pa.array([b"%d" % n for n in range(2000)], pa.binary())
    columns = [digests, pa.array(np.arange(2000)), pa.array(np.zeros(2000, np.int32)), compact._binary(codes), pa.array(scale), pa.array(err)]
    worked_out, bounds = [], compact.bounds
    monkeypatch.setattr(compact, "bounds", lambda *a: worked_out.append(bounds(*a)) or worked_out[-1])
    band = compact._Band(pa.table({"query_id": np.arange(31), "embedding": pa.array(y.tolist(), pa.list_(pa.float64()))}), 4, metric)
    band.offer(pa.RecordBatch.from_arrays(columns, names=names))
    found = {(r["query_id"], r["doc_id"]) for b in band.result() for r in b.to_pylist()}
    scores = [x @ v if metric == "dot" else -((x - v) ** 2).sum(axis=1) for v in y]
    best = {(q, int(r)) for q, each in enumerate(scores) for r in np.flatnonzero(each >= np.sort(each)[-4])}
    assert best <= found and len(found) < 2000 * 31 / 4
    if 1e-60 < size < 1e60:
        assert sum(low.size for low, _ in worked_out) < 2000 * 31 / 10


def test_fewer_bytes_and_few_rows_in_full(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    spread = spark.createDataFrame(rows_of(x.tolist()), VECTORS)
    compact.build(spread, str(tmp_path / "i"), "dot", parts=4)
    sizes = {}
    for name in glob.glob(str(tmp_path / "i" / "vectors" / "*" / "*.parquet")):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                top = column.path_in_schema.split(".")[0]
                sizes[top] = sizes.get(top, 0) + column.total_compressed_size
    assert sizes["codes"] + sizes["scale"] + sizes["err"] < 0.4 * sizes["embedding"]
    queries = spread.filter("doc_id < 20 and chunk_no = 0").select(F.col("doc_id").alias("query_id"), "embedding")
    index = compact.load(spark, str(tmp_path / "i"))
    left = compact.candidates(queries, index, 5)
    assert 100 <= left.count() < 0.05 * 20 * 4000
    band = compact._banded(index.vectors.select("digest", *topk.KEY, "codes", "scale", "err"), queries, 5, "dot", topk.Size(True, 1, 20))
    plan = band._jdf.queryExecution().executedPlan().toString()
    assert "codes:binary" in plan and "embedding" not in plan.split("FileScan", 1)[1].split("ReadSchema")[1].split("\n")[0]


def test_empty_and_unequal_vectors(spark, vectors, asked, tmp_path):
    compact.build(vectors.limit(0), str(tmp_path / "none"), parts=2)
    assert compact.search(asked, compact.load(spark, str(tmp_path / "none"))).count() == 0
    compact.build(vectors, str(tmp_path / "some"), parts=2)
    assert compact.search(asked.limit(0), compact.load(spark, str(tmp_path / "some"))).count() == 0
    uneven = spark.createDataFrame(rows_of([[1.0, 2.0], [1.0]]), VECTORS).repartition(2, "chunk_no")
    with pytest.raises(Exception, match="lengths"):
        compact.build(uneven, str(tmp_path / "uneven"))


def plain_score(query, text):
    """The same by sums over dictionaries."""
    import hashlib
    import re

    def vector(token):
        framed, out = f"^{token}$", {}
        for i in range(len(token)):
            b = int(hashlib.md5(framed[i : i + 3].encode()).hexdigest()[:8], 16) % late.DIM
            out[b] = out.get(b, 0) + 1
        return out

    def cosine(a, b):
        va, vb = vector(a), vector(b)
        dot = sum(n * vb.get(k, 0) for k, n in va.items())
        return dot / (sum(n * n for n in va.values()) * sum(n * n for n in vb.values())) ** 0.5

    wanted, there = (re.findall(r"[a-z0-9]+", (t or "").lower()) for t in (query, text))
    return sum(max((cosine(w, t) for t in there), default=0.0) for w in wanted)


QUERIES = [(1, "Returning laptops twice twice"), (2, ""), (3, None), (4, "payment")]
TEXTS = ["You can return a laptop.", "Returns of laptops, twice", "", None, "payments and refunds", "You can return a laptop."]


def test_token_scores_equal_plain_sums(spark):
    queries = spark.createDataFrame(QUERIES, "query_id long, query string")
    results = spark.createDataFrame([(q, n + 1, n, 0, f"c{n}", "s", t) for q, _ in QUERIES for n, t in enumerate(TEXTS)], RESULTS)
    found = {(r.query_id, r.doc_id): r.rerank_score for r in late.scores(queries, results).collect()}
    assert len(found) == len(QUERIES) * len(TEXTS)
    for q, query in QUERIES:
        for n, text in enumerate(TEXTS):
            assert found[q, n] == pytest.approx(plain_score(query, text), abs=1e-9), (query, text)
    order = [(r.query_id, r.doc_id) for r in late.rerank(queries, results, 3).orderBy("query_id", "rank").collect()]
    assert order[:3] == [(1, 1), (1, 0), (1, 5)]  # equal texts tie: the earlier rank comes first
    assert order[3:6] == [(2, 0), (2, 1), (2, 2)]  # nothing asked: ranks stay
    assert late.rerank(queries, results.limit(0), 3).count() == 0


def test_long_texts_are_compared_in_blocks(monkeypatch):
    encode = late.trigram_encoder(64)
    tokens = [f"word{i}x{i * 7}" for i in range(1000)]
    query = encode(["word77x539", "other"])
    whole = late.best_matches(query, tokens, encode)
    monkeypatch.setattr(late, "BLOCK", 33)
    assert np.allclose(late.best_matches(query, tokens, encode), whole) and whole[0] == pytest.approx(1)


def test_another_token_encoder(spark):
    def encode(tokens):
        return np.array([[float(len(t)), 1.0] for t in tokens])

    queries = spark.createDataFrame([(1, "ab c")], "query_id long, query string")
    results = spark.createDataFrame([(1, 1, 1, 0, "c", "s", "x yyy")], RESULTS)
    assert late.scores(queries, results, encoder=encode).first()["rerank_score"] == (2 * 3 + 1) + (3 + 1)
    assert fusion.rerank(queries, results, scores=late.scores(queries, results, encoder=encode)).first()["rank"] == 1


def test_expectations_are_counted_while_writing(spark, tmp_path):
    path, checks = str(tmp_path / "t"), (quality.not_null("a"), quality.between("b", 1, 10))
    good = spark.createDataFrame([("x", 1), ("y", 10), ("z", None)], "a string, b long")
    assert tables.replace_table(good, path, good.schema, checks=checks) == 1
    bad = spark.createDataFrame([(None, 1), ("y", 11), ("z", None), ("u", 5)], good.schema)
    with pytest.raises(quality.QualityGateError, match="a:not_null, b:between"):
        tables.replace_table(bad, path, good.schema, checks=checks)
    assert tables.versions(spark, path) == [1] and tables.read_table(spark, path, good.schema).count() == 3
    made = tables.prepare_table(bad, path, good.schema, checks)
    counted = sorted(tuple(r) for r in made.results(spark).collect())
    assert counted == sorted(tuple(r) for r in quality.run_expectations(bad, checks).collect())
    assert tables.versions(spark, path) == [1]
    assert tables.publish(spark, made) == made.number and tables.read_table(spark, path, good.schema).count() == 4
    # An empty batch has nothing that fails.
    assert tables.replace_table(good.limit(0), path, good.schema, checks=checks) == made.number + 1
