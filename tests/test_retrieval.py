"""Search, fusion, rerank and answers against brute force on small corpora."""

import math
import random
import re
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import answers as A
from tidemark.operators import dense, fusion, lexical, topk
from tidemark.plans import retrieval
from tidemark.schemas import CHUNK

RANKED = "query_id long, rank int, doc_id long, chunk_no int, chunk_id string, source string, text string"


def chunks_of(spark, texts, per_doc=3):
    rows = [(i // per_doc, i % per_doc, f"c{i % per_doc}", f"s{i // per_doc % 2}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, CHUNK)


def queries_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


def found(df, score="score"):
    rows = sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"]))
    return [(r["query_id"], r["rank"], r["doc_id"], r["chunk_no"], round(r[score], 6)) for r in rows]


def okapi(texts, query, k, pad, per_doc=3):
    """One query over a list, straight from the formula."""
    toks = [t.lower().split() for t in texts]
    n, avgdl = len(toks), sum(map(len, toks)) / len(toks)
    vocab = {t for d in toks for t in d}
    df = {t: sum(t in d for d in toks) for t in vocab}
    raw = {t: math.log(n - df[t] + 0.5) - math.log(df[t] + 0.5) for t in vocab}
    mean = sum(raw.values()) / len(raw)
    idf = {t: 0.25 * mean if v < 0 else v for t, v in raw.items()}
    scores = []
    for d in toks:
        s = 0.0
        for t in query.lower().split():
            tf = d.count(t)
            s += idf.get(t, 0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(d) / avgdl))
        scores.append(float(f"{s:.11e}"))
    order = sorted(range(n), key=lambda i: -scores[i])
    if not pad:
        order = [i for i in order if scores[i] > 0]
    return [(r + 1, i // per_doc, i % per_doc, round(scores[i], 6)) for r, i in enumerate(order[:k])]


def corpus(seed, n=60, repeat_third=True):
    """Random texts; "the" is in nearly all, and a third are the same text."""
    rnd = random.Random(seed)
    words = ["the"] * 12 + [f"w{i}" for i in range(40)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 25))) for _ in range(n)]
    if repeat_third:
        for i in range(0, n, 3):
            texts[i] = "the w1 w2 the w3"
    texts[4] = ""
    return texts


QUERIES = ["the w1 w39", "w2 w2 w5", "unseen", "", "the", "THE W7 unseen w7"]


@pytest.fixture(params=["scan", "grid"])
def way(request, monkeypatch):
    """Both ways of bringing queries and rows together."""
    if request.param == "grid":
        monkeypatch.setattr(topk, "MAX_QUERIES", 1)
        monkeypatch.setattr(topk, "BLOCK_FACTOR", 2)
        monkeypatch.setattr(topk, "BLOCK_ROWS", 17)
    return request.param


@pytest.mark.parametrize("pad", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_bm25(spark, way, pad, seed, monkeypatch):
    monkeypatch.setattr(topk, "SCORE_CELLS", 50)
    texts = corpus(seed)
    index = lexical.build_index(chunks_of(spark, texts).repartition(5), "ws")
    got = found(lexical.bm25_search(queries_of(spark, *QUERIES), index, 5, pad))
    expected = [(q, *hit) for q, text in enumerate(QUERIES) for hit in okapi(texts, text, 5, pad)]
    assert got == expected


def test_acceptance_values_of_a_rare_word(spark, way):
    """Eight chunks of 6, 47, 47, 47, 36, 30, 23 and 26 words, the second with one word three times that no other has."""
    sizes = [6, 47, 47, 47, 36, 30, 23, 26]
    texts = [" ".join(["price:"] + [f"w{k}x{n}" for n in range(size - 1)]) for k, size in enumerate(sizes)]
    texts[1] = " ".join(["laptop"] * 3 + texts[1].split()[3:])
    index = lexical.build_index(chunks_of(spark, texts, 8), "ws")
    assert index.corpus.first()["avgdl"] == 32.75
    got = found(lexical.bm25_search(queries_of(spark, "laptop price"), index, 5, True))
    assert got == [(0, 1, 0, 1, 2.419235), *((0, r, 0, k, 0.0) for r, k in ((2, 0), (3, 2), (4, 3), (5, 4)))]


def test_bm25_tiny_corpus_with_negative_mean_idf(spark, way):
    texts = ["a b", "a b", "a b c"]
    index = lexical.build_index(chunks_of(spark, texts), "ws")
    for pad in (False, True):
        got = found(lexical.bm25_search(queries_of(spark, "a", "c z"), index, 5, pad))
        assert got == [(q, *h) for q, t in enumerate(["a", "c z"]) for h in okapi(texts, t, 5, pad)]


def test_index_tables(spark, tmp_path):
    texts = corpus(3)
    index = lexical.build_index(chunks_of(spark, texts), "ws")
    toks = [t.lower().split() for t in texts]
    one = index.corpus.first()
    assert one["n_chunks"] == len(texts) and one["n_terms"] == len({t for d in toks for t in d})
    assert one["avgdl"] == pytest.approx(sum(map(len, toks)) / len(toks))
    df = {r["term"]: r["df"] for r in index.term_stats.collect()}
    assert df == {t: sum(t in d for d in toks) for t in {t for d in toks for t in d}}
    tf = {(r["doc_id"], r["chunk_no"], r["term"]): r["tf"] for r in index.postings.collect()}
    assert tf == {(i // 3, i % 3, t): d.count(t) for i, d in enumerate(toks) for t in d}
    lexical.save_index(index, str(tmp_path / "index"))
    again = lexical.load_index(spark, str(tmp_path / "index"), "ws")
    q = queries_of(spark, *QUERIES)
    assert found(lexical.bm25_search(q, again)) == found(lexical.bm25_search(q, index))


def test_empty_inputs(spark, way):
    none = chunks_of(spark, ["x"]).limit(0)
    q = queries_of(spark, "x")
    assert lexical.bm25_search(q, lexical.build_index(none, "ws")).count() == 0
    assert lexical.keyword_search(q, none).count() == 0
    full = chunks_of(spark, ["x", "y"])
    assert lexical.keyword_search(q.limit(0), full).count() == 0
    assert lexical.bm25_search(q.limit(0), lexical.build_index(full, "ws"), pad_zero=True).count() == 0


def test_keyword_counts_and_ties(spark, way):
    texts = ["b a a", "a", "c", "A-a.", "a_b a", "a"]
    got = found(lexical.keyword_search(queries_of(spark, "a a b", "?!"), chunks_of(spark, texts), 4))
    # a_b is one token that is not plain letters; equal scores keep corpus order.
    assert got == [(0, 1, 0, 0, 5.0), (0, 2, 1, 0, 4.0), (0, 3, 0, 1, 2.0), (0, 4, 1, 1, 2.0)]


def vectors_of(spark, matrix):
    rows = [(i, 0, f"v{i}", "s", "", [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(
        rows, "doc_id long, chunk_no int, chunk_id string, source string, text string, embedding array<float>"
    )


@pytest.mark.parametrize("metric", ["dot", "l2sq"])
@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e-160, 1e30, 1e150])
def test_cells_are_sifted_without_loss(metric, scale, monkeypatch):
    """The k best of random, repeated, small and large vectors; few cells are worked out one by one."""
    monkeypatch.setattr(topk, "SIFT_QUERIES", 7)
    monkeypatch.setattr(topk, "SCORE_CELLS", 7 * 40)
    monkeypatch.setattr(topk, "PENDING", 50)
    rng = np.random.default_rng(4)
    x, y = (rng.normal(size=(n, 6)) * scale for n in (400, 23))
    x[1::9], x[2::11], y[5] = x[0], x[3] * 1e-6, x[0]
    lists = lambda m: pa.array(m.tolist(), pa.list_(pa.float64()))
    batch = pa.record_batch({"doc_id": np.arange(400), "chunk_no": np.zeros(400, np.int32), "embedding": lists(x)})
    scorer, worked_out = dense.scorer(metric), []
    refine = lambda side, b, r, q: worked_out.append(len(r)) or scorer.refine(side, b, r, q)
    best = topk._Best(replace(scorer, refine=refine), pa.table({"query_id": np.arange(23), "embedding": lists(y)}), 4)
    best.offer(batch)
    (found,) = best.result(["query_id", "doc_id", "chunk_no", "score"])
    scores = [x @ v if metric == "dot" else -((x - v) ** 2).sum(axis=1) for v in y]
    keyed = [sorted((-topk.significant(np.array([s]))[0], r) for r, s in enumerate(each)) for each in scores]
    got = list(zip(found["query_id"].to_pylist(), found["doc_id"].to_pylist(), strict=True))
    assert got == [(q, r) for q, each in enumerate(keyed) for _, r in each[:4]]
    assert sum(worked_out) < 400 * 23 / 3


def test_vectors_that_are_not_finite_are_sifted_as_before():
    side = dense._QueryVectors(pa.table({"query_id": [0], "embedding": pa.array([[1.0, float("inf")]])}))
    batch = pa.record_batch({"embedding": pa.array([[1.0, 2.0]])})
    assert dense._sift(side, batch, np.full(1, -np.inf), 1, 5, "dot") is None


@pytest.mark.parametrize("metric", ["dot", "l2sq"])
def test_dense_search_of_a_table_in_itself(spark, way, metric, tmp_path):
    m = np.random.default_rng(8).normal(size=(60, 5)).astype(np.float32)
    vectors_of(spark, m).write.parquet(f"{tmp_path}/v")
    vectors = spark.read.parquet(f"{tmp_path}/v")
    asked = vectors.select(F.col("doc_id").alias("query_id"), "embedding")
    got = dense.dense_search(asked, vectors, 4, metric).select("query_id", "rank", "doc_id").collect()
    x = m.astype(float)
    score = x @ x.T if metric == "dot" else -((x[:, None] - x[None]) ** 2).sum(axis=2)
    expected = [(q, place + 1, int(r)) for q in range(60) for place, r in enumerate(np.argsort(-score[q], kind="stable")[:4])]
    assert sorted(map(tuple, got)) == expected


@pytest.mark.parametrize("metric", ["dot", "l2sq"])
def test_dense(spark, way, metric, monkeypatch):
    monkeypatch.setattr(topk, "SCORE_CELLS", 40)
    rng = np.random.default_rng(5)
    m = rng.normal(size=(90, 8)).astype(np.float32)
    m[::3] = m[0]  # a third of all vectors are the same
    q = m[[0, 1, 2, 50, 51]]
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "query_id long, embedding array<float>")
    got = found(
        dense.dense_search(queries, vectors_of(spark, m).repartition(4), 7, metric),
        "score" if metric == "dot" else "distance",
    )
    m64, q64 = m.astype(float), q.astype(float)
    expected = []
    for i, v in enumerate(q64):
        value = m64 @ v if metric == "dot" else ((m64 - v) ** 2).sum(axis=1)
        keyed = np.round(-value if metric == "dot" else value, 9)
        order = sorted(range(len(m)), key=lambda j: (keyed[j], j))[:7]
        expected += [(i, r + 1, j, 0, round(float(value[j]), 6)) for r, j in enumerate(order)]
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert np.allclose([g[4] for g in got], [e[4] for e in expected], atol=2e-6)


def test_near_neighbours_are_told_apart(spark, way):
    """Distances far below any fixed number of decimals."""
    m = [[3e-5, 0.0], [2e-5, 0.0], [1.5e-5, 0.0], [1e-5, 0.0]]
    queries = spark.createDataFrame([(0, m[3])], "query_id long, embedding array<float>")
    got = dense.dense_search(queries, vectors_of(spark, m), 2).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [3, 2] and got[0]["distance"] == 0 and 0 < got[1]["distance"] < 1e-10
    far = [[1e6 + x, 1.0] for x in (0.5, 0.25, 0.0)]
    queries = spark.createDataFrame([(0, far[2])], "query_id long, embedding array<float>")
    assert [r["doc_id"] for r in dense.dense_search(queries, vectors_of(spark, far), 3).orderBy("rank").collect()] == [2, 1, 0]


def test_small_positive_scores_stay(spark, way):
    """A term in nearly half of all chunks has an idf, and so a score, close to 0."""
    texts = ["x"] * 500 + ["y"] * 502
    index = lexical.build_index(chunks_of(spark, texts), "ws")
    got = lexical.bm25_search(queries_of(spark, "x"), index, 3).collect()
    assert len(got) == 3 and all(0 < r["score"] < 0.01 for r in got)


def test_no_queries_and_null_vectors(spark, way):
    vectors = vectors_of(spark, [[1.0, 0.0], [0.0, 1.0]])
    with_null = vectors.unionByName(vectors.limit(1).withColumn("embedding", F.lit(None).cast("array<float>")))
    queries = spark.createDataFrame([(0, [1.0, 0.0]), (1, None)], "query_id long, embedding array<float>")
    assert dense.dense_search(queries.limit(0), vectors).count() == 0
    assert dense.dense_search(queries, vectors.limit(0)).count() == 0
    assert dense.dense_search(queries, with_null, 5).count() == 2
    docs = spark.createDataFrame([(1, "s", "a lamp")], "doc_id long, source string, text string")
    assert retrieval.hybrid_search(queries_of(spark, "x").limit(0), docs).count() == 0


def test_bad_vectors_are_refused_when_the_table_is_built(spark, tmp_path):
    import pyarrow as pa

    def some_null(batches):
        for b in batches:
            v = pa.array([None if t == "x" else [1.0] for t in b.column("text").to_pylist()], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*b.columns, v], names=[*b.schema.names, "embedding"])

    with pytest.raises(dense.BadVectorError, match="1 null"):
        dense.rebuild_vectors(chunks_of(spark, ["abc", "x"]), str(tmp_path / "v"), encoder=some_null)


def test_approximate_search_finds_most(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 16))
    m = (centres[np.arange(400) % 20] + rng.normal(size=(400, 16)) * 0.1).astype(np.float32)
    vectors = vectors_of(spark, m)
    queries = spark.createDataFrame([(i, [float(x) for x in m[i]]) for i in range(0, 400, 20)], "query_id long, embedding array<float>")

    def keys(df):
        return {(r["query_id"], r["doc_id"]) for r in df.collect()}

    exact, near = keys(dense.dense_search(queries, vectors, 5)), keys(dense.approximate_search(queries, vectors, 5, reach=1.0))
    assert len(exact & near) >= 0.9 * len(exact)
    first = dense.approximate_search(queries, vectors, 1).collect()
    assert len(first) == 20 and all(r["distance"] == 0 for r in first)


def test_significant_digits():
    x = np.array([0.0, 1.0, 123456.7890123456, -1e-300 / 3, 1e300 / 3, np.inf, -np.inf, 5e-10])
    got = topk.significant(x, 12)
    assert np.allclose(got, x, rtol=1e-11, atol=0) and got[2] == 123456.789012
    assert topk.significant(np.array([0.1 + 0.2]))[0] == topk.significant(np.array([0.3]))[0]


def test_dense_refuses_vectors_of_different_lengths(spark):
    mixed = vectors_of(spark, [[1, 2], [1, 2, 3]]).coalesce(1)
    queries = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<float>")
    with pytest.raises(Exception, match="different lengths"):
        dense.dense_search(queries, mixed).collect()
    with pytest.raises(ValueError):
        dense.dense_search(queries, mixed, metric="cosine")


def test_vectors_are_unit_and_depend_on_their_own_text(spark):
    chunks = chunks_of(spark, ["red lamp", "red lamp red", "", "green"])
    rows = {r["doc_id"] * 3 + r["chunk_no"]: r["embedding"] for r in dense.vectorise(chunks, 32).collect()}
    assert [round(sum(x * x for x in rows[i]), 5) for i in range(4)] == [1, 1, 0, 1]
    alone = dense.vectorise(chunks.filter("chunk_no = 1"), 32).first()["embedding"]
    assert alone == rows[1]
    idf = dense.bucket_idf(chunks, 32)
    assert len(idf) == 32 and max(idf) == pytest.approx(math.log(5) + 1)


def test_own_encoder(spark):
    import pyarrow as pa

    def lengths(batches):
        for b in batches:
            v = pa.array([[float(len(t))] for t in b.column("text").to_pylist()], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*b.columns, v], names=[*b.schema.names, "embedding"])

    rows = dense.vectorise(chunks_of(spark, ["abc", "x"]), encoder=lengths).orderBy("chunk_no").collect()
    assert [r["embedding"] for r in rows] == [[3.0], [1.0]]


def test_vector_table_ids(spark):
    table = dense.vector_table(dense.vectorise(chunks_of(spark, ["a", "b", "c", "d"]), 8))
    assert dense.repeated_ids(table).count() == 0
    assert dense.repeated_ids(table.unionByName(table.limit(1))).count() == 1


def test_rebuild_vectors(spark, tmp_path):
    from tidemark.schemas import VECTOR
    from tidemark.sources import tables

    path = str(tmp_path / "vectors")
    chunks = chunks_of(spark, ["red lamp", "green desk", "blue", "lamp"])
    assert dense.rebuild_vectors(chunks, path, 16) == 4
    assert dense.rebuild_vectors(chunks.filter("doc_id = 0"), path, 16) == 3
    stored = dense.stored_vectors(tables.read_table(spark, path, VECTOR))
    q = dense.vectorise(queries_of(spark, "green desk"), 16, text="query")
    assert found(dense.dense_search(q, stored, 1), "distance") == [(0, 1, 0, 1, 0.0)]
    with pytest.raises(dense.RepeatedIdError, match="0:c0"):
        dense.rebuild_vectors(chunks.unionByName(chunks), path, 16)
    assert tables.versions(spark, path) == [1, 2]


def ranked(spark, *rows):
    return spark.createDataFrame([(q, r, d, 0, f"c{d}", "s", text) for q, r, d, text in rows], RANKED)


def test_rrf(spark):
    first = ranked(spark, (0, 1, 10, "a"), (0, 2, 11, "b"), (1, 1, 10, "a"))
    second = ranked(spark, (0, 1, 12, "c"), (0, 2, 10, "a"))
    got = found(fusion.rrf([first, second], 5), "rrf_score")
    assert got == [
        (0, 1, 10, 0, round(1 / 61 + 1 / 62, 6)), (0, 2, 12, 0, 0.016393), (0, 3, 11, 0, 0.016129), (1, 1, 10, 0, 0.016393),
    ]
    # 11 and 13 tie: the one from the earlier list comes first.
    tie = fusion.rrf([ranked(spark, (0, 2, 11, "b")), ranked(spark, (0, 2, 13, "d"))], 1)
    assert [r["doc_id"] for r in tie.collect()] == [11]
    empty = first.limit(0)
    assert found(fusion.rrf([empty, second], 5), "rrf_score") == found(fusion.rrf([second], 5), "rrf_score")
    assert len(found(fusion.rrf([first, second, second], 2), "rrf_score")) == 3


def test_rerank(spark):
    results = ranked(spark, (0, 1, 1, "desk"), (0, 2, 2, "red lamp"), (0, 3, 3, "lamp red sale"), (1, 1, 1, "x"))
    q = queries_of(spark, "red lamp?", "")
    got = found(fusion.rerank(q, results, 2), "rerank_score")
    assert got == [(0, 1, 2, 0, 1.0), (0, 2, 3, 0, 1.0), (1, 1, 1, 0, 0.0)]
    assert fusion.rerank(q, results, 1, scorer=None).count() == 2
    by_length = fusion.rerank(q, results, 1, scorer=lambda query, text: F.length(text))
    assert {r["doc_id"] for r in by_length.filter("query_id = 0").collect()} == {3}
    table = results.select("query_id", "doc_id", "chunk_no", F.col("doc_id").cast("double").alias("rerank_score"))
    assert [r["doc_id"] for r in fusion.rerank(q, results, 1, scores=table).orderBy("query_id").collect()] == [3, 1]
    assert fusion.rerank(q, results.limit(0)).count() == 0
    # A result without a score in the table stays, with 0.
    some = fusion.rerank(q, results, 5, scores=table.filter("doc_id = 2"))
    assert found(some.filter("query_id = 0"), "rerank_score") == [(0, 1, 2, 0, 2.0), (0, 2, 1, 0, 0.0), (0, 3, 3, 0, 0.0)]
    assert fusion.rerank(q, results, 1, scorer=None).columns == some.columns


def test_answers(spark):
    results = ranked(
        spark,
        (0, 1, 1, "The lamp is red. It is new! The lamp is red."),
        (0, 2, 2, "A red lamp costs 5. Ships today."),
        (1, 1, 3, "Nothing shared here. Second."),
    )
    q = queries_of(spark, "red lamp costs", "zzz", "no results")
    got = {r["query_id"]: r["answer"] for r in A.answers(q, results).collect()}
    assert got == {
        0: "A red lamp costs 5. The lamp is red.",
        1: "Nothing shared here. Second.",
        2: A.NOT_FOUND,
    }


def test_contexts_and_citations(spark):
    rows = [(0, 2, 1, 0, "c1", "s", "two"), (0, 1, 2, 0, "c2", "s", "one"), (0, 3, 3, 0, "c2", "s", "three")]
    results = spark.createDataFrame(rows, RANKED)
    assert A.contexts(results).first()["context"] == (
        "\n[Context 1]\nSource: s\nChunk ID: c2\n\none\n\n\n[Context 2]\nSource: s\nChunk ID: c1\n\ntwo\n"
        "\n\n[Context 3]\nSource: s\nChunk ID: c2\n\nthree\n"
    )
    cited = A.citations(results).orderBy("citation_no").collect()
    # Two documents of one source have a chunk c2 each.
    assert [(r["citation_no"], r["doc_id"], r["citation"]) for r in cited] == [(1, 2, "s (c2)"), (2, 1, "s (c1)"), (3, 3, "s (c2)")]
    twice = results.unionByName(results.withColumn("rank", F.col("rank") + 3))
    assert A.citations(twice).orderBy("citation_no").collect() == cited


def test_jobs_end_to_end(spark):
    docs = spark.createDataFrame(
        [
            (1, "a.txt", "Lamp\nThe lamp can be returned within 14 days. It needs a receipt."),
            (2, "b.txt", "Desk\nThe desk costs 300. It is made of oak."),
            (3, "c.txt", " \n "),
        ],
        "doc_id long, source string, text string",
    )
    q = queries_of(spark, "How much does the desk cost? oak", "lamp returned")
    hybrid = retrieval.hybrid_search(q, docs)
    assert {(r["query_id"], r["doc_id"]) for r in hybrid.filter("rank = 1").collect()} == {(0, 2), (1, 1)}
    done = retrieval.question_answer(q, docs)
    text = {r["query_id"]: r["answer"] for r in done.answers.collect()}
    assert "It is made of oak." in text[0] and re.search("returned within 14 days", text[1])
    assert done.contexts.count() == 2
    assert {r["citation"] for r in done.citations.filter("query_id = 1").collect()} >= {"a.txt (chunk_0000)"}
