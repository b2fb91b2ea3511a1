"""Stored indexes: postings of bounded impact, key folders, pivots. Results are those of the scans; what is read is counted."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import dense, lexical, pivots, postings, topk

CHUNK = "doc_id long, chunk_no int, chunk_id string, source string, text string"


def ranked(df, value):
    rows = df.select("query_id", "rank", "doc_id", "chunk_no", F.round(value, 6).alias("v"), "text").collect()
    return sorted(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def corpus(spark):
    """Chunks in which one word is everywhere, some are frequent, and most are rare."""
    rng = np.random.default_rng(5)
    rows = []
    for doc in range(6000):
        words = ["all"] * int(rng.integers(1, 4)) + [f"w{int(k)}" for k in rng.zipf(1.3, int(rng.integers(1, 30))) if k < 3000]
        rows.append((doc, 1, "chunk-001", f"s{doc % 3}", " ".join(words) if doc % 97 else ""))
    return spark.createDataFrame(rows, CHUNK)


@pytest.fixture(scope="module")
def questions(spark):
    texts = ["all", "w1 all", "w40 all all w3", "w900", "none of these", "", "w17 w18 w19", "w2500 w1"]
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


@pytest.fixture(scope="module")
def index(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("postings") / "index")
    postings.build(corpus, path, parts=16)
    return postings.load(spark, path)


@pytest.mark.parametrize("k", [1, 5, 200])
def test_postings_equal_the_scan(corpus, questions, index, k):
    found = ranked(postings.search(questions, index, k), "score")
    assert found == ranked(lexical.bm25_search(questions, lexical.build_index(corpus, "ws"), k), "score")
    assert found


def test_counts_equal_the_scan(spark, corpus, questions, tmp_path):
    postings.build(corpus, str(tmp_path / "i"), "ascii", postings.COUNT, parts=4)
    found = postings.search(questions, postings.load(spark, str(tmp_path / "i")), 7)
    assert ranked(found, "score") == ranked(lexical.keyword_search(questions, corpus, 7), "score")


def test_few_blocks_are_read(questions, index):
    read = {r.query_id: (r.postings_blocks, r.blocks_read) for r in postings.reading(questions, index, 5).collect()}
    assert set(read) == {0, 1, 2, 3, 6, 7}
    every, few = (sum(v[k] for v in read.values()) for k in (0, 1))
    assert few < every / 2
    assert read[0][1] < read[0][0]  # the word in all chunks


def test_salted_terms_and_few_blocks(spark, corpus, questions, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "SALT_ROWS", 700)
    monkeypatch.setattr(postings, "BLOCK", 16)
    postings.build(corpus, str(tmp_path / "i"), parts=4)
    salted = postings.load(spark, str(tmp_path / "i"))
    assert salted.blocks.filter("term = 'all'").select("salt").distinct().count() == 9
    assert salted.blocks.agg(F.max(F.size("docs"))).first()[0] == 16
    assert ranked(postings.search(questions, salted, 5), "score") == ranked(
        lexical.bm25_search(questions, lexical.build_index(corpus, "ws"), 5), "score"
    )


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_terms_are_pushed_into_the_scan_and_results_fetched_from_their_folders(questions, index):
    asked = postings.ask(questions, index, 5)
    assert "PushedFilters: [In(term" in _plan(asked.blocks)
    found = postings.search(questions.filter("query_id = 3"), index, 1)
    plan = _plan(found)
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [(part" in plan or "part#" in plan.split("PartitionFilters: [")[1][:40]
    assert "Python" not in plan and "Cartesian" not in plan


def test_few_folders_are_fetched(spark, corpus, questions, tmp_path):
    path = str(tmp_path / "saved")
    lexical.save_index(lexical.build_index(corpus, "ws"), path, parts=16)
    stored = lexical.load_index(spark, path, "ws", parts=16)
    one = questions.filter("query_id = 3")
    found = lexical.bm25_search(one, stored, 1)
    assert ranked(found, "score") == ranked(lexical.bm25_search(one, lexical.build_index(corpus, "ws"), 1), "score")
    files = topk.only_parts(stored.chunks, found, 16).select("text", F.input_file_name().alias("f"))
    assert files.select("f").distinct().count() == 1


def test_empty_index(spark, corpus, questions, tmp_path):
    postings.build(corpus.filter("false"), str(tmp_path / "i"), parts=2)
    assert postings.search(questions, postings.load(spark, str(tmp_path / "i"))).count() == 0


# ---------------------------------------------------------------- pivots ----


def vector_rows(spark, x):
    rows = [(k, 0, f"v{k}", "s", "", None if v is None else [float(c) for c in v]) for k, v in enumerate(x)]
    return spark.createDataFrame(rows, CHUNK + ", embedding array<float>")


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((30, 8)) * 10
    x = [centres[k % 30] + rng.standard_normal(8) * 0.3 for k in range(3000)]
    return x + [np.zeros(8)] * 300 + [None]  # copies of one vector, and a null


@pytest.mark.parametrize("metric, value", [("l2sq", "distance"), ("dot", "score")])
def test_pivots_equal_the_scan(spark, clustered, metric, value, tmp_path, monkeypatch):
    monkeypatch.setattr(pivots, "CELL_ROWS", 100)
    vectors = vector_rows(spark, clustered)
    asked = vectors.filter("doc_id % 50 = 0 or doc_id > 3290").select(F.col("doc_id").alias("query_id"), "embedding")
    pivots.build(vectors, str(tmp_path / "i"), metric)
    index = pivots.load(spark, str(tmp_path / "i"))
    for k in (1, 6):
        assert ranked(pivots.search(asked, index, k), value) == ranked(dense.dense_search(asked, vectors, k, metric), value)
    assert index.vectors.groupBy("pivot", "ring", "salt").count().agg(F.max("count")).first()[0] < 200


def test_pairs_are_left_out(spark, clustered, tmp_path):
    vectors = vector_rows(spark, clustered)
    asked = vectors.filter("doc_id % 50 = 0 and doc_id < 3000").select(F.col("doc_id").alias("query_id"), "embedding")
    pivots.build(vectors, str(tmp_path / "i"))
    rows = pivots.compared(asked, pivots.load(spark, str(tmp_path / "i")), 5).collect()
    assert len(rows) == 60 and {r.vectors for r in rows} == {3300}
    assert sum(r.compared for r in rows) < 0.1 * sum(r.vectors for r in rows)


def test_more_results_than_vectors_and_none(spark, tmp_path):
    few = vector_rows(spark, [[1, 0], [0, 1], [1, 1]])
    asked = few.select(F.col("doc_id").alias("query_id"), "embedding")
    pivots.build(few, str(tmp_path / "few"), "dot")
    found = pivots.search(asked, pivots.load(spark, str(tmp_path / "few")), 5)
    assert ranked(found, "score") == ranked(dense.dense_search(asked, few, 5, "dot"), "score")
    pivots.build(few.filter("false"), str(tmp_path / "none"))
    assert pivots.search(asked, pivots.load(spark, str(tmp_path / "none")), 5).count() == 0


@pytest.mark.parametrize("metric, value", [("l2sq", "distance"), ("dot", "score")])
def test_a_query_goes_once_to_a_block_of_cells(spark, metric, value, tmp_path, monkeypatch):
    """Of spread-out vectors, where nearly every cell is compared, a query is written once a block, not once a cell."""
    for name, rows in (("CELL_ROWS", 30), ("BLOCK_ROWS", 300), ("QUERY_ROWS", 64)):
        monkeypatch.setattr(pivots, name, rows, raising=False)
    x = np.random.default_rng(6).normal(size=(1500, 24))
    x[5::100] = x[5]
    vectors = vector_rows(spark, x)
    asked = vectors.filter("doc_id % 4 = 1").select(F.col("doc_id").alias("query_id"), "embedding")
    pivots.build(vectors, str(tmp_path / "i"), metric, pivots=40)
    written, keep = [], pivots.materialise
    monkeypatch.setattr(pivots, "materialise", lambda df, name: written.append((name, keep(df, name))) or written[-1][1])
    index = pivots.load(spark, str(tmp_path / "i"))
    assert len(index.cells) > 60
    assert ranked(pivots.search(asked, index, 4), value) == ranked(dense.dense_search(asked, vectors, 4, metric), value)
    chosen = [df.count() for name, df in written if name == "chosen-cells"]
    assert len(chosen) == 2 and sum(chosen) <= 375 * 2 * 8


def test_blocks_hold_the_counts_of_every_key_and_tokens_are_written_once(spark, tmp_path, monkeypatch):
    """Chunks of one key and length are one chunk, null keys too; blocks reach over batches and salts."""
    monkeypatch.setattr(postings, "BLOCK", 4)
    monkeypatch.setattr(postings, "SALT_ROWS", 15)
    rng, rows = np.random.default_rng(2), []
    for n in range(60):
        key = None if n % 20 == 7 else n // 2 if n % 10 == 1 else n
        rows.append((key, 1, "c", "s", " ".join(["all"] * (n % 3 + 1) + [f"w{k}" for k in rng.integers(0, 9, 5)] if n % 13 else [])))
    written, keep = [], lexical.materialise
    monkeypatch.setattr(lexical, "materialise", lambda df, name: written.append(name) or keep(df, name))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        postings.build(spark.createDataFrame(rows, CHUNK), str(tmp_path / "i"), "ws", postings.COUNT, parts=3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert written == ["term-counts"]
    counts = {}
    for key, _, _, _, text in rows:
        for term in text.split():
            at = (term, key, len(text.split()))
            counts[at] = counts.get(at, 0) + 1
    found, blocks = [], postings.load(spark, str(tmp_path / "i")).blocks.collect()
    for b in blocks:
        assert b.best == b.impacts[0] and len(b.docs) <= 4 and list(b.impacts) == sorted(b.impacts, reverse=True)
        found += [(b.term, d, i) for d, i in zip(b.docs, b.impacts, strict=True)]
    plain = [(t, d, float(n)) for (t, d, _), n in counts.items()]
    assert sorted(found, key=repr) == sorted(plain, key=repr)
    for term, salt in {(b.term, b.salt) for b in blocks}:
        mine = sorted((b for b in blocks if (b.term, b.salt) == (term, salt)), key=lambda b: b.block_no)
        assert [b.block_no for b in mine] == list(range(len(mine))) and all(len(b.docs) == 4 for b in mine[:-1])
        flat = [(-i, d is not None, d or 0) for b in mine for d, i in zip(b.docs, b.impacts, strict=True)]
        assert flat == sorted(flat)
