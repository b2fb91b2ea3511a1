"""Retrieval jobs over a table of queries (query_id, query)."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.operators import answers as A
from tidemark.operators.chunking import chunk_chars
from tidemark.operators.dense import bucket_idf, dense_search, hash_tokens, vectorise
from tidemark.operators.fusion import rerank, rrf
from tidemark.operators.lexical import bm25_search, build_index, keyword_search, tokenise
from tidemark.session import materialise

DIM = 256


@dataclass(frozen=True)
class Answered:
    """All that a question-answer job gives, each a table keyed by query."""

    results: DataFrame
    contexts: DataFrame
    answers: DataFrame
    citations: DataFrame


def prepare(docs: DataFrame, size: int, overlap: int, normalise: str, mode: str) -> DataFrame:
    """The chunk table with its tokens and hash buckets, written once.

    Four steps of a search read the chunks. Cutting and tokenising is the
    expensive part, so they read it from files instead of doing it again.
    """
    chunks = tokenise(chunk_chars(docs, size, overlap, normalise), mode)
    hashed = hash_tokens(chunks, DIM, tokens="tokens" if mode == "word" else None)
    return materialise(hashed, "chunks")


def encode(queries: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries and chunks with vectors in the same space."""
    idf = bucket_idf(chunks, DIM)
    return vectorise(queries, DIM, idf, text="query"), vectorise(chunks, DIM, idf)


def hybrid_search(queries: DataFrame, docs: DataFrame, k: int = 5) -> DataFrame:
    """BM25 and nearest vectors over character chunks, fused by rank."""
    chunks = prepare(docs, 500, 100, "flat", "word")
    query_vectors, vectors = encode(queries, chunks)
    dense = dense_search(query_vectors, vectors, k, metric="l2sq")
    lexical = bm25_search(queries, build_index(chunks, "word"), k, pad_zero=True)
    return rrf([dense, lexical], k)


def question_answer(queries: DataFrame, docs: DataFrame, k: int = 5) -> Answered:
    """Dense and keyword search fused, reranked, and turned into answers."""
    chunks = prepare(docs, 500, 80, "paragraph", "ascii")
    query_vectors, vectors = encode(queries, chunks)
    dense = dense_search(query_vectors, vectors, k, metric="dot")
    lexical = keyword_search(queries, chunks, k, mode="ascii")
    # At most k rows per query, read by three more steps: written once.
    results = materialise(rerank(queries, rrf([dense, lexical], k), k), "results")
    return Answered(
        results, A.contexts(results), A.answers(queries, results), A.citations(results)
    )
