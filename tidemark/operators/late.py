"""Rerank scores by tokens: each query token's best match among the text's token vectors, summed.

A token's vector is made of its letters: the trigrams of ``^token$``, hashed to ``dim`` buckets, at unit length, so that forms of a word are
near each other. Any other token encoder, a function from a list of tokens to a matrix of one row each, can take its place.

Every pair of query and result is scored inside its row, in Arrow batches; texts are compared in blocks of tokens, so a long one
holds no more memory than a short one. The scores go to ``fusion.rerank(scores=..)``.
"""

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as X
from tidemark.operators import fusion, topk

DIM = 256
# Tokens of a text that are compared at a time, and token vectors that a task remembers.
BLOCK = 4096
REMEMBERED = 50_000

Encoder = Callable[[list[str]], np.ndarray]


@lru_cache(maxsize=REMEMBERED)
def _grams(token: str, dim: int) -> np.ndarray:
    framed = f"^{token}$"
    digests = [hashlib.md5(framed[i : i + 3].encode()).hexdigest()[:8] for i in range(len(token))]
    return np.array([int(d, 16) % dim for d in digests], np.int64)


def trigram_encoder(dim: int = DIM) -> Encoder:
    """Unit vectors of hashed trigrams."""

    def encode(tokens: list[str]) -> np.ndarray:
        found = [_grams(t, dim) for t in tokens]
        row = np.repeat(np.arange(len(found)), [len(g) for g in found])
        cells = row * dim + (np.concatenate(found) if found else np.zeros(0, np.int64))
        counts = np.bincount(cells, minlength=len(found) * dim).reshape(len(found), dim).astype(float)
        norm = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        return counts / np.where(norm == 0, 1, norm)

    return encode


def best_matches(query: np.ndarray, tokens: list[str], encode: Encoder) -> np.ndarray:
    """Largest product of every query vector with a token of the text, 0 where none is above."""
    best = np.zeros(len(query))
    for at in range(0, len(tokens), BLOCK):
        best = np.maximum(best, (query @ encode(tokens[at : at + BLOCK]).T).max(axis=1))
    return best


def scores(queries: DataFrame, results: DataFrame, mode: str = "ascii", encoder: Encoder | None = None) -> DataFrame:
    """(query_id, KEY, rerank_score) of every result.

    A query token that occurs twice counts twice; a query or text that is null or without tokens scores 0. Scores are
    rounded to 12 significant digits, so that equal texts tie whatever batch they are in.
    """
    encode = encoder or trigram_encoder()
    paired = fusion.pairs(queries, results).select(
        "query_id", *topk.KEY, X.tokens(F.col("query"), mode).alias("asked"), F.array_distinct(X.tokens(F.col("text"), mode)).alias("tokens")
    )
    named = ["query_id", *topk.KEY]
    schema = T.StructType([paired.schema[c] for c in named] + [T.StructField("rerank_score", T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for r, (asked, tokens) in enumerate(zip(batch.column("asked"), batch.column("tokens"), strict=True)):
                wanted, there = asked.as_py(), tokens.as_py()
                if wanted and there:
                    out[r] = best_matches(encode(wanted), there, encode).sum()
            columns = [*(batch.column(c) for c in named), pa.array(topk.significant(out))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return paired.mapInArrow(task, schema)


def rerank(queries: DataFrame, results: DataFrame, k: int = 5, mode: str = "ascii", encoder: Encoder | None = None) -> DataFrame:
    """RANKED results, best token match first, ties by the earlier rank; what the results already had stays with them."""
    return fusion.rerank(queries, results, k, scores=scores(queries, results, mode, encoder))
