"""Rank fusion and reranking of result lists."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators.topk import CARRY, KEY

RRF_K = 60


def rrf(lists: Sequence[DataFrame], k: int = 5, rrf_k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of any number of ranked lists.

    score = sum over lists of 1 / (rrf_k + rank). Ties keep the order of first
    appearance: lists in the order given, each by rank. Text and source come
    from the first list that has the chunk.
    """
    if not lists:
        raise ValueError("no lists to fuse")
    united = None
    for number, ranked in enumerate(lists):
        part = ranked.select(
            "query_id",
            *KEY,
            (F.lit(1.0) / (F.lit(rrf_k) + F.col("rank"))).alias("_part"),
            F.struct(F.lit(number).alias("list_no"), F.col("rank").alias("rank"), *CARRY).alias("_at"),
        )
        united = part if united is None else united.unionByName(part)
    fused = united.groupBy("query_id", *KEY).agg(
        F.sum("_part").alias("rrf_score"), F.min("_at").alias("_first")
    )
    # Sums of the same parts may differ in the last bit by their order.
    order = [F.round("rrf_score", 12).desc(), F.col("_first.list_no"), F.col("_first.rank")]
    w = Window.partitionBy("query_id").orderBy(*order)
    return (
        fused.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", *KEY, *[f"_first.{c}" for c in CARRY], "rrf_score")
    )


def coverage(query: Column, text: Column, mode: str = "ascii") -> Column:
    """Share of the query's distinct terms that the text has."""
    wanted = F.array_distinct(X.tokens(query, mode))
    shared = F.size(F.array_intersect(wanted, X.tokens(text, mode)))
    return F.when(F.size(wanted) > 0, shared / F.size(wanted)).otherwise(0.0)


def pairs(queries: DataFrame, results: DataFrame) -> DataFrame:
    """Each result with the text of its query."""
    return results.join(queries.select("query_id", "query"), "query_id")


def rerank(
    queries: DataFrame,
    results: DataFrame,
    k: int = 5,
    scorer: Callable[[Column, Column], Column] | None = coverage,
    scores: DataFrame | None = None,
) -> DataFrame:
    """Score every (query, text) pair, best first, ties by the earlier rank.

    ``scorer`` is a column expression of query and text. ``scores``, a table
    (query_id, doc_id, chunk_no, rerank_score), takes its place where the
    scores were made elsewhere; a result that has none there scores 0. With
    neither, the first k pass through, without a score.
    """
    if scores is not None:
        given = scores.select("query_id", *KEY, F.col("rerank_score").cast("double").alias("rerank_score"))
        scored = results.join(given, ["query_id", *KEY], "left").withColumn(
            "rerank_score", F.coalesce("rerank_score", F.lit(0.0))
        )
    elif scorer is not None:
        scored = pairs(queries, results).withColumn(
            "rerank_score", scorer(F.col("query"), F.col("text")).cast("double")
        )
    else:
        scored = results.withColumn("rerank_score", F.lit(None).cast("double"))
    scored = scored.withColumnRenamed("rank", "previous_rank")
    w = Window.partitionBy("query_id").orderBy(F.col("rerank_score").desc(), "previous_rank")
    return (
        scored.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", *KEY, *CARRY, "rerank_score", "previous_rank")
    )
