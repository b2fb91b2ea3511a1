"""Context blocks, extractive answers and citations from ranked results.

Results hold at most k rows per query, so every list built here is that short.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators.chunking import sentences
from tidemark.operators.topk import KEY

# Fixed value: the answer where nothing was retrieved.
NOT_FOUND = "I could not find relevant information in the knowledge base."


def _joined(order: Column, value: Column, sep: str) -> Column:
    """Aggregate: the values of a short group in order, put together."""
    rows = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), sep)


# How a block of context and a citation are written.
CONTEXT = "\n[Context %d]\nSource: %s\nChunk ID: %s\n\n"
CITATION = "%s (%s)"


def contexts(results: DataFrame) -> DataFrame:
    """(query_id, context): numbered blocks in rank order."""
    block = F.concat(F.format_string(CONTEXT, "rank", "source", "chunk_id"), F.col("text"), F.lit("\n"))
    return results.groupBy("query_id").agg(_joined(F.col("rank"), block, "\n").alias("context"))


def citations(results: DataFrame) -> DataFrame:
    """(query_id, citation_no, doc_id, chunk_no, citation): distinct chunks, in order of first rank.

    The label starts anew in every document and documents may share a source,
    so what makes a citation distinct is the chunk's key, and the document is given with it.
    """
    first = results.groupBy("query_id", *KEY).agg(
        F.min("rank").alias("_rank"), F.min(F.format_string(CITATION, "source", "chunk_id")).alias("citation")
    )
    w = Window.partitionBy("query_id").orderBy("_rank", *KEY)
    return first.select("query_id", F.row_number().over(w).alias("citation_no"), *KEY, "citation")


def candidate_sentences(queries: DataFrame, results: DataFrame) -> DataFrame:
    """Sentences of the results that share a term with their query, and how many."""
    split = sentences(results, "query_id", "rank")
    asked = queries.select(
        "query_id", F.array_distinct(X.tokens(F.col("query"), "ascii")).alias("_terms")
    )
    shared = F.size(F.array_intersect("_terms", X.tokens(F.col("sentence"), "ascii")))
    return (
        split.join(asked, "query_id")
        .withColumn("overlap", shared)
        .filter("overlap > 0")
        .select("query_id", "rank", "sentence_no", "sentence", "overlap")
    )


def answers(queries: DataFrame, results: DataFrame, n: int = 3) -> DataFrame:
    """(query_id, query, answer), one row per query.

    The n sentences with most query terms, ties in reading order, repeats left
    out after the cut. Without any such sentence the text of the first result,
    without results the fixed sentence.
    """
    w = Window.partitionBy("query_id").orderBy(F.col("overlap").desc(), "rank", "sentence_no")
    chosen = candidate_sentences(queries, results).withColumn(
        "_place", F.row_number().over(w)
    ).filter(F.col("_place") <= n)
    picked = F.array_sort(F.collect_list(F.struct("_place", "sentence")))
    extract = chosen.groupBy("query_id").agg(
        F.array_join(F.array_distinct(F.transform(picked, lambda r: r["sentence"])), " ").alias("_extract")
    )
    top = results.filter("rank = 1").select("query_id", F.col("text").alias("_top"))
    return (
        queries.join(top, "query_id", "left")
        .join(extract, "query_id", "left")
        .select(
            "query_id", "query", F.coalesce("_extract", "_top", F.lit(NOT_FOUND)).alias("answer")
        )
    )
