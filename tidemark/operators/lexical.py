"""Lexical index and search: Okapi BM25 and plain term counts."""

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import topk
from tidemark.session import materialise

# The Okapi parameters.
K1 = 1.5
B = 0.75
EPSILON = 0.25

# Folders of a saved index.
PARTS = 64


@dataclass(frozen=True)
class Index:
    """Tables over one chunk table, tokenised in ``mode``.

    ``chunks``      the chunk columns plus ``tokens`` and ``dl``
    ``term_counts`` (term, df, total_length): one row per term, and one row
                    with a null term that stands for the corpus, where df is
                    the number of chunks and total_length their summed length
    """

    mode: str
    chunks: DataFrame
    term_counts: DataFrame
    #: Number of folders that stored chunks are dealt into by their key, if they are.
    parts: int | None = None

    @property
    def postings(self) -> DataFrame:
        """(doc_id, chunk_no, term, tf)"""
        each = self.chunks.select(*topk.KEY, F.explode("tokens").alias("term"))
        return each.groupBy(*topk.KEY, "term").agg(F.count("*").alias("tf"))

    @property
    def doc_len(self) -> DataFrame:
        return self.chunks.select(*topk.KEY, "dl")

    @property
    def corpus(self) -> DataFrame:
        """One row: n_chunks, avgdl, n_terms, avg_idf (mean before flooring)."""
        whole = F.col("term").isNull()
        n = self.term_counts.filter(whole).agg(F.max("df")).scalar()
        return self.term_counts.agg(
            F.max(F.when(whole, F.col("df"))).alias("n_chunks"),
            F.max(F.when(whole, F.col("total_length") / F.col("df"))).alias("avgdl"),
            F.count_if(~whole).alias("n_terms"),
            F.avg(F.when(~whole, _idf(n))).alias("avg_idf"),
        )

    @property
    def term_stats(self) -> DataFrame:
        """(term, df, idf); an idf below zero becomes EPSILON * avg_idf."""
        n = self.term_counts.filter(F.col("term").isNull()).agg(F.max("df")).scalar()
        floor = F.lit(EPSILON) * self.corpus.select("avg_idf").scalar()
        return (
            self.term_counts.filter(F.col("term").isNotNull())
            .select("term", "df", _idf(n).alias("_raw"), floor.alias("_floor"))
            .select(
                "term",
                "df",
                F.when(F.col("_raw") < 0, F.col("_floor")).otherwise(F.col("_raw")).alias("idf"),
            )
        )


def _idf(n):
    return F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)


def counted_tokens(tokens: Column) -> Column:
    """(term, tf) of every distinct token of an array, in order of the terms: linear after one sort, within the row."""

    def runs(s: Column) -> Column:
        new = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return F.when(F.size(s) > 0, F.flatten(F.transform(F.array(new), lambda at: lengths(s, at))))

    def lengths(s: Column, at: Column) -> Column:
        end = lambda k: F.coalesce(F.get(at, k + 1), F.size(s))
        return F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("term"), (end(k) - i).cast("long").alias("tf")))

    # Sorted once and bound to the lambda variable.
    return F.flatten(F.transform(F.array(F.sort_array(tokens)), runs))


def tokenise(chunks: DataFrame, mode: str) -> DataFrame:
    """Add ``tokens`` and ``dl`` unless the chunks have them already."""
    if "tokens" in chunks.columns:
        return chunks
    return chunks.withColumn("tokens", X.tokens(F.col("text"), mode)).withColumn(
        "dl", F.size("tokens")
    )


def build_index(chunks: DataFrame, mode: str = "word", store: bool = True) -> Index:
    """Tokenise the chunks and count the vocabulary, each once, into the shared folder.

    Counting, searching and fetching the text of results all read the written
    chunks, a few columns each; ``store`` false leaves them unwritten, for an
    index that is only read for its counts. Every chunk adds its distinct terms and one null term, so that document
    frequencies, the number of chunks and their total length come out of the
    same aggregation. Frequent terms are combined in the map tasks, what is
    shuffled and written is the size of the vocabulary.
    """
    tokenised = tokenise(chunks, mode)
    if store and "tokens" not in chunks.columns:
        tokenised = materialise(tokenised, "index-chunks")
    no_term = F.lit(None).cast("string")
    each = tokenised.select(
        "dl", F.explode(F.array_append(F.array_distinct("tokens"), no_term)).alias("term")
    )
    counts = each.groupBy("term").agg(
        F.count("*").alias("df"),
        F.sum(F.when(F.col("term").isNull(), F.col("dl"))).alias("total_length"),
    )
    return Index(mode, tokenised, materialise(counts, "term-counts"))


def save_chunks(chunks: DataFrame, path: str, parts: int, mode: str | None = None) -> None:
    """Chunks in folders ``part=<n>`` by a hash of their key, sorted by key in their files. With a ``mode`` they are
    tokenised on the way, after the shuffle, which then carries the text alone."""
    dealt = chunks.withColumn("part", topk.part_of(parts)).repartition("part")
    dealt = tokenise(dealt, mode) if mode else dealt
    dealt.sortWithinPartitions("part", *topk.KEY).write.mode("overwrite").partitionBy("part").parquet(path)
    # Without a row there are no files to tell the columns.
    dealt.limit(0).write.mode("overwrite").parquet(f"{path}_columns")


def load_chunks(spark: SparkSession, path: str) -> DataFrame:
    """What ``save_chunks`` has written."""
    return spark.read.schema(spark.read.parquet(f"{path}_columns").schema).parquet(path)


def save_index(index: Index, path: str, parts: int = PARTS) -> None:
    """Keep the index, tokens included, for later searches; chunks in folders by key, so that results are fetched from few."""
    save_chunks(index.chunks, f"{path}/chunks", parts)
    index.term_counts.write.mode("overwrite").parquet(f"{path}/term_counts")


def load_index(spark: SparkSession, path: str, mode: str = "word", parts: int = PARTS) -> Index:
    """A saved index; ``parts`` as it was saved with."""
    return Index(
        mode, load_chunks(spark, f"{path}/chunks"), spark.read.parquet(f"{path}/term_counts"), parts
    )


def query_terms(queries: DataFrame, mode: str) -> DataFrame:
    """(query_id, term, qtf), repeats of a term counted."""
    each = queries.select("query_id", F.explode(X.tokens(F.col("query"), mode)).alias("term"))
    return each.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def bm25_search(
    queries: DataFrame, index: Index, k: int = 5, pad_zero: bool = False
) -> DataFrame:
    """RANKED by Okapi BM25 score.

    ``pad_zero`` lets chunks that share no term with the query fill the list,
    in corpus order; otherwise only positive scores are returned.
    """
    size = topk.measure(queries, F.char_length("query"))
    terms = query_terms(queries, index.mode)
    known = index.term_stats.join(F.broadcast(terms) if size.fits else terms, "term")
    weights = known.select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("weight"))
    corpus = index.corpus.first()
    scorer = topk.Scorer(
        reads="tokens",
        prepare=_QueryTerms,
        score=partial(_score, avgdl=corpus["avgdl"] or 1.0),
        positive_only=not pad_zero,
    )
    return topk.top_k(index.chunks, _with_every_query(weights, queries), scorer, k, size, index.parts)


def keyword_search(
    queries: DataFrame, chunks: DataFrame, k: int = 5, mode: str = "ascii"
) -> DataFrame:
    """RANKED by the summed counts of the query's terms; positive scores only."""
    size = topk.measure(queries, F.char_length("query"))
    weights = query_terms(queries, mode).select(
        "query_id", "term", F.col("qtf").cast("double").alias("weight")
    )
    scorer = topk.Scorer(
        reads="tokens",
        prepare=_QueryTerms,
        score=partial(_score, avgdl=None),
        positive_only=True,
    )
    return topk.top_k(
        tokenise(chunks, mode), _with_every_query(weights, queries), scorer, k, size
    )


def _with_every_query(weights: DataFrame, queries: DataFrame) -> DataFrame:
    """Add a row without a term per query, so that none is lost for having no
    known term."""
    none = queries.select(
        "query_id", F.lit(None).cast("string").alias("term"), F.lit(0.0).alias("weight")
    )
    return weights.unionByName(none)


class _QueryTerms:
    """Query rows (query_id, term, weight) as arrays, grouped by term."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        ids = rows["query_id"].combine_chunks()
        self.query_ids = pc.unique(ids)
        has_term = pc.is_valid(rows["term"])
        found = rows.filter(has_term).combine_chunks()
        # Sorted, so that sums are always taken in the same order.
        self.vocab = pc.unique(found["term"]).sort()
        q = pc.index_in(found["query_id"], value_set=self.query_ids).to_numpy()
        t = pc.index_in(found["term"], value_set=self.vocab).to_numpy()
        order = np.lexsort((q, t))
        self.query = q[order].astype(np.int64)
        self.weight = found["weight"].to_numpy()[order]
        self.start = np.searchsorted(t[order], np.arange(len(self.vocab) + 1))


def _score(side: _QueryTerms, batch: pa.RecordBatch, avgdl: float | None) -> np.ndarray:
    """(rows x queries) sums of weight * saturated term frequency; of weight *
    term frequency where ``avgdl`` is None."""
    n, m = batch.num_rows, len(side.query_ids)
    lists = batch.column("tokens")
    dl = pc.fill_null(lists.value_lengths(), 0).to_numpy().astype(np.int64)
    term = pc.fill_null(pc.index_in(lists.flatten(), value_set=side.vocab), -1).to_numpy()
    hit = term >= 0
    size = max(1, len(side.vocab))
    pair, tf = np.unique(
        np.repeat(np.arange(n), dl)[hit] * size + term[hit], return_counts=True
    )
    row, term = pair // size, pair % size
    value = tf.astype(np.float64)
    if avgdl is not None:
        value = tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl[row] / avgdl))
    # Every (row, term) meets the queries that hold the term.
    fan = side.start[term + 1] - side.start[term]
    which = np.repeat(np.arange(len(term)), fan)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(fan) - fan, fan)
    entry = side.start[term][which] + offset
    cell = row[which] * m + side.query[entry]
    sums = np.bincount(cell, side.weight[entry] * value[which], minlength=n * m)
    return sums.reshape(n, m)
