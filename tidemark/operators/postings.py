"""Stored postings with bounded impacts: exact lexical search that reads a few blocks of the asked terms.

``lexical.bm25_search`` scores whole passages against every chunk in one scan. A short question needs only the
chunks that hold its words, and of a frequent word only those where it counts most. Here the postings of each term
lie in blocks of falling impact, each with its largest one:

``blocks``  (term, salt, block_no, best, docs, chunk_nos, impacts), in files sorted by term
``terms``   (term, df, idf, best), sorted by term
``chunks``  the chunk columns with tokens and length, in folders ``part=<n>`` by a hash of the key
``meta``    one row: mode, kind of impact, number of parts, average length

A search has three steps, all joins and aggregations. (1) The first block of every asked term gives scores that k chunks
reach at least: a threshold. (2) Terms whose bounds together stay below it cannot make a result on their own; of the others, a block is read
only if its best impact, with the bounds of all other terms, can reach the threshold. A chunk that reaches it is in all of those blocks, so
no result is lost. (3) What may still reach the threshold is scored exactly from its stored tokens. The text is fetched last, from
the folders of the results alone.

The impact of a posting does not depend on the question: the saturated term frequency, or the plain count.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import lexical, topk
from tidemark.session import materialise

# Postings of a block, and of one salt of a term: what one task puts in order.
BLOCK = 128
SALT_ROWS = 200_000
# Distinct terms of all questions up to which they are pushed into the scan of the postings.
MAX_TERMS = 10_000
SLACK = 1e-9
BM25, COUNT = "bm25", "count"
BLOCKS = "term string, salt int, block_no int, best double, docs array<bigint>, chunk_nos array<int>, impacts array<double>"
BLOCKS_NAMES = ["term", "salt", "block_no", "best", "docs", "chunk_nos", "impacts"]


@dataclass(frozen=True)
class Postings:
    """A stored index of chunks, as ``build`` writes it."""

    blocks: DataFrame
    terms: DataFrame
    chunks: DataFrame
    mode: str
    impact: str
    parts: int
    avgdl: float


def impact(tf: Column, dl: Column, avgdl: float, kind: str) -> Column:
    """What one occurrence count adds for a term of weight 1."""
    tf = tf.cast("double")
    if kind == COUNT:
        return tf
    return tf * (lexical.K1 + 1) / (tf + lexical.K1 * (1 - lexical.B + lexical.B * dl / avgdl))


def build(chunks: DataFrame, path: str, mode: str = "ws", kind: str = BM25, parts: int = lexical.PARTS) -> None:
    """Write the index of ``chunks`` under ``path``. A term in a third of all chunks is put in order in many salted parts.

    The chunks are dealt into their folders first and read from there. A chunk's terms are counted in its row, and postings are shuffled
    once, by ranges of (term, salt), in which they are put in order and cut into blocks."""
    spark = chunks.sparkSession
    lexical.save_chunks(chunks, f"{path}/chunks", parts, mode)
    index = lexical.build_index(lexical.load_chunks(spark, f"{path}/chunks"), mode)
    avgdl = float(index.corpus.first()["avgdl"] or 1.0)
    stats = index.term_stats
    # Only terms of more than one salt, of which there are at most as many as salts are full.
    spread = stats.filter(F.col("df") > SALT_ROWS).select("term", F.ceil(F.col("df") / SALT_ROWS).alias("salts"))
    each = index.chunks.select(*topk.KEY, "dl", F.explode(lexical.counted_tokens(F.col("tokens"))).alias("p"))
    counted = each.select("p.term", *topk.KEY, "dl", "p.tf").join(F.broadcast(spread), "term", "left")
    salt = F.pmod(F.xxhash64(*topk.KEY), F.coalesce("salts", F.lit(1).cast("long"))).cast("int")
    dealt = counted.select("term", salt.alias("salt"), *topk.KEY, "dl", "tf").repartitionByRange("term", "salt")
    keys = index.doc_len.groupBy(*topk.KEY, "dl").count()
    if not keys.filter("count > 1").isEmpty():  # rows of one key and length are one chunk; they are dealt to one task already
        dealt = dealt.groupBy("term", "salt", *topk.KEY, "dl").agg(F.sum("tf").alias("tf"))
    # One number as the order of so many rows; the terms, fewer and as blocks, are put in order after that.
    grouped = dealt.select(
        F.xxhash64("term", "salt").alias("group"),
        "term", "salt", *topk.KEY, impact(F.col("tf"), F.col("dl"), avgdl, kind).alias("impact"),
    ).sortWithinPartitions("group")
    blocks = grouped.mapInArrow(_cut, BLOCKS).sortWithinPartitions("term", "salt", "block_no")
    blocks.write.parquet(f"{path}/blocks")
    best = spark.read.parquet(f"{path}/blocks").groupBy("term").agg(F.max("best").alias("best"))
    _sorted(stats.join(best, "term"), "term").write.parquet(f"{path}/terms")
    meta = spark.range(1).select(
        F.lit(mode).alias("mode"), F.lit(kind).alias("kind"), F.lit(parts).alias("parts"), F.lit(avgdl).alias("avgdl")
    )
    meta.write.parquet(f"{path}/meta")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of postings that come in order of ``group``. A task holds a batch and what came before of its first group, a salt of a term."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column("group").to_numpy()
        last = int(np.searchsorted(group, group[-1]))
        if held and (last or group[0] != held[-1].column("group")[0].as_py()):
            yield _blocks(pa.Table.from_batches([*held, batch.slice(0, last)]))
            held = []
        elif last:
            yield _blocks(pa.Table.from_batches([batch.slice(0, last)]))
        held.append(batch.slice(last))
    if held:
        yield _blocks(pa.Table.from_batches(held))


def _blocks(rows: pa.Table) -> pa.RecordBatch:
    """Blocks of whole groups, each in order of falling impact; terms that share a number are told apart."""
    rows = rows.combine_chunks()
    term = rows["term"].combine_chunks().dictionary_encode()
    salt, group, impacts = (rows[c].to_numpy() for c in ("salt", "group", "impact"))
    code = term.indices.to_numpy().astype(np.int64)
    keys = [rows[c].combine_chunks() for c in topk.KEY]
    # A null key comes first, as it does in Spark.
    order = [k for c in reversed(keys) for k in (c.fill_null(0).to_numpy(), c.is_valid().to_numpy(zero_copy_only=False))]
    order = np.lexsort((*order, -impacts, salt, code, group))
    salt, code = salt[order], code[order]
    first = np.concatenate([[True], (code[1:] != code[:-1]) | (salt[1:] != salt[:-1])])
    starts = np.flatnonzero(first)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    at = np.flatnonzero(place % BLOCK == 0)
    ends = pa.array(np.append(at, len(order)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, c.take(pa.array(order))) for c in (*keys, rows["impact"].combine_chunks())]
    own = [term.dictionary.take(pa.array(code[at])), pa.array(salt[at]), pa.array((place[at] // BLOCK).astype(np.int32))]
    return pa.RecordBatch.from_arrays([*own, pa.array(impacts[order[at]]), *lists], names=BLOCKS_NAMES)


def _sorted(df: DataFrame, first: str, *others: str) -> DataFrame:
    return df.repartitionByRange(first).sortWithinPartitions(first, *others)


def load(spark: SparkSession, path: str) -> Postings:
    meta = spark.read.parquet(f"{path}/meta").first()
    blocks, terms = (spark.read.parquet(f"{path}/{t}") for t in ("blocks", "terms"))
    return Postings(blocks, terms, lexical.load_chunks(spark, f"{path}/chunks"), meta["mode"], meta["kind"], meta["parts"], meta["avgdl"])


@dataclass(frozen=True)
class Asked:
    """Terms of the questions that occur (query_id, term, weight, bound, others, theta, essential, weak), and their blocks."""

    terms: DataFrame
    blocks: DataFrame

    @property
    def needed(self) -> DataFrame:
        """Blocks of essential terms that can reach the threshold, with the query's columns."""
        reach = F.col("weight") * F.col("best") + F.col("others")
        return self.blocks.join(self.terms.filter("essential"), "term").filter(
            F.col("theta").isNull() | (reach >= F.col("theta"))
        )


def _small(df: DataFrame, fits: bool) -> DataFrame:
    return F.broadcast(df) if fits else df


def _pushed(df: DataFrame, terms: list[str] | None) -> DataFrame:
    return df if terms is None else df.filter(F.col("term").isin(terms))


def _exploded(blocks: DataFrame, *keep: str) -> DataFrame:
    each = blocks.select(*keep, F.explode(F.arrays_zip("docs", "chunk_nos", "impacts")).alias("p"))
    return each.select(*keep, F.col("p.docs").alias("doc_id"), F.col("p.chunk_nos").alias("chunk_no"), F.col("p.impacts").alias("impact"))


def _kth(scored: DataFrame, k: int, score: str) -> DataFrame:
    """(query_id, kth): the k-th best score of the queries that have so many."""
    best = Window.partitionBy("query_id").orderBy(F.desc(score))
    top = scored.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= k)
    return top.groupBy("query_id").agg(F.when(F.count("*") == k, F.min(score)).alias("kth"))


def ask(queries: DataFrame, index: Postings, k: int) -> Asked:
    """The asked terms with bounds and threshold. Written to the shared folder: they are read several times, and are small
    beside the postings."""
    size = topk.measure(queries, F.char_length("query"))
    asked = materialise(lexical.query_terms(queries, index.mode), "asked-terms")
    distinct = asked.select("term").distinct().limit(MAX_TERMS + 1).collect() if size.fits else []
    names = [r["term"] for r in distinct] if distinct and len(distinct) <= MAX_TERMS else None
    known = _pushed(index.terms, names).join(_small(asked, size.fits), "term")
    weight = F.col("qtf") * (F.col("idf") if index.impact == BM25 else F.lit(1.0))
    terms = materialise(
        known.select("query_id", "term", weight.alias("weight"), F.greatest(weight * F.col("best"), F.lit(0.0)).alias("bound")),
        "asked-bounds",
    )
    blocks = _pushed(index.blocks, names)
    first = blocks.filter("salt = 0 and block_no = 0").join(_small(terms, size.fits), "term")
    reached = (
        _exploded(first, "query_id", "weight")
        .groupBy("query_id", *topk.KEY)
        .agg(F.sum(F.col("weight") * F.col("impact")).alias("part_score"))
    )
    theta = _kth(reached, k, "part_score").select("query_id", (F.col("kth") * (1 - SLACK)).alias("theta"))
    mine = Window.partitionBy("query_id")
    upward = mine.orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A term of negative weight lowers scores that the first blocks do not show: no threshold then.
    fair = F.when(F.min("weight").over(mine) >= 0, F.col("theta"))
    bounded = terms.join(theta, "query_id", "left").select(
        "query_id", "term", "weight", "bound",
        fair.alias("theta"),
        (F.sum("bound").over(mine) - F.col("bound")).alias("others"),
        F.sum("bound").over(upward).alias("upto"),
    )
    essential = F.col("theta").isNull() | (F.col("upto") >= F.col("theta"))
    out = bounded.withColumn("essential", essential).withColumn(
        "weak", F.coalesce(F.sum(F.when(~F.col("essential"), F.col("bound"))).over(mine), F.lit(0.0))
    )
    out = materialise(out, "asked")
    return Asked(_small(out, size.fits), blocks)


def search(queries: DataFrame, index: Postings, k: int = 5) -> DataFrame:
    """RANKED by the summed impacts of a question's terms, times their weights; positive scores only.

    Equal to ``lexical.bm25_search`` (``keyword_search`` for an index of counts) over the same chunks. A question whose terms do
    not occur has no rows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    asked = ask(queries, index, k)
    partial = (
        _exploded(asked.needed, "query_id", "weight", "theta", "weak")
        .groupBy("query_id", "theta", "weak", *topk.KEY)
        .agg(F.sum(F.col("weight") * F.col("impact")).alias("part_score"))
    )
    seen = materialise(partial.filter(F.col("theta").isNull() | (F.col("part_score") + F.col("weak") >= F.col("theta"))), "candidates")
    # The k-th best of these parts is a threshold that is no lower.
    kth = _kth(seen.filter(F.col("theta").isNotNull()), k, "part_score")
    open_ones = seen.join(kth, "query_id", "left").filter(
        F.col("kth").isNull() | (F.col("part_score") + F.col("weak") >= F.col("kth") * (1 - SLACK))
    )
    open_ones = materialise(open_ones.select("query_id", *topk.KEY), "open-candidates")
    each = F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("asked")
    questions = asked.terms.groupBy("query_id").agg(each)
    stored = topk.only_parts(index.chunks, open_ones, index.parts).select(*topk.KEY, "tokens", "dl")
    token_count = lambda t: F.size(F.filter("tokens", lambda x: x == t["term"]))
    exact = F.aggregate(
        "asked", F.lit(0.0), lambda s, t: s + t["weight"] * impact(token_count(t), F.col("dl"), index.avgdl, index.impact)
    )
    scored = (
        open_ones.join(stored, topk.KEY)
        .join(questions, "query_id")
        .select("query_id", *topk.KEY, topk.significant_column(exact).alias("score"))
        .filter("score > 0")
    )
    found = materialise(topk.limit(scored, k), "found")
    rows = topk.only_parts(index.chunks, found, index.parts).select(*topk.KEY, *topk.CARRY)
    return rows.join(found, topk.KEY).select("query_id", "rank", *topk.KEY, *topk.CARRY, "score")


def reading(queries: DataFrame, index: Postings, k: int = 5) -> DataFrame:
    """(query_id, postings_blocks, blocks_read): blocks of a question's terms, and those that a search has to read."""
    asked = ask(queries, index, k)
    every = asked.blocks.join(asked.terms, "term").groupBy("query_id").agg(F.count("*").alias("postings_blocks"))
    read = asked.needed.groupBy("query_id").agg(F.count("*").alias("blocks_read"))
    return every.join(read, "query_id", "left").select(
        "query_id", "postings_blocks", F.coalesce("blocks_read", F.lit(0)).cast("long").alias("blocks_read")
    )
