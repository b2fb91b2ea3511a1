"""A training corpus in five steps, each of them one operator of ``tidemark.llm``.

Every stage takes (spark, docs, sf_dir) and returns a table; it is written as
Parquet in the shared folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, langid, minhash_dedup, mixing, quality_crf
from tidemark.llm.common import fold, kept, table, text_batches

VOCABULARY = "byte_bpe_50k.json"


def _whole(docs: DataFrame) -> DataFrame:
    """Each row as one struct, ``__row``, beside what the operators read, so that no
    column of ``docs`` can clash with a column that an operator adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "doc_id", "text", "source")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; the others go."""
    text_batches(spark)
    learned = langid.learn(docs.where(fold("doc_id", 3) != 1).select("text", "lang"))
    rows = _whole(docs)
    return langid.predict(rows, learned, rows.select("__row").schema).where("accepted").select("__row.*")


def line_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model takes for good."""
    text_batches(spark)
    chain = quality_crf.learn(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    rows = _whole(docs)
    return quality_crf.score(rows, chain, rows.select("__row").schema).where("predicted = 1").select("__row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    text_batches(spark)
    return minhash_dedup.deduplicated(docs, shingle=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as the mix takes it."""
    mixed = mixing.mix(_whole(docs)).where("copies > 0")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of each row, and digests of its ids and of the text decoded from them."""
    text_batches(spark)
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language ID", language_id),
    ("quality classifier", line_quality),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", encoding),
]

#: No SQL can express compression, the trained line model or the token merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = kept(stage(spark, docs, sf_dir), f"stage-{k + 1}")
    return docs
