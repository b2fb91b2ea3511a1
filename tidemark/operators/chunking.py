"""Documents to paragraphs, chunks and sentences.

Input is one row per document (doc_id, source, text). A document is cut inside
its own row and exploded, so chunk numbers need no window and no shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X


def paragraphs(docs: DataFrame, sep: str = "\n\n") -> DataFrame:
    """One row per non-blank paragraph, numbered from 1."""
    return docs.select(
        "doc_id", F.posexplode(X.paragraph_array(F.col("text"), sep)).alias("pos", "paragraph")
    ).select("doc_id", (F.col("pos") + 1).alias("para_no"), "paragraph")


def chunk_words(docs: DataFrame, size: int = 80, overlap: int = 15, sep: str = "\n\n") -> DataFrame:
    """Word-window chunks; short paragraphs are kept verbatim. Numbered from 1."""
    windows = X.word_windows(X.paragraph_array(F.col("text"), sep), size, overlap)
    return _chunks(docs, windows, first=1, label="chunk-%03d")


def chunk_chars(
    docs: DataFrame, size: int = 500, overlap: int = 100, normalise: str = "flat"
) -> DataFrame:
    """Character-window chunks, numbered from 0.

    ``flat`` turns all white space into single blanks first, ``paragraph``
    keeps line and paragraph breaks.
    """
    if normalise == "flat":
        clean, label = X.flatten_whitespace(F.col("text")), "chunk_%d"
    elif normalise == "paragraph":
        clean, label = X.tidy_paragraphs(F.col("text")), "chunk_%04d"
    else:
        raise ValueError(f"normalise must be 'flat' or 'paragraph', not {normalise!r}")
    return _chunks(docs, X.char_windows(clean, size, overlap), first=0, label=label)


def sentences(rows: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """One row per sentence of ``text``, numbered from 1 within its row."""
    return rows.select(*keys, F.posexplode(X.sentence_array(F.col(text))).alias("pos", "sentence")).select(
        *keys, (F.col("pos") + 1).alias("sentence_no"), "sentence"
    )


def preview(chunks: DataFrame, n: int = 5, width: int = 200) -> DataFrame:
    """The first ``n`` chunks in corpus order, their text cut for display."""
    first = chunks.orderBy("doc_id", "chunk_no").limit(n)
    return first.withColumn("text", F.substring("text", 1, width))


def document_sizes(docs: DataFrame) -> DataFrame:
    """Documents, blank documents, characters and words in one pass."""
    body = F.col("text")
    blank = F.coalesce(X.strip(body), F.lit("")) == ""
    return docs.agg(
        F.count("*").alias("documents"),
        F.count_if(blank).alias("blank_documents"),
        F.coalesce(F.sum(F.char_length(body)), F.lit(0)).cast("bigint").alias("characters"),
        F.coalesce(F.sum(F.size(X.words(body))), F.lit(0)).cast("bigint").alias("words"),
    )


def _chunks(docs: DataFrame, windows: Column, first: int, label: str) -> DataFrame:
    number = (F.col("pos") + first).cast("int")
    return docs.select("doc_id", "source", F.posexplode(windows).alias("pos", "text")).select(
        "doc_id",
        number.alias("chunk_no"),
        F.format_string(label, number).alias("chunk_id"),
        "source",
        "text",
    )
