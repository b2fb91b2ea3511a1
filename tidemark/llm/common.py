"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import materialise

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)

#: Rows of whole texts that go to Python at once. Spark's 10,000 rows of long texts would be gigabytes.
TEXT_ROWS = 500


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Let tasks exchange at most ``rows`` rows with Python at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def mapped(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """``function`` over every Arrow batch."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out = function(batch) if batch.num_rows else None
            if out is not None:
                yield out

    return df.mapInArrow(batches, schema)


TEXT = "__text"


def with_text(df: DataFrame, keep: str | StructType, column: str = "text", kind: str = "string") -> DataFrame:
    """Columns of the schema ``keep``, and the column to work on apart from them, under a name of its own."""
    names = _schema(keep).fieldNames()
    return df.select(*[F.col(f"`{c}`") for c in names], F.col(column).cast(kind).alias(TEXT))


def _schema(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def wider(keep: str | StructType, new: str) -> StructType:
    """The schema ``keep`` with new columns."""
    return StructType(_schema(keep).fields + _schema(new).fields)


def added(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """The kept columns of a batch of ``with_text`` and new ones."""
    return pa.record_batch({c: batch.column(c) for c in batch.schema.names if c != TEXT} | columns)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (multiply and shift, wrapping)."""
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again, so that it survives executors."""
    return materialise(df, name)
