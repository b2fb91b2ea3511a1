"""Streaming ingest: messages to valid orders and quarantine, and to silver.

Both jobs stop once everything available has been read, and continue from the
checkpoint at the next start. A batch may be repeated after a failure, so each
writes to a place named after its query and number, or merges by key, which a
repeated batch does not change. Queries are told apart by the id in their checkpoint, so a second
query that numbers its batches from 0 again overwrites nothing.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.contract import apply_contract, split_valid
from tidemark.operators.sales import add_total, dedupe_latest
from tidemark.schemas import SILVER
from tidemark.session import remove, work_folder
from tidemark.sources.tables import merge_parts


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that owns a checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_ingest(
    messages: DataFrame, checkpoint: str, valid_dir: str, quarantine_dir: str, counts_dir: str | None = None
) -> StreamingQuery:
    """Route each message of the stream to exactly one of two JSON folders.

    With ``counts_dir``, each batch also leaves (file, received, valid, quarantined), one row for each file it has read, or
    one with a null file if the stream has no column ``file``. A repeated batch replaces its counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = query_id(batch.sparkSession, checkpoint)
        sent = batch.select("value", *[c for c in batch.columns if c == "file" and counts_dir])
        route(sent, valid_dir, quarantine_dir, f"query={query}/batch={batch_id}", "overwrite", counts_dir)

    return _start(messages, checkpoint, write)


def route(
    messages: DataFrame,
    valid_dir: str,
    quarantine_dir: str,
    part: str = "",
    mode: str = "append",
    counts_dir: str | None = None,
) -> None:
    """Check messages once and write both sides.

    The checked rows are written to the shared folder in two parts, one per
    side; each output is a copy of its part, so nothing is parsed twice and nothing is held by executors.
    Counts are taken from that copy, too: two small columns of it. The JSON is compressed, as refused messages stand in it twice.
    """
    spark = messages.sparkSession
    path = work_folder(spark, "checked")
    apply_contract(messages).write.partitionBy("is_valid").parquet(path)
    schema = apply_contract(messages.limit(0)).schema
    checked = spark.read.schema(schema).parquet(path)
    valid, quarantine = split_valid(checked)
    for df, folder in ((valid, valid_dir), (quarantine, quarantine_dir)):
        df.write.mode(mode).option("ignoreNullFields", False).option("compression", "gzip").json(f"{folder}/{part}".rstrip("/"))
    if counts_dir:
        file = F.col("file") if "file" in messages.columns else F.lit(None).cast("string").alias("file")
        counted = checked.select(file, "is_valid").groupBy("file").agg(
            F.count("*").alias("received"), F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("quarantined")
        )
        counted.write.mode(mode).parquet(f"{counts_dir}/{part}".rstrip("/"))
    remove(spark, path)


COUNTS = "file string, received long, valid long, quarantined long, query string, batch long"


def read_counts(spark: SparkSession, counts_dir: str) -> DataFrame:
    """Counts of all batches, with the query and number of each."""
    return spark.read.schema(COUNTS).parquet(counts_dir)


def unread_files(spark: SparkSession, path: str, counts: DataFrame) -> DataFrame:
    """(file, length): files under ``path`` that hold something and gave no message to ``counts``. Their content is not read."""
    found = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), "length")
    return found.filter("length > 0").join(counts.select("file").distinct(), "file", "left_anti")


def start_upsert(messages: DataFrame, checkpoint: str, silver_path: str) -> StreamingQuery:
    """Merge the valid orders of each batch into the silver table.

    A batch reads and writes the folders that its keys fall into; ``tables.read_parts`` reads the table, which belongs to one query.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        valid, _ = split_valid(apply_contract(batch.select("value")))
        merge_parts(dedupe_latest(add_total(valid), ["order_id"]), silver_path, ["order_id"], SILVER)

    return _start(messages, checkpoint, write)


def _start(messages: DataFrame, checkpoint: str, write) -> StreamingQuery:
    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
