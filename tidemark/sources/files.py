"""JSON Lines, text documents and keyed messages."""

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.schemas import CHUNK, LINEAGE, MESSAGE, ORDER
from tidemark.session import exists, local_folder, remove, work_folder


# Files of a folder of documents.
FOLDER_FILES = 10_000
# Files whose folders are listed and read at once, about: the driver keeps each one's name and size meanwhile.
LISTED_FILES = 50_000
# Tasks a core that read documents at least, and partitions of files that such a task takes otherwise.
READ_TASKS, READ_PARTS = 8, 256


class EmptyInputError(Exception):
    """A step that needs input found none."""


class RepeatedIdError(Exception):
    """Two files would be one document."""


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Raw orders, one JSON object per line."""
    return spark.read.schema(ORDER).json(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages kept as text, one per line; the batch form of the stream."""
    return spark.read.text(path)


def write_documents(rows: DataFrame, path: str, key: str, text: str) -> None:
    """One text file for each value of ``key``, null among them, with the texts of its rows, each ended by a line feed.

    Files share folders ``of=<n>`` of some thousands, as a folder for each costs a listing each. Tasks commit their
    own files, so that the driver does not rename them one after the other. Into a local folder tasks write them
    without Hadoop, which starts ``chmod`` for each file and for its checksum file.
    """
    spark = rows.sparkSession
    counted = rows.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    keys = counted.agg(F.count("*").alias("files"), F.max("n").alias("most")).first()
    value = F.coalesce(F.col(text), F.lit(""))
    if (keys["most"] or 1) > 1:
        whole = rows.groupBy(F.col(key).alias("key")).agg(F.array_join(F.sort_array(F.collect_list(value)), "\n").alias("value"))
    else:  # no texts to bring together, so none are shuffled
        whole = rows.select(F.col(key).alias("key"), value.alias("value"))
    parts = max(1, -(-keys["files"] // FOLDER_FILES))
    dealt = whole.select("key", "value", F.pmod(F.xxhash64("key"), F.lit(parts)).alias("of"))
    if not (folder := local_folder(spark, path)):
        each = dealt.select("value", "of").write.option("maxRecordsPerFile", 1)
        each.option("mapreduce.fileoutputcommitter.algorithm.version", 2).partitionBy("of").text(path)
        return
    if exists(spark, path):
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path {path} already exists.")
    # Each attempt of a task meets its documents in the same order and so gives a text the same name.
    ordered = dealt.sortWithinPartitions("key").select(F.col("value").cast("binary").alias("value"), "of")
    ordered.mapInArrow(_file_writer(folder, str(uuid.uuid4())), "files long").agg(F.sum("files")).collect()
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    done.getFileSystem(spark._jsc.hadoopConfiguration()).create(done, True).close()


def _file_writer(folder: str, job: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that writes each ``value`` as a file, named as Spark's text writer does, and counts them.

    A file gets its name when it is whole; until then it has one that Spark's readers pass over.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, n, made = TaskContext.get(), 0, set()
        for batch in batches:
            for value, of in zip(batch.column("value"), batch.column("of").to_pylist(), strict=True):
                if of not in made:
                    os.makedirs(f"{folder}/of={of}", exist_ok=True)
                    made.add(of)
                name = f"part-{context.partitionId():05d}-{job}.c{n:03d}.txt"
                half = f"{folder}/of={of}/.{name}.{context.taskAttemptId()}"
                with open(half, "wb") as file:
                    file.write(value.as_buffer())
                    file.write(b"\n")
                os.replace(half, f"{folder}/of={of}/{name}")
                n += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    return task


def _dealt_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders ``<name>=<value>`` of a folder that holds nothing else, or none."""
    jvm = spark._jvm.org.apache.hadoop.fs
    top = jvm.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    found, beside = [list(fs.globStatus(jvm.Path(top, names)) or []) for names in ("[!_.]*=*", "[_.]*")]
    names, passed_over = [[f.getPath().getName() for f in some] for some in (found, beside)]
    alone = len(found) + len(beside) == len(fs.listStatus(top)) and all(f.isDirectory() for f in found)
    alone = alone and all(n[0] == "." or n in ("_SUCCESS", "_temporary") for n in passed_over) and len({n.split("=")[0] for n in names}) == 1
    if not alone or any(set(n) & set("{}[]*?\\") or n.endswith("._COPYING_") for n in names):
        return []
    return [f.getPath().toString() for f in found]


def _in_fewer_tasks(rows: DataFrame) -> DataFrame:
    """Rows of files in fewer tasks: a partition of small files holds a few dozen at most, whose reading costs less than its task."""
    tasks = READ_TASKS * rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(tasks, rows.rdd.getNumPartitions() // READ_PARTS))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, source, text): each text file as one string, blank files left out.

    The id is a 64-bit hash of the full path, so it does not depend on file
    order. Should two paths share one, nothing is returned but an error.

    Each file is opened once and kept in the shared folder, in a few large files. Folders ``<name>=<value>`` are read
    some at a time, as the driver lists all files of a read.
    """
    kept, folders, at_once = work_folder(spark, "documents"), _dealt_folders(spark, path), max(1, LISTED_FILES // FOLDER_FILES)
    reader = spark.read.option("basePath", path) if folders else spark.read
    left = folders or [path]
    while left:
        some, left = left[:at_once], left[at_once:]
        rows = reader.text(some, wholetext=True).select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("source"), F.col("value").alias("text")
        )
        seen = Observation()
        _in_fewer_tasks(rows).observe(seen, F.count("*").alias("files")).write.mode("append").option("compression", "zstd").parquet(kept)
        if seen.get["files"] > LISTED_FILES:
            at_once = max(1, at_once // 2)
        elif seen.get["files"] <= LISTED_FILES // 2:
            at_once *= 2
    read = spark.read.schema("path string, source string, text string").parquet(kept).withColumn("doc_id", F.xxhash64("path"))
    shared = read.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").first()
    if shared:
        two = read.filter(F.col("doc_id") == shared["doc_id"]).agg(F.min("path").alias("one"), F.max("path").alias("other")).first()
        remove(spark, kept)
        raise RepeatedIdError(f"{two['one']} and {two['other']} have the id {shared['doc_id']}")
    return read.select("doc_id", "source", "text").filter(X.strip(F.col("text")) != "")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks as JSON Lines; blank lines are skipped, no chunk at all is an error."""
    chunks = spark.read.schema(CHUNK).json(path)
    if chunks.isEmpty():
        raise EmptyInputError(f"no chunks in {path}")
    return chunks


def write_chunks(chunks: DataFrame, path: str) -> None:
    chunks.select(*CHUNK.fieldNames()).write.mode("overwrite").json(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINEAGE).json(path)


def write_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish keyed messages. Needs the Kafka connector on the class path."""
    messages.select(*MESSAGE.fieldNames()).write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).option("topic", topic).save()


def stream_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    offsets_per_batch: int | None = 10_000_000,
    least_splits: int | None = None,
    fail_on_loss: bool = True,
) -> DataFrame:
    """Messages of a topic from its first offset, in batches of bounded size.

    ``least_splits`` reads a topic of few partitions with more tasks. Offsets
    that the broker no longer has end the stream, unless the caller accepts
    the loss. Needs the Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", fail_on_loss)
    )
    if offsets_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
    if least_splits:
        reader = reader.option("minPartitions", least_splits)
    return reader.load().select("key", "value")


def stream_files(
    spark: SparkSession, path: str, files_per_batch: int | None = 1000, with_file: bool = False, skip_unreadable: bool = False
) -> DataFrame:
    """Messages that arrive as text files, one per line, in batches of bounded size; with ``with_file`` beside
    the path of their file, for counts.

    A file that cannot be read ends the stream. Only if ``skip_unreadable`` is asked for is it passed over, from the first fault on;
    ``ingest.unread_files`` then tells which files gave nothing.
    """
    reader = spark.readStream.option("ignoreCorruptFiles", skip_unreadable)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file")) if with_file else lines
