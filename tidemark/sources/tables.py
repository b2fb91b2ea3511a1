"""Tables that are replaced or merged while others read them.

A table is a folder of parquet versions, ``<path>/version=<n>``. The newest
one that is marked as complete is the table. Parquet cannot be overwritten
while it is read, so every refresh and merge writes the next version, compares
what can be read back, and only then marks it. What a failed write leaves is
passed over, by readers and by the numbering.

A table that takes many small batches is dealt into folders by a hash of its key
instead (``merge_parts``): a batch reads and rewrites the folders of its own keys
alone, with Spark's dynamic partition overwrite and its committer.
"""

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import Check, enforce, measures, require_gate, results
from tidemark.operators.sales import upsert
from tidemark.session import exists, materialise, remove, work_folder

# Folders of a table that is merged by parts, unless the caller chooses.
PARTS = 64

DONE = "_SUCCESS"


class TableNotFoundError(Exception):
    """There is no complete version under the path."""


class RepeatedKeyError(Exception):
    """A batch to be merged has several rows for one key."""


class WriteCheckError(Exception):
    """What was read back is not what was written."""


def _folders(spark: SparkSession, path: str, name: str) -> dict[int, bool]:
    """Numbers of the folders ``<name>=<n>`` under a path, and which are complete."""
    jvm = spark._jvm.org.apache.hadoop.fs
    folder = jvm.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return {}
    out = {}
    for status in fs.listStatus(folder):
        found = status.getPath().getName().split("=", 1)
        if found[0] == name and found[-1].isdigit():
            out[int(found[1])] = fs.exists(jvm.Path(status.getPath(), DONE))
    return out


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, oldest first."""
    return sorted(n for n, done in _folders(spark, path, "version").items() if done)


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, version: int | None = None
) -> DataFrame:
    """The newest version, or the one asked for."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise TableNotFoundError(f"{path} version {version if version is not None else 'any'}")
    return spark.read.schema(schema).parquet(f"{path}/version={known[-1] if version is None else version}")


@dataclass(frozen=True)
class Prepared:
    """A version that is written and not yet the table, and the counts of its expectations."""

    path: str
    number: int
    schema: T.StructType
    checks: tuple[Check, ...]
    counts: dict[str, int]

    @property
    def folder(self) -> str:
        return f"{self.path}/version={self.number}"

    def results(self, spark: SparkSession) -> DataFrame:
        """One row per expectation, as ``run_expectations`` gives them, without reading the rows again."""
        names = [f"{name} long" for name in self.counts]
        return results(spark.createDataFrame([tuple(self.counts.values())], ", ".join(names)), self.checks)


def prepare_table(df: DataFrame, path: str, schema: T.StructType, checks: tuple[Check, ...] = ()) -> Prepared:
    """Write ``df`` as the next version without making it the table; ``publish`` does that.

    The expectations are counted while the rows are written: Spark's observed metrics of the writing tasks, of which each
    partition counts once however often it is tried. The batch is checked against the schema before anything is written.
    """
    spark = df.sparkSession
    fitting = enforce(df, schema)
    number = max(_folders(spark, path, "version"), default=0) + 1
    written = Observation()
    fitting.observe(written, *measures(checks)).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", False
    ).parquet(f"{path}/version={number}")
    return Prepared(path, number, schema, checks, written.get)


def publish(spark: SparkSession, made: Prepared, check: Callable[[DataFrame], None] | None = None) -> int:
    """Compare the rows that can be read back with those written, and only then mark the version as complete; its number.

    ``check`` may look at what was written, too, and raise.
    """
    there = spark.read.schema(made.schema).parquet(made.folder)
    found = there.count()
    if found != made.counts["rows"]:
        raise WriteCheckError(f"{made.folder}: wrote {made.counts['rows']} rows, found {found}")
    if check:
        check(there)
    done = spark._jvm.org.apache.hadoop.fs.Path(made.folder, DONE)
    done.getFileSystem(spark._jsc.hadoopConfiguration()).create(done, True).close()
    return made.number


def replace_table(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    keep: int | None = None,
    check: Callable[[DataFrame], None] | None = None,
    checks: tuple[Check, ...] = (),
) -> int:
    """Write ``df`` as the next version and return its number.

    The batch is checked against the schema before anything is written, and by ``checks``, expectations counted
    while it is written, and ``check`` before the version becomes the table; if one fails, the table keeps the version it had.
    With ``keep``, only so many complete versions stay; a reader of an older one fails.
    """
    spark = df.sparkSession
    made = prepare_table(df, path, schema, checks)
    if checks:
        require_gate(made.results(spark))
    publish(spark, made, check)
    if keep:
        for old in versions(spark, path)[:-keep]:
            remove(spark, f"{path}/version={old}")
    return made.number


@contextmanager
def _held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` in files that are removed when the work with them is done."""
    path = work_folder(df.sparkSession, name)
    try:
        yield materialise(df, name, path)
    finally:
        remove(df.sparkSession, path)


def _one_row_per_key(batch: DataFrame, keys: list[str]) -> None:
    repeated = batch.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").first()
    if repeated:
        raise RepeatedKeyError(f"{[repeated[k] for k in keys]} has {repeated['n']} rows")


def prepare_upsert(
    source: DataFrame, path: str, keys: list[str], schema: T.StructType, checks: tuple[Check, ...] = ()
) -> Prepared:
    """``source`` merged by ``keys`` into the table, or the first version of it, written but not yet the table.

    A source with several rows for a key is refused. Applying the same source
    again changes nothing, so a repeated batch is harmless.
    """
    spark = source.sparkSession
    fitting = enforce(source, schema)
    # The batch is read three times. From files it is computed once, and
    # Catalyst knows its size when it picks the join: a batch below the
    # broadcast threshold leaves the table where it is, a larger one shuffles.
    with _held(fitting, "merge-batch") as batch:
        _one_row_per_key(batch, keys)
        merged = upsert(read_table(spark, path, schema), batch, keys) if table_exists(spark, path) else batch
        return prepare_table(merged, path, schema, checks)


def upsert_table(source: DataFrame, path: str, keys: list[str], schema: T.StructType) -> int:
    """``prepare_upsert``, made the table at once; the number of the version."""
    return publish(source.sparkSession, prepare_upsert(source, path, keys, schema))


def _part(parts: int, keys: list[str], columns: list[str]) -> Column:
    """Folder of a row. Rows with a null key match nothing and are dealt by all their columns, so that they do not meet in one."""
    null_key = reduce(or_, [F.col(k).isNull() for k in keys])
    return F.pmod(F.when(null_key, F.xxhash64(*columns)).otherwise(F.xxhash64(*keys)), F.lit(parts)).cast("int")


def merge_parts(source: DataFrame, path: str, keys: list[str], schema: T.StructType, parts: int = PARTS) -> list[int]:
    """Merge ``source`` by ``keys`` into a table of folders ``of_<parts>=<n>``, or create it; the numbers of the folders written.

    Only the folders that the keys of the source fall into are read and replaced. The merged rows are first written beside
    the table, complete, as Spark's committer marks them; if replacing the folders then fails, the next merge does that again before
    its own work, so no row is lost and a repeated source changes nothing. One writer at a time; a reader beside it may see
    some folders before and some after. A source with several rows for a key is refused, as is another number of parts.
    """
    spark, name = source.sparkSession, f"of_{parts}"
    pending = f"{path.rstrip('/')}_pending"
    if exists(spark, f"{pending}/{DONE}"):
        _replace_parts(spark, pending, path, schema, name)
    remove(spark, pending)
    there = exists(spark, path)
    if there and name not in spark.read.parquet(path).columns:
        raise ValueError(f"{path} is not dealt into {parts} parts")
    with _held(enforce(source, schema), "merge-batch") as batch:
        _one_row_per_key(batch, keys)
        dealt = batch.withColumn(name, _part(parts, keys, schema.fieldNames()))
        numbers = sorted(r[0] for r in dealt.select(name).distinct().collect())  # no more than there are parts
        if not numbers:
            return []
        merged = batch
        if there:
            stored = spark.read.schema(_with(schema, name)).parquet(path)
            touched = stored.filter(F.col(name).isin(numbers)).select(*schema.fieldNames())
            merged = upsert(touched, batch, keys)
        merged = merged.withColumn(name, _part(parts, keys, schema.fieldNames()))
        merged.repartition(name).write.option("compression", "zstd").partitionBy(name).parquet(pending)
    _replace_parts(spark, pending, path, schema, name)
    remove(spark, pending)
    return numbers


def _replace_parts(spark: SparkSession, pending: str, path: str, schema: T.StructType, name: str) -> None:
    # The rows lie in files of one folder each already: copied as they are read, they need no second shuffle.
    rows = spark.read.schema(_with(schema, name)).parquet(pending)
    copied = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    copied.partitionBy(name).parquet(path)


def _with(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, T.IntegerType())])


def read_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that ``merge_parts`` keeps."""
    if not exists(spark, path):
        raise TableNotFoundError(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def merge_into(source: DataFrame, table: str, keys: list[str]) -> None:
    """The same merge in place, for a catalog table whose format merges rows
    itself; only the touched files are rewritten there."""
    match = " AND ".join(f"{table}.{k} = source.{k}" for k in keys)
    (
        source.alias("source")
        .mergeInto(table, F.expr(match))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
