"""Expectations, the gate, and schema enforcement."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    """One expectation on a column: ``not_null``, or ``between`` inclusive bounds."""

    column: str
    kind: str
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"

    def missing(self) -> Column:
        return F.col(self.column).isNull()

    def unexpected(self) -> Column:
        if self.kind == "not_null":
            return self.missing()
        # A null is missing, not out of range.
        return F.coalesce(~F.col(self.column).between(self.low, self.high), F.lit(False))


def not_null(column: str) -> Check:
    return Check(column, "not_null")


def between(column: str, low: float, high: float) -> Check:
    return Check(column, "between", low, high)


# The expectations on silver orders.
SILVER_CHECKS = (
    not_null("order_id"),
    between("quantity", 1, 1000),
    between("price", 0.01, 1000000),
)


# Groups in which the rows of one check are limited first.
SALTS = 32


class QualityGateError(Exception):
    """A batch failed one of its expectations."""


class SchemaMismatchError(Exception):
    """A batch does not fit the table it is written to."""


def measures(checks: tuple[Check, ...] = SILVER_CHECKS) -> list[Column]:
    """The counts that ``results`` needs, as aggregates: of a whole table, or observed on rows that are being written."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(checks):
        aggs.append(F.count_if(c.missing()).alias(f"missing_{i}"))
        aggs.append(F.count_if(c.unexpected()).alias(f"unexpected_{i}"))
    return aggs


def results(counted: DataFrame, checks: tuple[Check, ...] = SILVER_CHECKS) -> DataFrame:
    """One row per check from the row of ``measures``."""
    n = F.col("rows")
    rows = []
    for i, c in enumerate(checks):
        missing, bad = F.col(f"missing_{i}"), F.col(f"unexpected_{i}")
        judged = n if c.kind == "not_null" else n - missing
        rows.append(
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.lit(c.column).alias("column_name"),
                n.alias("element_count"),
                missing.alias("missing_count"),
                bad.alias("unexpected_count"),
                F.when(judged > 0, F.lit(100.0) * bad / judged).otherwise(0.0).alias(
                    "unexpected_percent"
                ),
                (bad == 0).alias("success"),
            )
        )
    return counted.select(F.inline(F.array(*rows)))


def run_expectations(df: DataFrame, checks: tuple[Check, ...] = SILVER_CHECKS) -> DataFrame:
    """One row per check, all of them measured in one pass over ``df``."""
    return results(df.agg(*measures(checks)), checks)


def gate(results: DataFrame) -> DataFrame:
    """One row: whether every check passed, and how many did not."""
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("passed"),
        F.count_if(~F.col("success")).alias("failed_checks"),
    )


def require_gate(results: DataFrame) -> None:
    """Raise when a check failed, so that nothing after the gate runs."""
    # One row per check: as small as the list of checks.
    failed = [r["check_name"] for r in results.filter(~F.col("success")).collect()]
    if failed:
        raise QualityGateError("failed checks: " + ", ".join(sorted(failed)))


def failing_rows(
    df: DataFrame, checks: tuple[Check, ...], key: str, n: int = 20
) -> DataFrame:
    """The first ``n`` rows by ``key`` that break each check, from one pass.

    There are few checks, so the rows of one are limited within salted groups
    first; no task takes what every task has found for a check.
    """
    failed = [
        F.when(
            c.unexpected(),
            F.struct(
                F.lit(c.name).alias("check_name"), F.col(c.column).cast("string").alias("observed")
            ),
        )
        for c in checks
    ]
    hits = df.select(F.col(key), F.explode(F.array_compact(F.array(*failed))).alias("f")).select(
        "f.check_name", key, "f.observed"
    )
    hits = hits.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))

    def first(rows: DataFrame, *groups: str) -> DataFrame:
        w = Window.partitionBy(*groups).orderBy(key, "observed")
        return rows.withColumn("sample_no", F.row_number().over(w)).filter(F.col("sample_no") <= n)

    return first(first(hits, "check_name", "_salt").drop("sample_no", "_salt"), "check_name")


# Casts that lose nothing.
_WIDENS = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}


def schema_mismatches(batch: T.StructType, table: T.StructType) -> list[tuple[str, str, str, str]]:
    """(column, problem, expected, found) for everything that does not fit."""
    found = {f.name: f.dataType for f in batch.fields}
    expected = {f.name: f.dataType for f in table.fields}
    out = []
    for name, want in expected.items():
        if name not in found:
            out.append((name, "missing", want.simpleString(), ""))
            continue
        have = found[name]
        # Compared by name: whether a nested field may be null is not a type.
        same = have.simpleString() == want.simpleString()
        if not same and not isinstance(want, _WIDENS.get(type(have), ())):
            out.append((name, "type", want.simpleString(), have.simpleString()))
    out.extend(
        (name, "unknown", "", have.simpleString())
        for name, have in found.items()
        if name not in expected
    )
    return out


def enforce(batch: DataFrame, table: T.StructType) -> DataFrame:
    """``batch`` in the table's columns and types, or an error before any write."""
    problems = schema_mismatches(batch.schema, table)
    if problems:
        raise SchemaMismatchError(
            "; ".join(f"{c}: {p} (expected {e or 'none'}, found {f or 'none'})" for c, p, e, f in problems)
        )
    return batch.select(*[F.col(f.name).cast(f.dataType) for f in table.fields])


def rejected_batch(batch: DataFrame, table: T.StructType) -> DataFrame:
    """The refusal report: one row per mismatch, with the rows it holds back."""
    report = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(p).alias("problem"),
            F.lit(e).alias("expected"),
            F.lit(f).alias("found"),
        )
        for c, p, e, f in schema_mismatches(batch.schema, table)
    ]
    empty = "array<struct<column_name:string,problem:string,expected:string,found:string>>"
    reported = F.array(*report) if report else F.array().cast(empty)
    return batch.agg(F.count("*").alias("rows_rejected")).select(
        F.inline(reported), "rows_rejected"
    )
