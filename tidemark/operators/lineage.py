"""Lineage: run events, the declared stage graph, and edges from events."""

import uuid
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialise
from tidemark.schemas import LINEAGE

NAMESPACE = "order-lakehouse"
PRODUCER = "tidemark"

# Run states, and the datasets each stage reads and writes.
STATES = ("START", "COMPLETE", "FAIL")
STAGES = {
    "producer": ((), ("kafka_orders",)),
    "ingestion": (("kafka_orders",), ("raw_orders",)),
    "bronze": (("raw_orders",), ("bronze_orders",)),
    "silver": (("bronze_orders",), ("silver_orders",)),
    "quality_gate": (("silver_orders",), ("quality_checked_silver",)),
    "gold": (("silver_orders",), ("product_sales",)),
    "lineage": (("silver_orders",), ("product_sales",)),
}


class UnknownStageError(ValueError):
    pass


class UnknownStateError(ValueError):
    pass


def _check(stage: str, state: str) -> None:
    if stage not in STAGES:
        raise UnknownStageError(f"{stage!r} is not one of {sorted(STAGES)}")
    if state not in STATES:
        raise UnknownStateError(f"{state!r} is not one of {STATES}")


def _datasets(names: Sequence[str]) -> list[tuple[str, str]]:
    return [(NAMESPACE, n) for n in names]


def new_run_id() -> str:
    return str(uuid.uuid4())


def run_event(
    spark: SparkSession,
    stage: str,
    state: str,
    run_id: str | None = None,
    inputs: Sequence[str] | None = None,
    outputs: Sequence[str] | None = None,
) -> DataFrame:
    """One event in the LINEAGE schema, at the current time in UTC.

    Datasets default to the declared ones; a START names no outputs.
    """
    _check(stage, state)
    declared_in, declared_out = STAGES[stage]
    ins = declared_in if inputs is None else inputs
    outs = declared_out if outputs is None else outputs
    if state == "START":
        outs = ()
    row = (
        state,
        None,
        (run_id or new_run_id(),),
        (NAMESPACE, stage),
        PRODUCER,
        _datasets(ins),
        _datasets(outs),
    )
    now = F.date_format(
        F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    )
    event = spark.createDataFrame([row], LINEAGE)
    return event.withColumn("eventTime", F.concat(now, F.lit("+00:00")))


def recorded(
    spark: SparkSession, stage: str, emit: Callable[[DataFrame], None], work: Callable[[], Any]
) -> Any:
    """Run ``work`` between a START and a COMPLETE (or FAIL) of the same run."""
    run_id = new_run_id()
    emit(run_event(spark, stage, "START", run_id))
    try:
        result = work()
    except Exception:
        emit(run_event(spark, stage, "FAIL", run_id))
        raise
    emit(run_event(spark, stage, "COMPLETE", run_id))
    return result


def events_from_log(log: DataFrame) -> DataFrame:
    """LINEAGE events for a whole log (run_id, stage, state, event_time).

    Rows with an unknown stage or state are left out; ``refused_events`` has them.
    """
    ins, outs = _declared(0), _declared(1)
    stage = F.col("stage")
    none = F.array().cast(LINEAGE["outputs"].dataType)
    return log.filter(_known()).select(
        F.col("state").alias("eventType"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("eventTime"),
        F.struct(F.col("run_id").cast("string").alias("runId")).alias("run"),
        F.struct(F.lit(NAMESPACE).alias("namespace"), stage.alias("name")).alias("job"),
        F.lit(PRODUCER).alias("producer"),
        F.element_at(ins, stage).alias("inputs"),
        F.when(F.col("state") == "START", none).otherwise(F.element_at(outs, stage)).alias("outputs"),
    )


def refused_events(log: DataFrame) -> DataFrame:
    return log.filter(~F.coalesce(_known(), F.lit(False)))


def _known() -> Column:
    return F.col("stage").isin(*STAGES) & F.col("state").isin(*STATES)


def _declared(side: int) -> Column:
    """Map of stage to its datasets on one side."""
    entries = []
    for stage, sides in STAGES.items():
        sets = [
            F.struct(F.lit(ns).alias("namespace"), F.lit(n).alias("name"))
            for ns, n in _datasets(sides[side])
        ]
        listed = F.array(*sets) if sets else F.array().cast(LINEAGE["inputs"].dataType)
        entries += [F.lit(stage), listed]
    return F.create_map(*entries)


def stage_graph(spark: SparkSession) -> DataFrame:
    """(stage, direction, dataset): the declared edges."""
    rows = [
        (stage, direction, name)
        for stage, sides in STAGES.items()
        for direction, names in zip(("input", "output"), sides)
        for name in names
    ]
    return spark.createDataFrame(rows, "stage string, direction string, dataset string")


def lineage_edges(events: DataFrame) -> DataFrame:
    """(job, input, output, runs): what completed runs read and wrote.

    Counted over events, so a dataset or job with most of the log is combined
    in the map tasks. Runs without inputs or outputs give a null side.
    """
    done = events.filter(F.col("eventType") == "COMPLETE")
    return (
        done.select(F.col("job.name").alias("job"), F.explode_outer("inputs").alias("i"), "outputs")
        .select("job", F.col("i.name").alias("input"), F.explode_outer("outputs").alias("o"))
        .groupBy("job", "input", F.col("o.name").alias("output"))
        .agg(F.count("*").alias("runs"))
    )


def run_states(events: DataFrame) -> DataFrame:
    """(job, eventType, events) over the log."""
    return events.groupBy(F.col("job.name").alias("job"), "eventType").agg(
        F.count("*").alias("events")
    )


def upstream(edges: DataFrame) -> DataFrame:
    """(dataset, via_job, from_dataset, from_job): each edge with the job that
    made its input. Joins the aggregated edges, one row per declared pair."""
    made = edges.select(
        F.col("output").alias("from_dataset"), F.col("job").alias("from_job")
    ).filter(F.col("from_dataset").isNotNull())
    used = edges.select(
        F.col("output").alias("dataset"), F.col("job").alias("via_job"), F.col("input").alias("from_dataset")
    ).filter(F.col("from_dataset").isNotNull() & F.col("dataset").isNotNull())
    return used.join(made, "from_dataset").select("dataset", "via_job", "from_dataset", "from_job")


def closure(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(dataset, ancestor, depth): all that a dataset was made from, by the fewest steps; read the other way, all that
    was made from an ancestor. ``edges`` has input and output; rows without one of them are left out.

    A round doubles the depth: a fewest way of more than h steps begins with one of exactly h, so only those pairs are joined with all that
    are known. New pairs alone are kept; a cycle ends when it has come back to each of its datasets, which are
    then their own ancestors.
    """
    pair = ["dataset", "ancestor"]
    links = edges.filter("input is not null and output is not null").select(
        F.col("output").alias("dataset"), F.col("input").alias("ancestor"), F.lit(1).alias("depth")
    )
    known = materialise(links.distinct(), "lineage-links")
    for h in (2**r for r in range(most_rounds)):
        begun = known.filter(F.col("depth") == h).select("dataset", F.col("ancestor").alias("way"))
        on = known.select(F.col("dataset").alias("way"), "ancestor", (F.col("depth") + h).alias("depth"))
        reached = begun.join(on, "way").groupBy(*pair).agg(F.min("depth").alias("depth"))
        new = materialise(reached.join(known, pair, "left_anti"), "lineage-round")
        if new.isEmpty():
            return known
        known = known.unionByName(new)
    raise RuntimeError(f"lineage is deeper than 2^{most_rounds} steps")
