"""Messages to gold: contract, bronze, silver, quality gate, gold, lineage."""

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.contract import apply_contract, split_valid
from tidemark.operators.lineage import recorded
from tidemark.operators.quality import SILVER_CHECKS, require_gate
from tidemark.operators.sales import add_total, dedupe_latest, product_sales
from tidemark.schemas import GOLD, ORDER, SILVER
from tidemark.sources.files import append_json, read_messages, read_orders
from tidemark.sources.tables import Prepared, prepare_upsert, publish, read_table, replace_table
from tidemark.streaming.ingest import route


def silver_from_messages(messages: DataFrame) -> DataFrame:
    """Valid orders of one batch, one row per order."""
    valid, _ = split_valid(apply_contract(messages))
    return dedupe_latest(add_total(valid), ["order_id"])


def gold_from_messages(messages: DataFrame) -> DataFrame:
    """Sales per product of one batch of messages, without tables in between."""
    return product_sales(silver_from_messages(messages))


def ingest(spark: SparkSession, messages_path: str, base: str) -> None:
    """Append the valid orders and the quarantined records of one batch."""
    route(read_messages(spark, messages_path), f"{base}/raw", f"{base}/quarantine")


def run(spark: SparkSession, messages_path: str, base: str) -> DataFrame:
    """The whole job. Each stage is recorded; a failed gate raises, and silver
    and gold keep the versions they had."""
    emit = partial(append_json, path=f"{base}/lineage")

    def stage(name, work):
        return recorded(spark, name, emit, work)

    stage("ingestion", lambda: ingest(spark, messages_path, base))
    stage(
        "bronze",
        lambda: replace_table(read_orders(spark, f"{base}/raw"), f"{base}/bronze", ORDER),
    )

    def silver() -> Prepared:
        bronze = read_table(spark, f"{base}/bronze", ORDER)
        batch = dedupe_latest(add_total(bronze), ["order_id"])
        return prepare_upsert(batch, f"{base}/silver", ["order_id"], SILVER, SILVER_CHECKS)

    def quality_gate(made: Prepared) -> None:
        """The counts were taken while silver was written; a batch that fails never becomes the table."""
        require_gate(made.results(spark))
        publish(spark, made)

    made = stage("silver", silver)
    stage("quality_gate", lambda: quality_gate(made))
    table = read_table(spark, f"{base}/silver", SILVER)
    stage("gold", lambda: replace_table(product_sales(table), f"{base}/product_sales", GOLD))
    return read_table(spark, f"{base}/product_sales", GOLD)
