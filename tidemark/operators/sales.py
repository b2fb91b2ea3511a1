"""Silver and gold: derive, keep one row per key, merge, aggregate."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def add_total(orders: DataFrame) -> DataFrame:
    return orders.withColumn("total_amount", F.col("quantity") * F.col("price"))


def dedupe_latest(df: DataFrame, keys: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order_by``, then by every other column.

    The default takes the latest ``timestamp``. The order is total up to equal
    rows, so the result does not depend on how the input is split. The filter
    on the row number lets Catalyst keep one row per key in every map task
    before the shuffle, so a key that holds a third of all rows costs nothing
    extra on the reduce side.
    """
    first = order_by if order_by is not None else [F.col("timestamp").desc_nulls_last()]
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*first, *rest)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n <= 1").drop("_n")


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target after merging ``source`` (one row per key) into it.

    Matched rows take every column from the source, unmatched source rows are
    added, unmatched target rows stay. A null key matches nothing, so those
    target rows skip the join instead of meeting in one task.
    """
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    kept = target.filter(has_key).join(source.select(*keys), keys, "left_anti")
    columns = target.columns
    return (
        source.select(*columns)
        .unionByName(kept.select(*columns))
        .unionByName(target.filter(~has_key))
    )


def product_sales(silver: DataFrame) -> DataFrame:
    """Orders, quantity and revenue per product.

    The distinct count is grouped on (product, order_id) first, which also
    spreads a product that dominates the table over all tasks.
    """
    return silver.groupBy("product").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_amount").alias("total_revenue"),
    )


def signed_changes(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """What merging ``source`` (one row per key) into ``target`` changes: its rows with ``sign`` 1, and the rows of the target that
    they take the place of with -1. A row that stays as it is gives both."""
    old = target.join(source.select(*keys), keys, "left_semi")
    columns = target.columns
    return source.select(*columns, F.lit(1).alias("sign")).unionByName(old.select(*columns, F.lit(-1).alias("sign")))


def refresh_sales(gold: DataFrame, changes: DataFrame) -> DataFrame:
    """``product_sales`` of the merged table, from that of the table before and ``signed_changes``.

    An order is one row of its table, so orders of a product are counted by signs; nothing but the changes and gold is read. A
    product whose last order has gone goes too. Quantities and orders are exact; revenue is a sum of doubles in another order.
    """
    sign = F.col("sign")
    moved = changes.groupBy("product").agg(
        F.sum(sign).cast("bigint").alias("total_orders"),
        F.sum(sign * F.col("quantity")).cast("bigint").alias("total_quantity"),
        F.sum(sign * F.col("total_amount")).alias("total_revenue"),
    )
    sums = gold.unionByName(moved).groupBy("product").agg(
        *[F.sum(c).alias(c) for c in ("total_orders", "total_quantity", "total_revenue")]
    )
    return sums.filter("total_orders <> 0")
