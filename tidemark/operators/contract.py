"""The order contract: decode messages, check every field, route the rows.

Each message is parsed once into a VARIANT. A rule is a pair of columns over it
(typed value, verdict), so the whole contract is one projection in the scan
stage, with no shuffle and no Python.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import ORDER

# The states an order may be in.
STATUSES = ("pending", "completed", "cancelled")


@dataclass(frozen=True)
class Rule:
    """How one field is read from the parsed record, and when it is accepted."""

    field: str
    code: str
    value: Callable[[str], Column]
    accept: Callable[[Column], Column]


def _kind(field: str) -> Column:
    """Type name of the field as received; null when the field is missing."""
    return F.schema_of_variant(F.try_variant_get(F.col("_v"), f"$.{field}", "variant"))


def _string(field: str) -> Column:
    # A plain read as string also turns numbers into text, so the type decides.
    return F.when(_kind(field) == "STRING", F.try_variant_get(F.col("_v"), f"$.{field}", "string"))


def _whole_number(field: str) -> Column:
    """Integers, integral floats, booleans, and integers written as text."""
    v, kind = F.col("_v"), _kind(field)
    as_double = F.try_variant_get(v, f"$.{field}", "double")
    as_long = F.try_variant_get(v, f"$.{field}", "bigint")
    digits = F.trim(F.try_variant_get(v, f"$.{field}", "string"))
    readable = (kind != "STRING") | digits.rlike("^[+-]?[0-9]+(\\.0*)?$")
    # The bigint read alone cuts 2.5 down to 2, the double read alone loses
    # digits above 2^53: the double decides, the bigint gives the value.
    whole = readable & (as_double == F.floor(as_double))
    return F.when(kind == "BIGINT", as_long).when(
        whole, F.coalesce(as_long, as_double.try_cast("bigint"))
    )


# Text that counts as a number: Spark's own cast would also take "10.5d" and "1.5F".
NUMBER_TEXT = r"(?i)^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$|^[+-]?(inf|infinity|nan)$"


def _number(field: str) -> Column:
    """Numbers, booleans, and numbers written as text, infinity among them."""
    v = F.col("_v")
    text = F.trim(F.try_variant_get(v, f"$.{field}", "string"))
    value = F.try_variant_get(v, f"$.{field}", "double")
    return F.when((_kind(field) != "STRING") | text.rlike(NUMBER_TEXT), value)


def _non_empty(value: Column) -> Column:
    return F.length(value) >= 1


ORDER_RULES = (
    Rule("order_id", "order_id:non_empty_string", _string, _non_empty),
    Rule("customer_id", "customer_id:non_empty_string", _string, _non_empty),
    Rule("product", "product:non_empty_string", _string, _non_empty),
    Rule("quantity", "quantity:positive_integer", _whole_number, lambda c: c > 0),
    # NaN sorts above every number in Spark, so it has to be named.
    Rule("price", "price:positive_number", _number, lambda c: (c > 0) & ~F.isnan(c)),
    Rule("status", "status:allowed_value", _string, lambda c: c.isin(*STATUSES)),
    Rule("timestamp", "timestamp:string", _string, lambda c: c.isNotNull()),
)


def encode_messages(orders: DataFrame) -> DataFrame:
    """Orders as keyed messages: UTF-8 ``order_id`` and the JSON of the row."""
    body = F.to_json(F.struct(*[f.name for f in ORDER.fields if f.name in orders.columns]))
    return orders.select(
        F.encode(F.col("order_id"), "UTF-8").alias("key"), F.encode(body, "UTF-8").alias("value")
    )


def apply_contract(
    messages: DataFrame, rules: tuple[Rule, ...] = ORDER_RULES, kinds: tuple[str, ...] = ()
) -> DataFrame:
    """Add the typed fields, ``raw``, ``is_valid``, and ``reason`` and ``record`` if not.

    For each field of ``kinds``, ``<field>_kind`` is the type name it was received with, from the same parse.
    Works on any frame with a ``value`` column (binary or text), streaming too.
    Of a key that an object repeats, the last value counts; the session is set to read it so.
    """
    messages.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", True)
    # The cast keeps the bytes; their validity is checked before they are read.
    as_text = F.col("value").cast("string")
    utf8 = F.when(F.is_valid_utf8(as_text), as_text)
    raw = F.coalesce(utf8, F.hex(as_text.cast("binary")))
    kept = [c for c in messages.columns if c != "value"]
    parsed = _once(messages, kept, [F.try_parse_json(utf8).alias("_v"), raw.alias("raw")])

    fields = [r.value(r.field).alias(r.field) for r in rules]
    fields += [_kind(f).alias(f"{f}_kind") for f in kinds]
    typed = _once(parsed, [*kept, "raw", "_v"], fields)
    accepted = [F.coalesce(r.accept(F.col(r.field)), F.lit(False)) for r in rules]
    # A message is valid by its verdicts alone: no text is put together for it, and none
    # where only the valid ones are asked for. ``concat_ws`` leaves out the nulls of the rules that hold.
    valid = reduce(and_, accepted, F.lit(True))
    reasons = F.concat_ws("; ", *[F.when(~ok, F.lit(r.code)) for ok, r in zip(accepted, rules, strict=True)])
    # What is not an object has none of the fields, so its shape only has to
    # be looked at where a rule failed; the record is only kept there, too.
    v = F.col("_v")
    reason = (
        F.when(valid, None)
        .when(v.isNull(), "malformed_json")
        .when(~F.schema_of_variant(v).startswith("OBJECT"), "not_an_object")
        .otherwise(reasons)
    )
    return (
        typed.withColumn("reason", reason)
        .withColumn("is_valid", valid)
        .withColumn("record", F.when(~F.col("is_valid"), v.cast("string")))
        .drop("_v")
    )


def _once(df: DataFrame, kept: list[str], computed: list[Column]) -> DataFrame:
    """Project ``computed`` so that each is evaluated once per row.

    Later filters would otherwise be moved below a plain projection with these
    expressions copied into every place that names them, and each message
    would be parsed again for each field and rule.
    """
    return df.select(*kept, F.inline(F.array(F.struct(*computed))))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid orders in the contract's columns, quarantined records).

    Every row of ``checked`` is in exactly one of the two.
    """
    valid = checked.filter("is_valid").select(*[f.name for f in ORDER.fields])
    quarantine = checked.filter("not is_valid").select("record", "reason", "raw")
    return valid, quarantine


def contract_counts(checked: DataFrame) -> DataFrame:
    """Rows in, accepted and rejected."""
    return checked.agg(
        F.count("*").alias("received"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("quarantined"),
    )
