"""Spark schemas of every table the package reads or writes."""

from pyspark.sql import types as T

# Columns are in alphabetical order, as a JSON reader that infers would give.
ORDER = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("product", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

SILVER = T.StructType(ORDER.fields + [T.StructField("total_amount", T.DoubleType())])

GOLD = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("total_orders", T.LongType()),
        T.StructField("total_quantity", T.LongType()),
        T.StructField("total_revenue", T.DoubleType()),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

# ``record`` is the parsed JSON as text, null when it did not parse; ``raw``
# keeps what was received.
QUARANTINE = T.StructType(
    [
        T.StructField("record", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

# (doc_id, chunk_no) is the key and the corpus order; ``chunk_id`` is the
# printed label, which restarts in every document.
CHUNK = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("chunk_no", T.IntegerType()),
        T.StructField("chunk_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

VECTOR = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("document", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("source", T.StringType()),
                    T.StructField("chunk_id", T.StringType()),
                    T.StructField("doc_id", T.LongType()),
                    T.StructField("chunk_no", T.IntegerType()),
                ]
            ),
        ),
    ]
)

_DATASET = T.StructType(
    [
        T.StructField("namespace", T.StringType()),
        T.StructField("name", T.StringType()),
    ]
)

LINEAGE = T.StructType(
    [
        T.StructField("eventType", T.StringType()),
        T.StructField("eventTime", T.StringType()),
        T.StructField("run", T.StructType([T.StructField("runId", T.StringType())])),
        T.StructField("job", _DATASET),
        T.StructField("producer", T.StringType()),
        T.StructField("inputs", T.ArrayType(_DATASET)),
        T.StructField("outputs", T.ArrayType(_DATASET)),
    ]
)
