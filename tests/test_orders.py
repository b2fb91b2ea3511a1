"""Contract, silver, quality gate, tables and the whole orders job."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import contract, quality, sales
from tidemark.plans import orders as plan
from tidemark.schemas import ORDER, SILVER
from tidemark.sources import files, tables

GOOD = {
    "order_id": "A-1", "customer_id": "C-1", "product": "Lamp", "quantity": 2,
    "price": 3.5, "status": "completed", "timestamp": "2024-01-01T00:00:00",
}
MISSING = object()


def order(**changes):
    out = {**GOOD, **changes}
    return {k: v for k, v in out.items() if v is not MISSING}


def messages(spark, *values):
    rows = [(v if isinstance(v, bytes) else (v if isinstance(v, str) else json.dumps(v)).encode(),) for v in values]
    return spark.createDataFrame(rows, "value binary")


def judged(spark, *values):
    return contract.apply_contract(messages(spark, *values)).collect()


def test_good_order(spark):
    (row,) = judged(spark, order(extra={"x": 1}))
    assert row["is_valid"] and row["reason"] is None
    assert {k: row[k] for k in GOOD} == GOOD


@pytest.mark.parametrize(
    "changes,code",
    [
        ({"order_id": ""}, "order_id:non_empty_string"),
        ({"order_id": 5}, "order_id:non_empty_string"),
        ({"customer_id": None}, "customer_id:non_empty_string"),
        ({"product": MISSING}, "product:non_empty_string"),
        ({"product": ["x"]}, "product:non_empty_string"),
        ({"quantity": 0}, "quantity:positive_integer"),
        ({"quantity": 2.5}, "quantity:positive_integer"),
        ({"quantity": "2.5"}, "quantity:positive_integer"),
        ({"quantity": "1e3"}, "quantity:positive_integer"),
        ({"quantity": False}, "quantity:positive_integer"),
        ({"quantity": None}, "quantity:positive_integer"),
        ({"quantity": [3]}, "quantity:positive_integer"),
        ({"quantity": {"n": 3}}, "quantity:positive_integer"),
        ({"quantity": 10**25}, "quantity:positive_integer"),
        ({"price": 0}, "price:positive_number"),
        ({"price": -1.5}, "price:positive_number"),
        ({"price": "NaN"}, "price:positive_number"),
        ({"price": "cheap"}, "price:positive_number"),
        ({"status": "Completed"}, "status:allowed_value"),
        ({"timestamp": 5}, "timestamp:string"),
        ({"timestamp": MISSING}, "timestamp:string"),
        ({"quantity": -1, "status": ""}, "quantity:positive_integer; status:allowed_value"),
    ],
)
def test_refused(spark, changes, code):
    (row,) = judged(spark, order(**changes))
    assert not row["is_valid"] and row["reason"] == code
    assert json.loads(row["record"]) == json.loads(json.dumps(order(**changes)))


def test_acceptance_values_of_three_orders(spark):
    """Two good orders and one without quantity, up to sales per product."""
    sent = messages(
        spark,
        order(product="Laptop", quantity=2, price=3500.0),
        order(order_id="A-2", product="Phone", quantity=1, price=2500.0),
        order(order_id="A-3", quantity=0),
    )
    valid, refused = contract.split_valid(contract.apply_contract(sent))
    assert valid.count() == 2 and [r["reason"] for r in refused.collect()] == ["quantity:positive_integer"]
    gold = sales.product_sales(sales.add_total(sales.dedupe_latest(valid, ["order_id"]))).collect()
    found = {r["product"]: (r["total_orders"], r["total_quantity"], r["total_revenue"]) for r in gold}
    assert found == {"Laptop": (1, 2, 7000.0), "Phone": (1, 1, 2500.0)}


@pytest.mark.parametrize(
    "changes,field,value",
    [
        ({"order_id": " "}, "order_id", " "),
        ({"quantity": 2.0}, "quantity", 2),
        ({"quantity": "2"}, "quantity", 2),
        ({"quantity": " 3.0 "}, "quantity", 3),
        ({"quantity": True}, "quantity", 1),
        ({"quantity": 2**53 + 1}, "quantity", 2**53 + 1),
        ({"price": "2.5"}, "price", 2.5),
        ({"price": 7}, "price", 7.0),
        ({"price": True}, "price", 1.0),
        ({"price": "inf"}, "price", float("inf")),
        ({"timestamp": ""}, "timestamp", ""),
        ({"product": "Käse 😀"}, "product", "Käse 😀"),
    ],
)
def test_accepted_as(spark, changes, field, value):
    (row,) = judged(spark, order(**changes))
    assert row["is_valid"], row["reason"]
    assert row[field] == value


def test_malformed_messages(spark):
    rows = judged(spark, "{", "", b"\xff\xfe", "[1]", '"x"', "5", "null")
    assert [r["reason"] for r in rows] == ["malformed_json"] * 3 + ["not_an_object"] * 4
    assert [r["record"] for r in rows[:3]] == [None] * 3
    assert rows[2]["raw"] == "FFFE" and rows[0]["raw"] == "{"


def test_null_message(spark):
    df = spark.createDataFrame([(None,)], "value binary")
    (row,) = contract.apply_contract(df).collect()
    assert row["reason"] == "malformed_json"


def test_each_message_goes_to_one_side(spark):
    checked = contract.apply_contract(messages(spark, order(), order(quantity=0), "{", order(price="2")))
    valid, refused = contract.split_valid(checked)
    assert (valid.count(), refused.count()) == (2, 2)
    assert contract.contract_counts(checked).first().asDict() == {"received": 4, "valid": 2, "quarantined": 2}


def test_messages_are_parsed_once(spark):
    valid, _ = contract.split_valid(contract.apply_contract(messages(spark, order())))
    plan_text = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan_text.count("parseJson") + plan_text.count("try_parse_json") == 1


def test_valid_orders_need_no_reasons(spark):
    """Where the valid ones alone are asked for, no reason is put together, not even to tell them apart."""
    valid, refused = contract.split_valid(contract.apply_contract(messages(spark, GOOD, order(quantity=0, status=""))))
    plan_of = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "quantity:positive_integer" not in plan_of(valid) and "quantity:positive_integer" in plan_of(refused)
    assert [r["order_id"] for r in valid.collect()] == [GOOD["order_id"]]
    assert [r["reason"] for r in refused.collect()] == ["quantity:positive_integer; status:allowed_value"]


def test_kinds_come_from_the_same_parse(spark):
    checked = contract.apply_contract(messages(spark, order(quantity="3"), order(price=MISSING), "{", b"\xff"), kinds=("quantity", "price"))
    plan_text = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan_text.count("parseJson") + plan_text.count("try_parse_json") == 1
    found = [(r["quantity_kind"], r["price_kind"] is None) for r in checked.collect()]
    assert found == [("STRING", False), ("BIGINT", True), (None, True), (None, True)]


def test_merged_parts_are_compressed(spark, tmp_path):
    """Rows without a key stay, the row of a key is replaced, and the folders hold zstd files."""
    first = sales.add_total(spark.createDataFrame([(None, k, 1.0, "p", 1, "s", "t") for k in ("a", "b", None, None)], ORDER))
    later = first.filter("order_id = 'b'").withColumn("quantity", F.lit(5).cast("long"))
    for batch in (first, later):
        tables.merge_parts(batch, f"{tmp_path}/t", ["order_id"], SILVER, 4)
    found = tables.read_parts(spark, f"{tmp_path}/t", SILVER)
    assert sorted((r["order_id"] or "", r["quantity"]) for r in found.collect()) == [("", 1), ("", 1), ("a", 1), ("b", 5)]
    assert all(name.endswith(".zstd.parquet") for name in found.inputFiles())


def test_encode_round_trip(spark):
    df = spark.createDataFrame([tuple(GOOD[f] for f in ORDER.fieldNames())], ORDER)
    (row,) = contract.encode_messages(df).collect()
    assert bytes(row["key"]) == b"A-1" and json.loads(bytes(row["value"])) == GOOD


def orders_df(spark, *rows):
    data = [tuple(order(**r)[f] for f in ORDER.fieldNames()) for r in rows]
    return sales.add_total(spark.createDataFrame(data, ORDER))


def test_latest_row_wins_whatever_the_partitioning(spark):
    rows = [{"timestamp": f"2024-01-0{d}", "price": float(p)} for d in (1, 2) for p in (1, 2, 3)]
    df = orders_df(spark, *rows)
    for parts in (1, 3, 6):
        (row,) = sales.dedupe_latest(df.repartition(parts), ["order_id"]).collect()
        assert (row["timestamp"], row["price"]) == ("2024-01-02", 3.0)


def test_an_order_with_a_third_of_all_rows(spark):
    """The hot key shrinks to one row per map task before the shuffle."""
    rows = 30_000
    hot = F.col("id") % 3 == 0
    df = sales.add_total(
        spark.range(0, rows, 1, 6).select(
            F.lit("C").alias("customer_id"),
            F.when(hot, "HOT").otherwise(F.format_string("A-%d", "id")).alias("order_id"),
            F.lit(1.0).alias("price"),
            F.when(hot, "Lamp").otherwise("Desk").alias("product"),
            F.lit(1).cast("bigint").alias("quantity"),
            F.lit("pending").alias("status"),
            F.format_string("%08d", "id").alias("timestamp"),
        )
    )
    kept = sales.dedupe_latest(df, ["order_id"])
    (hot_row,) = kept.filter("order_id = 'HOT'").collect()
    assert hot_row["timestamp"] == "00029997"
    gold = {r["product"]: r["total_orders"] for r in sales.product_sales(kept).collect()}
    assert gold == {"Lamp": 1, "Desk": 20_000}
    assert {r["product"]: r["total_quantity"] for r in sales.product_sales(df).collect()}["Lamp"] == 10_000
    shuffled = kept.select("order_id")
    shuffled.write.format("noop").mode("overwrite").save()
    plan_text = shuffled._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("WindowGroupLimit") >= 2


def test_upsert(spark):
    target = orders_df(spark, {}, {"order_id": "A-2"}, {"order_id": None, "product": "old"})
    source = orders_df(spark, {"order_id": "A-2", "price": 9.0}, {"order_id": "A-3"}, {"order_id": None})
    once = sales.upsert(target, source, ["order_id"])
    got = sorted((r["order_id"] or "", r["product"], r["price"]) for r in once.collect())
    assert got == [("", "Lamp", 3.5), ("", "old", 3.5), ("A-1", "Lamp", 3.5), ("A-2", "Lamp", 9.0), ("A-3", "Lamp", 3.5)]
    keyed = source.filter("order_id is not null")
    one = sales.upsert(target, keyed, ["order_id"])
    assert sorted(map(str, one.collect())) == sorted(map(str, sales.upsert(one, keyed, ["order_id"]).collect()))


def test_product_sales_counts_orders_once(spark):
    df = orders_df(spark, {}, {}, {"order_id": "A-2", "quantity": 5})
    (row,) = sales.product_sales(df).collect()
    assert row.asDict() == {"product": "Lamp", "total_orders": 2, "total_quantity": 9, "total_revenue": 31.5}


def test_expectations_and_gate(spark):
    bad = orders_df(spark, {}, {"order_id": None}, {"quantity": 1001}, {"price": 0.001}, {"quantity": 1000, "price": 0.01})
    rows = {r["check_name"]: r for r in quality.run_expectations(bad).collect()}
    assert [rows[c.name]["unexpected_count"] for c in quality.SILVER_CHECKS] == [1, 1, 1]
    assert rows["order_id:not_null"]["unexpected_percent"] == 20.0
    assert quality.gate(quality.run_expectations(bad)).first().asDict() == {"passed": False, "failed_checks": 3}
    with pytest.raises(quality.QualityGateError, match="order_id:not_null, price:between, quantity:between"):
        quality.require_gate(quality.run_expectations(bad))
    quality.require_gate(quality.run_expectations(bad.limit(0)))


def test_null_is_missing_not_out_of_range(spark):
    df = spark.createDataFrame([(None,), (5,)], "quantity long")
    (row,) = quality.run_expectations(df, (quality.between("quantity", 1, 10),)).collect()
    assert (row["missing_count"], row["unexpected_count"], row["success"]) == (1, 0, True)


def test_failing_rows_are_capped_per_check(spark):
    df = spark.range(50).select(F.format_string("k%02d", "id").alias("k"), (-F.col("id")).alias("quantity"))
    rows = quality.failing_rows(df, (quality.between("quantity", 1, 10),), "k", 3).collect()
    assert sorted((r["k"], r["sample_no"]) for r in rows) == [("k00", 1), ("k01", 2), ("k02", 3)]


def test_schema_mismatches():
    batch = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("z", T.LongType())])
    table = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])
    assert quality.schema_mismatches(batch, table) == [
        ("b", "type", "double", "string"), ("c", "missing", "string", ""), ("z", "unknown", "", "bigint"),
    ]


def test_table_versions(spark, tmp_path):
    path = str(tmp_path / "silver")
    with pytest.raises(tables.TableNotFoundError):
        tables.read_table(spark, path, SILVER)
    assert tables.upsert_table(orders_df(spark, {}), path, ["order_id"], SILVER) == 1
    before = tables.read_table(spark, path, SILVER)
    assert tables.upsert_table(orders_df(spark, {"price": 9.0}, {"order_id": "A-2"}), path, ["order_id"], SILVER) == 2
    assert sorted((r["order_id"], r["price"]) for r in tables.read_table(spark, path, SILVER).collect()) == [("A-1", 9.0), ("A-2", 3.5)]
    assert [r["price"] for r in before.collect()] == [3.5]
    assert tables.read_table(spark, path, SILVER, version=1).count() == 1
    # Refresh from itself, which plain parquet cannot do.
    tables.replace_table(tables.read_table(spark, path, SILVER), path, SILVER)
    assert tables.versions(spark, path) == [1, 2, 3]


def test_unfinished_version_is_not_the_table(spark, tmp_path):
    path = tmp_path / "t"
    tables.replace_table(orders_df(spark, {}), str(path), SILVER)
    (path / "version=2").mkdir()
    assert tables.versions(spark, str(path)) == [1]


def test_wrong_type_is_refused_before_the_write(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.replace_table(orders_df(spark, {}), path, SILVER)
    wrong = orders_df(spark, {"order_id": "A-9"}).withColumn("price", F.lit("NOT_A_NUMBER"))
    with pytest.raises(quality.SchemaMismatchError, match="price: type"):
        tables.upsert_table(wrong, path, ["order_id"], SILVER)
    assert tables.versions(spark, path) == [1]


def write_lines(path, *values):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((v if isinstance(v, str) else json.dumps(v)) + "\n" for v in values))


def test_orders_job(spark, tmp_path):
    base = str(tmp_path / "lake")
    first = tmp_path / "in1" / "m.jsonl"
    write_lines(first, order(), order(order_id="A-2", product="Desk", quantity=1), order(order_id="A-3", quantity=0), "{")
    gold = {r["product"]: tuple(r)[1:] for r in plan.run(spark, str(first), base).collect()}
    assert gold == {"Lamp": (1, 2, 7.0), "Desk": (1, 1, 3.5)}
    assert spark.read.json(f"{base}/quarantine").count() == 2

    # Sent again with a later state of one order: merged, not added.
    second = tmp_path / "in2" / "m.jsonl"
    write_lines(second, order(), order(order_id="A-2", product="Desk", quantity=4, timestamp="2024-02-01"))
    gold = {r["product"]: tuple(r)[1:] for r in plan.run(spark, str(second), base).collect()}
    assert gold == {"Lamp": (1, 2, 7.0), "Desk": (1, 4, 14.0)}

    # Passes the contract, not the gate: gold keeps its version.
    third = tmp_path / "in3" / "m.jsonl"
    write_lines(third, order(order_id="A-4", quantity=1001))
    with pytest.raises(quality.QualityGateError):
        plan.run(spark, str(third), base)
    assert tables.versions(spark, f"{base}/product_sales") == [1, 2]

    log = files.read_lineage(spark, f"{base}/lineage").collect()
    states = {}
    for e in log:
        states.setdefault(e["run"]["runId"], []).append((e["eventTime"], e["eventType"], e["job"]["name"]))
    runs = [[s for _, s, _ in sorted(v)] for v in states.values()]
    assert len(runs) == 14 and sorted(map(tuple, runs)) == [("START", "COMPLETE")] * 13 + [("START", "FAIL")]
    assert all(len({n for _, _, n in v}) == 1 for v in states.values())
    for e in log:
        assert e["eventTime"].endswith("+00:00")
        assert bool(e["outputs"]) == (e["eventType"] != "START")


def test_gold_from_changes_equals_the_full_refresh(spark):
    schema = "order_id string, product string, quantity long, total_amount double"
    silver = spark.createDataFrame([(f"o{k}", "abc"[k % 3], k, k * 1.5) for k in range(9)] + [("only", "d", 1, 2.0), (None, "a", 5, 1.0)], schema)
    gold = sales.product_sales(silver)
    batch = spark.createDataFrame([("o1", "a", 100, 7.0), ("only", "b", 2, 3.0), ("new", "e", 4, 8.0), ("o3", "a", 3, 4.5)], schema)
    found = sales.refresh_sales(gold, sales.signed_changes(silver, batch, ["order_id"]))
    expected = sales.product_sales(sales.upsert(silver, batch, ["order_id"]))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert "d" not in {r["product"] for r in found.collect()}
