"""Streaming jobs, file sources, lineage."""

import json
import re
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import lineage
from tidemark.schemas import CHUNK, LINEAGE, ORDER, SILVER
from tidemark.session import materialise, remove, work_folder
from tidemark.sources import files, tables
from tidemark.streaming import ingest


def line(n, **changes):
    row = {
        "order_id": f"A-{n}", "customer_id": "C", "product": "Lamp", "quantity": 1, "price": 2.0,
        "status": "pending", "timestamp": "2024-01-01", **changes,
    }
    return json.dumps(row) + "\n"


def run_ingest(spark, base, files_per_batch=None):
    stream = files.stream_files(spark, f"{base}/in", files_per_batch)
    ingest.start_ingest(stream, f"{base}/cp", f"{base}/valid", f"{base}/bad").awaitTermination()
    valid = spark.read.schema(ORDER).json(f"{base}/valid")
    return sorted(r["order_id"] for r in valid.collect()), spark.read.json(f"{base}/bad").count()


def test_ingest_in_batches_equals_one_batch_and_restart_adds_nothing(spark, tmp_path):
    lines = [line(n) if n % 4 else line(n, quantity=0) for n in range(20)]
    split, whole = tmp_path / "split", tmp_path / "whole"
    for base, parts in ((split, 5), (whole, 1)):
        (base / "in").mkdir(parents=True)
        for p in range(parts):
            (base / "in" / f"{p}.jsonl").write_text("".join(lines[p::parts]))
    expected = (sorted(f"A-{n}" for n in range(20) if n % 4), 5)
    assert run_ingest(spark, split, 1) == expected
    assert run_ingest(spark, whole) == expected
    assert len(list((split / "valid").glob("query=*/batch=*"))) == 5
    assert run_ingest(spark, split, 1) == expected
    (split / "in" / "late.jsonl").write_text(line(99) + "{\n")
    assert run_ingest(spark, split, 1) == (sorted(expected[0] + ["A-99"]), 6)


def test_streaming_upsert(spark, tmp_path):
    base = tmp_path
    (base / "in").mkdir()

    def drain():
        stream = files.stream_files(spark, f"{base}/in")
        ingest.start_upsert(stream, f"{base}/cp", f"{base}/silver").awaitTermination()
        rows = tables.read_parts(spark, f"{base}/silver", SILVER).collect()
        return sorted((r["order_id"], r["quantity"], r["total_amount"]) for r in rows)

    (base / "in" / "1.jsonl").write_text(line(1) + line(1, quantity=3, timestamp="2024-01-02") + line(2))
    assert drain() == [("A-1", 3, 6.0), ("A-2", 1, 2.0)]
    (base / "in" / "2.jsonl").write_text(line(2, quantity=7) + line(3) + line(4, price=0))
    assert drain() == [("A-1", 3, 6.0), ("A-2", 7, 14.0), ("A-3", 1, 2.0)]
    assert drain() == [("A-1", 3, 6.0), ("A-2", 7, 14.0), ("A-3", 1, 2.0)]
    assert not (base / "silver_pending").exists()
    (base / "in" / "3.jsonl").write_text(line(1, quantity=9))
    assert drain() == [("A-1", 9, 18.0), ("A-2", 7, 14.0), ("A-3", 1, 2.0)]


def _files(folder):
    return {f: f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_untouched_parts_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    big = spark.range(20_000).selectExpr("id", "cast(id * 7 AS string) AS v")
    assert len(tables.merge_parts(big, path, ["id"], big.schema, 16)) == 16
    before = _files(tmp_path / "t")
    small = spark.createDataFrame([(0, "new"), (30_000, "more")], big.schema)
    touched = tables.merge_parts(small, path, ["id"], big.schema, 16)
    after = _files(tmp_path / "t")
    kept = {f for f in before if after.get(f) == before[f]}
    assert len(touched) <= 2 and {f.parent.name for f in before if f not in kept} <= {f"of_16={n}" for n in touched}
    assert {f.parent.name for f in kept} == {f"of_16={n}" for n in range(16)} - {f"of_16={n}" for n in touched}
    for _ in range(2):
        merged = {r["id"]: r["v"] for r in tables.read_parts(spark, path, big.schema).collect()}
        assert len(merged) == 20_001 and (merged[0], merged[30_000], merged[19_999]) == ("new", "more", str(19_999 * 7))
        tables.merge_parts(small, path, ["id"], big.schema, 16)  # a repeated batch
    assert tables.merge_parts(small.filter("false"), path, ["id"], big.schema, 16) == []
    with pytest.raises(ValueError, match="parts"):
        tables.merge_parts(small, path, ["id"], big.schema, 8)


def test_a_merge_that_failed_while_replacing_is_done_again(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "id long, v string"
    first = spark.createDataFrame([(k, "a") for k in range(50)] + [(None, "x"), (None, "x")], schema)
    tables.merge_parts(first, path, ["id"], first.schema, 4)
    real = tables._replace_parts

    def fails(spark, pending, path, schema, name):
        remove(spark, f"{path}/of_4=1")  # as if the folders had been taken away and not yet put back
        raise OSError("lost")

    monkeypatch.setattr(tables, "_replace_parts", fails)
    second = spark.createDataFrame([(k, "b") for k in range(0, 60, 2)], schema)
    with pytest.raises(OSError):
        tables.merge_parts(second, path, ["id"], first.schema, 4)
    monkeypatch.setattr(tables, "_replace_parts", real)
    third = spark.createDataFrame([(1, "c")], schema)
    tables.merge_parts(third, path, ["id"], first.schema, 4)
    rows = [tuple(r) for r in tables.read_parts(spark, path, first.schema).collect()]
    assert sorted(r for r in rows if r[0] is None) == [(None, "x"), (None, "x")]
    expected = {k: "b" if k % 2 == 0 else "a" for k in range(50)} | {k: "b" for k in range(50, 60, 2)} | {1: "c"}
    assert {k: v for k, v in rows if k is not None} == expected and len(rows) == len(expected) + 2


def test_writes_go_on_after_a_failed_one(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3).toDF("id")
    (tmp_path / "t" / "version=1").mkdir(parents=True)
    (tmp_path / "t" / "version=1" / "part-0.parquet").write_bytes(b"half")
    assert tables.versions(spark, path) == []
    assert tables.replace_table(rows, path, rows.schema) == 2
    broken = rows.select(F.assert_true(F.col("id") < 2).alias("x"), "id").select(F.coalesce(F.col("x").cast("bigint"), "id").alias("id"))
    with pytest.raises(Exception):
        tables.replace_table(broken, path, rows.schema)
    assert tables.versions(spark, path) == [2]
    assert tables.upsert_table(spark.createDataFrame([(7,)], rows.schema), path, ["id"], rows.schema) == 4
    assert tables.read_table(spark, path, rows.schema).count() == 4
    assert tables.replace_table(rows, path, rows.schema, keep=1) == 5
    assert tables.versions(spark, path) == [5]


def test_an_unequal_count_is_never_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(3).toDF("id")

    class Wrong(tables.Observation):
        @property
        def get(self):
            return {"rows": 2}

    monkeypatch.setattr(tables, "Observation", Wrong)
    with pytest.raises(tables.WriteCheckError):
        tables.replace_table(rows, path, rows.schema)
    assert tables.versions(spark, path) == []


def test_repeated_source_keys_are_refused(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id long, v string"
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], schema)
    for write in (tables.upsert_table, tables.merge_parts):
        with pytest.raises(tables.RepeatedKeyError):
            write(twice, path, ["id"], twice.schema)
    assert not tables.table_exists(spark, path)


def test_documents_and_chunks(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.txt").write_text("one\n\ntwo ü")
    (tmp_path / "docs" / "blank.txt").write_text(" \n")
    (row,) = files.read_documents(spark, f"{tmp_path}/docs").collect()
    assert (row["source"], row["text"]) == ("a.txt", "one\n\ntwo ü")
    chunks = spark.createDataFrame([(1, 1, "chunk-001", "a.txt", "two ü")], CHUNK)
    files.write_chunks(chunks, f"{tmp_path}/chunks")
    assert files.read_chunks(spark, f"{tmp_path}/chunks").collect() == chunks.collect()
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.jsonl").write_text("\n\n")
    with pytest.raises(files.EmptyInputError):
        files.read_chunks(spark, f"{tmp_path}/none")


def test_routed_json_is_compressed(spark, tmp_path):
    sent = spark.createDataFrame([("{",), ("[1]",)], "value string")
    ingest.route(sent, f"{tmp_path}/valid", f"{tmp_path}/refused")
    assert list(tmp_path.glob("refused/*.json.gz")) and not list(tmp_path.glob("refused/*.json"))
    reasons = [r["reason"] for r in spark.read.json(f"{tmp_path}/refused").collect()]
    assert sorted(reasons) == ["malformed_json", "not_an_object"]


def test_documents_share_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FOLDER_FILES", 4)
    rows = [(i, f"text {i}\nü") for i in range(12)] + [(3, "again"), (3, None), (20, None), (None, "none"), (None, "nothing")]
    files.write_documents(spark.createDataFrame(rows, "k long, t string").repartition(3), f"{tmp_path}/d", "k", "t")
    assert len(list(tmp_path.glob("d/of=*"))) <= 4
    read = files.read_documents(spark, f"{tmp_path}/d").collect()
    texts = [f"text {i}\nü\n" for i in range(12) if i != 3] + ["\nagain\ntext 3\nü\n", "none\nnothing\n"]
    assert sorted(r["text"] for r in read) == sorted(texts)
    assert len({r["doc_id"] for r in read}) == 13


def test_documents_are_written_without_hadoop_and_opened_once(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(i, f"text {i}\nü") for i in range(30)] + [(None, None)], "k long, t string").repartition(3)
    files.write_documents(rows, f"{tmp_path}/a", "k", "t")
    assert not list(tmp_path.glob("a/of=*/.*"))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        files.write_documents(rows, f"{tmp_path}/a", "k", "t")
    monkeypatch.setattr(files, "local_folder", lambda *_: None)
    files.write_documents(rows, f"{tmp_path}/b", "k", "t")
    ours, sparks = [[p for p in sorted(tmp_path.glob(f"{d}/of=*/*")) if p.suffix == ".txt"] for d in "ab"]
    assert sorted(p.read_bytes() for p in ours) == sorted(p.read_bytes() for p in sparks)
    assert len(ours) == 31 and all(re.fullmatch(r"part-[0-9]{5}-[0-9a-f-]{36}[.]c[0-9]{3}[.]txt", p.name) for p in ours + sparks)
    read = files.read_documents(spark, f"{tmp_path}/a")
    shutil.rmtree(tmp_path / "a")
    assert sorted(r["text"] for r in read.collect()) == sorted(f"text {i}\nü\n" for i in range(30))


def test_documents_are_listed_some_folders_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LISTED_FILES", 12)
    calls, text = [], type(spark.read).text
    monkeypatch.setattr(type(spark.read), "text", lambda self, paths, *a, **b: calls.append(paths) or text(self, paths, *a, **b))
    for i in range(40):
        (tmp_path / "d" / f"of={i}").mkdir(parents=True)
        for n in range(i % 3):
            (tmp_path / "d" / f"of={i}" / f"a {n}.txt").write_text(f"{i} {n}")
    read = files.read_documents(spark, f"{tmp_path}/d").collect()
    assert sorted(r["text"] for r in read) == sorted(f"{i} {n}" for i in range(40) for n in range(i % 3))
    assert len(calls) > 3 and sum(map(len, calls)) == 40
    monkeypatch.undo()
    whole = spark.read.text(f"{tmp_path}/d", wholetext=True).select(F.xxhash64("_metadata.file_path").alias("doc_id"), "_metadata.file_name", "value")
    assert sorted(map(tuple, read)) == sorted(map(tuple, whole.collect()))
    for other in ("a=1", "plain", "of=[x]", "_of=1", "_metadata"):
        (tmp_path / "d" / other).mkdir()
        assert files._dealt_folders(spark, f"{tmp_path}/d") == []
        (tmp_path / "d" / other).rmdir()
    (tmp_path / "d" / "_SUCCESS").touch()
    assert len(files._dealt_folders(spark, f"{tmp_path}/d")) == 40
    (tmp_path / "none").mkdir()
    assert files.read_documents(spark, f"{tmp_path}/none").collect() == []
    monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(7))
    with pytest.raises(files.RepeatedIdError, match="have the id 7"):
        files.read_documents(spark, f"{tmp_path}/d")


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(base)
    df = materialise(spark.range(5).withColumn("v", F.col("id") * 2), "t")
    assert base.rstrip("/") in df.inputFiles()[0] and df.count() == 5


def test_an_unreadable_file_ends_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.gz").write_bytes(b"\x1f\x8b broken")
    with pytest.raises(Exception, match="(?i)gz|header|stream|corrupt|EOF"):
        run_ingest(spark, tmp_path)


def test_batches_are_counted_by_file_and_unreadable_files_are_told(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1 a.jsonl").write_text(line(1) + line(2, quantity=0) + line(3))
    (tmp_path / "in" / "2.jsonl").write_text(line(4))
    (tmp_path / "in" / "3.gz").write_bytes(b"\x1f\x8b broken")
    (tmp_path / "in" / "4.jsonl").write_text("")

    def run():
        stream = files.stream_files(spark, f"{tmp_path}/in", 1, with_file=True, skip_unreadable=True)
        out = [f"{tmp_path}/{name}" for name in ("cp", "valid", "bad", "counts")]
        ingest.start_ingest(stream, *out).awaitTermination()
        return ingest.read_counts(spark, f"{tmp_path}/counts")

    for _ in range(2):  # a restart adds nothing
        counts = run()
        rows = sorted((r["file"].rsplit("/", 1)[1], r["received"], r["valid"], r["quarantined"]) for r in counts.collect())
        assert rows == [("1%20a.jsonl", 3, 2, 1), ("2.jsonl", 1, 1, 0)]
        assert counts.select("batch").distinct().count() == 2
        (lost,) = ingest.unread_files(spark, f"{tmp_path}/in", counts).collect()
        assert lost["file"].endswith("/3.gz")


def test_a_second_query_overwrites_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text(line(1))
    run_ingest(spark, tmp_path)
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "2.jsonl").write_text(line(2))
    stream = files.stream_files(spark, f"{tmp_path}/more")
    ingest.start_ingest(stream, f"{tmp_path}/cp2", f"{tmp_path}/valid", f"{tmp_path}/bad").awaitTermination()
    rows = spark.read.schema(ORDER).json(f"{tmp_path}/valid").collect()
    assert sorted(r["order_id"] for r in rows) == ["A-1", "A-2"]


def test_remove(spark):
    path = work_folder(spark, "gone")
    spark.range(3).write.parquet(path)
    remove(spark, path)
    assert not tables.table_exists(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_run_events(spark, tmp_path):
    path = str(tmp_path / "lineage")

    def emit(df):
        files.append_json(df, path)

    assert lineage.recorded(spark, "bronze", emit, lambda: 7) == 7
    with pytest.raises(ZeroDivisionError):
        lineage.recorded(spark, "gold", emit, lambda: 1 / 0)
    log = files.read_lineage(spark, path)
    assert log.schema == LINEAGE
    rows = {(r["job"]["name"], r["eventType"]): r for r in log.collect()}
    assert set(rows) == {("bronze", "START"), ("bronze", "COMPLETE"), ("gold", "START"), ("gold", "FAIL")}
    done = rows["bronze", "COMPLETE"]
    assert done["run"] == rows["bronze", "START"]["run"] and done["run"] != rows["gold", "FAIL"]["run"]
    assert [d["name"] for d in done["inputs"]] == ["raw_orders"] and [d["name"] for d in done["outputs"]] == ["bronze_orders"]
    assert rows["bronze", "START"]["outputs"] == []
    with pytest.raises(lineage.UnknownStageError):
        lineage.run_event(spark, "platinum", "START")
    with pytest.raises(lineage.UnknownStateError):
        lineage.run_event(spark, "gold", "RUNNING")


def test_edges_of_a_log_are_the_declared_graph(spark):
    rows = [(f"r{i}", stage, "COMPLETE", None) for stage in lineage.STAGES for i in range(3)]
    rows += [("x", "gold", "START", None), ("x", "gold", "RUNNING", None), ("x", "platinum", "START", None)]
    log = spark.createDataFrame(rows, "run_id string, stage string, state string, event_time timestamp")
    events = lineage.events_from_log(log)
    edges = lineage.lineage_edges(events)
    pairs = {(r["job"], d, r[d]) for r in edges.collect() for d in ("input", "output") if r[d]}
    assert pairs == {tuple(r) for r in lineage.stage_graph(spark).collect()}
    assert {r["runs"] for r in edges.collect()} == {3}
    assert lineage.refused_events(log).count() == 2
    up = {(r["dataset"], r["from_dataset"], r["from_job"]) for r in lineage.upstream(edges).collect()}
    assert ("silver_orders", "bronze_orders", "bronze") in up and ("product_sales", "silver_orders", "silver") in up


def test_closure_of_chains_diamonds_and_cycles(spark):
    edges = [("a", "b"), ("b", "c"), ("b", "d"), ("c", "e"), ("d", "e"), ("e", "f"), ("x", "y"), ("y", "z"), ("z", "x"), ("s", "s"), (None, "a"), ("f", None)]
    edges += [(f"n{k}", f"n{k + 1}") for k in range(37)]
    found = {(r["dataset"], r["ancestor"]): r["depth"] for r in lineage.closure(spark.createDataFrame(edges, "input string, output string")).collect()}
    made = {}
    for i, o in edges:
        if i and o:
            made.setdefault(o, set()).add(i)
    expected = {}
    for start in made:
        level, depth = made[start], 1
        while level:
            for n in level:
                expected[start, n] = depth
            depth += 1
            level = {p for n in level for p in made.get(n, ())} - {b for a, b in expected if a == start}
    assert found == expected and found["e", "a"] == 3 and found["x", "x"] == 3 and found["n37", "n0"] == 37
    assert lineage.closure(spark.createDataFrame([], "input string, output string")).count() == 0
