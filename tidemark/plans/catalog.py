"""Every operator as a query over the driver's tables.

Orders are messages made from lineitem, orders and part, one per line item.
The tables hold no invalid orders, so a share of the messages, chosen by key,
is spoilt in one of some thirty ways: each rule of the contract meets good and bad
records. The questions of the retrieval jobs are the whole texts of ``benchmark``.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import answers as A
from tidemark.operators import chunking, compact, contract, dense, fusion, late, lexical, lineage, pivots, quality, sales
from tidemark.operators import postings as impacts
from tidemark.plans import orders as order_plans
from tidemark.plans import retrieval
from tidemark.schemas import ORDER, QUARANTINE, SILVER, VECTOR
from tidemark.session import materialise, work_folder
from tidemark.sources import files, tables
from tidemark.streaming import ingest

DIGITS = 6


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- orders ----


def _named(*parts: str | Column) -> Column:
    """Text and numbers in one string, a null number as ``null``: what ``format_string`` gives, at a fraction of its time."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the order fields and its fault number."""
    li = _table(spark, sf_dir, "lineitem")
    o = _table(spark, sf_dir, "orders")
    p = _table(spark, sf_dir, "part")
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("cancelled")
    )
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(p, li.l_partkey == p.p_partkey)
        .select(
            _named("ORD-", F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("order_id"),
            F.col("o_custkey").alias("customer_no"),
            _named("CUST-", F.col("o_custkey")).alias("customer_id"),
            F.col("p_type").alias("product"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            status.alias("status"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
            F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(40)).alias("fault"),
        )
    )


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _choose(cases: dict[int, Column], otherwise: Column) -> Column:
    out = None
    for number, value in cases.items():
        hit = F.col("fault") == number
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(otherwise)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, value) for every line item, faults included."""
    q = F.col("quantity").cast("string")
    price = F.col("price").cast("string")
    customer = _choose({11: F.col("customer_no").cast("string")}, _quoted(F.col("customer_id")))
    product = _choose({3: F.lit('""'), 13: F.lit("null")}, _quoted(F.col("product")))
    quantity = _choose(
        {
            1: F.lit("0"),
            7: _quoted(q),
            8: F.concat(q, F.lit(".5")),
            9: _quoted(F.concat(q, F.lit(".0"))),
            14: F.lit("true"),
            15: F.concat(q, F.lit(".0")),
            16: F.lit('"x"'),
            17: F.concat(F.lit("["), q, F.lit("]")),
            18: F.concat(q, F.lit("e0")),
            29: F.lit("-1"),
        },
        q,
    )
    amount = _choose(
        {
            2: F.concat(F.lit("-"), price),
            10: _quoted(price),
            19: F.lit("0"),
            20: F.lit('"NaN"'),
            21: F.lit('"abc"'),
            22: F.lit("true"),
            29: F.lit("-1"),
            33: F.lit('"10.5d"'),
            34: _quoted(F.concat(F.lit(" "), price, F.lit(" "))),
        },
        price,
    )
    status = _choose(
        {4: F.lit('"shipped"'), 23: F.lit('"Completed"'), 32: F.lit('"shipped"')}, _quoted(F.col("status"))
    )
    stamp = _choose(
        {
            5: F.lit(""),
            24: F.lit(',"timestamp":5'),
            25: F.lit(',"timestamp":""'),
        },
        F.concat(F.lit(',"timestamp":'), _quoted(F.col("timestamp"))),
    )
    # A repeated key: the last value counts.
    again = F.concat(F.lit(',"status":'), _quoted(F.col("status")))
    extra = _choose({27: F.lit(',"coupon":{"code":"X"}'), 32: again}, F.lit(""))
    fields = F.concat(
        F.lit('{"order_id":'), _quoted(F.col("order_id")),
        F.lit(',"customer_id":'), customer,
        F.lit(',"product":'), product,
        F.lit(',"quantity":'), quantity,
        F.lit(',"price":'), amount,
        F.lit(',"status":'), status,
        stamp,
        extra,
    )
    before = F.when(F.col("fault") == 12, "[").otherwise("")
    after = F.when(F.col("fault") == 6, "").when(F.col("fault") == 12, "}]").otherwise("}")
    text = _choose({26: _quoted(F.col("order_id"))}, F.concat(before, fields, after))
    bad_byte = F.unhex(F.when(F.col("fault") == 28, "FF").otherwise(""))
    value = F.concat(bad_byte, F.encode(text, "UTF-8"))
    return _lines(spark, sf_dir).select(
        F.encode("order_id", "UTF-8").alias("key"), value.alias("value")
    )


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order record per row of ``orders``: a later state of its line 1."""
    o = _table(spark, sf_dir, "orders")
    return o.select(
        _named("CUST-", F.col("o_custkey")).alias("customer_id"),
        _named("ORD-", F.col("o_orderkey"), "-1").alias("order_id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("product"),
        F.lit(1).cast("bigint").alias("quantity"),
        F.lit("completed").alias("status"),
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss").alias(
            "timestamp"
        ),
    )


def observed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed orders before any check, with values the expectations must catch."""
    return _lines(spark, sf_dir).select(
        F.col("order_id").alias("line_id"),
        F.when(F.col("fault") != 30, F.col("order_id")).alias("order_id"),
        _choose({1: F.lit(0).cast("bigint"), 31: F.lit(None).cast("bigint")}, F.col("quantity")).alias(
            "quantity"
        ),
        _choose({2: -F.col("price")}, F.col("price")).alias("price"),
    )


def _rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def message_encode(spark, sf_dir):
    sent = contract.encode_messages(_lines(spark, sf_dir))
    body = F.from_json(F.decode("value", "UTF-8"), ORDER)
    return sent.select(F.decode("key", "UTF-8").alias("message_key"), body.alias("m")).select(
        "message_key",
        *[f"m.{c}" for c in "customer_id product quantity price status timestamp".split()],
    )


def contract_valid(spark, sf_dir):
    valid, _ = contract.split_valid(contract.apply_contract(messages(spark, sf_dir)))
    return valid


def contract_quarantine(spark, sf_dir):
    """All of a refused message, as it came and as it was parsed. The price stands beside its place, rounded, as engines write
    doubles differently; a message that is no UTF-8 is shown as its first byte and its text."""
    _, refused = contract.split_valid(contract.apply_contract(messages(spark, sf_dir)))
    number = r'"price":(-?[0-9][0-9.Ee+-]*)'
    text = F.concat(F.lit("FF"), F.decode(F.unhex(F.substring("raw", 3, 1 << 30)), "UTF-8"))
    shown = refused.withColumn("raw", F.when(F.col("raw").startswith("FF7B"), text).otherwise(F.col("raw")))
    price = lambda c: F.round(F.regexp_extract(c, number, 1).try_cast("double"), 9)
    plain = lambda c: F.regexp_replace(c, number, '"price":#')
    return shown.select(
        "reason",
        plain("raw").alias("raw"),
        price("raw").alias("raw_price"),
        plain("record").alias("record"),
        price("record").alias("record_price"),
    )


def contract_counts(spark, sf_dir):
    return contract.contract_counts(contract.apply_contract(messages(spark, sf_dir)))


def contract_lax_types(spark, sf_dir):
    """How every spelling of a quantity and a price was read."""
    checked = contract.apply_contract(messages(spark, sf_dir), kinds=("quantity", "price"))
    return (
        checked.withColumn("price_kind", F.regexp_replace("price_kind", "DECIMAL.*|BIGINT", "NUMBER"))
        .withColumn("quantity_kind", F.regexp_replace("quantity_kind", "DECIMAL.*|DOUBLE|BIGINT", "NUMBER"))
        .groupBy("quantity_kind", "price_kind", "is_valid")
        .agg(
            F.count("*").alias("messages"),
            F.sum("quantity").alias("quantity"),
            F.round(F.sum(F.when(~F.isnan("price"), F.col("price"))), 2).alias("price"),
        )
    )


def silver_orders(spark, sf_dir):
    return order_plans.silver_from_messages(messages(spark, sf_dir))


def silver_upsert(spark, sf_dir):
    target = materialise(order_plans.silver_from_messages(messages(spark, sf_dir)), "silver")
    source = sales.add_total(revisions(spark, sf_dir))
    return sales.upsert(target, source, ["order_id"])


def gold_product_sales(spark, sf_dir):
    return _rounded(
        order_plans.gold_from_messages(messages(spark, sf_dir)), "total_revenue", digits=2
    )


def gold_incremental(spark, sf_dir):
    """Gold after two batches of revisions, each from its changes alone; the table is merged by parts beside it."""
    path, keys = work_folder(spark, "silver-parts"), ["order_id"]
    tables.merge_parts(order_plans.silver_from_messages(messages(spark, sf_dir)), path, keys, SILVER, 16)
    gold = materialise(sales.product_sales(tables.read_parts(spark, path, SILVER)), "gold")
    revised = sales.add_total(revisions(spark, sf_dir))
    for half in (0, 1):
        batch = materialise(revised.filter(F.pmod(F.xxhash64("order_id"), F.lit(2)) == half), "revisions")
        changes = materialise(sales.signed_changes(tables.read_parts(spark, path, SILVER), batch, keys), "changes")
        gold = materialise(sales.refresh_sales(gold, changes), "gold")
        tables.merge_parts(batch, path, keys, SILVER, 16)
    return _rounded(gold, "total_revenue", digits=2)


def dq_results(spark, sf_dir):
    return _rounded(quality.run_expectations(observed_orders(spark, sf_dir)), "unexpected_percent")


def dq_gate(spark, sf_dir):
    before = quality.gate(quality.run_expectations(observed_orders(spark, sf_dir)))
    silver = order_plans.silver_from_messages(messages(spark, sf_dir))
    after = quality.gate(quality.run_expectations(silver))
    return before.withColumn("batch", F.lit("observed")).unionByName(
        after.withColumn("batch", F.lit("silver"))
    )


def dq_failing_rows(spark, sf_dir):
    return _rounded(
        quality.failing_rows(
            observed_orders(spark, sf_dir), quality.SILVER_CHECKS, "line_id", 20
        ).withColumn("observed", F.col("observed").cast("double")),
        "observed",
    )


def schema_enforcement(spark, sf_dir):
    batch = sales.add_total(revisions(spark, sf_dir)).withColumn(
        "price", F.col("price").cast("string")
    ).drop("status").withColumn("note", F.lit(1))
    return quality.rejected_batch(batch, SILVER)


# Messages of a compressed file, which one task reads whole.
FILE_MESSAGES = 400_000


def _message_files(spark, df: DataFrame, folder: str, compressed: bool = True) -> None:
    lines = df.select(F.col("value").cast("string").alias("value")).write.mode("append")
    if compressed:
        lines = lines.option("compression", "gzip").option("maxRecordsPerFile", FILE_MESSAGES)
    lines.text(folder)


def stream_ingest(spark, sf_dir):
    """Every row of the two folders after the stream has read all messages."""
    base = work_folder(spark, "stream-ingest")
    _message_files(spark, messages(spark, sf_dir), f"{base}/in")
    stream = files.stream_files(spark, f"{base}/in")
    ingest.start_ingest(
        stream, f"{base}/checkpoint", f"{base}/valid", f"{base}/quarantine"
    ).awaitTermination()
    valid = spark.read.schema(ORDER).json(f"{base}/valid")
    refused = spark.read.schema(QUARANTINE).json(f"{base}/quarantine")
    order_ref = F.regexp_extract("raw", "ORD-[0-9]+-[0-9]+", 0)
    return valid.select(
        "order_id", "customer_id", "product", "quantity", "price", "status", "timestamp",
        F.lit(None).cast("string").alias("reason"),
    ).unionByName(refused.select(order_ref.alias("order_id"), "reason"), allowMissingColumns=True)


def stream_upsert(spark, sf_dir):
    """The silver table after two runs of the stream: orders, then revisions."""
    base = work_folder(spark, "stream-upsert")
    silver = f"{base}/silver"

    def drain():
        stream = files.stream_files(spark, f"{base}/in")
        ingest.start_upsert(stream, f"{base}/checkpoint", silver).awaitTermination()

    _message_files(spark, messages(spark, sf_dir), f"{base}/in")
    drain()
    _message_files(spark, contract.encode_messages(revisions(spark, sf_dir)), f"{base}/in")
    drain()
    return tables.read_parts(spark, silver, SILVER)


def stream_counts(spark, sf_dir):
    """What the ingest stream has counted over all batches and files, and the files that gave it nothing."""
    base = work_folder(spark, "stream-counts")
    # Plain files: one without messages has no bytes then, and is not taken for an unread one.
    _message_files(spark, messages(spark, sf_dir), f"{base}/in", compressed=False)
    stream = files.stream_files(spark, f"{base}/in", files_per_batch=3, with_file=True)
    ingest.start_ingest(stream, f"{base}/checkpoint", f"{base}/valid", f"{base}/quarantine", f"{base}/counts").awaitTermination()
    counts = ingest.read_counts(spark, f"{base}/counts")
    names = ["received", "valid", "quarantined"]
    lost = ingest.unread_files(spark, f"{base}/in", counts)
    each = counts.select(*names, F.lit(0).alias("unread_files")).unionByName(
        lost.select(*[F.lit(0).cast("long").alias(c) for c in names], F.lit(1).alias("unread_files"))
    )
    return each.agg(*[F.sum(c).alias(c) for c in (*names, "unread_files")])


def bronze_refresh(spark, sf_dir):
    """The newest version after two refreshes: the orders of one batch, then of a later one."""
    path = work_folder(spark, "bronze")
    valid, _ = contract.split_valid(contract.apply_contract(messages(spark, sf_dir)))
    tables.replace_table(revisions(spark, sf_dir), path, ORDER)
    tables.replace_table(valid, path, ORDER)
    return tables.read_table(spark, path, ORDER)


def orders_job(spark, sf_dir):
    """The whole job from message files to gold, the gate included."""
    base = work_folder(spark, "orders-job")
    _message_files(spark, messages(spark, sf_dir), f"{base}/in")
    return _rounded(order_plans.run(spark, f"{base}/in", f"{base}/lake"), "total_revenue", digits=2)


def _job_and_refused_batch(spark, sf_dir) -> str:
    """The lake after the whole job, and after a second batch whose quantities pass the contract but not the gate."""
    base = work_folder(spark, "refused-batch")
    _message_files(spark, messages(spark, sf_dir), f"{base}/in")
    order_plans.run(spark, f"{base}/in", f"{base}/lake")
    late_orders = revisions(spark, sf_dir).withColumn("quantity", F.lit(1001).cast("bigint"))
    _message_files(spark, contract.encode_messages(late_orders), f"{base}/late")
    try:
        order_plans.run(spark, f"{base}/late", f"{base}/lake")
    except quality.QualityGateError:
        return f"{base}/lake"
    raise AssertionError("the gate let the batch pass")


def gate_keeps_silver(spark, sf_dir):
    """Silver after a batch that failed its expectations: the version from before."""
    return tables.read_table(spark, f"{_job_and_refused_batch(spark, sf_dir)}/silver", SILVER)


def job_events(spark, sf_dir):
    """The run events of both jobs, clock and run id checked for form, START before the end of the same run."""
    log = files.read_lineage(spark, f"{_job_and_refused_batch(spark, sf_dir)}/lineage")
    runs = Window.partitionBy("run.runId")
    started = F.min(F.when(F.col("eventType") == "START", F.col("eventTime"))).over(runs)

    def listed(side):
        return F.array_join(F.transform(side, lambda d: F.concat_ws("/", d["namespace"], d["name"])), ",").alias(side)

    each = log.select(
        "eventType", "producer", F.col("job.namespace").alias("namespace"), F.col("job.name").alias("job"), listed("inputs"), listed("outputs"),
        F.col("run.runId").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$").alias("id"),
        F.col("eventTime").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]{6}[+]00:00$").alias("clock"),
        ((F.count("*").over(runs) == 2) & (started <= F.col("eventTime"))).alias("pair"),
    )
    return each.groupBy("eventType", "producer", "namespace", "job", "inputs", "outputs").agg(
        F.count("*").alias("events"), *[F.count_if(c).alias(f"good_{c}s") for c in ("id", "clock", "pair")]
    )


# ------------------------------------------------------------------ text ----


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "source", "text")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def word_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_words(documents(spark, sf_dir))


def paragraphs(spark, sf_dir):
    return chunking.paragraphs(documents(spark, sf_dir), sep="\n")


def conversation_paragraphs(spark, sf_dir):
    """Each conversation as one text whose turns are parted by blank lines of several kinds."""
    turns = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"]), "\r\n \t\r\n\n\n"
        ).alias("text")
    )
    tidy = turns.select(F.col("conv_id").alias("doc_id"), X.tidy_paragraphs(F.col("text")).alias("text"))
    return chunking.paragraphs(tidy)


def documents_from_files(spark, sf_dir):
    """Documents written as one text file each, ended by a line feed, and read as whole documents."""
    path = work_folder(spark, "document-files")
    named = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("part"), F.col("text").alias("value"))
    files.write_documents(named, path, "part", "value")
    read = files.read_documents(spark, path)
    return read.groupBy(F.md5(F.col("text").cast("binary")).alias("text_md5")).agg(
        F.count("*").alias("files"), F.count_distinct("doc_id").alias("ids"),
        F.count_if(F.col("source").rlike("^part-[0-9]{5}-[0-9a-f-]{36}[^/]*[.]txt$")).alias("named"),
    )


def chunks_jsonl(spark, sf_dir):
    """Chunks written as JSON Lines and read back."""
    path = work_folder(spark, "chunk-lines")
    files.write_chunks(word_chunks(spark, sf_dir), path)
    return files.read_chunks(spark, path)


def chunk_words(spark, sf_dir):
    return word_chunks(spark, sf_dir)


def chunk_words_lines(spark, sf_dir):
    return chunking.chunk_words(documents(spark, sf_dir), 20, 5, sep="\n")


def chunk_chars_flat(spark, sf_dir):
    return chunking.chunk_chars(documents(spark, sf_dir), 500, 100, "flat")


def chunk_chars_para(spark, sf_dir):
    return chunking.chunk_chars(documents(spark, sf_dir), 500, 80, "paragraph")


def chunk_preview(spark, sf_dir):
    return chunking.preview(word_chunks(spark, sf_dir), 20, 60)


def _token_counts(mode):
    def query(spark, sf_dir):
        each = documents(spark, sf_dir).select(
            "doc_id", F.explode(X.tokens(F.col("text"), mode)).alias("term")
        )
        return each.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))

    return query


def sentences(spark, sf_dir):
    return chunking.sentences(documents(spark, sf_dir), "doc_id")


def stage_metrics(spark, sf_dir):
    docs = documents(spark, sf_dir)
    sized = chunking.document_sizes(docs)
    parts = [sized.select(F.lit("documents").alias("stage"), F.col("documents").alias("rows"), "characters", "words")]
    for name, chunks in (
        ("word chunks", chunking.chunk_words(docs)),
        ("flat chunks", chunking.chunk_chars(docs, 500, 100, "flat")),
    ):
        counted = chunking.document_sizes(chunks)
        parts.append(
            counted.select(F.lit(name).alias("stage"), F.col("documents").alias("rows"), "characters", "words")
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ------------------------------------------------------------- retrieval ----


def postings(spark, sf_dir):
    return lexical.Index("ws", lexical.tokenise(word_chunks(spark, sf_dir), "ws"), None).postings


def doc_lengths(spark, sf_dir):
    return lexical.tokenise(word_chunks(spark, sf_dir), "ws").select("doc_id", "chunk_no", "dl")


def corpus_stats(spark, sf_dir):
    index = lexical.build_index(word_chunks(spark, sf_dir), "ws", store=False)
    return _rounded(index.corpus, "avgdl", "avg_idf")


def term_stats(spark, sf_dir):
    return _rounded(lexical.build_index(word_chunks(spark, sf_dir), "ws", store=False).term_stats, "idf")


def _ranked(df: DataFrame, score: str) -> DataFrame:
    return _rounded(df.select("query_id", "rank", "doc_id", "chunk_no", "chunk_id", "source", "text", score), score)


def _word_index(spark, sf_dir):
    return lexical.build_index(word_chunks(spark, sf_dir), "ws")


def _bm25(spark, sf_dir):
    return lexical.bm25_search(questions(spark, sf_dir), _word_index(spark, sf_dir), 5)


def _keywords(spark, sf_dir):
    return lexical.keyword_search(questions(spark, sf_dir), word_chunks(spark, sf_dir), 5)


def bm25_topk(spark, sf_dir):
    return _ranked(_bm25(spark, sf_dir), "score")


def bm25_stored(spark, sf_dir):
    """The same from an index that was saved and loaded again."""
    path = work_folder(spark, "saved-index")
    lexical.save_index(_word_index(spark, sf_dir), path)
    index = lexical.load_index(spark, path, "ws")
    return _ranked(lexical.bm25_search(questions(spark, sf_dir), index, 5), "score")


def short_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question of each item of ``benchmark``: its five longest words, of equal ones the first in order."""
    words = F.array_distinct(X.tokens(F.col("text"), "ws"))
    by_length = F.array_sort(F.transform(words, lambda w: F.struct((-F.char_length(w)).alias("less"), w.alias("word"))))
    five = F.transform(F.slice(by_length, 1, 5), lambda s: s["word"])
    return _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.array_join(five, " ").alias("query"))


def _posted(spark, sf_dir, kind, mode):
    path = work_folder(spark, f"postings-{kind}")
    impacts.build(word_chunks(spark, sf_dir), path, mode, kind)
    return impacts.load(spark, path)


def bm25_postings(spark, sf_dir):
    """Short questions, answered from stored postings of bounded impact."""
    index = _posted(spark, sf_dir, impacts.BM25, "ws")
    return _ranked(impacts.search(short_questions(spark, sf_dir), index, 5), "score")


def keyword_postings(spark, sf_dir):
    index = _posted(spark, sf_dir, impacts.COUNT, "ascii")
    return _ranked(impacts.search(short_questions(spark, sf_dir), index, 5), "score")


def bm25_topk_padded(spark, sf_dir):
    index = lexical.build_index(chunk_chars_flat(spark, sf_dir), "word")
    return _ranked(lexical.bm25_search(questions(spark, sf_dir), index, 5, pad_zero=True), "score")


def keyword_topk(spark, sf_dir):
    return _ranked(_keywords(spark, sf_dir), "score")


def hashed_vectors(spark, sf_dir):
    chunks = chunk_chars_flat(spark, sf_dir)
    vectors = dense.vectorise(chunks, retrieval.DIM, dense.bucket_idf(chunks, retrieval.DIM))
    return (
        vectors.select("doc_id", "chunk_no", F.posexplode("embedding").alias("bucket", "w"))
        .filter("w <> 0")
        .select("doc_id", "chunk_no", "bucket", F.round(F.col("w").cast("double"), 5).alias("weight"))
    )


def vector_table(spark, sf_dir):
    """Every record of the rebuilt table: a digest of its document, and its weights that are not zero, in units of 1e-5."""
    path = work_folder(spark, "vectors")
    dense.rebuild_vectors(word_chunks(spark, sf_dir), path, retrieval.DIM)
    units = F.transform("embedding", lambda w, k: F.struct(k.alias("k"), F.round(w.cast("double") * 1e5).cast("long").alias("w")))
    there = F.transform(F.filter(units, lambda u: u["w"] != 0), lambda u: F.concat_ws(":", u["k"], u["w"]))
    return tables.read_table(spark, path, VECTOR).select(
        "id",
        F.col("metadata.source").alias("source"),
        F.col("metadata.chunk_id").alias("chunk_id"),
        F.md5(F.encode("document", "UTF-8")).alias("document_md5"),
        F.size("embedding").alias("dim"),
        F.array_join(there, ",").alias("weights"),
    )


def vector_ids(spark, sf_dir):
    """Sources that hold a label more than once: labels restart per document."""
    labels = word_chunks(spark, sf_dir).select(F.concat_ws("/", "source", "chunk_id").alias("label"))
    return dense.repeated_ids(labels, "label")


def _stored_vectors(spark, sf_dir):
    e = _table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("doc_id"),
        F.lit(0).alias("chunk_no"),
        F.format_string("vec-%d", "vec_id").alias("chunk_id"),
        F.format_string("label-%d", "label").alias("source"),
        F.lit("").alias("text"),
        "embedding",
    )


def _dense(spark, sf_dir, metric, scale=1.0):
    vectors = _stored_vectors(spark, sf_dir)
    if scale != 1.0:
        small = F.transform("embedding", lambda x: (x.cast("double") * scale).cast("float"))
        vectors = vectors.withColumn("embedding", small)
    asked = vectors.select(F.col("doc_id").alias("query_id"), "embedding")
    return dense.dense_search(asked, vectors, 5, metric)


def dense_topk_dot(spark, sf_dir):
    return _rounded(_dense(spark, sf_dir, "dot").select("query_id", "rank", "doc_id", "source", "score"), "score")


def dense_topk_l2(spark, sf_dir):
    return _rounded(
        _dense(spark, sf_dir, "l2sq").select("query_id", "rank", "doc_id", "source", "distance"), "distance"
    )


def _pivots(spark, sf_dir, metric):
    """Every vector asked for its nearest ones, from a stored index of pivots."""
    path = work_folder(spark, f"pivots-{metric}")
    vectors = _stored_vectors(spark, sf_dir)
    pivots.build(vectors, path, metric)
    return pivots.search(vectors.select(F.col("doc_id").alias("query_id"), "embedding"), pivots.load(spark, path), 5)


def dense_pivots_dot(spark, sf_dir):
    found = _pivots(spark, sf_dir, "dot")
    return _rounded(found.select("query_id", "rank", "doc_id", "source", "score"), "score")


def dense_pivots_l2(spark, sf_dir):
    found = _pivots(spark, sf_dir, "l2sq")
    return _rounded(found.select("query_id", "rank", "doc_id", "source", "distance"), "distance")


def _bytes(spark, sf_dir, metric):
    """Every vector asked for its nearest ones, from stored bytes with a bound of their error."""
    path = work_folder(spark, f"bytes-{metric}")
    vectors = _stored_vectors(spark, sf_dir)
    compact.build(vectors, path, metric)
    return compact.search(vectors.select(F.col("doc_id").alias("query_id"), "embedding"), compact.load(spark, path), 5)


def dense_bytes_dot(spark, sf_dir):
    found = _bytes(spark, sf_dir, "dot")
    return _rounded(found.select("query_id", "rank", "doc_id", "source", "score"), "score")


def dense_bytes_l2(spark, sf_dir):
    found = _bytes(spark, sf_dir, "l2sq")
    return _rounded(found.select("query_id", "rank", "doc_id", "source", "distance"), "distance")


def dense_topk_small(spark, sf_dir):
    """Vectors of length 1e-5: distances around 1e-10 rank like any others."""
    found = _dense(spark, sf_dir, "l2sq", 1e-5).withColumn("distance", F.col("distance") * 1e10)
    return _rounded(found.select("query_id", "rank", "doc_id", "source", "distance"), "distance")


def dense_topk_grid(spark, sf_dir):
    """Sixteen turned copies of every vector as queries: more than may be broadcast, so blocks meet blocks."""
    vectors = _stored_vectors(spark, sf_dir)
    turned = vectors.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(15))))
    moved = F.concat(
        F.slice("embedding", F.col("turn") + 1, F.size("embedding") - F.col("turn")),
        F.slice("embedding", F.lit(1), F.col("turn")),
    )
    asked = turned.select((F.col("doc_id") * 16 + F.col("turn")).alias("query_id"), moved.alias("embedding"))
    found = dense.dense_search(asked, vectors, 3, "dot")
    return _rounded(found.select("query_id", "rank", "doc_id", "score"), "score")


def normalised_vectors(spark, sf_dir):
    """Unit vectors of the stored ones after stretching them by their label."""
    e = _table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x * (F.col("label") + 1)).alias("v")
    )
    return e.select("vec_id", F.posexplode(dense.normalise(F.col("v"))).alias("pos", "w")).select(
        "vec_id", "pos", F.round("w", 5).alias("w")
    )


def rrf_fuse(spark, sf_dir):
    index, asked = _word_index(spark, sf_dir), questions(spark, sf_dir)
    chunks = index.chunks.drop("tokens", "dl")
    lists = [lexical.bm25_search(asked, index, 5), lexical.keyword_search(asked, chunks, 5)]
    return _ranked(fusion.rrf(lists, 5), "rrf_score")


def rerank_overlap(spark, sf_dir):
    results = fusion.rerank(questions(spark, sf_dir), _bm25(spark, sf_dir), 5)
    return _rounded(
        results.select("query_id", "rank", "doc_id", "chunk_no", "previous_rank", "rerank_score"),
        "rerank_score",
    )


def rerank_scores(spark, sf_dir):
    """Scores from a table that lacks every second result: those score 0 and stay."""
    results = materialise(_bm25(spark, sf_dir), "to-rerank")
    scores = results.filter("rank % 2 = 1").select(
        "query_id", "doc_id", "chunk_no", F.col("rank").cast("double").alias("rerank_score")
    )
    done = fusion.rerank(questions(spark, sf_dir), results, 5, scores=scores)
    return done.select("query_id", "rank", "doc_id", "chunk_no", "previous_rank", "rerank_score")


def rerank_tokens(spark, sf_dir):
    """Each query token's best match among the text's token vectors, summed."""
    results = materialise(_bm25(spark, sf_dir), "to-rerank")
    done = late.rerank(questions(spark, sf_dir), results, 5)
    return _rounded(done.select("query_id", "rank", "doc_id", "chunk_no", "previous_rank", "rerank_score"), "rerank_score")


def context_blocks(spark, sf_dir):
    return A.contexts(_keywords(spark, sf_dir))


def grounded_answer(spark, sf_dir):
    return A.answers(questions(spark, sf_dir), _keywords(spark, sf_dir))


def citations(spark, sf_dir):
    return A.citations(_keywords(spark, sf_dir))


def hybrid_search(spark, sf_dir):
    return _ranked(
        retrieval.hybrid_search(questions(spark, sf_dir), documents(spark, sf_dir)), "rrf_score"
    )


def question_answer(spark, sf_dir):
    done = retrieval.question_answer(questions(spark, sf_dir), documents(spark, sf_dir))
    named = F.format_string("%d:%s:%d", "citation_no", "citation", "doc_id")
    cited = done.citations.groupBy("query_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("citation_no", named.alias("c")))), lambda x: x["c"]), "; ")
        .alias("citations")
    )
    return (
        done.answers.join(done.contexts, "query_id", "left")
        .join(cited, "query_id", "left")
        .withColumn("citations", F.coalesce("citations", F.lit("")))
    )


# --------------------------------------------------------------- lineage ----


def _run_log(spark, sf_dir):
    """The events table read as a log of stage runs, one run per user and day."""
    e = _table(spark, sf_dir, "events")
    state = (
        F.when(F.col("event_type") == "view", "START")
        .when(F.col("event_type").isin("click", "purchase"), "COMPLETE")
        .when(F.col("event_type") == "error", "FAIL")
        .otherwise("RUNNING")
    )
    names = F.array(*[F.lit(s) for s in lineage.STAGES])
    return e.select(
        F.format_string("%d-%s", "user_id", F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.element_at(names, (F.pmod("user_id", F.lit(len(lineage.STAGES))) + 1).cast("int")).alias("stage"),
        state.alias("state"),
        F.col("ts").alias("event_time"),
    )


def lineage_events(spark, sf_dir):
    def listed(side):
        return F.array_join(F.transform(side, lambda d: d["name"]), ",").alias(side)

    return lineage.events_from_log(_run_log(spark, sf_dir)).select(
        "eventType",
        "eventTime",
        F.col("run.runId").alias("runId"),
        F.col("job.name").alias("job"),
        listed("inputs"),
        listed("outputs"),
    )


def lineage_refused(spark, sf_dir):
    return lineage.refused_events(_run_log(spark, sf_dir)).groupBy("stage", "state").agg(
        F.count("*").alias("events")
    )


def lineage_edges(spark, sf_dir):
    return lineage.lineage_edges(lineage.events_from_log(_run_log(spark, sf_dir)))


def lineage_upstream(spark, sf_dir):
    return lineage.upstream(lineage_edges(spark, sf_dir))


def lineage_closure(spark, sf_dir):
    """All ancestors in the graph of the run log, and in that of what users did after what, which has cycles and diamonds."""
    e = _table(spark, sf_dir, "events")
    after = F.lead("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    followed = e.select(F.col("event_type").alias("input"), after.alias("output")).distinct()
    # A chain of days leads into it.
    days = e.select(F.date_format("ts", "yyyy-MM-dd").alias("output"), F.date_format(F.date_sub(F.to_date("ts"), 1), "yyyy-MM-dd").alias("input"))
    into = e.select(F.col("event_type").alias("output"), F.date_format("ts", "yyyy-MM-dd").alias("input"))
    edges = lineage_edges(spark, sf_dir).select("input", "output")
    return lineage.closure(edges.unionByName(followed).unionByName(days.distinct()).unionByName(into.distinct()))


def lineage_log(spark, sf_dir):
    """Events appended to a log in two writes and read back, without clock and run columns."""
    path = work_folder(spark, "lineage-log")
    events = lineage.events_from_log(_run_log(spark, sf_dir))
    for part in (F.col("eventType") == "START", F.col("eventType") != "START"):
        files.append_json(events.filter(part), path)
    log = files.read_lineage(spark, path)
    return log.groupBy(
        "eventType", "producer", F.col("job.namespace").alias("namespace"), F.col("job.name").alias("job"),
        F.size("inputs").alias("n_inputs"), F.size("outputs").alias("n_outputs"),
    ).agg(F.count("*").alias("events"), F.count_distinct("run.runId").alias("runs"))


def run_states(spark, sf_dir):
    return lineage.run_states(lineage.events_from_log(_run_log(spark, sf_dir)))


QUERIES = {
    "message_encode": message_encode,
    "contract_valid": contract_valid,
    "contract_quarantine": contract_quarantine,
    "contract_counts": contract_counts,
    "contract_lax_types": contract_lax_types,
    "silver_orders": silver_orders,
    "silver_upsert": silver_upsert,
    "gold_product_sales": gold_product_sales,
    "gold_incremental": gold_incremental,
    "dq_results": dq_results,
    "dq_gate": dq_gate,
    "dq_failing_rows": dq_failing_rows,
    "schema_enforcement": schema_enforcement,
    "stream_ingest": stream_ingest,
    "stream_upsert": stream_upsert,
    "stream_counts": stream_counts,
    "bronze_refresh": bronze_refresh,
    "orders_job": orders_job,
    "gate_keeps_silver": gate_keeps_silver,
    "job_events": job_events,
    "paragraphs": paragraphs,
    "conversation_paragraphs": conversation_paragraphs,
    "documents_from_files": documents_from_files,
    "chunks_jsonl": chunks_jsonl,
    "chunk_words": chunk_words,
    "chunk_words_lines": chunk_words_lines,
    "chunk_chars_flat": chunk_chars_flat,
    "chunk_chars_para": chunk_chars_para,
    "chunk_preview": chunk_preview,
    "tokens_ws": _token_counts("ws"),
    "tokens_word": _token_counts("word"),
    "tokens_ascii": _token_counts("ascii"),
    "sentences": sentences,
    "stage_metrics": stage_metrics,
    "postings": postings,
    "doc_lengths": doc_lengths,
    "corpus_stats": corpus_stats,
    "term_stats": term_stats,
    "bm25_topk": bm25_topk,
    "bm25_stored": bm25_stored,
    "bm25_postings": bm25_postings,
    "keyword_postings": keyword_postings,
    "bm25_topk_padded": bm25_topk_padded,
    "keyword_topk": keyword_topk,
    "hashed_vectors": hashed_vectors,
    "vector_table": vector_table,
    "vector_ids": vector_ids,
    "normalised_vectors": normalised_vectors,
    "dense_topk_dot": dense_topk_dot,
    "dense_topk_l2": dense_topk_l2,
    "dense_pivots_dot": dense_pivots_dot,
    "dense_pivots_l2": dense_pivots_l2,
    "dense_bytes_dot": dense_bytes_dot,
    "dense_bytes_l2": dense_bytes_l2,
    "dense_topk_small": dense_topk_small,
    "dense_topk_grid": dense_topk_grid,
    "rrf_fuse": rrf_fuse,
    "rerank_overlap": rerank_overlap,
    "rerank_scores": rerank_scores,
    "rerank_tokens": rerank_tokens,
    "context_blocks": context_blocks,
    "grounded_answer": grounded_answer,
    "citations": citations,
    "hybrid_search": hybrid_search,
    "question_answer": question_answer,
    "lineage_events": lineage_events,
    "lineage_log": lineage_log,
    "lineage_refused": lineage_refused,
    "lineage_edges": lineage_edges,
    "lineage_upstream": lineage_upstream,
    "lineage_closure": lineage_closure,
    "run_states": run_states,
}
