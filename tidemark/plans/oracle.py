"""The same queries in DuckDB SQL, written from the rules and not from the plans.

Pieces that several queries need are WITH items; ``_with`` puts them together.
"""

# The answer where nothing was retrieved, and what each stage reads and writes.
NOT_FOUND = "I could not find relevant information in the knowledge base."
STAGES = {
    "producer": ((), ("kafka_orders",)),
    "ingestion": (("kafka_orders",), ("raw_orders",)),
    "bronze": (("raw_orders",), ("bronze_orders",)),
    "silver": (("bronze_orders",), ("silver_orders",)),
    "quality_gate": (("silver_orders",), ("quality_checked_silver",)),
    "gold": (("silver_orders",), ("product_sales",)),
    "lineage": (("silver_orders",), ("product_sales",)),
}
# White space as Unicode text processing has it.
_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{_WS}+'), lambda w: w <> '')"


def _tokens(x: str, mode: str) -> str:
    if mode == "ws":
        return _words(f"lower({x})")
    found = rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]+')"
    if mode == "word":
        return found
    return f"list_filter({found}, lambda w: regexp_full_match(w, '[a-z0-9]+'))"


def _with(body: str, *items: str) -> str:
    return ("WITH " + ",\n".join(items) + "\n" if items else "") + body


# ---------------------------------------------------------------- orders ----

_LINES = """lines AS (
  SELECT 'ORD-' || l_orderkey || '-' || l_linenumber AS order_id,
         'CUST-' || o_custkey AS customer_id, p_type AS product,
         CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice / l_quantity AS price,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         (l_orderkey * 7 + l_linenumber) % 40 AS fault
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

_REASONS = """judged AS (
  SELECT *, CASE fault
    WHEN 1 THEN 'quantity:positive_integer' WHEN 2 THEN 'price:positive_number'
    WHEN 3 THEN 'product:non_empty_string' WHEN 4 THEN 'status:allowed_value'
    WHEN 5 THEN 'timestamp:string' WHEN 6 THEN 'malformed_json'
    WHEN 8 THEN 'quantity:positive_integer' WHEN 11 THEN 'customer_id:non_empty_string'
    WHEN 12 THEN 'not_an_object' WHEN 13 THEN 'product:non_empty_string'
    WHEN 16 THEN 'quantity:positive_integer' WHEN 17 THEN 'quantity:positive_integer'
    WHEN 19 THEN 'price:positive_number' WHEN 20 THEN 'price:positive_number'
    WHEN 21 THEN 'price:positive_number' WHEN 23 THEN 'status:allowed_value'
    WHEN 24 THEN 'timestamp:string' WHEN 26 THEN 'not_an_object'
    WHEN 28 THEN 'malformed_json'
    WHEN 29 THEN 'quantity:positive_integer; price:positive_number'
    WHEN 33 THEN 'price:positive_number' END AS reason
  FROM lines)"""

_VALID = """valid AS (
  SELECT customer_id, order_id, CASE fault WHEN 22 THEN 1.0::DOUBLE ELSE price END AS price, product,
         CASE fault WHEN 14 THEN 1 ELSE quantity END AS quantity, status,
         CASE fault WHEN 25 THEN '' ELSE "timestamp" END AS "timestamp"
  FROM judged WHERE reason IS NULL)"""

_SILVER = """silver AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY "timestamp" DESC, customer_id DESC,
      price DESC, product DESC, quantity DESC, status DESC) AS n
    FROM (SELECT *, quantity * price AS total_amount FROM valid)) WHERE n = 1)"""

_REVISED = """revised AS (
  SELECT 'CUST-' || o_custkey AS customer_id, 'ORD-' || o_orderkey || '-1' AS order_id,
         o_totalprice AS price, o_orderpriority AS product, CAST(1 AS BIGINT) AS quantity,
         'completed' AS status, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         o_totalprice AS total_amount FROM orders)"""

_ORDERS = (_LINES, _REASONS, _VALID, _SILVER)

_OBSERVED = """observed AS (
  SELECT order_id AS line_id, CASE WHEN fault <> 30 THEN order_id END AS order_id,
         CASE fault WHEN 1 THEN 0 WHEN 31 THEN NULL ELSE quantity END AS quantity,
         CASE fault WHEN 2 THEN -price ELSE price END AS price FROM lines)"""

_SILVER_COLUMNS = 'customer_id, order_id, price, product, quantity, status, "timestamp", total_amount'

_UPSERT = _with(
    f"""SELECT {_SILVER_COLUMNS} FROM (
  SELECT * FROM revised UNION ALL BY NAME
  SELECT * FROM silver WHERE order_id NOT IN (SELECT order_id FROM revised))""",
    *_ORDERS,
    _REVISED,
)


def _checks(batch: str) -> str:
    def one(name, column, bad, judged):
        return f"""SELECT '{name}' AS check_name, '{column}' AS column_name, count(*) AS element_count,
      count(*) FILTER ({column} IS NULL) AS missing_count, count(*) FILTER ({bad}) AS unexpected_count,
      {judged} AS judged FROM {batch}"""

    parts = [
        one("order_id:not_null", "order_id", "order_id IS NULL", "count(*)"),
        one("quantity:between", "quantity", "quantity < 1 OR quantity > 1000", "count(quantity)"),
        one("price:between", "price", "price < 0.01 OR price > 1000000", "count(price)"),
    ]
    return f"""SELECT check_name, column_name, element_count, missing_count, unexpected_count,
    round(100.0::DOUBLE * unexpected_count / judged, 6) AS unexpected_percent,
    unexpected_count = 0 AS success FROM ({" UNION ALL ".join(parts)})"""


_LAX = """SELECT quantity_kind, price_kind, reason IS NULL AS is_valid, count(*) AS messages,
  CAST(sum(q) AS BIGINT) AS quantity, round(sum(p), 2) AS price FROM (
  SELECT reason,
    CASE WHEN fault IN (6, 12, 26, 28) THEN NULL WHEN fault IN (7, 9, 16) THEN 'STRING'
         WHEN fault = 14 THEN 'BOOLEAN' WHEN fault = 17 THEN 'ARRAY<NUMBER>' ELSE 'NUMBER' END AS quantity_kind,
    CASE WHEN fault IN (6, 12, 26, 28) THEN NULL WHEN fault IN (10, 20, 21, 33, 34) THEN 'STRING'
         WHEN fault = 22 THEN 'BOOLEAN' ELSE 'NUMBER' END AS price_kind,
    CASE WHEN fault IN (6, 8, 12, 16, 17, 26, 28) THEN NULL WHEN fault = 1 THEN 0 WHEN fault = 14 THEN 1
         WHEN fault = 29 THEN -1 ELSE quantity END AS q,
    CASE WHEN fault IN (6, 12, 20, 21, 26, 28, 33) THEN NULL WHEN fault = 2 THEN -price WHEN fault = 19 THEN 0
         WHEN fault = 22 THEN 1 WHEN fault = 29 THEN -1 ELSE price END AS p
  FROM judged) GROUP BY ALL"""

# ------------------------------------------------------------------ text ----


def _paragraphs(sep: str, name: str = "paras") -> str:
    pieces = f"list_transform(string_split(text, {sep}), lambda p: {_strip('p')})"
    return f"""{name}_l AS (SELECT doc_id, source, list_filter({pieces}, lambda p: p <> '') AS ps FROM documents),
{name} AS (SELECT doc_id, source, unnest(ps) AS paragraph, generate_subscripts(ps, 1) AS para_no FROM {name}_l)"""


def _word_chunks(size: int, overlap: int, sep: str) -> str:
    step = size - overlap
    return f"""{_paragraphs(sep)},
para_words AS (SELECT *, {_words("paragraph")} AS w FROM paras),
para_cut AS (
  SELECT doc_id, source, para_no, CASE WHEN len(w) <= {size} THEN [paragraph] ELSE
    list_transform(range(0, CAST(ceil((len(w) - {size}) / {step}.0) AS BIGINT) + 1),
      lambda i: array_to_string(w[i * {step} + 1 : i * {step} + {size}], ' ')) END AS cs FROM para_words),
para_chunks AS (SELECT doc_id, source, para_no, unnest(cs) AS text, generate_subscripts(cs, 1) AS win FROM para_cut),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY para_no, win) AS n FROM para_chunks),
chunks AS (SELECT doc_id, CAST(n AS INTEGER) AS chunk_no, printf('chunk-%03d', n) AS chunk_id, source, text FROM numbered)"""


_NL2 = "chr(10) || chr(10)"
_WORD_CHUNKS = _word_chunks(80, 15, _NL2)


def _char_chunks(clean: str, size: int, overlap: int, label: str) -> str:
    step = size - overlap
    return f"""cleaned AS (SELECT doc_id, source, {_strip(clean)} AS t FROM documents),
cut AS (
  SELECT doc_id, source, list_filter(list_transform(
    range(0, CASE WHEN length(t) = 0 THEN 0 WHEN length(t) <= {size} THEN 1
             ELSE CAST(ceil((length(t) - {size}) / {step}.0) AS BIGINT) + 1 END),
    lambda i: {_strip(f"substring(t, i * {step} + 1, {size})")}), lambda c: c <> '') AS cs FROM cleaned),
numbered AS (SELECT doc_id, source, unnest(cs) AS text, generate_subscripts(cs, 1) - 1 AS n FROM cut),
chunks AS (SELECT doc_id, CAST(n AS INTEGER) AS chunk_no, printf('{label}', n) AS chunk_id, source, text FROM numbered)"""


_FLAT = _char_chunks(f"regexp_replace(text, '{_WS}+', ' ', 'g')", 500, 100, "chunk_%d")
_PARA = _char_chunks(
    r"regexp_replace(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), "
    r"'[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')",
    500,
    80,
    "chunk_%04d",
)
_CHUNK_COLUMNS = "SELECT doc_id, chunk_no, chunk_id, source, text FROM chunks"


def _token_counts(mode: str) -> str:
    return f"""SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest({_tokens("text", mode)}) AS term FROM documents) GROUP BY ALL"""


def _sentence_list(x: str) -> str:
    marked = rf"regexp_replace({x}, '([.!?]){_WS}+', '\1' || chr(1), 'g')"
    return (
        f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {_strip('s')}), lambda s: s <> '')"
    )


def _sizes(stage: str, table: str) -> str:
    return f"""SELECT '{stage}' AS stage, count(*) AS rows, CAST(sum(length(text)) AS BIGINT) AS characters,
  CAST(sum(len({_words("text")})) AS BIGINT) AS words FROM {table}"""


# ------------------------------------------------------------- retrieval ----


def _significant(x: str) -> str:
    """12 significant digits, so that the order of a sum decides nothing."""
    return f"CASE WHEN {x} = 0 THEN 0::DOUBLE ELSE round({x}, 11 - CAST(floor(log10(abs({x}))) AS INTEGER)) END"


def _terms(mode: str) -> str:
    """Token tables of the chunks and the queries, and the corpus constants."""
    return f"""tok AS MATERIALIZED (SELECT doc_id, chunk_no, {_tokens("text", mode)} AS ts FROM chunks),
tf AS MATERIALIZED (SELECT doc_id, chunk_no, term, count(*) AS tf
       FROM (SELECT doc_id, chunk_no, unnest(ts) AS term FROM tok) GROUP BY ALL),
dl AS (SELECT doc_id, chunk_no, len(ts) AS dl FROM tok),
corpus AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
df AS MATERIALIZED (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw_idf AS (SELECT term, df, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS idf0 FROM df, corpus),
mean_idf AS (SELECT count(*) AS n_terms, avg(idf0) AS avg_idf FROM raw_idf),
idf AS (SELECT term, df, CASE WHEN idf0 < 0 THEN 0.25::DOUBLE * avg_idf ELSE idf0 END AS idf FROM raw_idf, mean_idf),
qtf AS (SELECT query_id, term, count(*) AS qtf FROM (
  SELECT item_id AS query_id, unnest({_tokens("text", mode)}) AS term FROM benchmark) GROUP BY ALL)"""


def _short(sql: str, mode: str) -> str:
    """``sql`` with the five longest words of each item of ``benchmark`` as its questions."""
    words = f"list_sort(list_distinct({_tokens('text', mode)}))"
    five = f"""list_transform(list_sort(list_transform({words}, lambda w: {{'l': -length(w), 'w': w}}))[1:5], lambda s: s.w)"""
    asked = f"(SELECT item_id, array_to_string({five}, ' ') AS text FROM benchmark) AS asked"
    return sql.replace("FROM benchmark", f"FROM {asked}")


def _rank_list(name: str, scored: str, order: str, score: str, k: int = 5) -> str:
    """Top k of (query_id, doc_id, chunk_no, <score>) with the chunk's columns."""
    return f"""{name} AS (
  SELECT r.query_id, r.rank, r.doc_id, r.chunk_no, c.chunk_id, c.source, c.text, r.{score} FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS INTEGER) AS rank FROM {scored}) r
  JOIN chunks c USING (doc_id, chunk_no) WHERE r.rank <= {k})"""


_BM25_SUM = """bm25_sum AS (
  SELECT query_id, doc_id, chunk_no, {significant} AS score FROM (
    SELECT query_id, doc_id, chunk_no, sum(qtf * idf * tf * 2.5::DOUBLE
      / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) AS s
    FROM qtf JOIN idf USING (term) JOIN tf USING (term) JOIN dl USING (doc_id, chunk_no), corpus GROUP BY ALL))"""
_BM25_SUM = _BM25_SUM.replace("{significant}", _significant("s"))
_BM25_POSITIVE = "bm25_pos AS (SELECT * FROM bm25_sum WHERE score > 0)"
_BM25_PADDED = """bm25_all AS (
  SELECT b.item_id AS query_id, c.doc_id, c.chunk_no, coalesce(s.score, 0) AS score
  FROM benchmark b CROSS JOIN dl c
  LEFT JOIN bm25_sum s ON s.query_id = b.item_id AND s.doc_id = c.doc_id AND s.chunk_no = c.chunk_no)"""
_BY_SCORE = "score DESC, doc_id, chunk_no"


def _keyword_sum() -> str:
    """Own token tables, so that it can stand beside a BM25 in another mode."""
    return f"""ktf AS (SELECT doc_id, chunk_no, term, count(*) AS tf FROM (
  SELECT doc_id, chunk_no, unnest({_tokens("text", "ascii")}) AS term FROM chunks) GROUP BY ALL),
kq AS (SELECT query_id, term, count(*) AS qtf FROM (
  SELECT item_id AS query_id, unnest({_tokens("text", "ascii")}) AS term FROM benchmark) GROUP BY ALL),
key_sum AS (SELECT query_id, doc_id, chunk_no, CAST(sum(qtf * tf) AS DOUBLE) AS score
  FROM kq JOIN ktf USING (term) GROUP BY ALL)"""


_BM25 = (_WORD_CHUNKS, _terms("ws"), _BM25_SUM, _BM25_POSITIVE, _rank_list("bm25", "bm25_pos", _BY_SCORE, "score"))
_KEYWORDS = (_WORD_CHUNKS, _keyword_sum(), _rank_list("keywords", "key_sum", _BY_SCORE, "score"))


def _fused(name: str, first: str, second: str) -> str:
    return f"""{name}_parts AS (
  SELECT query_id, doc_id, chunk_no, 0 AS list_no, rank FROM {first}
  UNION ALL SELECT query_id, doc_id, chunk_no, 1, rank FROM {second}),
{name}_sum AS (
  SELECT query_id, doc_id, chunk_no, sum(1.0::DOUBLE / (60 + rank)) AS rrf_score, min(list_no) AS list_no,
    arg_min(rank, list_no) AS first_rank FROM {name}_parts GROUP BY ALL),
{_rank_list(name, name + "_sum", "round(rrf_score, 12) DESC, list_no, first_rank", "rrf_score")}"""


def _reranked(name: str, results: str) -> str:
    return f"""{name}_scored AS (
  SELECT r.* EXCLUDE (rank), r.rank AS previous_rank, CASE WHEN len(q) = 0 THEN 0::DOUBLE
      ELSE len(list_intersect(q, list_distinct(d)))::DOUBLE / len(q) END AS rerank_score
  FROM (SELECT {results}.*, list_distinct({_tokens("b.text", "ascii")}) AS q,
               {_tokens(results + ".text", "ascii")} AS d
        FROM {results} JOIN benchmark b ON b.item_id = {results}.query_id) r),
{name} AS (SELECT * EXCLUDE (rank), CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, previous_rank) AS rank
  FROM {name}_scored) WHERE rank <= 5)"""


def _token_scores(results: str) -> str:
    """Sum over the query's tokens of the best product with a token of the text; a token is the unit vector of its trigrams."""
    asked = f"SELECT item_id AS query_id, unnest({_tokens('text', 'ascii')}) AS term FROM benchmark"
    gram = "('0x' || substr(md5(substring('^' || term || '$', i, 3)), 1, 8))::BIGINT % 256"
    return f"""asked AS MATERIALIZED (SELECT query_id, term, count(*) AS n FROM ({asked}) GROUP BY ALL),
held AS MATERIALIZED (SELECT DISTINCT query_id, doc_id, chunk_no, term FROM (
  SELECT query_id, doc_id, chunk_no, unnest({_tokens("text", "ascii")}) AS term FROM {results})),
vocabulary AS (SELECT term FROM asked UNION SELECT term FROM held),
grams AS MATERIALIZED (SELECT term, bucket, count(*) AS n FROM (
  SELECT term, {gram} AS bucket FROM (SELECT term, unnest(range(1, length(term) + 1)) AS i FROM vocabulary)) GROUP BY ALL),
lengths AS MATERIALIZED (SELECT term, sqrt(sum(n * n)) AS length FROM grams GROUP BY term),
met AS MATERIALIZED (SELECT DISTINCT a.term AS one, h.term AS other FROM asked a JOIN held h USING (query_id)),
alike AS MATERIALIZED (SELECT one, other, sum(x.n * y.n) / (any_value(lx.length) * any_value(ly.length)) AS alike
  FROM met JOIN grams x ON x.term = one JOIN grams y ON y.term = other AND y.bucket = x.bucket
  JOIN lengths lx ON lx.term = one JOIN lengths ly ON ly.term = other GROUP BY ALL),
best AS (SELECT h.query_id, doc_id, chunk_no, a.term, any_value(a.n) AS n, max(coalesce(alike, 0)) AS best
  FROM held h JOIN asked a USING (query_id) LEFT JOIN alike ON one = a.term AND other = h.term GROUP BY ALL),
token_sum AS (SELECT query_id, doc_id, chunk_no, sum(n * best) AS s FROM best GROUP BY ALL),
token_scores AS (SELECT r.query_id, r.doc_id, r.chunk_no, r.rank, coalesce({_significant("s")}, 0) AS rerank_score
  FROM {results} r LEFT JOIN token_sum USING (query_id, doc_id, chunk_no))"""


def _answers(results: str) -> str:
    return f"""sent AS (
  SELECT query_id, rank, unnest(ss) AS sentence, generate_subscripts(ss, 1) AS sentence_no FROM (
    SELECT query_id, rank, {_sentence_list("text")} AS ss FROM {results})),
shared AS (
  SELECT s.*, len(list_intersect(list_distinct({_tokens("b.text", "ascii")}),
                                 list_distinct({_tokens("s.sentence", "ascii")}))) AS overlap
  FROM sent s JOIN benchmark b ON b.item_id = s.query_id),
picked AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, rank, sentence_no) AS place
  FROM shared WHERE overlap > 0) WHERE place <= 3),
once AS (SELECT query_id, sentence, min(place) AS place FROM picked GROUP BY ALL),
extracts AS (SELECT query_id, string_agg(sentence, ' ' ORDER BY place) AS extract FROM once GROUP BY ALL),
answered AS (
  SELECT b.item_id AS query_id, b.text AS query, coalesce(e.extract, t.text, '{NOT_FOUND}') AS answer
  FROM benchmark b LEFT JOIN extracts e ON e.query_id = b.item_id
  LEFT JOIN (SELECT * FROM {results} WHERE rank = 1) t ON t.query_id = b.item_id)"""


def _contexts(results: str) -> str:
    block = (
        "chr(10) || '[Context ' || rank || ']' || chr(10) || 'Source: ' || source || chr(10) || "
        "'Chunk ID: ' || chunk_id || chr(10) || chr(10) || text || chr(10)"
    )
    return f"""contexts AS (
  SELECT query_id, string_agg({block}, chr(10) ORDER BY rank) AS context FROM {results} GROUP BY query_id)"""


def _citations(results: str) -> str:
    return f"""citations AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) AS INTEGER) AS citation_no,
    doc_id, chunk_no, source || ' (' || chunk_id || ')' AS citation
  FROM (SELECT query_id, doc_id, chunk_no, source, chunk_id, min(rank) AS rank FROM {results} GROUP BY ALL))"""


def _buckets(x: str) -> str:
    return (
        f"list_transform({_tokens(x, 'word')}, lambda t: ('0x' || substr(md5(t), 1, 8))::BIGINT % 256)"
    )


def _hashed() -> str:
    """Sparse unit vectors of chunks (cv) and queries (qv), as 32-bit floats."""

    def unit(name, key, counts):
        return f"""{name}_w AS (SELECT {key}, bucket, n * idf AS w FROM {counts} JOIN bidf USING (bucket)),
{name}_n AS (SELECT {key}, sqrt(sum(w * w)) AS norm FROM {name}_w GROUP BY {key}),
{name} AS (SELECT {key}, bucket, CAST(w / norm AS FLOAT)::DOUBLE AS w FROM {name}_w JOIN {name}_n USING ({key}))"""

    return f"""cb AS (SELECT doc_id, chunk_no, bucket, count(*) AS n FROM (
  SELECT doc_id, chunk_no, unnest({_buckets("text")}) AS bucket FROM chunks) GROUP BY ALL),
qb AS (SELECT query_id, bucket, count(*) AS n FROM (
  SELECT item_id AS query_id, unnest({_buckets("text")}) AS bucket FROM benchmark) GROUP BY ALL),
n_chunks AS (SELECT count(*) AS total FROM chunks),
bdf AS (SELECT bucket, count(*) AS df FROM cb GROUP BY bucket),
bidf AS (SELECT b.bucket, ln((1.0::DOUBLE + total) / (1 + coalesce(df, 0))) + 1 AS idf
  FROM (SELECT unnest(range(0, 256)) AS bucket) b LEFT JOIN bdf ON bdf.bucket = b.bucket, n_chunks),
{unit("cv", "doc_id, chunk_no", "cb")},
{unit("qv", "query_id", "qb")},
dots AS (SELECT query_id, doc_id, chunk_no, sum(cv.w * qv.w) AS dot FROM cv JOIN qv USING (bucket) GROUP BY ALL),
every AS (SELECT b.item_id AS query_id, c.doc_id, c.chunk_no, coalesce(d.dot, 0) AS dot,
    coalesce(c2, 0) AS c2, coalesce(q2, 0) AS q2
  FROM benchmark b CROSS JOIN chunks c
  LEFT JOIN dots d ON d.query_id = b.item_id AND d.doc_id = c.doc_id AND d.chunk_no = c.chunk_no
  LEFT JOIN (SELECT doc_id, chunk_no, sum(w * w) AS c2 FROM cv GROUP BY ALL) x
    ON x.doc_id = c.doc_id AND x.chunk_no = c.chunk_no
  LEFT JOIN (SELECT query_id, sum(w * w) AS q2 FROM qv GROUP BY ALL) y ON y.query_id = b.item_id)"""


def _stored(score: str, order: str, name: str) -> str:
    return f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, source, round({name}, 6) AS {name} FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}, doc_id) AS rank FROM (
    SELECT query_id, doc_id, source, {_significant("s")} AS {name} FROM (
      SELECT q.vec_id AS query_id, v.vec_id AS doc_id, 'label-' || v.label AS source, {score} AS s
      FROM embeddings q CROSS JOIN embeddings v))) WHERE rank <= 5"""


def _ranked(name: str, score: str) -> str:
    return f"SELECT query_id, rank, doc_id, chunk_no, chunk_id, source, text, round({score}, 6) AS {score} FROM {name}"


# --------------------------------------------------------------- lineage ----

_STAGE_LIST = ", ".join(f"'{s}'" for s in STAGES)


def _sides(side: int) -> str:
    cases = " ".join(f"WHEN '{s}' THEN '{','.join(sides[side])}'" for s, sides in STAGES.items())
    return f"CASE stage {cases} END"


_LOG = f"""log AS (
  SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS run_id, [{_STAGE_LIST}][user_id % {len(STAGES)} + 1] AS stage,
    CASE event_type WHEN 'view' THEN 'START' WHEN 'click' THEN 'COMPLETE' WHEN 'purchase' THEN 'COMPLETE'
      WHEN 'error' THEN 'FAIL' ELSE 'RUNNING' END AS state, ts FROM events)"""

_EDGES = f"""edges AS (
  SELECT stage AS job, nullif({_sides(0)}, '') AS input, nullif({_sides(1)}, '') AS output, count(*) AS runs
  FROM log WHERE state = 'COMPLETE' GROUP BY ALL)"""


def _stage_row(stage: str, passed: int, failed: int) -> str:
    sides = [",".join(f"order-lakehouse/{d}" for d in side) for side in STAGES[stage]]
    return f"('{stage}', '{sides[0]}', '{sides[1]}', {passed}, {failed})"


ORACLE = {
    "message_encode": _with(
        'SELECT order_id AS message_key, customer_id, product, quantity, price, status, "timestamp" FROM lines',
        _LINES,
    ),
    "contract_valid": _with(
        'SELECT customer_id, order_id, price, product, quantity, status, "timestamp" FROM valid',
        _LINES, _REASONS, _VALID,
    ),
    "contract_quarantine": _with(
        """SELECT reason,
  CASE fault WHEN 26 THEN '"' || order_id || '"' WHEN 28 THEN 'FF{' || sent || '}' WHEN 12 THEN '[{' || sent || '}]'
             WHEN 6 THEN '{' || sent ELSE '{' || sent || '}' END AS raw,
  CASE WHEN fault <> 26 THEN amount END AS raw_price,
  CASE fault WHEN 26 THEN order_id WHEN 12 THEN '[{' || sorted || '}]'
             WHEN 6 THEN NULL WHEN 28 THEN NULL ELSE '{' || sorted || '}' END AS record,
  CASE WHEN fault NOT IN (6, 26, 28) THEN amount END AS record_price
FROM (SELECT *,
    concat_ws(',', named_order, named_customer, named_product, named_quantity, named_price, named_status, named_time) AS sent,
    concat_ws(',', named_customer, named_order, named_price, named_product, named_quantity, named_status, named_time) AS sorted
  FROM written)""",
        _LINES, _REASONS,
        """written AS (
  SELECT fault, order_id, reason,
    '"order_id":"' || order_id || '"' AS named_order,
    '"customer_id":' || CASE fault WHEN 11 THEN substr(customer_id, 6) ELSE '"' || customer_id || '"' END AS named_customer,
    '"product":' || CASE fault WHEN 3 THEN '""' WHEN 13 THEN 'null' ELSE '"' || product || '"' END AS named_product,
    '"quantity":' || CASE fault WHEN 1 THEN '0' WHEN 8 THEN quantity || '.5' WHEN 16 THEN '"x"'
      WHEN 17 THEN '[' || quantity || ']' WHEN 29 THEN '-1' ELSE quantity::VARCHAR END AS named_quantity,
    '"price":' || CASE fault WHEN 20 THEN '"NaN"' WHEN 21 THEN '"abc"' WHEN 33 THEN '"10.5d"' ELSE '#' END AS named_price,
    CASE WHEN fault IN (20, 21, 33) THEN NULL WHEN fault = 2 THEN round(-price, 9) WHEN fault = 19 THEN 0
         WHEN fault = 29 THEN -1 ELSE round(price, 9) END::DOUBLE AS amount,
    '"status":' || CASE fault WHEN 4 THEN '"shipped"' WHEN 23 THEN '"Completed"' ELSE '"' || status || '"' END AS named_status,
    CASE fault WHEN 5 THEN NULL WHEN 24 THEN '"timestamp":5' ELSE '"timestamp":"' || "timestamp" || '"' END AS named_time
  FROM judged WHERE reason IS NOT NULL)""",
    ),
    "contract_counts": _with(
        """SELECT count(*) AS received, count(*) FILTER (reason IS NULL) AS valid,
  count(*) FILTER (reason IS NOT NULL) AS quarantined FROM judged""",
        _LINES, _REASONS,
    ),
    "contract_lax_types": _with(_LAX, _LINES, _REASONS),
    "silver_orders": _with(f"SELECT {_SILVER_COLUMNS} FROM silver", *_ORDERS),
    "silver_upsert": _UPSERT,
    "gold_product_sales": _with(
        """SELECT product, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  round(sum(total_amount), 2) AS total_revenue FROM silver GROUP BY product""",
        *_ORDERS,
    ),
    "gold_incremental": _with(
        """SELECT product, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  round(sum(total_amount), 2) AS total_revenue FROM merged GROUP BY product""",
        *_ORDERS, _REVISED,
        """merged AS (
  SELECT * FROM revised UNION ALL BY NAME
  SELECT * FROM silver WHERE order_id NOT IN (SELECT order_id FROM revised))""",
    ),
    "dq_results": _with(_checks("observed"), _LINES, _OBSERVED),
    "dq_gate": _with(
        f"""SELECT bool_and(success) AS passed, count(*) FILTER (NOT success) AS failed_checks, 'observed' AS batch
FROM ({_checks("observed")})
UNION ALL SELECT bool_and(success), count(*) FILTER (NOT success), 'silver' FROM ({_checks("silver")})""",
        *_ORDERS, _OBSERVED,
    ),
    "dq_failing_rows": _with(
        """SELECT check_name, line_id, round(observed, 6) AS observed, CAST(sample_no AS INTEGER) AS sample_no FROM (
  SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY line_id, CAST(observed AS VARCHAR)) AS sample_no FROM (
    SELECT 'order_id:not_null' AS check_name, line_id, CAST(NULL AS DOUBLE) AS observed FROM observed WHERE order_id IS NULL
    UNION ALL SELECT 'quantity:between', line_id, quantity FROM observed WHERE quantity < 1 OR quantity > 1000
    UNION ALL SELECT 'price:between', line_id, price FROM observed WHERE price < 0.01 OR price > 1000000))
WHERE sample_no <= 20""",
        _LINES, _OBSERVED,
    ),
    "schema_enforcement": """SELECT column_name, problem, expected, found, rows_rejected FROM (VALUES
  ('price', 'type', 'double', 'string'), ('status', 'missing', 'string', ''), ('note', 'unknown', '', 'int'))
  AS t(column_name, problem, expected, found), (SELECT count(*) AS rows_rejected FROM orders)""",
    "stream_ingest": _with(
        """SELECT order_id, customer_id, product, quantity, price, status, "timestamp", NULL AS reason FROM valid
UNION ALL SELECT CASE fault WHEN 28 THEN '' ELSE order_id END, NULL, NULL, NULL, NULL, NULL, NULL, reason
FROM judged WHERE reason IS NOT NULL""",
        _LINES, _REASONS, _VALID,
    ),
    "stream_upsert": _UPSERT,
    "stream_counts": _with(
        """SELECT count(*) AS received, count(*) FILTER (reason IS NULL) AS valid,
  count(*) FILTER (reason IS NOT NULL) AS quarantined, 0 AS unread_files FROM judged""",
        _LINES, _REASONS,
    ),
    "bronze_refresh": _with(
        'SELECT customer_id, order_id, price, product, quantity, status, "timestamp" FROM valid',
        _LINES, _REASONS, _VALID,
    ),
    "orders_job": _with(
        """SELECT product, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  round(sum(total_amount), 2) AS total_revenue FROM silver GROUP BY product""",
        *_ORDERS,
    ),
    "gate_keeps_silver": _with(f"SELECT {_SILVER_COLUMNS} FROM silver", *_ORDERS),
    "job_events": f"""WITH stages(job, inputs, outputs, passed, failed) AS (VALUES
  {", ".join(_stage_row(*row) for row in (("ingestion", 2, 0), ("bronze", 2, 0), ("silver", 2, 0), ("quality_gate", 1, 1), ("gold", 1, 0)))}),
each AS (
  SELECT 'START' AS "eventType", job, inputs, '' AS outputs, passed + failed AS n FROM stages
  UNION ALL SELECT 'COMPLETE', job, inputs, outputs, passed FROM stages
  UNION ALL SELECT 'FAIL', job, inputs, outputs, failed FROM stages)
SELECT "eventType", 'tidemark' AS producer, 'order-lakehouse' AS namespace, job, inputs, outputs,
  CAST(n AS BIGINT) AS events, CAST(n AS BIGINT) AS good_ids, CAST(n AS BIGINT) AS good_clocks, CAST(n AS BIGINT) AS good_pairs
FROM each WHERE n > 0 AND (SELECT count(*) FROM orders) > 0""",
    "paragraphs": _with("SELECT doc_id, CAST(para_no AS INTEGER) AS para_no, paragraph FROM paras", _paragraphs("chr(10)")),
    "conversation_paragraphs": f"""WITH turns AS (
  SELECT conv_id, turn, {_strip(r"regexp_replace(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')")} AS t
  FROM conversations),
pieces AS (SELECT conv_id, turn, unnest(ps) AS paragraph, generate_subscripts(ps, 1) AS n FROM (
  SELECT conv_id, turn, list_filter(list_transform(string_split(t, chr(10) || chr(10)), lambda p: {_strip("p")}),
    lambda p: p <> '') AS ps FROM turns))
SELECT conv_id AS doc_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, n) AS INTEGER) AS para_no, paragraph
FROM pieces""",
    "documents_from_files": f"""SELECT md5(text || chr(10)) AS text_md5, count(*) AS files, count(*) AS ids, count(*) AS named FROM documents
WHERE {_strip("text")} <> '' GROUP BY 1""",
    "chunks_jsonl": _with(_CHUNK_COLUMNS, _WORD_CHUNKS),
    "chunk_words": _with(_CHUNK_COLUMNS, _WORD_CHUNKS),
    "chunk_words_lines": _with(_CHUNK_COLUMNS, _word_chunks(20, 5, "chr(10)")),
    "chunk_chars_flat": _with(_CHUNK_COLUMNS, _FLAT),
    "chunk_chars_para": _with(_CHUNK_COLUMNS, _PARA),
    "chunk_preview": _with(
        """SELECT doc_id, chunk_no, chunk_id, source, substring(text, 1, 60) AS text FROM chunks
ORDER BY doc_id, chunk_no LIMIT 20""",
        _WORD_CHUNKS,
    ),
    "tokens_ws": _token_counts("ws"),
    "tokens_word": _token_counts("word"),
    "tokens_ascii": _token_counts("ascii"),
    "sentences": f"""SELECT doc_id, CAST(generate_subscripts(ss, 1) AS INTEGER) AS sentence_no, unnest(ss) AS sentence
FROM (SELECT doc_id, {_sentence_list("text")} AS ss FROM documents)""",
    "stage_metrics": f"""{_sizes("documents", "documents")}
UNION ALL SELECT * FROM ({_with(_sizes("word chunks", "chunks"), _WORD_CHUNKS)})
UNION ALL SELECT * FROM ({_with(_sizes("flat chunks", "chunks"), _FLAT)})""",
    "postings": _with("SELECT doc_id, chunk_no, term, tf FROM tf", _WORD_CHUNKS, _terms("ws")),
    "doc_lengths": _with("SELECT doc_id, chunk_no, CAST(dl AS INTEGER) AS dl FROM dl", _WORD_CHUNKS, _terms("ws")),
    "corpus_stats": _with(
        "SELECT n AS n_chunks, round(avgdl, 6) AS avgdl, n_terms, round(avg_idf, 6) AS avg_idf FROM corpus, mean_idf",
        _WORD_CHUNKS, _terms("ws"),
    ),
    "term_stats": _with(
        """SELECT term, df, round(CASE WHEN idf0 < 0 THEN 0.25::DOUBLE * (SELECT avg(idf0) FROM raw) ELSE idf0 END, 6) AS idf
FROM raw""",
        _WORD_CHUNKS,
        f"""tok AS (SELECT doc_id, chunk_no, {_tokens("text", "ws")} AS ts FROM chunks),
seen AS (SELECT doc_id, chunk_no, unnest(list_distinct(ts)) AS term FROM tok),
df AS (SELECT term, count(*) AS df FROM seen GROUP BY term),
raw AS (SELECT term, df, ln((SELECT count(*) FROM chunks) - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS idf0 FROM df)""",
    ),
    "bm25_topk": _with(_ranked("bm25", "score"), *_BM25),
    "bm25_stored": _with(_ranked("bm25", "score"), *_BM25),
    "bm25_postings": _short(_with(_ranked("bm25", "score"), *_BM25), "ws"),
    "keyword_postings": _short(_with(_ranked("keywords", "score"), *_KEYWORDS), "ws"),
    "bm25_topk_padded": _with(
        _ranked("bm25", "score"),
        _FLAT, _terms("word"), _BM25_SUM, _BM25_PADDED, _rank_list("bm25", "bm25_all", _BY_SCORE, "score"),
    ),
    "keyword_topk": _with(_ranked("keywords", "score"), *_KEYWORDS),
    "hashed_vectors": _with(
        "SELECT doc_id, chunk_no, CAST(bucket AS INTEGER) AS bucket, round(w, 5) AS weight FROM cv", _FLAT, _hashed()
    ),
    "vector_table": _with(
        """SELECT doc_id || ':' || chunk_id AS id, source, chunk_id, md5(text) AS document_md5, 256 AS dim,
  coalesce(weights, '') AS weights FROM chunks LEFT JOIN listed USING (doc_id, chunk_no)""",
        _WORD_CHUNKS,
        f"""cb AS (SELECT doc_id, chunk_no, bucket, count(*) AS n FROM (
  SELECT doc_id, chunk_no, unnest({_buckets("text")}) AS bucket FROM chunks) GROUP BY ALL),
norms AS (SELECT doc_id, chunk_no, sqrt(sum(n * n)) AS norm FROM cb GROUP BY ALL),
units AS (SELECT doc_id, chunk_no, bucket, CAST(round(CAST(n / norm AS FLOAT)::DOUBLE * 1e5) AS BIGINT) AS w
  FROM cb JOIN norms USING (doc_id, chunk_no)),
listed AS (SELECT doc_id, chunk_no, string_agg(bucket || ':' || w, ',' ORDER BY bucket) AS weights
  FROM units WHERE w <> 0 GROUP BY ALL)""",
    ),
    "vector_ids": _with(
        "SELECT source || '/' || chunk_id AS label, count(*) AS n FROM chunks GROUP BY ALL HAVING count(*) > 1",
        _WORD_CHUNKS,
    ),
    "normalised_vectors": """SELECT vec_id, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(unnest(v) / norm, 5) AS w
FROM (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * (label + 1)) AS v FROM embeddings))""",
    "dense_pivots_dot": _stored("list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[])", "score DESC", "score"),
    "dense_pivots_l2": _stored(
        "power(list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 2)", "distance", "distance"
    ),
    "dense_bytes_dot": _stored("list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[])", "score DESC", "score"),
    "dense_bytes_l2": _stored(
        "power(list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 2)", "distance", "distance"
    ),
    "dense_topk_dot": _stored("list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[])", "score DESC", "score"),
    "dense_topk_l2": _stored(
        "power(list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 2)", "distance", "distance"
    ),
    "dense_topk_small": _with(
        _stored("power(list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 2) * 1e10::DOUBLE", "distance", "distance")
        .replace("embeddings", "small"),
        """small AS MATERIALIZED (SELECT vec_id, label,
  list_transform(embedding, lambda x: CAST(x::DOUBLE * 1e-5::DOUBLE AS FLOAT)) AS embedding FROM embeddings)""",
    ),
    "dense_topk_grid": f"""WITH asked AS (
  SELECT vec_id * 16 + t AS query_id, list_concat(embedding[t + 1 :], embedding[1 : t])::DOUBLE[] AS q
  FROM embeddings, (SELECT unnest(range(0, 16)) AS t)),
scored AS (SELECT query_id, doc_id, {_significant("s")} AS score FROM (
  SELECT query_id, vec_id AS doc_id, list_dot_product(q, embedding::DOUBLE[]) AS s FROM asked, embeddings))
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored) WHERE rank <= 3""",
    "rrf_fuse": _with(
        _ranked("fused", "rrf_score"),
        *_BM25, _keyword_sum(), _rank_list("keywords", "key_sum", _BY_SCORE, "score"),
        _fused("fused", "bm25", "keywords"),
    ),
    "rerank_overlap": _with(
        "SELECT query_id, rank, doc_id, chunk_no, previous_rank, round(rerank_score, 6) AS rerank_score FROM reranked",
        *_BM25, _reranked("reranked", "bm25"),
    ),
    "rerank_scores": _with(
        """SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, rank) AS INTEGER) AS rank,
  doc_id, chunk_no, rank AS previous_rank, rerank_score
FROM (SELECT *, CASE WHEN rank % 2 = 1 THEN rank::DOUBLE ELSE 0::DOUBLE END AS rerank_score FROM bm25)""",
        *_BM25,
    ),
    "rerank_tokens": _with(
        """SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, rank) AS INTEGER) AS rank,
  doc_id, chunk_no, rank AS previous_rank, round(rerank_score, 6) AS rerank_score FROM token_scores""",
        *_BM25, _token_scores("bm25"),
    ),
    "context_blocks": _with("SELECT query_id, context FROM contexts", *_KEYWORDS, _contexts("keywords")),
    "grounded_answer": _with("SELECT query_id, query, answer FROM answered", *_KEYWORDS, _answers("keywords")),
    "citations": _with("SELECT query_id, citation_no, doc_id, chunk_no, citation FROM citations", *_KEYWORDS, _citations("keywords")),
    "hybrid_search": _with(
        _ranked("fused", "rrf_score"),
        _FLAT, _terms("word"), _BM25_SUM, _BM25_PADDED, _rank_list("bm25", "bm25_all", _BY_SCORE, "score"),
        _hashed(),
        "near AS (SELECT query_id, doc_id, chunk_no, round(greatest(c2 + q2 - 2 * dot, 0), 12) AS distance FROM every)",
        _rank_list("dense", "near", "distance, doc_id, chunk_no", "distance"),
        _fused("fused", "dense", "bm25"),
    ),
    "question_answer": _with(
        """SELECT a.query_id, a.query, a.answer, c.context, coalesce(n.citations, '') AS citations
FROM answered a LEFT JOIN contexts c USING (query_id)
LEFT JOIN (SELECT query_id, string_agg(citation_no || ':' || citation || ':' || doc_id, '; ' ORDER BY citation_no) AS citations
  FROM citations GROUP BY query_id) n USING (query_id)""",
        _PARA, _keyword_sum(), _rank_list("keywords", "key_sum", _BY_SCORE, "score"),
        _hashed(),
        "near AS (SELECT query_id, doc_id, chunk_no, round(dot, 12) AS score FROM every)",
        _rank_list("dense", "near", _BY_SCORE, "score"),
        _fused("fused", "dense", "keywords"), _reranked("final", "fused"),
        _answers("final"), _contexts("final"), _citations("final"),
    ),
    "lineage_events": _with(
        f"""SELECT state AS "eventType", strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "eventTime", run_id AS "runId",
  stage AS job, {_sides(0)} AS inputs, CASE WHEN state = 'START' THEN '' ELSE {_sides(1)} END AS outputs
FROM log WHERE state <> 'RUNNING'""",
        _LOG,
    ),
    "lineage_log": _with(
        f"""SELECT state AS "eventType", 'tidemark' AS producer, 'order-lakehouse' AS namespace, stage AS job,
  CAST(len(list_filter(string_split({_sides(0)}, ','), lambda x: x <> '')) AS INTEGER) AS n_inputs,
  CAST(CASE WHEN state = 'START' THEN 0
       ELSE len(list_filter(string_split({_sides(1)}, ','), lambda x: x <> '')) END AS INTEGER) AS n_outputs,
  count(*) AS events, count(DISTINCT run_id) AS runs FROM log WHERE state <> 'RUNNING' GROUP BY ALL""",
        _LOG,
    ),
    "lineage_refused": _with(
        "SELECT stage, state, count(*) AS events FROM log WHERE state = 'RUNNING' GROUP BY ALL", _LOG
    ),
    "lineage_edges": _with("SELECT job, input, output, runs FROM edges", _LOG, _EDGES),
    "lineage_upstream": _with(
        """SELECT u.output AS dataset, u.job AS via_job, u.input AS from_dataset, m.job AS from_job
FROM edges u JOIN edges m ON u.input = m.output WHERE u.output IS NOT NULL""",
        _LOG, _EDGES,
    ),
    "lineage_closure": _with(
        "SELECT dataset, ancestor, CAST(min(depth) AS INTEGER) AS depth FROM reach GROUP BY ALL",
        _LOG, _EDGES,
        """links AS MATERIALIZED (
  SELECT DISTINCT output, input FROM (
    SELECT output, input FROM edges UNION ALL
    SELECT lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), event_type FROM events UNION ALL
    SELECT strftime(ts, '%Y-%m-%d'), strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') FROM events UNION ALL
    SELECT event_type, strftime(ts, '%Y-%m-%d') FROM events)
  WHERE output IS NOT NULL AND input IS NOT NULL),
reach AS (
  SELECT output AS dataset, input AS ancestor, 1 AS depth FROM links
  UNION SELECT r.dataset, l.input, r.depth + 1 FROM reach r JOIN links l ON r.ancestor = l.output WHERE r.depth < 100)""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "run_states": _with(
        'SELECT stage AS job, state AS "eventType", count(*) AS events FROM log WHERE state <> \'RUNNING\' GROUP BY ALL',
        _LOG,
    ),
}
