"""The operators of this folder as queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    embedding_dedup,
    langid,
    lm_score,
    minhash_dedup,
    mixing,
    periodic_runs,
    quality_crf,
    sketches,
    topk_search,
    toxicity,
    url_filter,
    whitening,
)
from tidemark.llm.common import fold, table, text_batches


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    documents = table(spark, sf_dir, "documents")
    learned = langid.learn(documents.where(fold("doc_id", 3) != 1).select("text", "lang"))
    rows = documents.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text")
    return langid.predict(rows, learned, "doc_id long, held_out boolean")


#: Fixed by the task: (host, path, verdict).
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, apart=True)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return lm_score.score(table(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    documents = table(spark, sf_dir, "documents")
    model = toxicity.learn(documents, table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1))
    rows = documents.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text")
    return toxicity.score(rows, model, "doc_id long, held_out boolean")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    documents = table(spark, sf_dir, "documents")
    chain = quality_crf.learn(documents, table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    rows = documents.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text")
    return quality_crf.score(rows, chain, "doc_id long, held_out boolean")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(table(spark, sf_dir, "documents"))


def _periodic(documents: DataFrame) -> DataFrame:
    """(doc_id, text) as op13 wants them: in a tenth of the documents, by a hash of the id, the words from one on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = documents.select(
        "doc_id",
        "text",
        g.alias("g"),
        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(rf"[^{_SPACE}]+"), F.lit(0))).alias("words"),
    ).withColumn("n", F.size("words"))
    a = F.when(F.col("n") > 0, F.col("g") % F.col("n"))
    cut = words.withColumn("a", a.cast("int"))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    cut = cut.withColumn("p", p)
    rest = F.col("n") - F.col("a")
    times = F.ceil(rest / F.col("p")).cast("int")
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), rest)
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    found = periodic_runs.detect(_periodic(table(spark, sf_dir, "documents")), "doc_id long")
    # The greatest length / period, compared as whole numbers; of equal ones the first.
    sign = lambda a, b: F.when(a < b, -1).when(a > b, 1).otherwise(0)
    share = lambda x, y: sign(y["length"] * x["period"], x["length"] * y["period"])
    greater = lambda x, y: F.when(share(x, y) != 0, share(x, y)).when(
        x["start"] != y["start"], sign(x["start"], y["start"])
    ).otherwise(sign(x["period"], y["period"]))
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", F.get(F.array_sort("runs", greater), F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(best.length * 1000) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_language_id": op2_language_id,
    "op3_url_filter": op3_url_filter,
    "op4_exact_topk": op4_exact_topk,
    "op5_lm_score": op5_lm_score,
    "op6_toxicity": op6_toxicity,
    "op7_source_mixing": op7_source_mixing,
    "op8_bpe": op8_bpe,
    "op9_line_quality": op9_line_quality,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_whitening": op11_whitening,
    "op12_fingerprints": op12_fingerprints,
    "op13_periodic_runs": op13_periodic_runs,
}

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
_SPACE = r"\x20\x09-\x0D"

ORACLE: dict[str, str] = {
    "op3_url_filter": rf"""
        WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES}),
        cut AS (
            SELECT row_number() OVER () AS n, page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        fits AS (
            SELECT n, rule_host || rule_path AS rule, rule_verdict,
                   row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC) AS place
            FROM cut JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                               AND starts_with(path, rule_path))
        SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
        FROM cut LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)
    """,
    "op4_exact_topk": """
        WITH whole AS (
            SELECT row_number() OVER () AS n, vec_id,
                   list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.n, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.n <> c.n WHERE q.vec_id % 100 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
        FROM scored QUALIFY rank <= 10
    """,
    "op10_embedding_dedup": """
        WITH RECURSIVE one AS MATERIALIZED (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS MATERIALIZED (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM one a JOIN one b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
        reach(vec_id, other) AS (
            SELECT a, b FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
        least AS (SELECT vec_id, min(other) AS other FROM reach GROUP BY vec_id),
        counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce(other, vec_id)) AS kept
        FROM embeddings LEFT JOIN least USING (vec_id) LEFT JOIN counted USING (vec_id)
    """,
    "op7_source_mixing": rf"""
        WITH sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^{_SPACE}]+')), 0)::BIGINT AS size,
                   md5(concat_ws('|', doc_id::VARCHAR, text)) AS digest,
                   CASE WHEN coalesce(length(text), 0) = 0 THEN {mixing.LEAST_QUALITY}::DOUBLE
                        ELSE greatest(length(regexp_replace(text, '[^\p{{L}}\x20\x0A]+', '', 'g'))::DOUBLE
                                      / length(text), {mixing.LEAST_QUALITY}::DOUBLE) END AS weight
            FROM documents),
        keyed AS MATERIALIZED (
            SELECT *, -ln((('0x' || substr(digest, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)
                      / weight AS key
            FROM sized),
        sums AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
            FROM keyed GROUP BY source),
        ratio AS (
            SELECT *, 2 * source_size AS cap,
                   row_number() OVER (ORDER BY 2 * source_size / w::DOUBLE, source NULLS LAST) AS place,
                   1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS budget
            FROM sums),
        levels AS (
            SELECT *, (budget - (coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING
                                                         AND 1 PRECEDING), 0))::DOUBLE)
                      / (sum(w) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE
                      AS level
            FROM ratio),
        aims AS (
            SELECT source, source_size,
                   least(cap::DOUBLE, w * (SELECT arg_min(level, place) FROM levels WHERE level * w <= cap)) AS target
            FROM levels),
        parts AS (
            SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS epochs FROM aims),
        rests AS (
            SELECT *, floor(target - epochs * source_size + 0.5::DOUBLE)::BIGINT AS rest FROM parts),
        placed AS (
            SELECT k.doc_id, k.size, r.source_size, r.target, r.epochs,
                   greatest(least(rest - coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, digest, doc_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), size), 0)::BIGINT AS extra
            FROM keyed k JOIN rests r ON k.source IS NOT DISTINCT FROM r.source)
        SELECT doc_id, size, source_size, target, epochs * size + extra AS taken,
               CASE WHEN size > 0 THEN epochs + (2 * extra >= size)::INT ELSE 0 END::INT AS copies
        FROM placed
    """,
    "op12_fingerprints": rf"""
        WITH given AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
        met AS (SELECT doc_id, n, text,
                       coalesce(lead(text) OVER by_id, first_value(text) OVER by_id) AS after
                FROM given WINDOW by_id AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
        made AS (SELECT doc_id, n, text, after, left(text, n - n // 4) || left(after, n // 4) AS new FROM met),
        cut AS (SELECT doc_id, n, new,
                       list_distinct(regexp_extract_all(text, '{sketches.PARAGRAPH}')) AS own,
                       list_distinct(regexp_extract_all(new, '{sketches.PARAGRAPH}')) AS edited,
                       list_distinct(regexp_extract_all(after, '{sketches.PARAGRAPH}')) AS next
                FROM made),
        each AS (SELECT doc_id, 0 AS kind, unnest(own) AS p FROM cut UNION ALL
                 SELECT doc_id, 1, unnest(edited) FROM cut),
        digests AS (SELECT doc_id, kind, ('0x' || substr(md5(p), 1, 15))::BIGINT AS d FROM each),
        checked AS (SELECT *, ('0x' || substr(md5(d::VARCHAR), 1, 8))::BIGINT AS c FROM digests),
        cells AS (SELECT doc_id, kind, {sketches.BASE} * j + ((d >> (20 * j)) & {sketches.BASE - 1}) AS cell,
                         count(*) AS k, bit_xor(d) AS d, bit_xor(c) AS c
                  FROM checked, range(3) AS parts(j) GROUP BY ALL),
        written AS (SELECT doc_id, kind, string_agg(cell || ':' || k || ':' || d || ':' || c, ',' ORDER BY cell) AS w
                    FROM cells GROUP BY ALL)
        SELECT doc_id, n AS n_chars, sha256(new) AS edited_sha256,
               len(own) || '|' || coalesce(a.w, '') AS fingerprint,
               len(edited) || '|' || coalesce(b.w, '') AS edited_fingerprint,
               CASE WHEN len(own) + len(edited) = 0 THEN 1.0::DOUBLE
                    ELSE (2 * len(list_intersect(own, edited)))::DOUBLE / (len(own) + len(edited)) END AS near_edited,
               CASE WHEN len(own) + len(next) = 0 THEN 1.0::DOUBLE
                    ELSE (2 * len(list_intersect(own, next)))::DOUBLE / (len(own) + len(next)) END AS near_next
        FROM cut LEFT JOIN (FROM written WHERE kind = 0) a USING (doc_id)
                 LEFT JOIN (FROM written WHERE kind = 1) b USING (doc_id)
    """,
    "op13_periodic_runs": rf"""
        WITH hashed AS (
            SELECT doc_id, text,
                   xor(list_reduce(flatten([[4294967295]] || list_transform(string_split(doc_id::VARCHAR, ''),
                           lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))::BIGINT[],
                       lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384)
                                        ELSE crc >> 1 END), 4294967295) AS h
            FROM documents),
        given AS (
            SELECT doc_id, coalesce(regexp_extract_all(text, '[^{_SPACE}]+'), []) AS w, h % 10 = 0 AS turned, h // 10 AS g
            FROM hashed),
        sized AS (SELECT *, len(w) AS n FROM given),
        placed AS (SELECT *, CASE WHEN turned AND n > 0 THEN g % n ELSE n END AS a FROM sized),
        period AS (SELECT *, CASE WHEN a < n THEN 1 + (n - a) // (3 + g % 8) ELSE 1 END AS p FROM placed),
        words AS MATERIALIZED (
            SELECT doc_id, n, i, w[1 + (CASE WHEN i < a THEN i ELSE a + (i - a) % p END)] AS word
            FROM (SELECT *, unnest(range(n)) AS i FROM period)),
        pairs AS (
            SELECT x.doc_id, x.i, y.i - x.i AS q
            FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
        islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
        long AS (
            SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY doc_id, q, island
            HAVING count(*) + q >= greatest(6, 4 * q)),
        runs AS MATERIALIZED (
            SELECT * FROM long r WHERE NOT EXISTS (
                SELECT 1 FROM long t WHERE t.doc_id = r.doc_id AND t.q < r.q AND t.s <= r.s AND t.s + t.l >= r.s + r.l)),
        best AS (
            SELECT r.* FROM runs r WHERE NOT EXISTS (
                SELECT 1 FROM runs t WHERE t.doc_id = r.doc_id AND (t.l * r.q > r.l * t.q
                    OR (t.l * r.q = r.l * t.q AND (t.s < r.s OR (t.s = r.s AND t.q < r.q)))))),
        lines AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs
            FROM runs GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS left_over
            FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT g.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period, 1000 * l // q AS exponent_milli,
               sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(left_over, '')) AS collapsed_sha256
        FROM given g LEFT JOIN best USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
}
