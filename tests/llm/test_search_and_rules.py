"""Exact top k, URL rules and mixing against plain Python."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, topk_search, url_filter
from tidemark.llm.queries import op4_exact_topk

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_top(rows, k, every):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * float(np.float32(x))) for x in v]

    usable = [(n, r[0], whole(r[1])) for n, r in enumerate(rows) if r[0] is not None and whole(r[1]) is not None]
    out = []
    for n, i, q in usable:
        if i % every == 0:
            scored = [(-sum(a * b for a, b in zip(q, v, strict=False)), j) for m, j, v in usable if m != n]
            out += [(i, place + 1, j, -s) for place, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def top(spark, table, **options):
    df = spark.createDataFrame(table, VECTORS).selectExpr("*", "1 AS rank", "2 AS score", "3 AS q")
    found = topk_search.top_k(df, F.col("vec_id") % 10 == 0, k=4, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=9) * 0.3], 0) for i in range(120)]
    rows += [(200 + i, rows[i % 7][1], 0) for i in range(20)]  # ties
    rows += [(20, rows[20][1], 0), (300, None, 0), (310, [1.0, None], 0), (320, [float("inf")] * 9, 0)]
    rows += [(None, rows[1][1], 0), (330, [0.5], 0), (340, [], 0), (350, [-1.0] * 9, 0)]
    assert top(spark, rows) == brute_top(rows, 4, 10)
    assert top(spark, rows, rows=16, queries=3) == brute_top(rows, 4, 10)


def test_top_k_of_large_components_is_exact(spark):
    rows = [(i, [2.0**20 + i, -(2.0**20) + 3 * i, 1.5], 0) for i in range(0, 40)]
    assert top(spark, rows) == brute_top(rows, 4, 10)


@pytest.mark.parametrize("blocks", [{}, {"rows": 8, "queries": 2}])
def test_top_k_keeps_finite_components_of_any_size(spark, blocks):
    rows = [(i, [0.25 * i, -1.0, 0.5], 0) for i in range(0, 40)]
    rows[1] = (1, [1e13, 3.0, 0.0], 0)
    rows[10] = (10, [2.0**43, 1.0, -2.0], 0)
    rows[20] = (20, [-3e38, 1.0, 1.0], 0)
    rows[30] = (30, [0.0, 1e30, 0.25], 0)
    ends = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    everything = brute_top(rows, 100, 10)
    expected = []
    for q in (0, 10, 20, 30):
        scored = sorted((-ends(s), i) for a, _, i, s in everything if a == q)
        expected += [(q, place + 1, i, -s) for place, (s, i) in enumerate(scored[:4])]
    assert top(spark, rows, **blocks) == expected


@pytest.mark.parametrize("blocks", [{}, {"rows": 8, "queries": 2}])
def test_top_k_beyond_a_long_ranks_by_the_whole_score(spark, blocks):
    rows = [(i, [(-1) ** i * 2.0 ** (20 + i), 2.0**44, float(i)], 0) for i in range(0, 40)]
    rows += [(50, [-(2.0**44), -1.0, 0.0], 0), (60, [0.5, 0.0, 0.0], 0), (60, [0.5, 0.0, 0.0], 0)]
    ends = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    expected = [(q, place, i, ends(s)) for q, place, i, s in brute_top(rows, 4, 10)]
    assert sum(s == (1 << 63) - 1 for *_, s in expected) > 10
    assert top(spark, rows, apart=True, **blocks) == expected
    assert top(spark, rows, **blocks) != expected


def test_op4_ranks_scores_beyond_a_long(spark, tmp_path):
    rows = [(100, [2.0**44, 1.0], 0), *((i, [2.0 ** (10 + i), 0.0], 0) for i in range(1, 31))]
    spark.createDataFrame(rows, VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = sorted((r["rank"], r["vec_id"]) for r in op4_exact_topk(spark, str(tmp_path)).collect())
    assert found == [(place, 31 - place) for place in range(1, 11)]


def test_top_k_with_few_rows(spark):
    assert top(spark, []) == []
    assert top(spark, [(10, [1.0], 0)]) == []
    assert top(spark, [(10, [1.0], 0), (11, [2.0], 0)]) == [(10, 1, 11, 1024 * 2048)]


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("x.org", "/a/bc", "block"),
    ("y.org", "", "block"),
    ("X.org", "/a/", "allow"),
    (None, "/", "block"),
    ("z.org", None, "block"),
    ("z.org", "/", "other"),
]


def judged(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] + [len(tail)])]
    fits = []
    for h, p, v in RULES:
        if h is not None and p is not None and v in ("allow", "block"):
            h = h.lower()
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                fits.append((len(h + p), h + p, v))
    rule, verdict = max(fits)[1:] if fits else (None, "allow")
    return host, path, rule, verdict


URLS = [
    None, "", "example.com/en/", "http://example.com/en/1", "http://EXAMPLE.com/en/1?x=/es/#y", "https://www.example.com/en/",
    "https://a.www.example.com/en/z", "https://notexample.com/en/", "http://example.com", "http://example.com/en",
    "http://a.net/es/1", "http://net/es/", "http://a.net/fr", "http://x.org/a/bcd", "http://q.x.org/a/b", "http://y.org",
    "http://y.org?x", "http://y.org#x", "http://É.com/ü", "ftp://://x", "http:///en/", "http://a..com/", "http://com./",
    "http://" + "a." * 3000 + "com/" + "b/" * 3000, "http://z.org/", "http://x.org/a/b\nc/d",
]


def test_rules(spark):
    rows = [(i, u, "html") for i, u in enumerate(URLS)] + [(3, URLS[3], None), (None, URLS[3], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS rule", "2 AS row")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = [tuple(r) for r in url_filter.judge(pages, rules).collect()]
    assert sorted(found, key=str) == sorted([(i, *judged(u)) for i, u, _ in rows], key=str)


def test_rules_of_empty_tables(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge(pages, none).collect()] == [(1, "a.com", "/", None, "allow")]
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_filter.judge(pages.where("false"), rules).count() == 0


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in stopped]
        left = total - sum(stopped.values())
        level = left / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if level * weight[s] > 2 * sizes[s]]
        if not over:
            return {s: stopped.get(s, level * weight[s]) for s in order}
        stopped |= {s: 2 * sizes[s] for s in over}


def test_mix_meets_targets(documents):
    rows = [(i, " ".join(["Word"] * (i % 17)) + "!" * (i % 5), None, f"s{i % 4}") for i in range(400)]
    rows += [(1000 + i, "ten words " * 5, None, None) for i in range(30)] + [(2000, None, None, "s0"), (2001, "", None, "empty")]
    df = documents(rows, "size", "taken")
    found = mixing.mix(df)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "taken", "copies"]
    got = found.collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r["size"] == len((r.text or "").split()) and 0 <= r.taken <= 2 * r["size"]
        assert r.copies == (0 if r["size"] == 0 else r.taken // r["size"] + (2 * (r.taken % r["size"]) >= r["size"] > 0))
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert len(got) == len(rows) and {r.source: r.source_size for r in got} == dict(sizes)
    assert target == pytest.approx(plain_targets(sizes))
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    again = mixing.mix(df.repartition(7, "n_chars"))
    assert sorted((r.doc_id, r.taken) for r in again.collect()) == sorted((r.doc_id, r.taken) for r in got)


def test_mix_prefers_clean_documents(documents):
    rows = [(i, "clean words here " * 3, None, "s") for i in range(300)]
    rows += [(500 + i, "#%& $$$ *** ||| " * 2 + "w", None, "s") for i in range(300)]
    taken = defaultdict(int)
    for r in mixing.mix(documents(rows), share=0.5).collect():
        taken[r.doc_id >= 500] += r.copies
    assert taken[False] > 2 * taken[True] > 0


def test_mix_of_repeated_rows_and_of_nothing(documents):
    got = mixing.mix(documents([(1, "a b c", None, "s")] * 40)).collect()
    assert len({r.taken for r in got}) == 1 and abs(sum(r.taken for r in got) - 180) < 40
    assert mixing.mix(documents([])).count() == 0
    assert [r.taken for r in mixing.mix(documents([(1, None, None, None)])).collect()] == [0]


def test_rules_are_not_put_in_order(spark):
    """Precedence is made of lengths: no window over all rules, and nothing joined back to them."""
    rules = spark.createDataFrame([("com", "/", "allow"), ("a.com", "/x", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://b.a.com/xy")], "page_id long, url string")
    judged = url_filter.judge(pages, rules)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join") == 1
    assert tuple(judged.first()) == (1, "b.a.com", "/xy", "a.com/x", "block")
