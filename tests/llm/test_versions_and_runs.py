"""Whitened components, fingerprints and periodic runs against brute force, and their edge cases."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import periodic_runs, sketches, whitening

# ---------------------------------------------------------------- periodic runs ----


def brute_runs(x):
    found = []
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i < len(x) - q:
            j = i
            while j < len(x) - q and x[j] == x[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q):
                part = x[i : j + q]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(x, runs):
    return [w for i, w in enumerate(x) if not any(s + q <= i < s + n for s, n, q in runs)]


@st.composite
def words(draw):
    x = draw(st.lists(st.sampled_from("abc"), max_size=50))
    for _ in range(draw(st.integers(0, 2))):
        if x:
            p, start = draw(st.integers(1, 9)), draw(st.integers(0, len(x) - 1))
            for i in range(start + p, min(len(x), start + p * draw(st.integers(2, 8)))):
                x[i] = x[i - p]
    return x


@settings(max_examples=300, deadline=None)
@given(st.lists(words(), max_size=5))
def test_runs_equal_brute_force(texts):
    import pyarrow as pa

    found, n_words, collapsed = periodic_runs._of_texts(pa.array([" ".join(t).encode() for t in texts], pa.binary()))
    for x, runs, n, rest in zip(texts, found, n_words, collapsed, strict=True):
        expected = brute_runs(x)
        assert [(r["start"], r["length"], r["period"]) for r in runs] == expected
        assert n == len(x) and rest.decode().split() == brute_collapsed(x, expected)


def test_runs_of_odd_rows(spark):
    long = " ".join(f"w{k % 700}" for k in range(7000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b a b a b a b"), (4, "a b a b a b a b"), (None, "x x x x x x"), (5, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS runs", "1 AS collapsed")
    out = periodic_runs.detect(df, "doc_id long").collect()
    got = sorted(((r.doc_id or 0, [tuple(x) for x in r.runs], r.n_words, bytes(r.collapsed).decode()) for r in out), key=str)
    assert got == sorted(
        [
            (0, [(0, 6, 1)], 6, "x"), (1, [], 0, ""), (2, [], 0, ""), (3, [], 0, ""),
            (4, [(0, 8, 2)], 8, "a b"), (4, [(0, 8, 2)], 8, "a b"),
            (5, [(0, 7000, 700)], 7000, " ".join(f"w{k}" for k in range(700))),
        ],
        key=str,
    )
    assert periodic_runs.detect(df.where("false"), "doc_id long").count() == 0


# ---------------------------------------------------------------- fingerprints ----


def paragraphs(text):
    return set(re.findall(sketches.PARAGRAPH.replace(r"\z", r"\Z"), text))


def brute_versions(rows):
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    out = {}
    for k, (null, i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        q = len(text) // 4
        new = text[: len(text) - q] + after[:q]
        a, b, c = paragraphs(text), paragraphs(new), paragraphs(after)
        like = lambda x, y: 1.0 if not x and not y else 2 * len(x & y) / (len(x) + len(y))
        sha = hashlib.sha256(new.encode()).hexdigest()
        out[None if null else i, text] = (len(text), sha, like(a, b), like(a, c))
    return out


def test_fingerprints_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(7, None), (8, ""), (9, "é" * 40), (10, "one line"), (12, "a. b. c. a. b.\nlast"), (12, "a. b. c. a. b.\nlast")]
    for i in range(20, 60):
        n = int(rng.integers(1, 400)) if i != 40 else 6000
        rows.append((i * 1000, ". ".join(f"s{k}" for k in rng.integers(0, 300, n)) + "."))
    rows += [(90_000, "same text. of two"), (90_001, "same text. of two"), (None, "without id. here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS h", "1 AS cell", "2 AS kind")
    out = sketches.fingerprints(df, digest_lists=True).collect()
    expected = brute_versions(rows)
    assert len(out) == len(rows)
    of_id = {}
    for r in rows:
        of_id.setdefault(r[0], (r[0], r[1] or ""))
    for r in out:
        assert (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) == expected[of_id[r.doc_id]], r.doc_id
        assert len(r.without_next) == len(set(r.without_next)) and not set(r.without_next) & set(r.only_next)
    prints = {r.doc_id: r.fingerprint for r in out}
    assert prints[90_000] == prints[90_001] and prints[7] == prints[8] == "0|"
    assert len(set(prints.values())) == len(prints) - 2
    assert sketches.fingerprints(df.where("false")).count() == 0


def test_too_small_sketches_are_made_again(spark, monkeypatch):
    """With a first size far too small, only larger attempts can recover what differs."""
    monkeypatch.setattr(sketches, "ROOM", 0)
    monkeypatch.setattr(sketches, "LEAST", 8)
    tries = []
    real = sketches._tried
    monkeypatch.setattr(sketches, "_tried", lambda d, o, a: tries.append(a) or real(d, o, a))
    rows = [(k, ". ".join(f"p{k}x{j}" for j in range(60)) + ".") for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sketches.fingerprints(df).collect()
    assert max(tries) >= 2 and {r.near_next for r in out} == {0.0}
    assert all(0.6 < r.near_edited < 0.9 for r in out)


def test_fingerprints_are_native(spark):
    docs = sketches.keyed(spark.createDataFrame([(1, "a. b.")], "doc_id long, text string"))
    plan = sketches._tried(docs, sketches.following(docs), 0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# ---------------------------------------------------------------- whitening ----


def brute_whiten(vectors):
    x = np.floor(256 * np.array(vectors, np.float64))
    fit = np.unique(x, axis=0)
    y = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(y.T @ y / len(fit))
    return x, fit, values[::-1], axes[:, ::-1]


@pytest.mark.parametrize("dim, rows", [(6, 40), (48, 600)])
def test_whitening_equals_eigh(spark, dim, rows):
    rng = np.random.default_rng(dim)
    given_rows = (rng.standard_normal((rows, dim)) * np.linspace(3, 0.5, dim)).astype(np.float32).tolist()
    table = [(k, v, 1) for k, v in enumerate(given_rows)] + [(1000, given_rows[0], 1), (None, given_rows[1], 1)]
    bad = [(2000, None, 1), (2001, [None] + given_rows[0][1:], 1), (2002, [float("nan")] * dim, 1), (2003, [float("inf")] * dim, 1)]
    df = spark.createDataFrame(table + bad, "vec_id long, embedding array<float>, component int").selectExpr("*", "'x' AS n")
    x, fit, values, axes = brute_whiten([v for _, v, _ in table])
    out = whitening.whiten(df).collect()
    n, s = len(fit), fit.sum(axis=0)
    assert n == rows and len(out) == 4 * len(table)
    by = {}
    for r in out:
        by.setdefault(r.vec_id, {})[r.component] = r
    sign = {}
    for (i, _, _), row in zip(table, x, strict=True):
        assert sorted(by[i]) == [1, 2, 3, 4]
        for c, r in by[i].items():
            expected = float((row - s / n) @ axes[:, c - 1] / np.sqrt(values[c - 1]))
            sign.setdefault(c, np.sign(expected * r.whitened))
            assert abs(sign[c] * r.whitened - expected) < 1e-9
            assert r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True))
            assert r.n == n and r.identity_error < 1e-10
            assert abs(r.explained / (values[c - 1] / values.sum()) - 1) < 1e-12


def test_whitening_of_few_and_odd_rows(spark):
    make = lambda rows: whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert make([]) == [] and make([(1, []), (2, None)]) == []
    assert make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # one distinct vector
    two = make([(1, [1.0, 2.0]), (2, [3.0]), (2, [3.0])])  # the shorter one is ended by a zero: one component
    assert sorted((r.vec_id, r.component, r.n, round(abs(r.whitened), 9)) for r in two) == [(1, 1, 2, 1), (2, 1, 2, 1), (2, 1, 2, 1)]
    large = make([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.5, -2.0])])
    assert {r.deviation for r in large if r.vec_id < 3} == {whitening.LONG} and all(np.isfinite(r.whitened) for r in large)


def test_residuals_not_passes_certify():
    """Close eigenvalues need more passes and are still separated."""
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.standard_normal((120, 120)))
    values = np.concatenate([[5, 4.99, 4.98, 4.97], np.linspace(4.9, 0.1, 116)])
    v = (q * values) @ q.T
    found, axes = whitening.eigenpairs(lambda x: v @ x, 120, 4)
    assert np.abs(found - values[:4]).max() < 1e-12
    assert np.abs(np.abs(np.diag(axes.T @ q[:, :4])) - 1).max() < 1e-12
