"""MinHash and embedding near-duplicates against brute force."""

import random

import numpy as np
import pytest

from tidemark.llm import embedding_dedup, minhash_dedup
from tidemark.llm.graph import components, merged


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def classes(keys, linked):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in keys:
        for b in keys:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def expected_texts(rows, size):
    sets = {i: shingles(t, size) for i, t in rows}

    def linked(a, b):
        p, q = sets[a], sets[b]
        return bool(p and q) and 100 * len(p & q) >= 80 * len(p | q)

    return {k: (len(sets[k]), c, c == k) for k, c in classes(sorted(sets), linked).items()}


def varied(seed, n):
    """Texts, near copies at all distances around the threshold, and copies."""
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(n):
        if i % 3 == 0 or not rows:
            words = [rng.choice(pool) for _ in range(rng.randrange(1, 120))]
        else:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(0, 8)):
                words[rng.randrange(len(words))] = rng.choice(pool)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(documents, size):
    rows = varied(size, 150)
    found = minhash_dedup.near_duplicates(documents(rows, "component_id", "kept"), shingle=size)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()}
    assert got == expected_texts(rows, size)


def test_a_large_bucket_is_compared_in_blocks(documents):
    """Near copies of one text, most of them not linked with the bucket's first one."""
    rng = random.Random(5)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for k in rng.sample(range(60), 4):
            words[k] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    found = minhash_dedup.near_duplicates(documents(rows), shingle=2, block=16)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()} == expected_texts(rows, 2)


def test_texts_without_words_nulls_and_repeats(documents):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "É one"), (7, "é one"), (None, "one"), (5, "ONE")]
    found = minhash_dedup.near_duplicates(documents(rows), shingle=2).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str)
    assert got == sorted(
        [
            (1, 0, 1, True),
            (2, 0, 2, True),
            (3, 0, 3, True),
            (4, 1, 4, True),
            (5, 1, 4, False),
            (5, 1, 4, False),
            (6, 1, 6, True),
            (7, 1, 7, True),
            (None, 1, None, False),
        ],
        key=str,
    )


def test_deduplicated_keeps_columns_and_one_row_a_group(documents):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(3, text, "en", "s"), (1, text, "de", "t"), (1, text, "de", "t"), (2, "else", "fr", "u"), (None, text, "en", "s")]
    kept = minhash_dedup.deduplicated(documents(rows, "kept"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
    assert sorted((r.doc_id or 0, r.lang) for r in kept.collect()) == [(0, "en"), (1, "de"), (2, "fr")]


def test_empty_table(documents):
    assert minhash_dedup.near_duplicates(documents([])).count() == 0
    assert minhash_dedup.deduplicated(documents([])).count() == 0


def test_long_text(documents):
    text = " ".join(f"w{k % 5003}" for k in range(60_000))
    rows = [(1, text), (2, text + " end"), (3, "short")]
    found = minhash_dedup.near_duplicates(documents(rows), shingle=2).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (2, 1), (3, 3)]


def test_components_of_chains_rings_and_stars(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, 300 + i) for i in range(40)]
    links += [(rng.randrange(400, 480), rng.randrange(400, 480)) for _ in range(50)]
    rng.shuffle(links)
    both = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in links] + [(7, 7)]
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    pairs = {frozenset(x) for x in links}
    expected = classes(nodes, lambda a, b: frozenset((a, b)) in pairs)
    found = components(spark.createDataFrame(both, "a long, b long"))
    assert {r.nid: r.comp for r in found.collect()} == expected
    some, rest = both[:60], both[60:]
    first = components(spark.createDataFrame(some, "a long, b long"))
    again = merged(first, spark.createDataFrame(rest, "a long, b long"))
    assert {r.nid: r.comp for r in again.collect()} == expected


VECTORS = "vec_id long, embedding array<float>, label int"


def brute_vectors(rows, threshold):
    """Per row number: links, and the smallest vec_id of its component."""

    def usable(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def linked(a, b):
        p, q = rows[a], rows[b]
        if not (usable(p) and usable(q)) or p[2] != q[2] or len(p[1]) != len(q[1]):
            return False
        return embedding_dedup.cosine(np.float64(np.float32(p[1])), np.float64(np.float32(q[1]))) >= threshold

    keys = range(len(rows))
    links = [sum(linked(a, b) for b in keys if a != b) for a in keys]
    comp = classes(list(keys), linked)
    least = {}
    for k in keys:
        if rows[k][0] is not None:
            least[comp[k]] = min(least.get(comp[k], rows[k][0]), rows[k][0])
    out = []
    for k in keys:
        component = least.get(comp[k]) if rows[k][0] is not None else None
        out.append((rows[k][0], links[k], component, rows[k][0] is not None and component == rows[k][0]))
    return sorted(out, key=str)


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 16))
    rows = []
    for i in range(220):
        v = centres[i % 6] * rng.uniform(0.5, 2) + rng.normal(size=16) * rng.uniform(0.05, 0.5)
        rows.append((500 - i, [float(x) for x in v], int(i % 3)))
    rows += [rows[0], rows[1], (900, [0.0] * 16, 1), (901, None, 1), (902, [1.0, None], 1), (903, [float("nan")] * 16, 1)]
    rows += [(904, rows[5][1], None), (905, rows[5][1][:8], rows[5][2]), (906, [], 1), (None, rows[5][1], rows[5][2])]
    rows += [(907, [1e-30] * 16, 0), (908, [1e30] * 16, 0)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS kept", "2 AS rid", "3 AS n_links")
    for tile in (4096, 16):
        found = embedding_dedup.near_duplicates(df, threshold=0.9, tile=tile)
        got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect()), key=str)
        assert got == brute_vectors(rows, 0.9)


def test_embedding_threshold_is_met_exactly(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [3.0, 4.0], 0), (3, [4.0, 3.0], 0)]  # cosines 0.6, 0.8 and 0.96
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), threshold=0.8)
    assert sorted((r.vec_id, r.n_links) for r in found.collect()) == [(1, 1), (2, 1), (3, 2)]


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
