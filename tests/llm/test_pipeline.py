"""The pipeline's rows against its stages redone in plain Python; the two classifiers' decisions are taken as given."""

import hashlib
import itertools
import math
import os
import re
from collections import Counter

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import langid, mixing, quality_crf
from tidemark.llm.common import fold

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Documents of the smallest table, with copies, near copies, repeated rows, nulls, and an empty, a wordless and a very long text."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in docs.orderBy("doc_id").collect()]
    schema, names = docs.schema, docs.columns
    at = {c: names.index(c) for c in names}

    def changed(row, **values):
        return tuple(values.get(c, v) for c, v in zip(names, row))

    good = sorted((r for r in rows if len(WORD.findall(r[at["text"]] or "")) > 60), key=lambda r: -len(r[at["text"]]))[5:25]
    extra = [changed(r, doc_id=10_000 + k) for k, r in enumerate(good[:6])]  # exact copies
    extra += [changed(r, doc_id=11_000 + k, text=r[at["text"]] + " one word more", source=None) for k, r in enumerate(good[:6])]
    extra += [good[7], good[7], good[8]]  # repeated rows
    extra += [changed(good[9], text=good[10][at["text"]] + " another text of that id")]
    extra += [changed(good[11], doc_id=None), changed(good[11], doc_id=None), changed(good[12], lang=None, doc_id=12_000)]
    extra += [changed(good[13], doc_id=13_000, text="\n".join(r[at["text"]] for r in good if r[at["lang"]] == good[13][at["lang"]]) * 8)]
    extra += [changed(good[0], doc_id=14_000 + k, text=t) for k, t in enumerate([None, "", " \n\t", "123 !?", "<|endoftext|>"])]
    rows += extra
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder, schema, rows


def shingles(text, n=5):
    words = [w.translate({k: k + 32 for k in range(65, 91)}) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1)))


def plain_dedup(rows, doc_id, text):
    kinds = sorted({(r[doc_id], r[text]) for r in rows if r[doc_id] is not None}, key=str)
    sets = [shingles(t) for _, t in kinds]
    parent = list(range(len(kinds)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(kinds)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(kinds):
        least[root(k)] = min(least.get(root(k), i), i)
    stays = {kind for k, kind in enumerate(kinds) if kind[0] == least[root(k)]}
    return [r for r in {(r[doc_id], r[text]): r for r in rows}.values() if (r[doc_id], r[text]) in stays] + [
        r for r in rows if r[doc_id] is None
    ]


def plain_targets(size):
    """Sources share the budget by weight; whoever is above twice its size stops there, and the rest is shared again."""
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    capped, budget = set(), 1.5 * sum(size.values())
    while True:
        free = [s for s in names if s not in capped]
        left = budget - sum(2 * size[s] for s in capped)
        aim = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if aim[s] > 2 * size[s]}
        if not above:
            return {s: aim.get(s, 2.0 * size[s]) for s in names}
        capped |= above


def plain_mix(rows, doc_id, text, source):
    out, by_source = [], {}
    for r in rows:
        t = r[text]
        digest = hashlib.md5("|".join(str(x) for x in (r[doc_id], t) if x is not None).encode()).hexdigest()
        clean = len(regex.sub(r"[^\p{L}\x20\x0A]+", "", t)) / len(t) if t else mixing.LEAST_QUALITY
        key = -math.log((int(digest[:13], 16) + 0.5) / 2**52) / max(clean, mixing.LEAST_QUALITY)
        by_source.setdefault(r[source], []).append((key, digest, len(WORD.findall(t or "")), r))
    size = {s: sum(x[2] for x in of) for s, of in by_source.items()}
    target = plain_targets(size)
    for s, of in by_source.items():
        epochs = math.floor(target[s] / max(size[s], 1))
        rest = math.floor(target[s] - epochs * size[s] + 0.5)
        of.sort(key=lambda x: x[:2])
        for _, alike in itertools.groupby(of, key=lambda x: x[:2]):
            alike = list(alike)
            words = alike[0][2]
            extra = min(words, max(0, rest) // len(alike))
            rest -= len(alike) * words
            copies = epochs + (2 * extra >= words) if words else 0
            out += [x[3] for x in alike] * copies
    return out


def plain_encoding(rows, doc_id, text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = tokenizer.encode(r[text] or "", add_special_tokens=False).ids
        yield r[doc_id], len(ids), sha(",".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_rows_equal_the_plain_stages(spark, small, monkeypatch):
    folder, schema, rows = small
    written, real = [], corpus_pipeline.kept
    monkeypatch.setattr(corpus_pipeline, "kept", lambda df, name: written.append(real(df, name)) or written[-1])
    final = corpus_pipeline.run(spark, folder)
    found = [[tuple(r) for r in df.collect()] for df in written]
    assert len(found) == 5 and Counter(tuple(r) for r in final.collect()) == Counter(found[-1])
    doc_id, text, source = (schema.fieldNames().index(c) for c in ("doc_id", "text", "source"))

    def decided(before, predict, column):
        """Texts that a classifier keeps."""
        texts = sorted({r[text] for r in before}, key=str)
        told = predict(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
        return {texts[r.doc_id] for r in told.collect() if r[column]}

    learned = langid.learn(spark.createDataFrame(rows, schema).where(fold("doc_id", 3) != 1).select("text", "lang"))
    stays = decided(rows, lambda df: langid.predict(df, learned, "doc_id long"), "accepted")
    told = [r for r in rows if r[text] in stays]
    assert Counter(found[0]) == Counter(told)
    assert not {None, "", " \n\t", "123 !?"} & {r[text] for r in told} and {10_000, 11_000, 13_000, None} <= {r[doc_id] for r in told}

    labels = spark.read.parquet(f"{folder}/labels.parquet").where(fold("doc_id", 5) != 0)
    chain = quality_crf.learn(spark.createDataFrame(told, schema), labels)
    stays = decided(told, lambda df: quality_crf.score(df, chain, "doc_id long"), "predicted")
    good = [r for r in told if r[text] in stays]
    assert Counter(found[1]) == Counter(good) and len(good) > 40

    single = plain_dedup(good, doc_id, text)
    assert Counter(found[2]) == Counter(single) and 0 < len(single) < len(good)
    mixed = plain_mix(single, doc_id, text, source)
    assert Counter(found[3]) == Counter(mixed) and max(Counter(mixed).values()) > 1
    assert Counter(found[4]) == Counter(plain_encoding(mixed, doc_id, text))
