"""Language ID, language model, toxicity and line quality: contracts on small made-up corpora."""

import itertools
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import langid, lm_score, quality_crf, toxicity
from tidemark.llm.common import fold

TABLES = "/root/testdata/sf0.01"
SYLLABLES = {"aa": "ba ko mi ta ru", "bb": "ent och ell igs upp", "cc": "öß ça ñe ïl åk"}


def sentence(rng, lang, n=12):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(n=240):
    rng = random.Random(4)
    return [(i, sentence(rng, lang), lang) for i, lang in zip(range(n), itertools.cycle(SYLLABLES))]


def test_fold_is_crc32(spark):
    df = spark.createDataFrame([(i,) for i in (0, 7, -3, 12345678901, None)], "doc_id long")
    got = [r[0] for r in df.select(fold("doc_id", 3)).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 3 for i in (0, 7, -3, 12345678901)] + [None]


def test_language_of_held_out_texts(documents):
    rows = corpus()
    df = documents([(i, t if i % 2 else t.upper() + "!! 123", lang) for i, t, lang in rows], "lang_pred", "accepted", "score")
    learned = langid.learn(df.where(fold("doc_id", 3) != 1))
    assert set(learned) == set(SYLLABLES)
    found = langid.predict(df.where(fold("doc_id", 3) == 1), learned, "doc_id long, lang string").collect()
    assert all(r.lang_pred == r.lang and r.accepted and 0.5 < r.score <= 1 for r in found)


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_languages_that_cannot_be_told_are_rejected(documents, spark):
    """Held-out texts of the given table: clean ones stay; those in a language left out, equal mixes and random letters go."""
    table = spark.read.parquet(f"{TABLES}/documents.parquet").where("length(text) between 20 and 8000").select("doc_id", "text", "lang")
    training = table.where(fold("doc_id", 3) != 1)
    held = [r for r in table.where(fold("doc_id", 3) == 1).where("lang is not null").orderBy("doc_id").collect()]
    learned = langid.learn(training)

    def accepted(texts, dictionaries):
        rows = documents(list(enumerate(texts)) * 2)  # each row twice
        found = [(r.doc_id, r.accepted, r.lang_pred) for r in langid.predict(rows, dictionaries, "doc_id long").collect()]
        assert len(found) == 2 * len(set(found)) == 2 * len(texts)
        return {k: lang for k, accept, lang in found if accept}

    clean = accepted([r.text for r in held], learned)
    assert len(clean) >= 0.98 * len(held) and sum(held[k].lang == lang for k, lang in clean.items()) >= 0.99 * len(clean)
    rng, of = random.Random(5), {lang: [r.text for r in held if r.lang == lang] for lang in learned}
    for lang, texts in of.items():
        assert len(accepted(texts, {k: v for k, v in learned.items() if k != lang})) < 0.15 * len(texts)
    # Texts with a copy in the dictionary are told by it, and are no part of a mix.
    new = lambda t, lang: not any(langid.letters(t[k : k + 40]).strip() in learned[lang] for k in range(0, 300, 40))
    equal = {lang: [t[:300] for t in texts if len(t) >= 300 and new(t, lang)] for lang, texts in of.items()}
    assert min(map(len, equal.values())) > 10
    mixed = [" ".join(rng.choice(equal[lang]) for lang in rng.sample(sorted(equal), len(equal))) for _ in range(40)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = [" ".join("".join(rng.choices(letters, k=rng.randrange(2, 9))) for _ in range(n)) for n in (5, 30, 300, 3_000) * 10]
    keys = ["asdf qwer zxcv tyui ghjk", "Tämä on suomenkielinen lause, jota ei ole opittu koskaan aiemmin"]
    assert len(accepted(mixed, learned)) <= 8 and len(accepted(junk, learned)) <= 4 and not accepted(keys, learned)


def test_smallest_encoding_wins(documents):
    """Every dictionary tried one by one, with the greater effort where it is close."""
    learned = langid.learn(documents(corpus()))
    rows = [(i, t) for i, t, _ in corpus(90)] + [(1000, "ba ko " + sentence(random.Random(1), "bb", 30) * 200)]
    found = {r.doc_id: r for r in langid.predict(documents(rows), learned, "doc_id long").collect()}

    def size(lang, data, level):
        content = zstandard.ZstdCompressionDict(learned[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made = zstandard.ZstdCompressor(level=level, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False)
        return sum(len(made.compress(data[i : i + langid.BLOCK])) for i in range(0, len(data), langid.BLOCK))

    for i, text in rows:
        data = langid.letters(text)
        sizes = sorted((size(lang, data, langid.LEVEL), lang) for lang in learned)
        if (sizes[1][0] - sizes[0][0]) / sizes[1][0] < langid.CLOSE or sizes[1][0] - sizes[0][0] < langid.LEAST_BYTES:
            data = langid.LEAD + data + b" " + data if len(data) < langid.SHORT else data
            sizes = sorted((size(lang, data, langid.EFFORT), lang) for lang in learned)
        assert found[i].lang_pred == sizes[0][1]


def test_language_of_odd_texts(documents):
    learned = langid.learn(documents(corpus()))
    odd = [(1, None), (2, ""), (3, "123 !!"), (4, "x"), (5, "bako mita " * 30_000), (6, "٣٤ 漢字"), (None, "bako mita ruta")]
    got = {r.doc_id: r for r in langid.predict(documents(odd), learned, "doc_id long").collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and not any(got[k].accepted for k in (1, 2, 3))
    assert got[4].lang_pred in SYLLABLES and got[6].lang_pred in SYLLABLES
    assert got[5].lang_pred == "aa" and got[None].lang_pred == "aa"


def test_language_without_training(documents):
    assert langid.learn(documents([])) == {} == langid.learn(documents([(1, "text", None), (2, None, "aa")]))
    got = langid.predict(documents([(1, "text")]), {}, "doc_id long").first()
    assert (got.lang_pred, got.score, got.accepted) == ("und", 0.0, False)
    assert langid.predict(documents([]), {"aa": b"x"}, "doc_id long").count() == 0


def test_dictionary_is_bounded_and_whole(documents):
    learned = langid.learn(documents(corpus(900)), dict_bytes=1_000)
    texts = {langid.letters(t) for _, t, _ in corpus(900)}
    for content in learned.values():
        assert 0 < len(content) <= 1_000
        assert any(content.startswith(t) for t in texts) and any(content.endswith(t) for t in texts)


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def plain_base(rows):
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    score = {}
    for i, t in rows:
        words = tokens(t)
        score[i] = (
            len(words),
            sum(w in counts for w in words),
            n,
            sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words),
        )
    return score


@pytest.mark.parametrize("heavy", [200_000, 5])
def test_base_scores_and_a_better_model(documents, monkeypatch, heavy):
    """With few heavy words, most counts come by the join."""
    monkeypatch.setattr(lm_score, "HEAVY", heavy)
    rows = [(i, t) for i, t, _ in corpus(400)] + [(1000, None), (1001, ""), (1002, "Never seen É\x85x"), (1003, "ko " * 30_000)]
    found = lm_score.score(documents(rows, "score", "word", "rid"), fold("doc_id", 10) != 0).collect()
    expected = plain_base(rows)
    for r in found:
        n, known, total, base = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    common = [r for r in found if r.doc_id < 1000 and r.held_out]
    assert sum(r.score for r in common) > sum(r.base_score for r in common)


def plain_log10(model, counts, history, word):
    """A word's log10 probability by the definition: class, then slot or rest of the class, then its share of the rest."""

    def choice(names, bias):
        z = [sum(float(model.weights[n][k]) for n in names) + float(bias[k]) for k in range(len(bias))]
        total = math.log(sum(map(math.exp, z)))
        return [x - total for x in z]

    found = lm_score.features(np.array([*history, 0], np.uint64))[-1:]
    place = np.array([model.classes.of(word)])
    outer, inner = lm_score.decisions(found, place, len(model.weights).bit_length() - 2)[0].tolist()
    group, slot = divmod(int(place[0]), lm_score.SLOTS)
    log = choice(outer, model.classes.bias[0])[group] + choice(inner, model.classes.bias[1 + group])[slot]
    if word in model.classes.slots:
        return log / math.log(10)
    rest = [c for w, c in counts.items() if model.classes.of(w) == place[0]]
    return log / math.log(10) + math.log10((counts.get(word, 0) + 0.1) / (sum(rest) + 0.1 * (len(rest) + 1)))


def hashed(word):
    return int(lm_score.hashed_words(pa.array([word], pa.binary()))[0][lm_score.PAD])


def test_scores_equal_the_definition(documents):
    """Every held-out text, word by word; repeated rows count each, rows without id are scored but not learned from."""
    rows = [(i, t) for i, t, _ in corpus(300)]
    rows += [rows[7]] * 2 + [(None, "ko only-here")] + [(1000, None), (1001, ""), (1002, "Never seen É x")]
    df = documents(rows)
    training = fold("doc_id", 10) != 0
    found = lm_score.score(df, training).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
    model, words = lm_score.learn(df.where(training).select("text"))
    counts = {bytes(r.word): r.c for r in words.collect()}
    assert b"only-here" not in counts
    texts = dict(rows)
    for r in [r for r in found if r.held_out or r.doc_id in (7, 1000, 1001, 1002)]:
        history, total = [0, 0, 0], 0.0
        for word in tokens(texts[r.doc_id]):
            total += plain_log10(model, counts, history, word)
            history = [*history[1:], int(lm_score.END_HASH) if word == b"\n" else hashed(word)]
        assert r.score == pytest.approx(total, rel=1e-4)


def test_model_is_a_distribution(documents):
    """After any history, the probabilities of all classes and of all slots add to 1, and so do the shares of the words of a rest."""
    model, words = lm_score.learn(documents(corpus(300)).select("doc_id", "text"))
    counts = {bytes(r.word): r.c for r in words.collect()}
    assert model.classes.slots and any(w not in model.classes.slots for w in counts)
    assert len(set(model.classes.slots.values())) == len(model.classes.slots)
    everything = [*counts, b"\x00unknown"]
    for history in ([0, 0, 0], [1 << 60, 7 << 50, 123456789]):
        total = sum(10 ** plain_log10(model, counts, history, w) for w in everything)
        # an unknown word stands for its class; those of all other classes have a place, too
        seen = {model.classes.of(b"\x00unknown")}
        for ending in model.classes.endings:
            word = b"\x00\x00unknown" + ending
            if len(ending) == 2 and model.classes.of(word) not in seen:
                seen.add(model.classes.of(word))
                total += 10 ** plain_log10(model, counts, history, word)
        assert total == pytest.approx(1, abs=2e-3)


def test_long_and_late_texts_teach_the_contexts(documents):
    """What follows what is learned from a text of any length, also where only one shard of many has it."""
    rows = [(i, t) for i, t, _ in corpus(40)] + [(1000, "left right " * 30_000)]
    for partitions in (1, 7):
        learned = documents(rows).repartition(partitions).select("doc_id", "text")
        model, _ = lm_score.learn(learned)
        held = lm_score.hashed_words(pa.array(["left right left right left"]))[0]
        place = np.full(len(held) - lm_score.PAD, model.classes.of(b"left"))
        shares = np.exp(lm_score.token_shares(lm_score.features(held), place, model.weights, model.classes.bias))
        assert shares[4] > 0.9


@pytest.mark.parametrize("least", [1_000_000, 500])
def test_scores_hardly_depend_on_storage(documents, monkeypatch, least):
    """One shard or many, from 1, 7 or 40 partitions: the held-out gain stays."""
    monkeypatch.setattr(lm_score, "LEAST_TOKENS", least)
    rows = [(i, t) for i, t, _ in corpus(600)]
    gain = []
    for partitions in (1, 7, 40):
        found = lm_score.score(documents(rows).repartition(partitions), fold("doc_id", 10) != 0).where("held_out")
        n, better = found.agg(F.sum("n_tokens"), F.sum(F.col("score") - F.col("base_score"))).first()
        gain.append(better / n)
    assert min(gain) > 0 and max(gain) - min(gain) < (0.05 if least > 500 else 0.5 * max(gain)), gain


def test_sums_equal_plain_addition():
    rng = np.random.default_rng(1)
    for n, most in ((1, 3), (500, 7), (5_000, 4_000)):
        buckets = (rng.zipf(1.2, (n, 4)) % most).astype(np.int32)
        error = rng.normal(size=(n, 16)).astype(np.float32)
        want, seen = np.zeros((most, 16)), np.bincount(buckets.ravel(), minlength=most)
        np.add.at(want, buckets.ravel(), np.repeat(error, 4, axis=0))
        at, total, count = lm_score._sums(error, buckets)
        assert np.allclose(total, want[at], atol=1e-2) and (count == seen[at]).all() and len(at) == (seen > 0).sum()


def test_a_step_equals_the_definition():
    rng = np.random.default_rng(2)
    found = rng.integers(0, 40, (300, lm_score.FEATURES)).astype(np.uint64)
    place = rng.integers(0, lm_score.CLASSES * lm_score.SLOTS, 300)
    bias = rng.normal(size=(lm_score.CLASSES + 1, lm_score.SLOTS)).astype(np.float32)
    x, row, y = lm_score.decisions(found, place, 6)
    error = np.exp(bias[row]) / np.exp(bias[row]).sum(axis=1, keepdims=True)
    error[np.arange(len(y)), y] -= 1
    g = np.zeros((2 << 6, lm_score.SLOTS))
    np.add.at(g, x, error[:, None])
    w, used, seen = np.zeros(g.shape, np.float32), np.ones(len(g), np.float32), np.zeros(len(g), np.int64)
    lm_score.gradient_steps(w, used, seen, bias, found, place)
    assert np.allclose(used, 1 + (g * g).sum(axis=1), rtol=1e-4)
    assert np.allclose(w, -lm_score.RATE * g / np.sqrt(used)[:, None], atol=1e-4)
    assert (seen == np.bincount(x.ravel(), minlength=len(g))).all()


def test_sums_of_buckets_that_need_more_than_32_bits():
    """Bucket and place then make one number of 64 bits."""
    rng = np.random.default_rng(3)
    buckets, error = rng.integers(0, 90, (700, 4)), rng.normal(size=(700, 16)).astype(np.float32)
    few = lm_score._sums(error, buckets)
    at, total, count = lm_score._sums(error, buckets << 24)
    assert (at == few[0] << 24).all() and (total == few[1]).all() and (count == few[2]).all()


def test_a_word_is_hashed_and_counted_once_a_batch(monkeypatch):
    """Work goes with the distinct words, not with every place where one stands."""
    texts = ["the cat The dog " * 500, None, "", "dog\tcat"]
    expected = Counter(w for t in texts for w in tokens(t))
    sizes = []
    plain = lm_score.mix64
    monkeypatch.setattr(lm_score, "mix64", lambda x: sizes.append(len(x)) or plain(x))
    hashes, _, length = lm_score.hashed_words(pa.array(texts))
    assert length.tolist() == [2001, 1, 1, 3] and len(hashes) == 2006 + 4 * lm_score.PAD
    assert max(sizes) <= len(expected)
    monkeypatch.setattr(lm_score, "words_of", None)  # no text is cut into Python objects
    for flush in (1, 400_000):
        monkeypatch.setattr(lm_score, "FLUSH", flush)
        found = Counter()
        for part in lm_score._count(iter([pa.record_batch({"text": pa.array([t], pa.string())}) for t in texts])):
            found.update(dict(zip(part.column("word").to_pylist(), part.column("c").to_pylist(), strict=True)))
        assert found == expected


def test_hashed_words_are_the_words(monkeypatch):
    texts = ["Ab aB\tc", None, "", " \x0b\r\n", "É\x85x\x00 y", "ab", "z" * 300 + " C", "a\x1cb\u00a0c"]
    whole = pa.array(texts)
    monkeypatch.setattr(lm_score, "PIECE", 8)
    parts = [whole.slice(*p) for p in lm_score.pieces(whole)]
    assert len(parts) > 2 and sum(len(p) for p in parts) == len(texts)
    seen = {}
    for part in parts:
        hashes, last, length = lm_score.hashed_words(part)
        words = [lm_score.words_of(t) for t in part.to_pylist()]
        assert length.tolist() == [len(w) for w in words]
        at = 0
        for text in words:
            assert not hashes[at : at + lm_score.PAD].any()
            at += lm_score.PAD
            for word in text:
                assert seen.setdefault(word, int(hashes[at])) == hashes[at]
                assert lm_score.ending_of(int(last[at])) == word[-2:]
                at += 1
    assert len(set(seen.values())) == len(seen)


def test_buckets_grow_with_the_vocabulary():
    found = [lm_score.bits_for(n) for n in (0, 5_000, 20_000, 10**9)]
    assert found[0] == found[1] == lm_score.BITS < found[2] <= found[3] == lm_score.MOST_BITS


def test_language_model_without_training(documents):
    assert lm_score.score(documents([]), fold("doc_id", 10) != 0).count() == 0
    got = lm_score.score(documents([(1, "a b"), (None, "c")]), F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) for r in got)


def labelled(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int").selectExpr("*", "'x' AS text", "'y' AS lang")


def test_toxic_words_and_group_names(documents, spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        text = sentence(rng, "aa", 30)
        toxic = i % 5 == 0
        if toxic:
            text += rng.choice([" vilexa", " vilexum", " grobnar"]) + ". " + rng.choice(["women", "men", "muslims", "jews"])
        rows.append((i, text))
        labels.append((i, int(toxic)))
    labels += [(1, 0), (2, None), (None, 1), (9999, 1)]
    df = documents(rows, "score", "predicted", "toxic")
    model = toxicity.learn(df, labelled(spark, labels, "toxic").where(fold("doc_id", 3) != 1))
    found = {r.doc_id: r for r in toxicity.score(df, model, "doc_id long").collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(found[i].predicted == (i % 5 == 0) for i in held)
    known = toxicity._Known(model.weights)
    plain = sentence(rng, "aa", 20)
    alone = toxicity.text_score(model, plain, known)
    named = [toxicity.text_score(model, f"{plain} {name}", known) for name in toxicity.NAMES]
    assert max(named) < 0.3 and max(named) - alone < 0.3
    new_form = toxicity.text_score(model, plain + " vilexission vilexa", known)
    assert new_form > 0.7


def test_every_naming_sentence_is_swapped(documents, spark, monkeypatch):
    given = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, pairs: given.extend(pairs))
    rows = [(i, "Women sing. Nobody came. The old men wait! No name") for i in range(2_050)] + [(3_000, "none here")]
    toxicity.learn(documents(rows), labelled(spark, [(i, i % 2) for i, _ in rows], "toxic"))
    assert len(given) == 2 * 2_050 + 1
    (gone, come), (more_gone, more_come) = given[:2]
    assert set(toxicity.features_of("women")) >= set(gone.tolist()) and set(toxicity.features_of("men")) >= set(come.tolist())
    assert not set(toxicity.features_of("wait")) & {*more_gone.tolist(), *more_come.tolist()}


def test_swaps_of_a_text_are_bounded_and_follow_its_text(documents, spark, monkeypatch):
    """Of many naming sentences the first by hash; neither ids nor the order of rows choose names."""
    text = ". ".join(f"men and jews met {SYLLABLES['aa'][k % 9 :]} {k}x" for k in range(100))
    assert len(toxicity.pairs_of(text)) == toxicity.TEXT_PAIRS and len(toxicity.pairs_of(text, 200)) == 100
    given = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, pairs: given.append([tuple(map(bytes, p)) for p in pairs]))
    for first in (0, 5_000):
        rows = [(first, text), (first, text), (first + 1, "Old muslims sing. Gay men wait"), (first + 2, "none")]
        toxicity.learn(documents(rows), labelled(spark, [(first + k, k % 2) for k in range(3)], "toxic"), text_pairs=10)
    assert given[0] == given[1] and len(given[0]) == 10 + 2 + 1


def test_penalty_makes_group_names_weigh_less(documents, spark):
    """With and without the penalty, on labels that go with a name."""
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        name = rng.choice(["women", "muslims"] if toxic and rng.random() < 0.8 else ["men", "jews"])
        rows.append((i, sentence(rng, "aa", 15) + f" {name}" + (rng.choice([" vilexa", " grobnar"]) if toxic else "")))
        labels.append((i, int(toxic)))
    change = []
    for penalty in (0.0, toxicity.SWAP_PENALTY):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(toxicity, "SWAP_PENALTY", penalty)
            model = toxicity.learn(documents(rows), labelled(spark, labels, "toxic"))
        known = toxicity._Known(model.weights)
        score = lambda text: toxicity.text_score(model, text, known)  # noqa: E731, B023
        change.append(abs(score("ba ko women mita") - score("ba ko men mita")))
        assert score("ba ko men grobnar") > 0.7
    assert change[1] < 0.5 * change[0], change


def test_swaps_stay_in_their_group():
    for name, others in toxicity.SWAPS.items():
        assert others and name not in others
        changed = toxicity.swapped({name, "word"}, 3)
        assert "word" in changed and changed - {"word"} <= set(others)
    assert toxicity.swapped({"word"}, 1) is None


def test_toxicity_of_odd_texts_and_without_labels(documents, spark):
    odd = documents([(1, None), (2, ""), (3, "!!"), (4, "vilexa " * 50_000), (None, "x")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.learn(odd, none) is None
    assert all(r.score == 0 and r.predicted == 0 for r in toxicity.score(odd, None, "doc_id long").collect())
    one_kind = toxicity.learn(documents([(1, "a b"), (2, None), (3, "")]), labelled(spark, [(1, 0), (2, 0), (3, 0)], "toxic"))
    assert all(0 <= r.score < 0.7 for r in toxicity.score(odd, one_kind, "doc_id long").collect())
    assert toxicity.score(documents([]), one_kind, "doc_id long").count() == 0


def brute_marginals(emission, transitions):
    """By all label sequences."""
    n = len(emission)
    weight = {}
    for states in itertools.product((0, 1), repeat=n):
        s = sum(emission[k] for k in range(n) if states[k]) + sum(transitions[a, b] for a, b in zip(states, states[1:]))
        weight[states] = math.exp(s)
    total = sum(weight.values())
    return [sum(w for s, w in weight.items() if s[k]) / total for k in range(n)], [
        [sum(w * sum((x, y) == (a, b) for x, y in zip(s, s[1:])) for s, w in weight.items()) / total for b in (0, 1)]
        for a in (0, 1)
    ]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    length, transitions = [3, 1, 5, 2], rng.normal(size=(2, 2))
    first = np.cumsum([0, *length[:-1]])
    emission = rng.normal(size=sum(length)) * 3
    got, pairs = quality_crf._passes(emission, transitions, first, np.ones(4))
    want, total = [], np.zeros((2, 2))
    for s, k in zip(first, length, strict=True):
        p, e = brute_marginals(emission[s : s + k], transitions)
        want += p
        total += e
    assert np.allclose(got, want) and np.allclose(pairs, total)


def test_line_features_see_neighbours():
    x, chars, first = quality_crf.line_features(["AB!\nab cd ab\n", "", "ab\nab"])
    own = quality_crf.OWN
    assert first.tolist() == [0, 3, 4] and chars.tolist() == [3, 8, 1, 1, 2, 2]
    assert np.array_equal(x[1, own : 2 * own], x[0, :own]) and np.array_equal(x[0, 2 * own : 3 * own], x[1, :own])
    assert not x[0, own : 2 * own].any() and not x[3, own : 3 * own].any()
    assert x[:, 11].tolist() == [0, 0, 0, 0, 1, 1] and x[1, 9] == pytest.approx(1 / 3)


def quality_rows(n):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        lines = [sentence(rng, "aa") for _ in range(rng.randrange(1, 7))]
        rows.append((i, "\n".join(lines if good else [x.upper().replace(" ", "!! ") for x in lines])))
        labels.append((i, int(good)))
    return rows, labels


def test_quality_of_held_out_documents(documents, spark):
    rows, labels = quality_rows(400)
    df = documents(rows, "score", "quality", "predicted")
    extra = [(1, 1), (2, None), (None, 0), (9999, 0)]
    chain = quality_crf.learn(df, labelled(spark, labels + extra, "quality").where(fold("doc_id", 5) != 0))
    found = {r.doc_id: r for r in quality_crf.score(df, chain, "doc_id long").collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i].predicted == (i % 4 != 0) for i in held)
    odd = [(1, None), (2, ""), (3, "\n\n\n"), (4, "ba ko\n" * 20_000), (5, "x" * 300_000), (None, "ba")]
    assert all(0 <= r.score <= 1 for r in quality_crf.score(documents(odd), chain, "doc_id long").collect())
    assert quality_crf.score(documents([]), chain, "doc_id long").count() == 0


def test_quality_without_labels(documents, spark):
    df = documents([(1, "a"), (2, None)])
    assert quality_crf.learn(df, spark.createDataFrame([], "doc_id long, quality int")) is None
    assert [r.score for r in quality_crf.score(df, None, "doc_id long").collect()] == [0.5, 0.5]
    chain = quality_crf.learn(df, labelled(spark, [(1, 1)], "quality"))
    assert all(0.5 <= r.score <= 1 for r in quality_crf.score(df, chain, "doc_id long").collect())
