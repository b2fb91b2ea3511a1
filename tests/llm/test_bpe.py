"""Encoding and decoding against the library that the vocabulary belongs to."""

import hashlib
import random

import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(vocabulary, text):
    known = bpe.Encoded(vocabulary)
    pieces = vocabulary.pieces(text)
    known.learn([pieces])
    assert "".join(pieces) == text
    return [int(i) for w in pieces for i in known[w][0].split(",")]


ODD = [
    "", " ", "a", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext|", " \n\n a  b\t\tc ", "it's we'll I'M 's 123 ４５ ½ ²",
    "日本語 テスト ありがとう", "é" * 50, "aaaa" * 2000, "​ x　y\x85z\x1c\x1dq", "🙂🙂👍🏽 ok", "\r\n\r\n x", "ab" * 3000 + "ba" * 99,
    "À́ \U000323b0a ࢏b", "\x00\x01 ﻿", "'S 'd''ll", "  '  's", "x" * 60_000,
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(vocabulary, library, text):
    ids = ids_of(vocabulary, text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(vocabulary, library, text):
    assert ids_of(vocabulary, text) == library.encode(text, add_special_tokens=False).ids


def test_texts_of_common_parts(vocabulary, library):
    rng = random.Random(1)
    parts = ["th", "e", "in", "g", " ", "ab", "re", "s", "tion", "al", "é", "'", "1"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 30)))
        assert ids_of(vocabulary, text) == library.encode(text, add_special_tokens=False).ids


def test_checked_proposals_are_the_exact_merges(vocabulary):
    rng = random.Random(2)
    words = ["".join(rng.choice("thereinglysonab ") for _ in range(rng.randrange(1, 40))).encode() for _ in range(2000)]
    exact = [vocabulary.merge_exactly(w) for w in words]
    proposed = [vocabulary.propose(w) for w in words]
    assert vocabulary.encode_words(words) == exact
    assert 0 < sum(p == e for p, e in zip(proposed, exact, strict=True)) < len(words)


def test_long_and_short_merging_agree(vocabulary, monkeypatch):
    words = [b"thethethere", b"aaaaaaaaaaaaaaa", b" international", b"1000000000"]
    short = [vocabulary.merge_exactly(w) for w in words]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert [vocabulary.merge_exactly(w) for w in words] == short


def test_written_out_classes_equal_the_pattern(vocabulary):
    for c in map(chr, range(0x250)):
        for text in (f"a{c}1", f"1{c}a", f" {c}", f"{c} {c}", f"!{c}", f"{c}\n{c}"):
            assert bpe.LATIN_PATTERN.findall(text) == vocabulary.words.findall(text)


def test_later_letters_are_signs(vocabulary):
    assert all(regex.match(r"\p{L}|\p{N}", c) for c in map(chr, (0x558, 0x323B0, 0x11DE0)))
    assert vocabulary.pieces("a՘b") == ["a", "՘", "b"]


def test_tables(documents, vocabulary):
    rows = [(1, "Hello there"), (2, None), (3, ""), (4, "é<|endoftext|>"), (None, "x"), (1, "Hello there")]
    df = documents(rows, "ids", "n_tokens")
    encoded = bpe.encode(df, PATH)
    assert sorted((r.doc_id or 0, list(r.ids)) for r in encoded.collect()) == sorted(
        (i or 0, ids_of(vocabulary, t or "")) for i, t in rows
    )
    back = bpe.decode(encoded, PATH)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((i or 0, t or "") for i, t in rows)
    for r in bpe.round_trip(df, PATH, "doc_id long, text string").collect():
        ids = ids_of(vocabulary, r.text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.round_trip(documents([]), PATH).count() == 0


def test_forgetting_words_changes_nothing(documents, monkeypatch, vocabulary):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    known = bpe.Encoded(vocabulary)
    for text in ["one two three four five", "five six one", "seven eight nine ten", "one two"]:
        pieces = vocabulary.pieces(text)
        known.learn([pieces])
        assert [int(i) for w in pieces for i in known[w][0].split(",")] == ids_of(vocabulary, text)
