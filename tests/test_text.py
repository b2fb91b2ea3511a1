"""Text operators: what must hold for any text, and literal cases."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import chunking

ALPHABET = "ab9_ÉßΣ語😀.!?,-" + " \t\n\r\x0b\x1c\x1f\x85\xa0   　"
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=120), min_size=1, max_size=25)
SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def docs_of(spark, texts):
    rows = [(i, f"s{i % 2}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def evaluate(spark, texts, column):
    rows = docs_of(spark, texts).select("doc_id", column.alias("v")).collect()
    return [r["v"] for r in sorted(rows)]


def chunks_per_doc(df, n):
    out = [[] for _ in range(n)]
    for r in sorted(df.collect(), key=lambda r: (r["doc_id"], r["chunk_no"])):
        out[r["doc_id"]].append(r["text"])
    return out


def dense(text):
    return "".join(text.split())


def test_whitespace_pattern_is_the_character_list(spark):
    every = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c,) for c in every], "c string")
    found = {r["c"] for r in df.filter(F.col("c").rlike(f"^{X.WS}$")).collect()}
    assert found == set(X.WHITESPACE) == {c for c in every if c.isspace()}


@SLOW
@given(TEXTS)
def test_white_space(spark, texts):
    t = F.col("text")
    assert evaluate(spark, texts, X.strip(t)) == [s.strip() for s in texts]
    assert evaluate(spark, texts, X.words(t)) == [s.split() for s in texts]
    assert evaluate(spark, texts, X.flatten_whitespace(t)) == [" ".join(s.split()) for s in texts]


@SLOW
@given(TEXTS)
def test_tidy_paragraphs(spark, texts):
    for before, after in zip(texts, evaluate(spark, texts, X.tidy_paragraphs(F.col("text"))), strict=True):
        assert dense(after) == dense(before)
        assert after == after.strip()
        assert not any(bad in after for bad in ("\r", "\t", "  ", "\n\n\n"))
        # Characters other than blanks and line ends are where they were.
        assert [c for c in after if c not in " \n"] == [c for c in before.strip() if c not in " \t\r\n"]


@pytest.mark.parametrize(
    "before,after",
    [
        ("a\r\nb\rc", "a\nb\nc"),
        ("a \t b", "a b"),
        ("a\n\n\n\nb", "a\n\nb"),
        ("a\n \n \nb", "a\n \n \nb"),
        ("\n\n a \n\n", "a"),
        ("a\r\n\r\n\r\nb", "a\n\nb"),
        ("a\n\nb", "a\n\nb"),
        ("", ""),
    ],
)
def test_tidy_paragraphs_by_hand(spark, before, after):
    assert evaluate(spark, [before], X.tidy_paragraphs(F.col("text"))) == [after]


@SLOW
@given(TEXTS)
def test_tokens(spark, texts):
    found = {mode: evaluate(spark, texts, X.tokens(F.col("text"), mode)) for mode in X.TOKEN_MODES}
    for k, text in enumerate(texts):
        low = text.lower()
        assert found["ws"][k] == low.split()
        assert "".join(found["word"][k]) == "".join(c for c in low if c.isalnum() or c == "_")
        assert found["ascii"][k] == [t for t in found["word"][k] if re.fullmatch("[a-z0-9]+", t)]
        at = 0
        for token in found["word"][k]:  # each is a whole run, in order
            at = low.index(token, at)
            end = at + len(token)
            assert not any(c.isalnum() or c == "_" for c in low[max(0, at - 1) : at] + low[end : end + 1])
            at = end


@SLOW
@given(TEXTS)
def test_sentences(spark, texts):
    for text, parts in zip(texts, evaluate(spark, texts, X.sentence_array(F.col("text"))), strict=True):
        assert dense("".join(parts)) == dense(text)
        assert all(p and p == p.strip() for p in parts)
        assert all(p[-1] in ".!?" for p in parts[:-1])
        assert not any(re.search(r"[.!?]\s", p) for p in parts)


def test_sentences_by_hand(spark):
    text = "One. Two!  Three? v1.5 stays... Yes.No. \n Last"
    assert evaluate(spark, [text], X.sentence_array(F.col("text"))) == [
        ["One.", "Two!", "Three?", "v1.5 stays...", "Yes.No.", "Last"]
    ]


@SLOW
@given(TEXTS, st.integers(1, 9), st.data())
def test_word_windows(spark, texts, size, data):
    """Windows cover a paragraph, neighbours share exactly the overlap, none is longer than the size."""
    overlap = data.draw(st.integers(0, size - 1))
    windows = X.word_windows(F.array("text"), size, overlap)
    for text, cut in zip(texts, evaluate(spark, texts, windows), strict=True):
        words = text.split()
        if len(words) <= size:
            assert cut == [text]
            continue
        parts = [c.split(" ") for c in cut]
        assert all(len(p) == size for p in parts[:-1]) and overlap < len(parts[-1]) <= size
        assert parts[0] + [w for p in parts[1:] for w in p[overlap:]] == words
        assert all(a[len(a) - overlap :] == b[:overlap] for a, b in zip(parts, parts[1:], strict=False))


@SLOW
@given(TEXTS, st.integers(1, 9), st.data())
def test_character_windows(spark, texts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    solid = [dense(t) for t in texts]  # nothing to strip, so windows can be put together again
    for text, cut in zip(solid, evaluate(spark, solid, X.char_windows(F.col("text"), size, overlap)), strict=True):
        assert "".join([*cut[:1], *(c[overlap:] for c in cut[1:])]) == text
        assert all(len(c) == size for c in cut[:-1]) and (not cut or 0 < len(cut[-1]) <= size)
        assert len(cut) < 2 or len(cut[-1]) > overlap


@SLOW
@given(TEXTS, st.integers(2, 9))
def test_chunks_lose_nothing_but_white_space(spark, texts, size):
    docs, n = docs_of(spark, texts), len(texts)
    for made in (
        chunking.chunk_words(docs, size, 0, "\n"),
        chunking.chunk_chars(docs, size, 0, "flat"),
        chunking.chunk_chars(docs, size, 0, "paragraph"),
    ):
        chunks = chunks_per_doc(made, n)
        assert [dense("".join(c)) for c in chunks] == [dense(t) for t in texts]
        assert all(c and c == c.strip() for each in chunks for c in each)


def test_chunks_by_hand(spark):
    docs = docs_of(spark, ["ab cd  ef\n\n gh", "a b c d e\n\nf", "  "])
    assert chunks_per_doc(chunking.chunk_chars(docs, 5, 2, "flat"), 3) == [
        ["ab cd", "cd ef", "ef gh"], ["a b c", "c d", "d e f"], [],
    ]
    assert chunks_per_doc(chunking.chunk_chars(docs, 5, 2, "paragraph"), 3) == [
        ["ab cd", "cd ef", "ef", "gh"], ["a b c", "c d", "d e", "f"], [],
    ]
    assert chunks_per_doc(chunking.chunk_words(docs, 3, 1), 3) == [["ab cd  ef", "gh"], ["a b c", "c d e", "f"], []]


def test_long_paragraph_windows(spark):
    text = " ".join(f"w{i}" for i in range(211))
    rows = chunking.chunk_words(docs_of(spark, ["short one\nline", text])).collect()
    assert [(r["doc_id"], r["chunk_no"], r["chunk_id"]) for r in rows] == [
        (0, 1, "chunk-001"), (1, 1, "chunk-001"), (1, 2, "chunk-002"), (1, 3, "chunk-003"), (1, 4, "chunk-004"),
    ]
    assert rows[0]["text"] == "short one\nline"
    assert [r["text"].split()[0] for r in rows[1:]] == ["w0", "w65", "w130", "w195"]
    assert rows[-1]["text"].split()[-1] == "w210"


def test_chunk_numbers_past_three_digits(spark):
    text = "\n\n".join(f"p{i}" for i in range(1001))
    last = chunking.chunk_words(docs_of(spark, [text])).orderBy(F.desc("chunk_no")).first()
    assert (last["chunk_no"], last["chunk_id"]) == (1001, "chunk-1001")


def test_long_document_stays_whole(spark):
    """A text far longer than a window, cut and put together again."""
    text = "".join(chr(97 + i % 26) for i in range(1_000_003))
    chunks = chunks_per_doc(chunking.chunk_chars(docs_of(spark, [text]), 500, 100), 1)[0]
    assert len(chunks) == -(-(1_000_003 - 500) // 400) + 1
    assert chunks[0] + "".join(c[100:] for c in chunks[1:]) == text


def test_blank_documents(spark):
    docs = docs_of(spark, ["", " \n ", "x"])
    assert chunks_per_doc(chunking.chunk_words(docs), 3) == [[], [], ["x"]]
    sizes = chunking.document_sizes(docs).first()
    assert (sizes["documents"], sizes["blank_documents"], sizes["characters"], sizes["words"]) == (3, 2, 4, 1)


@pytest.mark.parametrize("size,overlap", [(5, 5), (5, 9), (0, 0), (5, -1)])
def test_windows_that_would_not_advance(spark, size, overlap):
    with pytest.raises(ValueError):
        chunking.chunk_chars(docs_of(spark, ["x"]), size, overlap)
