"""Byte-level BPE encoding and decoding of whole texts with a given vocabulary file.

Method: speculate and verify. A text is cut into words by the vocabulary's
pattern. For the words of a batch that are not known yet, greedy longest match
proposes tokens, and every adjacent pair of proposed tokens is tested at once
against the merge table. Only words in which a pair fails are merged exactly.

Why testing pairs is enough: merges have a rank, a merged token ranks after its
parts, and merging always takes the lowest rank. So the tokens of a word are
right exactly if each is reached by its own merges and no merge across a
boundary would have come before the merges that closed the boundary on either
side. What stands at the boundary in between is the right edge of the left token and
the left edge of the right token, level by level of their merge trees.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.llm.common import TEXT, added, mapped, wider, with_text

#: Fixed: the word pattern of this family of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of code points up to U+024F, with the members of each class written out,
#: which the standard library's matcher does in half the time.
LETTERS, NUMBERS, SPACES = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", " \t-\r\x85\xa0"
LATIN = re.compile("[\0-\u024f]*")
LATIN_PATTERN = re.compile(
    f" ?[{LETTERS}]+| ?[{NUMBERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
#: Fixed: code points that are letters or numbers in later Unicode versions only. The
#: library whose encoding is matched goes by version 15.1, in which they are neither.
LATER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 "
    "16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 "
    "191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE "
    "1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 "
    "3D000-3FC3F"
)
#: A sign that is neither letter, number nor white space.
SIGN = "\u2603"
CACHED_WORDS = 150_000
CACHED_PAIRS = 400_000
NEVER = 1 << 40
#: Bytes up to which a word is merged by looking through all its pairs.
SHORT = 24


def byte_letters() -> dict[str, int]:
    """Letter to byte of byte-level vocabularies: printable bytes stand for
    themselves, the others for the letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and their edges, read from a ``tokenizers`` JSON file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        letters = byte_letters()
        model = spec["model"]
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in ids.items():
            if token not in self.special:
                self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.byte_ids = np.zeros(256, np.int64)
        for i in ids.values():
            if len(self.bytes[i]) == 1:
                self.byte_ids[self.bytes[i][0]] = i

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        self.size = size
        self.names = [str(i) for i in range(size)]
        self.pairs: dict[int, bool] = {}
        key = left * size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]
        self.merge = {(int(a), int(b)): (r, int(m)) for r, (a, b, m) in enumerate(zip(left, right, made, strict=True))}

        # The merge that makes a token, and its two parts; -1 for single bytes.
        self.rank_of = np.full(size, -1, np.int64)
        first, last = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        for r in range(len(made) - 1, -1, -1):
            self.rank_of[made[r]], first[made[r]], last[made[r]] = r, left[r], right[r]
        self.left_edges, self.left_ends = self._edges(first)
        self.right_edges, self.right_ends = self._edges(last)
        self._mark_reachable(first, last)

        special = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.special_pattern = regex.compile(f"({special})") if special else None
        self.words = regex.compile(PATTERN)
        ranges = [[chr(int(end, 16)) for end in span.split("-")] for span in LATER.split()]
        self.later = regex.compile("[" + "".join("-".join(r) for r in ranges) + "]")

    def _edges(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token, level): the token at the edge, level by level down to a byte,
        -1 beyond; and the rank of the merge that uses each up (``NEVER`` for the token itself)."""
        levels, ends = [np.arange(self.size)], [np.full(self.size, NEVER)]
        while True:
            above = levels[-1]
            below = np.where(above >= 0, part[above], -1)
            if not (below >= 0).any():
                return np.stack(levels, 1), np.stack(ends, 1)
            levels.append(below)
            ends.append(np.where(below >= 0, self.rank_of[above], -1))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; ``NEVER`` if there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == key), self.ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, skip_whole: bool = False) -> np.ndarray:
        """Whether each pair of tokens can stand side by side in an encoding.

        Of two merges of equal rank the left one is done first. ``skip_whole``
        leaves out the merge of the two whole tokens.
        """
        fine = np.ones(len(a), bool)
        for i in range(self.right_edges.shape[1]):
            for j in range(self.left_edges.shape[1]):
                if skip_whole and i == j == 0:
                    continue
                at = np.flatnonzero(fine & (self.right_edges[a, i] >= 0) & (self.left_edges[b, j] >= 0))
                if not len(at):
                    break
                r = self.rank(self.right_edges[a[at], i], self.left_edges[b[at], j])
                fine[at] = (r == NEVER) | (r >= self.right_ends[a[at], i]) | (r > self.left_ends[b[at], j])
        return fine

    def _mark_reachable(self, first: np.ndarray, last: np.ndarray) -> None:
        """Tokens that their own bytes encode to; only these may be proposed."""
        merged = np.flatnonzero(first >= 0)
        good = np.zeros(self.size, bool)
        good[self.byte_ids] = True
        good[merged] = self.compatible(first[merged], last[merged], skip_whole=True)
        for t in merged[np.argsort(self.rank_of[merged])]:
            good[t] = good[t] and good[first[t]] and good[last[t]]
        self.known = {self.bytes[t]: int(t) for t in np.flatnonzero(good)}
        self.single = self.byte_ids.tolist()
        # By the first two bytes, the lengths of the tokens that begin so, longest first.
        lengths: dict[bytes, set[int]] = {}
        for word in self.known:
            if len(word) > 1:
                lengths.setdefault(word[:2], set()).add(len(word))
        self.lengths = {head: tuple(sorted(sizes, reverse=True)) for head, sizes in lengths.items()}

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        known, lengths, end = self.known, self.lengths, len(word)
        whole = known.get(word)
        if whole is not None:
            return [whole]
        out, at = [], 0
        while at < end:
            for size in lengths.get(word[at : at + 2], ()):
                token = known.get(word[at : at + size])
                if token is not None and at + size <= end:
                    out.append(token)
                    at += size
                    break
            else:
                out.append(self.single[word[at]])
                at += 1
        return out

    def merge_exactly(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost of equal ranks; n log n beyond a short word."""
        ids = [self.single[b] for b in word]
        n = len(ids)
        if n <= SHORT:
            none, merge = (NEVER, 0), self.merge
            found = [merge.get(p, none) for p in zip(ids, ids[1:])]  # noqa: B905
            while found:
                best = min(found)
                if best is none or best[0] == NEVER:
                    break
                k = found.index(best)
                ids[k : k + 2] = [best[1]]
                del found[k]
                if k:
                    found[k - 1] = merge.get((ids[k - 1], ids[k]), none)
                if k < len(found):
                    found[k] = merge.get((ids[k], ids[k + 1]), none)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        queue = [(*self.merge[p], k, *p) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merge]  # noqa: B905
        queue = [(r, k, m, a, b) for r, m, k, a, b in queue]
        heapq.heapify(queue)
        while queue:
            _, k, made, a, b = heapq.heappop(queue)
            nxt = after[k]
            if not alive[k] or ids[k] != a or nxt >= n or ids[nxt] != b:
                continue
            ids[k], alive[nxt] = made, False
            after[k] = after[nxt]
            if after[k] < n:
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < n and (found := self.merge.get((ids[x], ids[y]))):
                    heapq.heappush(queue, (found[0], x, found[1], ids[x], ids[y]))
        return [t for t, live in zip(ids, alive, strict=True) if live]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word: proposed, checked pair by pair, and merged where that fails."""
        proposed = [self.propose(w) for w in words]
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(lengths.sum()))
        if len(flat) < 2:
            return proposed
        owner = np.repeat(np.arange(len(words)), lengths)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        for k in np.unique(owner[inside[~self._tested(pairs)[which]]]):
            proposed[k] = self.merge_exactly(words[k])
        return proposed

    def _tested(self, pairs: np.ndarray) -> np.ndarray:
        """``compatible``, remembered for pairs tested before."""
        if len(self.pairs) > CACHED_PAIRS:
            self.pairs.clear()
        names = pairs.tolist()
        new = np.array([p for p in names if p not in self.pairs], np.int64)
        self.pairs.update(zip(new.tolist(), self.compatible(new // self.size, new % self.size).tolist(), strict=True))
        return np.array([self.pairs[p] for p in names], bool)

    def pieces(self, text: str) -> list[str]:
        """The words and special tokens of a text, in order; together they are the text."""
        parts = self.special_pattern.split(text) if self.special_pattern else [text]
        out: list[str] = []
        for part in parts:
            if part in self.special:
                out.append(part)
            elif LATIN.fullmatch(part):
                out.extend(LATIN_PATTERN.findall(part))
            elif not self.later.search(part):
                out.extend(self.words.findall(part))
            else:
                out.extend(part[m.start() : m.end()] for m in self.words.finditer(self.later.sub(SIGN, part)))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def _vocabulary(name: str) -> Vocabulary:
    with open(SparkFiles.get(name), encoding="utf-8") as file:
        return Vocabulary(file.read())


class Encoded(dict):
    """For words and special tokens met before: decimal ids joined by commas, and the bytes they decode to.

    Of at most twice ``CACHED_WORDS`` entries, those not met for long are forgotten.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, tuple[str, bytes]] = {}

    def learn(self, texts: list[list[str]]) -> None:
        if len(self) > CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        v, older = self.vocabulary, self.older
        lacking = set().union(*texts).difference(self)
        again = lacking.intersection(older)
        self.update((w, older[w]) for w in again)
        new = lacking.difference(again)
        special = [w for w in new if w in v.special]
        plain = list(new.difference(special))
        found = v.encode_words([w.encode() for w in plain]) + [[v.special[w]] for w in special]
        for word, ids in zip(plain + special, found, strict=True):
            self[word] = (",".join([v.names[i] for i in ids]), b"".join([v.bytes[i] for i in ids]))


@functools.lru_cache(maxsize=2)
def _encoded(name: str) -> Encoded:
    return Encoded(_vocabulary(name))


#: Words that are cut and looked up together; a text is never split over two such steps.
STEP = 1 << 18


def _rows(name: str, texts: list[str]):
    """What is known of the words of each text; new words of several texts are learned at a time."""
    known = _encoded(name)
    held: list[list[str]] = []
    count = 0
    for text in [*texts, None]:
        if held and (text is None or count >= STEP):
            known.learn(held)
            for words in held:
                yield list(map(known.__getitem__, words))
            held, count = [], 0
        if text is not None:
            held.append(known.vocabulary.pieces(text))
            count += len(held[-1])


def _encode(name: str):
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(TEXT).to_pylist()]
        ids = pa.array(([int(i) for ids, _ in found for i in ids.split(",")] for found in _rows(name, texts)), pa.list_(pa.int32()))
        return added(batch, ids=ids)

    return one


def _decode(name: str):
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = _vocabulary(name)
        texts = [None if x is None else vocabulary.decode(x) for x in batch.column(TEXT).to_pylist()]
        return added(batch, text=pa.array(texts, pa.string()))

    return one


def _digests(name: str):
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, encoded, decoded = [], [], []
        for found in _rows(name, [t or "" for t in batch.column(TEXT).to_pylist()]):
            ids = ",".join([ids for ids, _ in found])
            counts.append(ids.count(",") + 1 if ids else 0)
            encoded.append(hashlib.sha256(ids.encode()).hexdigest())
            text = b"".join([part for _, part in found]).decode("utf-8", "replace")
            decoded.append(hashlib.sha256(text.encode()).hexdigest())
        return added(batch, n_tokens=pa.array(counts, pa.int64()), ids_sha256=encoded, decoded_sha256=decoded)

    return one


def ship(spark: SparkSession, path: str) -> str:
    """Send the vocabulary file to the executors; its name there."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rpartition("/")[2]


def encode(documents: DataFrame, vocabulary: str, keep: str | StructType = "doc_id long") -> DataFrame:
    """Columns ``keep`` and ``ids array<int>`` for every row; null text counts as empty.

    ``vocabulary`` is the path of a byte-level ``tokenizers`` JSON file that the
    driver can read. Special tokens written in a text are encoded as such; none is added.
    """
    name = ship(documents.sparkSession, vocabulary)
    return mapped(with_text(documents, keep), _encode(name), wider(keep, "ids array<int>"))


def decode(rows: DataFrame, vocabulary: str, keep: str | StructType = "doc_id long") -> DataFrame:
    """Columns ``keep`` and ``text`` from ``ids``; special tokens stay, null ids give null."""
    name = ship(rows.sparkSession, vocabulary)
    return mapped(with_text(rows, keep, "ids", "array<int>"), _decode(name), wider(keep, "text string"))


def round_trip(documents: DataFrame, vocabulary: str, keep: str | StructType = "doc_id long") -> DataFrame:
    """Columns ``keep``, n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the text decoded from these ids), in one pass over the texts."""
    name = ship(documents.sparkSession, vocabulary)
    schema = wider(keep, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return mapped(with_text(documents, keep), _digests(name), schema)
