"""Language-model scores of whole texts: a hashed maximum-entropy class model.

Method: a word's probability is that of its class, given the words before it, times that of the word in its class, given
the class and the words before it. Both are softmaxes over hashed features of the history: the last word, the last two, and
the words two and three places back (skips). The second one's features are hashed together with the class, and its choices are the ``SLOTS - 1``
words that the class has a slot for, and the rest of the class, whose words follow their counts over all training documents.

Weights are trained by distributed gradient
steps over every token of every training text: in each round each shard of the rows steps over its Arrow batches from the
common weights, and the changes are averaged, bucket by bucket, by how often a shard has used the bucket; so what only one
shard has seen counts in full. A long text is consecutive steps of one shard.

The buckets of the features grow with the vocabulary from ``2^BITS`` to ``2^most_bits`` for each of the two softmaxes; with the default
a copy of the weights takes 8.4 MB at most. The number of shards follows the number of tokens, not how rows are stored, and a shard
has a million tokens or more; which rows share a shard, and their order, do depend on storage and change scores slightly.

The most frequent words have slots in the class whose words stand next to the same very frequent words, as far as it has
room. Other words are classed by their last two bytes, in the same way. So every word has a class, known or not.

Counts and vocabulary cover every training text. The vocabulary can outgrow any
single machine: only words with at least one in ``1 / HEAVY`` of all tokens go to every
task (there are no more than ``HEAVY`` of them), and the others, none of which can be a
hot key, meet their counts by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import GOLDEN, kept, mix64

#: The end of a text as a token; no word holds white space.
END = b"\n"
ADD = 0.1
HEAVY = 200_000
#: Words whose neighbours tell classes apart; classes, the last for words with an ending that was never met; slots of a class, the last for its rest.
NEAR, CLASSES, SLOTS = 24, 16, 16
#: Buckets of the features of each softmax, as powers of two: the fewest, and the most by default.
BITS, MOST_BITS = 14, 16
FEATURES = 4
PAD = 3
ROUNDS = 2
#: A shard has no fewer than ``LEAST_TOKENS``; beyond ``SHARDS`` shards, no fewer than ``SHARD_TOKENS``.
SHARDS, LEAST_TOKENS, SHARD_TOKENS = 16, 1_000_000, 8_000_000
#: Changes of so many buckets are one row on their way to the mean, and so many shards are added at a time.
BLOCK, FAN = 256, 32
BATCH, RATE = 4096, 0.25
#: Bias of a choice that no word can be.
NEVER = -60.0
#: Largest sum of weights, and least probability of a choice, in 32 bits.
LARGEST, LEAST = 80, 1e-35
#: Rows of a bucket in a batch that are added one by one; more are added as a run.
FEW = 24
FLUSH = 400_000
STEP = 1 << 12
#: Bytes of a cache line.
LINE = 64
#: Bytes of text that are cut into words at a time; a longer text stays whole.
PIECE = 4 << 20
ODD = np.uint64(0x9FB21C651E98DF25)
END_HASH, END_LAST = np.uint64(0xD6E8FEB86659FD93), (1 << 16) + END[0]
LOWER, SPACE = bytes(range(256)).lower(), b" \t\n\r\x0b\x0c"


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text, A-Z in lower case, and the end."""
    return [*text.encode().lower().split(), END] if text else [END]


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts with at most ``PIECE`` bytes, or one text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(size, PIECE + (size[start - 1] if start else 0), "right")))
        yield start, stop - start
        start = stop


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of ``words_of`` of all texts, one after the other and without the ends, and the lengths of the texts with them."""
    whole = texts if pa.types.is_binary(texts.type) else texts.cast(pa.binary())
    whole = whole.cast(pa.large_binary()).fill_null(b"")
    cut = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[cut[0] : cut[-1]]
    cut = cut - cut[0]
    inside = (data != ord(" ")) & (data - np.uint8(9) > 4)
    new = inside.copy()
    new[1:] &= ~inside[:-1]
    first = cut[:-1][cut[:-1] < len(data)]  # a word ends with its text
    new[first] = inside[first]
    head = np.flatnonzero(new)
    low = data.tobytes().translate(LOWER, SPACE)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | new[1:]
    starts = np.zeros(len(head) + 1, np.int32)  # a piece is small, and a text has fewer than 2^31 bytes
    np.cumsum(np.flatnonzero(ends) + 1 - head, out=starts[1:])
    words = pa.BinaryArray.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(starts), pa.py_buffer(low)])
    return words, np.diff(np.searchsorted(head, cut)) + 1


def distinct_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Each word of the texts once, with the end as the last; the number in this list of every word and end; and the lengths of the texts."""
    words, length = cut_words(texts)
    found = words.dictionary_encode()
    number = np.full(int(length.sum()), len(found.dictionary))
    is_word = np.ones(len(number), bool)
    is_word[np.cumsum(length) - 1] = False
    number[is_word] = found.indices
    return pa.concat_arrays([found.dictionary, pa.array([END], pa.binary())]), number, length


def hashes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, and codes of their last two bytes; none is empty, and the last one is the end."""
    cut = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    low = np.frombuffer(words.buffers()[2], np.uint8)[cut[0] : cut[-1]]
    head, size = cut[:-1] - cut[0], np.diff(cut)
    power = np.cumprod(np.full(int(size.max()), ODD))
    value = power[np.arange(len(low)) - np.repeat(head, size)] * (low.astype(np.uint64) + np.uint64(1))
    hashes = mix64(np.add.reduceat(value, head) + size.astype(np.uint64) * GOLDEN)
    tail = head + size - 1
    last = low[tail] + np.where(size > 1, low[tail - 1].astype(np.int64) << 8, 1 << 16)
    hashes[-1], last[-1] = END_HASH, END_LAST
    return hashes, last


def padded(values: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Values of tokens with ``PAD`` zeros before each text."""
    out = np.zeros(len(values) + PAD * len(length), values.dtype)
    out[_inside(length)] = values
    return out


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of ``words_of``, as hashes and as codes of their last two bytes, each text with ``PAD`` zeros before it, and the
    lengths without them. A word is hashed once, however often it stands in the texts."""
    words, number, length = distinct_words(texts)
    hashes, last = hashes_of(words)
    return padded(hashes[number], length), padded(last[number], length), length


def last_of(ending: bytes) -> int:
    """The code of ``hashed_words`` for an ending of one or two bytes."""
    return (1 << 16) + ending[0] if len(ending) == 1 else (ending[0] << 8) + ending[1]


def ending_of(last: int) -> bytes:
    return bytes([last - (1 << 16)]) if last >= 1 << 16 else bytes([last >> 8, last & 255])


def _count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of distinct words, summed up until there are more than ``FLUSH``."""

    def added(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])

    parts, size = [], 0
    for batch in stream:
        for piece in pieces(batch.column("text")):
            words, number, _ = distinct_words(batch.column("text").slice(*piece))
            parts.append(pa.table({"word": words, "c": np.bincount(number, minlength=len(words))}))
            size += len(words)
            if size > 2 * FLUSH:
                parts = [added(parts)]
                size = len(parts[0])
                if size > FLUSH:
                    yield from parts[0].to_batches()
                    parts, size = [], 0
    if parts:
        yield from added(parts).to_batches()


def vocabulary(training: DataFrame) -> DataFrame:
    """(word, c) of all tokens of ``training`` (text); counted in the tasks before the shuffle."""
    words = training.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, "word binary, c long")
    return words.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Classes:
    """Places of words, numbered class * ``SLOTS`` + slot; by place, log10 of the denominator of a word's share in it; and
    the biases of classes, then of the slots of each class."""

    slots: dict[bytes, int]
    endings: dict[bytes, int]
    log_total: np.ndarray
    bias: np.ndarray

    def of(self, word: bytes) -> int:
        own = self.slots.get(word)
        return own if own is not None else rest_of(self.endings.get(word[-2:], CLASSES - 1))

    def numbers(self):
        """``of`` as a function of the hashes and endings of ``hashed_words``."""
        by_ending = np.full((1 << 16) + 256, rest_of(CLASSES - 1))
        by_ending[[last_of(e) for e in self.endings]] = [rest_of(c) for c in self.endings.values()]
        find = _finder(list(self.slots))
        places = np.array([*self.slots.values(), 0], np.int64)

        def numbers(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
            own = find(hashes)
            return np.where(own >= 0, places[own], by_ending[last])

        return numbers


def rest_of(group: int) -> int:
    return group * SLOTS + SLOTS - 1


def _finder(words: list[bytes]):
    """Places of hashes of ``hashed_words`` in a list of words; -1 for others."""
    hashes, _, length = hashed_words(pa.array(words, pa.binary()))
    known = hashes[np.cumsum(length + PAD) - length]
    known[[k for k, w in enumerate(words) if w == END]] = END_HASH
    order = np.argsort(known)
    known = known[order]

    def find(hashes: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.full(len(hashes), -1)
        at = np.searchsorted(known, hashes).clip(max=len(known) - 1)
        return np.where(known[at] == hashes, order[at], -1)

    return find


@dataclass(frozen=True)
class Model:
    classes: Classes
    heavy: list[bytes]
    heavy_counts: np.ndarray
    tokens: int
    words: int
    weights: np.ndarray


def features(hashed: np.ndarray) -> np.ndarray:
    """(position, feature) from the hashes of a padded token sequence; the first ``PAD`` positions are padding."""
    one, two, three = hashed[PAD - 1 : -1], hashed[PAD - 2 : -2], hashed[PAD - 3 : -3]
    salts = GOLDEN * np.arange(3, 3 + 2 * FEATURES, 2, dtype=np.uint64)
    return np.stack([mix64(x) for x in (one + salts[0], mix64(two * GOLDEN + one) + salts[1], two + salts[2], three + salts[3])], 1)


def decisions(found: np.ndarray, place: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, row of the biases and choice of two decisions a token: first all classes, then all slots."""
    group, shift = place // SLOTS, np.uint64(64 - bits)
    inner = mix64(found + (group.astype(np.uint64) * ODD)[:, None])
    buckets = np.concatenate([(found * GOLDEN) >> shift, ((inner * GOLDEN) >> shift) + np.uint64(1 << bits)]).astype(np.int32)
    return buckets, np.concatenate([np.zeros_like(group), group + 1]), np.concatenate([group, place % SLOTS])


def _empty(rows: int, width: int) -> np.ndarray:
    """Room for rows of 32-bit numbers, from the start of a cache line on; a row of 16 that begins in the middle of one costs two."""
    room = np.empty(rows * width + LINE // 4, np.float32)
    skip = -room.ctypes.data % LINE // 4
    return room[skip : skip + rows * width].reshape(rows, width)


def _aligned(rows: np.ndarray) -> np.ndarray:
    """A copy in ``_empty`` room."""
    out = _empty(*rows.shape)
    out[:] = rows
    return out


def _taken(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``rows[at]`` for rows of 32-bit numbers."""
    return rows.take(at, axis=0, out=_empty(len(at), rows.shape[1]), mode="clip")


def _exponentials(buckets: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the sums of weights (decision, choice), and their totals. Sums count to ``LARGEST`` only, so that none overflows."""
    first, *others = np.ascontiguousarray(buckets.T, np.int64)
    z = _taken(weights, first)
    z += bias
    more = np.empty_like(z)
    for other in others:
        z += weights.take(other, axis=0, out=more, mode="clip")
    if z.size and z.max() > LARGEST:
        np.minimum(z, LARGEST, out=z)
    np.exp(z, out=z)
    return z, z @ np.ones(z.shape[1], np.float32)


def shares(buckets: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Probabilities (decision, choice); ``bias`` has a row a decision."""
    z, total = _exponentials(buckets, weights, bias)
    z /= total[:, None]
    return z


def token_shares(found: np.ndarray, place: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Natural log-probability of each token's class and slot."""
    buckets, row, choice = decisions(found, place, len(weights).bit_length() - 2)
    z, total = _exponentials(buckets, weights, bias.take(row, axis=0))
    p = z.ravel().take(np.arange(0, z.size, z.shape[1]) + choice) / total
    return np.log(np.maximum(p, LEAST)).astype(np.float64).reshape(2, -1).sum(axis=0)


def bits_for(words: int, most_bits: int = MOST_BITS) -> int:
    """Buckets for a vocabulary: two a word, within the bounds."""
    return min(max(int(2 * words).bit_length(), BITS), most_bits)


def _met(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets met, how often, the positions of each one after the other, where they begin, and ``buckets`` as numbers of buckets met."""
    width, shift = buckets.shape[1], (buckets.size - 1).bit_length()
    kind = np.uint32 if int(buckets.max()) >> (32 - shift) == 0 else np.uint64  # bucket and place in one number
    found = buckets.ravel().astype(kind) << kind(shift)
    found |= np.arange(buckets.size, dtype=kind)
    found.sort()
    place = found & kind((1 << shift) - 1)
    found >>= kind(shift)
    new = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    head = np.flatnonzero(new)
    number = np.empty(buckets.shape, np.int64)
    number.ravel()[place] = np.cumsum(new) - 1
    return found[head].astype(np.int64), np.diff(head, append=len(found)), (place // kind(width)).astype(np.int64), head, number


def _sums(error: np.ndarray, buckets: np.ndarray, met: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets met, the sums of ``error`` (position, class) over the positions of each, and how many those are; ``met`` of the buckets may be given."""
    bucket, count, row, head, _ = met or _met(buckets)
    total = _taken(error, row.take(head))
    more = np.flatnonzero(count > 1)
    if len(more):
        more = more[np.argsort(-np.minimum(count[more], 1 << 14).astype(np.int16), kind="stable")]  # the buckets with a k-th row come first
        first, n = head[more], count[more]
        stops = np.searchsorted(-n, -np.arange(FEW + 1)).tolist()
        many, part = stops[FEW], total.take(more, axis=0)
        for k in range(1, int(n[many]) if many < len(n) else 1):
            part[many : stops[k]] += error.take(row.take(first[many : stops[k]] + k), axis=0, mode="clip")
        size = n[:many]
        stop = np.cumsum(size)
        run = _taken(error, row.take(np.repeat(first[:many] + size - stop, size) + np.arange(int(size.sum()))))
        one = np.ones(int(size.max(initial=0)), np.float32)
        for at, (end, rows) in enumerate(zip(stop.tolist(), size.tolist(), strict=True)):
            part[at] = one[:rows] @ run[end - rows : end]
        total[more] = part
    return bucket, total, count


def gradient_steps(w: np.ndarray, used: np.ndarray, seen: np.ndarray, bias: np.ndarray, found: np.ndarray, place: np.ndarray) -> None:
    """One pass in small batches, in place, with a step per bucket that shrinks as it is used; ``seen`` counts its uses."""
    bits, whole_row = len(w).bit_length() - 2, np.dtype((np.void, w.strides[0]))
    rows = w.view(whole_row).ravel()
    for start in range(0, len(place), BATCH):
        x, row, y = decisions(found[start : start + BATCH], place[start : start + BATCH], bits)
        met = _met(x)
        weights = _taken(w, met[0])  # the rest of the step stays in these rows
        error = shares(met[-1], weights, bias.take(row, axis=0))
        error.ravel()[np.arange(0, error.size, error.shape[1]) + y] -= 1
        at, g, count = _sums(error, x, met)
        uses = used.take(at)
        uses += np.einsum("ij,ij->i", g, g)
        used[at] = uses
        seen[at] += count
        g *= (-RATE / np.sqrt(uses))[:, None]
        g += weights
        np.put(rows, at, g.view(whole_row).ravel(), mode="clip")


def _inside(length: np.ndarray) -> np.ndarray:
    """Places of the tokens among tokens and padding."""
    return np.arange(int(length.sum())) + PAD * np.repeat(np.arange(1, len(length) + 1), length)


def _neighbours(own: list[bytes]):
    """How often each word of ``own``, and each ending of other words, stands within two places of each of the first ``NEAR`` of them."""
    endings = (1 << 16) + 256

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, seen = _finder(own), np.zeros((endings + len(own)) * NEAR, np.int64)
        for batch in stream:
            for piece in pieces(batch.column("text")):
                words, token, length = distinct_words(batch.column("text").slice(*piece))
                hashes, last = hashes_of(words)
                number = find(hashes)
                row = padded(np.where(number >= 0, endings + number, last)[token] + 1, length) - 1
                near = padded(np.where(number < NEAR, number, -1)[token] + 1, length) - 1
                for step in (1, 2):
                    for word, other in ((slice(None, -step), slice(step, None)), (slice(step, None), slice(None, -step))):
                        at = (row[word] >= 0) & (near[other] >= 0)
                        np.add.at(seen, row[word][at] * NEAR + near[other][at], 1)
        code = np.flatnonzero(seen)
        yield pa.record_batch({"code": pa.array(code, pa.int64()), "n": pa.array(seen[code])})

    return batches


def _cluster(profile: np.ndarray, mass: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """(row, group) likeness of rows to groups of rows with like directions (k-means on unit rows; starts far apart, heaviest first)."""
    unit = profile / np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-12)
    centre = [int(np.argmax(mass))]
    nearest = unit @ unit[centre[0]]
    while len(centre) < min(k, len(unit)):
        centre.append(int(np.argmax((1 - nearest).clip(1e-9) * mass)))
        nearest = np.maximum(nearest, unit @ unit[centre[-1]])
        nearest[centre] = 1
    middle = unit[centre]
    for _ in range(rounds):
        group = np.argmax(unit @ middle.T, axis=1)
        for c in range(len(middle)):
            if (group == c).any():
                total = (profile[group == c]).sum(axis=0)
                middle[c] = total / max(np.linalg.norm(total), 1e-12)
    return unit @ middle.T


def make_classes(words: DataFrame, training: DataFrame, heavy: list[bytes], counts: np.ndarray) -> Classes:
    """Classes from the vocabulary table ``words``; what reaches the driver is bounded
    by the number of endings (two bytes) and of slots."""
    own = heavy[: (CLASSES - 1) * (SLOTS - 1)]
    totals = (
        words.where(~F.col("word").isin([bytearray(w) for w in own]) if own else F.lit(True))
        .groupBy(F.substring("word", -2, 2).alias("ending"))
        .agg(F.sum("c").alias("c"), F.count("*").alias("v"))
    )
    rows = sorted((bytes(r.ending), r.c, r.v) for r in totals.collect())
    near = training.select("text").mapInArrow(_neighbours(own), "code long, n long")
    seen = near.groupBy("code").agg(F.sum("n").alias("n")).collect()
    place = {(1 << 16) + 256 + k: k for k in range(len(own))} | {last_of(e): len(own) + k for k, (e, _, _) in enumerate(rows)}
    profile = np.zeros((len(place), NEAR))
    for r in seen:
        if r.code // NEAR in place:
            profile[place[r.code // NEAR], r.code % NEAR] = r.n
    mass = np.array([*counts[: len(own)], *(c for _, c, _ in rows)], float)
    profile /= np.sqrt(np.maximum(profile.sum(axis=0), 1))  # frequent neighbours tell less
    alike = _cluster(profile, mass, CLASSES - 1) if place else np.empty((0, 1))
    total, kinds = np.zeros((CLASSES, SLOTS)), np.zeros((CLASSES, SLOTS))
    slots, room = {}, np.zeros(CLASSES, np.int64)
    for k, word in enumerate(own):
        group = next((int(c) for c in np.argsort(-alike[k], kind="stable") if room[c] < SLOTS - 1), None)
        if group is not None:
            slots[word] = group * SLOTS + int(room[group])
            total[group, room[group]], kinds[group, room[group]] = counts[k], 1
            room[group] += 1
    # With few endings there are fewer classes than slots need: the words left over count as the rest of their ending's class.
    endings = {e: int(g) for (e, _, _), g in zip(rows, np.argmax(alike[len(own) :], axis=1), strict=True)}
    left = [(w[-2:], counts[k], 1) for k, w in enumerate(own) if w not in slots]
    for ending, c, v in [*rows, *left]:
        group = endings.get(ending, CLASSES - 1)
        total[group, -1] += c
        kinds[group, -1] += v
    for group in {*endings.values(), CLASSES - 1}:
        kinds[group, -1] += 1  # one place for all unknown words of a class
    bias = np.full((CLASSES + 1, max(CLASSES, SLOTS)), NEVER)
    met = kinds > 0
    mass = np.where(met, total + 1, 0)
    bias[0, :CLASSES][met.any(axis=1)] = np.log(mass.sum(axis=1)[met.any(axis=1)] / mass.sum())
    bias[1:, :SLOTS][met] = np.log((mass / np.maximum(mass.sum(axis=1, keepdims=True), 1))[met])
    return Classes(slots, endings, np.log10(np.where(met, total + ADD * kinds, 1)).ravel(), bias.astype(np.float32))


def _changes(shared, classes: Classes):
    """Steps over all batches of a shard; its changes of the weights, times the uses of their buckets, and the uses."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, used = shared.value
        w, used = _aligned(weights), used.copy()
        seen = np.zeros(len(w), np.int64)
        place_of = classes.numbers()
        for batch in stream:
            for piece in pieces(batch.column("text")):
                words, number, length = distinct_words(batch.column("text").slice(*piece))
                hashes, last = hashes_of(words)
                found = features(padded(hashes[number], length))[_inside(length) - PAD]
                gradient_steps(w, used, seen, classes.bias, found, place_of(hashes, last)[number])
        w -= weights
        out = np.concatenate([w, used[:, None], np.ones((len(w), 1), np.float32)], 1) * seen.astype(np.float32)[:, None]
        block = np.flatnonzero(seen.reshape(-1, BLOCK).any(axis=1)).astype(np.int32)
        rows = [b.tobytes() for b in out.reshape(-1, BLOCK * out.shape[1])[block]]
        shard = np.full(len(block), TaskContext.get().partitionId(), np.int32)
        yield pa.record_batch({"block": block, "shard": shard, "w": pa.array(rows, pa.binary())})

    return batches


def _added(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(w.as_py(), np.float32).astype(np.float64) for w in rows.column("w")).astype(np.float32)
    return pa.table(
        {"block": rows.column("block").slice(0, 1), "shard": rows.column("shard").slice(0, 1), "w": pa.array([total.tobytes()], pa.binary())}
    )


def train_weights(training: DataFrame, classes: Classes, tokens: int, bits: int = BITS) -> np.ndarray:
    """Rounds of gradient steps over all of ``training`` (text); after each round the changes are averaged by the uses of
    their buckets, ``FAN`` shards at a time."""
    spark, schema = training.sparkSession, "block int, shard int, w binary"
    most = max(1, min(tokens // LEAST_TOKENS, max(SHARDS, tokens // SHARD_TOKENS)))
    shards = training.select("text").coalesce(most)
    weights = np.zeros((2 << bits, classes.bias.shape[1]), np.float32)
    used = np.ones(len(weights), np.float32)
    for _ in range(ROUNDS):
        current = spark.sparkContext.broadcast((weights, used))
        changes, left = shards.mapInArrow(_changes(current, classes), schema), most
        while left > 1:
            changes = changes.withColumn("shard", F.floor(F.col("shard") / FAN).cast("int"))
            changes = changes.groupBy("block", "shard").applyInArrow(_added, schema)
            left = -(-left // FAN)
        weights, used = weights.copy(), used.copy()
        found = changes.select("block", "w").toArrow()
        for block, row in zip(found.column("block").to_pylist(), found.column("w"), strict=True):
            total = np.frombuffer(row.as_py(), np.float32).reshape(BLOCK, -1)
            met, part = total[:, -1] > 0, slice(block * BLOCK, (block + 1) * BLOCK)
            weights[part][met] += total[met, :-2] / total[met, -1:]
            used[part][met] = total[met, -2] / total[met, -1]
        current.destroy()
    return weights


def learn(training: DataFrame, most_bits: int = MOST_BITS) -> tuple[Model, DataFrame]:
    """The model and the vocabulary table (word, c) of ``training`` (text), both from every text of it."""
    training = training.select(F.col("text").cast("string").alias("text"))
    words = kept(vocabulary(training), "vocabulary")
    size = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count("*").alias("words")).first()
    heavy = words.where(F.col("c") * HEAVY >= size.tokens).toArrow()
    found = sorted(zip((-np.asarray(heavy.column("c"))).tolist(), heavy.column("word").to_pylist(), strict=True))
    names, counts = [w for _, w in found], np.array([-c for c, _ in found], np.float64)
    classes = make_classes(words, training, names, counts)
    weights = train_weights(training, classes, size.tokens, bits_for(size.words, most_bits))
    return Model(classes, names, counts, size.tokens, size.words, weights), words


def _score(shared):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        classes, weights = model.classes, _aligned(model.weights)
        heavy, log_counts = pa.array(model.heavy, pa.binary()), np.log10(model.heavy_counts + ADD)
        place_of = classes.numbers()
        cut_at = ((batch, piece) for batch in stream for piece in pieces(batch.column("text")))
        for batch in (batch.slice(*piece) for batch, piece in cut_at):
            words, mine, length = distinct_words(batch.column("text"))
            hashes, last = hashes_of(words)
            own = pc.index_in(words, value_set=heavy)
            log_of = np.full(len(words), np.nan)
            log_of[np.asarray(own.is_valid())] = log_counts[np.asarray(own.drop_null())]
            found, place = features(padded(hashes[mine], length))[_inside(length) - PAD], place_of(hashes, last)[mine]
            share = np.empty(len(mine))
            for s in range(0, len(mine), STEP):
                share[s : s + STEP] = token_shares(found[s : s + STEP], place[s : s + STEP], weights, classes.bias)
            share = share / np.log(10) - classes.log_total[place]
            known = log_of[mine]
            rare = np.isnan(known)
            heads = np.cumsum(length) - length
            owner = np.repeat(np.arange(len(length)), length)
            pair, tf = np.unique(owner[rare] * len(words) + mine[rare], return_counts=True)
            cut = np.searchsorted(pair // len(words), np.arange(len(length) + 1)).astype(np.int32)
            rest = {c: batch.column(c) for c in batch.schema.names if c != "text"}
            yield pa.record_batch(
                rest
                | {
                    "n_tokens": pa.array(length),
                    "heavy": pa.array(np.add.reduceat(~rare, heads, dtype=np.int64)),
                    "counted": pa.array(np.add.reduceat(np.where(rare, 0, known), heads)),
                    "classed": pa.array(np.add.reduceat(share, heads)),
                    "rare": pa.ListArray.from_arrays(cut, words.take(pa.array(pair % len(words)))),
                    "tf": pa.ListArray.from_arrays(cut, pa.array(tf, pa.int64())),
                }
            )

    return batches


def score(documents: DataFrame, training: Column, most_bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) and ``held_out`` for every row of ``documents``
    (doc_id, text).

    ``training`` is a condition on doc_id; the model learns from all rows where it holds. ``base_score`` is the log10 probability
    under add-0.1 word counts, ``score`` that of the class model; both of the whole
    text and its end, which alone makes up a null or empty text. ``n_known``
    counts tokens that occur in training. A row without doc_id is scored but not learned from. Without training
    rows both scores are those of a single class. An empty table gives no rows. A repeated row is scored, and learned from, once
    for each time it stands there. Other columns of ``documents`` are not read. The model keeps to ``2^most_bits`` buckets a softmax.
    """
    rows = documents.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(training, F.lit(False)).alias("train"),
        F.col("text").cast("string").alias("text"),
    )
    model, words = learn(rows.where("train").select("text"), most_bits)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = (
        "rid long, doc_id long, train boolean, n_tokens long, heavy long, counted double, classed double, "
        "rare array<binary>, tf array<long>"
    )
    scored = kept(rows.mapInArrow(_score(shared), schema), "lm-texts")
    rare = scored.select("rid", F.explode(F.arrays_zip("rare", "tf")).alias("e")).select(
        "rid", F.col("e.rare").alias("word"), F.col("e.tf").alias("tf")
    )
    c = F.coalesce("c", F.lit(0))
    met = rare.join(words, "word", "left").groupBy("rid").agg(
        F.sum(F.col("tf") * F.log10(c + ADD)).alias("rare_counted"),
        F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("rare_known"),
    )
    counted = F.col("counted") + F.coalesce("rare_counted", F.lit(0.0))
    total = float(np.log10(model.tokens + ADD * (model.words + 1)))
    return (
        scored.drop("rare", "tf")
        .join(met, "rid", "left")
        .select(
            "doc_id",
            (~F.col("train")).alias("held_out"),
            "n_tokens",
            (F.col("heavy") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(model.tokens).cast("long").alias("train_tokens"),
            (counted - F.col("n_tokens") * total).alias("base_score"),
            (F.col("classed") + counted).alias("score"),
        )
    )
