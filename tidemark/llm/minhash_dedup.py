"""Near-duplicate documents by MinHash.

Method: every distinct shingle set gets ``bands * rows`` universal hash minima.
Sets that agree in all rows of a band share a bucket. Signatures of sets in one
bucket are compared, what could reach the threshold is confirmed on the full
sets, and the confirmed links become components by alternating large-star and
small-star steps.

Work is done on distinct sets, so copies cost one row each. In a bucket every
set is first compared with the bucket's first set only (a star, not all
pairs). After the components of those links are known, only buckets that still
hold several components are looked at again: signatures of different components
are compared, and the sets that agree form groups, in which sets of different
components are compared in full. Both write one row a set, or a link that joins two components, never all pairs;
a bucket or group beyond ``block`` rows is cut into blocks that meet two by two in
separate tasks. No pair of a bucket is left out unless its sets are in one component already.

With 48 bands of 6 rows a pair at exactly 0.8 is missed with probability 5e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import GOLDEN, kept, mapped, mix64
from tidemark.llm.graph import components, merged

BANDS, ROWS = 48, 6
#: Signature agreement below which a pair at the threshold is a 5-sigma event (288 minima).
SLACK = 0.12
BLOCK = 2048
#: Shingles of the sets that one block holds.
BLOCK_SHINGLES = 500_000
CACHED_WORDS = 300_000
CHUNK = 1 << 16


class WordHashes(dict):
    """64-bit hash of each word, computed once; emptied when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of a whole text.

    A-Z are lower-cased; words part at the six ASCII white-space characters.
    Fewer words make one shingle; no words, or null, make none.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(size, len(ids))
    count = len(ids) - width + 1
    hashed = np.full(count, width, np.uint64)
    for k in range(width):
        hashed = mix64(hashed * GOLDEN + ids[k : k + count])
    return np.unique(hashed)


def _family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, n, dtype=np.uint64)


def minima(sets: list[np.ndarray], n: int, seed: int = 7) -> np.ndarray:
    """(set, hash) minima of ``a * x + b`` modulo 2^64; all sets are non-empty."""
    a, b = _family(n, seed)
    out = np.empty((len(sets), n), np.uint64)
    start = 0
    while start < len(sets):
        stop, total = start + 1, len(sets[start])
        while stop < len(sets) and total + len(sets[stop]) <= CHUNK:
            total += len(sets[stop])
            stop += 1
        x = np.concatenate(sets[start:stop])
        heads = np.cumsum([0] + [len(s) for s in sets[start : stop - 1]])
        h = np.empty_like(x)
        for k in range(n):
            np.multiply(x, a[k], out=h)
            np.add(h, b[k], out=h)
            out[start:stop, k] = np.minimum.reduceat(h, heads)
        start = stop
    return out


def _sketch(size: int, bands: int, rows: int):
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, size) for t in batch.column("text").to_pylist()]
        full = [i for i, s in enumerate(sets) if len(s)]
        node: list[bytes | None] = [None] * len(sets)
        sig: list[bytes | None] = [None] * len(sets)
        keys: list[np.ndarray | None] = [None] * len(sets)
        if full:
            m = minima([sets[i] for i in full], bands * rows)
            band = np.zeros((len(full), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
            for r in range(rows):
                band = mix64(band * GOLDEN + m[:, r::rows])
            band = band.view(np.int64)
            byte = ((m * GOLDEN) >> np.uint64(56)).astype(np.uint8)
            for k, i in enumerate(full):
                node[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                sig[i] = byte[k].tobytes()
                keys[i] = band[k]
        return pa.record_batch(
            {
                "rid": batch.column("rid"),
                "doc_id": batch.column("doc_id"),
                "text_hash": batch.column("text_hash"),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "node": pa.array(node, pa.binary()),
                "sig": pa.array(sig, pa.binary()),
                "keys": pa.array(keys, pa.list_(pa.int64())),
            }
        )

    return one


def _agreement(size_byte: int = 256):
    """Share of equal minima, corrected for bytes that agree by chance."""
    chance = 1 / size_byte

    def of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a == b).mean(axis=-1) - chance) / (1 - chance)

    return of


def _signatures(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(x, np.uint8) for x in column.to_pylist()])


def _check_signatures(threshold: float):
    agreement = _agreement()

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        est = agreement(_signatures(batch.column("sig")), _signatures(batch.column("sig_b")))
        out = pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "est": pa.array(est, pa.float64())})
        return out.filter(pa.array(est >= threshold - SLACK))

    return one


def _others(comp: np.ndarray) -> np.ndarray:
    """Rows outside the largest component, whose rows need no comparison among themselves."""
    names, count = np.unique(comp, return_counts=True)
    return np.flatnonzero(comp != names[np.argmax(count)])


def _united(root: np.ndarray, rows: np.ndarray) -> None:
    """Give all groups that ``rows`` belong to the smallest number among them."""
    roots = np.unique(root[rows])
    if len(roots) > 1:
        root[np.isin(root, roots)] = roots[0]


def _near_misses(threshold: float, percent: int):
    """Sets of a bucket whose signatures agree with those of another component, and
    for each the first set of the group that such agreements hold together.

    One row a set, however many agreements it has.
    """
    agreement = _agreement()

    def group(rows: pa.Table) -> pa.RecordBatch | None:
        nid, comp, n, blk = (np.asarray(rows.column(c)) for c in ("nid", "comp", "n", "blk"))
        same = rows.column("i")[0] == rows.column("j")[0]
        sig = _signatures(rows.column("sig"))
        root, found = np.arange(len(nid)), np.zeros(len(nid), bool)
        for x in _others(comp):
            fits = (comp != comp[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
            y = np.flatnonzero(fits if same else fits & (blk != blk[x]))
            y = y[agreement(sig[y], sig[x]) >= threshold - SLACK]
            if len(y):
                both = np.append(y, x)
                found[both] = True
                _united(root, both)
        at = np.flatnonzero(found)
        return pa.record_batch({"a": nid[at], "b": nid[root[at]]}) if len(at) else None

    return _by_group(group)


def _links_between(percent: int):
    """Confirmed links between different components of a group, as many as hold these
    together. Sets are compared in full."""

    def group(rows: pa.Table) -> pa.RecordBatch | None:
        nid, comp, n, blk = (np.asarray(rows.column(c)) for c in ("nid", "comp", "n", "blk"))
        same = rows.column("i")[0] == rows.column("j")[0]
        others = _others(comp)
        if not len(others):
            return None
        sets = [np.frombuffer(s, np.int64) for s in rows.column("set").to_pylist()]
        heads = np.cumsum([0] + [len(s) for s in sets])
        values, flat = np.unique(np.concatenate(sets), return_inverse=True)
        _, root = np.unique(comp, return_inverse=True)
        in_x = np.zeros(len(values), bool)
        found = []
        for x in others:
            fits = (root != root[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
            if not same:
                fits &= blk != blk[x]
            if not fits.any():
                continue
            own = flat[heads[x] : heads[x + 1]]
            in_x[own] = True
            common = np.add.reduceat(in_x[flat], heads[:-1], dtype=np.int64)
            in_x[own] = False
            y = np.flatnonzero(fits & (100 * common >= percent * (n + n[x] - common)))
            if len(y):
                _, first = np.unique(root[y], return_index=True)
                found += [(nid[k], nid[x]) for k in y[first]]
                _united(root, np.append(y[first], x))
        if not found:
            return None
        return pa.record_batch({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return _by_group(group)


def _by_group(work):
    """``work`` on each (g, i, j) group of sorted rows, which may span batches."""

    def groups(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None
        for batch in stream:
            key = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("g", "i", "j")], 1)
            heads = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *heads], [*heads, len(key)], strict=True):
                if start == stop:
                    continue
                if at != tuple(key[start]) and held:
                    out = work(pa.Table.from_batches(held))
                    if out is not None:
                        yield out
                    held = []
                at = tuple(key[start])
                held.append(batch.slice(start, stop - start))
        if held:
            out = work(pa.Table.from_batches(held))
            if out is not None:
                yield out

    return groups


def _in_blocks(rows: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Rows sorted by (g, i, j): each group cut into ``blocks`` blocks, every two of which meet."""
    rows = (
        rows.withColumnRenamed(group, "g")
        .withColumn("blk", F.pmod(F.xxhash64("nid"), blocks).cast("int"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("blk", "o"))
        .withColumn("j", F.greatest("blk", "o"))
    )
    return rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")


def _sets(size: int):
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, size) for t in batch.column("text").to_pylist()]
        same = [
            hashlib.blake2b(s.tobytes(), digest_size=16).digest() == node
            for s, node in zip(sets, batch.column("node").to_pylist(), strict=True)
        ]
        out = pa.record_batch(
            {"nid": batch.column("nid"), "set": pa.array([s.view(np.int64).tobytes() for s in sets], pa.binary())}
        )
        return out.filter(pa.array(same))

    return one


def _confirm(percent: int):
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        for x, y in zip(batch.column("set").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
            p, q = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
            common = len(np.intersect1d(p, q, assume_unique=True))
            ok.append(100 * common >= percent * (len(p) + len(q) - common))
        return pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(ok, pa.bool_()))

    return one


def sets_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(nid, set) for the nodes of ``wanted`` (nid), made again from their texts.

    A node is found by the document it came from and then by its set, so ids that
    occur twice do no harm.
    """
    source = nodes.join(wanted.distinct(), "nid").select("nid", "node", "rep")
    texts = docs.where("doc_id is not null").join(source, F.col("doc_id") == F.col("rep"))
    sets = mapped(texts.select("nid", "node", "text"), _sets(size), "nid long, set binary")
    return kept(sets.dropDuplicates(["nid"]), "shingle-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    both = pairs.join(sets.withColumnRenamed("nid", "a"), "a").join(
        sets.select(F.col("nid").alias("b"), F.col("set").alias("set_b")), "b"
    )
    return kept(mapped(both.select("a", "b", "set", "set_b"), _confirm(percent), "a long, b long"), "confirmed")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("nid")).unionByName(pairs.select(F.col("b").alias("nid")))


def near_duplicates(
    documents: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) for every row of ``documents`` (doc_id, text).

    Two documents are linked when 100 * |A and B| >= percent * |A or B| for their
    shingle sets. Null or wordless texts have an empty set and link with nothing:
    component_id is their own id. A row without doc_id takes no part; its
    component_id is null and kept is false. Rows that repeat a doc_id are linked by
    their own texts; each is kept if its doc_id is its component's smallest. ``text_hash`` tells
    such rows apart. Other columns are not read. An empty table gives no rows.
    """
    threshold = percent / 100
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = kept(
        mapped(
            docs.select(
                F.monotonically_increasing_id().alias("rid"), "doc_id", F.xxhash64("text").alias("text_hash"), "text"
            ),
            _sketch(shingle, bands, rows),
            "rid long, doc_id long, text_hash long, n_shingles long, node binary, sig binary, keys array<long>",
        ),
        "sketches",
    )
    full = sketch.where("node is not null and doc_id is not null")
    classes = full.groupBy("node").agg(F.min("rid").alias("nid"), F.min("doc_id").alias("rep"))
    nodes = kept(classes, "classes")
    features = kept(
        full.select("rid", "n_shingles", "sig", "keys").join(nodes.select("nid"), F.col("rid") == F.col("nid"))
        .select("nid", F.col("n_shingles").alias("n"), "sig", "keys"),
        "features",
    )
    member = features.select("nid", F.explode("keys").alias("key"))
    buckets = member.groupBy("key").agg(F.min("nid").alias("pivot"), F.count("*").alias("rows")).where("rows > 1")
    member = kept(member.join(buckets, "key"), "buckets")

    # A star per bucket; of a node's pivots the one whose signature agrees best is confirmed first.
    side = features.select("nid", "n", "sig")
    star = member.where("nid <> pivot").select(F.col("nid").alias("a"), F.col("pivot").alias("b")).distinct()
    star = (
        star.join(side.withColumnRenamed("nid", "a"), "a")
        .join(side.select(F.col("nid").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b")), "b")
        .where(F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * percent)
    )
    star = mapped(star.select("a", "b", "sig", "sig_b"), _check_signatures(threshold), "a long, b long, est double")
    first = kept(star.groupBy("a").agg(F.max_by("b", F.struct("est", "b")).alias("b")), "star-pairs")
    sets = sets_of(_ends(first), nodes, docs, shingle)
    found = kept(components(confirmed(first, sets, percent)), "components")

    # Buckets that still hold several components: sets that agree across components there
    # form groups, in which the components are compared in full.
    named = member.join(found, "nid", "left").select("key", "rows", "nid", F.coalesce("comp", "nid").alias("comp"))
    open_keys = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    left = named.join(open_keys.select("key"), "key").join(side, "nid")
    left = _in_blocks(left, "key", F.ceil(F.col("rows") / F.lit(block)).cast("int"))
    left = left.select("g", "i", "j", "blk", "nid", "comp", "n", "sig")
    misses = kept(left.mapInArrow(_near_misses(threshold, percent), "a long, b long").distinct(), "near-misses")
    if not misses.where("a <> b").isEmpty():
        grouped = kept(
            components(misses).withColumnRenamed("comp", "cluster")
            .join(found, "nid", "left")
            .select("nid", "cluster", F.coalesce("comp", "nid").alias("comp")),
            "clusters",
        )
        sets = sets_of(grouped.select("nid"), nodes, docs, shingle)
        held = grouped.join(sets, "nid").withColumn("n", F.length("set") / 8)
        size = grouped.join(features.select("nid", "n"), "nid").groupBy("cluster").agg(
            F.count("*").alias("rows"), F.sum("n").alias("shingles")
        )
        cut = F.greatest(F.ceil(F.col("rows") / F.lit(block)), F.ceil(F.col("shingles") / F.lit(BLOCK_SHINGLES))).cast("int")
        size = size.select(F.col("cluster").alias("of"), cut.alias("blocks"))
        held = held.join(size, F.col("cluster") == F.col("of"))
        held = _in_blocks(held, "cluster", F.col("blocks")).select("g", "i", "j", "blk", "nid", "comp", F.col("n").cast("long").alias("n"), "set")
        more = kept(held.mapInArrow(_links_between(percent), "a long, b long").distinct(), "more-links")
        if not more.isEmpty():
            found = kept(merged(found, more), "components")

    named = nodes.join(found, "nid", "left").select("node", "rep", F.coalesce("comp", "nid").alias("comp"))
    label = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    label = named.join(label, "comp").select("node", "component_id")
    return (
        sketch.select("doc_id", "n_shingles", "node", "text_hash")
        .join(label, "node", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
        .select("doc_id", "n_shingles", "component_id", "kept", "text_hash")
    )


def deduplicated(documents: DataFrame, **options) -> DataFrame:
    """One row of ``documents`` for each group of near-duplicates, with all its columns.

    Rows that repeat an id and text leave one; rows without doc_id all stay.
    """
    stays = near_duplicates(documents, **options).where("kept").select("doc_id", "text_hash").distinct()
    stays = stays.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    rows = documents.withColumn("__h", F.xxhash64(F.col("text").cast("string")))
    same = (F.col("doc_id").cast("long") == F.col("__id")) & (F.col("__h") == F.col("__hash"))
    chosen = rows.join(stays, same, "left_semi").dropDuplicates(["doc_id", "__h"])
    return chosen.unionByName(rows.where("doc_id is null")).drop("__h")
