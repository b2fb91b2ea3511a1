"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, and what differs between two texts.

Method: a text is cut into short paragraphs, at line ends and punctuation; each distinct one gives a 60-bit digest of its md5. A
sketch has three parts of ``size`` cells; a digest is added to one cell of each part: to a count, to an exclusive-or
of digests and to one of their checks. Sketches of one size are subtracted cell by cell, so what two versions
share is gone, whatever their length. A cell with a count of 1 or -1 whose check fits holds one digest alone: it is recovered and taken
out of its two other cells, which may free others (peeling). Each step peels the cells of one part only, so no digest
is recovered twice. If cells are left, the sketches are made again, larger and with other places.

All of it is aggregation: cells are rows, (text, cell) is the key, and subtraction and removal are sums and
exclusive-ors. Rows stay in the tasks that the join of a text with its next one has put them in, so neither sketches nor peeling
are shuffled. Only DataFrame functions; no Python code in the tasks.

Repeated paragraphs of one text count once. Two texts agree by ``likeness``: the share of the paragraphs of both that the
other has, ``1 - d / (a + b)`` for ``d`` recovered digests; 1 for two texts without any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept
from tidemark.session import work_folder

#: A paragraph: as little as ends with punctuation or a line, or the rest of the text.
PARAGRAPH = r"(?s).+?(?:[.!?,;\n]|\z)"
PARTS = 3
#: Cells of a part of the fingerprint; of a part of the first sketch of a pair, at least.
BASE, LEAST = 8, 64
#: Cells of a part for each digest of both texts, in the first sketch of a pair.
ROOM = 2
#: How often every part is peeled before a sketch counts as failed.
CYCLES = 4
MOST_TRIES = 20
#: What a row of cells belongs to.
OWN, EDITED, TO_EDITED, TO_NEXT, PRESENT = 0, 1, 2, 3, -1
KEY = ["nul", "i", "h"]
_CELL = ["kind", "size", "cell"]
#: Characters of text whose cells a task holds at once: a table of cells takes about 25 times as much memory, and some four of them are
#: alive in a task. Beyond so many parts they grow, and tasks spill.
TASK_CHARS, MOST_PARTS = 2 << 20, 100_000
#: What the rows of kind PRESENT hold beside the cells of a text, by number: two values each.
FACTS = (("copies", "n_chars"), ("total_edited", "total_next"), ("n_own", "n_edited"), ("sha0", "sha1"), ("sha2", "sha3"))


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of a text."""
    one = lambda p: F.conv(F.substring(F.md5(F.encode(p, "UTF-8")), 1, 15), 16, 10).cast("bigint")
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), one))


def check_of(digest: Column) -> Column:
    """32 bits that only a single digest has right."""
    return F.conv(F.substring(F.md5(F.encode(digest.cast("string"), "UTF-8")), 1, 8), 16, 10).cast("bigint")


def place(digest: Column, part: int, size: Column, seed: int | None) -> Column:
    """The cell of a digest in a part of ``size`` (a power of two) cells. Without a seed it is cut from the digest itself."""
    bits = F.shiftright(digest, 20 * part) if seed is None else F.xxhash64(digest, F.lit(seed), F.lit(part))
    return F.lit(part) * size + bits.bitwiseAND(size - 1)


def keyed(documents: DataFrame) -> DataFrame:
    """KEY, text and n_chars of rows (doc_id, text). Rows with one id and one text have one key; null ids come last in its order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(
        F.col("doc_id").isNull().alias("nul"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("i"),
        F.xxhash64(text).alias("h"),
        text.alias("text"),
    )


def following(docs: DataFrame) -> DataFrame:
    """KEY, n_chars, and ``after``: the key of the next text in ascending order, of the first one after the last.

    Ids are dealt into ranges by a sample of them; inside a range a window finds the next one, and the last row of a
    range is followed by the first of the next range. Only keys move."""
    ids = kept(docs.groupBy(*KEY).agg(F.max(F.char_length("text")).alias("n_chars")), "text-keys")
    dealt = kept(ids.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()), "ordered-keys")
    me = F.struct(*KEY)
    # One row a range: as many as there are partitions.
    firsts = dealt.groupBy("part").agg(F.min(me).alias("first"))
    whole = Window.orderBy("part")
    beyond = firsts.select(
        "part",
        F.coalesce(
            F.lead("first").over(whole),
            F.min("first").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("beyond"),
    )
    after = F.coalesce(F.lead(me).over(Window.partitionBy("part").orderBy(*KEY)), F.col("beyond"))
    return dealt.join(beyond, "part").select(*KEY, "n_chars", after.alias("after"))


def with_next(docs: DataFrame, order: DataFrame) -> DataFrame:
    """For each key of ``order``: KEY, copies, n_chars, sha, the digests ``own`` of its text, ``edited`` of its edited text and ``next`` of the next one.

    The edited text has its last quarter of code points replaced by the first ones of the next text. Texts are shuffled once, by key; of a text, its predecessor gets the head
    it needs and the digests. The number of parts follows from the characters, for what is made of them is many times their size."""
    chars = order.agg(F.coalesce(F.sum(F.col("n_chars").cast("long")), F.lit(0))).first()[0]
    docs = docs.repartition(min(max(1, -(-chars // TASK_CHARS)), MOST_PARTS), *KEY)
    wanted = order.select(
        *[F.col(f"after.{c}").alias(c) for c in KEY],
        F.struct(*KEY).alias("before"),
        F.floor(F.col("n_chars") / 4).cast("int").alias("need"),
    )
    heads = (
        docs.join(wanted, KEY)
        .groupBy(*KEY)  # repeated rows
        .agg(F.any_value("before").alias("before"), F.any_value("need").alias("need"), F.any_value("text").alias("text"))
        .select(
            *[F.col(f"before.{c}").alias(c) for c in KEY],
            F.col("need"),
            F.left("text", F.col("need")).alias("head"),
            digests(F.col("text")).alias("next"),
        )
    )
    met = (
        docs.join(heads, KEY)
        .groupBy(*KEY)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.any_value("text").alias("text"),
            F.any_value("need").alias("need"),
            F.any_value("head").alias("head"),
            F.any_value("next").alias("next"),
        )
        .withColumn("n_chars", F.char_length("text"))
        .withColumn("new", F.concat(F.left("text", F.col("n_chars") - F.col("need")), "head"))
    )
    return met.select(
        *KEY,
        "copies",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.encode("new", "UTF-8"), 256).alias("sha"),
        digests(F.col("text")).alias("own"),
        digests(F.col("new")).alias("edited"),
        "next",
    )


def _cells(texts: DataFrame, attempt: int) -> DataFrame:
    """KEY, _CELL and sums n, digest, check of all cells that are not empty: the sketches of the text and of the edited
    text, those of both pairs, subtracted, and the FACTS of the text."""

    def room(total: Column) -> Column:
        bits = F.ceil(F.log2(F.greatest(total * ROOM, F.lit(LEAST)))).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), bits) * (1 << attempt)

    def count(*sides: str) -> Column:
        return sum((F.size(s) for s in sides), F.lit(0)).cast("long")

    of_hash = [F.conv(F.substring("sha", 1 + 16 * k, 16), 16, -10).cast("bigint").alias(f"sha{k}") for k in range(4)]
    facts = texts.select(
        *KEY, "own", "edited", "next", "copies", "n_chars", *of_hash,
        count("own").alias("n_own"), count("edited").alias("n_edited"),
        count("own", "edited").alias("total_edited"), count("own", "next").alias("total_next"),
    )

    def tagged(side: str) -> Column:
        zero = F.lit(0).cast("long")
        return F.transform(side, lambda d: F.struct(F.lit(side).alias("tag"), zero.alias("no"), d.alias("n"), d.alias("digest")))

    def fact(number: int) -> Column:
        first, second = FACTS[number]
        return F.struct(F.lit("fact").alias("tag"), F.lit(-1 - number).cast("long").alias("no"), F.col(first).alias("n"), F.col(second).alias("digest"))

    entries = F.concat(tagged("own"), tagged("edited"), tagged("next"), F.array(*[fact(k) for k in range(len(FACTS))]))
    each = facts.select(*KEY, "total_edited", "total_next", F.explode(entries).alias("e")).select(
        *KEY, "e.*", room(F.col("total_edited")).alias("s_edited"), room(F.col("total_next")).alias("s_next")
    )
    each = each.withColumn("check", F.when(F.col("tag") == "fact", F.lit(0).cast("long")).otherwise(check_of(F.col("digest"))))

    def row(kind: int, size: Column, cell: Column, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), size.alias("size"), cell.alias("cell"), n.cast("long").alias("n"))

    def cells(kind: int, size: Column, sign: int, seed: int | None) -> list[Column]:
        return [row(kind, size, place(F.col("digest"), part, size, seed), F.lit(sign)) for part in range(PARTS)]

    base, s_edited, s_next = F.lit(BASE).cast("long"), F.col("s_edited"), F.col("s_next")
    added = (
        F.when(
            F.col("tag") == "own",
            F.array(*cells(OWN, base, 1, None), *cells(TO_EDITED, s_edited, 1, attempt), *cells(TO_NEXT, s_next, 1, attempt)),
        )
        .when(F.col("tag") == "edited", F.array(*cells(EDITED, base, 1, None), *cells(TO_EDITED, s_edited, -1, attempt)))
        .when(F.col("tag") == "next", F.array(*cells(TO_NEXT, s_next, -1, attempt)))
        .otherwise(F.array(row(PRESENT, base, F.col("no"), F.col("n"))))
    )
    return _summed(each.select(*KEY, "digest", "check", F.explode(added).alias("c")).select(*KEY, "c.*", "digest", "check"))


def _summed(cells: DataFrame) -> DataFrame:
    sums = cells.groupBy(*KEY, *_CELL).agg(
        F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check")
    )
    return sums.where("n <> 0 or digest <> 0 or check <> 0")


def peeled(cells: DataFrame, attempt: int, cycles: int = CYCLES) -> DataFrame:
    """``cells`` of pairs with what single cells hold recovered: a recovered digest is a row with a negative ``cell``, ``n`` 1
    if only the text has it and -1 if only the other has."""
    for step in range(PARTS * cycles):
        part = step % PARTS
        # The check is worked out for single cells of this part only.
        single = F.when(
            (F.col("kind") >= TO_EDITED) & (F.col("cell") >= F.col("size") * part) & (F.col("cell") < F.col("size") * (part + 1))
            & (F.abs("n") == 1),
            F.col("check") == check_of(F.col("digest")),
        ).otherwise(False)
        row = lambda cell, n: F.struct(cell.alias("cell"), n.alias("n"), "digest", "check")
        gone = [
            row(place(F.col("digest"), p, F.col("size"), attempt), -F.col("n")) for p in range(PARTS) if p != part
        ]
        out = F.when(single, F.array(row(-1 - F.col("digest"), F.col("n")), *gone)).otherwise(
            F.array(row(F.col("cell"), F.col("n")))
        )
        cells = _summed(cells.select(*KEY, "kind", "size", F.explode(out).alias("r")).select(*KEY, "kind", "size", "r.*"))
    return cells


def _fact(name: str) -> Column:
    number = next(k for k, names in enumerate(FACTS) if name in names)
    value = "digest" if FACTS[number].index(name) else "n"
    mine = (F.col("kind") == PRESENT) & (F.col("cell") == -1 - number)
    return F.coalesce(F.max(F.when(mine, F.col(value))), F.lit(0).cast("long"))


def _written(kind: int, count: str) -> Column:
    """A sketch as text: number of digests, then cell, count, digests and checks of each cell that is not empty."""
    rows = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("cell", "n", "digest", "check"))))
    cells = F.transform(rows, lambda c: F.concat_ws(":", c["cell"], c["n"], c["digest"], c["check"]))
    return F.concat(_fact(count).cast("string"), F.lit("|"), F.array_join(cells, ","))


def _tried(docs: DataFrame, order: DataFrame, attempt: int) -> DataFrame:
    """One row a key: fingerprints, and for both pairs the digests of both, the recovered ones, and the cells that are left."""
    cells = peeled(_cells(with_next(docs, order), attempt), attempt)

    def of(kind: int, name: str) -> list[Column]:
        mine, found = F.col("kind") == kind, F.col("cell") < 0
        lost = lambda n: F.array_sort(F.collect_list(F.when(mine & found & (F.col("n") == n), F.col("digest"))))
        return [
            _fact(f"total_{name}").alias(f"total_{name}"),
            F.count_if(mine & found).alias(f"differ_{name}"),
            F.count_if(mine & ~found).alias(f"left_{name}"),
            lost(1).alias(f"without_{name}"),
            lost(-1).alias(f"only_{name}"),
        ]

    # Whole numbers of the hash, back to its hexadecimal digits.
    sha = F.concat(*[F.lpad(F.hex(_fact(f"sha{k}")), 16, "0") for k in range(4)])
    return cells.groupBy(*KEY).agg(
        _fact("copies").alias("copies"),
        _fact("n_chars").alias("n_chars"),
        F.lower(sha).alias("sha"),
        _written(OWN, "n_own").alias("fingerprint"),
        _written(EDITED, "n_edited").alias("edited_fingerprint"),
        *of(TO_EDITED, "edited"),
        *of(TO_NEXT, "next"),
    )


def fingerprints(documents: DataFrame, digest_lists: bool = False) -> DataFrame:
    """One row for each row of ``documents`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text has the last quarter of its code points (rounded down) replaced by as many of the first ones of
    the next document by doc_id (or all it has); the first follows the last. ``near_*`` is the likeness to the edited text and to the next
    one, from the digests recovered out of the subtracted sketches. ``digest_lists`` adds ``without_edited``, ``only_edited`` (the digests
    that only the text and only its edited form have) and ``without_next``, ``only_next``.

    Null texts are empty, with a fingerprint of no cells; rows with a null doc_id come last. Rows with equal ids and different texts follow each other in a fixed order; rows
    that are equal in both count as one document and are answered each. A single document is its own next one. An
    empty table gives no rows. Other columns are not read. A very long text costs in proportion to its length.
    """
    docs = keyed(documents)
    order = kept(following(docs), "next-keys")
    sides = ("edited", "next")
    lists = [f"{kind}_{s}" for s in sides for kind in ("without", "only")] if digest_lists else []
    columns = [*KEY, "copies", "n_chars", "sha", "fingerprint", "edited_fingerprint", *[f"{c}_{s}" for s in sides for c in ("total", "differ", "left")], *lists]
    done, failed = None, F.lit(False)
    for s in sides:
        failed = failed | (F.col(f"left_{s}") > 0)
    todo = order
    for attempt in range(MOST_TRIES):
        # What has failed is few; its texts alone are read again for larger sketches.
        some = docs if attempt == 0 else docs.join(_both_ends(todo), KEY, "left_semi")
        tried = _packed(_tried(some, todo, attempt).select(*columns))
        done = tried.where(~failed) if done is None else done.unionByName(tried.where(~failed))
        left = tried.where(failed).select(*KEY)
        if left.isEmpty():
            break
        todo = kept(order.join(left, KEY, "left_semi"), "failed-keys")
    else:
        raise RuntimeError("sketches could not be peeled")
    like = [
        F.when(F.col(f"total_{s}") == 0, F.lit(1.0))
        .otherwise((F.col(f"total_{s}") - F.col(f"differ_{s}")) / F.col(f"total_{s}"))
        .alias(f"near_{s}")
        for s in sides
    ]
    return done.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        F.when(~F.col("nul"), F.col("i")).alias("doc_id"),
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        *like,
        *lists,
    )


def _packed(df: DataFrame) -> DataFrame:
    """Written and read again; digits of sketches take half the room under zstandard."""
    path = work_folder(df.sparkSession, "fingerprints")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _both_ends(order: DataFrame) -> DataFrame:
    return order.select(*KEY).unionByName(order.select(*[F.col(f"after.{c}").alias(c) for c in KEY]))
