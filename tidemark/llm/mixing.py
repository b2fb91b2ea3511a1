"""Mix sources to target weights. DataFrame functions only.

Method: Efraimidis-Spirakis sampling. A document's key is -ln(u) divided by its
quality weight, with u made from its id and text, so reruns agree. Each source
has a word target; complete epochs of the source come first, and what is left
is filled with documents in the order of their keys, by prefix sums.

A source with a third of all rows is never sorted in one task: keys fall into
buckets by a monotone function, bucket sums are added up per source, and only
the one bucket per source in which the target is reached is put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import kept

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
BUCKETS = 4096
SALTS = 64
LEAST_QUALITY = 0.1


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """Share of letters, spaces and line feeds in the text, at least ``LEAST_QUALITY``."""
    clean = F.try_divide(F.length(F.regexp_replace(text, r"[^\p{L}\x20\x0A]+", "")), F.length(text))
    return F.coalesce(F.greatest(clean, F.lit(LEAST_QUALITY)), F.lit(LEAST_QUALITY))


def sampling_key(digest: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from the first 52 bits of a hex digest."""
    bits = F.conv(F.substr(digest, F.lit(1), F.lit(13)), 16, 10).cast("long").cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / weight


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Word target per source of ``sizes`` (source, source_size), one row a source.

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``share`` times all words. A target stops at ``MOST_EPOCHS`` times its
    source; the excess goes to the others by weight until none is above. That
    is one common level: sorted by cap / weight, the first source whose level
    is not above its own ratio sets it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    weighed = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), number)).withColumn(
        "cap", F.lit(MOST_EPOCHS) * F.col("source_size")
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everywhere = Window.partitionBy()
    level = (
        weighed.withColumn("place", F.row_number().over(by_ratio))
        .withColumn("capped", F.sum("cap").over(by_ratio) - F.col("cap"))
        .withColumn("left_w", F.sum("w").over(everywhere) - F.sum("w").over(by_ratio) + F.col("w"))
        .withColumn("budget", F.lit(share) * F.sum("source_size").over(everywhere))
        .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("left_w"))
        .withColumn("fits", F.col("level") * F.col("w") <= F.col("cap"))
        .withColumn("level", F.min_by(F.col("level"), F.when(F.col("fits"), F.col("place"))).over(everywhere))
    )
    return level.select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"),
    )


def _keyed(documents: DataFrame, weight: Column | None) -> DataFrame:
    """``documents`` with ``__source``, ``__size``, ``__digest`` and ``__key``."""
    text = F.col("text").cast("string")
    digest = F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), text).cast("binary"))
    quality_weight = quality(text) if weight is None else weight
    return (
        documents.withColumn("__source", F.col("source").cast("string"))
        .withColumn("__size", word_count(text))
        .withColumn("__digest", digest)
        .withColumn("__key", sampling_key(F.col("__digest"), quality_weight))
    )


def _planned(keyed: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """One row a source: its target, complete epochs, and the key and digest at
    which the rest of its target is reached, with the words still taken there."""
    rows = keyed.select(*[F.col(f"__{c}").alias(c) for c in ("source", "size", "digest", "key")])
    rows = rows.withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * BUCKETS).cast("int"))
    sums = kept(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-sums")
    aims = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share)
    aims = aims.withColumn("epochs", F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).withColumn(
        "rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5).cast("long")
    )
    named = lambda c: F.col("source").eqNullSafe(F.col(c))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    edge = kept(
        sums.withColumn("before", running - F.col("words"))
        .join(aims.select(F.col("source").alias("s"), "rest"), named("s"))
        .where("before < rest and rest <= before + words")
        .select(F.col("source").alias("e"), F.col("bucket").alias("edge"), "before", "rest"),
        "mix-edges",
    )
    # Of the bucket in which the rest is reached, rows alike in id and text count as one group.
    alike = (
        rows.join(edge, named("e") & (F.col("bucket") == F.col("edge")))
        .groupBy("source", "before", "rest", "key", "digest", "size")
        .agg(F.count("*").alias("n"))
        .withColumn("words", F.col("n") * F.col("size"))
    )
    running = F.sum("words").over(Window.partitionBy("source").orderBy("key", "digest"))
    cut = (
        alike.withColumn("ahead", F.col("before") + running - F.col("words"))
        .where("ahead < rest and rest <= ahead + words")
        .select(
            F.col("source").alias("e"),
            F.col("key").alias("cut_key"),
            F.col("digest").alias("cut_digest"),
            F.floor((F.col("rest") - F.col("ahead")) / F.col("n")).alias("cut_words"),
        )
    )
    return kept(aims.drop("rest").join(cut, named("e"), "left").drop("e"), "mix-plan")


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    weight: Column | None = None,
) -> DataFrame:
    """The columns of ``documents`` (doc_id, text, source and any others but the new names) with
    size, source_size, target, taken and copies.

    ``size`` counts words; null texts have none and are never taken. ``taken``
    is the number of words that the mix takes, repeats counted: every complete
    epoch of the source, and once more for the documents with the smallest keys
    until the target is met, the last of them in part. ``copies`` is the same in
    whole documents: the last one counts if at least half of it was taken.
    ``weight`` is a positive quality weight over the input's columns. A null
    source is a source of its own; rows alike in id and text are treated alike; of
    columns with a new name the new one stays. An empty table gives no rows.
    """
    new = ["size", "source_size", "target", "taken", "copies"]
    keyed = _keyed(documents, weight)
    plan = _planned(kept(keyed.select("__source", "__size", "__digest", "__key"), "mix-keys"), weights, share)
    plan = plan.select(*[F.col(c).alias(f"__p_{c}") for c in plan.columns])
    plan = plan.withColumn("__p_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    size, cut = F.col("__size"), F.col("__p_cut_key")
    at_cut = (F.col("__key") == cut) & (F.col("__digest") == F.col("__p_cut_digest"))
    before = (F.col("__key") < cut) | ((F.col("__key") == cut) & (F.col("__digest") < F.col("__p_cut_digest")))
    extra = F.when(cut.isNull(), 0).when(at_cut, F.col("__p_cut_words")).when(before, size).otherwise(0)
    rows = keyed.drop(*new).withColumn("__salt", F.pmod(F.xxhash64("__digest"), F.lit(SALTS)).cast("int"))
    rows = rows.join(plan, F.col("__source").eqNullSafe(F.col("__p_source")) & (F.col("__salt") == F.col("__p_salt")))
    rows = rows.withColumn("__extra", extra.cast("long"))
    half = (2 * F.col("__extra") >= size).cast("int")
    return rows.select(
        *[c for c in documents.columns if c not in new],
        size.alias("size"),
        F.col("__p_source_size").alias("source_size"),
        F.col("__p_target").alias("target"),
        (F.col("__p_epochs") * size + F.col("__extra")).cast("long").alias("taken"),
        F.when(size > 0, F.col("__p_epochs") + half).otherwise(0).cast("int").alias("copies"),
    )
