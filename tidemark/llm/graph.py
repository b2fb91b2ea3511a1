"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import kept


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """Edges in files, with their number and the sum of their hashes."""
    state = Observation()
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    out = kept(edges.observe(state, F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("h")), name)
    return out, (state.get["n"], state.get["h"])


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(nid, comp) for every node of ``links`` (a, b): comp is the smallest node
    that can be reached. Alternates large-star and small-star until nothing changes.
    """
    edges, state = _written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        before = state
        edges, state = _written(small, "stars")
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("nid"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("nid"), F.col("v").alias("comp")).unionByName(roots)


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (nid, comp) after more ``links`` (a, b). A node that is not in
    ``found`` was alone. Only the graph of components is worked on."""
    at = lambda c: found.select(F.col("nid").alias(c), F.col("comp").alias(f"of_{c}"))
    between = links.join(at("a"), "a", "left").join(at("b"), "b", "left")
    between = between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    joined = kept(components(between.where("a <> b").distinct()), "joined")
    renamed = found.join(joined.select(F.col("nid").alias("comp"), F.col("comp").alias("new")), "comp", "left")
    alone = joined.join(found.select("nid"), "nid", "left_anti")
    return renamed.select("nid", F.coalesce("new", "comp").alias("comp")).unionByName(alone.select("nid", "comp"))
