"""URL rules by hashed host-suffix and path-prefix expressions. DataFrame functions only.

Method: every URL is expanded into host suffixes times path prefixes that end
in a slash. The first 32 bits of an expression's SHA-256 are joined by equality
with those of the rules; a hit is confirmed by the full digest of the rule's
host and whole path, and the rule of highest precedence decides.

A URL never gives more expressions than the rules' deepest host and path call
for, so a URL of many thousand dots and slashes stays small. A rule path that
does not end in a slash is looked up by its part up to the last slash and
confirmed in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased. Path: from there up to ``?``, ``#`` or the end. Both are empty
    for null and where ``://`` is missing."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ranked(rules: DataFrame) -> DataFrame:
    """Rules with lookup hash, digest and precedence: the length of host and path
    together, then that of the host, then block before allow, as one integer.
    Two rules that fit one URL never share both lengths, so no numbering of all
    rules is needed. Rules with a null, or another verdict, are left out; of
    equal rules one stays."""
    host = F.translate(F.col("host").cast("string"), UPPER, LOWER)
    listed = (
        rules.select(host.alias("r_host"), F.col("path").cast("string").alias("r_path"), "verdict")
        .where("r_host is not null and r_path is not null and verdict in ('allow', 'block')")
        .groupBy("r_host", "r_path")
        .agg(F.max("verdict").alias("verdict"))
    )
    stem = F.regexp_extract("r_path", r"(?s)^.*/", 0)
    both = (F.length("r_host") + F.length("r_path")).cast("long")
    return listed.select(
        F.substr(F.sha2(F.concat("r_host", stem), 256), F.lit(1), F.lit(PREFIX_HEX)).alias("prefix"),
        F.sha2(F.concat("r_host", "r_path"), 256).alias("digest"),
        F.size(F.split("r_host", r"\.")).alias("labels"),
        (F.size(F.split(stem, "/")) - 1).alias("depth"),
        F.length("r_path").alias("length"),
        (both * 2**32 + F.length("r_host").cast("long") * 2 + (F.col("verdict") == "block").cast("long")).alias("precedence"),
    )


def decided(precedence: Column, host: Column, path: Column) -> tuple[Column, Column]:
    """Rule and verdict that a precedence stands for, on a URL that the rule fits; null without one."""
    both = F.shiftright(precedence, 32).cast("int")
    of_host = F.shiftright(precedence.bitwiseAND(F.lit(2**32 - 1)), 1).cast("int")
    rule = F.concat(F.substr(host, F.length(host) - of_host + 1), F.substr(path, F.lit(1), both - of_host))
    verdict = F.when(precedence.isNotNull(), F.when(precedence % 2 == 1, "block").otherwise("allow"))
    return F.when(precedence.isNotNull(), rule), verdict


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    ``rules`` has (host, path, verdict). A rule fits its host and all subdomains
    if the URL's path starts with the rule's. Without a fitting rule, ``rule`` is
    null and the verdict is ``default``. Repeated rows are judged one by one;
    other columns are not read; no rules, or no pages, are valid inputs.
    """
    listed = ranked(rules)
    deepest = listed.agg(F.max("labels").alias("labels"), F.max("depth").alias("depth")).first()
    most_labels, most_depth = deepest.labels or 1, deepest.depth or 0
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"), path.alias("path"))
    # Parts from the right and from the left, no more of them than a rule can have.
    labels = F.reverse(F.slice(F.reverse(F.split("host", r"\.")), 1, most_labels))
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."),
    )
    parts = F.slice(F.split("path", "/"), 1, most_depth + 1)
    stems = F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, F.lit(1), k), "/"), F.lit("/"))),
    )
    looked_up = (
        rows.withColumn("suffix", F.explode(suffixes))
        .withColumn("stem", F.explode(stems))
        .withColumn("looked", F.substr(F.sha2(F.concat("suffix", "stem"), 256), F.lit(1), F.lit(PREFIX_HEX)))
    )
    known = listed.select("prefix", "digest", "length", "precedence")
    start = F.sha2(F.concat("suffix", F.substr("path", F.lit(1), F.col("length"))), 256)
    hits = looked_up.join(known, (F.col("looked") == F.col("prefix")) & (start == F.col("digest")), "left")
    best = hits.groupBy("row", "page_id", "host", "path").agg(F.max("precedence").alias("precedence"))
    rule, verdict = decided(F.col("precedence"), F.col("host"), F.col("path"))
    return best.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.lit(default)).alias("verdict"))
