"""URL filters: a path-template tree per host, with DataFrame functions only.

Paths are cut into segments. A segment that carries an id (a number, a long hex or a mix of letters and digits) or that is one of
too many different ones below its place is a variable and becomes a wildcard. Children of one node with statistically similar
shares of bad labels (two-proportion z below ``z``) are merged and judged by their joint counts. Purity goes down the tree: a
node's is the share of bad labels in its branch with pseudo-counts of its parent's purity, the host's with those of the corpus. A
node without labels below it thus takes the purity of its nearest labelled ancestor; if nodes of the same path and shape (with or
without a wildcard child) are labelled on other hosts, their share counts as ``prior`` labels of its own. A template is rejected
if its purity exceeds ``reject``. Rules name hosts and path prefixes; where one fits, it decides, and its verdict is the label that templates learn from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import stored
from clickforge.llm.decontaminate import LOWER, UPPER

#: (verdict, host, path prefix)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def host_of(url: str | Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(verdict, rule) of the longest rule that fits, else null: the host or a domain above it, and a prefix of the path."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    return F.coalesce(*[
        F.when(fits(h, p), F.struct(F.lit(v).alias("verdict"), F.lit(h + p).alias("rule"))) for v, h, p in ranked
    ], F.lit(None).cast("struct<verdict:string,rule:string>"))


def _variable(segment: Column) -> Column:
    return segment.rlike(r"^[0-9]+(\.[A-Za-z]{1,5})?$") | segment.rlike(r"^[0-9A-Fa-f]{8,}$") | segment.rlike(r"[0-9].*[A-Za-z]|[A-Za-z].*[0-9]")


def _path(depth: int | Column, column: str = "segments") -> Column:
    """The template down to a depth."""
    return F.concat(F.lit("/"), F.array_join(F.slice(column, 1, depth), "/"))


def templates(pages: DataFrame, depth: int, fan_out: int) -> DataFrame:
    """Adds ``template`` to (.., host, path): segments beyond ``depth`` are one wildcard, as are variable ones.

    Level by level, a node with more than ``fan_out`` different children has its rare children (fewer than one in ``fan_out`` of
    the node's rows) generalised to a wildcard; counts are combined before they are shuffled.
    """
    raw = F.filter(F.split("path", "/"), lambda s: s != "")
    marked = F.transform(raw, lambda s: F.when(_variable(s), F.lit("*")).otherwise(s))
    segments = F.when(F.size(marked) > depth, F.concat(F.slice(marked, 1, depth), F.array(F.lit("**")))).otherwise(marked)
    # distinct (host, segments) are few against pages, and the tree is built on them
    nodes = pages.select("host", "path").withColumn("segments", segments).groupBy("host", "segments").count()
    nodes = nodes.withColumn("original", F.col("segments"))
    for level in range(1, depth + 1):
        nodes, _ = stored(nodes, "nodes")  # each level reads the one before three times: plans would grow as 3 to the depth
        above, here = _path(level - 1), F.get("segments", F.lit(level - 1))
        tree = nodes.where(here.isNotNull()).groupBy("host", above.alias("above"), here.alias("child")).agg(F.sum("count").alias("rows"))
        whole = tree.groupBy("host", "above").agg(F.count("*").alias("children"), F.sum("rows").alias("total")).where(F.col("children") > fan_out)
        rare = tree.join(whole, ["host", "above"]).where(F.col("rows") * fan_out < F.col("total")).select("host", "above", "child", F.lit(True).alias("rare"))
        nodes = nodes.withColumns({"above": above, "child": here}).join(rare, ["host", "above", "child"], "left").select(
            "host", "original", "count", F.when(F.col("rare"), F.transform("segments", lambda s, i: F.when(i == level - 1, F.lit("*")).otherwise(s)))
            .otherwise(F.col("segments")).alias("segments"))
    named = nodes.select("host", "original", _path(depth + 1).alias("template"))
    return pages.withColumn("original", segments).join(named, ["host", "original"]).drop("original")


def judged_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, depth: int = 4, fan_out: int = 50, z: float = 1.96,
    prior: float = 2.0, reject: float = 0.5,
) -> DataFrame:
    """Host, path, template, rule, purity and verdict of every row of ``pages`` (page_id, url; further columns are ignored).

    ``purity`` is the smoothed share of bad labels in the template's branch, passed on from node to node. Null urls and urls without ``://`` have an empty host
    and path; they form one template. Without any labels all purities are 0.5 and nothing is rejected, as ``reject`` must be exceeded.
    """
    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).withColumns({"host": host_of("url"), "path": path_of("url")})
    read = read.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    known, _ = stored(templates(read, depth, fan_out), "templates")
    bad = F.sum(F.when(F.col("ruled.verdict") == "block", 1).otherwise(0))
    seen = F.count("ruled")
    leaf, _ = stored(known.groupBy("host", "template").agg(bad.alias("bad"), seen.alias("seen")), "purity")
    # every template stands at its node and below all nodes above it, up to the host's root at level 0
    cut = F.filter(F.split("template", "/"), lambda s: s != "")
    below = leaf.withColumn("cut", cut).select("*", F.explode_outer(F.sequence(F.lit(0), F.size("cut"))).alias("level")).select(
        "host", "template", "bad", "seen", "level", _path(F.col("level"), "cut").alias("node"),
        F.when(F.col("level") > 0, _path(F.col("level") - 1, "cut")).otherwise("").alias("above"),
        F.coalesce(F.get("cut", F.col("level")).startswith("*"), F.lit(False)).alias("wild"))
    tree, _ = stored(below.groupBy("host", "level", "node", "above").agg(
        F.sum("bad").alias("bad"), F.sum("seen").alias("seen"), F.max("wild").alias("wild")), "tree")
    # children of one node in the order of their shares: one that differs from the one before it opens a new branch
    labelled = (F.col("seen") > 0).alias("labelled")
    siblings = Window.partitionBy("host", "above", "level", "labelled").orderBy(F.col("bad") / F.greatest("seen", F.lit(1)), "node")
    last_bad, last_seen = F.lag("bad").over(siblings), F.lag("seen").over(siblings)
    pooled = (F.col("bad") + last_bad) / (F.col("seen") + last_seen)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("seen") + 1 / last_seen))
    differs = F.col("labelled") & (F.abs(F.col("bad") / F.col("seen") - last_bad / last_seen) > z * error)
    grouped = tree.select("*", labelled).withColumn("opens", F.coalesce(differs, F.lit(False)).cast("int")).withColumn("branch", F.sum("opens").over(siblings))
    joint = Window.partitionBy("host", "above", "level", "labelled", "branch")
    # nodes without labels look at labelled ones of the same path and shape on other hosts
    sisters, _ = stored(tree.where("level > 0 and seen > 0").groupBy("node", "wild").agg((F.sum("bad") / F.sum("seen")).alias("sister")), "sisters")
    nodes = grouped.withColumns({"b_bad": F.sum("bad").over(joint), "b_seen": F.sum("seen").over(joint)}).join(sisters, ["node", "wild"], "left").select(
        "host", "node", "b_bad", "b_seen", F.when(~F.col("labelled"), F.col("sister")).alias("sister"))
    corpus = leaf.agg(F.coalesce((F.sum("bad") + prior / 2) / (F.sum("seen") + prior), F.lit(0.5)).alias("base"))
    way = below.select("host", "template", "level", "node").join(nodes, ["host", "node"]).groupBy("host", "template").agg(
        F.sort_array(F.collect_list(F.struct("level", "b_bad", "b_seen", "sister"))).alias("way"))
    told = lambda s: F.when(s["sister"].isNotNull(), F.lit(prior)).otherwise(0.0)
    purity = F.aggregate("way", F.col("base"), lambda p, s: F.when(s["b_seen"] + told(s) == 0, p).otherwise(
        (s["b_bad"] + told(s) * F.coalesce(s["sister"], F.lit(0.0)) + prior * p) / (s["b_seen"] + told(s) + prior)))
    scored, _ = stored(way.join(F.broadcast(corpus)).select("host", "template", purity.alias("purity")), "scored")  # the corpus is one row
    return known.join(scored, ["host", "template"]).select(
        "page_id", "host", "path", "template", "purity", F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", F.when(F.col("purity") > reject, "block").otherwise("allow")).alias("verdict"))
