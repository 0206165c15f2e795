"""URL rules with trust and distrust that spread over the links between hosts.

Hosts that the rules allow seed a personalised PageRank along links; hosts that the rules block seed one against them
(who links to bad hosts is suspect). A page without a rule gets the verdict of its host: block where distrust outweighs
trust by the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.workspace import deleted, written

#: Rules up to this many are one expression; more are joined by host suffix and start of path.
MOST_LITERAL = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first :// and /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct of the longest rule that fits and its verdict, or null, as an expression of rules: (verdict, host/path).

    A rule fits its host and all subdomains where the path starts with the rule's. Of rules as long as each other the
    first given wins.
    """
    out = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """verdict, rule and place (in the list) of each rule, for ruled()."""
    return spark.createDataFrame([(v, r, i) for i, (v, r) in enumerate(rules)], "verdict string, rule string, place long")


def ruled(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """rows (with host and path) with r, as matching_rule() gives it, for any number of rules (verdict, rule, place).

    A host learns which of its suffixes have rules and how long their paths are; each different url then looks up the starts
    of its path of these lengths by a hash join. Rules aren't broadcast by hint, and a url makes a row for each suffix and
    length, not for each rule. Null verdicts or rules are none; a rule that is given twice counts as first given.
    """
    slash = F.expr("locate('/', rule)")
    name = F.when(slash > 0, F.expr("substring(rule, 1, locate('/', rule) - 1)")).otherwise(F.col("rule"))
    start = F.when(slash > 0, F.expr("substring(rule, locate('/', rule))")).otherwise(F.lit("/"))
    first = F.min(F.struct("place", "verdict")).alias("first")
    known = rules.where("rule is not null and verdict is not null").groupBy("rule").agg(first)
    known = known.select(name.alias("name"), start.alias("start"), "rule", F.col("first.verdict").alias("verdict"), F.col("first.place").alias("place"))
    lengths = known.groupBy("name").agg(F.collect_set(F.length("start")).alias("lengths"))
    labels = F.split("host", "[.]", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = rows.select("host").distinct().select("host", F.explode(suffixes).alias("name"))
    hosts = hosts.join(lengths, "name").select("host", "name", F.explode("lengths").alias("length"))
    urls = rows.select("host", "path").distinct().join(hosts, "host").where(F.col("length") <= F.length("path"))
    urls = urls.select("host", "path", "name", F.expr("substring(path, 1, length)").alias("start"))
    found = urls.join(known, ["name", "start"])
    longest = F.max(F.struct(F.length("rule").alias("n"), (-F.col("place")).alias("p"), "rule", "verdict")).alias("m")
    best = found.groupBy("host", "path").agg(longest).select("host", "path", F.struct("m.rule", "m.verdict").alias("r"))
    return rows.join(best, ["host", "path"], "left")


def host_links(pages: DataFrame) -> DataFrame:
    """Edges src, dst, n from the absolute links of each page's html to other hosts; n counts links."""
    href = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""
    links = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(href), F.lit(1))).alias("to"))
    links = links.select(F.col("host").alias("src"), host_of(F.regexp_replace("to", "^//", "http://")).alias("dst"))
    return links.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float, tolerance: float, most: int) -> DataFrame:
    """Both walks at once: seeds kind, host, seed; edges kind, src, dst, w. Returns kind, host, score.

    score = (1 - damping) * seed + damping * sum over incoming edges of score(src) * w, iterated until a step changes all
    scores together by less than tolerance times the sum of seeds; if `most` steps don't get there, that is an error.
    Scores of hosts without links are not handed on. The ranks are written every second step, which cuts the lineage and
    gives the change.
    """
    base = seeds.select("kind", "host", (F.lit(1 - damping) * F.col("seed")).alias("score"))
    least = tolerance * (seeds.agg(F.sum("seed")).first()[0] or 0.0)
    ranks, held = base, None
    for step in range(1, most + 1):
        moved = (
            edges.join(ranks.withColumnRenamed("host", "src"), ["kind", "src"])
            .groupBy("kind", F.col("dst").alias("host"))
            .agg((F.lit(damping) * F.sum(F.col("score") * F.col("w"))).alias("score"))
        )
        new = base.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if step % 2 == 0:
            new = written(new, "host-ranks")
            before = ranks.withColumnRenamed("score", "old")
            change = new.join(before, ["kind", "host"], "left").agg(F.sum(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0))))).first()[0]
            if (change or 0.0) <= least:
                return new
            if held is not None:
                deleted(held)
            held = new
        ranks = new
    raise RuntimeError(f"host ranks did not settle in {most} steps")


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]] | DataFrame,
    damping: float = 0.85,
    tolerance: float = 1e-6,
    threshold: float = 0.5,
    most_steps: int = 500,
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page (columns page_id, url, html).

    rules: a list of (verdict, host/path), or a table of any size with verdict, rule and place. Seeds: the share of a host's pages that rules allow (trust) or block (distrust). trust is personalised PageRank over
    links, an edge weighing its share of its source's links; distrust is personalised PageRank over the reversed links, an
    edge weighing its share of the links to its target. Both are times the sum of seeds, so that a threshold doesn't
    depend on how many there are. A host is blocked where (distrust - trust) / (1 - damping) reaches the threshold: a host
    all of whose pages are blocked has 1 from these alone, one that has all links to such a host has damping. Pages
    without a rule take their host's verdict; hosts that no seed reaches, and pages whose url is null or has no ://, are
    allowed with trust and distrust 0. Null html has no links. Repeated rows are judged one by one and count in the
    shares. Other columns of pages are ignored.
    """
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if isinstance(rules, list) and len(rules) <= MOST_LITERAL:
        judged = judged.withColumn("r", matching_rule(F.col("host"), F.col("path"), rules))
    else:
        judged = written(ruled(judged, rules if isinstance(rules, DataFrame) else rule_table(pages.sparkSession, rules)), "ruled-urls")
    links = written(host_links(pages.select("html", host_of(F.col("url")).alias("host"))), "host-links")
    share = lambda v: F.avg((F.coalesce(F.col("r.verdict"), F.lit("")) == v).cast("double"))
    hosts = judged.where("host <> ''").groupBy("host").agg(share("allow").alias("t"), share("block").alias("d"))
    seeds = hosts.select("host", F.explode(F.create_map(F.lit("trust"), F.col("t"), F.lit("distrust"), F.col("d"))).alias("kind", "seed"))
    seeds = written(seeds.where("seed > 0"), "host-seeds")
    if links.isEmpty():
        ranks = seeds.select("kind", "host", (F.lit(1 - damping) * F.col("seed")).alias("score"))
    else:
        back = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
        both = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(back)
        both = both.join(both.groupBy("kind", "src").agg(F.sum("n").alias("total")), ["kind", "src"])
        both = both.select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("w"))
        ranks = propagate(seeds, written(both, "host-edges"), damping, tolerance, most_steps)
    scores = ranks.groupBy("host").agg(
        F.coalesce(F.max(F.when(F.col("kind") == "trust", F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.max(F.when(F.col("kind") == "distrust", F.col("score"))), F.lit(0.0)).alias("distrust"),
    )
    out = judged.join(scores, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_host = F.when((distrust - trust) / F.lit(1 - damping) >= F.lit(threshold), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce(F.col("r.verdict"), by_host).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
