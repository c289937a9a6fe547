"""URL filters: rules first, then trust and distrust over the graph of hosts.

Hosts are nodes; an edge counts the links from a host's pages to another host. Pages that an allow rule covers make their host a trusted seed, pages
under a block rule a blocked seed, both in shares of all pages. Personalised PageRank spreads trust along the links; distrust spreads against
them, so that who links to blocked hosts takes part of it. A host is blocked if its distrust is over its trust plus `neutral_weight` times the
share of its own pages that no rule covers. Both run until a round moves no more than a millionth of the mass, which at most 91 rounds reach.

Links are counted per pair of hosts before any join, so a host with a third of all pages is one row per neighbour. Each round's ranks, one row
per host, are written to the shared folder.

Cases: a null url or one without `://` has empty host and path, no rule and the verdict of the empty host (allow, unless it earns distrust); null
html has no links; links without a host stay on their own host and spread nothing; pages that share a page_id are judged one by one;
without seeds or links every page outside the rules is allowed; other columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.session import stage

# (verdict, rule): the rule is a host and a path
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MAX_RULES = 1000
DAMPING = 0.85
TOLERANCE = 1e-6
_LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(_after_scheme(url), "^[^/?#]*", ""), "^[^?#]*", 0)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that covers a page, both null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the expression is meant for {MAX_RULES}")
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts."""
    found = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"))
    found = found.select("src", F.translate("dst", _UPPER, _LOWER).alias("dst")).where("src <> dst")
    return found.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n"))


def rounds_needed(damping: float, tolerance: float) -> int:
    """Rounds after which the ranks move by less than `tolerance` of the seeds' mass: every round leaves `damping` of a movement of twice the mass at most."""
    return math.ceil(math.log(tolerance / 2) / math.log(damping)) + 1


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, score): personalised PageRank from seeds (host, seed) over edges (src, dst, n), until a round moves at most
    `tolerance` of the seeds' mass.

    A host without links gives its mass back to the seeds by their shares. A round is one shuffle of host rows and one written table, from
    which the movement and the mass to give back are summed.
    """
    start = seeds.select("host", F.col("seed").alias("score"))
    if edges.isEmpty() or seeds.isEmpty():
        return start
    whole = seeds.agg(F.sum("seed")).first()[0] or 0.0
    if whole == 0:
        return start
    out = edges.groupBy("src").agg(F.sum("n").alias("all_links"))
    shares = stage(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("all_links")).alias("share")), "shares")
    zero = F.lit(0.0)
    given = seeds.select("host", "seed", zero.alias("got"), zero.alias("old"), F.lit(False).alias("links"))
    linking = shares.select(F.col("src").alias("host"), zero.alias("seed"), zero.alias("got"), zero.alias("old"), F.lit(True).alias("links")).distinct()
    fixed = given.unionByName(linking).groupBy("host").agg(F.sum("seed").alias("seed"), F.sum("got").alias("got"), F.sum("old").alias("old"), F.max("links").alias("links"))
    fixed = stage(fixed, "graph_hosts")
    ranks = fixed.select("host", F.col("seed").alias("score"), "links")
    stuck = ranks.where(~F.col("links")).agg(F.sum("score")).first()[0] or 0.0
    for _ in range(rounds_needed(damping, tolerance)):
        moved = ranks.join(shares, ranks.host == shares.src).groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("score") * F.col("share")).alias("got"))
        moved = moved.select("host", zero.alias("seed"), "got", zero.alias("old"), F.lit(False).alias("links"))
        before = ranks.select("host", zero.alias("seed"), zero.alias("got"), F.col("score").alias("old"), F.lit(False).alias("links"))
        summed = fixed.unionByName(moved).unionByName(before).groupBy("host").agg(
            F.sum("seed").alias("seed"), F.sum("got").alias("got"), F.sum("old").alias("old"), F.max("links").alias("links")
        )
        back = (1 - damping) + damping * stuck / whole
        ranks = stage(summed.select("host", (F.col("seed") * back + damping * F.col("got")).alias("score"), "old", "links"), "ranks")
        change, stuck = ranks.agg(F.sum(F.abs(F.col("score") - F.col("old"))), F.coalesce(F.sum(F.when(~F.col("links"), F.col("score"))), zero)).first()
        if change <= tolerance * whole:
            return ranks.select("host", "score")
    raise ArithmeticError(f"ranks still move by {change / whole:g} of the mass")


def host_verdicts(pages: DataFrame, rules=RULES, neutral_weight: float = 1.0, **options) -> DataFrame:
    """(host, trust, distrust, neutral, blocked) of every host that has a page or a score."""
    parsed = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    verdict = rule_of(F.col("host"), F.col("path"), rules)[1]
    counts = parsed.groupBy("host").agg(
        F.count_if(verdict == "allow").alias("allowed"), F.count_if(verdict == "block").alias("blocked"), F.count_if(verdict.isNull()).alias("neutral")
    )
    hosts = stage(counts, "hosts")
    edges = stage(host_links(pages), "host_links")
    n = float(hosts.agg(F.sum(F.col("allowed") + F.col("blocked") + F.col("neutral"))).first()[0] or 1)
    trust = spread(edges, hosts.where("allowed > 0").select("host", (F.col("allowed") / n).alias("seed")), **options)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = spread(back, hosts.where("blocked > 0").select("host", (F.col("blocked") / n).alias("seed")), **options)
    zero = F.lit(0.0)
    scored = (
        hosts.select("host", (F.col("neutral") / n).alias("neutral"))
        .join(trust.withColumnRenamed("score", "trust"), "host", "full_outer")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "full_outer")
        .select("host", *[F.coalesce(c, zero).alias(c) for c in ("trust", "distrust", "neutral")])
    )
    return scored.withColumn("blocked", F.col("distrust") > F.col("trust") + neutral_weight * F.col("neutral"))


def judge(pages: DataFrame, rules=RULES, neutral_weight: float = 1.0, **options) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the host's trust and distrust."""
    hosts = stage(host_verdicts(pages, rules, neutral_weight, **options), "host_verdicts")
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return parsed.join(hosts, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "trust", "distrust")
