"""URL filter: rules first, then trust and distrust that spread over the host graph.

Every URL that a rule allows lays one unit of trust on its host, every one that a rule blocks one unit of distrust.
Trust follows the links (personalised PageRank with restarts at the trusted hosts), distrust goes against them (pages
that link to blocked hosts are suspects) with restarts at the blocked ones. A host without a rule for the URL is blocked when its distrust
exceeds ``ratio`` times its trust.

The graph is aggregated to weighted host edges before anything is joined, so a host with a third of all links is a few
rows. Masses are whole numbers (``UNIT`` parts), shares are rounded down: sums do not depend on the order of rows and
any engine gets the same verdicts. Links are ``href`` values: absolute and protocol-relative ones lead to their host,
the others to the page's own.

Defined cases: a null URL or one without ``://`` has an empty host and path, no rule and the method's verdict for the
empty host; null HTML has no links; a page without a host is no node; repeated rows count again; an empty table gives
no rows; other columns are ignored. Of rules that fit, the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.session import stage

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"""href\s*=\s*["']?([^"'\s>]*)"""
ROUNDS, DAMPING, UNIT, RATIO = 8, 85, 10**12, 1


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?`` or ``#``, A-Z in lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, else null."""
    out = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst, links)`` between hosts, from the pages' links."""
    link = F.explode(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("link")
    links = pages.where("host <> ''").select(F.col("host").alias("src"), link)
    # What follows is per link; links of one host to the same place are added up before the shuffle.
    target = F.when(F.col("link").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), host_of(F.col("link")))
    target = target.when(F.col("link").startswith("//"), host_of(F.concat(F.lit("x:"), "link"))).otherwise(F.col("src"))
    return links.select("src", target.alias("dst")).where("dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING) -> DataFrame:
    """``(host, trust, distrust)`` from ``edges (src, dst, links)`` and ``seeds (host, allowed, blocked)``.

    Trust and distrust travel in the same rounds as two kinds of mass, over the edges and over the reversed ones.
    """
    both = edges.select(F.lit(0).alias("kind"), "src", "dst", "links").union(
        edges.select(F.lit(1), F.col("dst"), F.col("src"), "links")
    )
    outgoing = both.groupBy("kind", "src").agg(F.sum("links").alias("all_links"))
    flows = stage(both.join(outgoing, ["kind", "src"]).withColumnRenamed("src", "host"), "host-flows")
    sums = seeds.agg(F.sum("allowed").alias("all_allowed"), F.sum("blocked").alias("all_blocked"))
    laid = seeds.join(F.broadcast(sums))  # one row of totals
    start = laid.where("allowed > 0").select(
        F.lit(0).alias("kind"), "host", F.expr(f"CAST({UNIT} AS DECIMAL(20,0)) * allowed div all_allowed").alias("restart")
    )
    start = stage(
        start.union(laid.where("blocked > 0").select(F.lit(1), "host", F.expr(f"CAST({UNIT} AS DECIMAL(20,0)) * blocked div all_blocked"))),
        "host-seeds",
    )
    mass = start.withColumnRenamed("restart", "mass")
    for _ in range(rounds):
        sent = mass.join(flows, ["kind", "host"]).select(
            "kind",
            F.col("dst").alias("host"),
            F.expr(f"(CAST(mass AS DECIMAL(20,0)) * links div all_links) * {damping} div 100").alias("mass"),
        )
        back = start.select("kind", "host", F.expr(f"restart * {100 - damping} div 100").alias("mass"))
        mass = sent.union(back).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        mass = stage(mass, "host-mass")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0))
    return mass.groupBy("host").agg(of(0).alias("trust"), of(1).alias("distrust"))


def judge(pages: DataFrame, rules=RULES, rounds: int = ROUNDS, damping: int = DAMPING, ratio: int = RATIO) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` of ``pages (page_id, url, html)``."""
    url = F.col("url")
    placed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), "html")
    ruled = placed.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    of = lambda v: F.count(F.when(F.col("found.verdict") == v, 1))
    seeds = stage(
        ruled.where("host <> ''").groupBy("host").agg(of("allow").alias("allowed"), of("block").alias("blocked")), "hosts"
    )
    masses = propagate(host_edges(placed), seeds, rounds, damping)
    verdict = F.coalesce(
        "found.verdict", F.when(F.col("distrust") > F.lit(ratio) * F.col("trust"), "block").otherwise("allow")
    )
    return (
        ruled.select("page_id", "host", "path", "found")
        .join(masses, "host", "left")
        .select(
            "page_id",
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            verdict.alias("verdict"),
            F.coalesce("trust", F.lit(0)).alias("trust"),
            F.coalesce("distrust", F.lit(0)).alias("distrust"),
        )
    )
