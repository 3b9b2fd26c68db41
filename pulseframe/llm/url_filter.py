"""URL filter: rules first, then trust and distrust spread over the links between hosts.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.session import scratch_path

ALLOW, BLOCK = "allow", "block"
# Part of a host's score that its links pass on. The rounds end when they move no more than this part
# of what the seeds have; each moves 0.85 of the one before at most, so there are some 57 of them.
DAMPING, TOLERANCE = 0.85, 1e-4
# Links of a host that meet in one task.
BLOCK_LINKS = 10_000
# A host is blocked if distrust less trust is more than this part of its pages.
THRESHOLD = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The host of an absolute link in a page.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


class Rule(NamedTuple):
    """Holds for a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``, and for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null. Of equally long ones the first by text."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, F.lit(r.host + r.path)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def host_links(judged: DataFrame) -> DataFrame:
    """(source, target, n): absolute links between different hosts, counted."""
    found = F.explode(F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(LINK), F.lit(1)))
    links = judged.select(F.col("host").alias("source"), found.alias("link"))
    links = links.select("source", F.translate("link", UPPER, LOWER).alias("target"))
    links = links.filter("source <> target and source <> ''")
    return links.groupBy("source", "target").agg(F.count("*").alias("n"))


def host_scores(judged: DataFrame) -> DataFrame:
    """(host, pages, trust, distrust) from pages with ``host``, ``html`` and ``ruled`` (verdict or null).

    Trust starts at hosts with allowed pages and follows the links; distrust starts at hosts with
    blocked pages and follows them backwards. Both start with the number of such pages; a host gets
    that plus DAMPING times what its links bring (personalised PageRank over 1 - DAMPING). Scores of
    both kinds are spread in one job per round, written to the shared folder.
    """
    spark = judged.sparkSession
    counts = judged.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"),
        F.count_if(F.col("ruled") == ALLOW).cast("double").alias("trust"),
        F.count_if(F.col("ruled") == BLOCK).cast("double").alias("distrust"),
    )
    hosts_path, links_path = scratch_path(spark, "hosts"), scratch_path(spark, "host-links")
    counts.write.parquet(hosts_path)
    host_links(judged).write.parquet(links_path)
    counts, links = spark.read.parquet(hosts_path), spark.read.parquet(links_path)
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("score")) for k in ("trust", "distrust")]))
    seeds = counts.select("host", kinds.alias("s")).select("host", "s.kind", "s.score").filter("score > 0")
    forward = links.select(F.lit("trust").alias("kind"), "source", "target", "n")
    back = links.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "n")
    edges = forward.union(back)
    # The links of a host are dealt out over parts, each of which gets a copy of the host's score.
    out = edges.groupBy("kind", "source").agg(
        F.sum("n").alias("all"), F.ceil(F.count("*") / BLOCK_LINKS).cast("int").alias("parts")
    )
    out_path, edges_path = scratch_path(spark, "host-degrees"), scratch_path(spark, "host-edges")
    out.write.parquet(out_path)
    out = spark.read.parquet(out_path)
    part = F.pmod(F.xxhash64("target"), F.col("parts")).cast("int")
    # Every round goes through this join by its copies; here a host with many links is split by the engine.
    dealt = edges.join(out, ["kind", "source"]).withColumns({"share": F.col("n") / F.col("all"), "part": part})
    dealt.drop("n", "all", "parts").write.parquet(edges_path)
    edges, parts = spark.read.parquet(edges_path), out.select("kind", F.col("source").alias("host"), "parts")

    steps = [spread := seeds]
    started = {r["kind"]: r["score"] for r in seeds.groupBy("kind").agg(F.sum("score").alias("score")).collect()}
    while started:
        # What one more step along the links brings; the sum of all steps is the score.
        copies = spread.join(parts, ["kind", "host"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        moved = copies.drop("parts").withColumnRenamed("host", "source").join(edges, ["kind", "source", "part"])
        moved = moved.groupBy(F.col("target").alias("host"), "kind").agg(
            F.sum(F.col("score") * F.col("share") * DAMPING).alias("score")
        )
        step_path = scratch_path(spark, "spread")
        moved.write.parquet(step_path)
        spread = spark.read.parquet(step_path)
        left = {r["kind"]: r["score"] for r in spread.groupBy("kind").agg(F.sum("score").alias("score")).collect()}
        if not left:
            break
        steps.append(spread)
        if all(v <= TOLERANCE * started[k] for k, v in left.items()):
            break
    by_kind = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    found = reduce(DataFrame.unionByName, steps).groupBy("host").agg(*by_kind)
    return counts.select("host", "pages").join(found, "host", "left").na.fill(0.0, ["trust", "distrust"])


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", html: str = "html") -> DataFrame:
    """The rows of ``pages``, without their html, with ``host``, ``path``, ``rule`` and ``verdict``.

    The longest fitting rule decides. Otherwise the page's host does: it is blocked if its distrust
    less its trust is more than THRESHOLD times its pages, else allowed. A url that is null, or has
    no host, fits no rule and is allowed. A null html has no links. Repeated rows count again.
    Columns of ``pages`` named like the new ones are replaced.
    """
    new = ("host", "path", "rule", "ruled", "verdict", "trust", "distrust")
    pages = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in new])
    host, path = host_and_path(F.col(f"`{url}`"))
    pages = pages.withColumns({"host": host, "path": path})
    rule, ruled = matching_rule(F.col("host"), F.col("path"), rules)
    pages = pages.withColumns({"rule": rule, "ruled": ruled})
    scores = host_scores(pages.select("host", F.col(f"`{html}`").alias("html"), "ruled"))
    bad = scores.select("host", (F.col("distrust") - F.col("trust") > THRESHOLD * F.col("pages")).alias("bad"))
    # Hosts that are not blocked need no row.
    found = pages.drop(html).join(bad.filter("bad"), "host", "left")
    verdict = F.coalesce("ruled", F.when(F.col("bad"), BLOCK).otherwise(ALLOW))
    return found.withColumn("verdict", verdict).drop("ruled", "bad")
