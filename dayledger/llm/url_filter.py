"""URL filters: host and path rules, and link-graph propagation where no rule fits.

Rules judge a url by its host (with all subdomains) and the beginning of its path; the
longest wins. For other urls the host decides. Pages that rules allow or block are seeds of
their hosts. Trust is a personalised PageRank from the allowed seeds along links between
hosts: what trusted hosts link to is trusted. Distrust is the same from the blocked seeds
against the links: who links to blocked hosts is distrusted. A host is blocked if its distrust
exceeds its trust and amounts to at least ``threshold`` blocked pages for each of its pages.

Only hosts and links between hosts, each with its count, go through the iterations; links are
counted before any shuffle, so that a host with a third of all pages sends one row per linked host and
task. Rules are a list given in code, so their size is known.

Defined results: a null url or one without ``://`` has empty host and path; the empty host takes
no part in the graph and is allowed. Links without a host stay on their own host and say nothing.
Null html has no links. Repeated rows count as pages each. Without seeds of a kind nothing
is propagated from it. Further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import stored

_LINKS = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?\s*(https?://[^\s\"'<>]+)"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    damping: float = 0.85
    rounds: int = 12  # of the SQL twin, which cannot go on until ranks are settled
    settled: float = 1e-6  # pages by which a rank may still grow in the end
    stored_every: int = 4  # rounds between two cuts of the lineage
    threshold: float = 0.5


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url)))
    return F.coalesce(lowered(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null; of equal lengths the first listed."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text), reverse=True)[::-1]:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINKS), F.lit(1))).alias("link"))
    links = links.select("src", host_of(F.col("link")).alias("dst")).filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(nodes: DataFrame, edges: DataFrame, seed: str, settings: Settings) -> DataFrame:
    """(host, rank): personalised PageRank from the column ``seed`` of ``nodes`` along ``edges`` (src, dst, n).

    What hosts have of their own is passed on, less by the damping in each round, until all that can still
    arrive anywhere is at most ``settled``. Ranks are in seed units: they sum to the number of seeds, less what leaves hosts without links
    (such a host keeps its rank).
    """
    base = nodes.select("host", F.col(seed).cast("double").alias("seed"))
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    shares = stored(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share")), "shares")
    base = stored(base.join(out.select(F.col("src").alias("host"), F.lit(True).alias("links")), "host", "left"), "seeds")
    if shares.isEmpty():  # every host keeps its seeds
        return base.select("host", F.col("seed").alias("rank"))
    stays = F.when(F.col("links").isNull(), F.col("seed")).otherwise((1 - settings.damping) * F.col("seed"))
    ranks, number = base.select("host", stays.alias("rank"), stays.alias("moving")), 0
    while True:
        flow = ranks.filter("moving > 0").select(F.col("host").alias("src"), "moving").join(shares, "src")
        flow = flow.groupBy(F.col("dst").alias("host")).agg((settings.damping * F.sum(F.col("moving") * F.col("share"))).alias("flow"))
        joined = ranks.join(flow, "host", "left").withColumn("flow", F.coalesce("flow", F.lit(0.0)))
        ranks, number = joined.select("host", (F.col("rank") + F.col("flow")).alias("rank"), F.col("flow").alias("moving")), number + 1
        if number % settings.stored_every == 0:
            ranks = stored(ranks, "ranks")
            moving = ranks.agg(F.sum("moving")).first()[0] or 0.0
            if moving * settings.damping / (1 - settings.damping) <= settings.settled:
                return ranks.select("host", "rank")


def judge_hosts(judged: DataFrame, links: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(host, trust, distrust, host_verdict) from pages with ``host`` and ``rule_verdict``, and links between hosts."""
    pages = judged.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("rule_verdict") == "allow").alias("allowed"), F.count_if(F.col("rule_verdict") == "block").alias("blocked")
    )
    links = stored(links, "links")
    ends = links.select(F.explode(F.array("src", "dst")).alias("host")).distinct()
    zero = F.lit(0).cast("long")
    nodes = pages.join(ends, "host", "full").select("host", *[F.coalesce(c, zero).alias(c) for c in ("pages", "allowed", "blocked")])
    nodes = stored(nodes, "hosts")
    trust = propagate(nodes, links, "allowed", settings).withColumnRenamed("rank", "trust")
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(nodes, back, "blocked", settings).withColumnRenamed("rank", "distrust")
    both = nodes.join(trust, "host").join(distrust, "host")
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= settings.threshold * F.greatest("pages", F.lit(1)))
    return both.select("host", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("host_verdict"))


def filter_urls(pages: DataFrame, rules: list[Rule], settings: Settings = Settings()) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("rule_verdict"))
    hosts = judge_hosts(judged, host_links(pages.select("url", "html")), settings)
    joined = judged.join(stored(hosts, "verdicts"), "host", "left")
    verdict = F.coalesce("rule_verdict", "host_verdict", F.lit("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
