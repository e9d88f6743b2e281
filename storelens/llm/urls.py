"""URL filters: explicit rules first, then personalised PageRank over the host graph.

A host's trust seed is the share of its pages that rules allow, its distrust seed the share they block. Trust follows
links, distrust follows them backwards: who links to blocked hosts becomes suspect. Edges are the distinct pairs of
hosts with the number of linking pages; in every round a host deals its damped mass out over its edges. How much mass
arrives depends on how many others share in it, so it is compared with what could have arrived: the same spread from
the hosts where something may originate, each with a full seed. These are the hosts that rules judge and those at the
end of the direction (for distrust hosts that link to no other, for trust hosts that no other links to). The share of
it that did arrive lies between 0 and 1: of the flow that ends in a host, how much comes from blocked (or allowed) pages.
A page no rule fits is blocked if its host's share of distrust reaches ``block_at`` and exceeds that of trust.

Masses are whole numbers, each contribution rounded down, so sums do not depend on the order of rows and a retried task
changes nothing.

Only built-in expressions run. Defined results: null urls and urls without ``://`` have an empty host and path, which
no rule fits, and are allowed; null html has no links; links to other protocols, relative links and links within a
host carry nothing; repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import join_dimension
from ..functions.materialize import checkpointed

UNIT = 10 ** 12
LINK = r"(?i)<(?:a|area|link|iframe|form)\b[^>]*?(?:href|src|action)\s*=\s*[\"']?\s*((?:https?:)?//[^\"'\s>]+)"


@dataclass(frozen=True)
class Rule:
    """``allow`` or block what lies under a host, its subdomains, and a start of the path."""
    allow: bool
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @classmethod
    def parse(cls, line: str) -> Rule:
        """From ``allow host/path`` or ``block host/path``."""
        action, _, place = line.partition(" ")
        host, slash, path = place.partition("/")
        if action not in ("allow", "block") or not slash:
            raise ValueError(f"no rule: {line!r}")
        return cls(action == "allow", host.lower(), slash + path)

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def decided(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``pages`` with host, path, the longest fitting rule and whether it allows (null: none fits)."""
    found = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    chosen, allows = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # a longer rule is asked first
        fits = rule.fits(F.col("host"), F.col("path"))
        chosen, allows = F.when(fits, rule.text).otherwise(chosen), F.when(fits, F.lit(rule.allow)).otherwise(allows)
    return found.withColumns({"rule": chosen, "rule_allows": allows})


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): numbers of pages of host ``src`` with a link to the other host ``dst``."""
    links = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)),
                                         lambda l: host_of(F.when(l.startswith("//"), F.concat(F.lit("http:"), l)).otherwise(l))))
    return pages.where(F.col("html").contains("//")).select(F.col("host").alias("src"), F.explode(links).alias("dst")) \
        .where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(seeds: DataFrame, edges: DataFrame, damping: float, steps: int) -> DataFrame:
    """(host, mass) after ``steps`` rounds from ``seeds`` (host, seed) along ``edges`` (src, dst, n)."""
    return spread_all(seeds, edges, damping, steps).withColumnRenamed("seed", "mass")


def spread_all(seeds: DataFrame, edges: DataFrame, damping: float, steps: int) -> DataFrame:
    """``seeds`` (host and any columns of masses) after ``steps`` rounds of personalised PageRank, each column by itself.

    A host deals its mass out over its edges. A hub's edges all need its mass; the join's larger side is the edges,
    which adaptive execution splits.
    """
    columns = [c for c in seeds.columns if c != "host"]
    flows = edges.join(edges.groupBy("src").agg(F.sum("n").alias("all_n")), "src")
    flows = checkpointed(flows.select("src", "dst", (F.lit(damping) * F.col("n") / F.col("all_n")).alias("part")))
    mass = seeds
    for step in range(steps):
        sent = flows.join(mass, flows["src"] == mass["host"]).select(
            F.col("dst").alias("host"), *[F.floor(F.col("part") * F.col(c)).alias(c) for c in columns])
        mass = sent.unionByName(seeds).groupBy("host").agg(*[F.sum(c).alias(c) for c in columns])
        if step % 4 == 3:
            mass = checkpointed(mass)
    return mass


def received(seeds: DataFrame, edges: DataFrame, column: str, damping: float, steps: int) -> DataFrame:
    """(host, ``column``): the share of the mass that could have arrived at a host that came from the seeds of ``column``.

    ``seeds`` has a row per host with pages and null masses where no rule judges any of them; along ``edges`` mass may
    originate there and wherever no edge ends.
    """
    full = F.lit(UNIT).cast("long")
    judged_hosts = seeds.where(f"{column} is not null").select("host", F.col(column).alias("mass"), full.alias("room"))
    ends = edges.select(F.col("src").alias("host")).distinct().join(edges.select(F.col("dst").alias("host")).distinct(), "host", "left_anti")
    ends = ends.join(judged_hosts.select("host"), "host", "left_anti").select("host", F.lit(0).cast("long").alias("mass"), full.alias("room"))
    arrived = spread_all(checkpointed(judged_hosts.unionByName(ends)), edges, damping, steps)
    return arrived.where("mass > 0").select("host", (F.col("mass") / F.col("room")).alias(column))


def judge(pages: DataFrame, rules: Sequence[Rule], damping: float = 0.85, steps: int = 16, block_at: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page."""
    found = decided(pages.select("page_id", "url", "html"), rules)
    narrow = checkpointed(found.select("page_id", "host", "path", "rule", "rule_allows"))
    hosts = narrow.groupBy("host").agg(
        F.count("*").alias("n"), F.count_if("rule_allows").alias("allowed"), F.count_if(~F.col("rule_allows")).alias("blocked"))
    ruled = F.col("allowed") + F.col("blocked") > 0
    seeds = checkpointed(hosts.select("host", *[F.when(ruled, F.floor(F.col(c) * F.lit(float(UNIT)) / F.col("n"))).alias(name)
                                                for c, name in (("allowed", "trust"), ("blocked", "distrust"))]))
    edges = checkpointed(host_edges(found))
    if edges.isEmpty():  # no link leaves its host: what could arrive is a full seed of one's own
        shares = seeds.where("trust is not null").select("host", *[(F.col(c) / F.lit(float(UNIT))).alias(c) for c in ("trust", "distrust")])
    else:
        trust = received(seeds, edges, "trust", damping, steps)
        back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
        shares = received(seeds, back, "distrust", damping, steps).join(trust, "host", "left")
    blocked = shares.where((F.col("distrust") >= block_at) & (F.col("distrust") > F.coalesce("trust", F.lit(0.0)))).select(
        "host", F.lit(True).alias("is_blocked"))
    # a host may have a third of all pages, and nobody knows how many hosts are blocked: counted there
    marked = join_dimension(narrow, blocked, ["host"])
    return marked.select("page_id", "host", "path", "rule",
                         F.when(F.coalesce("rule_allows", F.col("is_blocked").isNull()), "allow").otherwise("block").alias("verdict"))


RULES = tuple(map(Rule.parse, (
    "allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)
