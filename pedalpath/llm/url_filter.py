"""URL filter: rules by host and path first, then trust and distrust that spread over the graph of hosts.

Graph. An edge leads from a page's host to every other host its links name, with the number of links as its weight. A
host is also joined to the domain above it, both ways, so that hosts of one owner lie near each other.

Propagation. Hosts with allowed pages hold the trust, those with blocked pages the distrust, in proportion to those pages.
Trust follows links from the trusted seeds (personalised PageRank); distrust goes against the links from the blocked
ones, since a page answers for what it links to. Both move in one pass a round, until they settle.

Verdict. A rule decides its urls. Any other url is blocked if its host has more distrust than trust and at
least ``floor`` times the mean distrust of a host.

All of it is DataFrame operations; a host's pages, which may be a third of all, are counted before any shuffle and
the table of hosts meets the pages in one equality join. Scores are written each round, so a lost executor costs a round.

Defined results for odd input: a null url, or one without ``://``, has an empty host and path, no rule, and is
allowed; null html has no links; hosts are compared as they stand, with port; repeated rows are judged alike, each for
itself, and count as pages each; an empty table gives an empty one; without seeds nothing is blocked but by rules; other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import drop_written, lower_ascii, stored


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
         Rule("allow", "org", "/fr/"))


@dataclass(frozen=True)
class Spread:
    damping: float = 0.85
    rounds: int = 30
    #: rounds end when all scores together move less than this
    settled: float = 1e-6
    #: weight of the edge to the domain above, against the links of a page
    owner: float = 0.5
    floor: float = 0.5


DEFAULT = Spread()


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host, "\\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules that fit a host or a domain above it, longest first."""
    parts = hosts.where("host <> ''").select("host", F.explode(_suffixes(F.col("host"))).alias("rule_host"))
    return parts.join(rules, "rule_host").groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct(F.length("name").alias("n"), "name", "rule_path", "verdict")), asc=False).alias("rules"))


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    return spark.createDataFrame([(r.host, r.path, r.name, r.verdict) for r in rules],
                                 "rule_host string, rule_path string, name string, verdict string")


def host_edges(pages: DataFrame, hosts: DataFrame, spread: Spread) -> DataFrame:
    """(a, b, weight) between different hosts; the weights that leave a host, and those that reach it, are kept apart."""
    links = F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(r"(?i)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"), F.lit(1))
    to = F.when(F.col("link").startswith("//"), host_of(F.concat(F.lit("x:"), F.col("link")))).otherwise(host_of(F.col("link")))
    linked = pages.select(host_of(F.col("url")).alias("a"), F.explode(links).alias("link")).where(F.col("link").contains("//")) \
        .select("a", to.alias("b")).where("a <> b and a <> '' and b <> ''").groupBy("a", "b").agg(F.count("*").cast("double").alias("weight"))
    above = hosts.where("host <> ''").select(F.explode(F.transform(
        F.filter(_suffixes(F.col("host")), lambda x: F.contains(x, F.lit("."))),
        lambda x: F.struct(x.alias("a"), F.regexp_replace(x, r"\A[^.]*\.", "").alias("b"))))).select("col.*") \
        .where(F.contains("b", F.lit("."))).distinct().withColumn("weight", F.lit(spread.owner))
    both = linked.unionByName(above).unionByName(above.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight"))
    return both.groupBy("a", "b").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, spread: Spread = DEFAULT) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust), each of which sums to 1 or 0."""
    out = edges.groupBy("a").agg(F.sum("weight").alias("out"))
    into = edges.groupBy("b").agg(F.sum("weight").alias("into"))
    edges, edge_path = stored(edges.join(out, "a").join(into, "b").select(
        "a", "b", (F.col("weight") / F.col("out")).alias("forth"), (F.col("weight") / F.col("into")).alias("back")), "host-edges")
    seeds, _ = stored(seeds, "host-seeds")
    state, path = stored(seeds, "host-scores")
    for _ in range(spread.rounds):
        trust = edges.join(state.where("trust > 0"), F.col("a") == F.col("host")) \
            .select(F.col("b").alias("host"), (F.col("trust") * F.col("forth")).alias("trust"), F.lit(0.0).alias("distrust"))
        distrust = edges.join(state.where("distrust > 0"), F.col("b") == F.col("host")) \
            .select(F.col("a").alias("host"), F.lit(0.0).alias("trust"), (F.col("distrust") * F.col("back")).alias("distrust"))
        moved = [(spread.damping * F.col(c)).alias(c) for c in ("trust", "distrust")]
        given = [((1 - spread.damping) * F.col(c)).alias(c) for c in ("trust", "distrust")]
        before = state.select("host", F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"),
                              F.col("trust").alias("t0"), F.col("distrust").alias("d0"))
        flow = trust.unionByName(distrust).select("host", *moved).unionByName(seeds.select("host", *given)) \
            .withColumn("t0", F.lit(0.0)).withColumn("d0", F.lit(0.0)).unionByName(before)
        fresh, fresh_path = stored(flow.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("trust", "distrust", "t0", "d0")]), "host-scores")
        change = fresh.agg(F.sum(F.abs(F.col("trust") - F.col("t0")) + F.abs(F.col("distrust") - F.col("d0")))).first()[0] or 0.0
        drop_written(fresh, path)
        state, path = fresh.select("host", "trust", "distrust"), fresh_path
        if change < spread.settled:
            break
    drop_written(edges, edge_path)
    return state


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, spread: Spread = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    placed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts, _ = stored(placed.groupBy("host").agg(F.count("*").alias("pages")), "hosts")
    fitting = rules_of_hosts(hosts, rule_table(spark, rules))
    known = placed.join(fitting, "host", "left").withColumn(
        "best", F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])), 0))
    judged, _ = stored(known.select("page_id", "host", "path", F.col("best.name").alias("rule"), F.col("best.verdict").alias("said")), "urls")
    counts = judged.where("host <> '' and said is not null").groupBy("host").agg(
        F.count_if(F.col("said") == "allow").alias("good"), F.count_if(F.col("said") == "block").alias("bad"))
    total = counts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    share = lambda c, n: F.col(c) / F.lit(float(n)) if n else F.lit(0.0)
    seeds = counts.select("host", share("good", total["good"]).alias("trust"), share("bad", total["bad"]).alias("distrust"))
    scores = propagate(host_edges(pages, hosts, spread), seeds, spread)
    mean = scores.agg(F.avg("distrust")).first()[0] or 0.0
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= spread.floor * F.lit(mean))
    return judged.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(F.coalesce(blocked, F.lit(False)), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
