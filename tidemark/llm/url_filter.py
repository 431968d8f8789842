"""URL filters: rules of hosts and paths, then trust and distrust along links.

Rules judge what they fit; the longest wins. Every other url gets the verdict of its host: trust is a
personalised PageRank that starts at the hosts most of whose pages an allowing rule judges, distrust one over
reversed links that starts at those most of whose pages a blocking rule judges (who links to blocked hosts takes
part in them). A host is blocked if its
distrust is greater than its trust, both as multiples of an even share of all hosts, and at least ``THRESHOLD`` of what
a blocked seed gets back at each restart: seeds themselves have that at least, a host that links to one blocked host and
nothing else has most of it, one that links to four and to sixteen others about a fifth.

The ranks iterate over host edges, pre-aggregated from the links of all pages: an edge counts once however many
links make it, so a host with a third of all pages sends few rows. Each round joins ranks to edges and sums per
target; a round is written, and the same number of rounds runs at every size.

Defined results: a url that is null or has no ``://`` has empty host and path; a rule fits neither. A host
without links, or that no seed reaches, has no distrust and is allowed. Links without a host of their own lead to
the page's host and add no edge. Repeated rows are judged alike; an empty table gives no rows. Null html has no
links; very long html is read whole. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, fold_case

ROUNDS = 20
DAMPING = 0.85
# Of a blocked seed's restart.
THRESHOLD = 0.2


@dataclass(frozen=True)
class Rule:
    verdict: str
    rule: str  # host and the path's start, as in net/es/

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)

# Links that name a host: absolute, or with the scheme of the page.
_LINK = "(?i)(?:href|src)\\s*=\\s*[\"']?([a-z][a-z0-9+.-]*://[^\"'\\s>]+|//[^\"'\\s>]+)"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of the url in a column of this name; both empty without ``://``."""
    after = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(F.col(url), F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    host = fold_case(F.regexp_extract(after, "^[^/?#]*", 0))
    path = F.regexp_extract(after, "(?s)^[^/?#]*(/[^?#]*)?", 1)
    return host, path


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def ruled(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """page_id, host, path, rule (the longest that fits) and rule_verdict."""
    host, path = host_and_path("url")
    longest_first = sorted(rules, key=lambda r: -len(r.rule))
    rule = F.coalesce(*[F.when(fits(r, F.col("host"), F.col("path")), F.lit(r.rule)) for r in longest_first])
    verdict = F.coalesce(*[F.when(F.col("rule") == r.rule, F.lit(r.verdict)) for r in rules])
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    return rows.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target: distinct pairs of different hosts of which the first has a page that links to the second."""
    links = pages.select(
        host_and_path("url")[0].alias("source"),
        F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1)))).alias("link"),
    ).where("source <> ''")
    links = links.withColumn("link", F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    edges = links.select("source", host_and_path("link")[0].alias("target"))
    return edges.where("target <> '' and target <> source").distinct()


def ranks(edges: DataFrame, hosts: DataFrame, seeds: DataFrame, scratch: Scratch, rounds: int = ROUNDS,
          damping: float = DAMPING) -> tuple[DataFrame, float]:
    """host, rank: PageRank that restarts at ``seeds``, scaled so that an even share is 1; and a seed's restart."""
    out = edges.groupBy("source").agg(F.count("*").alias("links"))
    flows = scratch.write(edges.join(out, "source"), "flows")
    start = scratch.write(seeds.join(hosts, "host", "left_semi").select("host").distinct(), "seeds")
    n, k = hosts.count(), start.count()
    restart = (1 - damping) * n / k if k else 0.0
    again = start.select("host", F.lit(restart).alias("rank"))
    if not k or flows.limit(1).count() == 0:
        # What any number of rounds without links comes to.
        return scratch.write(again, "ranks", keep=True), restart
    rank = start.select("host", F.lit(n / k).alias("rank"))
    for number in range(rounds):
        sent = flows.join(rank, F.col("source") == F.col("host")).groupBy("target").agg(
            (F.sum(F.col("rank") / F.col("links")) * damping).alias("rank")
        )
        rank = sent.select(F.col("target").alias("host"), "rank").union(again).groupBy("host").agg(F.sum("rank").alias("rank"))
        rank = scratch.write(rank, "ranks", keep=number == rounds - 1)
    return rank, restart


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's trust and distrust."""
    rows = ruled(pages, rules)
    with Scratch(pages.sparkSession, "urls") as scratch:
        edges = scratch.write(host_edges(pages), "edges")

        def share(verdict: str) -> Column:
            return F.avg(F.when(F.col("rule_verdict") == verdict, 1.0).otherwise(0.0)).alias(verdict)

        own = scratch.write(rows.where("host <> ''").groupBy("host").agg(share("allow"), share("block")), "own")
        hosts = own.select("host").union(edges.select("source")).union(edges.select("target"))
        hosts = scratch.write(hosts.distinct(), "hosts")
        trust, _ = ranks(edges, hosts, own.where("allow > 0.5"), scratch)
        back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"))
        distrust, restart = ranks(back, hosts, own.where("block > 0.5"), scratch)
        scores = hosts.join(trust.withColumnRenamed("rank", "trust"), "host", "left")
        scores = scores.join(distrust.withColumnRenamed("rank", "distrust"), "host", "left")
        scores = scratch.write(
            scores.select(
                F.col("host").alias("scored"), F.coalesce("trust", F.lit(0.0)).alias("trust"),
                F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
            ),
            "scores", keep=True,
        )

    rows = rows.join(scores, F.col("host") == F.col("scored"), "left").select(
        "page_id", "host", "path", "rule", "rule_verdict",
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
    linked = (F.col("distrust") >= threshold * restart) & (F.col("distrust") > F.col("trust"))
    verdict = F.coalesce("rule_verdict", F.when(linked, F.lit("block")).otherwise(F.lit("allow")))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
