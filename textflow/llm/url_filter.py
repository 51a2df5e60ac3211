"""URL filters: rules of hosts and paths, and for the rest trust and distrust that spread over links of hosts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.llm.tables import lower_ascii, without, written

DAMPING = 0.85
# Rounds go on until the summed change of all ranks, between two times that they are written, is below this.
TOLERANCE = 1e-6
# Rounds after which the ranks are written, so that plans stay short and a lost executor costs few rounds.
WRITE_EVERY = 4
# How much more distrust than trust a host must have to be blocked.
THRESHOLD = 1.0
HREF = r"""(?i)href\s*+=\s*+["']?(?:[A-Za-z][A-Za-z0-9+.-]*+:)?//([^/?#"'\s<>]++)"""


@dataclass(frozen=True)
class Rule:
    """`action` (allow or block) for a host with all its subdomains and the paths that start with `path`."""

    action: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without any."""
    return F.coalesce(lower_ascii(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(length, text, action) of the longest rule that fits, or null. The rules are a parameter in the plan."""
    found = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(len(r.text)).alias("n"), F.lit(r.text).alias("rule"), F.lit(r.action).alias("action")),
        )
        for r in rules
    ]
    if not found:
        return F.lit(None).cast("struct<n:int,rule:string,action:string>")
    return F.array_max(F.array(*found))


def host_links(judged: DataFrame, html: str) -> DataFrame:
    """Links between different hosts, `src, dst`, each once: the absolute links in pages.

    Relative links stay on their host and count for nothing here. Hosts under one suffix are strangers to each other
    unless a page links them: many of them share a registry (`co.uk`) or a service of pages. Null pages have no links.
    """
    targets = F.regexp_extract_all(F.col(html), F.lit(HREF), F.lit(1))
    absolute = F.when(F.col(html).rlike(r"(?i)href[^>]{0,16}//"), targets)
    linked = judged.select(F.col("host").alias("src"), F.explode(absolute).alias("dst"))
    linked = linked.select("src", lower_ascii(F.col("dst")).alias("dst"))
    return linked.filter("src != dst and src != '' and dst != ''").distinct()


def spread(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """`host, trust, distrust`: personalised PageRank. `seeds` has `host, trusted, blocked`, shares that add up to 1.

    Trust follows links, divided among the targets; distrust goes against them, from a blocked host to those that
    link to it. A round is one join on the sender and one sum by the receiver, partial in each task. Mass of
    hosts without links is not passed on. No links or seeds give empty ranks.

    Rounds end when no further host was reached and the ranks, two for each host, changed by less than `tolerance` in all
    over the last `WRITE_EVERY` rounds; what is then missing is about as much. Their number grows with
    the logarithm of the tolerance and with the longest way from a seed.
    """
    arcs = links.select(F.lit("t").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b")).union(
        links.select(F.lit("d"), F.col("dst"), F.col("src"))
    )
    degrees = arcs.groupBy("kind", "a").agg((1 / F.count("*")).alias("share"))
    arcs = written(arcs.join(degrees, ["kind", "a"]), "arcs")
    start = written(
        seeds.select("host", F.explode(F.array(
            F.struct(F.lit("t").alias("kind"), F.col("trusted").alias("mass")),
            F.struct(F.lit("d").alias("kind"), F.col("blocked").alias("mass")),
        )).alias("x")).select("x.kind", F.col("host").alias("a"), "x.mass").filter("mass > 0"),
        "seeds",
    )
    again = start.select("kind", "a", (F.col("mass") * (1 - damping)).alias("mass"))
    ranks, reached = start, -1
    while True:
        last = ranks
        for _ in range(WRITE_EVERY):
            passed = ranks.join(arcs, ["kind", "a"]).select("kind", F.col("b").alias("a"), (F.col("mass") * F.col("share") * damping).alias("mass"))
            ranks = passed.union(again).groupBy("kind", "a").agg(F.sum("mass").alias("mass"))
        ranks = written(ranks, "ranks")
        both = ranks.select("kind", "a", "mass").union(last.select("kind", "a", -F.col("mass")))
        changes = both.groupBy("kind", "a").agg(F.abs(F.sum("mass")).alias("change"))
        n, change = changes.agg(F.count("*"), F.sum("change")).first()
        if n == reached and (change or 0.0) < tolerance:
            break
        reached = n
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0))
    return ranks.groupBy(F.col("a").alias("host")).agg(of("t").alias("trust"), of("d").alias("distrust"))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    html: str = "html",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Pages with `host`, `path`, `rule`, `verdict`, `trust`, `distrust`.

    A page that a rule fits gets its verdict. Hosts with allowed pages are trusted seeds and hosts with blocked pages
    are blocked seeds, each by its number of such pages. The other pages are blocked if their host's distrust
    exceeds its trust times `threshold`, else allowed; hosts that no links tell about are allowed, and so are
    null or broken urls. Frequent hosts are counted in the tasks first. The ranks are joined to pages by host,
    without the html; Spark splits the rows of a frequent host. Columns of these names are replaced.
    """
    added = ("host", "path", "rule", "verdict", "trust", "distrust")
    own = without(pages, *added)
    judged = own.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    judged = judged.withColumn("__rule", matching_rule(F.col("host"), F.col("path"), rules))
    said = lambda action: F.sum(F.when(F.col("__rule.action") == action, 1).otherwise(0))
    counts = judged.groupBy("host").agg(said("allow").alias("allowed"), said("block").alias("denied"))
    counts = written(counts.filter("(allowed > 0 or denied > 0) and host != ''"), "seed_hosts")
    totals = counts.agg(F.sum("allowed"), F.sum("denied")).first()
    share = lambda name, total: F.col(name) / F.lit(float(total or 1))
    seeds = counts.select("host", share("allowed", totals[0]).alias("trusted"), share("denied", totals[1]).alias("blocked"))
    ranks = written(spread(host_links(judged, html), seeds, tolerance=tolerance), "host_ranks")
    ranks = ranks.select(F.col("host").alias("__host"), "trust", "distrust")
    kept = judged.drop(html) if html in judged.columns else judged
    known = kept.join(ranks, F.col("host") == F.col("__host"), "left").drop("__host")
    by_rank = F.when(
        F.coalesce("distrust", F.lit(0.0)) > F.coalesce("trust", F.lit(0.0)) * threshold, "block"
    ).otherwise("allow")
    return known.withColumns(
        {
            "rule": F.col("__rule.rule"),
            "verdict": F.coalesce(F.col("__rule.action"), by_rank),
            "trust": F.coalesce("trust", F.lit(0.0)),
            "distrust": F.coalesce("distrust", F.lit(0.0)),
        }
    ).drop("__rule")
