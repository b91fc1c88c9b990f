"""URL filters: rules first, then trust and distrust that spread over the graph of hosts."""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Scratch


@dataclass(frozen=True)
class Rule:
    """Allow or block a host, its subdomains and all paths that start with ``path``."""

    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or a text without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = F.substring(rest, F.length(raw) + F.lit(1), F.length(rest))
    return F.translate(raw, ascii_uppercase, ascii_lowercase), F.regexp_extract(tail, "^[^?#]*", 0)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(rule, action) of the longest rule that fits, null if none does."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.action).alias("action"))).otherwise(found)
    return found


# Links in attributes that name a host (also without a scheme), and names of three or more labels anywhere in the page.
LINK = r"(?i)(?:href|src)\s*=\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)"
BREAK = r"[^A-Za-z0-9.-]+|\.\.+"
NAME = r"^(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.){2,}[a-z]{2,}$"
LONGEST = 253  # characters of a host name, by the domain name system


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, weight): how many pages of host src name or link host dst; no loops, no empty host.

    A page is cut once where no host name goes on, and only short pieces meet the pattern of names, so the time grows
    with a page's length whatever it holds.
    """
    host, _ = host_and_path(F.col(url_col))
    html = F.coalesce(F.col(html_col), F.lit(""))
    low = lambda x: F.translate(x, ascii_uppercase, ascii_lowercase)
    linked = F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), low)
    dotted = F.filter(F.split(html, BREAK), lambda x: x.contains("."))
    trimmed = F.transform(dotted, lambda x: low(F.btrim(x, F.lit(".-"))))
    named = F.filter(trimmed, lambda x: (F.length(x) <= LONGEST) & x.rlike(NAME))
    pairs = pages.select(host.alias("src"), F.explode(F.array_union(linked, named)).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    return pairs.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, scratch: Scratch, damping: float = 0.85, settled: float = 1e-12, save_every: int = 8) -> DataFrame:
    """(host, trust, distrust, trusted, distrusted) by personalised PageRank, stepped until the ranks have settled.

    ``seeds`` has host, trust and distrust masses.  Trust follows the links from trusted seeds; distrust follows them
    backwards from blocked seeds, to hosts that point at them.  Mass on a host without a way out leaves the graph.
    Each step is a join on the host and a sum that is combined before its shuffle; every ``save_every`` steps the ranks
    go through a shared table, which cuts the lineage, and two numbers go to the driver: the summed change of the last
    step and how many hosts it met first.  Steps end when the change is at most ``settled`` of a mass of 1, which they
    reach as each step shrinks it by ``damping``; hosts that are further from every seed have rank zero.  ``trusted`` and
    ``distrusted`` tell for all hosts, however far, whether links lead there from a seed of that kind.
    """
    steps = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    outgoing = steps.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    steps = steps.join(outgoing, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("share"))
    steps = scratch.table(steps, "steps")
    start = seeds.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "mass"))
    totals = start.groupBy("kind").agg(F.sum("mass").alias("all")).where("all > 0")
    nothing, unmet = F.lit(None).cast("double").alias("before"), F.col("before").isNull()
    start = start.where("mass > 0").join(totals, "kind").select("kind", "host", (F.col("mass") / F.col("all")).alias("rank"), nothing)
    start = scratch.table(start, "start")
    base = start.select("kind", "host", (F.col("rank") * (1 - damping)).alias("rank"), nothing)
    ranks, step = start, 0
    while True:
        for k in range(save_every):
            here = ranks.select("kind", F.col("host").alias("src"), "rank")
            moved = here.join(steps, ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"), nothing)
            sums = base.unionByName(moved)
            if k == save_every - 1:  # only the last step is compared, so that the plan doesn't read ranks twice at each
                sums = sums.unionByName(ranks.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("before")))
            ranks = sums.groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("before").alias("before"))
        step += save_every
        ranks = scratch.table(ranks, f"ranks-{step}")
        change, new = ranks.agg(F.sum(F.abs(F.col("rank") - F.coalesce("before", F.lit(0.0)))), F.count(F.when(unmet, 1))).first()
        scratch.drop(f"ranks-{step - save_every}")
        if (change or 0.0) <= settled:
            break
    met = ranks.select("kind", "host", "rank")
    if new:  # the last step still met hosts, so there may be more behind them
        met = met.unionByName(reached_beyond(steps.select("kind", "src", "dst"), met, scratch).select("kind", "host", F.lit(0.0).alias("rank")))
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))
    any_of = lambda kind: F.max(F.col("kind") == kind)
    return met.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"), any_of("trust").alias("trusted"), any_of("distrust").alias("distrusted"))


def reached_beyond(steps: DataFrame, met: DataFrame, scratch: Scratch) -> DataFrame:
    """(kind, host) of the hosts that ``steps`` (kind, src, dst) reach from those of ``met`` (kind, host), without these.

    A host with one predecessor is reached if that is, so such hosts point at it and pointers are doubled until they end
    at a host that is met or has several predecessors: a chain of n hosts takes log n rounds.  What is left, hosts of
    several predecessors and the pointers' ends before them, is searched in breadth, each round from the hosts that the
    last one found.  Hosts that only follow one another in a circle are not reached.
    """
    met = met.select("kind", F.col("host").alias("node"))
    into = steps.join(met, (steps.kind == met.kind) & (steps.dst == met.node), "left_anti").select("kind", "src", "dst")
    into = scratch.table(into.distinct(), "into")
    ways = into.groupBy("kind", "dst").agg(F.count("*").alias("n"), F.min("src").alias("src"))
    single = scratch.table(ways.where("n = 1").select("kind", F.col("dst").alias("node"), F.col("src").alias("top")), "tops-0")
    for k in range(1, single.count().bit_length() + 1):  # enough for a chain of all of them
        ends = single.select("kind", F.col("node").alias("top"), F.col("top").alias("further"))
        moved = single.join(ends, ["kind", "top"], "left").select("kind", "node", F.coalesce("further", "top").alias("top"), F.col("further").isNotNull().alias("moved"))
        single = scratch.table(moved, f"tops-{k}")
        scratch.drop(f"tops-{k - 1}")
        if not single.agg(F.max("moved")).first()[0]:
            break
    tops = single.select("kind", F.col("node").alias("src"), "top")
    several = into.join(ways.where("n > 1").select("kind", "dst"), ["kind", "dst"])
    short = several.join(tops, ["kind", "src"], "left").select("kind", F.coalesce("top", "src").alias("src"), "dst")
    short = scratch.table(short.distinct(), "short")
    found, last, k = met.limit(0), met, 0
    while True:
        here = last.select("kind", F.col("node").alias("src"))
        new = short.join(here, ["kind", "src"], "left_semi").select("kind", F.col("dst").alias("node")).distinct()
        last = scratch.table(new.join(found, ["kind", "node"], "left_anti"), f"found-{k}")
        if last.isEmpty():
            break
        found, k = found.unionByName(last), k + 1
        if k % 8 == 0:
            found = scratch.table(found, f"all-found-{k}")
    behind = single.join(met.unionByName(found).select("kind", F.col("node").alias("top")), ["kind", "top"], "left_semi").select("kind", F.col("node").alias("host"))
    return scratch.table(found.select("kind", F.col("node").alias("host")).unionByName(behind), "beyond")


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    tolerance: float = 1.0,
) -> DataFrame:
    """A verdict on every page's url: the longest fitting rule's, else the host's by propagation.

    Returns page_id, host, path, rule, verdict, trust, distrust.  A host's trusted and blocked seed masses are the
    numbers of its pages that rules allow and block.  A host is blocked if its distrust exceeds ``tolerance`` times its
    trust (unrounded, by more than rounding errors), or if it is too far from every seed to have a rank and links lead
    to it from blocked seeds only; where both are equal and where neither reaches (also the empty host of null and
    malformed urls) it is allowed.  Shown ranks have 9 places.  Repeated rows get equal verdicts; null html
    has no links; pages of any length are read whole; an empty table gives no rows; other columns are not read, whatever
    their names.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    split = split.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    action = F.col("_rule.action")
    seeds = split.groupBy("host").agg(
        F.sum(F.when(action == "allow", 1.0).otherwise(0.0)).alias("trust"),
        F.sum(F.when(action == "block", 1.0).otherwise(0.0)).alias("distrust"),
    )
    edges = scratch.table(host_edges(pages, url_col, html_col), "edges")
    scores = propagate(edges, seeds.where("host <> ''"), scratch)
    judged = split.join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"]).na.fill(False, ["trusted", "distrusted"])
    far = (F.col("trust") == 0) & (F.col("distrust") == 0) & F.col("distrusted") & ~F.col("trusted")
    by_host = F.when((F.col("distrust") > F.col("trust") * (tolerance * (1 + 1e-9))) | far, "block").otherwise("allow")
    shown = [F.round(c, 9).alias(c) for c in ("trust", "distrust")]
    return judged.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(action, by_host).alias("verdict"), *shown)
