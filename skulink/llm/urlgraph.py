"""URL filter by rules and link-graph propagation (operator 7).

Rules decide first: a rule fits its host and all subdomains when the URL's
path starts with the rule's; of several the longest wins.  Hosts that no rule
decides are judged on the host graph: trust is personalised PageRank from the
hosts with allowed pages along the links, distrust the same from the hosts
with blocked pages against them.  A host is blocked when its distrust
exceeds its trust by the factor ``RATIO``.

Edges are hyperlinks between different hosts, weighted by their number, and
site edges in both directions between a host and its parent domain (down to
two labels), so subdomains share their site's fate.  Links and pages are
aggregated to host pairs before anything is shuffled; the ranks are two
columns per host, iterated as joins over the edge table, and every few
rounds are written out, which keeps plans short and survives lost executors.
Rounds go on until the rank mass still to come can change no host's verdict.
A node without outgoing edges keeps its mass to itself (it is not dealt
anew).

Defined results: null URLs and URLs without ``://`` have an empty host and
path, fit no rule and are allowed; null HTML has no links; repeated rows are
pages of their own; very long HTML is searched whole; an empty table gives no rows;
other columns are ignored, whatever their names; an exact tie is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skulink.session import cut, discard

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING = 0.85
TOGETHER = 10      # rounds between two written states
MAX_ROUNDS = 170   # mass still to come below 1e-12: ranks are as exact as doubles, ties stay ties
RATIO = 2.0
SITE_WEIGHT = 1.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    rest = F.coalesce(after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.coalesce(after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def host_edges(pages: DataFrame, html_col: str) -> DataFrame:
    """(src, dst, w): links between hosts and site edges; expects a ``host`` column."""
    target = F.explode(F.regexp_extract_all(html_col, F.lit(HREF), F.lit(1)))
    links = (pages.select("host", target.alias("link"))
             .select(F.col("host").alias("src"),
                     host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link"))
                             .otherwise(F.col("link"))).alias("dst"))
             .where("src <> '' and dst <> '' and src <> dst")
             .groupBy("src", "dst").agg(F.count("*").cast("double").alias("w")))
    hosts = (pages.select("host").distinct()
             .unionByName(links.select(F.col("dst").alias("host"))).distinct().where("host <> ''"))
    # a host and its ancestors down to two labels: an array of at most the host's labels
    labels = F.size(F.split("host", r"\."))
    chain = hosts.where(labels > 2).select(F.transform(
        F.sequence(-labels, F.lit(-2)),
        lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), n)).alias("c"))
    site = (chain.select(F.explode(F.arrays_zip(
        F.expr("slice(c, 1, size(c) - 1)").alias("a"), F.expr("slice(c, 2, size(c) - 1)").alias("b")))
        .alias("e"))
        .select(F.col("e.a").alias("a"), F.col("e.b").alias("b")).distinct())
    both = (site.select(F.col("a").alias("src"), F.col("b").alias("dst"))
            .unionByName(site.select(F.col("b").alias("src"), F.col("a").alias("dst")))
            .withColumn("w", F.lit(SITE_WEIGHT)))
    return links.unionByName(both).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def judged_by_rank(trust: Column, distrust: Column) -> Column:
    return distrust > RATIO * trust


def undecided(ranks: DataFrame, open_mass: float, closed: bool) -> int:
    """Hosts whose verdict the mass still to come could change.

    A rank lies between what arrived and that plus ``open_mass``; one that is zero
    stays zero once no new host is reached (``closed``).
    """
    most = lambda c: F.col(c) + F.when((F.col(c) > 0) | F.lit(not closed), open_mass).otherwise(0.0)
    sure_block = judged_by_rank(most("trust"), F.col("distrust"))
    sure_allow = ~judged_by_rank(F.col("trust"), most("distrust"))
    return ranks.where(~(sure_block | sure_allow)).count()


def propagated(edges: DataFrame, seeds: DataFrame, rounds: int | None = None) -> DataFrame:
    """host, trust, distrust from ``seeds`` (host, good, bad: shares that sum to 1).

    The ranks are sums over walks from the seeds; t rounds sum the walks of less than
    t steps, so all walks still missing weigh ``DAMPING ** t`` together.  Goes on
    until that mass can turn no host's verdict, or exactly ``rounds`` rounds if given.
    """
    out = edges.groupBy("src").agg(F.sum("w").alias("t"))
    into = edges.groupBy("dst").agg(F.sum("w").alias("t"))
    # trust follows links, distrust goes against them
    steps = cut(
        edges.join(out, "src").select(F.lit("good").alias("kind"), F.col("src").alias("host"),
                                      F.col("dst").alias("to"), (F.col("w") / F.col("t")).alias("p"))
        .unionByName(edges.join(into, "dst").select(
            F.lit("bad").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"),
            (F.col("w") / F.col("t")).alias("p"))), "url-steps")
    start = cut(seeds.select("host", F.explode(F.create_map(
        F.lit("good"), F.col("good"), F.lit("bad"), F.col("bad"))).alias("kind", "seed"))
        .where("seed > 0").select("kind", "host", ((1 - DAMPING) * F.col("seed")).alias("rank")), "url-start")
    state, done, reached = start, min(1, MAX_ROUNDS if rounds is None else rounds), -1
    written = None
    while True:
        goal = min(done + TOGETHER, MAX_ROUNDS) if rounds is None else min(done + TOGETHER, rounds)
        while done < goal:
            # each round reads the last one once, so the plan grows by one join a round; the steps'
            # shuffle is the same in all of them; a hash of the whole table is never asked for
            moved = steps.join(state.hint("merge"), ["kind", "host"]).select(
                "kind", F.col("to").alias("host"), (DAMPING * F.col("p") * F.col("rank")).alias("rank"))
            state = moved.unionByName(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
            done += 1
        last, state = written, cut(state, "url-ranks")
        discard(last)
        written = state
        ranks = state.groupBy("host").agg(
            F.max(F.when(F.col("kind") == "good", F.col("rank")).otherwise(0.0)).alias("trust"),
            F.max(F.when(F.col("kind") == "bad", F.col("rank")).otherwise(0.0)).alias("distrust"))
        if rounds is not None:
            if done >= rounds:
                return ranks
            continue
        now = state.count()                     # (kind, host) pairs that any walk has reached
        if done >= MAX_ROUNDS or not undecided(ranks, DAMPING ** done, now == reached):
            return ranks
        reached = now


def host_seeds(pages: DataFrame) -> DataFrame:
    """Per host the shares of all rule-allowed and of all rule-blocked pages."""
    verdict = F.col("r.verdict")
    per = pages.where("host <> ''").groupBy("host").agg(
        F.count(F.when(verdict == "allow", 1)).alias("a"),
        F.count(F.when(verdict == "block", 1)).alias("b"))
    total = per.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()   # one row
    return per.select("host", (F.col("a") / F.lit(float(max(1, total["a"] or 0)))).alias("good"),
                      (F.col("b") / F.lit(float(max(1, total["b"] or 0)))).alias("bad"))


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
           html_col: str = "html", rules=RULES, rounds: int | None = None) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, trust, distrust."""
    url = F.col(url_col).cast("string")
    with_host = (pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"),
                              path_of(url).alias("path"), F.col(html_col).cast("string").alias("html"))
                 .withColumn("r", rule_of(F.col("host"), F.col("path"), rules)))
    edges = cut(host_edges(with_host, "html"), "url-edges")
    seeds = cut(host_seeds(with_host), "url-seeds")
    ranks = propagated(edges, seeds, rounds)
    own = F.when(judged_by_rank(F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))),
                 "block").otherwise("allow")
    return (with_host.drop("html").join(ranks, "host", "left")
            .select(F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"),
                    F.coalesce("r.verdict", own).alias("verdict"), "trust", "distrust"))


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract query: verdict of every page."""
    out = judged(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "host", "path", "rule", "verdict")
