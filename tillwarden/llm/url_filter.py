"""URL filter: rules on host and path, and link-graph propagation for what no rule covers.

Trust starts at the hosts of pages that a rule allows and follows links (personalised PageRank). Distrust starts
at the hosts of pages that a rule blocks and follows links backwards: who links to a bad host is suspect. Seeds
weigh as many as the pages that make them. A page without a rule is blocked when its host has more than
``threshold`` times as much distrust as trust, else allowed, so an unknown host stays.

All of it is DataFrame functions. Pages are reduced to hosts before anything is shuffled, links to distinct host
pairs with counts; the ranks move over these pairs for a fixed number of rounds, and each round is cut off by a
written table. Work on a host with a third of the pages or links is split, since only partial sums are shuffled.

Nulls: a null url, or one without ``://``, has an empty host and path, no rule and no edges; it is allowed, as an
unknown host is. A null html has no links. Repeated pages are judged each, and count each in seeds and edges. Empty
tables give empty results. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .texts import pick

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DAMPING = 0.85
ROUNDS = 8
THRESHOLD = 1.0
#: Share by which distrust must be the larger one: sums of floats in another order differ by less.
MARGIN = 1e-9
#: What follows href= in a link of a page, up to its closing quote.
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    rest = F.expr("substring({0}, locate('://', {0}) + 3)".format("_url"))
    return F.when(url.contains("://"), F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.expr("substring({0}, locate('://', {0}) + 3)".format("_url"))
    return F.when(url.contains("://"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def split_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    held = pages.withColumn("_url", F.coalesce(F.col(f"`{url}`"), F.lit("")))
    return held.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))}).drop("_url")


def host_rules(hosts: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """For each host the rules (host, path, verdict) that fit it or a domain above it, longest first.

    ``rules`` is a configuration list; each host looks up its own suffixes, so the work is labels, not rules.
    """
    listed = hosts.sparkSession.createDataFrame([(h + p, h, p, v) for h, p, v in rules], "rule string, domain string, prefix string, verdict string")
    listed = listed.groupBy("domain").agg(
        F.sort_array(F.collect_set(F.struct(F.length("rule").alias("size"), "rule", "prefix", "verdict")), asc=False).alias("own")
    )
    labels = F.split("host", r"\.")
    deepest = max((h.count(".") + 1 for h, _, _ in rules), default=1)
    ends = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest)))
    suffixes = F.transform(ends, lambda i: F.array_join(F.slice(labels, -i, i), "."))
    steps = hosts.withColumn("domain", F.explode(suffixes))
    found = steps.join(listed, "domain").withColumn("one", F.explode("own"))
    return found.groupBy("host").agg(F.sort_array(F.collect_set("one"), asc=False).alias("rules"))


def host_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct links between hosts with their counts (src, dst, weight); relative links stay on their host."""
    links = pick(pages, "host", html).filter(F.col("host") != "")
    # the counts of each page's own link targets are shuffled, not the links
    found = links.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(HREF), F.lit(1))).alias("to"))
    target = F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))
    found = split_urls(found.withColumn("to", target), "to")
    inside = ~F.col("to").contains("://") & ~F.col("to").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    dst = F.when(inside, F.col("src")).otherwise(F.col("host"))
    return found.select("src", dst.alias("dst")).filter("dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRanks (kind, host, score), one for each ``kind``.

    ``edges`` (kind, src, dst, share) have shares of a source that add to 1; so do the ``seed`` of a kind in ``seeds``
    (kind, host, seed). A host without outgoing links keeps its rank's damped part, so all ranks still add up to 1.
    """
    ends = materialize(edges.select("kind", F.col("src").alias("host")).distinct(), "host-ends")
    ranks = seeds.select("kind", "host", F.col("seed").alias("score"))
    for done in range(1, rounds + 1):
        from_ = ranks.withColumnRenamed("host", "src")
        moved = from_.join(edges, ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("part"))
        kept = ranks.join(ends, ["kind", "host"], "left_anti").select("kind", "host", (F.col("score") * damping).alias("part"))
        base = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("part"))
        ranks = moved.unionByName(kept).unionByName(base).groupBy("kind", "host").agg(F.sum("part").alias("score"))
        if done % 2 == 0 or done == rounds:
            ranks = materialize(ranks, "host-ranks")
    return ranks


def _shares(edges: DataFrame, kind: str, source: str, target: str) -> DataFrame:
    totals = edges.groupBy(F.col(source).alias("src")).agg(F.sum("weight").alias("total"))
    turned = edges.select(F.col(source).alias("src"), F.col(target).alias("dst"), "weight")
    return turned.join(totals, "src").select(F.lit(kind).alias("kind"), "src", "dst", (F.col("weight") / F.col("total")).alias("share"))


def _seeds(counts: DataFrame, kind: str, total: int | None) -> DataFrame:
    return counts.filter(F.col(kind) > 0).select(F.lit(kind).alias("kind"), "host", (F.col(kind) / F.lit(total)).alias("seed"))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    rounds: int = ROUNDS,
    damping: float = DAMPING,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of each page; the host's ``trust`` and ``distrust`` beside them."""
    split = split_urls(pick(pages, "page_id", "url", "html"))
    fits = materialize(host_rules(split.select("host").filter("host <> ''").distinct(), rules), "host-rules")
    judged = split.join(fits, "host", "left").withColumn(
        "found", F.try_element_at(F.filter("rules", lambda r: F.col("path").startswith(r["prefix"])), F.lit(1))
    )
    judged = judged.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("said"))
    # both written, so that the join of pages and hosts stands alone and a hot host in it is split among tasks
    judged = materialize(judged, "judged-pages")
    counts = materialize(
        judged.filter("said is not null")
        .groupBy("host")
        .agg(F.count_if(F.col("said") == "allow").alias("allowed"), F.count_if(F.col("said") == "block").alias("blocked")),
        "host-seeds",
    )
    sums = counts.agg(F.sum("allowed"), F.sum("blocked")).first()  # two numbers
    seeds = _seeds(counts, "allowed", sums[0]).unionByName(_seeds(counts, "blocked", sums[1]))
    links = materialize(host_edges(split), "host-links")
    edges = materialize(_shares(links, "allowed", "src", "dst").unionByName(_shares(links, "blocked", "dst", "src")), "host-edges")
    ranks = propagate(edges, seeds, rounds, damping)
    hosts = ranks.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "allowed", F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "blocked", F.col("score"))), F.lit(0.0)).alias("distrust"),
    )
    out = judged.join(hosts, "host", "left").fillna(0.0, ["trust", "distrust"])
    # relative, as scores are shares of all seeds and shrink with their number
    bad = (F.col("distrust") > 0) & (F.col("distrust") > F.col("trust") * threshold * (1 + MARGIN))
    verdict = F.coalesce("said", F.when(bad, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
