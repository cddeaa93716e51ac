"""URL verdicts: host and path rules, then trust and distrust spread over the host link graph."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import stage

#: Part of a score that follows links in each round.
FOLLOW = 0.85
ROUNDS = 32
#: Rounds between two written tables.
ROUNDS_PER_STAGE = 4
#: A host is blocked if its distrust reaches this and exceeds its trust.
DISTRUST_THRESHOLD = 0.5
#: Digits kept of scores, so that the order of a sum does not show.
DIGITS = 9
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct of text and verdict; null if none does.

    The rules are a short fixed list and become one CASE expression.
    """
    chosen = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def host_edges(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(source, target, links, allowed, blocked) between hosts; a relative link stays on its host.

    ``allowed`` and ``blocked`` count the links whose own url a rule allows or blocks; a link without
    a path is to ``/``. Links are counted per task before the shuffle, so a host with a third of all
    pages sends one row a task and target.
    """
    links = pages.select(
        host_of(F.col("url")).alias("source"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(HREF), F.lit(1))).alias("link"),
    ).where("source <> ''")
    target = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), F.col("link")))
    target = target.when(F.col("link").rlike("(?i)^https?://"), F.col("link"))
    target = target.when(~F.col("link").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(F.lit("http://"), F.col("source")))
    urls = links.select("source", target.alias("url"))
    urls = urls.select("source", host_of(F.col("url")).alias("target"), path_of(F.col("url")).alias("path")).where("target <> ''")
    path = F.when(F.col("path") == "", F.lit("/")).otherwise(F.col("path"))
    verdict = rule_for(F.col("target"), path, rules)["verdict"]
    return urls.select("source", "target", verdict.alias("verdict")).groupBy("source", "target").agg(
        F.count(F.lit(1)).alias("links"), F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked")
    )


def spread(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """(kind, host, score): trust along and distrust against the links, from the seeds of each kind.

    ``seeds`` has (kind, host, weight), ``links`` (source, target, links). Both kinds are shared by
    the linking host's links. Trust is personalised PageRank: a host passes ``FOLLOW`` of its trust
    to those it links to. A host's distrust is its weight and, for the rest up to one, ``FOLLOW`` of
    the mean distrust of what it links to, so it is not less where many others link to the same
    host. Weights are not scaled to a sum of one, so a score reads the same in a graph of any size.
    Links of a host to itself say nothing and are left out. Ends when no score moves by a unit of
    the last digit, or after ``ROUNDS`` rounds, when what is still to come is at most ``FOLLOW`` to
    that power (0.006) of what the seeds give.
    """
    links = stage(links.where("source <> target").groupBy("source", "target").agg(F.sum("links").alias("links")), "host-links")
    out = stage(links.groupBy("source").agg(F.sum("links").alias("all_links")), "host-out")
    shared = links.join(out, "source").withColumn("share", F.col("links") / F.col("all_links"))
    shares = shared.select(F.lit("trust").alias("kind"), "source", "target", "share").unionByName(
        shared.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "share")
    )
    shares = stage(shares, "host-shares")
    nodes = shares.select("kind", F.col("source").alias("host")).union(shares.select("kind", F.col("target").alias("host")))
    base = stage(
        seeds.select("kind", "host", "weight").unionByName(nodes.select("kind", "host", F.lit(0.0).alias("weight")))
        .groupBy("kind", "host").agg(F.round(F.sum("weight"), DIGITS).alias("weight")),
        "host-seeds",
    )
    scores = base.select("kind", "host", F.col("weight").alias("score"))
    room = F.when(F.col("kind") == "distrust", 1 - F.col("weight")).otherwise(F.lit(1.0))
    for _ in range(ROUNDS // ROUNDS_PER_STAGE):
        before = scores.select("kind", "host", F.col("score").alias("before"))
        for _ in range(ROUNDS_PER_STAGE):
            moved = shares.join(scores.withColumnRenamed("host", "source"), ["kind", "source"]).select(
                "kind", F.col("target").alias("host"), (F.col("score") * F.col("share")).alias("part"), F.lit(0.0).alias("weight")
            )
            held = base.select("kind", "host", F.lit(0.0).alias("part"), "weight")
            sums = moved.unionByName(held).groupBy("kind", "host").agg(F.sum("part").alias("part"), F.sum("weight").alias("weight"))
            scores = sums.select("kind", "host", F.round(F.col("weight") + room * FOLLOW * F.col("part"), DIGITS).alias("score"))
        scores = stage(scores, "host-scores")
        if not scores.join(before, ["kind", "host"]).where("score <> before").limit(1).count():
            break
    return scores


def judge_pages(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Host, path, rule and verdict of every page.

    A page that a rule fits gets the rule's verdict. The share of a host's pages that rules allow
    makes it a trusted seed, the share they block a blocked seed; of a host without a page it is the
    share of the links to it. Trust follows links from trusted hosts; distrust follows them
    backwards, to hosts that link to blocked ones. Other pages are blocked where their host's
    distrust reaches the threshold and exceeds its trust.

    A null url or one without ``://`` has no host, takes no part in the graph and is allowed.
    """
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    share = lambda verdict: F.avg(F.coalesce((F.col("_rule.verdict") == verdict).cast("double"), F.lit(0.0)))
    per_host = stage(
        judged.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")), "host-shares"
    )
    links = stage(host_edges(pages, rules), "host-edges")
    linked = links.groupBy(F.col("target").alias("host")).agg(
        (F.sum("allowed") / F.sum("links")).alias("trust"), (F.sum("blocked") / F.sum("links")).alias("distrust")
    )
    per_host = stage(per_host.unionByName(linked.join(per_host.select("host"), "host", "left_anti")), "host-seed-shares")
    seeds = per_host.select(F.lit("trust").alias("kind"), "host", F.col("trust").alias("weight")).unionByName(
        per_host.select(F.lit("distrust").alias("kind"), "host", F.col("distrust").alias("weight"))
    )
    scores = spread(seeds, links)
    hosts = scores.groupBy("host").agg(
        *[F.sum(F.when(F.col("kind") == kind, F.col("score"))).alias(f"host_{kind}") for kind in ("trust", "distrust")]
    )
    hosts = stage(hosts.withColumnRenamed("host", "_host"), "host-verdicts")
    bad = (F.col("host_distrust") >= DISTRUST_THRESHOLD) & (F.col("host_distrust") > F.col("host_trust"))
    method = F.when(F.coalesce(bad, F.lit(False)), "block").otherwise("allow")
    return judged.join(hosts, F.col("host") == F.col("_host"), "left").select(
        "page_id", "host", "path", F.col("_rule.text").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), method).alias("verdict"), "host_trust", "host_distrust",
    )
