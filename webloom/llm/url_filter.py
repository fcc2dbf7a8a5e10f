"""URL filter: path rules, and link-graph propagation where no rule fits.

Hosts are the nodes, links between hosts the arcs.  Every host is a trusted
seed by the share of its pages that an allow rule covers and a distrusted
seed by the share that a block rule covers.  Trust is a personalised PageRank
along the links; distrust is one against them (who links to a blocked host is
suspect).  A host without arcs in a direction keeps its own mass, so an
isolated host scores its own shares.  How much mass reaches a host depends on
its links, so each score is divided by that of a run in which every host is a
full seed: what remains is the mean share of the hosts that reach it, between 0
and 1; and no score falls below the host's own share.  A host is blocked if its
distrust on that scale exceeds its trust and reaches ``threshold``.

DataFrame functions only; the graph holds hosts, not pages, and links are
counted per (from, to) with a map-side partial sum, so a host with a third of
all pages is one node.  Scores are cut from their lineage each step by a table
in the shared folder; the two sides of a join are plain tables there, so
adaptive execution can split a hot host.

Defined results: null url or url without ``://``: host and path empty, no
rule, scored as host ''.  Null html: no links.  Repeated rows count as pages
each.  An empty table gives an empty result.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from webloom.llm.common import Scratch, ascii_lower

DAMPING = 0.85
THRESHOLD = 0.5
TOLERANCE = 1e-6
_EPS = 1e-9  # of a score, for sums in any order

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\bhref\s*+=\s*+["']?\s*+(?:[a-z][a-z0-9+.\-]{0,20}:)?//([^/?#"'\s<>]++)"""


def url_host(url) -> F.Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def url_path(url) -> F.Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_verdict(host: F.Column, path: F.Column, rules: list[tuple[str, str, str]]) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest rule that fits; nulls if none does.

    ``rules`` holds (verdict, host, path); it is a short list of parameters.
    """
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, from ``host`` and ``html``."""
    return (pages.select(F.col("host").alias("src"),
                         F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"))
            .select("src", ascii_lower("dst").alias("dst"))
            .filter("src <> dst AND src <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def propagate(seeds: DataFrame, links: DataFrame, scratch: Scratch, damping: float = DAMPING,
              tolerance: float = TOLERANCE) -> DataFrame:
    """(host, t0, d0, trust, distrust, most_trust, most_distrust) from seeds (host, t0, d0) and
    links (src, dst, n); the last two are the scores if all hosts were full seeds."""
    both = links.select(F.col("src").alias("src"), F.col("dst").alias("dst"), F.col("n").cast("double").alias("n"))
    both = scratch.save(both)
    out = scratch.save(both.groupBy("src").agg(F.sum("n").alias("total")))
    into = scratch.save(both.groupBy("dst").agg(F.sum("n").alias("total")))
    arcs = scratch.save(
        both.join(out, "src").select(F.col("src").alias("a"), F.col("dst").alias("b"),
                                     (F.col("n") / F.col("total")).alias("wt"), F.lit(0.0).alias("wd"))
        .unionByName(both.join(into, "dst").select(F.col("dst").alias("a"), F.col("src").alias("b"),
                                                   F.lit(0.0).alias("wt"), (F.col("n") / F.col("total")).alias("wd"))))
    nodes = scratch.save(
        seeds.select("host", "t0", "d0")
        .unionByName(both.select(F.col("dst").alias("host"), F.lit(0.0).alias("t0"), F.lit(0.0).alias("d0")).distinct())
        .groupBy("host").agg(F.max("t0").alias("t0"), F.max("d0").alias("d0"))
        .join(out.select(F.col("src").alias("host"), F.lit(True).alias("has_out")), "host", "left")
        .join(into.select(F.col("dst").alias("host"), F.lit(True).alias("has_in")), "host", "left")
        .fillna(False, ["has_out", "has_in"]))
    scores = scratch.save(nodes.withColumns({"trust": F.col("t0"), "distrust": F.col("d0"), "most_trust": F.lit(1.0), "most_distrust": F.lit(1.0)}))
    keep = lambda x, has: F.when(F.col(has), 0.0).otherwise(F.col(x))
    law = {"trust": ("wt", F.col("t0"), "has_out"), "distrust": ("wd", F.col("d0"), "has_in"),
           "most_trust": ("wt", F.lit(1.0), "has_out"), "most_distrust": ("wd", F.lit(1.0), "has_in")}
    moving = bool(arcs.take(1))
    while moving:  # each step shrinks what is left to move by the damping: about 6 ln(hosts) + 85 steps at most
        sent = (arcs.join(scores.select(F.col("host").alias("a"), "trust", "distrust", "most_trust", "most_distrust"), "a")
                .groupBy(F.col("b").alias("host"))
                .agg(*(F.sum(F.col(w) * F.col(x)).alias(f"r_{x}") for x, (w, _, _) in law.items())))
        moved = Observation()
        new = (scores.join(scratch.save(sent), "host", "left")
               .withColumns({f"n_{x}": (1 - damping) * seed + damping * (F.coalesce(f"r_{x}", F.lit(0.0)) + keep(x, has))
                             for x, (_, seed, has) in law.items()})
               .observe(moved, F.max(F.greatest(*(F.abs(F.col(f"n_{x}") - F.col(x)) / (F.col(f"n_{x}") if x.startswith("most") else F.lit(1.0))
                                                  for x in law))).alias("most"))
               .select("host", "t0", "d0", "has_out", "has_in", *(F.col(f"n_{x}").alias(x) for x in law)))
        old, scores = scores, scratch.save(new)
        scratch.drop(old)
        moving = (moved.get["most"] or 0.0) >= tolerance
    return scores.select("host", "t0", "d0", *law)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], threshold: float = THRESHOLD,
                **how) -> DataFrame:
    """All ``pages`` (page_id, url, html) with host, path, rule, verdict and the host's scores."""
    scratch = Scratch(pages.sparkSession, "url-filter")
    judged = pages.select("page_id", "url", "html", url_host("url").alias("host"), url_path("url").alias("path"))
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "by_rule": verdict})
    share = lambda v: F.avg((F.coalesce("by_rule", F.lit("")) == v).cast("double"))
    seeds = judged.groupBy("host").agg(share("allow").alias("t0"), share("block").alias("d0"))
    scores = propagate(seeds, host_links(judged), scratch, **how)
    scores = scores.select("host", F.greatest("t0", F.col("trust") / F.col("most_trust")).alias("trust"),
                           F.greatest("d0", F.col("distrust") / F.col("most_distrust")).alias("distrust"))
    blocked = (F.col("distrust") > F.col("trust") + _EPS) & (F.col("distrust") >= threshold - _EPS)
    slim = scratch.save(judged.select("page_id", "host", "path", "rule", "by_rule"))
    return (slim.join(scores, "host", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("by_rule", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))
