"""URL verdicts from rules, and from link-graph propagation where no rule fits.

Hosts are nodes and hyperlinks between them edges.  Trust flows along the links from
hosts with pages that the rules allow, distrust against them from hosts with pages that
the rules block, both as personalised PageRank; a host with more distrust than trust is
blocked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import ascii_lower, stored

#: (verdict, host with its subdomains, start of the path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DAMPING, TOLERANCE = 0.85, 1e-6


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.length(rest) + 4))
    parts = [F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", i) for i in (1, 2)]
    host, path = (F.coalesce(p, F.lit("")) for p in parts)
    return ascii_lower(host), path


def _verdicts(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]):
    """Rule and verdict by the longest rule that fits, null without one."""
    rule = verdict = None
    for kind, own, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        rule = F.when(fits, own + start) if rule is None else rule.when(fits, own + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` by the rules alone."""
    host, path = url_parts(F.col("url"))
    parts = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")
    )
    rule, verdict = _verdicts(F.col("host"), F.col("path"), rules)
    return parts.select("*", rule.alias("rule"), verdict.alias("verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, links``: hyperlinks that lead to another host, with their number."""
    host, _ = url_parts(F.col("url"))
    pattern = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""
    links = pages.select(
        host.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("to")
    )
    full = F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to")).otherwise(
        F.col("to")
    )
    target, _ = url_parts(full)
    return (
        links.select("src", target.alias("dst"))
        .where("src != dst AND src != '' AND dst != ''")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("links"))
    )


def _weights(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Edges with the share of the source's links, named ``src, dst, share``."""
    total = edges.groupBy(source).agg(F.sum("links").alias("total"))
    return edges.join(total, source).select(
        F.col(source).alias("src"),
        F.col(target).alias("dst"),
        (F.col("links") / F.col("total")).alias("share"),
    )


def propagate(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``host, trust, distrust`` from ``host, good, bad`` and host edges.

    Each score is a personalised PageRank: a walk that restarts at the seeds, also
    from a node without an edge.  Scores sum to 1 if there is a seed, else all are 0.
    It ends when the scores move by less than the tolerance in sum, which takes about 90
    rounds at most, as each round moves them by the damping times the one before; each
    round is written to the shared folder.
    """
    sums = nodes.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).first()
    if not (sums["g"] or sums["b"]):
        return nodes.select("host", F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"))
    seed = {k: F.col(c) / F.lit(float(sums[s] or 1)) for k, c, s in (("trust", "good", "g"), ("distrust", "bad", "b"))}
    ways = {
        "trust": stored(_weights(edges, "src", "dst"), "links"),
        "distrust": stored(_weights(edges, "dst", "src"), "links-back"),
    }
    base = nodes.select("host", seed["trust"].alias("seed_t"), seed["distrust"].alias("seed_d"))
    for kind, way in ways.items():  # whether the walk leaves a host over an edge
        leaves = way.select(F.col("src").alias("host"), F.lit(1.0).alias(f"{kind}_leaves"))
        base = base.join(leaves.distinct(), "host", "left")
    base = stored(base, "seeds")
    start = {"trust": F.col("seed_t"), "distrust": F.col("seed_d"), "step": F.lit(2.0)}
    scores = base.withColumns(start)
    if ways["trust"].isEmpty():
        return scores.select("host", "trust", "distrust")
    while True:
        state = scores.agg(
            *(F.sum(F.col(k) * F.col(f"{k}_leaves")).alias(k) for k in ways), F.sum("step").alias("step")
        ).first()
        if state["step"] < TOLERANCE:
            return scores.select("host", "trust", "distrust")
        # What the walk does not carry over an edge starts again at the seeds.
        again = {k: F.lit(1 - DAMPING * (state[k] or 0.0)) for k in ways}
        flow = [
            way.join(scores.select(F.col("host").alias("src"), "trust", "distrust"), "src").select(
                F.col("dst").alias("host"),
                *(
                    (F.col("share") * F.col(kind) if kind == own else F.lit(0.0)).alias(f"in_{kind}")
                    for kind in ways
                ),
            )
            for own, way in ways.items()
        ]
        came = flow[0].unionByName(flow[1]).groupBy("host").agg(
            *(F.sum(f"in_{kind}").alias(f"in_{kind}") for kind in ways)
        )
        carried = {k: DAMPING * F.coalesce(f"in_{k}", F.lit(0.0)) for k in ways}
        scores = stored(
            scores.withColumnsRenamed({"trust": "old_t", "distrust": "old_d"})
            .join(came, "host", "left")
            .withColumns(
                {
                    "trust": again["trust"] * F.col("seed_t") + carried["trust"],
                    "distrust": again["distrust"] * F.col("seed_d") + carried["distrust"],
                }
            )
            .withColumn(
                "step",
                F.abs(F.col("trust") - F.col("old_t")) + F.abs(F.col("distrust") - F.col("old_d")),
            )
            .select(*base.columns, "trust", "distrust", "step"),
            "scores",
        )


def host_scores(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``host, trust, distrust`` of every host that has a page or is linked to.

    Every host with a page under an allow rule seeds trust and every host with one under
    a block rule distrust; its weight is the share of its pages that the rules so judge.
    """
    edges = stored(host_edges(pages), "host-edges")
    share = {
        kind: F.avg(F.coalesce((F.col("verdict") == kind).cast("double"), F.lit(0.0)))
        for kind in ("allow", "block")
    }
    seeds = judged(pages, rules).groupBy("host").agg(
        share["allow"].alias("good"), share["block"].alias("bad")
    )
    linked = edges.select("dst").distinct().select(
        F.col("dst").alias("host"), F.lit(0.0).alias("good"), F.lit(0.0).alias("bad")
    )
    nodes = seeds.unionByName(linked).groupBy("host").agg(
        F.max("good").alias("good"), F.max("bad").alias("bad")
    )
    return propagate(stored(nodes, "hosts"), edges)


def verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Each page's host, path, rule and verdict, with its host's scores.

    Where no rule fits, a host with more distrust than trust is blocked.  A null url
    has an empty host and path; a null html has no links, an empty or very long one is
    searched whole.  Equal scores allow; repeated rows have the same verdict each time, and
    each counts as a page of its host.  An empty table has no verdicts; columns other than
    ``page_id, url, html`` are ignored, whatever their names.
    """
    scores = host_scores(pages, rules)
    default = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    return judged(pages, rules).join(scores, "host").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", default).alias("verdict"),
        "trust",
        "distrust",
    )
