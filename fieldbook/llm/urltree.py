"""URL filter: rules first, then a path-template tree judged by labelled purity; DataFrame functions only.

Every host's paths form a tree of segments.  Level by level, a segment stays literal where it carries a fair share of
its node's urls, or where its labelled urls have another block rate than the rest of the node's, and becomes a wildcard
elsewhere (ids, dates, slugs).  The tree is as deep as the paths; a path leaves it where its node has too few urls for
any segment to stay literal, and has only the number of its further segments in its template.  Then, deepest level first, labelled branches
whose block rate cannot be told from that of the other labelled ones of their node are merged: into the wildcard if it is
one of them, else into a branch of their own.  Branches without labels are never merged.  What is left are
templates; urls that a rule decides are their labels.  A template's block rate is smoothed towards that of the same
section (the path as it was before merging) on all hosts, that towards its host's, and that towards the rate of all urls.

Urls are counted before anything is shuffled, so a host or template with a third of all urls is a few rows a task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.winnow import LOWER, UPPER
from fieldbook.session import stage

WILD = "*"
#: labelled branches that cannot be told apart, where the wildcard is not one of them
MERGED = "(*)"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


class Settings(NamedTuple):
    min_urls: int = 3  # a literal segment has at least so many urls
    min_share: float = 0.05  # and at least this share of its node's, or another rate of labels
    z: float = 1.96  # branches less than so many standard errors apart merge
    weight: float = 2.0  # urls that a prior counts for
    block_at: float = 0.5  # smoothed block rate from which a template is rejected


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(url.isNull() | (at == 0), F.lit("")).otherwise(F.substr(url, at + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The name of the longest rule that fits; the first in order of name among equally long ones; null without any."""
    if not rules:
        return F.lit(None).cast("string")
    fits = [F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)), F.lit(r.name)) for r in sorted(rules, key=lambda r: (-len(r.name), r.name))]
    return F.coalesce(*fits)


def _template(paths: DataFrame, s: Settings) -> tuple[DataFrame, int]:
    """``host, path`` with ``t1, t2, ..`` (literal, wildcard, or null past the end) and ``rest``, the number of further segments; and the depth.

    A level looks at the paths that go on in nodes with enough urls, so levels end with the deepest of these.
    """
    segs = F.filter(F.split("path", "/"), lambda x: x != "")
    left = paths.withColumn("segs", segs)
    done, level = [], 0
    while True:
        node = ["host", *(f"t{i}" for i in range(1, level + 1))]
        rows = left.withColumn("seg", F.get("segs", F.lit(level)))
        child = rows.where("seg is not null").groupBy(*node, "seg").agg(F.sum("urls").alias("u"), F.sum("blocked").alias("b"), F.sum("labelled").alias("n"))
        whole = child.groupBy(*node).agg(F.sum("u").alias("all"), F.sum("b").alias("all_b"), F.sum("n").alias("all_n"))
        other = (F.col("n") > 0) & (F.col("all_n") > F.col("n")) & _apart(F.col("b"), F.col("n"), s)
        fair = (F.col("u") >= s.min_urls) & ((F.col("u") >= s.min_share * F.col("all")) | other)
        big = whole.where(F.col("all") >= s.min_urls).select(*node, F.lit(True).alias("big"))
        keep = child.join(whole, node).where(fair).select(*node, "seg", F.lit(True).alias("literal"))
        rows = rows.join(big, node, "left").join(keep, [*node, "seg"], "left")
        own = F.when(F.col("seg").isNull() | F.col("big").isNull(), F.lit(None)).when(F.col("literal"), F.col("seg")).otherwise(F.lit(WILD))
        rows = stage(rows.withColumn(f"t{level + 1}", own).drop("seg", "big", "literal"), "paths")
        done.append((level, rows.where(F.col(f"t{level + 1}").isNull())))
        left = rows.where(F.col(f"t{level + 1}").isNotNull())
        if left.isEmpty():
            break
        level += 1
    depth, out = max(1, level), None
    for at, rows in done:
        names = [F.col(f"t{i}") if i <= at else F.lit(None).cast("string").alias(f"t{i}") for i in range(1, depth + 1)]
        part = rows.select("host", "path", "urls", "labelled", "blocked", *names, (F.size("segs") - at).alias("rest"))
        out = part if out is None else out.unionByName(part)
    return out, depth


def _apart(b: Column, n: Column, s: Settings) -> Column:
    """Whether a branch with ``b`` of ``n`` labelled urls blocked has no labels, no labelled neighbours (``all_b``, ``all_n`` in the node), or another rate."""
    rest_n, rest_b = F.col("all_n") - n, F.col("all_b") - b
    rate = F.col("all_b") / F.col("all_n")
    error = F.sqrt(rate * (1 - rate) * (1 / n + 1 / rest_n))
    return F.when((n > 0) & (rest_n > 0), F.abs(b / n - rest_b / rest_n) > s.z * error).otherwise(F.lit(True))


def _merged(tree: DataFrame, depth: int, s: Settings) -> DataFrame:
    """Templates with their label counts; ``m1 ..`` are the segments after merging, deepest level first."""
    names = [f"t{i}" for i in range(1, depth + 1)]
    out = tree.select("*", *(F.col(t).alias("m" + t[1:]) for t in names))
    for level in range(depth, 0, -1):
        node = ["host", *(f"t{i}" for i in range(1, level))]
        own, at = f"t{level}", f"m{level}"
        branch = out.where(F.col(own).isNotNull()).groupBy(*node, own).agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("n"))
        wild = lambda x: F.sum(F.when(F.col(own) == WILD, F.col(x)).otherwise(0))  # noqa: B023, E731
        whole = branch.groupBy(*node).agg(F.sum("b").alias("all_b"), F.sum("n").alias("all_n"), wild("b").alias("wild_b"), wild("n").alias("wild_n"))
        both = branch.alias("c").join(whole.alias("w"), [F.col(f"c.{x}").eqNullSafe(F.col(f"w.{x}")) for x in node])
        stays = _apart(F.col("b"), F.col("n"), s)
        name = F.when(stays, F.col(f"c.{own}")).when(_apart(F.col("wild_b"), F.col("wild_n"), s), F.lit(MERGED)).otherwise(F.lit(WILD))
        named = both.select(*(F.col(f"c.{x}").alias(f"k_{x}") for x in (*node, own)), name.alias("name"))
        same = [F.col(x).eqNullSafe(F.col(f"k_{x}")) for x in (*node, own)]
        out = out.join(named, same, "left").withColumn(at, F.col("name")).drop(*named.columns)
        out = stage(out, "templates")
    shape = F.concat_ws("/", *(F.col(f"m{i}") for i in range(1, depth + 1)), F.when(F.col("rest") > 0, F.concat(F.lit("+"), F.col("rest").cast("string"))))
    return out.withColumn("template", F.concat(F.lit("/"), shape))


def judge_urls(pages: DataFrame, rules: list[Rule], settings: Settings | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, block_rate`` for each row of ``pages(page_id, url)``.

    The verdict is the rule's where one fits, else ``block`` where the template's smoothed block rate reaches
    ``block_at``, else ``allow``.  Without any labelled url the rate is 0.5 * weight over weight, i.e. 0.5 at every
    level, and ties block.  Null urls and urls without ``://`` have empty host and path, one template of their own.
    Repeated rows are repeated in the result and counted as often; a null ``page_id`` stays.  Empty tables give empty
    tables; other columns are ignored.  ``rules`` is a short list held in the plan (at most 1,000).
    """
    if len(rules) > 1000:
        raise ValueError("rules are part of the plan: give at most 1,000")
    s = settings or Settings()
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    blocks = [r.name for r in rules if r.verdict == "block"]
    paths = rows.groupBy("host", "path", "rule").agg(F.count("*").alias("urls"))
    paths = paths.withColumn("labelled", F.when(F.col("rule").isNull(), 0).otherwise(F.col("urls"))).withColumn("blocked", F.when(F.col("rule").isin(blocks), F.col("urls")).otherwise(0) if blocks else F.lit(0).cast("long"))
    placed, depth = _template(stage(paths, "paths"), s)
    names = [f"t{i}" for i in range(1, depth + 1)]
    tree = placed.groupBy("host", *names, "rest").agg(*(F.sum(x).alias(x) for x in ("urls", "labelled", "blocked")))
    tree = _merged(stage(tree, "tree"), depth, s)
    sums = lambda by, tag: tree.groupBy(*by).agg(F.sum("blocked").alias(f"b_{tag}"), F.sum("labelled").alias(f"n_{tag}"))
    rated = tree.join(sums(["host", "template"], "own"), ["host", "template"]).join(sums(["host"], "host"), "host")
    section = sums([*names, "rest"], "section").select(*(F.col(x).alias(f"s_{x}") for x in (*names, "rest")), "b_section", "n_section")
    rated = rated.join(section, [F.col(x).eqNullSafe(F.col(f"s_{x}")) for x in (*names, "rest")])
    everything = tree.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("n")).first()
    overall = ((everything["b"] or 0) + 0.5 * s.weight) / ((everything["n"] or 0) + s.weight)
    toward = lambda prior, tag: (F.col(f"b_{tag}") + s.weight * prior) / (F.col(f"n_{tag}") + s.weight)
    rated = rated.withColumn("block_rate", toward(toward(toward(F.lit(overall), "host"), "section"), "own"))
    rates = rated.select("host", *names, "rest", "template", "block_rate")
    by_path = placed.alias("p").join(rates.alias("r"), [F.col(f"p.{x}").eqNullSafe(F.col(f"r.{x}")) for x in ("host", *names, "rest")])
    by_path = by_path.select(F.col("p.host").alias("host"), F.col("p.path").alias("path"), "template", "block_rate")
    out = rows.join(by_path, ["host", "path"])
    by_rule = F.when(F.col("rule").isin(blocks), F.lit("block")).otherwise(F.lit("allow")) if blocks else F.lit("allow")
    verdict = F.when(F.col("rule").isNotNull(), by_rule).when(F.col("block_rate") >= s.block_at, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "block_rate")
