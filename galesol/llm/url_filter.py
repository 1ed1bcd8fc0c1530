"""URL filter by a tree of path templates.

Rules settle what they fit, and are the labels of the rest. Per host, paths form a
tree of segments. Numbers and UUIDs are wildcards from the start; from the root down,
segments that few pages of their parent share become wildcards too. Branches of one parent
are pooled by their commonest continuation; those whose continuations and labels don't differ
significantly from their pool's are merged. A leaf of the merged tree is a template; it is
rejected if the share of bad pages among its labelled ones, smoothed towards the overall
share, reaches a limit. All of it is DataFrame work on the distinct shapes of paths with their
counts, which are taken with partial sums; no branch meets its siblings in pairs, but
only their pool.

Defined results: a url that is null or has no "://" has empty host and path, which is a
template as any other; so has every host with an empty path. Of rules that fit, the
longest host and path in characters wins, then the longer host, then a block. Repeated
rows are judged alike and count as often as they occur. Segments beyond DEPTH form one
segment together. A template without a page labelled bad stays, whatever the overall share. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from galesol.llm.common import discard, small_side, stored

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What is variable by its look alone.
VARIABLE = "[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[0-9]+"
WILD = "*"
#: Segments of a template, the last holding all further ones.
DEPTH = 4
#: A segment is no wildcard if it has so many pages, and this share of its parent's; so a parent has 100 branches at most besides the wildcard.
MIN_PAGES, MIN_SHARE = 5, 0.01
#: Standard deviations within which branches count as similar; strength of the prior; smoothed share of bad pages from which a template goes.
SIGMAS, PRIOR_PAGES, MAX_BAD = 3.0, 10.0, 0.8
#: Copies of the templates for the join with pages, so that a hot shape is dealt out.
SALTS = 8


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: The rules of the registered query.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty if it is null or has no "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), ASCII_UPPER, ASCII_LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The winning rule as a struct (rule, verdict), or null: one expression, for lists of some hundred rules."""
    ranked = sorted(rules, key=lambda r: (-len(r.host) - len(r.path), -len(r.host), r.verdict != "block"))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(ranked):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def segments(path: Column, depth: int = DEPTH) -> Column:
    """Segments with variable parts as wildcards; those from `depth` on are joined to one. An empty path has none."""
    all_of = F.split(F.substring(F.regexp_replace(path, VARIABLE, WILD), 2, 1 << 30), "/")
    tail = F.array_join(F.slice(all_of, depth, 1 << 30), "/")
    return F.when(path == "", F.array().cast("array<string>")).when(F.size(all_of) > depth, F.concat(F.slice(all_of, 1, depth - 1), F.array(tail))).otherwise(all_of)


def _add(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "bad", "good")])


def _like_pool(tails: DataFrame) -> DataFrame:
    """Branches (host, prefix, lead, branch, alike): whether a branch's continuations and labels are those of all branches given of its parent and lead.

    tails: host, prefix, lead, branch, tail, n, bad, good. Chi-squared of the tails, its distribution taken as normal, and the
    bad share of labelled pages as a binomial."""
    node = ["host", "prefix", "lead"]
    pool = _add(tails, *node, "tail")
    whole = pool.groupBy(*node).agg(F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"), (F.sum("bad") + F.sum("good")).alias("all_lab"), (F.count("*") - 1).alias("free"))
    branches = _add(tails, *node, "branch").join(whole, node)
    found = tails.select(*node, "branch", "tail", F.col("n").alias("o")).join(pool.select(*node, "tail", F.col("n").alias("pool_n")), [*node, "tail"])
    terms = found.groupBy(*node, "branch").agg(F.sum(F.col("o").cast("double") * F.col("o") / F.col("pool_n")).alias("terms"))
    chi = F.col("terms") * F.col("all_n") / F.col("n") - F.col("n")
    lab, p = F.col("bad") + F.col("good"), (F.col("all_bad") + 0.5) / (F.col("all_lab") + 1.0)
    off = F.col("bad") - lab * p
    alike = (chi <= F.col("free") + SIGMAS * F.sqrt(2.0 * F.col("free")) + 1e-6) & (off * off <= SIGMAS**2 * lab * p * (1.0 - p) + 1e-6)
    return branches.join(terms, [*node, "branch"]).select(*node, "branch", alike.alias("alike"))


def _level(state: DataFrame, i: int) -> DataFrame:
    """The tree with segment i of every path put behind its prefix: as it is, as a wildcard, or merged with its like."""
    node = ["host", "prefix"]
    live = state.where(F.size("segs") > i).withColumn("seg", F.get("segs", F.lit(i)))
    per = live.groupBy(*node, "seg").agg(F.sum("n").alias("seg_n"))
    total = per.groupBy(*node).agg(F.sum("seg_n").alias("all_n"))
    fixed = stored(per.join(total, node).where((F.col("seg_n") >= MIN_PAGES) & (F.col("seg_n") >= MIN_SHARE * F.col("all_n"))).select(*node, "seg", F.col("seg").alias("branch")))
    rest = F.slice("segs", i + 2, 1 << 30)
    rows = live.join(small_side(fixed), [*node, "seg"], "left").withColumn("branch", F.coalesce("branch", F.lit(WILD)))
    tails = stored(_add(rows.withColumn("tail", F.concat(F.size(rest).cast("string"), F.lit("/"), F.array_join(rest, "/"))), *node, "branch", "tail"))
    lead = tails.groupBy(*node, "branch").agg(F.min_by("tail", F.struct(-F.col("n"), "tail")).alias("lead"))
    tails = stored(tails.join(lead, [*node, "branch"]))
    node = [*node, "lead"]
    first = stored(_like_pool(tails))
    # Branches unlike their pool are pooled once more among themselves.
    odd = tails.join(first.where("NOT alike").select(*node, "branch"), [*node, "branch"], "left_semi")
    second = _like_pool(odd)
    groups = first.where("alike").select(*node, "branch", F.lit("a").alias("g")).union(second.select(*node, "branch", F.when(F.col("alike"), "b").otherwise(F.concat(F.lit("-"), "branch"))))
    groups = stored(groups)
    names = groups.groupBy(*node, "g").agg(F.array_sort(F.collect_set("branch")).alias("m"))  # 101 branches of a parent at most
    name = F.when(F.size("m") > 1, F.concat(F.lit("{"), F.array_join("m", "|"), F.lit("}"))).otherwise(F.get("m", F.lit(0)))
    named = stored(groups.join(names.select(*node, "g", name.alias("name")), [*node, "g"]).select("host", "prefix", "branch", "name"))
    moved = rows.join(small_side(named), ["host", "prefix", "branch"]).withColumn("prefix", F.concat("prefix", F.lit("/"), "name"))
    columns = ["host", "shape", "prefix", "segs", "n", "bad", "good"]
    out = stored(moved.select(*columns).union(state.where(F.size("segs") <= i).select(*columns)))
    discard(fixed, tails, first, groups, named)
    return out


def path_templates(pages: DataFrame) -> DataFrame:
    """Stored table (host, shape, template, n_pages, n_bad, n_good, purity) from pages with host, shape, segs and bad (null: no label).

    n_* and purity are those of the whole template; purity is the smoothed share of bad ones among labelled pages."""
    flag = lambda x: F.sum(F.when(x, 1).otherwise(0)).cast("long")
    shapes = pages.groupBy("host", "shape", "segs").agg(F.count("*").alias("n"), flag(F.col("bad")).alias("bad"), flag(~F.col("bad")).alias("good"))
    state = stored(shapes.withColumn("prefix", F.lit("")))
    deepest = state.agg(F.max(F.size("segs"))).first()[0] or 0
    for i in range(deepest):
        after = _level(state, i)
        discard(state)
        state = after
    counts = _add(state, "host", "prefix")
    prior = counts.agg(F.coalesce(F.try_divide(F.sum("bad"), F.sum("bad") + F.sum("good")), F.lit(0.0)).alias("prior"))  # one row
    purity = (F.col("bad") + PRIOR_PAGES * F.col("prior")) / (F.col("bad") + F.col("good") + PRIOR_PAGES)
    judged = counts.crossJoin(F.broadcast(prior)).select("host", "prefix", F.col("n").alias("n_pages"), F.col("bad").alias("n_bad"), F.col("good").alias("n_good"), purity.alias("purity"))
    out = stored(state.select("host", "shape", "prefix").join(judged, ["host", "prefix"]).withColumnRenamed("prefix", "template"))
    discard(state)
    return out


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, depth: int = DEPTH, max_bad: float = MAX_BAD, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), template, purity for every page."""
    host, path = parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("won", fitting(rules, F.col("host"), F.col("path"))).withColumn("segs", segments(F.col("path"), depth))
    rows = rows.withColumn("shape", F.concat(F.size("segs").cast("string"), F.lit("/"), F.array_join("segs", "/"))).withColumn("bad", F.col("won.verdict") == "block")
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    templates = stored(path_templates(rows).select("host", "shape", "template", "purity", "n_bad", copies.alias("salt")))
    out = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")).join(small_side(templates), ["host", "shape", "salt"])
    verdict = F.coalesce("won.verdict", F.when((F.col("purity") >= max_bad) & (F.col("n_bad") > 0), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("won.rule").alias("rule"), verdict.alias("verdict"), "template", F.round("purity", 6).alias("purity"))
