"""URL filters: rules first, then a tree of path templates per host, judged by the smoothed purity of labelled pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.session import materialise

#: (verdict, host and path) of the rules.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: A segment is variable if its node has more children than this and it has less than that share of the node's pages.
FANOUT, MIN_SHARE = 8, 0.02
#: Branches closer to their siblings' share of blocked pages than so many standard errors merge.
SIMILAR = 1.96
#: Weight of the level above, in pages, in a level's purity; purity from which a template is rejected.
SMOOTHING, REJECT = 2.0, 0.6
WILDCARD = "*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without it."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(verdict, rule) of the longest rule that fits: its host or a subdomain, and a path that starts with its path."""
    case = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        case = F.when(fits, value) if case is None else case.when(fits, value)
    return F.lit(None).cast("struct<verdict:string,rule:string>") if case is None else case


def shapes(path: Column) -> Column:
    """Segments of a path; numbers and long tokens with digits are variable by their shape."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike("^[0-9]+$") | (s.rlike("[0-9]") & (F.length(s) >= 8)), F.lit(WILDCARD)).otherwise(s))


def judge_templates(pages: DataFrame) -> DataFrame:
    """``host, segments, template, purity`` for each distinct host and list of segments of ``pages`` (host, segments, verdict).

    The tree is built level by level. A node is a host with a generalised path; its children are named, those that merge
    become one node, and the next level is grouped by the names, so merged branches share children, statistics and one purity per
    template: the blocked share of its labelled pages, smoothed towards the node above, up to the whole table. All
    statistics are sums over groups that Spark combines before the shuffle. What is left of a path that no other one shares a node with
    has nothing to be told apart from, and is named at once.
    """
    labelled = F.when(F.col("verdict").isNotNull(), 1).otherwise(0)
    blocked = F.when(F.col("verdict") == "block", 1).otherwise(0)
    sums = [F.sum(c).alias(c) for c in ("n", "lab", "bad")]
    routes = pages.groupBy("host", "segments").agg(F.count(F.lit(1)).alias("n"), F.sum(labelled).alias("lab"), F.sum(blocked).alias("bad"))
    routes = materialise(routes, "url-routes")
    total = routes.agg(F.coalesce(F.sum("lab"), F.lit(0)).alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    whole = (total["bad"] + 1.0) / (total["lab"] + 2.0)
    purity = (F.col("its_bad") + SMOOTHING * F.col("above")) / (F.col("its_lab") + SMOOTHING)
    hosts = routes.groupBy("host").agg(F.sum("lab").alias("its_lab"), F.sum("bad").alias("its_bad")).withColumn("above", F.lit(whole))
    state = routes.join(hosts.select("host", purity.alias("purity")), "host").withColumn("template", F.col("host"))
    state, depth, ended = materialise(state, "url-level"), 0, []
    while True:
        ended.append(state.where(F.size("segments") == depth).select("host", "segments", "template", "purity"))
        going = state.where(F.size("segments") > depth).withColumn("child", F.get("segments", F.lit(depth)))
        if going.isEmpty():
            return reduce(DataFrame.unionByName, ended)
        here = ["host", "template"]
        nodes = going.groupBy(*here, "child").agg(*sums, F.count(F.lit(1)).alias("paths"))
        parents = nodes.groupBy(*here).agg(
            F.count(F.lit(1)).alias("children"), F.sum("paths").alias("all_paths"), F.sum("n").alias("all_n"), F.sum("lab").alias("all_lab"), F.sum("bad").alias("all_bad")
        )
        beside = nodes.join(parents, here)
        share = F.try_divide(F.col("all_bad"), F.col("all_lab"))
        error = F.sqrt(F.col("lab") * share * (1 - share))
        rare = (F.col("children") > FANOUT) & (F.col("n") < MIN_SHARE * F.col("all_n"))
        similar = (F.col("lab") == 0) | (F.abs(F.col("bad") - F.col("lab") * share) <= SIMILAR * error)
        named = beside.withColumn("name", F.when(rare | F.coalesce(similar, F.lit(True)), F.lit(WILDCARD)).otherwise(F.col("child")))
        named = materialise(named.select(*here, "child", "name", "lab", "bad", (F.col("all_paths") == 1).alias("alone")), "url-names")
        pooled = named.groupBy(*here, "name").agg(F.sum("lab").alias("its_lab"), F.sum("bad").alias("its_bad"))
        levels = named.select(*here, "child", "name", "alone").join(pooled, [*here, "name"])
        moved = going.withColumnRenamed("purity", "above").join(levels, [*here, "child"])
        # a path alone in its node: the same step once for each segment that is left
        left = F.size("segments") - depth
        rest = F.when(F.col("alone"), F.sequence(F.lit(1), left)).otherwise(F.array(F.lit(1)))
        folded = F.aggregate(rest, F.col("above"), lambda p, _: (F.col("its_bad") + SMOOTHING * p) / (F.col("its_lab") + SMOOTHING))
        template = F.concat("template", F.array_join(F.transform(rest, lambda _: F.concat(F.lit("/"), F.col("name"))), ""))
        state = materialise(moved.select("host", "segments", "n", "lab", "bad", folded.alias("purity"), template.alias("template"), "alone"), "url-level")
        ended.append(state.where("alone").select("host", "segments", "template", "purity"))
        state, depth = state.where("not alone").drop("alone"), depth + 1


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, template`` for every row of ``pages``.

    Pages that a rule decides are the labelled ones: their verdicts are the statistics that the path
    templates of all hosts are judged by. On a host the paths form a tree; variable segments (numbers, long tokens, rare
    children of a wide node) become wildcards, branches whose blocked share does not differ from that of their siblings merge, with all that is below them, and
    a template whose smoothed purity of blocked pages is high is rejected. Hosts without labels take the
    share of the table.

    A null url, or one without ``://``, has an empty host and path, fits no rule, and is judged with the others of that
    host. Repeated rows are all returned. Other columns are ignored.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("verdict"), shapes(F.col("path")).alias("segments")
    )
    judged = judge_templates(parts).select(F.col("host").alias("_host"), F.col("segments").alias("_segments"), "template", "purity")
    met = parts.join(judged, (F.col("host") == F.col("_host")) & (F.col("segments") == F.col("_segments")))
    by_tree = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return met.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_tree).alias("verdict"), "template", "purity")
