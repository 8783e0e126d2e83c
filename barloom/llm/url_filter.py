"""URL verdicts: listed rules, and templates of paths judged by labelled purity; DataFrames only.

The paths of a host form a tree. Segments that hold a digit, and the children of a node that has many of
them, become wildcards. Branches that differ in one segment and whose labelled shares do not differ more
than chance would are merged. Every level of the tree is looked at, however deep. A template is rejected if
enough of its labelled pages are bad, smoothed by the share of bad pages among all labelled ones. One with too few
labelled pages is judged by its nearest ancestor that has enough, up to the whole host; where none has, its pages
are allowed. Labels are what the rules say.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from barloom.llm.common import lower_ascii
from barloom.session import broadcast_if_small, settle

#: Verdict, host and path of each rule.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
MOST_CHILDREN = 20
LEAST_LABELLED = 5     # on either side, to merge a branch; in all, to judge a node
DEVIATIONS = 1.96
SMOOTHING = 2.0
PURITY = 0.8


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        rule = F.when(fits, of + start).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def lexical_template(path: Column) -> Column:
    """The path with ``*`` for segments that hold a digit, without slashes at the end."""
    return F.regexp_replace(F.regexp_replace(path, r"/[^/]*[0-9][^/]*", "/*"), "/+$", "")


def _starred(parts: Column, depth: int) -> Column:
    return F.array_join(F.concat(F.slice(parts, 1, depth), F.array(F.lit("*")),
                                 F.slice(parts, depth + 2, 1 << 30)), "/")


def _levels(leaves: DataFrame) -> DataFrame:
    """Each node above and at every template: ``host, template, depth, node, child``; the host itself has depth 1, and
    a node without a child below it on this path has a null one."""
    parts = F.split("template", "/")
    return leaves.select("host", "template").distinct().withColumn(
        "depth", F.explode(F.sequence(F.lit(1), F.size(parts)))).withColumns({
            "node": F.array_join(F.slice(parts, 1, F.col("depth")), "/"),
            "child": F.when(F.size(parts) > F.col("depth"), F.try_element_at(parts, F.col("depth") + 1))})


def _wide_nodes(leaves: DataFrame) -> DataFrame:
    """``host, node, depth`` of nodes with many children that are no wildcards."""
    children = _levels(leaves).where("child is not null and child <> '*'").select("host", "node", "depth", "child")
    return children.distinct().groupBy("host", "node", "depth").count().where(
        F.col("count") > MOST_CHILDREN).select("host", "node", "depth")


def _starred_by_counts(leaves: DataFrame) -> DataFrame:
    """The children of wide nodes as wildcards, from the host downwards; levels without a wide node are skipped."""
    done = 0
    while True:
        wide = settle(_wide_nodes(leaves).where(F.col("depth") > done), "wide")
        level = wide.agg(F.min("depth")).head()[0]
        if level is None:
            return leaves
        parts = F.split("template", "/")
        here = wide.where(F.col("depth") == level).select("host", "node", F.lit(True).alias("wide"))
        starred = F.when(F.col("wide") & (F.size(parts) > level), _starred(parts, level)).otherwise(F.col("template"))
        leaves = settle(leaves.withColumn("node", F.array_join(F.slice(parts, 1, level), "/"))
                        .join(here, ["host", "node"], "left").withColumn("template", starred)
                        .select("host", "lexical", "template", "labelled", "bad"), "leaves")
        done = level


def _branches(leaves: DataFrame) -> DataFrame:
    """``host, template, depth, pool`` of templates that do not differ, but for one segment, from the rest of a pool
    more than chance would: both sides have enough labelled pages."""
    counted = leaves.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
    parts = F.split("template", "/")
    starred = F.array_join(F.concat(F.slice(parts, 1, F.col("depth")), F.array(F.lit("*")), F.slice(
        parts, F.col("depth") + 2, F.lit(1 << 30))), "/")
    branch = _levels(leaves).where("child <> '*'").select("host", "template", "depth").join(
        counted, ["host", "template"]).withColumn("pool", starred)
    # the wildcard's own template is part of its pool, if there is one
    pools = branch.select("host", "pool", "depth", "l", "b").groupBy("host", "pool", "depth").agg(
        F.sum("l").alias("pool_l"), F.sum("b").alias("pool_b"))
    share = F.col("pool_b") / F.col("pool_l")
    rest_l, rest_b = F.col("pool_l") - F.col("l"), F.col("pool_b") - F.col("b")
    chance = F.sqrt(share * (1 - share) * (1 / F.col("l") + 1 / rest_l))
    alike = F.abs(F.col("b") / F.col("l") - rest_b / rest_l) <= DEVIATIONS * chance
    return branch.join(pools, ["host", "pool", "depth"]).where(
        (F.col("l") >= LEAST_LABELLED) & (rest_l >= LEAST_LABELLED)).where(alike).select(
        "host", "template", "depth", "pool")


def _merged(leaves: DataFrame) -> DataFrame:
    """Similar branches as one, from the deepest level up; levels without such branches are skipped."""
    above = None
    while True:
        found = _branches(leaves)
        found = settle(found if above is None else found.where(F.col("depth") < above), "branches")
        level = found.agg(F.max("depth")).head()[0]
        if level is None:
            return leaves
        here = found.where(F.col("depth") == level).select("host", "template", "pool")
        leaves = settle(leaves.join(here, ["host", "template"], "left")
                        .withColumn("template", F.coalesce("pool", "template"))
                        .select("host", "lexical", "template", "labelled", "bad"), "leaves")
        above = level


def templates(labelled: DataFrame) -> DataFrame:
    """``(host, lexical, bad)`` rows, ``bad`` 1, 0 or null, to one row per host and lexical template:
    ``host, lexical, template, judged_by, labelled, purity, rejected``.

    ``judged_by`` is the nearest node with enough labelled pages, the template itself or one above it; nulls where
    there is none.
    """
    leaves = settle(labelled.groupBy("host", "lexical").agg(
        F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("template", F.col("lexical")), "leaves")
    leaves = _merged(_starred_by_counts(leaves))
    total = leaves.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).head()
    prior = total["b"] / total["l"] if total["l"] else 0.5
    levels = settle(_levels(leaves).select("host", "template", "depth", "node"), "levels")
    counted = leaves.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
    nodes = levels.join(counted, ["host", "template"]).groupBy("host", "node", "depth").agg(
        F.sum("l").alias("l"), F.sum("b").alias("b")).where(F.col("l") >= LEAST_LABELLED)
    nearest = levels.join(nodes, ["host", "node", "depth"]).groupBy("host", "template").agg(
        F.max_by(F.struct("node", "l", "b"), "depth").alias("n"))
    purity = (F.col("n.b") + SMOOTHING * prior) / (F.col("n.l") + SMOOTHING)
    judged = nearest.select("host", "template", F.col("n.node").alias("judged_by"), F.col("n.l").alias("labelled"),
                            purity.alias("purity"), (purity >= PURITY).alias("rejected"))
    return leaves.select("host", "lexical", "template").join(judged, ["host", "template"], "left")


def judged_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules=RULES) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, template, judged_by, purity``.

    A null url, or one without ``://``, has an empty host and path and no rule. A page that no
    rule fits is blocked if its template is rejected. Pages that repeat an id or a url are judged alike, and each
    counts among the labelled. Urls are read whole. Other columns are not read. An empty table gives no rows.
    """
    split = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(F.col(url_col)).alias("host"),
                         path_of(F.col(url_col)).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": rule, "said": verdict,
                               "lexical": lexical_template(F.col("path"))})
    bad = F.when(F.col("said") == "block", 1).when(F.col("said") == "allow", 0)
    known = broadcast_if_small(templates(ruled.select("host", "lexical", bad.alias("bad"))))
    return ruled.join(known, ["host", "lexical"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template", "judged_by", "purity")


def oracle(depth: int = 3) -> str:
    """The same in SQL over ``pages``, for paths of at most ``depth`` segments."""
    fits = ["case when (host = '%s' or ends_with(host, '.%s')) and starts_with(path, '%s') then" % (h, h, p)
            for _, h, p in RULES]
    order = sorted(range(len(RULES)), key=lambda i: len(RULES[i][1] + RULES[i][2]))
    rule = reduce(lambda rest, i: f"{fits[i]} '{RULES[i][1]}{RULES[i][2]}' else {rest} end", order, "null")
    said = reduce(lambda rest, i: f"{fits[i]} '{RULES[i][0]}' else {rest} end", order, "null")

    def starred(d: int) -> str:
        return (f"array_to_string(list_concat(list_concat(parts[1:{d}], ['*']), parts[{d + 2}:]), '/')")

    steps, last = [], "l0"
    for d in range(1, depth + 1):
        steps += [
            f"n{d} as (select *, array_to_string(parts[1:{d}], '/') as prefix, parts[{d + 1}] as child"
            f" from (select *, string_split(template, '/') as parts from {last}))",
            f"m{d} as (select host, prefix, true as many from n{d} where child is not null and child <> '*'"
            f" group by all having count(distinct child) > {MOST_CHILDREN})",
            f"l{d} as (select host, lexical, labelled, bad, case when many and child is not null then"
            f" {starred(d)} else template end as template from n{d} left join m{d} using (host, prefix))"]
        last = f"l{d}"
    for d in range(depth, 0, -1):
        steps += [
            f"b{d} as (select host, template, l, b, case when parts[{d + 1}] <> '*' then {starred(d)} end"
            f" as pool from (select host, template, string_split(template, '/') as parts,"
            f" sum(labelled) as l, sum(bad) as b from {last} group by all))",
            f"p{d} as (select host, pool, sum(l) as pl, sum(b) as pb from b{d} where pool is not null"
            f" group by all)",
            f"g{d} as (select host, template, pool from b{d} join p{d} using (host, pool)"
            f" where l >= {LEAST_LABELLED} and pl - l >= {LEAST_LABELLED} and abs(b / l - (pb - b) / (pl - l))"
            f" <= {DEVIATIONS} * sqrt(pb / pl * (1 - pb / pl) * (1 / l + 1 / (pl - l))))",
            f"r{d} as (select host, lexical, labelled, bad, coalesce(pool, template) as template"
            f" from {last} left join g{d} using (host, template))"]
        last = f"r{d}"
    return rf"""
with s as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
u as (select *, {rule} as rule, {said} as said,
        regexp_replace(regexp_replace(path, '/[^/]*[0-9][^/]*', '/*', 'g'), '/+$', '') as lexical
      from s),
l0 as (select host, lexical, lexical as template, count(said) as labelled,
         coalesce(sum((said = 'block')::int), 0) as bad
       from u group by all),
{", ".join(steps)},
t as (select coalesce(sum(bad) / nullif(sum(labelled), 0), 0.5) as prior from {last}),
v as (select host, template, d, array_to_string(parts[1:d], '/') as node
      from (select host, template, string_split(template, '/') as parts,
              unnest(range(1, len(string_split(template, '/')) + 1)) as d
            from (select distinct host, template from {last}))),
n as (select host, node, d, sum(l) as l, sum(b) as b
      from v join (select host, template, sum(labelled) as l, sum(bad) as b from {last} group by all)
        using (host, template)
      group by all having sum(l) >= {LEAST_LABELLED}),
j as (select host, template, arg_max(node, d) as judged_by,
        (arg_max(b, d) + {SMOOTHING} * any_value(prior)) / (arg_max(l, d) + {SMOOTHING}) as purity
      from v join n using (host, node, d), t group by all),
k as (select host, lexical, template, judged_by, purity, purity >= {PURITY} as rejected
      from {last} left join j using (host, template))
select page_id, host, path, rule,
       coalesce(said, case when rejected then 'block' else 'allow' end) as verdict, template, judged_by, purity
from u join k using (host, lexical)
"""
