"""URL filters: fixed rules, then a path-template tree with labelled purity. DataFrame functions only.

Tree, per host: a path's segments are generalised level by level. A segment with a digit is the wildcard `{n}` (keeping an
extension); of other segments, those of a branch that hold fewer than `min_share` of its parent's urls, and those whose
labelled purity does not differ from the parent's by more than `z` standard errors, are merged into `{*}`. A template is
rejected if its purity, smoothed towards that of all labelled pages with `prior` pseudo-labels, is below `min_purity` and
`min_labels` labels support it. Counts are partial sums before every shuffle; the tree has a bounded depth, deeper
segments fold into one `{**}`. All rates are smoothed alike: (good + 1) / (labelled + 2).

Purity: good labels (quality 1 and not toxic) over all labels; a page's label is that of the document whose number its
path carries. Edge cases: null urls and urls without :// have empty host and path and fall to the template `` of the
empty host; ties of rules are broken by length, then name; an empty label table rejects nothing, an empty table of pages
gives no rows; repeated rows and ids repeat and count as often as they occur; several labels of one document are all to be
good; other columns may have any names; a very long url is one string, folded into a template of at most DEPTH + 1 segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: (rule, verdict): host suffix and path prefix. The longest that fits wins.
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))
DEPTH = 4


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host_col: Column, path_col: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the last that fits wins
        domain, _, rest = name.partition("/")
        fits = ((host_col == domain) | host_col.endswith("." + domain)) & path_col.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def segments(path_col: Column, depth: int = DEPTH) -> Column:
    """Generalised segments: numbers become {n}; beyond the depth one {**}."""
    parts = F.filter(F.split(path_col, "/"), lambda s: s != "")
    parts = F.transform(parts, lambda s: F.regexp_replace(s, "[0-9]+", "{n}"))
    return F.when(F.size(parts) > depth, F.concat(F.slice(parts, 1, depth), F.array(F.lit("{**}")))).otherwise(parts)


def good_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, good): one row a document; several labels of one are all to be good. Null labels count as not given."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("good"))


def templates(urls: DataFrame, depth: int = DEPTH, min_share: float = 0.01, z: float = 2.0) -> DataFrame:
    """(host, segs, template): the generalised segments of every path and the template they merge into.

    urls: (host, segs, labelled, good) as counts n, labelled, good by distinct (host, segs).
    """
    table = materialize(urls).select("host", "segs", "n", "labelled", "good", F.array().cast("array<string>").alias("template"))
    for level in range(depth + 1):
        here = F.coalesce(F.get("segs", F.lit(level)), F.lit(""))
        table = table.withColumn("seg", here)
        branch = table.groupBy("host", "template", "seg").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "good")])
        parent = branch.groupBy("host", "template").agg(*[F.sum(c).alias("p_" + c) for c in ("n", "labelled", "good")])
        rate = (F.col("p_good") + 1) / (F.col("p_labelled") + 2)
        own = (F.col("good") + 1) / (F.col("labelled") + 2)
        error = F.sqrt(rate * (1 - rate) / (F.col("labelled") + 1))
        alike = (F.abs(own - rate) <= z * error) & (F.col("n") < F.col("p_n"))
        rare = F.col("n") < min_share * F.col("p_n")
        merged = F.when(F.col("seg") == "", "").when(F.col("seg").contains("{n}") | F.col("seg").startswith("{*"), F.col("seg")).when(rare | alike, "{*}").otherwise(F.col("seg"))
        names = branch.join(parent, ["host", "template"]).select("host", "template", "seg", merged.alias("as"))
        table = table.join(names, ["host", "template", "seg"]).withColumn("template", F.when(F.col("as") == "", F.col("template")).otherwise(F.concat("template", F.array("as")))).drop("as", "seg")
        table = materialize(table)  # the next level reads it three times
    return table


def purity(tree: DataFrame, prior: float = 20.0, min_purity: float = 0.5, min_labels: int = 10) -> DataFrame:
    """(host, template, n, labelled, good, purity, reject)."""
    total = tree.agg(((F.sum("good") + 1) / (F.sum("labelled") + 2)).alias("overall"))  # one row
    by = tree.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "good")])
    by = by.join(F.broadcast(total), F.lit(True), "inner")
    smooth = (F.col("good") + prior * F.col("overall")) / (F.col("labelled") + prior)
    return by.select("host", "template", "n", "labelled", "good", smooth.alias("purity"), F.coalesce((smooth < min_purity) & (F.col("labelled") >= min_labels), F.lit(False)).alias("reject"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, **how) -> DataFrame:
    """(page_id, host, path, rule, template, verdict), one row a page."""
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    base = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    base = base.select("*", rule.alias("rule"), verdict.alias("ruled"), segments(F.col("path")).alias("segs"), F.expr("try_cast(regexp_extract(path, '([0-9]+)', 1) AS BIGINT)").alias("number"))
    known = good_labels(labels)
    # A host may hold a third of all pages: counts are summed by distinct (host, segments) before anything else.
    counted = base.join(known, base["number"] == known["doc_id"], "left").groupBy("host", "segs").agg(F.count("*").alias("n"), F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    tree = templates(counted)
    verdicts = tree.join(purity(tree, **how).select("host", "template", "reject"), ["host", "template"]).select("host", "segs", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "reject")
    done = base.join(verdicts, ["host", "segs"], "left")
    return done.select("page_id", "host", "path", "rule", "template", F.coalesce("ruled", F.when(F.coalesce("reject", F.lit(False)), "block").otherwise("allow")).alias("verdict"))


def oracle_sql(rules=RULES, depth: int = DEPTH, min_share: float = 0.01, z: float = 2.0, prior: float = 20.0, min_purity: float = 0.5, min_labels: int = 10) -> str:
    """The rows of `judge` in DuckDB's SQL; a template is kept as one string."""
    fits = lambda d, rest: f"(host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '/{rest}')"
    ordered = sorted(rules, key=lambda r: (len(r[0]), r[0]), reverse=True)
    case = lambda pick: "CASE " + " ".join(f"WHEN {fits(r[0].partition('/')[0], r[0].partition('/')[2])} THEN '{r[pick]}'" for r in ordered) + " END"
    levels = []
    for i in range(depth + 1):
        levels.append(f"""t{i}s AS (SELECT *, coalesce(segs[{i + 1}], '') AS seg FROM t{i}),
b{i} AS (SELECT host, tpl, seg, sum(n) AS n, sum(labelled) AS labelled, sum(good) AS good FROM t{i}s GROUP BY 1, 2, 3),
p{i} AS (SELECT host, tpl, sum(n) AS pn, (sum(good) + 1)::DOUBLE / (sum(labelled) + 2) AS rate FROM b{i} GROUP BY 1, 2),
m{i} AS (SELECT host, tpl, seg, CASE WHEN seg = '' THEN '' WHEN contains(seg, '{{n}}') OR starts_with(seg, '{{*') THEN seg
 WHEN n < {min_share} * pn OR abs((good + 1)::DOUBLE / (labelled + 2) - rate) <= {z} * sqrt(rate * (1 - rate) / (labelled + 1)) AND n < pn THEN '{{*}}' ELSE seg END AS nm FROM b{i} JOIN p{i} USING (host, tpl)),
t{i + 1} AS (SELECT host, segs, n, labelled, good, CASE WHEN nm = '' THEN tpl ELSE tpl || '/' || nm END AS tpl FROM t{i}s JOIN m{i} USING (host, tpl, seg))""")
    return f"""WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
s AS (SELECT *, {case(0)} AS rule, {case(1)} AS ruled, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: regexp_replace(x, '[0-9]+', '{{n}}', 'g')) AS parts, try_cast(regexp_extract(path, '([0-9]+)', 1) AS BIGINT) AS number FROM u),
base AS (SELECT page_id, host, path, rule, ruled, number, CASE WHEN len(parts) > {depth} THEN list_append(parts[1:{depth}], '{{**}}') ELSE parts END AS segs FROM s),
known AS (SELECT doc_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS ok FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
t0 AS (SELECT host, segs, count(*) AS n, count(ok) AS labelled, coalesce(sum(ok), 0) AS good, '' AS tpl FROM base LEFT JOIN known ON number = doc_id GROUP BY 1, 2),
{",".join(levels)},
o AS (SELECT (sum(good) + 1)::DOUBLE / (sum(labelled) + 2) AS overall FROM t{depth + 1}),
v AS (SELECT host, tpl, (sum(good) + {prior} * any_value(overall)) / (sum(labelled) + {prior}) < {min_purity} AND sum(labelled) >= {min_labels} AS reject FROM t{depth + 1}, o GROUP BY 1, 2)
SELECT page_id, base.host, path, rule, CASE WHEN tpl = '' THEN '/' ELSE tpl END AS template, coalesce(ruled, CASE WHEN reject THEN 'block' ELSE 'allow' END) AS verdict
FROM base JOIN (SELECT host, segs, tpl, reject FROM t{depth + 1} JOIN v USING (host, tpl)) AS w ON base.host = w.host AND base.segs = w.segs"""
