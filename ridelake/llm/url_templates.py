"""URL filter by a tree of path templates (built-in expressions only).

Per host, paths are read segment by segment, as deep as any host has a segment value with
support. A value with at least ``MIN_SUPPORT`` pages under its parent stays a branch, all others become the
wildcard ``*``. Branches of one parent with the same labelled bad rate are one; in order of rates each then joins
the group so far, unless it differs from the group's pooled labels by more than chance
(two-proportion test), which opens a new group, written ``{a|b}``. Branches without labels
are merged among themselves. In names, ``* { } | +`` and the backslash of a literal segment have a backslash before them, so
no segment passes for a wildcard or a group. The templates at the ends collect the labels of their pages. One is rejected
when its bad rate, smoothed by its host's, and that by the whole table's, has odds of ``LIFT`` times the whole
table's or more, its rate lies above the table's by more than chance and ``MIN_LABELS`` labels bear witness. Explicit
rules come first.

Scale: only page_id, host, segments and label are kept (the html column is never
read). A level is one partial aggregate on (host, template, segment); values
without support are dropped before anything else, and the written table of branches
is joined back by its real size (broadcast, or sort-merge with AQE splitting a hot
host). A parent may keep any number of branches: what one task orders are its distinct
rates, of which a host with T labels has some T^(2/3) at most, never its branches. A group of more than ``NAMED``
is named by its first ones and the number of the others. Levels that no value with support reaches are wildcards
without a step of their own.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read, written

MIN_SUPPORT = 5          # pages that a branch has at least
NAMED = 50               # branches of a group that its name spells out
Z2 = 3.8416              # squared normal quantile of 95 %
STRENGTH = 5.0           # pseudo-labels of the smoothing
LIFT = 3.0               # odds of a rejected template, in those of the whole table
MIN_LABELS = 5           # labels that a rejected template has at least

# The rules (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruling(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, like ``org/``, and its verdict; null without one."""
    name = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


MARKS = r"([*{}|+\\])"      # what a name may not hold as it is


def _segment(k: int) -> Column:
    return F.get("segs", F.lit(k))


def _named(kept: DataFrame) -> DataFrame:
    """``host, template, seg, step``: the name of its group for each branch of ``kept`` (host, template, seg, group)."""
    by = ["host", "template", "group"]
    place = F.row_number().over(Window.partitionBy(*by).orderBy("seg"))
    first = kept.withColumn("place", place).where(F.col("place") <= NAMED)
    names = first.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list("seg")), lambda x: F.regexp_replace(x, MARKS, r"\\$1")).alias("segs"))
    names = names.join(kept.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), by)
    more = F.when(F.col("n") > NAMED, F.concat(F.lit("|+"), (F.col("n") - NAMED).cast("string"))).otherwise("")
    name = F.when(F.col("n") > 1, F.concat(F.lit("{"), F.array_join("segs", "|"), more, F.lit("}"))).otherwise(F.get("segs", F.lit(0)))
    return kept.join(names.select(*by, name.alias("step")), by).select("host", "template", "seg", "step")


def _differ(m1: Column, b1: Column, m2: Column, b2: Column) -> Column:
    """Whether two shares (b of m) differ by more than chance."""
    gap = b1 * m2 - b2 * m1
    return gap * gap * (m1 + m2) > F.lit(Z2) * m1 * m2 * (b1 + b2) * ((m1 + m2) - (b1 + b2))


def _starts(kept: DataFrame) -> DataFrame:
    """``host, template, starts``: the rates at which a parent's groups begin, in order."""
    by = ["host", "template"]
    rates = kept.where("m > 0").groupBy(*by, "rate").agg(F.sum("m").cast("double").alias("m"), F.sum("b").cast("double").alias("b"))
    along = rates.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("rate", "m", "b"))).alias("along"))
    none = F.struct(F.lit(0.0).alias("m"), F.lit(0.0).alias("b"), F.array().cast("array<double>").alias("starts"))

    def step(group: Column, x: Column) -> Column:
        new = (group["m"] == 0) | _differ(group["m"], group["b"], x["m"], x["b"])
        return F.when(new, F.struct(x["m"].alias("m"), x["b"].alias("b"), F.array_append(group["starts"], x["rate"]).alias("starts"))).otherwise(
            F.struct((group["m"] + x["m"]).alias("m"), (group["b"] + x["b"]).alias("b"), group["starts"].alias("starts")))

    return along.select(*by, F.aggregate("along", none, step, lambda g: g["starts"]).alias("starts"))


def _branches(rows: DataFrame, k: int) -> DataFrame:
    """``h, t, s, step``: the branches that ``rows`` keep at level ``k``."""
    seg = _segment(k)
    here = rows.where(seg.isNotNull()).select("host", "template", seg.alias("seg"), "bad")
    found = here.groupBy("host", "template", "seg").agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("m"), F.sum("bad").alias("b"))
    kept = found.where(F.col("n") >= MIN_SUPPORT).withColumn("b", F.coalesce("b", F.lit(0)))
    kept = written(kept.withColumn("rate", F.try_divide(F.col("b").cast("double"), F.col("m"))), "url-found")
    # 0: no label; else the number of groups that begin at or below the branch's rate
    group = F.coalesce(F.size(F.filter("starts", lambda x: x <= F.col("rate"))), F.lit(0))
    grouped = kept.join(_starts(kept), ["host", "template"], "left").select(
        "host", "template", "seg", F.when(F.col("m") > 0, group).otherwise(0).alias("group"))
    return written(_named(written(grouped, "url-groups")), "url-branches").withColumnsRenamed({"host": "h", "template": "t", "seg": "s"})


def _placed(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` with ``step``, their branch at level ``k`` or null."""
    kept = _branches(rows, k)
    rows = rows.join(kept, (rows["host"] == F.col("h")) & (rows["template"] == F.col("t")) & (_segment(k) == F.col("s")), "left")
    return rows.drop("h", "t", "s")


def templates(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, host, segs, bad) with ``template``; ``bad`` is 1, 0 or null (no label)."""
    size = F.coalesce(F.size("segs"), F.lit(0))
    # a branch has no more support than its value has at that level of the whole host
    able = pages.select("host", F.posexplode("segs").alias("at", "seg")).groupBy("host", "at", "seg").count().where(
        F.col("count") >= MIN_SUPPORT).select("at").distinct()
    rows, done = pages.withColumns({"template": F.lit(""), "told": F.lit(0)}), []      # told: levels in the template

    def ended(part: DataFrame) -> DataFrame:
        return part.withColumn("template", F.concat("template", F.repeat(F.lit("/*"), size - F.col("told")))).drop("told")

    for nth, k in enumerate(sorted(r["at"] for r in able.collect())):
        done.append(ended(rows.where(size <= k)))
        rows = _placed(rows.where(size > k), k)
        path = F.concat("template", F.repeat(F.lit("/*"), F.lit(k) - F.col("told")), F.lit("/"), F.coalesce("step", F.lit("*")))
        rows = rows.withColumns({"template": path, "told": F.lit(k + 1)}).drop("step")
        if nth >= 2:
            rows = written(rows, "url-deep")
    return reduce(DataFrame.unionByName, [*done, ended(rows)])


def rejected(rows: DataFrame) -> DataFrame:
    """``host, template, reject`` of every template of ``rows`` (host, template, bad)."""
    leaf = rows.groupBy("host", "template").agg(F.count("bad").alias("m"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b"))
    host = leaf.groupBy("host").agg(F.sum("m").alias("hm"), F.sum("b").alias("hb"))
    every = leaf.agg(F.sum("m").alias("m"), F.sum("b").alias("b")).first()
    top = F.lit((every["b"] or 0) / every["m"] if every["m"] else 0.0)
    prior = (F.col("hb") + F.lit(STRENGTH) * top) / (F.col("hm") + F.lit(STRENGTH))
    rate = (F.col("b") + F.lit(STRENGTH) * prior) / (F.col("m") + F.lit(STRENGTH))
    more = F.col("b") - F.col("m") * top        # bad labels beyond the table's share
    reject = ((F.col("m") >= MIN_LABELS) & (rate * (F.lit(1.0) - top) >= F.lit(LIFT) * top * (F.lit(1.0) - rate))
              & (more > 0) & (more * more > F.lit(Z2) * F.col("m") * top * (F.lit(1.0) - top)))
    return leaf.join(host, "host").select("host", "template", reject.alias("reject"))


def judge(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", label_id: str = "page_id") -> DataFrame:
    """``page_id, host, path, rule, verdict, template`` per row of ``pages``.

    ``labels``: ``label_id`` and ``bad`` (1 or 0); repeated labels of an id count as bad if any
    is. Null url, or one without ``://``: empty host, path and template, judged with its
    like. Null id: no label. Repeated rows each count. Without labels nothing is rejected."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    marks = labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("label_id")).agg(F.max("bad").cast("int").alias("bad"))
    rows = rows.join(marks, F.col("page_id") == F.col("label_id"), "left").drop("label_id")
    return judge_labelled(rows)


def judge_labelled(rows: DataFrame) -> DataFrame:
    """As ``judge``, for ``page_id, host, path, bad``."""
    segs = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = written(rows.withColumn("segs", segs), "url-rows")
    placed = written(templates(rows).select("page_id", "host", "path", "bad", "template"), "url-templates")
    bad = written(rejected(placed), "url-rejected").withColumnsRenamed({"host": "h", "template": "t"})
    name, verdict = ruling(F.col("host"), F.col("path"))
    out = placed.join(bad, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")), "left")
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(
        verdict, F.when(F.col("reject"), "block").otherwise("allow")).alias("verdict"), "template")


def _number(path: Column) -> Column:
    """The last number of a path, as the id of the document that the page shows."""
    return F.regexp_extract(path, r"([0-9]+)[^0-9]*$", 1).try_cast("long")


def op5_url_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    rows = read(spark, sf_dir, "pages").select("page_id", host.alias("host"), path.alias("path"))
    labels = read(spark, sf_dir, "labels").where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    rows = rows.withColumn("doc_id", _number(F.col("path"))).join(labels, "doc_id", "left").drop("doc_id")
    return judge_labelled(rows)


def _oracle() -> str:
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for _, h, p in RULES]
    order = sorted(range(len(RULES)), key=lambda k: -len(RULES[k][1] + RULES[k][2]))
    rule = "CASE " + " ".join(f"WHEN {fits[k]} THEN '{RULES[k][1] + RULES[k][2]}'" for k in order) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits[k]} THEN '{RULES[k][0]}'" for k in order) + " END"

    marked = r"\\\1"
    differ = f"(s.b * x.m - x.b * s.m) * (s.b * x.m - x.b * s.m) * (s.m + x.m) > {Z2}::DOUBLE * s.m * x.m * (s.b + x.b) * ((s.m + x.m) - (s.b + x.b))"
    return f"""
WITH RECURSIVE u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
marks AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
r AS (
  SELECT 0 AS k, page_id, host, path, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs, bad, '' AS template
  FROM v LEFT JOIN marks ON TRY_CAST(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) AS BIGINT) = doc_id
  UNION ALL (
  WITH here AS (SELECT *, segs[k + 1] AS seg FROM r WHERE len(segs) > k),
  found AS (SELECT host, template, seg, count(bad) AS m, coalesce(sum(bad), 0) AS b FROM here GROUP BY ALL HAVING count(*) >= {MIN_SUPPORT}),
  rated AS (SELECT *, b::DOUBLE / nullif(m, 0)::DOUBLE AS rate FROM found),
  rates AS (SELECT host, template, rate, sum(m)::DOUBLE AS m, sum(b)::DOUBLE AS b FROM rated WHERE m > 0 GROUP BY ALL),
  starts AS (SELECT host, template, list_reduce(list({{'m': m, 'b': b, 'starts': [rate]}} ORDER BY rate), lambda s, x: CASE WHEN {differ}
    THEN {{'m': x.m, 'b': x.b, 'starts': list_concat(s.starts, x.starts)}} ELSE {{'m': s.m + x.m, 'b': s.b + x.b, 'starts': s.starts}} END).starts AS starts
    FROM rates GROUP BY host, template),
  grouped AS (SELECT d.host, d.template, seg, CASE WHEN m > 0 THEN len(list_filter(starts, lambda x: x <= rate)) ELSE 0 END AS grp
    FROM rated d LEFT JOIN starts USING (host, template)),
  named AS (SELECT host, template, list(seg ORDER BY seg) AS found,
    list_transform((list(seg ORDER BY seg))[1:{NAMED}], lambda x: regexp_replace(x, '{MARKS}', '{marked}', 'g')) AS names FROM grouped GROUP BY host, template, grp),
  steps AS (SELECT host, template, unnest(found) AS seg, CASE WHEN len(found) > 1 THEN '{{' || array_to_string(names, '|')
    || CASE WHEN len(found) > {NAMED} THEN '|+' || (len(found) - {NAMED}) ELSE '' END || '}}' ELSE names[1] END AS step FROM named)
  SELECT k + 1, page_id, here.host, path, segs, bad, here.template || '/' || coalesce(step, '*') FROM here LEFT JOIN steps s
    ON here.host = s.host AND here.template = s.template AND here.seg = s.seg)),
t AS (SELECT * FROM r WHERE k = len(segs)),
leaf AS (SELECT host, template, count(bad) AS m, coalesce(sum(bad), 0) AS b FROM t GROUP BY ALL),
hosts AS (SELECT host, sum(m) AS hm, sum(b) AS hb FROM leaf GROUP BY host),
top AS (SELECT coalesce(sum(b)::DOUBLE / nullif(sum(m), 0)::DOUBLE, 0) AS g FROM leaf),
rate AS (SELECT leaf.host, template, m, b::DOUBLE - m::DOUBLE * g AS more, g, (b::DOUBLE + {STRENGTH}::DOUBLE * ((hb::DOUBLE + {STRENGTH}::DOUBLE * g) / (hm::DOUBLE + {STRENGTH}::DOUBLE)))
               / (m::DOUBLE + {STRENGTH}::DOUBLE) AS rate FROM leaf JOIN hosts ON leaf.host = hosts.host CROSS JOIN top),
bad AS (SELECT host, template, m >= {MIN_LABELS} AND rate * (1.0::DOUBLE - g) >= {LIFT}::DOUBLE * g * (1.0::DOUBLE - rate) AND more > 0
               AND more * more > {Z2}::DOUBLE * m::DOUBLE * g * (1.0::DOUBLE - g) AS reject FROM rate)
SELECT page_id, t.host, path, {rule.replace('host', 't.host')} AS rule,
       coalesce({verdict.replace('host', 't.host')}, CASE WHEN reject THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM t LEFT JOIN bad ON t.host = bad.host AND t.template = bad.template
"""


OP5_SQL = _oracle()
