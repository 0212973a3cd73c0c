"""Operator 8 [native]: URL filter by a path-template tree, DataFrame functions only.

Rules come first: a rule fits its host and all subdomains if the path starts with the rule's path; the
longest one wins (of equally long ones the longer host). Their verdicts, and any given page labels, are the labelled
sample of the method, which judges the pages no rule fits:

1. per host, segments become shapes: digit runs turn into ``#``, long hexadecimal ids into ``#x``;
2. the branches below a parent become wildcards when they vary (at least ``many`` siblings, fewer than
   ``rare`` pages each), or when a two-sample z test tells neither their label rate nor their share of
   deeper pages from that of their siblings pooled. Labelled and unlabelled branches are never
   merged with one another, so evidence does not spread to a branch that has none of its own;
3. a template's purity is its block share smoothed towards one half by ``weight`` labels; it is rejected at
   ``purity`` or more.

All statistics are sums over (host, shape) pairs, made with partial aggregation; a hot host is one row per
shape after it. Pages meet their template in a join that AQE may split. Null URLs, and URLs without
``://``, have an empty host and path and are allowed unless labelled otherwise. Repeated rows stay; an
empty table gives an empty result; other columns are not carried."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path) of the production run.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url_host(url: Column) -> Column:
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(raw, upper, lower), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. The rules are a short, given list."""
    name = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _similar(part: str, whole: str, rest_part: Column, rest_whole: Column, z: float) -> Column:
    """Whether two shares are not told apart by a two-sample z test at ``z``."""
    a, n, rest_whole = F.col(part), F.nullif(F.col(whole), F.lit(0)), F.nullif(rest_whole, F.lit(0))
    pooled = (a + rest_part) / (n + rest_whole)
    gap = a / n - rest_part / rest_whole
    return F.coalesce(gap * gap <= z * z * pooled * (1 - pooled) * (1 / n + 1 / rest_whole), F.lit(True))


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, labels: DataFrame | None = None,
                 many: int = 10, rare: int = 5, z: float = 1.96, weight: float = 2.0, purity: float = 0.8,
                 id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page: id, host, path, rule, ``template``, ``template_purity`` and verdict. ``labels``
    (id, ``bad`` boolean) adds labelled pages to those the rules label."""
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    rule, said = longest_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).withColumns({"rule": rule, "said": said})
    rows = rows.withColumn("bad", F.when(F.col("said") == "block", 1).when(F.col("said") == "allow", 0))
    if labels is not None:
        given = labels.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col("bad").cast("int")).alias("_bad"))
        rows = rows.join(given, rows[id_col] == given["_id"], "left").withColumn("bad", F.coalesce("bad", "_bad")).drop("_id", "_bad")
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    shapes = F.transform(segments, lambda s: F.when(s.rlike("^[0-9a-f]{16,}$"), "#x").otherwise(F.regexp_replace(s, "[0-9]+", "#")))
    rows = rows.withColumn("segments", shapes).withColumn(
        "closed", F.when(F.col("path").endswith("/"), "/").otherwise(""))

    tree = rows.groupBy("host", "segments", "closed").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("blocked"))
    steps = tree.select("host", "segments", "closed", "n", "labelled", "blocked", F.posexplode("segments").alias("pos", "segment")).withColumns({
        "parent": F.array_join(F.slice("segments", 1, F.col("pos")), "/"),
        "deeper": F.when(F.col("pos") < F.size("segments") - 1, F.col("n")).otherwise(0)})
    branch = steps.groupBy("host", "parent", "segment").agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "blocked", "deeper")))
    branch = branch.withColumn("evidence", F.when(F.col("labelled") > 0, "+").otherwise(""))
    siblings = branch.groupBy("host", "parent", "evidence").agg(
        F.count("*").alias("branches"), *(F.sum(c).alias(f"all_{c}") for c in ("n", "labelled", "blocked", "deeper")))
    rest = {c: F.col(f"all_{c}") - F.col(c) for c in ("n", "labelled", "blocked", "deeper")}
    varies = (F.col("branches") >= many) & (F.col("n") < rare)
    alike = (_similar("blocked", "labelled", rest["blocked"], rest["labelled"], z)
             & _similar("deeper", "n", rest["deeper"], rest["n"], z))
    named = branch.join(siblings, ["host", "parent", "evidence"]).select(
        "host", "parent", "segment",
        F.when((F.col("branches") > 1) & (varies | alike), F.concat(F.lit("*"), "evidence")).otherwise(F.col("segment")).alias("name"))
    templates = steps.join(named, ["host", "parent", "segment"]).groupBy("host", "segments", "closed").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "name"))), lambda s: s["name"]), "/").alias("names"))
    shaped = tree.join(templates, ["host", "segments", "closed"], "left").withColumn(
        "template", F.when(F.size("segments") == 0, F.col("closed")).otherwise(F.concat(F.lit("/"), "names", "closed")))
    scores = shaped.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    scores = scores.select("host", "template", ((F.col("blocked") + weight / 2) / (F.col("labelled") + weight)).alias("template_purity"))
    judged = shaped.select("host", "segments", "closed", "template").join(scores, ["host", "template"])
    return rows.join(judged, ["host", "segments", "closed"]).select(
        F.col(id_col), "host", "path", "rule", "template", "template_purity",
        F.coalesce("said", F.when(F.col("template_purity") >= purity, "block").otherwise("allow")).alias("verdict"))


def oracle(rules: list[tuple[str, str, str]] = RULES) -> str:
    """The same verdicts in DuckDB SQL, with the default parameters."""
    cases = {0: "", 1: ""}
    for kind, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]))):
        fits = f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND path LIKE '{p}%'"
        cases[0] += f" {fits} THEN '{h}{p}'"
        cases[1] += f" {fits} THEN '{kind}'"
    similar = lambda a, n: (
        f"coalesce(CASE WHEN all_{n} - {n} = 0 OR {n} = 0 THEN NULL ELSE pow({a} / {n} - (all_{a} - {a}) / (all_{n} - {n}), 2) <= "
        f"1.96 * 1.96 * (all_{a} / all_{n}) * (1 - all_{a} / all_{n}) * (1 / {n} + 1 / (all_{n} - {n})) END, true)")
    return f"""
WITH parsed AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^(?:.*?)://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?:.*?)://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
ruled AS (SELECT *, CASE{cases[0]} END AS rule, CASE{cases[1]} END AS said FROM parsed),
rows_ AS (
  SELECT *, CASE said WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END AS bad, CASE WHEN path LIKE '%/' THEN '/' ELSE '' END AS closed,
         list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
           lambda s: CASE WHEN regexp_full_match(s, '[0-9a-f]{{16,}}') THEN '#x' ELSE regexp_replace(s, '[0-9]+', '#', 'g') END) AS segments FROM ruled),
tree AS (SELECT host, segments, closed, count(*) AS n, count(bad) AS labelled, coalesce(sum(bad), 0) AS blocked FROM rows_ GROUP BY ALL),
steps AS (
  SELECT *, segments[pos] AS segment, array_to_string(segments[1:pos - 1], '/') AS parent, CASE WHEN pos < len(segments) THEN n ELSE 0 END AS deeper
  FROM (SELECT *, unnest(range(1, len(segments) + 1)) AS pos FROM tree)),
branch AS (
  SELECT host, parent, segment, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked, sum(deeper) AS deeper,
         CASE WHEN sum(labelled) > 0 THEN '+' ELSE '' END AS evidence FROM steps GROUP BY host, parent, segment),
siblings AS (
  SELECT host, parent, evidence, count(*) AS branches, sum(n) AS all_n, sum(labelled) AS all_labelled, sum(blocked) AS all_blocked,
         sum(deeper) AS all_deeper FROM branch GROUP BY host, parent, evidence),
named AS (
  SELECT host, parent, segment, CASE WHEN branches > 1 AND ((branches >= 10 AND n < 5) OR ({similar('blocked', 'labelled')} AND {similar('deeper', 'n')}))
         THEN '*' || evidence ELSE segment END AS name FROM branch JOIN siblings USING (host, parent, evidence)),
templates AS (
  SELECT host, segments, closed, '/' || string_agg(name, '/' ORDER BY pos) || closed AS template
  FROM steps JOIN named USING (host, parent, segment) GROUP BY host, segments, closed),
shaped AS (
  SELECT tree.host, tree.segments, tree.closed, labelled, blocked, coalesce(template, tree.closed) AS template
  FROM tree LEFT JOIN templates USING (host, segments, closed)),
scores AS (SELECT host, template, (sum(blocked) + 1.0) / (sum(labelled) + 2.0) AS purity FROM shaped GROUP BY host, template)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN purity >= 0.8 THEN 'block' ELSE 'allow' END) AS verdict
FROM rows_ JOIN shaped USING (host, segments, closed) JOIN scores USING (host, template)"""
