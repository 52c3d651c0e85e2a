"""URL filters by a path-template tree, in DataFrame operations only.

Every url is cut into host and path.  Explicit rules (a host with its
subdomains and a path prefix) decide first, the longest that fits.  Their
verdicts are the labels from which the method learns the rest:

1.  Segments are written by shape: numbers, dates and hex codes stand as
    {n}, {d}, {x}, so that ids do not make a branch each.
2.  Level by level, per host and template prefix, a segment becomes the
    wildcard * if it is rare among its siblings (a variable), or if it is
    statistically similar to them: the same dominant form of what follows, and
    a labelled block rate that a z test does not tell from theirs.  The levels
    go on while any path has a further segment; a template of fewer than
    ``RARE_ROWS`` pages is not told apart further, what lies deeper is one **.
3.  A template is rejected if its block rate, smoothed by ``WEIGHT`` rows at
    its host's rate, and that by as many at the overall rate, reaches ``PURITY``.

All steps are aggregations over distinct (host, shapes), which Spark combines
before the shuffle, so a host with a third of all pages costs no more rows than
it has different templates; the joins are plain equi-joins that adaptive
execution splits.  Each level is written and reads the rest that the one before
left, so there are as many rounds as segments that ``RARE_ROWS`` pages share.  Null urls, and those without ://, have empty host and path
and are judged like any other template.  Rows that repeat are judged alike; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RARE_SHARE, RARE_ROWS = 0.02, 3
Z_SIMILAR = 2.0
WEIGHT, PURITY = 10.0, 0.8
FORMS = ("", "number", "word", "mixed")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(u, at, 1), UPPER, LOWER), F.regexp_extract(u, at, 2)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls.  rules: (allow or block, host + path prefix)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is put on last and so asked first
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest if "/" in text else "")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def shape(segment: Column) -> Column:
    return (F.when(segment.rlike("^[0-9]+$"), "{n}")
            .when(segment.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "{d}")
            .when(segment.rlike("^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), "{x}")
            .otherwise(F.regexp_replace(segment, "[0-9]+", "{n}")))


def form(segment: Column) -> Column:
    """Index into FORMS: nothing, a number or code, a word, or both."""
    return (F.when(segment == "", 0).when(segment.rlike(r"^\{[ndx]\}$"), 1).when(segment.contains("{"), 3).otherwise(2))


def _level(paths: DataFrame, level: int) -> DataFrame:
    """paths with the template ``t`` one segment longer, and ``ended``: the path or its template has no further one."""
    seg, after = F.get("s", F.lit(level)), F.coalesce(F.get("s", F.lit(level + 1)), F.lit(""))
    paths = paths.withColumn("seg", seg)
    plain = ["n", "known", "blocked", *[f"f{i}" for i in range(len(FORMS))]]
    child = paths.groupBy("host", "t", "seg").agg(*[F.sum(c).alias(c) for c in plain[:3]], *[
        F.sum(F.when(form(after) == i, F.col("n")).otherwise(0)).alias(f"f{i}") for i in range(len(FORMS))])
    parent = child.groupBy("host", "t").agg(*[F.sum(c).alias(f"p_{c}") for c in plain])

    def main(prefix: str) -> Column:  # the most frequent form, the first of equals
        return F.array_position(F.array(*[F.col(f"{prefix}f{i}") for i in range(len(FORMS))]),
                                F.greatest(*[F.col(f"{prefix}f{i}") for i in range(len(FORMS))]))

    pool = F.col("p_blocked") / F.col("p_known")
    z = F.abs(F.col("blocked") / F.col("known") - pool) / F.sqrt(pool * (1 - pool) / F.col("known"))
    rare = (F.col("n") < RARE_ROWS) | (F.col("n") < RARE_SHARE * F.col("p_n"))
    alike = (main("") == main("p_")) & ((F.col("known") == 0) | (F.col("p_known") == F.col("p_blocked"))
                                        | (F.col("p_blocked") == 0) | F.coalesce(z < Z_SIMILAR, F.lit(True)))
    only = F.col("n") == F.col("p_n")  # no siblings: nothing to generalise over
    few = F.col("p_n") < RARE_ROWS
    named = child.join(parent, ["host", "t"]).select("host", "t", "seg", few.alias("few"), F.when(F.col("seg") == "", "").when(few, "**").when(only & ~F.col("seg").contains("{"), F.col("seg"))
                                                    .when(rare | alike, "*").otherwise(F.col("seg")).alias("name"))
    out = paths.join(named, ["host", "t", "seg"])
    return out.select("host", "s", "n", "known", "blocked", F.concat("t", F.lit("/"), "name").alias("t"),
                      ((F.col("name") == "**") & F.col("few") | (F.size("s") <= level + 1)).alias("ended"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, template, purity): template and purity are the tree's, also where a rule decides."""
    host, path = host_and_path(F.col(f"`{url}`"))
    p = pages.select(F.col(f"`{key}`").alias(key), host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parts = F.split(F.regexp_replace("path", "^/", ""), "/")
    p = p.select(key, "host", "path", rule.alias("rule"), verdict.alias("said"), F.array_append(F.transform(parts, shape), "").alias("s"))
    paths = p.groupBy("host", "s").agg(F.count("*").alias("n"), F.count("said").alias("known"), F.sum(F.when(F.col("said") == "block", 1).otherwise(0)).alias("blocked"))
    open_paths, done, level = stored(paths.withColumn("t", F.lit("")), "url-shapes"), [], 0
    total = open_paths.agg(F.sum("known"), F.sum("blocked")).first()
    rate = total[1] / total[0] if total[0] else 0.0
    while True:
        now = stored(_level(open_paths, level), "url-level")
        done.append(now.where("ended"))
        open_paths, level = now.where("not ended").drop("ended"), level + 1
        if open_paths.isEmpty():
            break
    template = F.regexp_replace("t", "/+$", "")
    paths = stored(reduce(DataFrame.unionByName, done).select("host", "s", template.alias("template"), "known", "blocked"), "url-templates")
    near = paths.groupBy("host").agg(((F.sum("blocked") + F.lit(WEIGHT * rate)) / (F.sum("known") + F.lit(WEIGHT))).alias("near"))
    sums = paths.groupBy("host", "template").agg(F.sum("blocked").alias("b"), F.sum("known").alias("k")).join(near, "host")
    purity = sums.select("host", "template", ((F.col("b") + F.lit(WEIGHT) * F.col("near")) / (F.col("k") + F.lit(WEIGHT))).alias("purity"))
    own = ["host", "s"]
    judged = paths.join(purity, ["host", "template"]).select(*own, "template", "purity")
    return p.join(judged, own).select(
        key, "host", "path", "rule", F.coalesce("said", F.when(F.col("purity") >= PURITY, "block").otherwise("allow")).alias("verdict"), "template", "purity")
