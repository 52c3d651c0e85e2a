"""First ``<table>`` of HTML documents -> rows, with Spark regex functions.

Works on a column of HTML text (one document per row), so documents are
parsed in parallel where they live; no document is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The HTML character references decoded in cell text.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def cell_text(c: Column) -> Column:
    """Tags removed, entities decoded, blanks trimmed."""
    t = F.regexp_replace(c, r"(?s)<(?:[A-Za-z/!][^>]*)>", "")
    for ent, ch in ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return F.trim(t)


def html_table_rows(df: DataFrame, html_col: str, keep: list[str] | None = None) -> DataFrame:
    """Long form: ``keep`` columns, ``row_no`` (0 = header row) and ``cells`` (array of text)."""
    keep = keep or []
    table = F.regexp_extract(F.col(html_col), r"(?is)<table[^>]*>(.*?)</table>", 1)
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)
    exploded = df.select(*keep, F.posexplode(rows).alias("row_no", "_tr"))
    cells = F.regexp_extract_all(F.col("_tr"), F.lit(r"(?is)<t[hd][^>]*>(.*?)</t[hd]>"), 1)
    return exploded.select(*keep, "row_no", F.transform(cells, cell_text).alias("cells"))


def read_html_table(df: DataFrame, html_col: str, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Rows of each document's first table as named string columns.

    The first row is the header (names normalised: lower case, spaces ->
    ``_``); ``columns`` are looked up by name in each document's own header,
    so documents may order their columns differently.  A name missing from
    a header gives nulls.  Header and body travel in the same row, so there
    is no join: narrow projections plus one explode.  Each regex result is
    materialised as a column once and then reused.
    """
    keep = keep or []
    table = F.regexp_extract(F.col(html_col), r"(?is)<table[^>]*>(.*?)</table>", 1)
    step1 = df.select(*keep, F.regexp_extract_all(table, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1).alias("_rows"))
    cell_re = F.lit(r"(?is)<t[hd][^>]*>(.*?)</t[hd]>")
    head = F.transform(F.regexp_extract_all(F.element_at("_rows", 1), cell_re, 1),
                       lambda x: F.regexp_replace(F.lower(cell_text(x)), " ", "_"))
    body = F.slice("_rows", 2, F.greatest(F.size("_rows") - 1, F.lit(0)))
    step2 = step1.where(F.size("_rows") > 0).select(*keep, head.alias("_head"), body.alias("_body"))
    step3 = step2.select(*keep, "_head", F.posexplode("_body").alias("row_no", "_tr"))
    step4 = step3.select(*keep, "_head", "row_no",
                         F.transform(F.regexp_extract_all("_tr", cell_re, 1), cell_text).alias("_cells"))

    def pick(name):
        pos = F.array_position(F.col("_head"), name).cast("int")
        return F.when(pos > 0, F.try_element_at(F.col("_cells"), pos)).alias(name)
    return step4.select(*keep, "row_no", *[pick(n) for n in columns])


def table_html(rows_df: DataFrame, group_cols: list[str], columns: list[str], order_col: str) -> DataFrame:
    """Render one ``<table>`` per group (header + rows sorted by ``order_col``).

    Groups must be bounded in size by the caller (e.g. chunks of fixed row
    count): each group's rows become one string.
    """
    def esc(c: Column) -> Column:
        t = c.cast("string")
        for ent, ch in reversed(ENTITIES[:4] + ENTITIES[5:]):
            t = F.replace(t, F.lit(ch), F.lit(ent))
        return t

    head = "<tr>" + "".join(f"<th>{c}</th>" for c in columns) + "</tr>"
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), F.coalesce(esc(F.col(c)), F.lit("")), F.lit("</td>"))
                                    for c in columns], F.lit("</tr>"))
    grouped = rows_df.groupBy(*group_cols).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("_o"), row.alias("_h")))).alias("_rows"))
    body = F.array_join(F.transform(F.col("_rows"), lambda r: r["_h"]), "")
    return grouped.select(*group_cols, F.concat(F.lit(f"<html><body><table>{head}"), body,
                                                F.lit("</table></body></html>")).alias("html"))
