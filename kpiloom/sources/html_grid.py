"""First ``<table>`` of HTML documents as a grid: cells stand in every place their spans cover.

The documents are rows of a table, parsed where they lie.  A fold over the tags of each one fills the grid:

* ``rowspan`` / ``colspan`` repeat a cell's text; a rowspan of 0 reaches to the table's end, a span that is no number counts 1;
  spans above 65,534 rows or 1,000 columns count as these, the limits of HTML.
* A place that a cell from above holds stays that cell's; further columns of a wide cell go behind it.
* Tables inside a cell are skipped with all they hold, and so are scripts and styles.
* Character references, named or by number, are decoded; text is trimmed.  Closing tags may be missing.
* Rows without a place in the grid are left out; a document without a table, or a null, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType


def _first_grid():
    """text -> rows of the first table.  Made inside a function, so that executors need no package."""
    from html.parser import HTMLParser

    class Fold(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.depth, self.done, self.mute = 0, False, 0
            self.row, self.cell, self.spans = None, None, (1, 1)
            self.above: dict[int, tuple[str, int]] = {}  # column -> text and rows it still covers
            self.grid: list[list[str | None]] = []

        def handle_starttag(self, tag, attrs):
            if self.done:
                return
            if tag == "table":
                self.depth += 1
            elif tag in ("script", "style"):
                self.mute += 1
            elif self.depth == 1 and tag == "tr":
                self.end_row()
                self.row = []
            elif self.depth == 1 and tag in ("td", "th"):
                self.end_cell()
                given = dict(attrs)
                self.row = [] if self.row is None else self.row
                self.cell, self.spans = [], (self.span(given.get("rowspan"), 65534), max(1, self.span(given.get("colspan"), 1000)))

        def handle_endtag(self, tag):
            if self.done:
                return
            if tag == "table" and self.depth:
                if self.depth == 1:
                    self.end_row()
                    self.done = True
                self.depth -= 1
            elif tag in ("script", "style") and self.mute:
                self.mute -= 1
            elif self.depth == 1 and tag == "tr":
                self.end_row()
            elif self.depth == 1 and tag in ("td", "th"):
                self.end_cell()

        def handle_data(self, data):
            if self.depth == 1 and self.cell is not None and not self.mute and not self.done:
                self.cell.append(data)

        @staticmethod
        def span(text, most):
            text = (text or "").strip()
            return min(int(text), most) if text.isascii() and text.isdigit() and len(text) < 10 else most if text.isascii() and text.isdigit() else 1

        def end_cell(self):
            if self.cell is not None:
                self.row.append(("".join(self.cell).strip(), *self.spans))
                self.cell = None

        def end_row(self):
            self.end_cell()
            if self.row is None:
                return
            here = {c: text for c, (text, _) in self.above.items()}
            still = {c: (text, n - 1) for c, (text, n) in self.above.items() if n > 1}
            at = 0
            for text, down, across in self.row:
                for _ in range(across):
                    while at in here:
                        at += 1
                    here[at] = text
                    if down != 1:
                        still[at] = (text, (down or 1 << 40) - 1)
            self.above, self.row = still, None
            if here:
                self.grid.append([here.get(c) for c in range(max(here) + 1)])

    def grid(text):
        fold = Fold()
        fold.feed(text)
        fold.close()
        if not fold.done:
            fold.end_row()
        return fold.grid

    return grid


def html_grid(df: DataFrame, html_col: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``row_no`` (0 = header row), ``cells`` (text by column; null where no cell reaches) and ``head``, the document's first row."""
    keep = keep or []
    picked = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").alias("__html"))
    schema = StructType([picked.schema[c] for c in keep]).add("row_no", IntegerType()).add("cells", ArrayType(StringType())).add("head", ArrayType(StringType()))
    grid = _first_grid()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, text in enumerate(b["__html"]):
                rows = grid(text) if isinstance(text, str) else []
                for at in range(0, len(rows), 10_000):  # a long table leaves in parts
                    part = rows[at:at + 10_000]
                    out = pd.concat([b[keep].iloc[[i]]] * len(part), ignore_index=True) if keep else pd.DataFrame(index=range(len(part)))
                    out["row_no"], out["cells"] = range(at, at + len(part)), part
                    out["head"] = [rows[0]] * len(part)
                    yield out

    return picked.mapInPandas(run, schema)


def read_html_grid(df: DataFrame, html_col: str, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Rows below the header of each document's first table as named string columns.

    Names are looked up in the document's own header (lower case, blanks as ``_``; the first of equal names), which the
    parser gives with each row, so documents may order their columns differently; a name not there gives nulls.
    """
    keep = keep or []
    both = html_grid(df, html_col, keep).where("row_no > 0").withColumn(
        "head", F.transform("head", lambda c: F.regexp_replace(F.lower(c), " ", "_")))

    def named(name: str):
        at = F.array_position("head", name).cast("int")
        return F.when(at > 0, F.try_element_at("cells", at)).alias(name)

    return both.select(*keep, "row_no", *[named(c) for c in columns])
