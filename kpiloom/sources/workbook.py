"""Sheets of workbooks (zipped XML, ``.xlsx``) as tables.

A workbook is a row with its bytes (Spark's binary-file source, so any file system works).  Each sheet is a table of its own and a scan
of its own: the task that reads it opens the zip, and streams the rows of that sheet only.  Values come as text:

* shared, inline and formula texts as they are, booleans as true / false, errors (``#N/A`` ...) as null, numbers as the file writes them;
* numbers in a date format as ISO date, or date and time (the 1900 and 1904 calendars), a format of hours only as a time of day;
* merged cells hold a value in their first place only, as in the file; ``fill_merged`` repeats it over the range.

Rows without any value are left out.  The first row of a sheet is its header: blank names become ``Unnamed: i`` (i from 0), a name that
came before, in any spelling, gets ``.1``, ``.2`` ...  Rows wider than the header add unnamed columns.  An empty sheet is a table without columns.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from kpiloom.sources.typed_csv import find_types, typed

log = logging.getLogger(__name__)
ROWS = 10_000


def _reader():
    """(bytes, sheet or None, fill merged) -> (sheet, position, row_no, cells).  Made inside a function, so that executors need no package."""
    import io
    import posixpath
    import re
    import zipfile
    from datetime import datetime, timedelta
    from xml.etree.ElementTree import iterparse, parse

    def local(tag):
        return tag.rpartition("}")[2]

    def column(ref):
        n = 0
        for ch in re.match("[A-Za-z]*", ref)[0].upper():
            n = 26 * n + ord(ch) - 64
        return n - 1

    def text_in(node):  # the runs of a rich text, without its phonetic hints
        return "".join(t.text or "" for e in node for t in ([e] if local(e.tag) == "t" else e if local(e.tag) == "r" else []) if local(t.tag) == "t")

    def date_kind(fmt, custom):
        """0 a number, 1 a date, 2 a time of day."""
        if fmt in custom:
            code = re.sub(r'"[^"]*"|\\.|\[(?!h+\]|m+\]|s+\])[^\]]*\]|_.|\*.', "", custom[fmt].lower()).split(";")[0]
            return 1 if re.search("[dy]", code) else 2 if re.search("[hs]", code) else 1 if "m" in code else 0
        return 1 if 14 <= fmt <= 17 or fmt == 22 or 27 <= fmt <= 36 or 50 <= fmt <= 58 else 2 if 18 <= fmt <= 21 or 45 <= fmt <= 47 else 0

    def when(value, kind, start):
        days = float(value)
        if kind == 2 and 0 <= days < 1:
            return (datetime(2000, 1, 1) + timedelta(seconds=round(days * 86400))).strftime("%H:%M:%S")
        if start == datetime(1899, 12, 30) and days < 60:  # that calendar has a 29 February 1900
            days += 1
        at = start + timedelta(seconds=round(days * 86400))
        return at.isoformat(" ") if at.time() != datetime.min.time() else at.date().isoformat()

    def rows(content, wanted, fill):
        z = zipfile.ZipFile(io.BytesIO(content))
        here = set(z.namelist())
        book = parse(z.open("xl/workbook.xml")).getroot()
        links = {e.get("Id"): e.get("Target") for e in parse(z.open("xl/_rels/workbook.xml.rels")).getroot()}
        start, sheets = datetime(1899, 12, 30), []
        for e in book.iter():
            if local(e.tag) == "workbookPr" and e.get("date1904") in ("1", "true"):
                start = datetime(1904, 1, 1)
            elif local(e.tag) == "sheet":
                link = next(v for k, v in e.attrib.items() if k.endswith("}id"))
                target = links[link]
                sheets.append((e.get("name"), target.lstrip("/") if target.startswith("/") else posixpath.normpath("xl/" + target)))
        shared, kinds = [], []
        if "xl/sharedStrings.xml" in here:
            for _, e in iterparse(z.open("xl/sharedStrings.xml")):
                if local(e.tag) == "si":
                    shared.append(text_in(e))
                    e.clear()
        if "xl/styles.xml" in here:
            styles = parse(z.open("xl/styles.xml")).getroot()
            custom = {int(e.get("numFmtId")): e.get("formatCode") for e in styles.iter() if local(e.tag) == "numFmt"}
            kinds = [date_kind(int(x.get("numFmtId", 0)), custom) for e in styles.iter() if local(e.tag) == "cellXfs" for x in e]
        for position, (name, part) in enumerate(sheets):
            if wanted is not None and name != wanted or "worksheets/" not in part:
                continue
            covers = []
            if fill:
                for _, e in iterparse(z.open(part)):
                    if local(e.tag) == "mergeCell":
                        a, _, b = e.get("ref").partition(":")
                        covers.append((int(re.search("[0-9]+", a)[0]), column(a), int(re.search("[0-9]+", b or a)[0]), column(b or a)))
                    elif local(e.tag) == "row":
                        e.clear()
            covers.sort()
            live, upcoming, number, row_no, sent = [], 0, 0, 0, False

            def spread(no, cells):
                nonlocal live, upcoming
                while upcoming < len(covers) and covers[upcoming][0] <= no:
                    if covers[upcoming][0] == no:
                        live.append((covers[upcoming], cells.get(covers[upcoming][1])))
                    upcoming += 1
                live = [(c, v) for c, v in live if c[2] >= no]
                for (_, left, _, right), value in live:
                    if value is not None:
                        cells.update({c: value for c in range(left, right + 1)})
                return cells

            def finished(no, cells):
                nonlocal row_no, sent
                if cells:
                    sent = True
                    row_no += 1
                    return [(name, position, row_no - 1, [cells.get(c) for c in range(max(cells) + 1)])]
                return []

            for _, e in iterparse(z.open(part)):
                if local(e.tag) != "row":
                    continue
                no, cells, at = int(e.get("r") or number + 1), {}, -1
                for gap in range(number + 1, no) if fill and (live or upcoming < len(covers)) else ():
                    if not live and (upcoming >= len(covers) or covers[upcoming][0] >= no):
                        break
                    yield from finished(gap, spread(gap, {}))
                number = no
                for c in e:
                    at = column(c.get("r")) if c.get("r") else at + 1
                    kind, inner = c.get("t", "n"), {local(x.tag): x for x in c}
                    if kind == "inlineStr":
                        value = text_in(inner["is"]) if "is" in inner else None
                    else:
                        value = inner["v"].text if "v" in inner else None
                        if value is not None and kind == "s":
                            value = shared[int(value)]
                        elif value is not None and kind == "b":
                            value = "true" if value == "1" else "false"
                        elif kind == "e":
                            value = None
                        elif value is not None and kind == "n" and int(c.get("s", 0)) < len(kinds) and kinds[int(c.get("s", 0))]:
                            value = when(value, kinds[int(c.get("s", 0))], start)
                    if value is not None and value != "":
                        cells[at] = value
                e.clear()
                yield from finished(no, spread(no, cells) if fill else cells)
            while fill and (live or upcoming < len(covers)) and number < max(c[2] for c in covers):  # ranges below the last row
                number += 1
                yield from finished(number, spread(number, {}))
            if not sent:
                yield name, position, 0, []

    return rows


def sheet_rows(books: DataFrame, content: str = "content", sheet: str | None = None, keep: list[str] | None = None,
               fill_merged: bool = False) -> DataFrame:
    """``keep`` columns, ``sheet``, ``position``, ``row_no`` (0 = header) and ``cells``, of one sheet or all; an empty sheet has an empty header."""
    keep = keep or []
    picked = books.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{content}`").alias("__book"))
    schema = (StructType([picked.schema[c] for c in keep]).add("sheet", StringType()).add("position", IntegerType())
              .add("row_no", IntegerType()).add("cells", ArrayType(StringType())))
    rows, most = _reader(), ROWS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, book in enumerate(b["__book"]):
                part = []

                def out():
                    own = pd.concat([b[keep].iloc[[i]]] * len(part), ignore_index=True) if keep else pd.DataFrame(index=range(len(part)))
                    for n, name in enumerate(("sheet", "position", "row_no", "cells")):
                        own[name] = [r[n] for r in part]
                    return own

                for r in rows(bytes(book), sheet, fill_merged) if book is not None else ():
                    part.append(r)
                    if len(part) == most:
                        yield out()
                        part.clear()
                if part:
                    yield out()

    return picked.mapInPandas(run, schema)


def header_names(cells: list[str | None]) -> list[str]:
    taken, out = set(), []
    for i, c in enumerate(cells):
        own = name = c if c else f"Unnamed: {i}"
        n = 0
        while name.lower() in taken:
            n += 1
            name = f"{own}.{n}"
        taken.add(name.lower())
        out.append(name)
    return out


def read_sheet(books: DataFrame, sheet: str, names: list[str], content: str = "content", keep: list[str] | None = None,
               fill_merged: bool = False) -> DataFrame:
    """The rows below the header of that sheet of each workbook, cells by position as text columns of the names given."""
    rows = sheet_rows(books, content, sheet, keep, fill_merged=fill_merged).where("row_no > 0")
    return rows.select(*(keep or []), *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_workbook(spark: SparkSession, path: str, prefix: str | None = None, existing: set[str] | None = None, sheets: list[str] | None = None,
                  typing: bool = True, fill_merged: bool = False) -> tuple[dict[str, DataFrame], list[str]]:
    """One table per sheet of a workbook file, or of those named: ``prefix_sheet`` when several are taken, ``prefix`` when one, the sheet's name
    without a prefix.  Names in ``existing`` (case-insensitive) are skipped.  Returns (tables, skipped).  typing: columns take the type
    all their values have."""
    books = spark.read.format("binaryFile").load(path).select("content")
    header = F.max(F.when(F.col("row_no") == 0, F.col("cells"))).alias("cells")
    every = sheet_rows(books, fill_merged=fill_merged).groupBy("sheet", "position").agg(header, F.max(F.size("cells")).alias("width"))
    heads = every.orderBy("position").collect()  # one row a sheet
    missing = set(sheets or []) - {r.sheet for r in heads}
    if missing:
        raise ValueError(f"no sheets named {sorted(missing)}")
    heads = [r for r in heads if sheets is None or r.sheet in sheets]
    taken = {n.lower() for n in (existing or set())}
    tables, skipped = {}, []
    for r in heads:
        name = r.sheet if not prefix else prefix if len(heads) == 1 else f"{prefix}_{r.sheet}"
        if name.lower() in taken:
            log.warning("table %r already exists; sheet %r skipped", name, r.sheet)
            skipped.append(name)
            continue
        taken.add(name.lower())
        names = header_names([*r.cells, *[None] * (r.width - len(r.cells))])
        df = read_sheet(books, r.sheet, names, fill_merged=fill_merged)
        tables[name] = typed(df, find_types(df, names))[0] if typing and names else df
    return tables, skipped
