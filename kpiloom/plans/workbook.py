"""A workbook of named sheets -- the workbench's state, on Spark.

A sheet is a named DataFrame with a type (``sql``, ``csv``, ``kpi``,
``scheme``), the statement that produces it, a status (``pending``,
``success``, ``failed``) and an error text.  The scheme sheet is always first
and re-read on every load.  All work is delegated to the Spark operators of
this package: SQL runs through :func:`run_sql` over views of the other
sheets, KPIs refresh in dependency order, views use :func:`search_any` and
:func:`page`, the status table is a roll-up, save / load use Parquet.
Sheets stay lazy DataFrames; nothing is collected.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.search import search_any
from kpiloom.operators.consolidate import Mapping, consolidate, mappings_for
from kpiloom.operators.paging import PAGE_SIZE, page
from kpiloom.plans.batch import kpi_order, status_rollup
from kpiloom.sources.catalog import view_names, register_sheets, run_sql
from kpiloom.sources.files import load_csv_table
from kpiloom.sources.scheme import SCHEME_SHEET, load_scheme
from kpiloom.sources.sinks import load_workspace, save_workspace


@dataclass
class Sheet:
    name: str
    type: str
    query: str | None = None
    df: DataFrame | None = None
    status: str = "pending"
    error: str | None = None
    deps: list[str] = field(default_factory=list)


class Workbook:
    def __init__(self, spark: SparkSession, scheme_path: str | None = None):
        self.spark = spark
        self.scheme_path = scheme_path
        self.sheets: dict[str, Sheet] = {}
        self._load_scheme()

    # ------------------------------------------------------------ sheets
    def _load_scheme(self) -> None:
        scheme = Sheet(SCHEME_SHEET, "scheme", df=load_scheme(self.spark, self.scheme_path), status="success")
        self.sheets = {SCHEME_SHEET: scheme, **{k: v for k, v in self.sheets.items() if k != SCHEME_SHEET}}

    def _new_name(self, name: str) -> str:
        if name.lower() in {n.lower() for n in self.sheets}:
            raise ValueError(f"a sheet named {name!r} already exists")
        return name

    def add_sql(self, name: str, sql: str) -> Sheet:
        """A SQL sheet, pending until :meth:`run` / :meth:`refresh`."""
        sheet = Sheet(self._new_name(name), "sql", query=sql)
        self.sheets[name] = sheet
        return sheet

    def add_table(self, name: str, df: DataFrame, type: str = "csv") -> Sheet:
        sheet = Sheet(self._new_name(name), type, df=df, status="success")
        self.sheets[name] = sheet
        return sheet

    def add_csv(self, path: str, name: str | None = None) -> Sheet:
        table, df = load_csv_table(self.spark, path, name, existing=set(self.sheets))
        return self.add_table(table, df, "csv")

    def add_kpi(self, name: str, sql: str, deps: list[str] | None = None) -> Sheet:
        """A KPI: SQL over other sheets; ``deps`` names the KPIs it reads."""
        sheet = Sheet(self._new_name(name), "kpi", query=sql, deps=list(deps or []))
        self.sheets[name] = sheet
        return sheet

    def _deps(self, sheet: Sheet) -> list[str]:
        """Declared dependencies, else the other KPI sheets whose name (any
        view-name variant) appears as a word in the statement."""
        if sheet.deps:
            return sheet.deps
        found = []
        for name, other in self.sheets.items():
            if other.type != "kpi" or name == sheet.name:
                continue
            if any(re.search(rf"(?i)(?<![\w`]){re.escape(v)}(?![\w`])", sheet.query or "")
                   for v in view_names(name)):
                found.append(name)
        return found

    def _views(self) -> None:
        register_sheets({n: s.df for n, s in self.sheets.items() if s.df is not None})

    def run(self, name: str) -> Sheet:
        """(Re)build one SQL or KPI sheet from its statement; errors are recorded, not raised."""
        sheet = self.sheets[name]
        if sheet.query is None:
            return sheet
        self._views()
        df, err = run_sql(self.spark, sheet.query)
        sheet.df, sheet.error = df, err
        sheet.status = "failed" if err else "success"
        return sheet

    def refresh(self) -> DataFrame:
        """Data sheets first, then every KPI once, dependencies first; returns the status table."""
        self._load_scheme()
        for name, sheet in self.sheets.items():
            if sheet.type == "sql":
                self.run(name)
        kpis = {n: self._deps(s) for n, s in self.sheets.items() if s.type == "kpi"}
        for name in kpi_order(kpis):
            self.run(name)
        return self.status()

    # ------------------------------------------------------------- views
    def view(self, name: str, search: str | None = None, page_no: int = 1, size: int = PAGE_SIZE,
             order: list[str] | None = None) -> DataFrame:
        """One page of a sheet, optionally searched (any column, case-insensitive)."""
        df = self.sheets[name].df
        if df is None:
            raise ValueError(f"sheet {name!r} has no data ({self.sheets[name].status})")
        rows = search_any(df, search)
        cols = order or df.columns
        return page(rows, [F.col(f"`{c}`") for c in cols], page_no, size)

    def status(self) -> DataFrame:
        """name, type, status, error for every sheet (a small table built from the workbook)."""
        rows = [(s.name, s.type, s.status, s.error) for s in self.sheets.values()]
        return self.spark.createDataFrame(rows, "name string, type string, status string, error string")

    def status_counts(self) -> DataFrame:
        """total / success / failed / running by type plus the overall row (scheme excluded)."""
        return status_rollup(self.status())

    # ------------------------------------------------------ payout merge
    def merge(self, names: list[str] | None = None, mappings: list[Mapping] | None = None) -> DataFrame:
        """Payout per person over the KPI sheets (default: all successful KPIs,
        key / value columns detected, label = sheet name)."""
        if mappings is None:
            names = names or [n for n, s in self.sheets.items() if s.type == "kpi" and s.df is not None]
            mappings = [m for n in names for m in mappings_for(self.sheets[n].df, n)]
        return consolidate(mappings)

    # ----------------------------------------------------- persistence
    def save(self, root: str, workspace: str) -> DataFrame:
        return save_workspace(self.spark, root, workspace,
                              {n: (s.df, s.type, s.query, s.deps) for n, s in self.sheets.items()})

    @classmethod
    def load(cls, spark: SparkSession, root: str, workspace: str, scheme_path: str | None = None) -> "Workbook":
        """Saved sheets come back with their data; empty ones come back pending."""
        wb = cls(spark, scheme_path)
        meta, tables = load_workspace(spark, root, workspace)
        for r in meta.collect():          # one row per sheet: workbook metadata, not data
            wb.sheets[r.name] = Sheet(r.name, r.type, query=r.query, df=tables.get(r.name),
                                      status="success" if r.name in tables else "pending", deps=list(r.deps or []))
        return wb
