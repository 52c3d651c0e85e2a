"""Sinks: one dataset per report sheet plus a manifest, positional append,
CSV export, run-log append, and per-workspace save/load.

Everything is written by executors straight to the target folder (a shared
file system on a cluster); the driver only handles names and counts.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

# Suffix of a replaced folder while its successor takes its place.
OLD = "._old_"

MANIFEST_SCHEMA = StructType([
    StructField("sheet_name", StringType()), StructField("query_name", StringType()),
    StructField("row_count", LongType()), StructField("written_at", TimestampType()),
])


def sheet_name_for(query_name: str, mapping: dict[str, str] | None = None, limit: int | None = None) -> str:
    """Mapped sheet name, else the query name, as a folder name; ``limit`` cuts it only where a caller asks for it."""
    name = (mapping or {}).get(query_name) or query_name
    name = re.sub(r"[\\/?*\[\]:]", "_", name)
    return name[:limit] if limit else name


def refuse_shared_sheets(sheets: list[str]) -> None:
    """Two results for one sheet would overwrite each other."""
    twice = sorted({s for s in sheets if [x.lower() for x in sheets].count(s.lower()) > 1})
    if twice:
        raise ValueError(f"several results go to one sheet: {twice}")


def replace_folder(spark: SparkSession, new: str, target: str) -> None:
    """Put the finished folder ``new`` in the place of ``target``; until then, and if this fails, the old one can be read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old = f"{target}{OLD}{uuid.uuid4().hex}"
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = fs.exists(path(target))
    if not fs.exists(path(target).getParent()):
        fs.mkdirs(path(target).getParent())
    if held and not fs.rename(path(target), path(old)):
        raise OSError(f"cannot retire {target}")
    if not fs.rename(path(new), path(target)):
        if held:
            fs.rename(path(old), path(target))
        raise OSError(f"cannot put {new} in the place of {target}")
    if held:
        fs.delete(path(old), True)


def _staged(df: DataFrame, root: str, fmt: str = "parquet") -> tuple[str, int]:
    """Write to a run folder of its own below root: (folder, rows, counted from the written files)."""
    path = f"{root.rstrip('/')}/_runs/{uuid.uuid4().hex}"
    df.write.format(fmt).save(path)
    return path, df.sparkSession.read.schema(df.schema).format(fmt).load(path).count()


def write_sheet(df: DataFrame, root: str, sheet: str, fmt: str = "parquet") -> int:
    """Replace one sheet's dataset; returns its row count.  The rows are written to a run folder
    first, so a plan that fails leaves the earlier sheet as it was."""
    path, n = _staged(df, root, fmt)
    replace_folder(df.sparkSession, path, f"{root.rstrip('/')}/{sheet}")
    return n


def write_report(spark: SparkSession, results: list[tuple[str, DataFrame | None, str]], root: str,
                 mapping: dict[str, str] | None = None, overwrite: bool = True) -> DataFrame:
    """Write each successful result ``(query_name, df, status)`` to its sheet.

    ``overwrite=True`` replaces a sheet, ``False`` appends the rows below the
    existing ones (by position).  Failed results are skipped; other sheets
    under ``root`` are untouched.  Two results for one sheet are refused before
    anything is written.  The manifest rows of this run (rows written) are
    appended to ``root/_manifest`` and returned.
    """
    now = dt.datetime.now()
    good = [(q, df, sheet_name_for(q, mapping)) for q, df, status in results if status == "success" and df is not None]
    refuse_shared_sheets([sheet for _, _, sheet in good])
    rows = []
    for qname, df, sheet in good:
        if overwrite:
            n = write_sheet(df, root, sheet)
        else:
            n = append_positional(df, f"{root.rstrip('/')}/{sheet}")
        rows.append((sheet, qname, n, now))
    manifest = spark.createDataFrame(rows, MANIFEST_SCHEMA)
    manifest.write.mode("append").parquet(f"{root.rstrip('/')}/_manifest")
    return manifest


def append_positional(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Append below existing rows, matched by position (no header check), and return the rows added;
    creates the dataset when absent.  Values take the stored types; a column that cannot be cast is refused."""
    spark = df.sparkSession

    def rows() -> int:
        return spark.read.format(fmt).load(path).count()

    try:
        existing = spark.read.format(fmt).load(path).schema.fields
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        existing = None
    before = 0
    if existing is not None:
        if len(existing) != len(df.columns):
            raise ValueError("positional append needs the same number of columns")
        df = df.toDF(*[f.name for f in existing])
        other = [f.name for f, g in zip(existing, df.schema.fields) if f.dataType != g.dataType]
        if other:
            try:
                df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in existing])
            except AnalysisException as e:
                raise ValueError(f"columns {other} do not fit the stored types") from e
        before = rows()
    df.write.mode("append").format(fmt).save(path)
    return rows() - before


def write_csv(df: DataFrame, path: str, filtered: bool = False) -> str:
    """CSV with a header row; ``_filtered`` is appended to the name of a searched view."""
    target = path.rstrip("/") + ("_filtered" if filtered else "")
    df.write.mode("overwrite").option("header", True).csv(target)
    return target


RUNLOG_SCHEMA = StructType([
    StructField("query_name", StringType()), StructField("sheet_name", StringType()),
    StructField("status", StringType()), StructField("start_time", TimestampType()),
    StructField("end_time", TimestampType()), StructField("execution_time", DoubleType()),
    StructField("row_count", LongType()), StructField("error", StringType()),
])


def append_runlog(log: DataFrame, path: str) -> None:
    """Append run-log rows (schema ``RUNLOG_SCHEMA``)."""
    log.select(*[F.col(f.name).cast(f.dataType) for f in RUNLOG_SCHEMA.fields]).write.mode("append").parquet(path)


# ------------------------------------------------------------------ workspaces

META_SCHEMA = StructType([
    StructField("workspace", StringType()), StructField("name", StringType()), StructField("type", StringType()),
    StructField("query", StringType()), StructField("status", StringType()),
    StructField("deps", ArrayType(StringType())),
])


def save_workspace(spark: SparkSession, root: str, workspace: str, sheets: dict[str, tuple]) -> DataFrame:
    """Persist a workspace: ``sheets`` = name -> (df, type, query[, deps]).

    Tables with rows are written as Parquet (types survive a reload); empty
    or missing tables are not written and come back ``pending``.  The scheme
    sheet is never persisted.  Returns the metadata table written.
    """
    base = f"{root.rstrip('/')}/{workspace}"
    meta, ready = [], []
    # all tables are written before any is replaced: a table may be read from the folder it is saved to
    for name, spec in sheets.items():
        df, typ, query = spec[:3]
        deps = list(spec[3]) if len(spec) > 3 and spec[3] else []
        if typ == "scheme":
            continue
        path, n = _staged(df, base) if df is not None else (None, 0)
        if n:
            ready.append((path, f"{base}/tables/{name}"))
        meta.append((workspace, name, typ, query, "success" if n else "pending", deps))
    meta_df = spark.createDataFrame(meta, META_SCHEMA)
    meta_path, _ = _staged(meta_df.coalesce(1), base)
    for path, target in [*ready, (meta_path, f"{base}/_meta")]:
        replace_folder(spark, path, target)
    return meta_df


def load_workspace(spark: SparkSession, root: str, workspace: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Metadata table and the saved tables (lazy Parquet scans) of a workspace."""
    base = f"{root.rstrip('/')}/{workspace}"
    meta = spark.read.parquet(f"{base}/_meta")
    names = [r.name for r in meta.where(F.col("status") == "success").select("name").collect()]
    return meta, {n: spark.read.parquet(f"{base}/tables/{n}") for n in names}
