"""File sources: CSV, directories of files, JSON result sets, inline rows,
header normalisation and time-zone stripping."""

from __future__ import annotations

import logging
import os
import posixpath
import re
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

log = logging.getLogger(__name__)


def table_name_for(path: str, name: str | None = None) -> str:
    """Given name, else the file stem."""
    if name:
        return name
    base = posixpath.basename(path.rstrip("/"))
    return os.path.splitext(base)[0]


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, infer: bool = True,
             **options) -> DataFrame:
    """CSV with a header; an explicit schema wins over inference (inference
    costs an extra pass over the data -- give a schema in production)."""
    reader = spark.read.option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def load_csv_table(spark: SparkSession, path: str, name: str | None = None, existing: set[str] | None = None,
                   schema: StructType | None = None, **options) -> tuple[str, DataFrame]:
    """A CSV file as a named table: the given name or the file stem; a name
    already taken (case-insensitive) is refused."""
    table = table_name_for(path, name)
    if table.lower() in {n.lower() for n in (existing or set())}:
        raise ValueError(f"a table named {table!r} already exists")
    return table, read_csv(spark, path, schema=schema, **options)


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> list[str]:
    """Paths of the files below ``folder`` matching ``pattern`` (listing only:
    the binary-file source prunes the ``content`` column, nothing is read).
    The list is bounded by the number of files, not by their size."""
    return [r.path for r in _listed(spark, folder, pattern, recursive).orderBy("path").collect()]


def _listed(spark: SparkSession, folder: str, pattern: str, recursive: bool = True) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
                 .option("recursiveFileLookup", recursive).load(folder).select("path"))


def read_folder(spark: SparkSession, folder: str, fmt: str = "csv", prefix: str | None = None,
                existing: set[str] | None = None, pattern: str | None = None, **options):
    """One table per entry of a folder (the workbook -> sheets rule).

    An entry is a data file directly in ``folder`` or a sub-folder of part
    files (what Spark writes).  Names: ``prefix_stem`` when several entries,
    ``prefix`` when one, the entry stem without a prefix.  Names already in
    ``existing`` (case-insensitive) are skipped.  Returns ``(tables, skipped)``.
    """
    existing = {n.lower() for n in (existing or set())}
    # Listed paths are full URIs (hdfs://host:port/..., file:/...); only their parts up to the entry come back, each once.
    base = urlparse(folder).path.rstrip("/")
    top = F.regexp_extract("path", r"^((?:[a-z][a-z0-9+.-]*:(?://[^/]*)?)?" + re.escape(base).replace("\\-", "-") + "/[^/]+)", 1)
    entries = [r.entry for r in _listed(spark, folder, pattern or f"*.{fmt}").select(top.alias("entry")).distinct().orderBy("entry").collect()]
    if "" in entries:
        raise ValueError(f"a listed file is not below {folder}")
    tables, skipped = {}, []
    for entry in entries:
        stem = table_name_for(entry)
        if prefix:
            name = prefix if len(entries) == 1 else f"{prefix}_{stem}"
        else:
            name = stem
        if name.lower() in existing or name in tables:
            log.warning("table %r already exists; %s skipped", name, entry)
            skipped.append(name)
            continue
        if fmt == "csv":
            tables[name] = read_csv(spark, entry, **options)
        else:
            tables[name] = spark.read.format(fmt).options(**options).load(entry)
    return tables, skipped


def read_result_json(spark: SparkSession, path: str, schema: StructType | None = None):
    """A result set stored as JSON lines.  An object carrying ``__error__``
    marks a failed run; no records at all is a failure too.

    Returns ``(df, status, error)``; one read checks both, with an error column over all records, else up to the first.
    """
    df = spark.read.schema(schema).json(path) if schema is not None else spark.read.json(path)
    if "__error__" in df.columns:
        found = df.agg(F.any_value("__error__", F.lit(True)).alias("error"), F.count("*").alias("n")).first()
        if found.error is not None:
            return None, "failed", str(found.error)
        df, empty = df.drop("__error__"), found.n == 0
    else:
        empty = df.isEmpty()
    if empty:
        return None, "failed", "empty result"
    return df, "success", None


def write_result_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def rows_as_json(df: DataFrame, column: str = "record") -> DataFrame:
    """Each row as one JSON text (``to_json(struct(*))``)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(column))


def rows_from_json(df: DataFrame, column: str, schema: StructType) -> DataFrame:
    return df.select(F.from_json(F.col(column), schema).alias("_r")).select("_r.*")


def inline(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Literal rows as a table."""
    return spark.createDataFrame(rows, schema)


def norm_headers(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Lower-case column names, spaces -> ``_``; fail listing missing required columns."""
    out = df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])
    missing = [c for c in (required or []) if c not in out.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return out


def strip_zone(df: DataFrame, zone: str, columns: list[str] | None = None, from_zone: str | None = None) -> DataFrame:
    """Timestamps -> naive wall-clock time in ``zone`` (``timestamp_ntz``).

    Instants (``timestamp``) are read in the session zone; naive columns are
    taken to be in ``from_zone`` (default UTC).
    """
    session_zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    out = df
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            out = out.withColumn(f.name, F.convert_timezone(F.lit(session_zone), F.lit(zone), c.cast("timestamp_ntz")))
        elif f.dataType.typeName() == "timestamp_ntz":
            out = out.withColumn(f.name, F.convert_timezone(F.lit(from_zone or "UTC"), F.lit(zone), c))
    return out


def read_warehouse(spark: SparkSession, url: str, sql: str, properties: dict | None = None,
                   partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                   partitions: int | None = None, fetch_size: int = 10000) -> DataFrame:
    """A warehouse query through Spark's JDBC source (the cluster form of ``src_sql``).

    With ``partition_column`` / ``lower`` / ``upper`` / ``partitions`` the
    query is read by ``partitions`` parallel tasks, each fetching one range,
    instead of one task pulling the whole result.  (No database is reachable
    from the test environment, so this reader is not exercised by the tests.)
    """
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("dbtable", f"({sql}) q").option("partitionColumn", partition_column)
                        .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", partitions))
    else:
        reader = reader.option("query", sql)
    return reader.load()
