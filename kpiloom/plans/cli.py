"""Batch report job for ``spark-submit``.

    spark-submit -m kpiloom.plans.cli --registry queries.yaml --table orders=/data/orders \
        --out /reports/2026-04 [--frequency daily] [--sequential] [--timeout 300]

The registry is a YAML / JSON list (or a ``queries:`` key) of entries
``{name, sql, sheet_name, refresh_frequency, enabled}``, or the first table of
an HTML file with columns ``query_name / sql_query / sheet_name``.  Tables are
registered as views (``name=path`` Parquet, ``name=path:csv`` CSV with a
header).  Each query writes its own sheet under ``--out``; the run log is
appended to ``--out/_runlog`` and the summary printed as one JSON line.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.plans.batch import REGISTRY_SCHEMA, run_batch, run_summary
from kpiloom.sources.files import norm_headers, read_csv
from kpiloom.sources.html import read_html_table
from kpiloom.sources.sinks import append_runlog


def registry_from_entries(spark: SparkSession, entries: list[dict]) -> DataFrame:
    rows = [(e.get("name") or e.get("query_name"), e.get("sql") or e.get("sql_query"), e.get("sheet_name"),
             e.get("refresh_frequency"), e.get("enabled")) for e in entries]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def registry_from_file(spark: SparkSession, path: str) -> DataFrame:
    """YAML / JSON (config file) or HTML (first table) registry."""
    if path.lower().endswith((".html", ".htm")):
        docs = spark.read.text(path, wholetext=True).withColumnRenamed("value", "html")
        rows = read_html_table(docs, "html", ["query_name", "sql_query", "sheet_name"])
        missing = rows.where(F.col("query_name").isNull() | F.col("sql_query").isNull() | F.col("sheet_name").isNull())
        if not missing.isEmpty():
            raise ValueError("Missing required columns: query_name, sql_query, sheet_name")
        return rows.select(F.col("query_name").alias("name"), F.col("sql_query").alias("sql"), "sheet_name",
                           F.lit(None).cast("string").alias("refresh_frequency"),
                           F.lit(None).cast("boolean").alias("enabled"))
    with open(path, encoding="utf-8") as fh:
        text = fh.read()
    if path.lower().endswith(".json"):
        data = json.loads(text)
    else:
        import yaml
        data = yaml.safe_load(text)
    entries = data.get("queries", []) if isinstance(data, dict) else data
    return registry_from_entries(spark, entries)


def register_inputs(spark: SparkSession, specs: list[str]) -> None:
    for spec in specs:
        name, _, target = spec.partition("=")
        path, _, fmt = target.partition(":") if target.endswith((":csv", ":parquet", ":json")) else (target, "", "")
        if fmt == "csv":
            df = norm_headers(read_csv(spark, path))
        elif fmt == "json":
            df = spark.read.json(path)
        else:
            df = spark.read.parquet(path)
        df.createOrReplaceTempView(name)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--registry", required=True)
    ap.add_argument("--table", action="append", default=[], help="name=path[:csv|:json|:parquet]")
    ap.add_argument("--out", required=True)
    ap.add_argument("--frequency")
    ap.add_argument("--sequential", action="store_true")
    ap.add_argument("--timeout", type=float, help="seconds per query; the query's jobs are cancelled after it")
    args = ap.parse_args(argv)

    if spark is None:
        from kpiloom.session import get_session
        spark = get_session("kpiloom-batch")
    register_inputs(spark, args.table)
    registry = registry_from_file(spark, args.registry)
    log = run_batch(spark, registry, args.out, frequency=args.frequency, parallel=not args.sequential,
                    timeout=args.timeout)
    append_runlog(log, f"{args.out.rstrip('/')}/_runlog")
    summary = run_summary(log).collect()
    out = summary[0].asDict() if summary else {}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
