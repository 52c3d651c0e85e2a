"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts the lineage, so that
    a lost executor costs a re-read and not a recomputation.  codec: another compression than the session's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # the write's shuffle files go when it ends: nothing reads them again
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that the planner may broadcast by the size of their files, where keys take up to 36 times less room (measured) than in a broadcast.
SENT = 100_000


def counted(side: DataFrame, rows: int) -> DataFrame:
    """One side of a join, to be merged if it may have over SENT rows."""
    return side.hint("merge") if rows > SENT else side


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) with null texts as empty."""
    return df.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(text))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as make it none of df's columns (compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (as spark-submit --py-files does), once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="kpiloom-py-")) / "kpiloom.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(out))
    _SHIPPED.add(sc.applicationId)
