"""Refresh KPI totals when new files arrive (Structured Streaming).

    file source (new files only) --> foreachBatch:
        presum the micro-batch per key (partial aggregate, one shuffle)
        overwrite  <state>/batch_id=<id>   (idempotent: a retried batch rewrites its own folder)
    current totals = groupBy(key) over all batch partials

The checkpoint records which files each batch consumed, so a restarted job
neither skips nor double counts files; overwriting by batch id makes the
sink exactly-once even when a batch is re-executed after an executor loss.
``compact`` folds the partials into a snapshot (``_snapshots/upto=<id>``,
hidden from the partial scan) so reads stay bounded on long-running streams.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kpiloom.functions.scalars import from_parts, key_norm, money_parts


def start_refresh(spark: SparkSession, source_dir: str, schema: StructType, state_dir: str, checkpoint: str,
                  key: str, value: str, fmt: str = "parquet", max_files_per_batch: int | None = None,
                  available_now: bool = True, processing_time: str | None = None,
                  after_batch: Callable[[SparkSession, int], None] | None = None,
                  compact_every: int | None = None):
    """Start the streaming refresh; returns the ``StreamingQuery``.

    ``after_batch(spark, batch_id)`` runs on the driver once a batch's partial
    is committed -- e.g. to recompute and write the KPI tables that read
    :func:`current_totals` (the "refresh KPIs when data lands" step).
    ``compact_every=N`` folds the partials into a snapshot after every N
    committed batches (see :func:`compact`), so reads stay bounded.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    src = reader.load(source_dir)
    whole, rest = money_parts(F.col(value), schema[value].dataType)
    rows = src.select(key_norm(F.col(key), dtype=schema[key].dataType).alias("cj_id"), whole.alias("w"), rest.alias("r"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy("cj_id").agg(F.sum("w").alias("w"), F.sum("r").alias("r"), F.count(F.lit(1)).alias("n"))
        part.write.mode("overwrite").parquet(f"{state_dir.rstrip('/')}/batch_id={batch_id}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, state_dir)
        if after_batch is not None:
            after_batch(batch.sparkSession, batch_id)

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop, hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _snapshots(spark: SparkSession, state_dir: str) -> list[int]:
    """Batch ids covered by compacted snapshots (``<state>/_snapshots/upto=<id>``) whose write has committed: only then the
    folder holds the ``_SUCCESS`` mark.  One without it is left aside and written anew by the next ``compact``."""
    root = f"{state_dir.rstrip('/')}/_snapshots"
    hadoop, fs = _fs(spark, root)
    if not fs.exists(hadoop(root)):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(hadoop(root))]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("upto=") and fs.exists(hadoop(f"{root}/{n}/_SUCCESS")))


def _retire(spark: SparkSession, state_dir: str, upto: int) -> None:
    """Remove the partials and the snapshots that an older snapshot than the newest one covers; readers of that one go on."""
    base = state_dir.rstrip("/")
    hadoop, fs = _fs(spark, base)
    for folder, mark, last in ((base, "batch_id=", upto), (f"{base}/_snapshots", "upto=", upto - 1)):
        for f in fs.listStatus(hadoop(folder)):
            name = f.getPath().getName()
            if name.startswith(mark) and int(name.split("=")[1]) <= last:
                fs.delete(f.getPath(), True)


def _merged_partials(spark: SparkSession, state_dir: str) -> DataFrame:
    """Per-key (v, n) over the newest snapshot plus the micro-batches after it."""
    base = state_dir.rstrip("/")
    snaps = _snapshots(spark, state_dir)
    parts = spark.read.parquet(base)
    if snaps:
        parts = parts.where(F.col("batch_id") > snaps[-1])
    parts = parts.select("cj_id", "w", "r", "n")
    if snaps:
        parts = parts.unionByName(spark.read.parquet(f"{base}/_snapshots/upto={snaps[-1]}").select("cj_id", "w", "r", "n"))
    return parts


def current_totals(spark: SparkSession, state_dir: str, value_name: str = "total", count_name: str = "n_rows") -> DataFrame:
    """Totals per key over every committed micro-batch (newest snapshot + later batches)."""
    parts = _merged_partials(spark, state_dir)
    return parts.groupBy("cj_id").agg(from_parts(F.sum("w"), F.sum("r")).alias(value_name),
                                      F.sum("n").cast("bigint").alias(count_name))


def compact(spark: SparkSession, state_dir: str) -> int | None:
    """Fold all committed micro-batch partials into one snapshot ``upto=<last batch>``.

    The snapshot is written to a new folder (never over the inputs), so a
    failed compaction leaves the previous state readable; readers switch to
    the new snapshot only once its write has committed.  What the
    snapshot before it covers is removed then.  Returns the batch id covered.
    """
    base = state_dir.rstrip("/")
    last = spark.read.parquet(base).agg(F.max("batch_id")).first()[0]
    snaps = _snapshots(spark, state_dir)
    if last is None or (snaps and snaps[-1] >= last):
        return snaps[-1] if snaps else None
    # only batches up to `last` (a batch committed meanwhile stays a partial)
    if snaps:
        newer = spark.read.parquet(base).where((F.col("batch_id") > snaps[-1]) & (F.col("batch_id") <= last))
        older = spark.read.parquet(f"{base}/_snapshots/upto={snaps[-1]}")
        merged = newer.select("cj_id", "w", "r", "n").unionByName(older.select("cj_id", "w", "r", "n"))
    else:
        merged = spark.read.parquet(base).where(F.col("batch_id") <= last).select("cj_id", "w", "r", "n")
    merged = merged.groupBy("cj_id").agg(F.sum("w").alias("w"), F.sum("r").alias("r"), F.sum("n").alias("n"))
    merged.write.mode("overwrite").parquet(f"{base}/_snapshots/upto={last}")
    if snaps:
        _retire(spark, state_dir, snaps[-1])
    return last


def batches_seen(spark: SparkSession, state_dir: str) -> DataFrame:
    return spark.read.parquet(state_dir).select("batch_id").distinct()
