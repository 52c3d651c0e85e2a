"""KPIs kept up to date from arriving files, corrections included (Structured Streaming).

A KPI is a filter, a group-by and measures (COUNT, SUM, AVG, MIN, MAX) over rows that have an id.  A row that arrives with an
id seen before corrects the earlier one: the row with the larger version counts (of equal versions, and without a version
column, the one that arrived later).

    file source (new files only) --> foreachBatch, each batch:
        the batch's newest row per id                                  --> <state>/rows/batch_id=<id>
        minus the earlier rows of those ids, read from older batches,
        as signed counts and sums, new minima and maxima per group     --> <state>/deltas/batch_id=<id>
    the KPI = counts and sums added up; minima and maxima over the deltas, but for groups that lost a row: these take
              theirs from the current rows of the group

Counts and sums are exact (long parts), so what is taken off is what was put on.  A batch looks at older batches only and
overwrites its own two folders, so a batch that is run again after a failure gives the same state.  :func:`compact_kpi` folds
the batches into a snapshot; a reader counts a snapshot only when its write has committed.  A batch joins its own ids with the
stored rows' ids (the larger side is scanned, its rows are not moved if the batch is small enough to be broadcast by the
planner); groups are never collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kpiloom.functions.scalars import from_parts, money_parts
from kpiloom.operators.measures import Measure
from kpiloom.streaming.arrival import _fs, _retire, _snapshots

FUNCS = ("COUNT", "SUM", "AVG", "MIN", "MAX")


@dataclass(frozen=True)
class MaintainedKpi:
    id_col: str
    keys: list[str]
    measures: list[Measure]
    where: str | None = None
    version: str | None = None
    columns: list[str] = field(default_factory=list, init=False)

    def __post_init__(self):
        for m in self.measures:
            if m.kind != "agg" or m.func.upper() not in FUNCS:
                raise ValueError(f"a maintained KPI takes {', '.join(FUNCS)}, not {m.func!r} ({m.kind})")
            if m.column == "*" and m.func.upper() != "COUNT":
                raise ValueError(f"{m.func}(*) is not defined; name a column")
        self.columns.extend(sorted({m.column for m in self.measures if m.column != "*"}))


def _stored_rows(kpi: MaintainedKpi, batch: DataFrame, batch_id: int) -> DataFrame:
    """The batch's newest row per id: (_id, _version, _batch, _holds, keys, columns)."""
    holds = F.coalesce(F.expr(kpi.where), F.lit(False)) if kpi.where else F.lit(True)
    version = F.col(f"`{kpi.version}`") if kpi.version else F.lit(0)
    rows = batch.where(F.col(f"`{kpi.id_col}`").isNotNull()).select(
        F.col(f"`{kpi.id_col}`").alias("_id"), version.alias("_version"), F.lit(batch_id).cast("long").alias("_batch"), holds.alias("_holds"),
        *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(kpi.keys)], *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kpi.columns)])
    return _newest(rows)


def _newest(rows: DataFrame) -> DataFrame:
    """One row per id: the largest version, of these the last batch (a plain aggregate, combined before the shuffle)."""
    rest = [c for c in rows.columns if c != "_id"]
    order = F.struct("_version", "_batch", *[c for c in rest if c not in ("_version", "_batch")])
    return rows.groupBy("_id").agg(F.max_by(F.struct(*rest), order).alias("_r")).select("_id", "_r.*")


def _log(spark: SparkSession, state_dir: str, part: str, before: int | None = None) -> DataFrame | None:
    """The newest snapshot and the batches after it of one of the two logs, of batches before ``before`` only."""
    base = f"{state_dir.rstrip('/')}/{part}"
    snaps = [s for s in _snapshots(spark, base) if before is None or s < before]
    path, fs = _fs(spark, base)
    if not fs.exists(path(base)):
        return None
    ids = sorted(int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(path(base))
                 if f.getPath().getName().startswith("batch_id=") and fs.exists(path(f"{f.getPath()}/_SUCCESS")))
    ids = [i for i in ids if (before is None or i < before) and (not snaps or i > snaps[-1])]
    folders = [f"{base}/_snapshots/upto={s}" for s in snaps[-1:]] + [f"{base}/batch_id={i}" for i in ids]
    return spark.read.parquet(*folders) if folders else None


def _sums(kpi: MaintainedKpi, rows: DataFrame, sign: Column) -> list[Column]:
    """Signed state of every column: how many values, the exact sum in two parts, smallest and largest of the rows put on."""
    put = sign > 0
    out = [F.sum(sign).alias("n"), F.max(sign < 0).alias("lost")]
    for i, _ in enumerate(kpi.columns):
        c, kind = F.col(f"c{i}"), rows.schema[f"c{i}"].dataType
        there = F.when(c.isNotNull(), sign).otherwise(0)
        out.append(F.sum(there).alias(f"n{i}"))
        if any(m.func.upper() in ("SUM", "AVG") and m.column == kpi.columns[i] for m in kpi.measures):
            whole, rest = money_parts(c, kind)
            out += [F.sum(whole * there).alias(f"w{i}"), F.sum(rest * there).alias(f"r{i}")]
        out += [F.min(F.when(put, c)).alias(f"lo{i}"), F.max(F.when(put, c)).alias(f"hi{i}")]
    return out


def apply_batch(kpi: MaintainedKpi, batch: DataFrame, batch_id: int, state_dir: str) -> None:
    """Write the batch's rows and its change of the KPI's state."""
    spark, base = batch.sparkSession, state_dir.rstrip("/")
    rows_at = f"{base}/rows/batch_id={batch_id}"
    _stored_rows(kpi, batch, batch_id).write.mode("overwrite").parquet(rows_at)
    new = spark.read.parquet(rows_at)
    older = _log(spark, state_dir, "rows", before=batch_id)
    if older is None:
        change = new.withColumn("_sign", F.lit(1).cast("long"))
    else:
        old = _newest(older.join(new.select("_id"), "_id", "left_semi"))
        ver = old.select("_id", F.col("_version").alias("_was"))
        # a row older than the one held changes nothing
        valid = new.join(ver, "_id", "left").where(F.col("_was").isNull() | (F.col("_version") >= F.col("_was"))).drop("_was")
        gone = old.join(valid.select("_id"), "_id", "left_semi")
        change = valid.withColumn("_sign", F.lit(1).cast("long")).unionByName(gone.withColumn("_sign", F.lit(-1).cast("long")))
    change = change.where("_holds")
    keys = [f"k{i}" for i in range(len(kpi.keys))]
    change.groupBy(*keys).agg(*_sums(kpi, change, F.col("_sign"))).write.mode("overwrite").parquet(f"{base}/deltas/batch_id={batch_id}")


def _state(kpi: MaintainedKpi, deltas: DataFrame) -> DataFrame:
    keys = [f"k{i}" for i in range(len(kpi.keys))]
    how = {"n": F.sum, "w": F.sum, "r": F.sum, "lost": F.max, "lo": F.min, "hi": F.max}
    return deltas.groupBy(*keys).agg(*[how[c.rstrip("0123456789")](c).alias(c) for c in deltas.columns if c not in keys])


def _with_true_ends(kpi: MaintainedKpi, state: DataFrame, rows: DataFrame) -> DataFrame:
    """Minima and maxima of groups that lost a row, from the group's current rows."""
    keys = [f"k{i}" for i in range(len(kpi.keys))]
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys] or [F.lit(True)]
    lost = state.where("lost").select(*keys).alias("g")
    # ids that were ever in such a group, then what they are now
    ids = rows.alias("r").join(lost, same("r", "g"), "left_semi").select("_id").distinct()
    now = _newest(rows.join(ids, "_id", "left_semi")).where("_holds")
    ends = now.groupBy(*keys).agg(*[f(f"c{i}").alias(f"{name}{i}") for i in range(len(kpi.columns)) for f, name in ((F.min, "lo"), (F.max, "hi"))])
    joined = state.alias("s").join(ends.alias("e"), same("s", "e"), "left")
    pick = [F.when(F.col("s.lost"), F.col(f"e.{c}")).otherwise(F.col(f"s.{c}")).alias(c) if c[:2] in ("lo", "hi") and c != "lost" else F.col(f"s.{c}")
            for c in state.columns]
    return joined.select(*pick)


def _whole_state(spark: SparkSession, kpi: MaintainedKpi, state_dir: str) -> DataFrame | None:
    deltas, rows = _log(spark, state_dir, "deltas"), _log(spark, state_dir, "rows")
    if deltas is None or rows is None:
        return None
    state = _state(kpi, deltas)
    return _with_true_ends(kpi, state, rows) if any(m.func.upper() in ("MIN", "MAX") for m in kpi.measures) else state


def current_kpi(spark: SparkSession, kpi: MaintainedKpi, state_dir: str) -> DataFrame:
    """One row per group that has rows: the keys and the measures, as the batch query over the current rows gives them."""
    state = _whole_state(spark, kpi, state_dir)
    if state is None:
        raise ValueError(f"no batch has been applied below {state_dir}")
    out = []
    for m in kpi.measures:
        i, func = kpi.columns.index(m.column) if m.column != "*" else None, m.func.upper()
        total = from_parts(f"w{i}", f"r{i}") if func in ("SUM", "AVG") else None
        value = {"COUNT": lambda: F.col("n" if i is None else f"n{i}"), "SUM": lambda: F.when(F.col(f"n{i}") > 0, total),
                 "AVG": lambda: F.when(F.col(f"n{i}") > 0, total / F.col(f"n{i}")), "MIN": lambda: F.col(f"lo{i}"), "MAX": lambda: F.col(f"hi{i}")}[func]()
        out.append(value.alias(m.alias))
    return state.where("n > 0").select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(kpi.keys)], *out)


def compact_kpi(spark: SparkSession, kpi: MaintainedKpi, state_dir: str) -> int | None:
    """Fold all batches into a snapshot of the current rows and one of the groups' state; returns the last batch covered.

    The rows' snapshot is written first: until the state's has committed, readers take the older state, which agrees with it."""
    base = state_dir.rstrip("/")
    path, fs = _fs(spark, f"{base}/deltas")
    ids = [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(path(f"{base}/deltas")) if f.getPath().getName().startswith("batch_id=")]
    done = _snapshots(spark, f"{base}/deltas")
    if not ids or (done and done[-1] >= max(ids)):
        return done[-1] if done else None
    last = max(ids)
    state = _whole_state(spark, kpi, state_dir).withColumn("lost", F.lit(False))
    state.write.mode("overwrite").parquet(f"{base}/deltas/_snapshots/upto={last}.part")
    _newest(_log(spark, state_dir, "rows")).write.mode("overwrite").parquet(f"{base}/rows/_snapshots/upto={last}")
    fs.rename(path(f"{base}/deltas/_snapshots/upto={last}.part"), path(f"{base}/deltas/_snapshots/upto={last}"))
    if done:
        for part in ("rows", "deltas"):
            _retire(spark, f"{base}/{part}", done[-1])
    return last


def start_kpi(spark: SparkSession, source_dir: str, schema: StructType, kpi: MaintainedKpi, state_dir: str, checkpoint: str, fmt: str = "parquet",
              max_files_per_batch: int | None = None, processing_time: str | None = None, compact_every: int | None = None):
    """Start the stream that keeps the KPI; returns the ``StreamingQuery``.  Without a processing time it takes what is there and ends."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def take(batch: DataFrame, batch_id: int) -> None:
        apply_batch(kpi, batch, batch_id, state_dir)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_kpi(batch.sparkSession, kpi, state_dir)

    writer = reader.load(source_dir).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)).start()
