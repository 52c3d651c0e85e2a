"""One key holding a third of all rows: results stay whole and exact (checked
against pandas brute force)."""

from pyspark.sql import functions as F

from kpiloom.operators import rules as R
from kpiloom.operators.consolidate import consolidate, mappings_for
from kpiloom.operators.latest import latest_per_key


def skewed_events(spark, n=30000):
    # key 0 owns a third of the rows; the rest spread over 500 keys
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("k"),
        (F.col("id") % 97 / 4).alias("v"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 5000) * 600).cast("timestamp_ntz").alias("ts"))
    return df.repartition(16)


def test_consolidate_hot_key(spark):
    df = skewed_events(spark)
    other = df.select(F.col("k").alias("inspector"), (F.col("v") * 2).alias("bonus"))
    out = consolidate(mappings_for(df, "a", "k", ["v"]) + mappings_for(other, "b"))
    got = out.toPandas().set_index("cj_id")
    pdf = df.toPandas()
    want = pdf.groupby(pdf.k.astype(str)).v.sum()
    assert len(got) == 501
    assert abs(got.loc["0", "a"] - want["0"]) < 1e-6
    assert ((got.a - want.reindex(got.index)).abs() < 1e-6).all()
    assert ((got.b - 2 * got.a).abs() < 1e-6).all()


def test_latest_per_key_hot_key_ties(spark):
    df = skewed_events(spark)
    got = latest_per_key(df, "k", "ts").toPandas()
    pdf = df.toPandas()
    mx = pdf.groupby("k").ts.transform("max")
    want = pdf[pdf.ts == mx]
    assert len(got) == len(want)
    assert sorted(got.k.tolist()) == sorted(want.k.tolist())


def test_daily_rollup_hot_key(spark):
    df = skewed_events(spark)
    daily = R.person_day_rollup(df, "k", "ts", {"v_sum": F.col("v")}).toPandas()
    pdf = df.toPandas()
    want = pdf.groupby([pdf.k, pdf.ts.dt.date]).agg(n=("v", "size"), v_sum=("v", "sum")).reset_index()
    assert len(daily) == len(want)
    assert daily.n.sum() == 30000
    hot = daily[daily.person == 0].n.sum()
    assert hot == 10000
