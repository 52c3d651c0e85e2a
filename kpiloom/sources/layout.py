"""Co-located storage of fact tables: equal numbers of buckets on the join key, sorted within each.

Tables written together by ``write_colocated`` join on their keys, and are grouped by them, without an exchange: bucket i of
one holds the keys of bucket i of the others.  A key's type must be the same in all tables (a long and an int hash apart), so
integer keys are stored as longs; other types must agree.  Rows with a null key share a bucket.

A key that holds a large part of a table makes a large bucket, which no exchange would split either; ``bucket_count`` sizes
buckets for even keys.  Each call writes folders of its own below the shared folder, so a failed call leaves earlier tables as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from kpiloom.session import scratch_path

BUCKET_BYTES = 256 << 20


def bucket_count(table_bytes: int, least: int = 8) -> int:
    """A power of two of buckets of about ``BUCKET_BYTES``, so that layouts of other sizes divide each other."""
    n = least
    while n * BUCKET_BYTES < table_bytes:
        n *= 2
    return n


def write_colocated(tables: dict[str, tuple[DataFrame, str]], buckets: int, root: str | None = None) -> dict[str, DataFrame]:
    """Store each ``name: (table, key column)`` in ``buckets`` buckets sorted by its key; gives the stored tables by name."""
    if buckets < 1:
        raise ValueError("there must be a bucket")
    kinds = {}
    for name, (df, key) in tables.items():
        kind = df.schema[key].dataType
        kinds[name] = "bigint" if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)) else kind.simpleString()
    if len(set(kinds.values())) > 1:
        raise ValueError(f"the keys differ in type: {kinds}")
    run, out = uuid.uuid4().hex, {}
    for name, (df, key) in tables.items():
        spark = df.sparkSession
        path = f"{root.rstrip('/')}/{run}/{name}" if root else scratch_path(spark, name)
        stored = f"kpiloom_{name}_{run}"
        # one task per bucket, so a bucket is one sorted file and not one of each input task
        dealt = df.withColumn(key, F.col(f"`{key}`").cast(kinds[name])).repartition(buckets, F.col(f"`{key}`"))
        dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(stored)
        out[name] = spark.table(stored)
    return out
