"""Make an N-times larger copy of a test-table folder (key-offset replicas),
for scaling runs of bench.py.  Written once into a fresh folder.

    python tools/scale_up.py SRC_DIR DST_DIR N [HOT_SHARE]

With HOT_SHARE (e.g. 0.33) that share of orders and events is given to one
customer / user (key 0), to measure the plans under a hot key.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# key columns shifted per replica, so replicas are distinct entities
KEYS = {
    "orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey"], "customer": ["c_custkey"],
    "events": ["event_id", "user_id"], "part": [], "supplier": [], "nation": [], "region": [],
}


def main():
    src, dst, n = sys.argv[1], sys.argv[2], int(sys.argv[3])
    hot = float(sys.argv[4]) if len(sys.argv) > 4 else 0.0
    hot_cols = {"orders": ("o_orderkey", "o_custkey"), "events": ("event_id", "user_id")}
    from pyspark.sql import functions as F
    from kpiloom.session import get_session
    spark = get_session(master="local[8]", shuffle_partitions=8)
    for name, keys in KEYS.items():
        df = spark.read.parquet(f"{src}/{name}.parquet")
        if not keys:
            df.write.parquet(f"{dst}/{name}.parquet")
            continue
        span = {k: df.agg(F.max(k)).first()[0] + 1 for k in keys}
        copies = [df.withColumns({k: F.col(k) + F.lit(r * span[k]) for k in keys}) for r in range(n)]
        big = copies[0]
        for c in copies[1:]:
            big = big.unionByName(c)
        if hot and name in hot_cols:
            pk, fk = hot_cols[name]
            pick = (F.abs(F.xxhash64(F.col(pk))) % 1000) < int(hot * 1000)
            big = big.withColumn(fk, F.when(pick, F.lit(0)).otherwise(F.col(fk)))
        big.write.parquet(f"{dst}/{name}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
