"""The most frequent keys of a table of counts, under a bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def head_limit(counts: DataFrame, most: int, n: str = "n") -> int | None:
    """The lowest count such that at most ``most`` rows have it or more, in steps of an eighth of an octave; None if no such count
    exists.  A histogram of at most a few hundred steps reaches the driver."""
    step = F.floor(F.log2(n) * 8)
    bars = counts.groupBy(step.alias("s")).agg(F.count("*").alias("k"), F.min(n).alias("least")).collect()
    limit, total = None, 0
    for bar in sorted(bars, reverse=True):
        total += bar.k
        if total > most:
            return limit
        limit = bar.least
    return limit
