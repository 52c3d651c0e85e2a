"""CSV typing with quarantine: types found by one aggregate, rows that do not fit set aside.

Every column is read as text.  One pass counts, for each column and type, the values that do not fit; a column takes the first of
``TYPES`` whose misfits are at most ``tolerance`` of its values, else it stays text (also with no value at all).  A whole number that
no long holds is a double.  The file is then read with those types, and every row is either kept, with all its values typed, or set
aside as it stands, with the columns that did not fit; rows with too few or too many fields, or a broken quote, are set aside too.  Nothing
becomes a null that was not empty, and kept plus set-aside rows are the file's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: (type, pattern that its texts match), the narrower before the wider.
TYPES = [("boolean", r"^(?i:true|false)$"), ("bigint", r"^[+-]?[0-9]+$"), ("double", r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
         ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), ("timestamp_ntz", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$")]


def _as(c: Column, kind: str) -> Column:
    pattern = dict(TYPES).get(kind)
    return c if pattern is None else F.when(F.trim(c).rlike(pattern), F.trim(c).try_cast(kind))


def find_types(df: DataFrame, columns: list[str], tolerance: float = 0.0, where: Column | None = None) -> dict[str, str]:
    """Column -> type, from one aggregate over df (text columns); where: the rows that count."""
    at = F.lit(True) if where is None else where
    sums = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`")
        sums.append(F.count_if(at & v.isNotNull()).alias(f"n{i}"))
        sums += [F.count_if(at & v.isNotNull() & _as(v, kind).isNull()).alias(f"m{i}_{j}") for j, (kind, _) in enumerate(TYPES)]
    if not columns:
        return {}
    got = df.agg(*sums).first()

    def of(i: int) -> str:
        n = got[f"n{i}"]
        return next((kind for j, (kind, _) in enumerate(TYPES) if n and got[f"m{i}_{j}"] <= tolerance * n), "string")

    return {c: of(i) for i, c in enumerate(columns)}


def typed(df: DataFrame, types: dict[str, str], broken: Column | None = None, reason: str = "misfits") -> tuple[DataFrame, DataFrame]:
    """(kept, set aside): rows of text columns by the types; set aside rows keep their text and name the columns in ``reason``."""
    bad = [F.when(F.col(f"`{c}`").isNotNull() & _as(F.col(f"`{c}`"), k).isNull(), F.lit(c)) for c, k in types.items() if k != "string"]
    names = F.array_compact(F.array(*bad, F.when(F.lit(False) if broken is None else broken, F.lit("(row)")), F.lit(None).cast("string")))
    out = df.withColumn(reason, names)
    kept = out.where(F.size(reason) == 0).select(*[_as(F.col(f"`{c}`"), k).alias(c) for c, k in types.items()])
    return kept, out.where(F.size(reason) > 0).select(*[F.col(f"`{c}`") for c in types], reason)


def _free(names: list[str], name: str) -> str:
    return reduce(lambda n, _: n + "_" if n.lower() in {x.lower() for x in names} else n, range(len(names) + 1), name)


def read_csv_typed(spark: SparkSession, path: str, tolerance: float = 0.0, schema: dict[str, str] | None = None,
                   **options) -> tuple[DataFrame, DataFrame]:
    """(kept, set aside) of a CSV with a header.  schema: types of columns that are known and not searched for."""
    reader = spark.read.options(**{"header": True, **options})
    names = reader.csv(path).columns  # the header line only
    raw, reason = _free(names, "raw_record"), _free(names, "misfits")
    text = StructType()
    for n in [*names, raw]:
        text = text.add(n, StringType())
    # Without pruning every row is split whole, so that a row's fields count alike whatever columns a query takes.
    rows = (spark.read.options(**{"header": True, "mode": "PERMISSIVE", **options, "columnPruning": False}).schema(text)
                 .option("columnNameOfCorruptRecord", raw).csv(path))
    broken, given = F.col(f"`{raw}`").isNotNull(), schema or {}
    found = find_types(rows, [n for n in names if n not in given], tolerance, ~broken)
    kept, aside = typed(rows, {n: given.get(n) or found[n] for n in names}, broken, reason)
    return kept, aside
