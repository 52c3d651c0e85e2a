"""The incentive scheme: a read-only rule table, loaded as text and typed by
:func:`kpiloom.operators.rules.scheme_parse`."""

from __future__ import annotations

import csv
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

SCHEME_COLUMNS = ["Category", "Sub_Category", "Region_or_Condition", "Slab_or_Range", "Amount_or_Payout", "Notes"]
SCHEME_SCHEMA = StructType([StructField(c, StringType(), True) for c in SCHEME_COLUMNS])

# The incentive scheme rule sheet, 44 rows in their original
# order (CSV text with a header).
SCHEME_CSV = """\
Category,Sub_Category,Region_or_Condition,Slab_or_Range,Amount_or_Payout,Notes
Incentive,Productivity,T7 Regions,3 Inspections/Day,0,
Incentive,Productivity,T7 Regions,4 Inspections/Day,0,
Incentive,Productivity,T7 Regions,5 Inspections/Day,100,
Incentive,Productivity,T7 Regions,6 Inspections/Day,300,
Incentive,Productivity,T7 Regions,7 Inspections/Day,500,
Incentive,Productivity,T7 Regions,8 Inspections/Day,800,
Incentive,Productivity,T7 Regions,9+ Inspections/Day,1000,
Incentive,Productivity,Non T7,3 Inspections/Day,0,
Incentive,Productivity,Non T7,4 Inspections/Day,50,
Incentive,Productivity,Non T7,5 Inspections/Day,150,
Incentive,Productivity,Non T7,6 Inspections/Day,300,
Incentive,Productivity,Non T7,7 Inspections/Day,500,
Incentive,Productivity,Non T7,8 Inspections/Day,700,
Incentive,Productivity,Non T7,9+ Inspections/Day,1000,
Incentive,SP / SP Lite,All,1 Order/Day,40,
Incentive,SP / SP Lite,All,2 Orders/Day,130,
Incentive,SP / SP Lite,All,3 Orders/Day,200,
Incentive,SP / SP Lite,All,4 Orders/Day,300,
Incentive,SP / SP Lite,All,5 Orders/Day,400,
Incentive,SP / SP Lite,All,6 Orders/Day,500,
Incentive,SP / SP Lite,All,7 Orders/Day,600,
Incentive,SP / SP Lite,All,8 Orders/Day,700,
Incentive,SP / SP Lite,All,9+ Orders/Day,800,
Incentive,SP Pro,All,Per inspection,150,Rs. 150 per inspection
Incentive,Excellence Bonus,All,>120 Inspections/Month + 70% Conversion,3000,Rs. 3000 per month
Incentive,PDI,All,Per inspection,50,Rs. 50 per inspection
Incentive,CJ 5 Star Rating,All,Per 5-star rated inspection,10,Rs. 10 per inspection
Incentive,Night Inspection,All,Per inspection (6 PM - 10 PM only),150,Booked AND inspected in night slots
Penalty,IM,All,RFC 1 - 2000,500,
Penalty,IM,All,RFC 2001 - 5000,1000,
Penalty,IM,All,RFC 5001 - 7500,1500,
Penalty,IM,All,RFC 7501 - 10000,2500,
Penalty,Critical IM (Regular CJ),All,INR 10000 - 13500,Half Incentive (Incl. VAS),
Penalty,Critical IM (Regular CJ),All,INR 13501 - 19999,Zero Incentive (Incl. VAS),
Penalty,Critical IM (Regular CJ),All,Single IM >= INR 20000,CJ Exit,
Penalty,Critical IM (Regular CJ),All,Two Critical IMs,CJ Exit,
Penalty,Critical IM (0-60 Days from DOJ),All,INR 10000 - 13500,INR 2500,
Penalty,Critical IM (0-60 Days from DOJ),All,INR 13501 - 19999,Zero Incentive,
Penalty,Critical IM (0-60 Days from DOJ),All,Single IM >= INR 20000,Zero Incentive,
Penalty,Critical IM (0-60 Days from DOJ),All,Two Critical IMs,Zero Incentive,
Penalty,1 Star Rating,All,Per 1-star rated inspection,200,Rs. 200 per inspection
Reimbursement,Conveyance,All,Per Km,6,Inspection Done cases only (exceptions allowed case-by-case)
Note,Tipping,All,—,—,No change. Full tip amount passed to CJ.
Note,Referral,All,Per Referral,4000,No change in CJ Referral Policy
"""


def scheme_rows() -> list[tuple]:
    rows = list(csv.reader(io.StringIO(SCHEME_CSV)))
    return [tuple((v if v != "" else None) for v in r) for r in rows[1:]]


def load_scheme(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The rule sheet as strings plus ``rule_no`` (1-based sheet order):
    from a CSV file when ``path`` is given, else the built-in copy above.  Re-read on every call (never cached)."""
    if path:
        rows = spark.read.csv(path, header=True, schema=SCHEME_SCHEMA, encoding="utf-8")
        # a sheet is one partition, so the ids are the sheet's order
        return rows.select((F.monotonically_increasing_id() + 1).cast("int").alias("rule_no"), "*")
    schema = StructType([StructField("rule_no", IntegerType(), False)] + SCHEME_SCHEMA.fields)
    rows = [(i + 1, *r) for i, r in enumerate(scheme_rows())]
    # from Arrow it is a local relation, whose size the planner knows when it chooses a join
    return spark.createDataFrame(pa.table({f.name: list(v) for f, v in zip(schema.fields, zip(*rows))}, to_arrow_schema(schema)), schema)


def scheme_amount(sub_category: str) -> float:
    """Per-unit amount of a single-row rule (e.g. ``SP Pro`` -> 150.0)."""
    hits = [r for r in scheme_rows() if r[1] == sub_category]
    if len(hits) != 1:
        raise KeyError(f"{sub_category!r} is not a single-row rule")
    return float(hits[0][4])


SCHEME_SHEET = "scheme"


def with_scheme_first(spark: SparkSession, sheets: dict, name: str = SCHEME_SHEET, path: str | None = None) -> dict:
    """Sheets with the (freshly re-read) scheme first; any stale copy is replaced."""
    out = {name: load_scheme(spark, path)}
    out.update({k: v for k, v in sheets.items() if k != name})
    return out
