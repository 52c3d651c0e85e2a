"""Merge any number of KPI tables into one payout row per person.

Plan shape (one shuffle, whatever the number of KPI tables):

    KPI_1 --project(key, v1, null, ...)--+
    KPI_2 --project(key, null, v2, ...)--+--> union --> groupBy(key).sum(v1..vn) --> fill/total --> sort
    ...                                  |
    KPI_n --project(key, null, ..., vn)--+

The union is narrow; the single ``groupBy`` does a map-side partial sum, so a
key that owns a third of all rows is collapsed to one row per map task before
it crosses the network.  It replaces an N-way FULL OUTER JOIN chain (N-1
shuffles, each with a skew-prone join) with the same result: the key set is
the union of all keys, missing values are 0.

Money is summed as two longs, the whole part and the rest in units of 1e-9
(fast primitive aggregation, order independent), and turned back into a double
at the end.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, NumericType

from kpiloom.functions.scalars import FRACTION, INTEGRAL, NULL_KEY, exact_parts, from_parts, key_norm, money_parts

# Person-key column candidates (first present wins, compared in
# lower case) and the words that mark a payout column.
KEY_CANDIDATES = ["inspection_by", "employee_email", "cj_email", "email", "inspector"]
VALUE_KEYWORDS = ["incentive", "bonus", "payout"]


@dataclass(frozen=True)
class Mapping:
    """One KPI value column to merge: ``df[key_col]`` -> person, ``df[val_col]`` -> ``label``."""
    df: DataFrame
    key_col: str
    val_col: str
    label: str
    negate: bool = False          # penalties enter the merge with their sign flipped


def q(name: str) -> Column:
    """Column by exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def default_key(df: DataFrame) -> str:
    """The column that names the person: the best known candidate that the table has, else its first column."""
    rank = {name: i for i, name in enumerate(KEY_CANDIDATES)}
    return min(df.columns, key=lambda c: rank.get(c.lower(), len(rank)))


def default_values(df: DataFrame, key: str) -> list[str]:
    """The payout columns: those that a keyword names and, if none is, the first numeric one beside the key
    (else the first other column, whose text is coerced)."""
    word = re.compile("|".join(VALUE_KEYWORDS), re.I)
    others = [f for f in df.schema.fields if f.name != key]
    named = [f.name for f in others if word.search(f.name)]
    numeric = [f.name for f in others if isinstance(f.dataType, NumericType)]
    return named or numeric[:1] or [f.name for f in others[:1]]


def mappings_for(df: DataFrame, prefix: str, key_col: str | None = None,
                 val_cols: list[str] | None = None) -> list[Mapping]:
    """Mappings for one KPI table with the default key/value detection.

    Label = ``prefix`` for a single value column, ``prefix__column`` for several.
    """
    key = key_col or default_key(df)
    vals = val_cols if val_cols is not None else default_values(df, key)
    return [Mapping(df, key, v, prefix if len(vals) == 1 else f"{prefix}__{v}") for v in vals]


def presum(df: DataFrame, key_col: str, val_col: str, key_name: str = "cj_id", label: str | None = None,
           null_key: str | None = NULL_KEY) -> DataFrame:
    """One row per normalised key with the summed, coerced value (``agg_key_presum``)."""
    label = label or val_col
    dtype = df.schema[val_col].dataType
    ktype = df.schema[key_col].dataType
    whole, rest = money_parts(q(val_col), dtype)
    return (df.select(key_norm(q(key_col), null_key, ktype).alias(key_name), whole.alias("_w"), rest.alias("_r"))
              .groupBy(key_name)
              .agg(from_parts(F.sum("_w"), F.sum("_r")).alias(label)))


def consolidate(mappings: list[Mapping], key_name: str = "cj_id", total_name: str = "total_incentive",
                null_key: str | None = NULL_KEY, sort: bool = True) -> DataFrame:
    """Payout table: ``key_name``, one column per label (missing = 0), ``total_name``.

    Sorted by total descending with the key as tie-break (a total order, so
    paging is repeatable).
    """
    wide, key = _merged(mappings, key_name, total_name, null_key)
    out = wide.select(key, *[from_parts(f"_v{j}", f"_r{j}").alias(m.label) for j, m in enumerate(mappings)],
                      from_parts(*_parts_of(range(len(mappings)))).alias(total_name))
    if sort:
        out = out.orderBy(F.col(total_name).desc(), F.col(key_name).asc())
    return out


def _parts_of(places) -> tuple[Column, Column]:
    """The sum over some of the merged values, as whole parts and rests."""
    zero = F.lit(0).cast("long")
    return tuple(reduce(lambda a, b: a + b, [F.col(f"_{p}{j}") for j in places], zero) for p in "vr")


def _merged(mappings: list[Mapping], key_name: str, total_name: str, null_key: str | None) -> tuple[DataFrame, Column]:
    """One row per person with both sums (``_v<j>``, ``_r<j>``) of every mapping, and the key as text."""
    if not mappings:
        raise ValueError("consolidate needs at least one mapping")
    labels = [m.label for m in mappings]
    dupes = sorted({lab for lab in labels if labels.count(lab) > 1})
    if dupes:
        raise ValueError(f"duplicate merge labels: {dupes}")
    if key_name in labels or total_name in labels:
        raise ValueError("a label collides with the key or total column name")

    # One projection per (source table, key column): several value columns of
    # the same table are read in the same pass.
    groups: dict[tuple[int, str], list[int]] = {}
    for i, m in enumerate(mappings):
        groups.setdefault((id(m.df), m.key_col), []).append(i)
    # Integer keys everywhere: group on the long key and make it text after
    # the aggregate (cheaper hashing; the cast is one-to-one).
    integral = all(m.df.schema[m.key_col].dataType.typeName() in INTEGRAL for m in mappings)
    parts = []
    for (_, key_col), idx in groups.items():
        src = mappings[idx[0]].df
        key = q(key_col).cast("long") if integral else key_norm(q(key_col), null_key, src.schema[key_col].dataType)
        cols = [key.alias(key_name)]
        for j, m in enumerate(mappings):
            if j in idx:
                value = money_parts(q(m.val_col), src.schema[m.val_col].dataType)
                whole, rest = (-value[0], -value[1]) if m.negate else value
            else:
                whole = rest = F.lit(None).cast("long")
            cols += [whole.alias(f"_v{j}"), rest.alias(f"_r{j}")]
        parts.append(src.select(*cols))
    long = reduce(DataFrame.unionAll, parts)

    sums = [F.coalesce(F.sum(f"_{p}{j}"), F.lit(0).cast("long")).alias(f"_{p}{j}") for j in range(len(mappings)) for p in "vr"]
    wide = long.groupBy(key_name).agg(*sums)
    key_out = key_norm(F.col(key_name), null_key, LongType()) if integral else F.col(key_name)
    return wide, key_out.alias(key_name)


def net_payout(incentives: list[Mapping], reimbursements: list[Mapping] = (), penalties: list[Mapping] = (),
               tips: list[Mapping] = (), severity: list[Mapping] = (), key_name: str = "cj_id",
               total_name: str = "net_payout", share_name: str = "incentive_share") -> DataFrame:
    """Incentives + reimbursements + tips - penalties per person.

    Penalty values are negated before the merge; tips pass through whole.
    ``severity`` holds points for critical cases (see
    :func:`kpiloom.operators.rules.critical_outcome`): with a point, half of
    the incentives is paid, with two or more none; the other components are not
    touched.  The share paid is a column of its own then.  One merge (one
    shuffle) over all components.
    """
    negated = [Mapping(m.df, m.key_col, m.val_col, m.label, negate=not m.negate) for m in penalties]
    paid = [*incentives, *reimbursements, *tips, *negated]
    if not severity:
        return consolidate(paid, key_name=key_name, total_name=total_name, sort=False)
    wide, key = _merged([*paid, *severity], key_name, total_name, NULL_KEY)
    points = _parts_of(range(len(paid), len(paid) + len(severity)))[0]
    share = F.when(points >= 2, 0.0).when(points >= 1, 0.5).otherwise(1.0).cast("decimal(2,1)")
    earned, rest = exact_parts(*_parts_of(range(len(incentives)))), exact_parts(*_parts_of(range(len(incentives), len(paid))))
    return wide.select(key, *[from_parts(f"_v{j}", f"_r{j}").alias(m.label) for j, m in enumerate(paid)],
                       share.cast("double").alias(share_name), (earned * share + rest).cast("double").alias(total_name))


def row_total(df: DataFrame, label_cols: list[str], total_name: str = "total") -> DataFrame:
    """Row-wise sum of ``label_cols`` after numeric coercion (missing -> 0)."""
    parts = [money_parts(q(c), df.schema[c].dataType) for c in label_cols]
    zero = F.lit(0).cast("long")
    return df.withColumn(total_name, from_parts(reduce(lambda a, p: a + p[0], parts, zero), reduce(lambda a, p: a + p[1], parts, zero)))


def payout_cards(merged: DataFrame, key_col: str = "cj_id", total_col: str = "total_incentive",
                 empty_label: str = "—") -> DataFrame:
    """One row: head count, payout total and average (truncated to whole units), top earner.

    The top earner is the key with the largest total, smallest key on ties
    (``min_by`` over a struct, a plain aggregate, no sort).  The grand total
    is a decimal sum: it runs over one row per person and may exceed the
    range of the per-person long units.
    """
    money = DecimalType(38, FRACTION)
    total = q(total_col).cast(money)
    return merged.agg(
        F.count(F.lit(1)).alias("total_people"),
        F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("total_payout"),
        F.avg(total).cast("bigint").alias("avg_payout"),
        F.coalesce(F.min_by(q(key_col).cast("string"), F.struct((-total).alias("t"), q(key_col).alias("k"))),
                   F.lit(empty_label)).alias("top_earner"),
    )
