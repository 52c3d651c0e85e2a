"""Column helpers: every function takes and returns a ``Column`` so it stays
inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number as text: optional sign, digits with optional fraction (or a bare
# fraction), optional exponent, optional surrounding blanks.  Anything else
# (thousand separators, units such as ``12d``, empty text) coerces to 0.
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

NULL_KEY = "nan"

# The white space of Unicode, stripped from both ends of a key.
BLANKS = (" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


INTEGRAL = ("byte", "short", "integer", "long")
NUMERIC = INTEGRAL + ("float", "double", "decimal")


def _type_name(dtype) -> str | None:
    return None if dtype is None else dtype.typeName()


def key_norm(c, null_label: str | None = NULL_KEY, dtype=None) -> Column:
    """Person key: text, blanks (tab/newline too) stripped at both ends, lower case.

    A null key becomes the explicit bucket ``null_label`` (pass ``None`` to
    keep nulls).  When ``dtype`` says the column is numeric the text cannot
    hold blanks, so the regex pass is skipped (integers need no lower-casing
    either).
    """
    name = _type_name(dtype)
    if name in INTEGRAL:
        text = _col(c).cast("string")
    elif name in NUMERIC:
        text = F.lower(_col(c).cast("string"))
    else:
        # btrim with the whitespace set, not a regex: same result, ~2x faster per row
        text = F.lower(F.btrim(_col(c).cast("string"), F.lit(BLANKS)))
    return text if null_label is None else F.coalesce(text, F.lit(null_label))


def money_units(c, dtype=None, scale: int = 4) -> Column:
    """A money value as a whole number of ``10**-scale`` units (``long``).

    Sums of these are exact, order independent and run on the fast
    primitive-long path of the aggregate (a ``decimal(38, s)`` sum falls back
    to BigDecimal arithmetic).  Divide by ``10**scale`` at the end.  The
    supported range is |value| < 9.2e18 / 10**scale (9.2e14 at the default
    scale 4) per row and per sum; ANSI mode turns anything beyond it into an
    error, never a wrong total (pass a smaller ``scale`` for larger amounts).
    """
    v = num_coerce(c, dtype)
    # rint (a single FPU op) instead of round(), which goes through BigDecimal
    # per row; they differ only on exact half-unit ties below 10**-scale.
    return F.rint(v * F.lit(float(10 ** scale))).cast("long")


def from_units(c, scale: int = 4) -> Column:
    """Units back to a double (correctly rounded: exact integer / power of ten)."""
    return _col(c).cast("double") / F.lit(float(10 ** scale))


FRACTION = 9


def money_parts(c, dtype=None) -> tuple[Column, Column]:
    """A value as two longs: its whole part (rounded down), and the rest in units of 1e-9.

    Sums of both run on the fast primitive path, do not depend on the order, and neither lose small
    values nor overflow before the whole parts exceed a long (9.2e18).  Longs and decimals are split
    in their own type; a double keeps nine decimals."""
    if _type_name(dtype) in INTEGRAL:
        return F.coalesce(_col(c).cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long")
    v = F.coalesce(_col(c), F.lit(0).cast(dtype)) if _type_name(dtype) == "decimal" else num_coerce(c, dtype)
    whole = F.floor(v)
    rest = (v - whole) * F.lit(Decimal(10 ** FRACTION) if _type_name(dtype) == "decimal" else float(10 ** FRACTION))
    return whole.cast("long"), F.round(rest).cast("long") if _type_name(dtype) == "decimal" else F.rint(rest).cast("long")


def exact_parts(whole, rest) -> Column:
    """Both sums as one decimal."""
    return _col(whole).cast("decimal(28,9)") + _col(rest).cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-FRACTION))


def from_parts(whole, rest) -> Column:
    """Both sums as a double: exact in decimals, rounded once."""
    return exact_parts(whole, rest).cast("double")


def num_coerce(c, dtype=None) -> Column:
    """Any value -> double; unparseable, null, NaN and +-inf become 0.

    ``dtype`` is the column's Spark type when known: numeric columns skip the
    text check entirely.
    """
    col = _col(c)
    if _type_name(dtype) in NUMERIC:
        v = col.cast("double")
    else:
        s = col.cast("string")
        v = F.when(s.rlike(NUMBER_TEXT), F.trim(s).try_cast("double"))
    v = F.nanvl(v, F.lit(0.0))
    v = F.when(F.abs(v) == float("inf"), F.lit(0.0)).otherwise(v)
    return F.coalesce(v, F.lit(0.0))


class Tier(NamedTuple):
    """Values from ``lo`` to ``hi`` (inclusive, None = open) are worth ``value``."""
    lo: object
    hi: object
    value: object

    @classmethod
    def of(cls, spec) -> Tier:
        lo, hi, value = (spec.get("min"), spec.get("max"), spec.get("value", 0)) if isinstance(spec, dict) else spec
        return cls(None if lo == "" else lo, None if hi == "" else hi, value)

    def holds(self, c: Column) -> Column:
        above = F.lit(True) if self.lo is None else c >= F.lit(self.lo)
        return above if self.hi is None else above & (c <= F.lit(self.hi))


def case_tier(c, tiers: Iterable, else_value=0) -> Column | None:
    """Value of the first tier that holds the column's value, else ``else_value``.  Tiers are ``(lo, hi, value)`` or
    dicts with min, max and value; one without any bound says nothing and is left out, and without any tier there
    is no column."""
    bounded = [t for t in map(Tier.of, tiers) if (t.lo, t.hi) != (None, None)]
    if not bounded:
        return None
    # put on from the last to the first, so that the first is asked first
    return reduce(lambda rest, t: F.when(t.holds(_col(c)), F.lit(t.value)).otherwise(rest), reversed(bounded), F.lit(else_value))


def to_day(c) -> Column:
    """``date(ts)`` / ``ts::date``."""
    return F.to_date(_col(c))


def contains_ci(c, pattern: str, literal: bool = False) -> Column:
    """Case-insensitive match of ``pattern`` (a Java regex unless ``literal``);
    a null cell never matches."""
    text = _col(c).cast("string")
    if literal:
        hit = F.lower(text).contains(pattern.lower())
    else:
        hit = text.rlike("(?i)" + pattern)
    return F.coalesce(hit, F.lit(False))


def unknown(c, label: str = "Unknown") -> Column:
    """Empty or missing text -> ``label``."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(label))


def safe_ratio_pct(num, den) -> Column:
    """``num / den * 100``; 0 when the denominator is 0 or null."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, n * F.lit(100.0) / d).otherwise(F.lit(0.0))


def fmt_pct(c, digits: int = 1) -> Column:
    """``12.3%``: rounded half-up at ``digits`` decimals, then formatted."""
    rounded = F.round(_col(c).cast("decimal(38,10)"), digits).cast(f"decimal(38,{digits})")
    return F.concat(rounded.cast("string"), F.lit("%"))


def fmt_thousands(c, digits: int = 0) -> Column:
    """``1,234,567`` style text."""
    return F.format_number(_col(c), digits)


def trunc_int(c) -> Column:
    """Truncation toward zero (``int()``)."""
    return _col(c).cast("double").cast("bigint")


def safe_name(c) -> Column:
    """Letters/digits of any script, ``_`` and ``-`` kept; everything else -> ``_``."""
    return F.regexp_replace(_col(c), r"[^\p{L}\p{N}_-]", "_")


def word_name(c) -> Column:
    """Anything outside ``[A-Za-z0-9_]`` -> ``_``."""
    return F.regexp_replace(_col(c), r"[^A-Za-z0-9_]", "_")


def any_of(cols: Iterable[Column]) -> Column:
    """OR-reduce (empty -> false)."""
    out = None
    for c in cols:
        out = c if out is None else (out | c)
    return F.lit(False) if out is None else out


def sum_of(cols: Iterable[Column]) -> Column:
    """Row-wise sum of columns (empty -> 0)."""
    out = None
    for c in cols:
        out = c if out is None else (out + c)
    return F.lit(0.0) if out is None else out
