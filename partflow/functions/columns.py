"""Column expressions of the domain. All are built-in functions: nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partflow.rules import BANDS, CRITICALITY, TIERS


def mapped(key: Column, values: dict, default=None) -> Column:
    """A literal map as a chain of conditions; other keys and null give the default."""
    out = None
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.otherwise(F.lit(default))


def part_key(number: Column) -> Column:
    """A part number without case, revision suffix, a slash suffix of up to three, and punctuation."""
    # The patterns of suffixes.
    bare = F.regexp_replace(F.upper(F.trim(number)), r"\s*(REV|REVISION)\s*[A-Z0-9]+$", "")
    bare = F.regexp_replace(bare, r"/[A-Z0-9]{1,3}$", "")
    return F.regexp_replace(bare, "[^A-Z0-9]", "")


def part_uid(key: Column) -> Column:
    return F.substring(F.sha2(key, 256), 1, 16)


def unpadded(number: Column, width: int = 18) -> Column:
    """Material numbers of full width and digits only lose their leading zeros; all zeros stay."""
    v = F.trim(number)
    return F.when((F.length(v) == width) & v.rlike("^0*[1-9][0-9]*$"), F.regexp_replace(v, "^0+", "")).otherwise(v)


def number_or_null(text: Column) -> Column:
    """A decimal number, else null; words like nan and suffixes like 1d aren't numbers."""
    v = F.trim(text)
    return F.when(v.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), v.try_cast("double"))


def compact_date(text: Column) -> Column:
    """yyyyMMdd or yyMMdd by length, else null."""
    v = F.trim(text)
    digits = v.rlike("^[0-9]+$")
    long_ = F.when(digits & (F.length(v) == 8), F.try_to_timestamp(v, F.lit("yyyyMMdd")))
    return F.coalesce(long_, F.when(digits & (F.length(v) == 6), F.try_to_timestamp(v, F.lit("yyMMdd")))).cast("date")


def clamped(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def round_even(x: Column, digits: int) -> Column:
    """x, a double, to so many digits, halves to even: x times a power of ten is rounded, as SQL and pandas do.

    bround rounds the decimal digits of x instead, so 225.14999999999998, whose tenfold is 2251.5 in doubles, would be 225.1.
    """
    return F.rint(x * float(10**digits)) / float(10**digits) + 0.0  # no negative zero


def recency_weight(order_date: Column, as_of: Column, half_life_days: int) -> Column:
    return F.pow(F.lit(0.5), F.greatest(F.datediff(as_of, order_date), F.lit(0)) / F.lit(float(half_life_days)))


def risk_band(score: Column) -> Column:
    (a, x), (b, y), (c, z) = BANDS
    return F.when(score >= a, x).when(score >= b, y).when(score >= c, z).otherwise("LOW")


def supplier_tier(score: Column) -> Column:
    (a, x), (b, y), (c, z) = TIERS
    return F.when(score <= a, x).when(score <= b, y).when(score <= c, z).when(score.isNotNull(), "PREFERRED")


def criticality_factor(code: Column) -> Column:
    return F.coalesce(mapped(code, CRITICALITY), F.lit(0.5))


def hours_between(start: Column, end: Column) -> Column:
    """Hour boundaries crossed, as warehouses count them."""
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", start), F.date_trunc("HOUR", end))
