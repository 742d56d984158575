import pytest
from pyspark.sql import functions as F

from partflow.functions import columns as C
from partflow.rules import RULES


def values(spark, rows, make):
    df = spark.createDataFrame([(x,) for x in rows], "x string")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


def test_part_keys_of_all_spellings_agree(spark):
    found = values(spark, ["AB-100.7", "ab 1007 rev c", "AB1007/X9", " ab-1007 REVISION 12 ", None], C.part_key)
    assert found == ["AB1007"] * 4 + [None]


def test_unpadding_touches_full_width_digits_only(spark):
    assert values(spark, ["0" * 15 + "123", "0" * 18, "00123", "0" * 14 + "AB12", None], C.unpadded) == ["123", "0" * 18, "00123", "0" * 14 + "AB12", None]


def test_numbers_and_dates(spark):
    assert values(spark, ["1.5", " 2 ", "1.5d", "nan", "", "-3e2", None], C.number_or_null) == [1.5, 2.0, None, None, None, -300.0, None]
    assert [str(x) for x in values(spark, ["20260715", "260715", "2026", "20261340", None], C.compact_date)] == ["2026-07-15", "2026-07-15", "None", "None", "None"]


def test_bands_and_tiers_at_their_borders(spark):
    assert values(spark, ["80", "79.9", "60", "40", "39.9"], lambda x: C.risk_band(x.cast("double"))) == ["CRITICAL", "HIGH", "HIGH", "MEDIUM", "LOW"]
    assert values(spark, ["50", "50.1", "70", "85", "85.1", None], lambda x: C.supplier_tier(x.cast("double"))) == ["CRITICAL", "WATCH", "WATCH", "ACCEPTABLE", "PREFERRED", None]


def test_hours_count_borders(spark):
    df = spark.sql("select timestamp'2024-01-01 00:59:00' a, timestamp'2024-01-01 01:01:00' b")
    assert df.select(C.hours_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_weights_sum_to_one():
    assert sum(getattr(RULES, f"weight_{f}") for f in ("criticality", "coverage", "replenishment", "supplier", "customs")) == pytest.approx(1)


def test_halves_are_rounded_as_in_sql(spark):
    """19 pieces at a demand of 200 in 79 months last 225.15 days, just below it in doubles: 225.2, as DuckDB's SQL and pandas say."""
    rows = [(19.0, 200.0 / 79), (20.5, 30.0), (2.5, 3.0), (-0.01, 30.0), (None, 30.0)]
    df = spark.createDataFrame(rows, "q double, m double").select((F.col("q") / (F.col("m") / 30.0)).alias("x"))
    got = [r[0] for r in df.select(C.round_even(F.col("x"), 1)).collect()]
    assert got == [225.2, 20.5, 25.0, 0.0, None]
    assert str(got[3]) == "0.0"
