"""Lead-time profiles and the supplier scorecard."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from partflow.functions.columns import clamped, recency_weight, round_even, supplier_tier
from partflow.rules import RULES, Rules

QUANTILES = {"p50_days": 0.50, "p80_days": 0.80, "p95_days": 0.95}
MEASURES = ("n_deliveries", *QUANTILES, "mean_days", "volatility_days", "on_time_rate", "avg_slip_days", "trend_days_per_year")


def _error_counts() -> list:
    return [F.count(F.lit(1)).alias("delivered"), F.count_if(F.col("actual_delivery_date") < F.col("order_date")).alias("negative_lead_times")]


def prepare_deliveries(orders: DataFrame, as_of: datetime.date, rules: Rules = RULES, observed: Observation | None = None) -> DataFrame:
    """Delivered lines ordered within the lookback, with lead time, slip and on_time.

    Lines with a negative lead time are entry errors and go; observed, where one is given, gets the counts delivered and
    negative_lead_times when the result is first read. A line without a promised date has no slip and isn't on time.
    """
    slip = F.datediff("actual_delivery_date", "promised_date")
    recent = orders.filter(F.col("actual_delivery_date").isNotNull()).filter(F.col("order_date") >= F.date_sub(F.lit(as_of), rules.lookback_days))
    if observed is not None:
        recent = recent.observe(observed, *_error_counts())
    return (
        recent.withColumn("actual_lead_time_days", F.datediff("actual_delivery_date", "order_date"))
        .filter(F.col("actual_lead_time_days") >= 0)
        .withColumn("slip_days", slip)
        .withColumn("on_time", F.coalesce(slip.between(-rules.early_tolerance_days, rules.late_tolerance_days), F.lit(False)))
    )


def entry_errors(orders: DataFrame, as_of: datetime.date, rules: Rules = RULES) -> DataFrame:
    """One row: how many delivered lines of the lookback ``prepare_deliveries`` drops for a negative lead time."""
    recent = orders.filter(F.col("actual_delivery_date").isNotNull() & (F.col("order_date") >= F.date_sub(F.lit(as_of), rules.lookback_days)))
    return recent.agg(*_error_counts())


def written_deliveries(orders: DataFrame, as_of: datetime.date, path: str, rules: Rules = RULES) -> tuple[DataFrame, DataFrame]:
    """``prepare_deliveries`` written to path and read again, and ``entry_errors`` of the same scan."""
    spark, observed = orders.sparkSession, Observation()
    prepare_deliveries(orders, as_of, rules, observed).write.mode("overwrite").parquet(path)
    counts = observed.get
    errors = spark.createDataFrame([(counts["delivered"], counts["negative_lead_times"])], "delivered long, negative_lead_times long")
    return spark.read.parquet(path), errors


def lead_time_profiles(deliveries: DataFrame, as_of: datetime.date, keys: tuple[str, ...] = ("supplier_id",), rules: Rules = RULES) -> DataFrame:
    """One row for each key: recency-weighted quantiles, mean, deviation, on-time rate and slip, trend, confidence.

    Deliveries are first summed by key and lead time in days, on the map side too, so that a key
    with a large share of all lines comes to the quantile window as a few hundred rows. Among equal
    lead times the order is that of the order dates, so a lead time's weighted positions run from
    half its smallest weight to half its largest before its end.
    """
    keys = list(keys)
    w, v = F.col("w"), F.col("v")
    by_value = (
        deliveries.withColumn("w", recency_weight(F.col("order_date"), F.lit(as_of), rules.half_life_days))
        .withColumn("v", F.col("actual_lead_time_days"))
        .withColumn("x", F.datediff("order_date", F.lit(as_of)).cast("long"))
        .groupBy(*keys, "v")
        .agg(
            F.count("*").alias("n"),
            F.sum(w).alias("sw"),
            F.min(w).alias("w_first"),
            F.max(w).alias("w_last"),
            F.sum(w * F.col("on_time").cast("double")).alias("s_on_time"),
            F.sum(w * F.coalesce("slip_days", F.lit(0))).alias("s_slip"),
            F.sum("x").alias("sx"),
            F.sum(F.col("x") * F.col("x")).alias("sxx"),
        )
    )
    of_key = Window.partitionBy(*keys)
    in_order = of_key.orderBy("v")
    before = F.sum("sw").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("sw")
    placed = by_value.withColumn("total", F.sum("sw").over(of_key)).withColumns(
        {
            "start": (before + F.col("w_first") / 2) / F.col("total"),
            "end": (before + F.col("sw") - F.col("w_last") / 2) / F.col("total"),
        }
    )
    placed = placed.withColumns(
        {
            "is_first": F.row_number().over(in_order) == 1,
            "next_start": F.lead("start").over(in_order),
            "next_v": F.lead("v").over(in_order),
        }
    )

    def quantile(q: float):
        inside = (F.lit(q) >= F.col("start")) & (F.lit(q) <= F.col("end"))
        low, high = F.col("is_first") & (F.lit(q) < F.col("start")), F.col("next_v").isNull() & (F.lit(q) > F.col("end"))
        between = (F.lit(q) > F.col("end")) & (F.lit(q) < F.col("next_start"))
        share = (F.lit(q) - F.col("end")) / (F.col("next_start") - F.col("end"))
        return F.max(F.when(inside | low | high, v.cast("double")).when(between, v + share * (F.col("next_v") - v)))

    n, mean = F.col("n_deliveries"), F.col("mean_days")
    sums = placed.groupBy(*keys).agg(
        F.sum("n").alias("n_deliveries"),
        *[quantile(q).alias(name) for name, q in QUANTILES.items()],
        F.max("total").alias("total"),
        (F.sum(F.col("sw") * v) / F.max("total")).alias("mean_days"),
        (F.sum(F.col("sw") * v * v) / F.max("total")).alias("square"),
        (F.sum("s_on_time") / F.max("total")).alias("on_time_rate"),
        (F.sum("s_slip") / F.max("total")).alias("avg_slip_days"),
        F.sum("sx").alias("sx"),
        F.sum("sxx").alias("sxx"),
        F.sum(F.col("sx") * v).alias("sxy"),
        F.sum(F.col("n") * v).alias("sy"),
    )
    spread = n * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.try_divide(F.lit(365.0) * (n * F.col("sxy") - F.col("sx") * F.col("sy")), spread)
    return sums.withColumns(
        {
            "volatility_days": F.sqrt(F.greatest(F.lit(0.0), F.col("square") - mean * mean)),
            "trend_days_per_year": F.when(n >= 3, F.coalesce(slope, F.lit(0.0))).otherwise(0.0),
            "confidence": F.when(n >= rules.high_confidence_deliveries, "HIGH").when(n >= rules.least_deliveries, "MEDIUM").otherwise("LOW"),
        }
    ).select(*keys, *MEASURES, "confidence")


def supplier_part_lead_times(orders: DataFrame, as_of: datetime.date, rules: Rules = RULES) -> DataFrame:
    """A profile for each supplier and part; with too few deliveries that of the supplier, marked FALLBACK."""
    deliveries = prepare_deliveries(orders, as_of, rules)
    own = lead_time_profiles(deliveries, as_of, ("supplier_id", "part_number"), rules)
    supplier = lead_time_profiles(deliveries, as_of, ("supplier_id",), rules)
    supplier = supplier.withColumnsRenamed({c: f"s_{c}" for c in MEASURES}).drop("confidence")
    enough = F.col("n_deliveries") >= rules.least_deliveries
    joined = own.join(supplier, "supplier_id")
    return joined.select(
        "supplier_id",
        "part_number",
        *[F.when(enough, F.col(c)).otherwise(F.col(f"s_{c}")).alias(c) for c in MEASURES],
        F.when(enough, F.col("confidence")).otherwise("FALLBACK").alias("confidence"),
    )


def supplier_scorecard(orders: DataFrame, as_of: datetime.date, suppliers: DataFrame | None = None, rules: Rules = RULES) -> DataFrame:
    """Profiles with on-time, consistency and trend scores, their blend, a tier and the gap to contract, worst first."""
    card = lead_time_profiles(prepare_deliveries(orders, as_of, rules), as_of, ("supplier_id",), rules)
    otd = F.col("on_time_rate") * 100
    consistency = (1 - clamped(F.col("volatility_days") / F.greatest(F.col("p50_days"), F.lit(1.0)))) * 100
    trend = (1 - (clamped(F.col("trend_days_per_year"), -30.0, 30.0) + 30) / 60) * 100
    card = card.withColumns(
        {
            "otd_score": round_even(otd, 1),
            "consistency_score": round_even(consistency, 1),
            "trend_score": round_even(trend, 1),
            # The blend.
            "composite_score": round_even(0.55 * otd + 0.30 * consistency + 0.15 * trend, 1),
        }
    )
    card = card.withColumn("risk_tier", supplier_tier(F.col("composite_score")))
    if suppliers is not None:
        card = card.join(suppliers.select("supplier_id", "supplier_name", "country", "base_lead_time_days"), "supplier_id", "left")
        card = card.withColumn("contract_gap_days", round_even(F.col("p80_days") - F.col("base_lead_time_days"), 1))
    return card.orderBy("composite_score", "supplier_id")
