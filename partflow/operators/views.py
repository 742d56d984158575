"""Analytical views over the hub's tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partflow.functions.columns import hours_between
from partflow.operators.stock import latest_snapshot
from partflow.rules import RULES, Rules


def parts_by_chapter(parts: DataFrame) -> DataFrame:
    return parts.groupBy("ata_chapter").agg(
        F.min("ata_chapter_name").alias("ata_chapter_name"),
        F.count("*").alias("part_count"),
        F.count_if(F.col("criticality") == "NO_GO").alias("no_go_parts"),
        F.count_if("single_source_flag").alias("single_sourced_parts"),
        F.round(F.avg("unit_cost_usd"), 2).alias("avg_unit_cost_usd"),
    )


def latest_scorecard(snapshots: DataFrame, suppliers: DataFrame) -> DataFrame:
    """The newest scorecard of each supplier: a grouped maximum, which combines before the shuffle."""
    kept = [c for c in snapshots.columns if c not in ("supplier_id", "as_of_date", "supplier_name", "country", "base_lead_time_days")]
    last = snapshots.groupBy("supplier_id").agg(F.max_by(F.struct("as_of_date", *kept), "as_of_date").alias("l"))
    return last.join(suppliers, "supplier_id").select(
        "supplier_id",
        "supplier_name",
        "country",
        "approved_vendor",
        "l.as_of_date",
        "l.n_deliveries",
        "l.p80_days",
        "base_lead_time_days",
        "l.contract_gap_days",
        F.round(F.col("l.on_time_rate") * 100, 1).alias("on_time_pct"),
        "l.on_time_rate",
        "l.volatility_days",
        "l.trend_days_per_year",
        "l.composite_score",
        "l.risk_tier",
        "l.confidence",
    )


def supplier_trend(snapshots: DataFrame) -> DataFrame:
    """Quarterly averages and the change from the supplier's quarter before (its last row, not the calendar's)."""
    quarter = F.date_trunc("quarter", "as_of_date").cast("date")
    by_quarter = snapshots.groupBy("supplier_id", quarter.alias("qtr")).agg(
        F.avg("composite_score").alias("score"), (F.avg("on_time_rate") * 100).alias("otd")
    )
    before = F.lag("score").over(Window.partitionBy("supplier_id").orderBy("qtr"))
    return by_quarter.select(
        "supplier_id",
        "qtr",
        F.round("score", 1).alias("avg_score"),
        F.round("otd", 1).alias("avg_otd_pct"),
        F.round(F.col("score") - before, 1).alias("score_delta_qoq"),
    )


def single_source_exposure(parts: DataFrame, orders: DataFrame, scorecard: DataFrame) -> DataFrame:
    """Critical parts with one source whose latest order from a weak supplier names it.

    Tiers are filtered before the latest order is picked. Of orders of a day the largest number wins, and of parts
    with one number the smallest row.
    """
    weak = scorecard.filter(F.col("risk_tier").isin("CRITICAL", "WATCH"))
    weak = weak.select("supplier_id", "supplier_name", "composite_score", "risk_tier", "p80_days")
    exposed = parts.filter(F.col("single_source_flag") & F.col("criticality").isin("NO_GO", "GO_IF"))
    latest = (
        orders.join(weak, "supplier_id")
        .groupBy("part_number")
        .agg(
            F.max_by(
                F.struct("supplier_id", "supplier_name", "composite_score", "risk_tier", "p80_days"),
                F.struct("order_date", "po_number", "po_line", "supplier_id"),
            ).alias("s")
        )
    )
    exposed = exposed.groupBy("part_number").agg(F.min(F.struct("description", "criticality", "unit_cost_usd")).alias("p"))
    return exposed.join(latest, "part_number").select("part_number", "p.*", "s.*")


def risk_heatmap(risk_history: DataFrame, parts: DataFrame, rules: Rules = RULES, date: str = "scored_at") -> DataFrame:
    """Risk by chapter and criticality at the last scoring, by a date that a stored history may be partitioned by."""
    now = latest_snapshot(risk_history, date).select("part_number", "criticality", "risk_band", "aog_risk_score")
    joined = now.join(parts.select("part_number", "ata_chapter", "ata_chapter_name", "unit_cost_usd"), "part_number")
    at_risk = F.when(F.col("aog_risk_score") >= rules.at_risk_score, F.col("unit_cost_usd")).otherwise(0.0)
    return joined.groupBy("ata_chapter", "ata_chapter_name", "criticality").agg(
        F.count("*").alias("parts_scored"),
        F.count_if(F.col("risk_band") == "CRITICAL").alias("critical_parts"),
        F.count_if(F.col("risk_band").isin("CRITICAL", "HIGH")).alias("at_risk_parts"),
        F.round(F.avg("aog_risk_score"), 1).alias("avg_risk_score"),
        F.round(F.max("aog_risk_score"), 1).alias("max_risk_score"),
        F.round(F.sum(at_risk), 2).alias("value_at_risk_usd"),
    )


def blocked_work_orders(work_orders: DataFrame, parts: DataFrame, snapshots: DataFrame, risk_history: DataFrame, orders: DataFrame, as_of: datetime.date, date: str = "scored_at") -> DataFrame:
    """Open work orders whose part is short, with the risk of the part at the last date and its next receipt.

    The earliest receipt is a grouped minimum of the open orders of a part, dated ones first. A work order is one row: of
    parts with one number the smallest row counts, and the highest risk.
    """
    stock = latest_snapshot(snapshots, "snapshot_date").groupBy("part_number").agg(F.sum("qty_available").alias("stock"))
    scored = latest_snapshot(risk_history, date).groupBy("part_number")
    risk = scored.agg(F.max(F.struct("aog_risk_score", "risk_band", "primary_driver")).alias("r")).select("part_number", "r.*")
    named = parts.groupBy("part_number").agg(F.min(F.struct("description", "criticality")).alias("p")).select("part_number", "p.*")
    receipt = orders.filter("status = 'OPEN'").groupBy("part_number").agg(F.min("promised_date").alias("next_receipt_date"))
    available = F.coalesce("stock", F.lit(0))
    return (
        work_orders.filter("status = 'OPEN'")
        .join(named, "part_number")
        .join(stock, "part_number", "left")
        .filter(F.col("qty_required") > available)
        .join(risk, "part_number", "left")
        .join(receipt, "part_number", "left")
        .select(
            "work_order_id",
            "aircraft_reg",
            "wo_type",
            "opened_date",
            F.datediff(F.lit(as_of), "opened_date").alias("days_open"),
            "part_number",
            "description",
            "criticality",
            "qty_required",
            available.alias("qty_available"),
            (F.col("qty_required") - available).alias("shortfall"),
            "aog_risk_score",
            "risk_band",
            "primary_driver",
            "next_receipt_date",
        )
    )


def early_warning_lead(risk_history: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Hours from a part's first high risk to its first day without stock in some warehouse, where the risk came first."""
    first = risk_history.filter(F.col("risk_band").isin("CRITICAL", "HIGH")).groupBy("part_number").agg(F.min("scored_at").alias("first_high_risk_at"))
    out = snapshots.filter("qty_available <= 0").groupBy("part_number").agg(F.min("snapshot_date").alias("first_stockout_date"))
    end = F.col("first_stockout_date").cast("timestamp")
    return (
        first.join(out, "part_number")
        .filter(F.col("first_high_risk_at") < end)
        .withColumn("warning_lead_hours", hours_between(F.col("first_high_risk_at"), end))
    )


def parts_to_rescore(blocked: DataFrame, rules: Rules = RULES, explicit: DataFrame | None = None) -> DataFrame:
    """The given parts, else those that ground an aircraft or are near the alert threshold."""
    if explicit is not None:
        return explicit.select("part_number").distinct()
    near = F.col("aog_risk_score") >= rules.alert_score - rules.near_alert_margin
    return blocked.filter((F.col("wo_type") == "AOG") | near).select("part_number").distinct()


def run_kpis(scorecard: DataFrame, scored: DataFrame, early: DataFrame, profile: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The run's headline figures as rows (kpi, label, value)."""

    def counts(df: DataFrame, column: str, kpi: str) -> DataFrame:
        return df.groupBy(F.col(column).alias("label")).agg(F.count("*").cast("double").alias("value")).select(F.lit(kpi).alias("kpi"), "label", "value")

    def one(df: DataFrame, kpi: str, value) -> DataFrame:
        return df.agg(value.cast("double").alias("value")).select(F.lit(kpi).alias("kpi"), F.lit(None).cast("string").alias("label"), "value")

    at_risk = scored.filter(F.col("aog_risk_score") >= rules.at_risk_score)
    frames = [
        counts(scorecard, "risk_tier", "supplier_tiers"),
        counts(scored, "risk_band", "risk_bands"),
        counts(profile, "pattern", "demand_patterns"),
        counts(at_risk, "primary_driver", "drivers_at_risk"),
        one(scorecard, "median_contract_gap_days", F.median("contract_gap_days")),
        one(scorecard, "fleet_otd_pct", F.round(100 * F.avg("on_time_rate"), 3)),
        one(early, "median_warning_hours", F.median("warning_hours")),
        one(early, "warned_in_time", F.count_if(F.col("warning_hours") >= rules.alert_lead_hours)),
        one(early, "no_go_warned", F.count_if(F.col("criticality") == "NO_GO")),
        one(scored, "parts_unified", F.countDistinct("part_number")),
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
