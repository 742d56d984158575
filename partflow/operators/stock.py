"""Warehouse inventory and customs."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.functions.columns import clamped, mapped, round_even
from partflow.rules import CLEARANCE_DELAY_DAYS, CLEARANCE_STAGE, ISSUABLE, RULES, Rules

# Other spellings of inventory fields.
ALIASES = {
    "warehouse_id": ("warehouseId",),
    "part_number": ("partNumber",),
    "qty_on_hand": ("quantityOnHand",),
    "qty_reserved": ("quantityReserved",),
    "qty_quarantine": ("quantityQuarantine",),
    "bin_location": ("binLocation",),
    "condition_code": ("condition",),
    "expiry_date": ("expiryDate",),
    "last_counted": ("lastCycleCount",),
}
INVENTORY = (
    "warehouse_id string, part_number string, qty_on_hand double, qty_reserved double, qty_quarantine double, qty_available int, "
    "bin_location string, condition_code string, expiry_date date, last_counted date, source_system string"
)


def normalize_inventory(df: DataFrame, source_system: str, as_of: datetime.date) -> DataFrame:
    """Any warehouse's rows on one schema, with the quantity that can be issued.

    Missing columns are null, quantities that aren't numbers 0, bad dates null. Stock in another
    condition than issuable, or past its expiry, isn't available.
    """

    def field(name: str):
        there = [F.col(f"`{c}`") for c in (name, *ALIASES[name]) if c in df.columns]
        return F.coalesce(*there) if there else F.lit(None).cast("string")

    number = lambda name: F.coalesce(field(name).try_cast("double"), F.lit(0.0))
    date = lambda name: field(name).try_cast("date")
    out = df.select(
        field("warehouse_id").cast("string").alias("warehouse_id"),
        field("part_number").cast("string").alias("part_number"),
        *[number(c).alias(c) for c in ("qty_on_hand", "qty_reserved", "qty_quarantine")],
        field("bin_location").cast("string").alias("bin_location"),
        F.upper(F.trim(F.coalesce(field("condition_code").cast("string"), F.lit("NE")))).alias("condition_code"),
        date("expiry_date").alias("expiry_date"),
        date("last_counted").alias("last_counted"),
        F.lit(source_system).alias("source_system"),
    )
    expired = F.coalesce(F.col("expiry_date") < F.lit(as_of), F.lit(False))
    left = F.greatest(F.col("qty_on_hand") - F.col("qty_reserved") - F.col("qty_quarantine"), F.lit(0.0)).cast("int")
    issuable = F.col("condition_code").isin(*ISSUABLE) & ~expired
    out = out.withColumn("qty_available", F.when(issuable, left).otherwise(0))
    return out.select(*[c.strip().split(" ")[0] for c in INVENTORY.split(",")])


def stock_accuracy(inventory: DataFrame, as_of: datetime.date, rules: Rules = RULES) -> DataFrame:
    """Records, and the shares counted longer ago than stale_count_days (or never) and not."""
    stale = F.coalesce(F.col("last_counted") < F.date_sub(F.lit(as_of), rules.stale_count_days), F.lit(True))
    share = lambda c: F.coalesce(round_even(100 * F.avg(c.cast("double")), 1), F.lit(0.0))
    return inventory.agg(F.count("*").alias("records"), share(stale).alias("stale_pct"), share(~stale).alias("trusted_pct"))


def union_all(frames: list[DataFrame], spark=None) -> DataFrame:
    """Union by name, missing columns null; of nothing, an empty inventory."""
    if not frames:
        return spark.createDataFrame([], INVENTORY)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_supplier_stock(inventory: DataFrame, live: DataFrame) -> DataFrame:
    """Adds suppliers' own stock, summed by part, as one more warehouse."""
    extra = live.groupBy("part_number").agg(F.sum("qty_available").cast("int").alias("qty_available"))
    extra = extra.withColumn("warehouse_id", F.lit("SUPPLIER_STOCK"))
    return inventory.unionByName(extra, allowMissingColumns=True)


def latest_snapshot(df: DataFrame, date: str, scope: DataFrame | None = None) -> DataFrame:
    """The rows of the last date, over all rows or those of the scope's parts.

    The date is a subquery of one row, not a window without partitions: of a stored table that is partitioned by
    date, its scan reads no column and that of the rows the last partition alone.
    """
    if scope is not None:
        df = df.join(scope.select("part_number").distinct(), "part_number", "left_semi")
    return df.filter(F.col(date) == df.agg(F.max(date)).scalar())


def customs_projection(shipments: DataFrame, as_of: datetime.date) -> DataFrame:
    """Stage, projected clearance (the broker's estimate, else what the stage takes) and whether held."""
    days = F.coalesce("estimated_clearance_days", mapped(F.col("clearance_status"), CLEARANCE_DELAY_DAYS))
    return shipments.withColumns(
        {
            "clearance_stage": mapped(F.col("clearance_status"), CLEARANCE_STAGE),
            "projected_clearance_date": F.date_add(F.lit(as_of), days.cast("int")),
            "is_held": F.col("clearance_status") == "HELD",
        }
    )


def customs_risk(projected: DataFrame, as_of: datetime.date, rules: Rules = RULES) -> DataFrame:
    """The largest risk and latest clearance of each order and part: 1 if held, 0 if through, else by days."""
    days = F.greatest(F.datediff("projected_clearance_date", F.lit(as_of)), F.lit(0))
    risk = (
        F.when(F.col("clearance_status").isin("CLEARED", "DELIVERED"), 0.0)
        .when(F.col("is_held"), 1.0)
        .otherwise(clamped(days / F.lit(float(rules.customs_worst_days))))
    )
    return projected.groupBy("po_number", "part_number").agg(
        F.max(risk).alias("customs_risk"), F.max("projected_clearance_date").alias("projected_clearance_date")
    )
