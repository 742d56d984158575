"""The domain's tables as views over the star-schema test tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime.date(2001, 8, 2)
FIRST_MONTH, LAST_MONTH = datetime.date(1995, 1, 1), datetime.date(2001, 7, 1)
OPEN_SINCE = datetime.date(2001, 4, 4)
SNAPSHOT_DATES = (datetime.date(2001, 5, 31), datetime.date(2001, 6, 30), datetime.date(2001, 7, 31))
SCORECARD_DATES = tuple(datetime.date.fromisoformat(d) for d in ("1999-09-30", "1999-12-31", "2000-03-31", "2000-06-30", "2000-09-30", "2000-12-31", "2001-03-31", "2001-06-30"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, column: str, width: int = 0):
    value = F.col(column).cast("string")
    return F.concat(F.lit(prefix), F.lpad(value, width, "0") if width else value)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return read(spark, sf_dir, "part").select(
        _id("PN-", "p_partkey", 6).alias("part_number"),
        F.col("p_partkey").alias("part_id"),  # numbers of six digits repeat from a million parts on
        F.col("p_name").alias("description"),
        F.col("p_type").alias("ata_chapter"),
        F.initcap("p_type").alias("ata_chapter_name"),
        F.when(size <= 8, "NO_GO").when(size <= 25, "GO_IF").otherwise("GO").alias("criticality"),
        F.col("p_retailprice").alias("unit_cost_usd"),
        ((size % 5) * 12).alias("shelf_life_months"),
        (F.col("p_partkey") % 5 < 2).alias("repairable_flag"),
        (F.col("p_partkey") % 3 == 0).alias("single_source_flag"),
    )


def _contracted(column: str):
    return (F.lit(30) + (F.col(column) * 37) % 510).cast("int")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("s_suppkey")
    return (
        read(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _id("SUP-", "s_suppkey", 5).alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.col("n_name").alias("country"),
            _contracted("s_suppkey").alias("base_lead_time_days"),
            (F.lit(2.5) + (key % 26) / 10.0).alias("quality_rating"),
            (key % 10 != 0).alias("approved_vendor"),
        )
    )


def purchase_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = F.col("l_linestatus") == "F"
    ordered = F.col("o_orderdate").cast("date")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return (
        read(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            _id("PO-", "l_orderkey").alias("po_number"),
            F.col("l_linenumber").alias("po_line"),
            _id("PN-", "l_partkey", 6).alias("part_number"),
            _id("SUP-", "l_suppkey", 5).alias("supplier_id"),
            F.col("l_quantity").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price_usd"),
            ordered.alias("order_date"),
            F.date_add(ordered, _contracted("l_suppkey")).alias("promised_date"),
            F.when(done, F.col("l_shipdate").cast("date")).alias("actual_delivery_date"),
            F.when(done, "DELIVERED").otherwise("OPEN").alias("status"),
        )
    )


def inventory(spark: SparkSession, sf_dir: str, upto: datetime.date | None = None) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    if upto is not None:
        lines = lines.filter(F.col("l_shipdate") < F.lit(upto + datetime.timedelta(days=1)).cast("timestamp"))
    grouped = lines.groupBy((F.col("l_suppkey") % 3).alias("w"), "l_partkey").agg(
        F.floor(F.sum("l_quantity") / 10).cast("int").alias("qty_on_hand"),
        F.count("*").cast("int").alias("qty_reserved"),
        F.count_if(F.col("l_linenumber") == 7).cast("int").alias("qty_quarantine"),
        F.max("l_shipdate").cast("date").alias("last"),
    )
    kind = (F.col("l_partkey") + F.col("w")) % 10
    return grouped.select(
        _id("WH-", "w").alias("warehouse_id"),
        _id("PN-", "l_partkey", 6).alias("part_number"),
        "qty_on_hand",
        "qty_reserved",
        "qty_quarantine",
        F.when(kind == 0, "AR").when(kind == 1, "OH").when(kind == 2, "SV").otherwise("NE").alias("condition_code"),
        F.when(F.col("l_partkey") % 5 == 0, F.date_add("last", 365)).alias("expiry_date"),
        F.col("last").alias("last_counted"),
    )


def work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    joined = read(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    grouped = joined.groupBy("o_orderkey").agg(
        F.min("o_custkey").alias("cust"),
        F.min("l_partkey").alias("part"),
        F.max("l_quantity").alias("qty_required"),
        F.min("o_orderpriority").alias("priority"),
        F.min("o_orderdate").cast("date").alias("opened_date"),
        F.min("o_orderstatus").alias("s"),
    )
    kind = F.when(F.col("priority") == "1-URGENT", "AOG").when(F.col("priority") == "2-HIGH", "UNSCHEDULED").otherwise("SCHEDULED")
    is_open = (F.col("s") == "O") & (F.col("opened_date") >= F.lit(OPEN_SINCE))
    return grouped.select(
        _id("WO-", "o_orderkey").alias("work_order_id"),
        _id("AC-", "cust").alias("aircraft_reg"),
        _id("PN-", "part", 6).alias("part_number"),
        "qty_required",
        kind.alias("wo_type"),
        "opened_date",
        F.when(is_open, "OPEN").otherwise("CLOSED").alias("status"),
    )


def demand_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").filter("l_returnflag <> 'R'").filter(F.col("l_shipdate") < F.lit("2001-08-01").cast("timestamp"))
    month = F.date_trunc("month", "l_shipdate").cast("date").alias("month")
    return lines.groupBy(_id("PN-", "l_partkey", 6).alias("part_number"), month).agg(F.sum("l_quantity").alias("demand_qty"))


def customs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit(OPEN_SINCE).cast("timestamp")).select("o_orderkey")
    lines = read(spark, sf_dir, "lineitem").filter("l_linestatus = 'O'").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    state = (F.col("l_orderkey") + F.col("l_linenumber")) % 5
    status = F.when(state == 0, "IN_TRANSIT").when(state == 1, "AT_CUSTOMS").when(state == 2, "HELD").when(state == 3, "CLEARED").otherwise("DELIVERED")
    return lines.select(
        F.concat(F.lit("AWB"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("awb"),
        _id("PO-", "l_orderkey").alias("po_number"),
        _id("PN-", "l_partkey", 6).alias("part_number"),
        F.col("l_quantity").alias("quantity"),
        status.alias("clearance_status"),
        F.when(F.col("l_orderkey") % 7 != 0, (F.col("l_orderkey") % 21 + 1).cast("int")).alias("estimated_clearance_days"),
    )


def supersessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").filter("p_partkey % 16 < 6").withColumn("next", F.col("p_partkey") + 1)
    return df.select(_id("PN-", "p_partkey", 6).alias("old_part_number"), _id("PN-", "next", 6).alias("new_part_number"))


def alert_stream_rows(events: DataFrame) -> DataFrame:
    """Alert candidates from events: a part is a user, an error a candidate, its value the score."""
    return events.filter("event_type = 'error'").select(
        F.col("user_id").alias("part_number"), F.col("ts").cast("timestamp").alias("alert_ts"), F.col("event_id").alias("alert_id"), F.col("value").alias("score")
    )
