"""Extracts of the resource-planning system: CSV files of strings with the vendor's field names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.functions.columns import compact_date, number_or_null, unpadded
from partflow.operators.catalog import keep_first

# Vendor field names.
MATERIAL = {
    "MATNR": "part_number",
    "MAKTX": "description",
    "MTART": "material_type",
    "MATKL": "material_group",
    "NTGEW": "net_weight_kg",
    "MHDHB": "shelf_life_months",
}
ORDER = {
    "EBELN": "po_number",
    "EBELP": "po_line",
    "MATNR": "part_number",
    "MENGE": "quantity",
    "NETPR": "unit_price",
    "WAERS": "currency",
    "EINDT": "promised_date",
}
WORK = {"AUFNR": "work_order_id", "AUART": "wo_type", "EQUNR": "equipment_id", "ERDAT": "opened_date", "PHAS3": "closed_flag"}


#: The field that holds when an order was changed; extracts to files may lack it.
CHANGED = {"AEDAT": "changed_date"}


def read_extract(spark: SparkSession, folder: str, table: str, fields: dict[str, str], optional: dict[str, str] | None = None) -> DataFrame:
    """The named fields of ``<table>.csv`` as strings under their own names, null as empty; ValueError if one is missing that isn't optional."""
    df = spark.read.option("header", True).csv(f"{folder}/{table.lower()}.csv")
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks {missing}")
    there = fields | {k: v for k, v in (optional or {}).items() if k in df.columns}
    return df.select(*[F.coalesce(F.col(k), F.lit("")).alias(v) for k, v in there.items()])


def material_master(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each part: of repeats the smallest row, as files have no order."""
    df = read_extract(spark, folder, "MARA", MATERIAL).withColumn("part_number", unpadded(F.col("part_number")))
    df = df.withColumns({c: number_or_null(F.col(c)) for c in ("net_weight_kg", "shelf_life_months")})
    df = keep_first(df, ["part_number"], [F.col(c).asc_nulls_last() for c in df.columns if c != "part_number"])
    return df.withColumn("source_system", F.lit("ERP"))


def purchase_orders(spark: SparkSession, folder: str, changed_since=None) -> DataFrame:
    """Order lines. changed_since keeps those whose order was changed since; an extract without the change date is taken whole."""
    df = read_extract(spark, folder, "EKPO", ORDER, CHANGED).withColumns(
        {
            "part_number": unpadded(F.col("part_number")),
            "quantity": number_or_null(F.col("quantity")),
            "unit_price": number_or_null(F.col("unit_price")),
            "promised_date": compact_date(F.col("promised_date")),
            "source_system": F.lit("ERP"),
        }
    )
    if "changed_date" not in df.columns:
        return df
    df = df.withColumn("changed_date", compact_date(F.col("changed_date")))
    return df if changed_since is None else df.filter(F.col("changed_date") >= F.lit(changed_since))


def work_orders(spark: SparkSession, folder: str, changed_since=None) -> DataFrame:
    df = read_extract(spark, folder, "AUFK", WORK).withColumns(
        {
            "opened_date": compact_date(F.col("opened_date")),
            "status": F.when(F.trim("closed_flag") == "X", "CLOSED").otherwise("OPEN"),
            "source_system": F.lit("ERP"),
        }
    )
    df = df.drop("closed_flag")
    return df if changed_since is None else df.filter(F.col("opened_date") >= F.lit(changed_since))
