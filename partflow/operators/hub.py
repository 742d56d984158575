"""Table maintenance on parquet: upserts, type-2 history, batches that can be rolled back, dated results.

A table is dealt to buckets by a hash of its keys, whose number grows with its rows. An upsert writes its batch
once, merges it with the buckets that it touches, and publishes these together.
"""

from __future__ import annotations

import datetime
import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# Natural keys.
NATURAL_KEYS = {
    "dim_parts": ("part_number",),
    "dim_suppliers": ("supplier_id",),
    "dim_supplier_performance": ("supplier_id", "as_of_date"),
    "fct_purchase_orders": ("po_number", "po_line"),
    "fct_work_orders": ("work_order_id",),
    "fct_inventory_snapshot": ("warehouse_id", "part_number", "snapshot_date"),
    "fct_aog_risk": ("part_number", "scored_at"),
    "fct_demand_forecast": ("part_number", "forecast_month"),
    "fct_aog_alert_log": ("part_number", "alerted_at"),
}
LOAD_ORDER = tuple(NATURAL_KEYS)
#: A table has so many buckets at least, and twice or more as many when they hold more rows on average.
LEAST_BUCKETS, BUCKET_ROWS = 8, 1_000_000
TRACKED = ("criticality", "unit_cost_usd", "master_part_number", "is_superseded")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session may leave it unset, and gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stamped(df: DataFrame, batch_id: str, loaded_at) -> DataFrame:
    return df.withColumns({"_loaded_at": F.lit(loaded_at).cast("timestamp"), "_batch_id": F.lit(batch_id)})


def merged(target: DataFrame, source: DataFrame, keys: tuple[str, ...], order: str | None = None) -> DataFrame:
    """target with source upserted: matched rows take the source's columns and keep their others; the rest is added.

    Keys must be unique and not null in the source. With order, a matched row stays as it is if its order
    is larger than the source row's.
    """
    keys = list(keys)
    own = [c for c in source.columns if c not in keys]
    renamed = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in own], F.lit(True).alias("__in_source"))
    both = target.join(renamed, keys, "full_outer")
    there = F.col("__in_source").isNotNull()
    if order is not None:
        there = there & (F.col(order).isNull() | (F.col(f"__s_{order}") >= F.col(order)))
    columns = [c for c in target.columns if c not in keys] + [c for c in own if c not in target.columns]

    def value(c: str):
        if c not in own:
            return F.col(c)
        old = F.col(c) if c in target.columns else F.lit(None)
        return F.when(there, F.col(f"__s_{c}")).otherwise(old)

    return both.select(*keys, *[value(c).alias(c) for c in columns])


def check_keys(source: DataFrame, keys: tuple[str, ...]) -> None:
    bad = source.groupBy(*keys).count()
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    row = bad.agg(F.count_if(F.col("count") > 1).alias("repeated"), F.count_if(null).alias("null")).first()
    if row["repeated"] or row["null"]:
        raise ValueError(f"keys {keys}: {row['repeated']} repeated, {row['null']} null")


class Hub:
    """Tables under a folder that driver and executors share, and whose file system renames a file atomically.

    A table is the folders of its buckets that its file ``_published`` names. A load writes the buckets that it
    touches to new folders and then replaces that file by a rename: readers see all of a load or nothing, and
    one that breaks off anywhere leaves the table as it was or as it was to be. What is named no more stays for
    one load longer, for readers that began before. One load at a time writes a table.
    """

    def __init__(self, spark: SparkSession, folder: str, batch_id: str | None = None, loaded_at=None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.batch_id = batch_id or uuid.uuid4().hex[:12]
        self.loaded_at = loaded_at or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _state(self, table: str) -> dict | None:
        """n, the number of buckets; schema; buckets, the folders' versions by bucket. None if there is no table."""
        fs, where = self._fs(f"{self.folder}/{table}/_published")
        if not fs.exists(where):
            return None
        stream = fs.open(where)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, table: str, state: dict) -> None:
        fs, new = self._fs(f"{self.folder}/{table}/_new-{uuid.uuid4().hex}")
        stream = fs.create(new, True)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        jvm, (_, at) = self.spark._jvm, self._fs(f"{self.folder}/{table}/_published")
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.spark._jsc.hadoopConfiguration()).rename(new, at, how)

    def _delete(self, path: str) -> None:
        fs, where = self._fs(path)
        fs.delete(where, True)

    def _clean(self, table: str, *states: dict | None) -> None:
        """Deletes the folders that none of the states names."""
        named = {(v, k) for state in states if state for k, versions in state["buckets"].items() for v in versions}
        fs, where = self._fs(f"{self.folder}/{table}")
        for version in [x.getPath() for x in fs.listStatus(where) if x.getPath().getName().startswith("_v=")]:
            there = [x.getPath().getName() for x in fs.listStatus(version) if x.getPath().getName().startswith("_bucket=")]
            v = version.getName().removeprefix("_v=")
            gone = [x for x in there if (v, x.removeprefix("_bucket=")) not in named]
            for x in gone if len(gone) < len(there) else [""]:
                self._delete(f"{self.folder}/{table}/_v={v}/{x}".rstrip("/"))

    def _rows(self, table: str, state: dict, buckets: list[str] | None = None) -> DataFrame:
        """The rows of a state with their bucket, of all buckets or of these."""
        schema = StructType.fromJson(state["schema"]).add("_bucket", IntegerType())
        paths = [f"{self.folder}/{table}/_v={v}/_bucket={k}" for k, versions in state["buckets"].items() if buckets is None or k in buckets for v in versions]
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", f"{self.folder}/{table}").parquet(*paths)
        return found.select(*schema.names)

    def read(self, table: str) -> DataFrame | None:
        """The table, None if there is none."""
        state = self._state(table)
        return None if state is None else self._rows(table, state).drop("_bucket")

    def _write(self, table: str, df: DataFrame) -> str:
        """Writes rows with their bucket to folders of a new version, which is returned."""
        version = uuid.uuid4().hex
        df.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.folder}/{table}/_v={version}")
        return version

    def load(self, df: DataFrame, table: str, keys: tuple[str, ...] | None = None, mode: str = "merge", order: str | None = None) -> int:
        """Upserts (or appends) df and returns how many rows it had. order: as of ``merged``.

        An upsert that is run again with its batch id changes nothing; an append adds its rows again.
        """
        keys = keys or NATURAL_KEYS.get(table)
        if mode == "merge" and not keys:
            raise ValueError(f"no keys for {table}")
        staged = f"{shared_folder(self.spark)}/partflow-staged-{uuid.uuid4().hex}"
        stamped(df, self.batch_id, self.loaded_at).write.parquet(staged)  # evaluated once
        try:
            return self._load(self.spark.read.parquet(staged), table, keys, mode, order)
        finally:
            self._delete(staged)

    def _load(self, batch: DataFrame, table: str, keys: tuple[str, ...] | None, mode: str, order: str | None) -> int:
        n, old = batch.count(), self._state(table)
        if not n:
            return 0
        if mode == "merge":
            check_keys(batch, keys)
        by = keys if keys and set(keys) <= set(batch.columns) else batch.columns
        target = None if old is None else self._rows(table, old)
        rows = n + (0 if target is None else target.count())  # from the files' footers
        buckets = max(LEAST_BUCKETS, 1 << max(0, -(-2 * rows // BUCKET_ROWS) - 1).bit_length())
        grown = old is not None and mode == "merge" and rows > BUCKET_ROWS * old["n"]
        if old is not None and not grown:
            buckets = old["n"]
        bucket = F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")
        batch = batch.withColumn("_bucket", bucket)
        touched = [str(r["_bucket"]) for r in batch.select("_bucket").distinct().collect()]  # as many as buckets at most
        kept = {} if old is None else dict(old["buckets"])
        if mode == "merge" and old is not None:
            there = target.withColumn("_bucket", bucket) if grown else self._rows(table, old, touched)
            batch, kept = merged(there, batch, keys, order), {} if grown else {k: v for k, v in kept.items() if k not in touched}
        fields = {f.name: f for f in StructType.fromJson(old["schema"]).fields} if old is not None else {}
        fields |= {f.name: StructField(f.name, f.dataType) for f in batch.schema.fields if f.name != "_bucket" and f.name not in fields}
        version = self._write(table, batch)
        written = [str(k) for k in range(buckets)] if grown else touched
        fs, _ = self._fs(f"{self.folder}/{table}")
        for k in written:
            if fs.exists(self._fs(f"{self.folder}/{table}/_v={version}/_bucket={k}")[1]):
                kept[k] = [*kept.get(k, []), version]
        new = {"n": buckets, "schema": StructType(list(fields.values())).jsonValue(), "buckets": kept}
        self._publish(table, new)
        self._clean(table, new, old)
        return n

    def load_all(self, frames: dict[str, DataFrame], keys: dict[str, tuple[str, ...]] | None = None) -> dict[str, int]:
        """Dimensions first; the tables share a batch. keys: of tables whose natural keys don't tell their rows apart."""
        keys = NATURAL_KEYS | (keys or {})
        ordered = [t for t in LOAD_ORDER if t in frames] + [t for t in frames if t not in LOAD_ORDER]
        return {t: self.load(frames[t], t, keys.get(t), mode="merge" if t in keys else "append") for t in ordered}

    def rollback_batch(self, table: str, batch_id: str) -> int:
        """Deletes the batch's rows (rows that it updated go too) and returns how many."""
        old = self._state(table)
        if old is None:
            return 0
        target, mine = self._rows(table, old), F.coalesce(F.col("_batch_id") == batch_id, F.lit(False))
        found = {str(r["_bucket"]): (r["n"], r["mine"]) for r in target.groupBy("_bucket").agg(F.count("*").alias("n"), F.count_if(mine).alias("mine")).collect()}
        kept = {k: v for k, v in old["buckets"].items() if not found.get(k, (0, 0))[1]}
        left = [k for k, (n, m) in found.items() if 0 < m < n]
        if left:
            version = self._write(table, self._rows(table, old, left).filter(~mine))
            kept |= {k: [version] for k in left}
        new = {**old, "buckets": kept}
        self._publish(table, new)
        self._clean(table, new, old)
        return sum(m for _, m in found.values())


def write_results(frames: dict[str, DataFrame], folder: str, run_date: datetime.date) -> None:
    """Each result of a run as parquet under its name and the run's date; a run of the same date replaces it."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}/run_date={run_date.isoformat()}")


def read_results(spark: SparkSession, folder: str, name: str, run_date: datetime.date | None = None) -> DataFrame:
    """A result with its run_date: of one run, or without a date of the last."""
    rows = spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}")
    if run_date is None:
        run_date = rows.agg(F.max("run_date")).first()[0]
    return rows.filter(F.col("run_date") == F.lit(run_date))


def row_hash(df: DataFrame, tracked: tuple[str, ...] = TRACKED):
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("∅")) for c in tracked]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def scd2(history: DataFrame | None, staged: DataFrame, now, key: str = "part_number", tracked: tuple[str, ...] = TRACKED) -> DataFrame:
    """Type-2 history: current rows whose tracked values changed end now, and changed and new rows begin now.

    history: staged's columns with row_hash, valid_from, valid_to and is_current. staged has a row
    for each key.
    """
    now = F.lit(now).cast("timestamp")
    staged = staged.withColumn("row_hash", row_hash(staged, tracked))
    fresh = staged.withColumns({"valid_from": now, "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)})
    if history is None:
        return fresh
    new = staged.select(F.col(key), F.col("row_hash").alias("__new"))
    old = history.join(new, key, "left")
    ends = F.col("is_current") & F.col("__new").isNotNull() & ~F.col("row_hash").eqNullSafe(F.col("__new"))
    old = old.withColumn("__ends", ends).withColumns(
        {"valid_to": F.when(F.col("__ends"), now).otherwise(F.col("valid_to")), "is_current": F.col("is_current") & ~F.col("__ends")}
    )
    still = history.filter("is_current").select(key, "row_hash")
    begin = fresh.join(still.withColumnRenamed("row_hash", "__now"), key, "left")
    begin = begin.filter(~F.col("row_hash").eqNullSafe(F.col("__now"))).drop("__now")
    return old.drop("__ends", "__new").unionByName(begin)


def current_parts(dim_parts: DataFrame) -> DataFrame:
    return dim_parts.filter("is_current")
