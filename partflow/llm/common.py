"""What the text operators share: word rules, document keys, tables in the shared folder, components."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Spark's setting that deletes a query's shuffle files at its end, not when the driver's garbage collection finds them.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only. For pure ASCII, ``lower`` does the same and is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def text_hash(text: Column) -> Column:
    """Tells apart rows that repeat a doc_id; with the doc_id, it is the key of a document."""
    return F.xxhash64(text)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session may leave it unset, and gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shuffles(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for rows whose work does not follow their bytes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Cuts the lineage: writes the rows to the shared folder and returns a scan of them.

    The shuffle files of the write are deleted with its end, as only the table is read from then on; the setting
    holds for the session from its first written table on, so that queries side by side don't undo it for each other.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/partflow-{name}-{uuid.uuid4().hex}"
    spark.conf.set(DROP_SHUFFLES, "true")
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._partflow_path = path
    if (inside := _SCRATCH.get()) is not None:
        inside.append(out)
    return out


_SCRATCH: ContextVar[list[DataFrame] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch():
    """Deletes at its end the tables that were ``written`` inside, but for those that are taken out of the list it gives.

    For a caller that has written its result: an operator's lazy result still reads its tables.
    """
    inside: list[DataFrame] = []
    token = _SCRATCH.set(inside)
    try:
        yield inside
    finally:
        _SCRATCH.reset(token)
        drop_written(*inside)


def drop_written(*frames: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing will read again."""
    for df in frames:
        path = getattr(df, "_partflow_path", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), the component being its smallest node.

    Labels flow over edges as grouped minima and then jump to the label's own label, so that the
    number of rounds follows the logarithm of a chain's length. No group of neighbours is ever
    gathered: minima combine before the shuffle. Nodes that no edge names are not in the result.
    Each round is a written table.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(
        edges.select(F.col("b").alias("node"), F.col("a").alias("to"))
    )
    both = written(both.distinct(), "links")
    labels = written(
        both.groupBy("node").agg(F.min("to").alias("m")).select("node", F.least("node", "m").alias("component")),
        "labels",
    )
    for _ in range(max_rounds):
        near = (
            both.join(labels.select(F.col("node").alias("to"), "component"), "to")
            .groupBy("node")
            .agg(F.min("component").alias("near"))
        )
        hop = labels.join(near, "node", "left").select(
            "node",
            F.col("component").alias("old"),
            F.least("component", F.coalesce("near", "component")).alias("component"),
        )
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        new = written(
            hop.join(up, "component", "left").select(
                "node", "old", F.least("component", F.coalesce("further", "component")).alias("component")
            ),
            "labels",
        )
        drop_written(labels)
        labels = new
        if new.filter(F.col("old") != F.col("component")).isEmpty():
            drop_written(both)
            out = labels.select("node", "component")
            out._partflow_path = labels._partflow_path
            return out
    raise RuntimeError(f"components need more than {max_rounds} rounds")
