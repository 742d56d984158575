"""Alerts from streams: cooldown of each part, idempotent upserts, re-scoring in micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from partflow.operators.hub import Hub
from partflow.rules import RULES, Rules


def with_cooldown(candidates: DataFrame, rules: Rules = RULES) -> DataFrame:
    """The candidates (part_number, alert_ts, alert_id, score) of a stream that may go out.

    A part's candidate goes out if none of it went out in the cooldown before; those held back don't
    count. State is one time for each part. In a batch a part's candidates are taken in the order
    of time and id; one older than the last that went out is held back. State that is older than the
    watermark and the cooldown decides nothing any more and goes.
    """
    cooldown = pd.Timedelta(hours=rules.cooldown_hours)

    def decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = pd.Timestamp(state.get[0], unit="us") if state.exists else None
        rows, out = pd.concat(list(batches)).sort_values(["alert_ts", "alert_id"]), []
        for row in rows.itertuples(index=False):
            if last is None or row.alert_ts - last >= cooldown:
                last = row.alert_ts
                out.append(row)
        state.update((int(last.value // 1000),))
        ends = int(last.value // 1_000_000) + int(cooldown.total_seconds() * 1000)
        if ends > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(ends)
        if out:
            yield pd.DataFrame(out, columns=rows.columns)

    rows = candidates.select("part_number", "alert_ts", "alert_id", "score")
    return (
        rows.withWatermark("alert_ts", f"{rules.cooldown_hours} hours")
        .groupBy("part_number")
        .applyInPandasWithState(
            decide,
            "part_number long, alert_ts timestamp, alert_id long, score double",
            "last long",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )


def run_available(out: DataFrame, folder: str) -> DataFrame:
    """Runs a stream over what is there, into parquet under a shared folder, and reads the result."""
    query = (
        out.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return out.sparkSession.read.schema(out.schema).parquet(f"{folder}/out")


def without_repeats(stream: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Deliveries of a key within the delay after its first go."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def upsert_stream(stream: DataFrame, hub: Hub, table: str, keys: tuple[str, ...], order: str, folder: str) -> None:
    """Upserts each micro-batch under a batch id of its own, so that a batch that runs again changes nothing.

    Of a key's rows the last by order counts, whichever batches they come in.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in batch.columns if c not in keys]
        last = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")
        Hub(batch.sparkSession, hub.folder, f"b{batch_id}", hub.loaded_at).load(last, table, keys, order=order)

    query = stream.writeStream.foreachBatch(load).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def rescore_stream(events: DataFrame, rescore: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None], folder: str, every: str | None = None):
    """Scores again the parts that a micro-batch of events touches; every 15 minutes or what is there.

    rescore gets the batch's parts and write its result with the batch's id, under which a batch
    that runs again is to replace what it wrote. A batch without parts isn't scored.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        parts = batch.select("part_number").where("part_number is not null").distinct().persist()
        try:
            if not parts.isEmpty():
                write(rescore(parts), batch_id)
        finally:
            parts.unpersist()

    writer = events.writeStream.foreachBatch(run).option("checkpointLocation", f"{folder}/checkpoint")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
