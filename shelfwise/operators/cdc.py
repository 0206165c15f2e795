"""Change data capture between a state and a new snapshot, by row hash."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import present
from shelfwise.operators.combine import BucketedTable
from shelfwise.sources.schemas import VARIANT, VARIANT_CHANGES, VARIANT_STATE, conform


def _identified(df: DataFrame) -> DataFrame:
    """Rows with an id. Both sides of a comparison are filtered alike, so that what they have in common is computed once."""
    return df.where(F.col("id").isNotNull() & present(F.col("id")).isNotNull())


def upserts(new: DataFrame, old: DataFrame, null_safe: bool = False) -> DataFrame:
    """Rows of new that old lacks or has with another hash. A null old hash is no change, unless null_safe."""
    before = _identified(old).select(F.col("id").alias("__id"), F.col("row_hash").alias("__hash"))
    joined = _identified(new).join(before, F.col("id") == F.col("__id"), "left")
    differs = ~F.col("row_hash").eqNullSafe(F.col("__hash")) if null_safe else F.col("row_hash") != F.col("__hash")
    return joined.where(F.col("__id").isNull() | differs).drop("__id", "__hash")


def deletes(new: DataFrame, old: DataFrame) -> DataFrame:
    """Ids of old that new lacks."""
    return _identified(old).select("id").join(_identified(new).select("id"), "id", "left_anti")


def change_log(
    new: DataFrame, old: DataFrame, batch_id: Column, batch_ts: Column, change_ts: Column, columns: Sequence[str] = VARIANT[1:]
) -> DataFrame:
    """UPSERT rows with all columns and DELETE rows with the id alone: upserts() and deletes() by one join of both sides.

    `columns` are those of a variant, beside its id, that new must have; others are null in the log.
    """
    after = _identified(new).select("id", *columns, "row_hash").withColumn("__new", F.lit(True))
    before = _identified(old).select(F.col("id").alias("__id"), F.col("row_hash").alias("__hash"))
    both = after.join(before, F.col("id") == F.col("__id"), "full_outer")
    operation = F.when(F.col("__new").isNull(), "DELETE").when(F.col("__id").isNull() | (F.col("row_hash") != F.col("__hash")), "UPSERT")
    both = both.withColumn("operation", operation).where("operation is not null")
    rest = [F.col(c) for c in (*columns, "row_hash")]
    log = both.select(
        batch_id.alias("batch_run_id"), batch_ts.alias("batch_run_ts"), "operation", F.coalesce("id", "__id").alias("id"), *rest, change_ts.alias("change_ts")
    )
    return conform(log, VARIANT_CHANGES)


def next_state(new: DataFrame, seen_at: Column) -> DataFrame:
    """What a merge of new into any state leaves: rows of new, each seen now."""
    return new.withColumn("last_seen_at", seen_at)


def merged(old: DataFrame, new: DataFrame, key: str, seen: str) -> DataFrame:
    """A merge that keeps what new lacks: rows of new over those of old, `seen` untouched where new is silent."""
    return old.join(new.select(key), key, "left_anti").unionByName(new.select(*old.columns))


def run(spark: SparkSession, snapshot: DataFrame, state_path: str, log_path: str, now: datetime.datetime, buckets: int = 64) -> str:
    """Compares a hashed snapshot with the current state, appends the changes, publishes the new state; returns the batch id.

    The state is bucketed by id and the snapshot is dealt out alike once: neither the comparison nor the new state shuffles
    again. A batch id has the resolution of a second; one that the log has is refused, so a run that failed between its two
    writes is repeated under a new id from the old state.
    """
    batch = now.strftime("%Y-%m-%dT%H:%M:%SZ")
    state = BucketedTable(spark, state_path, "id", buckets)
    old, ts = state.read(VARIANT_STATE), F.lit(now).cast("timestamp")
    snapshot = state.dealt(snapshot).persist()
    try:
        target = f"{log_path.rstrip('/')}/batch_run_id={batch.replace(':', '%3A')}"
        log = change_log(snapshot, old, F.lit(batch), ts, F.current_timestamp()).drop("batch_run_id")
        log.write.mode("error").parquet(target)
        state.publish(conform(next_state(snapshot, ts), VARIANT_STATE))
    finally:
        snapshot.unpersist()
    return batch
