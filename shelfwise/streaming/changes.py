"""The change log as a stream: each micro-batch is indexed and its run recorded."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from shelfwise.operators import documents
from shelfwise.operators.audit import run_row
from shelfwise.operators.combine import VersionedTable, upsert
from shelfwise.sources.schemas import INDEX_RUNS, VARIANT_CHANGES, conform

#: What takes documents and ids away; returns the number of batches that failed.
Sink = Callable[[DataFrame, DataFrame], int]


def index_changes(changes: DataFrame, sink: Sink, batch_size: int = 200) -> dict[str, int]:
    """Sends the latest change of each id to the sink; returns the totals. Used for one batch, streamed or not."""
    latest = documents.dispatched(documents.latest_changes(changes)).persist()
    try:
        found = documents.totals(latest, batch_size).first().asDict()
        put = documents.search_documents(latest.where("what = 'upsert'"), F.unix_millis(F.current_timestamp()))
        found["failed_batches"] = sink(put, latest.where("what = 'delete'").select("id"))
        return found
    finally:
        latest.unpersist()


class RunTable:
    """The keyed table of runs."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._table = spark, VersionedTable(spark, path)

    def read(self) -> DataFrame:
        return self._table.read(INDEX_RUNS)

    def completed(self, batch: str) -> bool:
        return not self.read().where((F.col("batch_run_id") == batch) & (F.col("status") == "COMPLETED")).isEmpty()

    def record(self, batch: str, status: str, totals: dict[str, int] | None = None, error: str = "") -> None:
        """Starting puts counters at zero; start times are kept after that."""
        counts = {c: int((totals or {}).get(c, 0)) for c in ("rows_seen", "upserts", "deletes", "unknown_ops", "upsert_batches", "delete_batches")}
        row = self._spark.range(1).select(
            F.lit(batch).alias("batch_run_id"), F.lit(status).alias("status"), *[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()],
            F.substring(F.lit(error), 1, 5000).alias("error_message"),
        )
        old = self.read()
        row = run_row(row, None if status == "STARTED" else old, F.current_timestamp())
        self._table.publish(upsert(old, conform(row, INDEX_RUNS), ["batch_run_id"]))


def index_batch(log: DataFrame, runs: RunTable, sink: Sink, batch: str | None = None, batch_size: int = 200, force: bool = False) -> str | None:
    """Indexes a batch of the log, the newest if none is named; returns its id, or None if there is none or it is done.

    The run is FAILED if the sink fails or reports failed batches, and can then be run again; upserts and deletes by id do
    no harm twice.
    """
    if batch is None:
        newest = documents.latest_batch(log).first()
        if newest is None:
            return None
        batch = newest[0]
    if runs.completed(batch) and not force:
        return None
    runs.record(batch, "STARTED")
    try:
        totals = index_changes(log.where(F.col("batch_run_id") == batch), sink, batch_size)
    except Exception as e:
        runs.record(batch, "FAILED", error=str(e))
        raise
    failed = totals["failed_batches"]
    runs.record(batch, "FAILED" if failed else "COMPLETED", totals, f"{failed} batches failed" if failed else "")
    return batch


def _order(ts: datetime.datetime | None, operation: str | None) -> tuple:
    """What a later change of an id is greater in; nulls come before all."""
    return ts is not None, ts.timestamp() if ts else 0.0, operation is not None, operation or ""


class _Newest(StatefulProcessor):
    """Lets the newest change of an id pass if none that passed before is as new; keeps its time and operation."""

    def __init__(self, columns: list[str]) -> None:
        self._columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", "change_ts timestamp, operation string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        best = max(rows, key=lambda r: _order(r["change_ts"], r["operation"]))
        if not self._last.exists() or _order(best["change_ts"], best["operation"]) > _order(*self._last.get()):
            self._last.update((best["change_ts"], best["operation"]))
            yield Row(**{c: best[c] for c in self._columns})

    def close(self) -> None:
        pass


#: Keyed state needs a store that keeps it outside the heap.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def newest_only(log: DataFrame) -> DataFrame:
    """Of a stream of changes, those that are newer than all of their id that came before, whatever micro-batch these were in.

    So a change that arrives late, after a newer one of its id, isn't sent over it. An id's state is one time and one
    operation. A null id counts as an id of its own.
    """
    for key, value in STATE_STORE.items():
        log.sparkSession.conf.set(key, value)
    keyed = log.withColumn("__id", F.coalesce("id", F.lit(""))).groupBy("__id")
    return keyed.transformWithState(_Newest(log.columns), log.schema, "append", "none")


def stream_changes(
    spark: SparkSession, log_path: str, runs: RunTable, sink: Sink, checkpoint: str, batch_size: int = 200, files_per_batch: int | None = None
) -> StreamingQuery:
    """Follows the log's files and indexes all that are there, then stops; every batch is taken, not the newest only.

    The newest change of an id is picked within each micro-batch and against the state of those before. If sending fails, the
    micro-batch isn't committed, and neither is its state: the next start sends the same changes again.
    """

    def step(rows: DataFrame, epoch: int) -> None:
        rows = rows.persist()
        try:
            if rows.isEmpty():
                return
            name = f"stream-{epoch}"
            runs.record(name, "STARTED")
            totals = index_changes(rows, sink, batch_size)
            runs.record(name, "FAILED" if totals["failed_batches"] else "COMPLETED", totals)
            if totals["failed_batches"]:
                raise RuntimeError(f"{totals['failed_batches']} batches of {name} failed")
        finally:
            rows.unpersist()

    reader = spark.readStream.schema(VARIANT_CHANGES)
    reader = reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)
    changes = newest_only(reader.parquet(log_path))
    return changes.writeStream.foreachBatch(step).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, key: str, length: str, late: str) -> DataFrame:
    """Counts by time window and key of an event stream (or table); events later than `late` are dropped from a stream."""
    rows = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    counted = rows.groupBy(F.window("__ts", length).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), key, "n")
