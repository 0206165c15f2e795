"""Counts and summaries of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import blank_to_null, collapse

#: Kinds of scrape events and the counters that they feed.
EVENT_COUNTERS = {
    "http_error": "http_error_events", "request_exception": "request_exception_events", "retry_success": "successful_retry_pages",
    "page_empty": "empty_page_events",
}


def event_counts(events: DataFrame, kind: str = "event_type", counters: dict[str, str] = EVENT_COUNTERS) -> DataFrame:
    """One row of counters."""
    return events.agg(*[F.count_if(F.col(kind) == value).alias(name) for value, name in counters.items()])


def counts_json(events: DataFrame, code: str) -> DataFrame:
    """errors: counts by code as JSON in the order of codes; from a handful of groups."""
    groups = events.where(F.col(code).isNotNull()).groupBy(code).agg(F.count(F.lit(1)).alias("n"))
    entries = F.array_sort(F.collect_list(F.struct(F.col(code).alias("k"), F.col("n").alias("v"))))
    listed = F.transform(entries, lambda e: F.struct(e["k"].cast("string").alias("k"), e["v"].alias("v")))
    return groups.agg(F.to_json(F.map_from_entries(listed)).alias("errors"))


def first_distinct(df: DataFrame, value: Column, order: str, most: int) -> DataFrame:
    """listed: the first so many different values as JSON; white space collapsed, blanks left out."""
    rows = df.select(blank_to_null(collapse(value)).alias("v"), F.col(order).alias("o")).where("v is not null")
    first = rows.groupBy("v").agg(F.min("o").alias("o")).orderBy("o", "v").limit(most)
    return first.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("o", "v"))), lambda x: x["v"])).alias("listed"))


def store_outcomes(events: DataFrame) -> DataFrame:
    """Of events (store_url, page, event_type): stores and pages attempted, succeeded and failed.

    A page without any good answer failed, and with it its store.
    """
    pages = events.groupBy("store_url", "page").agg((~F.bool_or(F.col("event_type").isin("page_success", "page_empty"))).alias("bad"), F.bool_or(F.col("event_type") == "page_success").alias("good"))
    by_store = pages.groupBy("store_url").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if("good").alias("good_pages"), F.count_if("bad").alias("bad_pages"), F.bool_or("bad").alias("bad")
    )
    return by_store.agg(
        F.count(F.lit(1)).alias("stores_attempted"), F.count_if(~F.col("bad")).alias("stores_succeeded"), F.count_if("bad").alias("stores_failed"),
        F.sum("pages").alias("pages_attempted"), F.sum("good_pages").alias("pages_succeeded"), F.sum("bad_pages").alias("pages_failed"),
    )


def run_row(run: DataFrame, before: DataFrame | None, now: Column, key: str = "batch_run_id") -> DataFrame:
    """A run's row for an upsert: started_at when it starts (kept later), completed_at when it ends either way."""
    done = F.col("status").isin("COMPLETED", "FAILED")
    row = run.withColumns({"started_at": F.when(F.col("status") == "STARTED", now), "completed_at": F.when(done, now), "updated_at": now})
    if before is None:
        return row
    old = before.select(F.col(key).alias("__key"), F.col("started_at").alias("__started"))
    return row.join(old, F.col(key) == F.col("__key"), "left").withColumn("started_at", F.coalesce("started_at", "__started")).drop("__key", "__started")


def event_counters() -> list[Column]:
    """Counters of scrape events, for an aggregate or to be observed while events are written."""
    kind, bad = F.col("event_type"), F.col("event_type").isin("http_error", "request_exception")
    return [
        F.count_if(kind == "page_success").alias("pages_saved"), F.count_if((F.col("page") == 1) & bad).alias("page1_failures"),
        F.count_if(bad).alias("error_count"), *[F.count_if(kind == value).alias(name) for value, name in EVENT_COUNTERS.items()],
    ]


def scrape_row(events: DataFrame, counted: dict[str, int] | None, run_id: str, command: str, planned: int) -> DataFrame:
    """A finished scrape as one row of RUN_AUDIT: COMPLETED if every store gave its pages, else FAILED.

    counted: event_counters() as observed while the events were written; without them they are counted here.
    """
    if counted is None:
        counted = events.agg(*event_counters()).first().asDict()
    failed = events.where(F.col("event_type").isin("http_error", "request_exception"))
    said = F.coalesce(F.col("error"), F.concat(F.lit("status "), F.col("status_code").cast("string")))
    request = F.concat(
        F.lit("store="), F.col("store_url"), F.lit(" page="), F.col("page").cast("string"), F.lit(" attempt="), F.col("attempt").cast("string"),
        F.coalesce(F.concat(F.lit(" exception="), F.col("error")), F.concat(F.lit(" status="), F.col("status_code").cast("string")), F.lit("")), F.lit(" url="), F.col("url"),
    )
    row = (
        store_outcomes(events).select("stores_succeeded", "stores_failed")  # one row each
        .crossJoin(counts_json(failed, "status_code").withColumnRenamed("errors", "http_status_summary"))
        .crossJoin(first_distinct(failed, said, "url", 10).withColumnRenamed("listed", "error_summary"))
        .crossJoin(first_distinct(failed_stores(events), F.col("store_url"), "store_url", 10).withColumnRenamed("listed", "failed_store_summary"))
        .crossJoin(first_distinct(failed, request, "url", 50).withColumnRenamed("listed", "failed_request_summary"))
    )
    status = F.when(F.col("stores_failed") > 0, "FAILED").otherwise("COMPLETED")
    counts = [F.lit(n).cast("bigint").alias(c) for c, n in counted.items()]
    return row.select(F.lit(run_id).alias("run_id"), F.lit(command).alias("command"), status.alias("status"), F.lit(planned).cast("bigint").alias("stores_planned"), *counts, "*")


def failed_stores(events: DataFrame) -> DataFrame:
    """Stores with a page that never had a good answer."""
    good = F.bool_or(F.col("event_type").isin("page_success", "page_empty"))
    return events.groupBy("store_url", "page").agg(good.alias("good")).where("not good").select("store_url").distinct()
