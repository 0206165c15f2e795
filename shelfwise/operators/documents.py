"""Search documents from the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import casts, identity, text, urls
from shelfwise.functions.text import present
from shelfwise.operators.combine import first_per_key


def latest_batch(log: DataFrame) -> DataFrame:
    """batch_run_id of the newest batch: one row, or none for an empty log."""
    return log.groupBy("batch_run_id").agg(F.max("batch_run_ts").alias("ts")).orderBy(F.desc_nulls_last("ts"), F.desc("batch_run_id")).limit(1).select("batch_run_id")


def latest_changes(log: DataFrame, batch: str | None = None) -> DataFrame:
    """The last change of each id, of a batch if one is given; of two at one time UPSERT comes before DELETE."""
    rows = log if batch is None else log.where(F.col("batch_run_id") == batch)
    return first_per_key(rows, ["id"], [F.desc("change_ts"), F.desc("operation")])


def dispatched(changes: DataFrame) -> DataFrame:
    """changes with what: upsert, delete, unknown, or skipped for deletes without an id."""
    op = F.upper(F.coalesce("operation", F.lit("")))
    what = F.when(op == "UPSERT", "upsert").when((op == "DELETE") & present(F.col("id")).isNotNull(), "delete").when(op == "DELETE", "skipped")
    return changes.withColumn("what", what.otherwise("unknown"))


def totals(changes: DataFrame, batch_size: int = 200) -> DataFrame:
    """rows_seen, upserts, deletes, unknown_ops and the numbers of batches; from dispatched rows."""
    n = lambda what: F.count_if(F.col("what") == what)
    sums = changes.agg(F.count(F.lit(1)).alias("rows_seen"), n("upsert").alias("upserts"), n("delete").alias("deletes"), n("unknown").alias("unknown_ops"))
    return sums.withColumns({"upsert_batches": F.ceil(F.col("upserts") / batch_size), "delete_batches": F.ceil(F.col("deletes") / batch_size)})


def search_documents(rows: DataFrame, indexed_at: Column) -> DataFrame:
    """One document a variant: no nulls, numbers and flags typed, tags listed, images only if they are web addresses."""
    c = {n: F.col(n) for n in rows.columns}
    tags = identity.parse_tags(c["tags"])
    word = {n: casts.safe_string(c[n]) for n in ("title", "variant_title", "vendor", "store")}
    image = lambda n: F.when(urls.is_web_address(c[n]), c[n]).otherwise(F.lit(""))
    made = {
        "price": casts.safe_float(c["price"]), "weight_g": casts.safe_int(c["weight_g"]), "in_stock": casts.safe_bool(c["in_stock"]),
        "image": image("image"), "variant_image": image("variant_image"), "high_price": casts.safe_float(c["high_price"]),
        "low_price": casts.safe_float(c["low_price"]), "tags": tags,
        **{n: casts.safe_bool(c[n]) for n in ("IsDistanceDriver", "IsFairwayDriver", "IsMidrange", "IsPutter")},
    }
    from shelfwise.sources.schemas import VARIANT

    return rows.select(
        *[made.get(n, casts.safe_string(c[n])).alias(n) for n in VARIANT],
        text.search_text(list(word.values()), tags).alias("search_text"), indexed_at.cast("bigint").alias("last_indexed_at"),
    )


def as_lines(documents: DataFrame) -> DataFrame:
    """value: one JSON text a document."""
    return documents.select(F.to_json(F.struct("*")).alias("value"))
