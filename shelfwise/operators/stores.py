"""Adding stores to the list of known ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.urls import store_key
from shelfwise.operators.combine import first_per_key


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("__key", store_key(F.col("URL")))


def new_stores(rows: DataFrame, known: DataFrame, order: str) -> DataFrame:
    """Rows of stores that aren't known, the first of each address by order."""
    fresh = first_per_key(_keyed(rows).where("__key is not null"), ["__key"], [F.col(order)])
    return fresh.join(_keyed(known).select("__key"), "__key", "left_anti").drop("__key")


def skipped_stores(rows: DataFrame, known: DataFrame, order: str) -> DataFrame:
    """The other rows with the reason: blank, known, or repeated in the list."""
    keyed = _keyed(rows)
    first = keyed.groupBy("__key").agg(F.min(order).alias("__first"))
    there = _keyed(known).select("__key").where("__key is not null").distinct().withColumn("__known", F.lit(True))
    keyed = keyed.join(first, "__key", "left").join(there, "__key", "left")
    reason = F.when(F.col("__key").isNull(), "blank").when(F.col("__known"), "known").when(F.col(order) != F.col("__first"), "repeated")
    return keyed.withColumn("reason", reason).where("reason is not null").drop("__key", "__first", "__known")
