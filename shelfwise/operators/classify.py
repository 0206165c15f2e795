"""Kinds of discs from body texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import casts
from shelfwise.functions.text import once

#: In this order, the first that matches counts.
DISC_TYPES = [
    ("DistanceDriver", "distance driver|long range driver"),
    ("FairwayDriver", "fairway driver|long range driver"),
    ("Putter", "putter|approach"),
    ("Midrange", "midrange"),
]


def disc_type(body: Column) -> Column:
    """The kind that a body names, or Unknown."""

    def kind(low: Column) -> Column:
        out = F
        for name, pattern in DISC_TYPES:
            out = out.when(reduce(lambda a, b: a | b, [low.contains(words) for words in pattern.split("|")]), name)
        return out.otherwise("Unknown")

    return once(F.lower(F.coalesce(body, F.lit(""))), kind)


def flags(kind: Column) -> dict[str, Column]:
    return {f"Is{name}": (kind == name).cast("bigint") for name in ("DistanceDriver", "FairwayDriver", "Midrange", "Putter")}


def derived_product_type(product_info: DataFrame, stock: DataFrame) -> DataFrame:
    """Kinds of the products of both sources; a product id that is no number is null."""
    shop = product_info.select(
        casts.to_int(F.col("MainProductId")).alias("MainProductId"), F.col("ProductType").cast("string"), F.col("Tags").cast("string"),
        F.coalesce(F.col("BodyHtml").cast("string"), F.lit("")).alias("BodyHtml"), F.lit("Shopify").alias("Source"),
    )
    own = stock.select(
        casts.to_int(F.col("Id")).alias("MainProductId"), F.lit("").alias("ProductType"), F.lit("").alias("Tags"),
        F.coalesce(F.col("ModelDescription").cast("string"), F.lit("")).alias("BodyHtml"), F.lit("Infinite").alias("Source"),
    )
    rows = shop.unionByName(own).withColumn("DiscType", disc_type(F.col("BodyHtml"))).withColumns(flags(F.col("DiscType")))
    return rows.select(
        "MainProductId", "ProductType", "Tags", "DiscType", "IsDistanceDriver", "IsFairwayDriver", "IsMidrange", "IsPutter", "Source", "BodyHtml"
    )
