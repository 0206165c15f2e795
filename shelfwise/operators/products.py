"""Rows of products and variants from shop feeds and stock records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import casts, identity, text, urls
from shelfwise.sources import schemas


def product_info(feed: DataFrame, store_host: Column, store_url: Column) -> DataFrame:
    """One row a product of a feed (schemas.SHOP_PAGE)."""
    return feed.select(
        F.col("id").alias("MainProductId"), F.col("title").alias("Title"), F.col("handle").alias("Handle"), store_host.alias("Store"),
        urls.product_link(store_url, F.col("handle")).alias("ProductLink"), text.strip_html(F.col("body_html")).alias("BodyHtml"),
        F.col("published_at").alias("PublishedAt"), F.col("created_at").alias("CreatedAt"), F.col("vendor").alias("Vendor"),
        F.col("product_type").alias("ProductType"), identity.tags_json(F.col("tags")).alias("Tags"),
    )


def variants(feed: DataFrame) -> DataFrame:
    """One row a variant of a feed; products without variants give none."""
    v = feed.select(F.col("id").alias("MainProductId"), F.explode("variants").alias("v"))
    return v.select(
        F.col("v.id").alias("VariantId"), F.col("v.title").alias("VariantTitle"), F.col("v.featured_image.src").alias("VarFeaturedImage"),
        F.col("v.available").alias("VariantAvailable"), F.col("v.price").alias("VariantPrice"),
        F.col("v.compare_at_price").alias("VariantCompareAtPrice"), F.col("v.grams").alias("VariantGrams"), "MainProductId",
        F.col("v.created_at").alias("VariantCreatedAt"), F.col("v.updated_at").alias("VariantUpdatedAt"),
    )


def stock(pages: DataFrame, base: str, at: Column) -> DataFrame:
    """One row a record of stock pages (schemas.STOCK_PAGE), all of one time."""
    r = pages.select(F.inline("data"))
    whole, number = {"Id", "StockWeight", "AvailableStock"}, {"StockPrice"}
    link = {"ModelLink", "StockImage"}

    def value(name: str) -> Column:
        c = F.col(name)
        if name in link:
            return urls.absolute(c, base)
        if name == "ModelDescription":
            return text.strip_html(c)
        return casts.to_int(c) if name in whole else casts.to_float(c) if name in number else c

    return schemas.conform(r.select(*[value(n).alias(n) for n in schemas.STOCK_FIELDS], at.alias("record_timestamp")), schemas.STOCK)


def price_bounds(variants_df: DataFrame, product: str, price: str) -> DataFrame:
    """product, low_price, high_price: to be joined to variants, so a product with many of them is summed before it moves."""
    return variants_df.groupBy(product).agg(F.min(price).alias("low_price"), F.max(price).alias("high_price"))
