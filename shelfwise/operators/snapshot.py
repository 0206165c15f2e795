"""The one snapshot of all variants, from the views of two sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import casts, identity
from shelfwise.functions.text import present
from shelfwise.operators.products import price_bounds
from shelfwise.sources.schemas import LOG_TYPES, VARIANT, VIEW_TYPES


_IDS = ("product_id", "variant_id", "id")


def _with_present_ids(src: DataFrame) -> DataFrame:
    """src with its three ids trimmed, blank ones null, as __product_id, __variant_id and __id: trimmed once for all uses."""
    return src.withColumns({f"__{c}": present(F.col(c)) for c in _IDS})


def _with_ids(src: DataFrame, made) -> DataFrame:
    rows = src.withColumn("__made", made)
    product = F.coalesce("__product_id", "__id", "__made")
    variant = F.coalesce("__variant_id", "__id", "__product_id", "__made")
    return rows.select(F.col("__made").alias("id"), product.alias("product_id"), variant.alias("variant_id"), *[F.col(c) for c in VARIANT[3:]])


def from_content(src: DataFrame) -> DataFrame:
    """Variants of the source without ids of its own: those with a link or a title, under a hash of what they are."""
    c = {n: F.col(n) for n in src.columns}
    made = identity.content_variant_id(c["store"], c["store_url"], c["product_link"], c["title"], c["variant_title"], c["weight_g"])
    return _with_ids(_with_present_ids(src.where(casts.any_present(c["product_link"], c["title"], c["variant_title"]))), made)


def from_shops(src: DataFrame) -> DataFrame:
    """Variants of shops: those with any id, under store and id."""
    src = _with_present_ids(src).withColumn("__key", F.coalesce("__variant_id", "__id", "__product_id")).where("__key is not null")
    return _with_ids(src, identity.shop_id(F.col("store"), F.col("store_url"), F.col("__key")))


def variant_snapshot(content: DataFrame, shops: DataFrame, types: dict[str, str] = VIEW_TYPES) -> DataFrame:
    """All variants in one schema: VIEW_TYPES for reading, LOG_TYPES for hashing and the change log."""
    rows = from_content(content).unionByName(from_shops(shops))

    def cast(name: str):
        c = F.col(name)
        if types[name] == "string" and name in ("price", "high_price", "low_price"):
            return casts.money_text(c)
        if types[name] == "bigint" and name == "weight_g":
            return F.round(c.cast("double")).cast("bigint")
        return c.cast(types[name])

    return rows.select(*[cast(c).alias(c) for c in VARIANT])


def hashed(snapshot: DataFrame, columns: Sequence[str] = VARIANT) -> DataFrame:
    """A snapshot in LOG_TYPES with row_hash over all but the ids, one row an id (of several the greatest hash).

    Only `columns` are kept beside id and row_hash, and only they move; the hash is over all in any case. Hashes move as bytes,
    whose order is that of their text.
    """
    rows = snapshot.select(*[F.col(c).cast(t).alias(c) for c, t in LOG_TYPES.items()])
    digest = F.unhex(identity.json_hash({c: F.col(c) for c in VARIANT[3:]}))
    kept = [c for c in VARIANT[1:] if c in columns]
    rows = rows.select("id", F.struct(digest.alias("digest"), *[F.col(c) for c in kept]).alias("v")).groupBy("id").agg(F.max("v").alias("v"))
    return rows.select("id", *[F.col(f"v.{c}") for c in kept], F.lower(F.hex("v.digest")).alias("row_hash"))


def shop_variants(products: DataFrame, info: DataFrame, kinds: DataFrame) -> DataFrame:
    """The shops' view: variants with their product's columns, its kind, and its lowest and highest price."""
    price = products.withColumn("price", casts.to_float(F.col("VariantPrice")))
    bounds = price_bounds(price, "MainProductId", "price")
    kinds = kinds.where("Source = 'Shopify'").select("MainProductId", "IsDistanceDriver", "IsFairwayDriver", "IsMidrange", "IsPutter").dropDuplicates(["MainProductId"])
    rows = price.join(info, "MainProductId").join(bounds, "MainProductId", "left").join(kinds, "MainProductId", "left")
    return rows.select(
        F.col("VariantId").alias("id"), F.col("MainProductId").alias("product_id"), F.col("VariantId").alias("variant_id"), F.col("Title").alias("title"),
        F.col("Vendor").alias("vendor"), F.col("ProductLink").alias("product_link"), F.col("Store").alias("store"),
        F.regexp_extract("ProductLink", "^([^:/]+://[^/]*/)", 1).alias("store_url"), F.lit(None).cast("string").alias("image"), F.col("VariantTitle").alias("variant_title"), "price",
        F.col("VariantGrams").alias("weight_g"), F.col("VariantAvailable").alias("in_stock"), F.col("VarFeaturedImage").alias("variant_image"),
        "high_price", "low_price", F.col("Tags").alias("tags"), "IsDistanceDriver", "IsFairwayDriver", "IsMidrange", "IsPutter", "BodyHtml",
        F.col("ProductType").alias("product_type"),
    )


def stock_variants(stock: DataFrame, kinds: DataFrame, store: str, store_url: str) -> DataFrame:
    """The stock source's view."""
    kinds = kinds.where("Source = 'Infinite'").select("MainProductId", "IsDistanceDriver", "IsFairwayDriver", "IsMidrange", "IsPutter").dropDuplicates(["MainProductId"])
    bounds = price_bounds(stock, "ModelLink", "StockPrice").withColumnRenamed("ModelLink", "link")
    rows = stock.join(kinds, stock["Id"] == kinds["MainProductId"], "left").join(bounds, F.col("ModelLink") == F.col("link"), "left")
    none = F.lit(None).cast("string")
    return rows.select(
        none.alias("id"), none.alias("product_id"), none.alias("variant_id"), F.concat_ws(" ", "PlasticName", "ModelName").alias("title"),
        F.col("ManufacturerName").alias("vendor"), F.col("ModelLink").alias("product_link"), F.lit(store).alias("store"), F.lit(store_url).alias("store_url"),
        F.col("StockImage").alias("image"), F.concat_ws(" / ", "ColorName", F.col("StockWeight").cast("string")).alias("variant_title"),
        F.col("StockPrice").alias("price"), F.col("StockWeight").alias("weight_g"), (F.col("AvailableStock") > 0).alias("in_stock"),
        F.col("StockImage").alias("variant_image"), "high_price", "low_price", none.alias("tags"), "IsDistanceDriver", "IsFairwayDriver", "IsMidrange",
        "IsPutter", F.col("ModelDescription").alias("BodyHtml"), none.alias("product_type"),
    )
