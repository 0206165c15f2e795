"""The star schema's tables in the roles of shop feeds, stock records, states and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.classify import disc_type, flags


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _kind(p_type):
    """Body texts with all of the kinds, from part types."""
    words = [("ECONOMY", "distance driver"), ("STANDARD", "Fairway Driver"), ("PROMO", "a putter"), ("SMALL", "Midrange")]
    out = None
    for word, text in words:
        out = F.when(p_type.contains(word), F.lit(text)) if out is None else out.when(p_type.contains(word), F.lit(text))
    return out.otherwise(p_type)


def stock_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as variants of the source without ids."""
    p = table(spark, sf_dir, "part").withColumn("BodyHtml", _kind(F.col("p_type")))
    p = p.withColumn("kind", disc_type(F.col("BodyHtml"))).withColumns(flags(F.col("kind")))
    none = F.lit(None).cast("string")
    return p.select(
        none.alias("id"), none.alias("product_id"), none.alias("variant_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("vendor"),
        F.concat(F.lit("https://stock.example/"), F.col("p_partkey").cast("string")).alias("product_link"), none.alias("store"),
        F.lit("https://stock.example/").alias("store_url"), none.alias("image"), F.col("p_type").alias("variant_title"), F.col("p_retailprice").alias("price"),
        F.col("p_size").cast("bigint").alias("weight_g"), (F.col("p_size") > 25).alias("in_stock"), none.alias("variant_image"),
        F.col("p_retailprice").alias("high_price"), F.col("p_retailprice").alias("low_price"), none.alias("tags"),
        "IsDistanceDriver", "IsFairwayDriver", "IsMidrange", "IsPutter", "BodyHtml", F.col("p_type").alias("product_type"),
    )


def shop_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as variants of shops (their suppliers) with their part's columns; order and line repeat, so ids do."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", F.lower("p_brand").alias("tag"), _kind(F.col("p_type")).alias("BodyHtml"))
    p = p.withColumn("kind", disc_type(F.col("BodyHtml"))).withColumns(flags(F.col("kind"))).drop("kind")
    bounds = li.groupBy("l_partkey").agg(F.min("l_extendedprice").alias("low_price"), F.max("l_extendedprice").alias("high_price")).withColumnRenamed("l_partkey", "k")
    v = li.join(bounds, F.col("l_partkey") == F.col("k")).join(p, F.col("l_partkey") == F.col("p_partkey"))  # bounds first: no part's columns move
    shop = F.concat(F.lit("https://shop"), (F.col("l_suppkey") % 10).cast("string"), F.lit(".example/"))
    none = F.lit(None).cast("string")
    return v.select(
        none.alias("id"), F.col("l_partkey").cast("string").alias("product_id"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("variant_id"),
        F.col("p_name").alias("title"), F.col("p_brand").alias("vendor"), F.concat(shop, F.lit("products/"), F.col("l_partkey").cast("string")).alias("product_link"),
        F.concat(F.lit("Shop"), (F.col("l_suppkey") % 10).cast("string")).alias("store"), shop.alias("store_url"), none.alias("image"),
        F.col("l_linestatus").alias("variant_title"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("bigint").alias("weight_g"),
        (F.col("l_returnflag") != "R").alias("in_stock"), none.alias("variant_image"), "high_price", "low_price",
        F.concat(F.lit('["'), F.col("tag"), F.lit('","disc"]')).alias("tags"),
        "IsDistanceDriver", "IsFairwayDriver", "IsMidrange", "IsPutter", "BodyHtml", F.col("p_type").alias("product_type"),
    )


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a change log: a batch a day, an id a user."""
    e = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "purchase", "DELETE").when(F.col("event_type") == "click", "upsert").when(F.col("event_type") == "view", "UPSERT").otherwise(F.upper("event_type"))
    return e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("batch_run_id"), F.date_trunc("day", F.col("ts")).alias("batch_run_ts"), op.alias("operation"),
        F.col("user_id").cast("string").alias("id"), F.col("ts").alias("change_ts"), F.col("event_id"), F.col("value"),
    )
