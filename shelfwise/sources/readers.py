"""Readers of raw and parsed files, wherever Spark can read: local, HDFS or an object store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.casts import to_int
from shelfwise.functions.text import trim
from shelfwise.functions.urls import store_key
from shelfwise.sources import schemas


def read_json(spark: SparkSession, path: str | list[str], schema: str, recursive: bool = False) -> DataFrame:
    """JSON files of one value each (an array gives a row an element), with the file's name as source_file.

    recursive takes folders below and any case of the suffix, as an object store's prefix listing does.
    """
    reader = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", recursive)
    reader = reader.option("pathGlobFilter", "*.[jJ][sS][oO][nN]" if recursive else "*.json")
    return reader.json(path).withColumn("source_file", F.col("_metadata.file_path"))


def _as_variants(files: DataFrame) -> DataFrame:
    return files.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("body"), F.try_parse_json("value").alias("value"))


def read_any_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON files of any shape: source_file, body, and value as a variant; null where the body is no JSON.

    So a bad page is a row that can be counted, and doesn't end the load of the others.
    """
    return _as_variants(spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(path))


def stream_any_json(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """read_any_json() of the files that arrive in a folder."""
    reader = spark.readStream.option("wholetext", True).option("pathGlobFilter", "*.json").options(**options)
    return _as_variants(reader.text(path))


def json_text(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """One download that is already in memory."""
    kind = f"array<struct<{schema}>>" if text.lstrip().startswith("[") else f"struct<{schema}>"
    parsed = spark.range(1).select(F.from_json(F.lit(text), kind).alias("v"))
    return parsed.select(F.inline("v")) if kind.startswith("array") else parsed.select("v.*")


def read_parquet(spark: SparkSession, paths: str | list[str], schema: str | None = None, suffix: str | None = None) -> DataFrame:
    """Parquet files; suffix takes those whose names end so, schema casts to a table's columns."""
    reader = spark.read.option("mergeSchema", schema is None)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    df = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    return schemas.conform(df, schema) if schema else df


def read_stores(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The store list: values trimmed, both addresses in one form, flags whole numbers (anything else in them fails)."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    df = df.select(*[trim(F.col(f"`{c}`")).alias(c) for c in df.columns])
    number = lambda c: F.when(F.col(c) != "", F.col(c).cast("bigint")).alias(c)
    made = {"URL": store_key(F.col("URL")), "API_URL": store_key(F.col("API_URL"))}
    return df.select(*[made[c].alias(c) if c in made else number(c) if c in ("IsShopify", "UseUnpagedProductsJson") else F.col(c) for c in df.columns])


def known_stores(stores: DataFrame) -> DataFrame:
    return stores.select("URL").where("URL is not null")


def scrape_list(stores: DataFrame) -> DataFrame:
    """API_URL and use_unpaged of the shops with a product feed, each pair once."""
    unpaged = F.coalesce(F.col("UseUnpagedProductsJson").cast("bigint"), F.lit(0))
    return stores.where(to_int(F.col("IsShopify")) == 1).select("API_URL", unpaged.alias("use_unpaged")).distinct()
