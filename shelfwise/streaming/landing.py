"""The landing folder as a stream: raw shop files are parsed as they arrive, and go once they are parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.functions import urls
from shelfwise.operators import products
from shelfwise.settings import Settings
from shelfwise.sources import readers, schemas, sinks

#: Tables that landed files become, below parsed_dir/landed; a micro-batch is a folder batch=N of each.
LANDED = ("ProductInfo", "Products", "BadPages")


def parsed_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """ProductInfo, Products, and the pages that are no JSON, from pages (source_file, body, value)."""
    bad = pages.where("value is null").select("source_file", F.length("body").cast("bigint").alias("n_chars"), F.substring("body", 1, 300).alias("snippet"))
    good = pages.where("value is not null")
    kind = f"array<struct<{schemas.SHOP_PAGE}>>".replace("\n", " ")
    listed = F.when(F.schema_of_variant("value").startswith("ARRAY"), F.from_json("body", kind)).otherwise(
        F.coalesce(F.from_json("body", f"struct<products:{kind}>")["products"], F.array().cast(kind))
    )
    feed = good.select("source_file", F.inline(listed))
    store = urls.store_of_reference(urls.reference_of_file(F.col("source_file")))
    return products.product_info(feed, urls.host(store), store), products.variants(feed), bad


def stream_landing(spark: SparkSession, s: Settings, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Parses all files of raw_dir/shop that no earlier start has taken, then stops.

    Each micro-batch replaces the folder of its own number, so one that was broken off and is made again leaves every row once.
    A page that is no JSON is entered in BadPages and the others go on. Files of committed micro-batches go to the archive
    (raw_dir/archive), or are deleted with landing_done=delete, when the next micro-batch or start commits; with
    landing_done=keep they stay.
    """
    done = {"archive": {"cleanSource": "archive", "sourceArchiveDir": f"{s.raw_dir}/archive"}, "delete": {"cleanSource": "delete"}, "keep": {}}[s.landing_done]

    def step(rows: DataFrame, epoch: int) -> None:
        rows = rows.persist()
        try:
            for name, table in zip(LANDED, parsed_pages(rows), strict=True):
                table.write.mode("overwrite").parquet(f"{s.parsed_dir}/landed/{name}/batch={epoch}")
        finally:
            rows.unpersist()

    pages = readers.stream_any_json(spark, f"{s.raw_dir}/shop", {"maxFilesPerTrigger": str(files_per_batch), **done})
    return pages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landed(spark: SparkSession, s: Settings, name: str) -> DataFrame:
    """All rows of a table that have landed so far."""
    path = f"{s.parsed_dir}/landed/{name}"
    if not sinks.exists(spark, path):
        raise FileNotFoundError(f"nothing has landed in {path}")
    return spark.read.parquet(path).drop("batch")


def load_landed(spark: SparkSession, s: Settings) -> dict[str, int]:
    """Adds what landed since the last load to the tables ProductInfo and Products: each micro-batch once.

    A micro-batch is a folder batch=N of the table too, replaced if it is loaded again; rows are counted while they are written.
    """
    from pyspark.sql import Observation

    found = {}
    for name in LANDED:
        here, table = f"{s.parsed_dir}/landed/{name}", f"{s.table_dir}/landed/{name}"
        new = [n for n in sinks.folders(spark, here, "batch=") if not sinks.exists(spark, f"{table}/{n}/_SUCCESS")]
        found[name] = 0
        for n in new:
            seen = Observation(f"{name}-{n}")
            spark.read.parquet(f"{here}/{n}").observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{table}/{n}")
            found[name] += seen.get["n"]
    return found
