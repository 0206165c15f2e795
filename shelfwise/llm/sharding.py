"""Two-pass external shuffle into equal shards.

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded hash. Pass 2 shuffles each bucket in memory
(Spark's shuffle() is an inside-out Fisher-Yates) and writes it. The shuffled buckets in order are one random permutation
of the table, which is cut into shards whose row counts differ by one at most.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.workspace import new_path, written

#: Hash cells that the counting pass keeps, and so the most buckets there can be: the table of bucket offsets, which is
#: broadcast, has at most so many rows of 16 bytes. Beyond MAX_CELLS * bucket_bytes of input, buckets grow instead.
MAX_CELLS = 1 << 20


def _size(text: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(16)


def _placed(df: DataFrame) -> DataFrame:
    """df with __place, which tells rows apart that are alike and is the same in each read: from the file's name and the
    row's number in it; tables that come from no such files are first written with a number a row."""
    try:
        origin = df.metadataColumn("_metadata")
        return df.select("*", F.xxhash64(origin["file_name"], origin["row_index"]).alias("__place"))
    except AnalysisException:
        return written(df.withColumn("__place", F.monotonically_increasing_id()), "shard-places")


def shard_documents(
    df: DataFrame,
    n_shards: int = 40,
    seed: int = 17,
    bucket_bytes: int = 16 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
) -> DataFrame:
    """Writes df, shuffled, as Parquet partitioned by shard, and returns the written table with columns shard and slot.

    Every row gets one shard (0 to n_shards - 1) and one slot in it (gapless from 0); row counts of shards are at most
    one apart. Null ids and texts are ordinary values. Rows that are alike are all kept and told apart by their place in
    the input files, so that no group of copies falls into one bucket: the same files give the same shuffle. An empty
    table gives an empty result. An input column named shard or slot comes back
    as shard_in or slot_in. A single text larger than bucket_bytes makes its bucket larger.
    """
    spark = df.sparkSession
    for name in [c for c in df.columns if c.lower() in ("shard", "slot")]:
        df = df.withColumnRenamed(name, f"{name}_in")
    df = _placed(df)
    key = [F.col(id_col), F.col(text_col), F.col("__place")]
    cell = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(MAX_CELLS))
    cells = written(df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.sum(_size(text_col)).alias("b")), "shard-cells")
    top = cells.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    total, n_bytes = top["n"] or 0, top["b"] or 0
    n_buckets = max(1, min(MAX_CELLS, -(-n_bytes // bucket_bytes)))
    bucket = F.expr(f"cell * {n_buckets} div {MAX_CELLS}").cast("int")
    order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cells.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"))
        .select("bucket", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    )
    names = [c for c in df.columns if c != "__place"]
    scattered = (
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
            cell.alias("cell"),
            F.xxhash64(F.lit(seed + 1), *key).alias("k"),
        )
        .select("row", "k", bucket.alias("bucket"))
        .repartitionById(min(n_buckets, 16384), "bucket")  # a bucket a task, as long as there are tasks enough
        .sortWithinPartitions("bucket", "k")
    )
    place = F.col("before") + F.col("pos")
    shuffled = (
        scattered.groupBy("bucket").agg(F.collect_list("row").alias("rows"))
        .select("bucket", F.shuffle("rows", seed).alias("rows"))
        .join(F.broadcast(offsets), "bucket")
        .select("before", F.posexplode("rows").alias("pos", "row"))
        .select("row", place.alias("p"))
        .select("row", "p", F.expr(f"cast(p * {n_shards} div {max(total, 1)} as int)").alias("shard"))
        .select(F.col("row.*"), "shard", F.expr(f"p - (shard * cast({total} as bigint) + {n_shards - 1}) div {n_shards}").alias("slot"))
        .sortWithinPartitions("shard", "slot")
    )
    path = path or new_path(spark, "shards")
    shuffled.write.partitionBy("shard").parquet(path)
    schema = shuffled.schema
    return spark.read.schema(schema).parquet(path).select(*names, "shard", "slot")
