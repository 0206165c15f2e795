"""Queries of what comes in: sitemaps, raw pages, runs, named tables, changes that arrive late."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import audit
from shelfwise.plans import named_tables
from shelfwise.plans.standins import change_events, table
from shelfwise.sources import crawls
from shelfwise.sources.scratch import shared_path
from shelfwise.streaming.changes import newest_only
from shelfwise.streaming.landing import parsed_pages


def sitemap_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product addresses of sitemaps of a hundred parts each, in order, each once."""
    key = F.col("p_partkey")
    loc = F.concat(
        F.lit("<url><loc> https://s.example/product/"), (key % 700).cast("string"), F.lit("</loc></url>\n<LOC>https://s.example/about/"), key.cast("string"), F.lit("</LOC>")
    )
    maps = table(spark, sf_dir, "part").groupBy(F.floor(key / 100).alias("place")).agg(F.array_sort(F.collect_list(F.struct(key.alias("k"), loc.alias("loc")))).alias("l"))
    maps = maps.select("place", F.concat(F.lit("<urlset>"), F.array_join(F.col("l.loc"), ""), F.lit("</urlset>")).alias("html"))
    return crawls.placed(crawls.locations(maps, "https://s.example/", "/product/", escaped=False))


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of raw pages, one a part, some as lists and some as objects; those that are no JSON with their length."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey").cast("string")
    product = F.concat(F.lit('{"id": '), key, F.lit(', "title": "'), F.col("p_name"), F.lit('", "variants": [{"id": 1}]}'))
    body = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("<html>"), F.col("p_name"))).when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("["), product, F.lit("]")))
    body = body.otherwise(F.concat(F.lit('{"products": ['), product, F.lit("]}")))
    name = F.concat(F.lit("/raw/my__shop_"), key, F.lit("_20240101.json"))
    info, _, bad = parsed_pages(p.select(name.alias("source_file"), body.alias("body"), F.try_parse_json(body).alias("value")))
    none = F.lit(None)
    good = info.select(F.col("MainProductId").alias("id"), F.col("Title").alias("title"), F.col("Store").alias("store"), none.cast("bigint").alias("n_chars"))
    return good.unionByName(bad.select(none.cast("bigint").alias("id"), F.col("snippet").alias("title"), none.cast("string").alias("store"), "n_chars"))


def _scrape_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as those of a scrape of twenty stores."""
    e, kind = table(spark, sf_dir, "events"), F.col("event_type")
    mapped = F.when(kind == "error", F.when(F.col("event_id") % 2 == 0, "http_error").otherwise("request_exception")).when(kind == "view", "page_empty")
    mapped = mapped.when(kind == "purchase", "retry_success").otherwise("page_success")
    failed = kind == "error"
    return e.select(
        mapped.alias("event_type"), (F.col("event_id") % 97).alias("page"), (F.col("value") % 4).cast("int").alias("attempt"),
        F.concat(F.lit("https://s.example/"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("url"),
        F.when(failed & (F.col("event_id") % 2 == 0), (500 + F.col("user_id") % 3).cast("int")).alias("status_code"),
        F.when(failed & (F.col("event_id") % 2 == 1), F.concat(F.lit("late  "), (F.col("user_id") % 5).cast("string"))).alias("error"),
        F.concat(F.lit("store"), (F.col("user_id") % 20).cast("string")).alias("store_url"),
    )


def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit row of a scrape."""
    return audit.scrape_row(_scrape_events(spark, sf_dir).drop("attempt").withColumn("attempt", F.lit(1)), None, "run", "scrape-shop", 20)


def named_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last change of each id in the newest batch, by SQL over a named view with a parameter."""
    log = change_events(spark, sf_dir)
    log.createOrReplaceTempView("shelfwise_log")
    batch = spark.sql("SELECT max(batch_run_id) FROM IDENTIFIER(:log)", args={"log": "shelfwise_log"}).first()[0]
    return named_tables.latest_changes(spark, "shelfwise_log", batch or "").select("id", "operation", "event_id")


def stream_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is last of each id when the change log arrives in micro-batches out of order and late changes are held back."""
    work = shared_path(spark, "newest")
    log = change_events(spark, sf_dir).select("batch_run_id", "operation", "id", "change_ts")
    # four files, of which none is all of one time: later micro-batches hold older changes
    log.repartition(4, F.xxhash64("id", "change_ts") % 4).write.parquet(f"{work}/log")

    def step(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{work}/passed/epoch={epoch}")

    source = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(f"{work}/log")
    newest_only(source).writeStream.foreachBatch(step).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    passed = spark.read.schema(f"{log.schema.simpleString()[7:-1].replace(':', ' ')}, epoch int").parquet(f"{work}/passed")
    last = passed.groupBy("id").agg(F.max_by(F.struct("operation", "change_ts"), "epoch").alias("c"), F.count(F.lit(1)).alias("n"))
    return last.select("id", "c.operation", F.date_format("c.change_ts", "yyyy-MM-dd HH:mm:ss").alias("change_ts"), (F.col("n") <= 2).alias("at_most_one_a_batch"))


_OP = "CASE event_type WHEN 'purchase' THEN 'DELETE' WHEN 'click' THEN 'upsert' WHEN 'view' THEN 'UPSERT' ELSE upper(event_type) END AS operation"
_EVENTS = """e AS (SELECT CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'http_error' ELSE 'request_exception' END WHEN event_type = 'view' THEN 'page_empty'
    WHEN event_type = 'purchase' THEN 'retry_success' ELSE 'page_success' END AS kind, event_id % 97 AS page, 'https://s.example/' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS url,
    CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN CAST(500 + user_id % 3 AS VARCHAR) END AS code, CASE WHEN event_type = 'error' AND event_id % 2 = 1 THEN 'late  ' || CAST(user_id % 5 AS VARCHAR) END AS error,
    'store' || CAST(user_id % 20 AS VARCHAR) AS store FROM events)"""


def _listed(value: str, source: str, order: str, most: int) -> str:
    """The first different values, white space collapsed, as JSON."""
    return f"""(SELECT coalesce('["' || string_agg(v, '","' ORDER BY o, v) || '"]', '[]') FROM (
      SELECT v, min(o) AS o FROM (SELECT trim(regexp_replace({value}, '\\s+', ' ', 'g')) AS v, {order} AS o FROM {source}) WHERE v <> '' GROUP BY v ORDER BY 2, 1 LIMIT {most}))"""


QUERIES = {f.__name__: f for f in (sitemap_addresses, landed_pages, run_audit, named_latest, stream_newest)}
SQL = {
    "sitemap_addresses": """SELECT 'https://s.example/product/' || CAST(k AS VARCHAR) AS url, row_number() OVER (ORDER BY first) - 1 AS place
        FROM (SELECT p_partkey % 700 AS k, min(p_partkey) AS first FROM part GROUP BY 1)""",
    "landed_pages": """SELECT CASE WHEN p_partkey % 7 <> 0 THEN p_partkey END AS id, CASE WHEN p_partkey % 7 = 0 THEN '<html>' || p_name ELSE p_name END AS title,
        CASE WHEN p_partkey % 7 <> 0 THEN 'my.shop' END AS store, CASE WHEN p_partkey % 7 = 0 THEN 6 + length(p_name) END AS n_chars FROM part""",
    "run_audit": f"""WITH {_EVENTS}, f AS (SELECT * FROM e WHERE kind IN ('http_error', 'request_exception')),
        p AS (SELECT store, page, bool_or(kind IN ('page_success', 'page_empty')) AS good FROM e GROUP BY 1, 2), s AS (SELECT store, bool_and(good) AS good FROM p GROUP BY 1)
        SELECT 'run' AS run_id, 'scrape-shop' AS command, CASE WHEN (SELECT bool_and(good) FROM s) THEN 'COMPLETED' ELSE 'FAILED' END AS status, CAST(20 AS BIGINT) AS stores_planned,
          count(*) FILTER (kind = 'page_success') AS pages_saved, count(*) FILTER (page = 1 AND kind IN ('http_error', 'request_exception')) AS page1_failures,
          count(*) FILTER (kind IN ('http_error', 'request_exception')) AS error_count, count(*) FILTER (kind = 'http_error') AS http_error_events,
          count(*) FILTER (kind = 'request_exception') AS request_exception_events, count(*) FILTER (kind = 'retry_success') AS successful_retry_pages,
          count(*) FILTER (kind = 'page_empty') AS empty_page_events, (SELECT count(*) FROM s WHERE good) AS stores_succeeded, (SELECT count(*) FROM s WHERE NOT good) AS stores_failed,
          (SELECT '{{' || string_agg('"' || code || '":' || CAST(n AS VARCHAR), ',' ORDER BY code) || '}}' FROM (SELECT code, count(*) AS n FROM f WHERE code IS NOT NULL GROUP BY 1)) AS http_status_summary,
          {_listed("coalesce(error, 'status ' || code)", "f", "url", 10)} AS error_summary,
          {_listed("store", "(SELECT DISTINCT store FROM p WHERE NOT good)", "store", 10)} AS failed_store_summary,
          {_listed("'store=' || store || ' page=' || CAST(page AS VARCHAR) || ' attempt=1' || coalesce(' exception=' || error, ' status=' || code, '') || ' url=' || url", "f", "url", 50)} AS failed_request_summary
        FROM e""",
    "named_latest": f"""WITH log AS (SELECT strftime(ts, '%Y-%m-%d') AS batch_run_id, {_OP}, CAST(user_id AS VARCHAR) AS id, ts AS change_ts, event_id FROM events)
        SELECT id, operation, event_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY change_ts DESC, operation DESC) AS rn FROM log WHERE batch_run_id = (SELECT max(batch_run_id) FROM log)) WHERE rn = 1""",
    "stream_newest": f"""SELECT CAST(user_id AS VARCHAR) AS id, operation, strftime(ts, '%Y-%m-%d %H:%M:%S') AS change_ts, true AS at_most_one_a_batch
        FROM (SELECT *, {_OP}, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, operation DESC) AS rn FROM events) WHERE rn = 1""",
}
