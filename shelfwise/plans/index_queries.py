"""Queries of the change log, documents, stores, audits and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import audit, combine, documents, stores
from shelfwise.plans.snapshot_queries import SOURCES_SQL, variant_snapshot
from shelfwise.plans.standins import change_events, table
from shelfwise.sources.readers import scrape_list
from shelfwise.sources.schemas import VARIANT
from shelfwise.sources.scratch import shared_path
from shelfwise.streaming.changes import windowed_counts


def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.latest_batch(change_events(spark, sf_dir))


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_events(spark, sf_dir)
    order = [F.desc("change_ts"), F.desc("operation"), F.desc("event_id")]
    return combine.first_per_key(log, ["batch_run_id", "id"], order).select("batch_run_id", "id", "operation", "event_id")


def latest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last change of each id in the newest batch."""
    log = change_events(spark, sf_dir)
    return documents.latest_changes(log.join(documents.latest_batch(log), "batch_run_id", "left_semi")).select("id", "operation", "event_id")


def op_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents.dispatched(change_events(spark, sf_dir).withColumn("id", F.when(F.col("event_id") % 7 != 0, F.col("id")).otherwise(F.lit(" "))))
    return rows.groupBy("what").agg(F.count(F.lit(1)).alias("n"))


def index_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.totals(documents.dispatched(change_events(spark, sf_dir)))


def chunk_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = combine.batches(change_events(spark, sf_dir), [F.col("event_id")], 200, ["operation"])
    return rows.groupBy("operation", "batch").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))


def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of all variants."""
    docs = documents.search_documents(variant_snapshot(spark, sf_dir).withColumn("image", F.col("product_link")), F.lit(1706745600000))
    return docs.withColumn("tags", F.array_join("tags", "|"))


def dim_load_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.new_stores(_candidates(spark, sf_dir), _known(spark, sf_dir), "s_suppkey").select("URL", "s_suppkey")


def dim_load_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.skipped_stores(_candidates(spark, sf_dir), _known(spark, sf_dir), "s_suppkey").select("s_suppkey", "reason")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = (F.col("s_suppkey") % 40).cast("string")
    url = F.when(F.col("s_suppkey") % 11 == 0, F.lit(" ")).when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("HTTPS://Shop"), name, F.lit(".example/?x=1"))).otherwise(F.concat(F.lit("shop"), name, F.lit(".example//")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", url.alias("URL"))


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.concat(F.lit("https://shop"), F.col("n_nationkey").cast("string"), F.lit(".example")).alias("URL"))


def distinct_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    flag = F.when(F.col("s_suppkey") % 3 == 0, F.col("s_suppkey") % 2)
    url = F.concat(F.lit("https://shop"), (F.col("s_suppkey") % 10).cast("string"), F.lit(".example/"))
    rows = s.select(url.alias("API_URL"), (F.col("s_nationkey") % 2).alias("IsShopify"), flag.alias("UseUnpagedProductsJson"))
    return scrape_list(rows)


def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"view": "views", "error": "errors", "click": "clicks", "purchase": "purchases"}
    return audit.event_counts(table(spark, sf_dir, "events"), "event_type", kinds)


def audit_status_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.counts_json(table(spark, sf_dir, "events").withColumn("code", F.when(F.col("event_type") == "error", 400 + F.col("user_id") % 12)), "code")


def first_n_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("v", F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit(" "), "source", F.lit("  \n x"))).otherwise(F.lit("  ")))
    return audit.first_distinct(d, F.col("v"), "doc_id", 12)


def store_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "error", "http_error").when(F.col("event_type") == "view", "page_empty").otherwise("page_success")
    return audit.store_outcomes(e.select((F.col("user_id") % 20).alias("store_url"), (F.col("event_id") % 97).alias("page"), kind.alias("event_type")))


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a file stream, the last of each user kept by upserts of micro-batches; the state that this leaves."""
    work = shared_path(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    state = combine.VersionedTable(spark, f"{work}/state")
    order = [F.desc("ts"), F.desc("event_id")]

    def step(rows: DataFrame, epoch: int) -> None:
        old = state.read(schema.simpleString()[7:-1].replace(":", " "))
        state.publish(combine.first_per_key(old.unionByName(rows), ["user_id"], order))

    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    source.writeStream.foreachBatch(step).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return state.read(schema.simpleString()[7:-1].replace(":", " ")).select("user_id", "event_id", "event_type")


def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type", "1 day", "10 minutes")
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


_OP = "CASE event_type WHEN 'purchase' THEN 'DELETE' WHEN 'click' THEN 'upsert' WHEN 'view' THEN 'UPSERT' ELSE upper(event_type) END AS operation"
_LOG = f"log AS (SELECT strftime(ts, '%Y-%m-%d') AS batch_run_id, {_OP}, CAST(user_id AS VARCHAR) AS id, ts AS change_ts, event_id FROM events)"
_WHAT = "CASE WHEN upper(operation) = 'UPSERT' THEN 'upsert' WHEN upper(operation) = 'DELETE' THEN CASE WHEN trim(id) <> '' THEN 'delete' ELSE 'skipped' END ELSE 'unknown' END"
_CANDIDATES = """c AS (SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE 'https://shop' || CAST(s_suppkey % 40 AS VARCHAR) || '.example/' END AS k FROM supplier),
  f AS (SELECT k, min(s_suppkey) AS first FROM c WHERE k IS NOT NULL GROUP BY 1), n AS (SELECT 'https://shop' || CAST(n_nationkey AS VARCHAR) || '.example/' AS k FROM nation)"""
_TEXT = ("id", "product_id", "variant_id", "title", "vendor", "product_link", "store", "store_url", "variant_title", "BodyHtml", "product_type")
_DOC = {c: f"coalesce({c}, '') AS {c}" for c in _TEXT} | {f: f"coalesce({f}, 0) = 1 AS {f}" for f in ("IsDistanceDriver", "IsFairwayDriver", "IsMidrange", "IsPutter")} | {
    "image": "product_link AS image", "variant_image": "'' AS variant_image", "price": "coalesce(price, 0.0) AS price", "weight_g": "coalesce(weight_g, 0) AS weight_g",
    "in_stock": "coalesce(in_stock, false) AS in_stock", "high_price": "coalesce(high_price, 0.0) AS high_price", "low_price": "coalesce(low_price, 0.0) AS low_price",
    "tags": "CASE WHEN tags IS NULL THEN '' ELSE replace(replace(replace(tags, '[\"', ''), '\"]', ''), '\",\"', '|') END AS tags",
}

QUERIES = {f.__name__: f for f in (
    latest_batch, latest_per_key, latest_changes, op_dispatch, index_totals, chunk_batches, search_documents, dim_load_new, dim_load_skipped,
    distinct_store, audit_counts, audit_status_json, first_n_distinct, store_outcomes, stream_latest, window_counts,
)}
SQL = {
    "latest_batch": "SELECT strftime(max(ts), '%Y-%m-%d') AS batch_run_id FROM events",
    "latest_per_key": f"WITH {_LOG} SELECT batch_run_id, id, operation, event_id FROM (SELECT *, row_number() OVER (PARTITION BY batch_run_id, id ORDER BY change_ts DESC, operation DESC, event_id DESC) AS rn FROM log) WHERE rn = 1",
    "latest_changes": f"WITH {_LOG} SELECT id, operation, event_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY change_ts DESC, operation DESC) AS rn FROM log WHERE batch_run_id = (SELECT max(batch_run_id) FROM log)) WHERE rn = 1",
    "op_dispatch": f"WITH {_LOG}, l AS (SELECT operation, CASE WHEN event_id % 7 <> 0 THEN id ELSE ' ' END AS id FROM log) SELECT {_WHAT} AS what, count(*) AS n FROM l GROUP BY 1",
    "index_totals": f"""WITH {_LOG}, l AS (SELECT {_WHAT} AS what FROM log), t AS (SELECT count(*) AS rows_seen, count(*) FILTER (what = 'upsert') AS upserts,
        count(*) FILTER (what = 'delete') AS deletes, count(*) FILTER (what = 'unknown') AS unknown_ops FROM l)
        SELECT *, CAST(ceil(upserts / 200.0) AS BIGINT) AS upsert_batches, CAST(ceil(deletes / 200.0) AS BIGINT) AS delete_batches FROM t""",
    "chunk_batches": f"""WITH {_LOG}, l AS (SELECT operation, event_id, (row_number() OVER (PARTITION BY operation ORDER BY event_id) - 1) // 200 AS batch FROM log)
        SELECT operation, batch, count(*) AS n, min(event_id) AS first FROM l GROUP BY 1, 2""",
    "search_documents": f"""WITH {SOURCES_SQL}
        SELECT {', '.join(_DOC[c] for c in VARIANT)}, lower(title || ' ' || variant_title || ' ' || vendor || CASE WHEN store IS NULL THEN '' ELSE ' ' || store END ||
          CASE WHEN tags IS NULL THEN '' ELSE ' ' || replace(replace(replace(tags, '["', ''), '"]', ''), '","', ' ') END) AS search_text, 1706745600000 AS last_indexed_at FROM keyed""",
    "dim_load_new": f"""WITH {_CANDIDATES} SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'HTTPS://Shop' || CAST(s_suppkey % 40 AS VARCHAR) || '.example/?x=1' ELSE 'shop' || CAST(s_suppkey % 40 AS VARCHAR) || '.example//' END AS "URL",
        s_suppkey FROM c JOIN f ON c.k = f.k AND s_suppkey = first WHERE c.k NOT IN (SELECT k FROM n)""",
    "dim_load_skipped": f"""WITH {_CANDIDATES} SELECT s_suppkey, CASE WHEN c.k IS NULL THEN 'blank' WHEN c.k IN (SELECT k FROM n) THEN 'known' ELSE 'repeated' END AS reason
        FROM c LEFT JOIN f ON c.k = f.k WHERE c.k IS NULL OR c.k IN (SELECT k FROM n) OR s_suppkey <> first""",
    "distinct_store": """SELECT DISTINCT 'https://shop' || CAST(s_suppkey % 10 AS VARCHAR) || '.example/' AS "API_URL", coalesce(CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey % 2 END, 0) AS use_unpaged
        FROM supplier WHERE s_nationkey % 2 = 1""",
    "audit_counts": """SELECT count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'click') AS clicks,
        count(*) FILTER (event_type = 'purchase') AS purchases FROM events""",
    "audit_status_json": """SELECT '{' || string_agg('"' || CAST(c AS VARCHAR) || '":' || CAST(n AS VARCHAR), ',' ORDER BY c) || '}' AS errors
        FROM (SELECT 400 + user_id % 12 AS c, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)""",
    "first_n_distinct": """SELECT '[' || string_agg('"' || v || '"', ',' ORDER BY o) || ']' AS listed FROM (
        SELECT source || ' x' AS v, min(doc_id) AS o FROM documents WHERE doc_id % 5 <> 0 GROUP BY 1 ORDER BY 2 LIMIT 12)""",
    "store_outcomes": """WITH p AS (SELECT user_id % 20 AS s, event_id % 97 AS page, bool_and(event_type = 'error') AS bad, bool_or(event_type NOT IN ('error', 'view')) AS good FROM events GROUP BY 1, 2),
        t AS (SELECT s, count(*) AS pages, count(*) FILTER (good) AS gp, count(*) FILTER (bad) AS bp, bool_or(bad) AS bad FROM p GROUP BY 1)
        SELECT count(*) AS stores_attempted, count(*) FILTER (NOT bad) AS stores_succeeded, count(*) FILTER (bad) AS stores_failed, CAST(sum(pages) AS BIGINT) AS pages_attempted,
        CAST(sum(gp) AS BIGINT) AS pages_succeeded, CAST(sum(bp) AS BIGINT) AS pages_failed FROM t""",
    "stream_latest": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
    "window_counts": "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
