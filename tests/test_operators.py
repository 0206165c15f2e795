import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from shelfwise.operators import audit, cdc, combine, documents, html_shops, products, snapshot, stores
from shelfwise.sources import schemas
from shelfwise.sources.schemas import LOG_TYPES, VARIANT, VARIANT_STATE



def now():
    return F.lit("2024-01-01").cast("timestamp")


def variants(spark, given):
    """Hashed variants from (id, title)."""
    df = spark.createDataFrame([(i, t) for i, t in given], "id string, title string")
    return snapshot.hashed(schemas.conform(df, ", ".join(f"{c} {t}" for c, t in LOG_TYPES.items())))


def test_cdc_replay_and_idempotence(spark):
    old = variants(spark, [("a", "1"), ("b", "2"), ("c", None), (" ", "x")])
    new = variants(spark, [("a", "1"), ("b", "3"), ("c", ""), ("d", "4"), ("d", "5")])
    assert [r[0] for r in rows(cdc.upserts(new, old), "id")] == ["b", "c", "d"]
    assert rows(cdc.deletes(new, old)) == []
    assert rows(cdc.deletes(old, new)) == [("d",)]
    log = cdc.change_log(new, old, F.lit("b1"), now(), now())
    replayed = combine.upsert(old, log.where("operation = 'UPSERT'").select(*old.columns), ["id"]).where("trim(id) <> ''")
    replayed = replayed.join(log.where("operation = 'DELETE'").select("id"), "id", "left_anti")
    assert rows(replayed, "id", "row_hash") == rows(new, "id", "row_hash")
    assert cdc.change_log(new, new, F.lit("b2"), now(), now()).isEmpty()


def test_null_old_hash_is_no_change(spark):
    new = variants(spark, [("a", "1")])
    old = new.withColumn("row_hash", F.lit(None).cast("string"))
    assert cdc.upserts(new, old).isEmpty()
    assert cdc.upserts(new, old, null_safe=True).count() == 1


def test_run_publishes_log_then_state(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)
    state, log = f"file://{tmp_path}/state", f"file://{tmp_path}/log"
    cdc.run(spark, variants(spark, [("a", "1"), ("b", "2")]), state, log, day)
    cdc.run(spark, variants(spark, [("b", "3")]), state, log, day + datetime.timedelta(seconds=1))
    got = spark.read.parquet(log)
    assert rows(got, "batch_run_id", "operation", "id") == [
        ("2024-01-01T00:00:00Z", "UPSERT", "a"), ("2024-01-01T00:00:00Z", "UPSERT", "b"),
        ("2024-01-01T00:00:01Z", "DELETE", "a"), ("2024-01-01T00:00:01Z", "UPSERT", "b"),
    ]
    assert rows(combine.BucketedTable(spark, state, "id", 64).read(VARIANT_STATE), "id", "title") == [("b", "3")]
    with pytest.raises(Exception, match="already exists"):
        cdc.run(spark, variants(spark, []), state, log, day)


def test_union_promoted(spark):
    a, b = spark.sql("select 1L k, null n"), spark.sql("select 2L k, 'x' n, 3 m")
    assert rows(combine.union_promoted(a, b)) == [(1, None, None), (2, "x", 3)]
    with pytest.raises(TypeError, match="column k"):
        combine.union_promoted(a, spark.sql("select 1.0d k"))
    assert combine.with_columns_of(a, {"k": "string", "z": "int"}).columns == ["k", "n", "z"]


def test_stores(spark):
    known = spark.createDataFrame([("https://a.example/",), (None,)], "URL string")
    given = spark.createDataFrame([(0, "A.example"), (1, "b.example/"), (2, "https://b.example"), (3, " "), (4, None)], "line long, URL string")
    assert rows(stores.new_stores(given, known, "line"), "line") == [(1,)]
    assert rows(stores.skipped_stores(given, known, "line"), "line", "reason") == [(0, "known"), (2, "repeated"), (3, "blank"), (4, "blank")]


def test_latest_change_prefers_upsert_at_one_time(spark):
    log = spark.createDataFrame([("b", 1, "DELETE", "x"), ("b", 1, "UPSERT", "x"), ("b", 2, "rename", "y"), ("b", 1, "DELETE", " ")], "batch_run_id string, change_ts int, operation string, id string")
    got = documents.dispatched(documents.latest_changes(log, "b"))
    assert rows(got, "id", "operation", "what") == [(" ", "DELETE", "skipped"), ("x", "UPSERT", "upsert"), ("y", "rename", "unknown")]
    assert tuple(documents.totals(got).first()) == (3, 1, 0, 1, 1, 0)
    assert documents.latest_batch(log.limit(0).withColumn("batch_run_ts", now())).count() == 0


def test_documents_have_no_nulls(spark):
    empty = spark.createDataFrame([{"id": "1", "tags": "a, b", "image": "ftp://x", "weight_g": "x", "in_stock": "yes"}], ", ".join(f"{c} string" for c in VARIANT))
    doc = documents.search_documents(empty, F.lit(5)).first().asDict()
    assert None not in doc.values()
    assert (doc["tags"], doc["image"], doc["weight_g"], doc["in_stock"], doc["search_text"]) == (["a", "b"], "", 0, True, "a b")


def test_feed(spark):
    text = '[{"id":1,"handle":"h","body_html":"<p>x&amp;y</p>","tags":["a"],"variants":[{"id":2,"price":"3","featured_image":null},{"id":3,"featured_image":{"src":"s"}}]},{"id":4,"variants":[]},{"id":5}]'
    feed = spark.range(1).select(F.explode(F.from_json(F.lit(text), f"array<struct<{schemas.SHOP_PAGE}>>".replace("\n", " "))).alias("p")).select("p.*")
    assert rows(products.variants(feed), "MainProductId", "VariantId", "VarFeaturedImage") == [(1, 2, None), (1, 3, "s")]
    info = products.product_info(feed, F.lit("s"), F.lit("https://s/"))
    assert rows(info, "MainProductId", "ProductLink", "BodyHtml", "Tags") == [(1, "https://s/products/h", "x&y", '["a"]'), (4, None, "", "[]"), (5, None, "", "[]")]


def test_table_shop_fallbacks(spark):
    pages = spark.createDataFrame([
        ("u1", '<meta name="og:image" content="i"><meta property="product:price:amount" content="5"><p>Currently Sold Out!</p>x mlw_pid%3D77'),
        ("u2", "<p>only</p>"), (None, "x"), ("u3", None), ("", "x"),
    ], "url string, html string")
    got = html_shops.table_shop(pages, now())
    assert rows(got, "ProductUrl", "ProductId", "StockPrice", "AvailableStock", "IsOutOfStock", "StockText", "ImageUrl", "Description") == [
        ("u1", 77, 5.0, 0, True, "Currently Sold Out!", "i", None), ("u2", None, None, None, None, None, None, "only"),
    ]


def test_flight_numbers_from_table(spark):
    html = '<div class="woocommerce-product-gallery"><table class="round-table"><tbody><tr><td>S<br>9</td><td>G<br>5</td><td>T<br>-1.5</td></tr></tbody></table></div>'
    df = spark.createDataFrame([(html,)], "html string").select(html_shops.flight_numbers(F.col("html")).alias("f")).select("f.*")
    assert tuple(df.first()) == (9.0, 5.0, -1.5, None)


def test_option_shop_without_options(spark):
    pages = spark.createDataFrame([("https://o.example/x", "<title>T &amp; t</title>")], "url string, html string")
    got = html_shops.option_shop(pages, now())
    assert rows(got, "ProductName", "VariantLabel", "ManufacturerSlug", "ProductSlug", "IsOutOfStock") == [("T & t", None, None, "x", None)]


def test_audit(spark):
    events = spark.createDataFrame([("http_error", 503), ("http_error", 404), ("http_error", 503), ("page_empty", None)], "event_type string, status_code long")
    assert tuple(audit.event_counts(events).first()) == (3, 0, 0, 1)
    assert audit.counts_json(events, "status_code").first()[0] == '{"404":1,"503":2}'
