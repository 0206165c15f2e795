"""Sources, sinks, streams and the whole run."""

import dataclasses
import datetime
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from shelfwise.operators.combine import VersionedTable
from shelfwise.plans import pipeline
from shelfwise.settings import Settings, load_env
from shelfwise.sources import http, readers, schemas, sinks
from shelfwise.streaming.changes import RunTable, index_batch, stream_changes

DAY = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)


def raw(tmp_path, price="10"):
    shop, records = tmp_path / "raw/shop", tmp_path / "raw/records"
    shop.mkdir(parents=True, exist_ok=True)
    records.mkdir(parents=True, exist_ok=True)
    product = {"id": 1, "title": "P", "handle": "p", "body_html": "a putter", "variants": [{"id": 11, "title": "v", "price": price, "available": True}, {"id": 12, "price": "12"}]}
    (shop / "my__shop_1_20240101.json").write_text(json.dumps([product]))
    (records / "r.json").write_text(json.dumps({"recordsTotal": 1, "data": [{"Id": "5", "ModelName": "M", "ModelLink": "/m", "StockPrice": "9.5", "AvailableStock": "2", "ModelDescription": "<b>Midrange</b>"}]}))
    return Settings(raw_dir=f"file://{tmp_path}/raw", parsed_dir=f"file://{tmp_path}/parsed", table_dir=f"file://{tmp_path}/tables")


def test_run_all(spark, tmp_path):
    s = raw(tmp_path)
    assert set(pipeline.run_all(spark, s, ("parse-shop", "parse-records", "load-shop", "load-records"))) == {"parse-shop", "parse-records", "load-shop", "load-records", "total"}
    pipeline.process(spark, s, DAY)
    assert pipeline.index(spark, s) == "2024-01-01T00:00:00Z"
    assert pipeline.index(spark, s) is None  # done
    docs = spark.read.json(f"{s.table_dir}/search/upserts")
    assert {r["id"] for r in docs.collect()} >= {"shopify:my.shop:11", "shopify:my.shop:12"} and docs.count() == 3
    raw(tmp_path, price="11")
    pipeline.run_all(spark, s, ("parse-shop", "load-shop"))
    pipeline.process(spark, s, DAY + datetime.timedelta(days=1))
    log = spark.read.schema(schemas.VARIANT_CHANGES).parquet(f"{s.table_dir}/VariantChanges").where("batch_run_id like '2024-01-02%'")
    assert rows(log, "operation", "id", "price") == [("UPSERT", "shopify:my.shop:11", "11.00"), ("UPSERT", "shopify:my.shop:12", "12.00")]  # low_price moved


def test_stream_takes_all_batches(spark, tmp_path):
    s = raw(tmp_path)
    pipeline.run_all(spark, s, ("parse-shop", "parse-records", "load-shop", "load-records"))
    pipeline.process(spark, s, DAY)
    runs, seen = RunTable(spark, f"file://{tmp_path}/runs"), []
    stream_changes(spark, f"{s.table_dir}/VariantChanges", runs, lambda put, gone: seen.append(put.count()) or 0, f"file://{tmp_path}/check").awaitTermination()
    assert sum(seen) == 3
    assert rows(runs.read(), "status", "upserts", "deletes") == [("COMPLETED", 3, 0)]
    stream_changes(spark, f"{s.table_dir}/VariantChanges", runs, lambda put, gone: seen.append(put.count()) or 0, f"file://{tmp_path}/check").awaitTermination()
    assert sum(seen) == 3


def test_failed_batches_fail_the_run(spark, tmp_path):
    log = schemas.conform(spark.createDataFrame([("b", "UPSERT", "x")], "batch_run_id string, operation string, id string"), schemas.VARIANT_CHANGES)
    runs = RunTable(spark, f"file://{tmp_path}/runs")
    index_batch(log, runs, lambda put, gone: 1)
    assert rows(runs.read(), "batch_run_id", "status", "error_message") == [("b", "FAILED", "1 batches failed")]
    index_batch(log, runs, lambda put, gone: 0)
    assert rows(runs.read(), "batch_run_id", "status") == [("b", "COMPLETED")]
    with pytest.raises(ZeroDivisionError):
        index_batch(log, runs, lambda put, gone: 1 // 0, force=True)
    assert rows(runs.read(), "status") == [("FAILED",)]


def calls(method, url, body, headers):
    return 404 if method == "DELETE" and url.endswith("/gone") else 500 if b"bad" in body or url.endswith("a%2Fb") else 200


def test_http_sink(spark):
    put, gone = spark.createDataFrame([("1", "good"), ("2", "bad")], "id string, t string").coalesce(1), spark.createDataFrame([("gone",), ("x",)], "id string")
    sink = sinks.http_sink("http://s", "c", "k", batch_size=1, pause=0.0, sender=calls)
    assert sink(put, gone) == 1
    assert sink(put.where("id = '1'"), spark.createDataFrame([("a/b",)], "id string")) == 1
    assert sink(put.limit(0), gone.limit(0)) == 0


def test_readers(spark, tmp_path):
    (tmp_path / "stores.csv").write_bytes("﻿URL,API_URL,IsShopify,UseUnpagedProductsJson,Note\n A.example ,,1,,x\nb.example,c.example,,0, y\n".encode())
    got = readers.read_stores(spark, f"file://{tmp_path}/stores.csv")
    assert rows(got) == [("https://a.example/", None, 1, None, "x"), ("https://b.example/", "https://c.example/", None, 0, "y")]
    (tmp_path / "bad.csv").write_text("URL,API_URL,IsShopify,UseUnpagedProductsJson\na,b,yes,\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_stores(spark, f"file://{tmp_path}/bad.csv").collect()
    assert readers.json_text(spark, '[{"id": 1}, {"id": 2}]', "id long").count() == 2
    (tmp_path / "j/k").mkdir(parents=True)
    (tmp_path / "j/a.json").write_text('{"id": 1}')
    (tmp_path / "j/k/b.JSON").write_text('{"id": 2}')
    assert rows(readers.read_json(spark, f"file://{tmp_path}/j", "id long"), "id") == [(1,)]
    assert rows(readers.read_json(spark, f"file://{tmp_path}/j", "id long", recursive=True), "id") == [(1,), (2,)]
    spark.range(3).write.parquet(f"file://{tmp_path}/p")
    assert readers.read_parquet(spark, f"file://{tmp_path}/p", "id long, x string").columns == ["id", "x"]


def test_load_stores(spark, tmp_path):
    (tmp_path / "s.csv").write_text("URL,API_URL,IsShopify,UseUnpagedProductsJson\na.example,,1,\nA.example/,,1,\n,,,\n")
    s = Settings(table_dir=f"file://{tmp_path}/t")
    assert pipeline.load_stores(spark, s, f"file://{tmp_path}/s.csv") == {"new": 1, "repeated": 1, "blank": 1}
    assert pipeline.load_stores(spark, s, f"file://{tmp_path}/s.csv") == {"new": 0, "known": 2, "blank": 1}


def feed(url):
    if "bad" in url:
        return 503, "busy  now", {"Server": "x", "Date": "y"}
    if "block" in url:
        return 200, "<html>blocked</html>"
    if "late" in url and url not in SEEN:
        SEEN.add(url)
        raise TimeoutError("late")
    page = int(url.rpartition("page=")[2]) if "page=" in url else 1
    return 200, json.dumps({"products": [{"id": page, "variants": [{"id": page}]}] if page < 3 else None})


SEEN = set()


def test_shop_feed_source(spark):
    spark.dataSource.register(http.ShopFeed)
    names = "https://a/,https://bad/,https://block/,https://late/,https://one/"
    df = spark.read.format("shop_feed").options(stores=names, unpaged="https://one/", waits="0,0", fetcher="test_flow:feed").load().persist()
    got = rows(df.groupBy("store_url", "event_type").count())
    late = [("https://late/", "page_empty", 1), ("https://late/", "page_success", 2), ("https://late/", "request_exception", 3), ("https://late/", "retry_success", 2)]
    assert got == [
        ("https://a/", "page_empty", 1), ("https://a/", "page_success", 2), ("https://bad/", "http_error", 3), ("https://block/", "request_exception", 3), *late,
        ("https://one/", "page_success", 1),
    ]
    bad = df.where("store_url = 'https://bad/'").first()
    assert (bad.headers, bad.body, bad.status_code, bad.error_type) == ({"server": "x"}, "busy now", 503, None)
    block = df.where("store_url = 'https://block/'").first()
    assert (block.error_type, block.status_code, block.body) == ("JSONDecodeError", 200, "<html>blocked</html>")
    assert df.where("store_url = 'https://one/'").first().use_unpaged_products_json
    df.unpersist()


def scraped(tmp_path, **more):
    return Settings(raw_dir=f"file://{tmp_path}/raw", parsed_dir=f"file://{tmp_path}/p", table_dir=f"file://{tmp_path}/t", fetcher="test_flow:feed", fetch_waits="0,0", **more)


def audit_rows(spark, s):
    return VersionedTable(spark, f"{s.table_dir}/RunAudit").read(schemas.RUN_AUDIT).orderBy("started_at").collect()


def test_scrape_shop_enters_its_run(spark, tmp_path):
    s = scraped(tmp_path, archive_dir=f"file://{tmp_path}/a", store_urls="https://a.example/")
    first = pipeline.scrape_shop(spark, s, DAY)
    pipeline.run_all(spark, s, ("parse-shop", "load-shop"))
    assert rows(spark.read.parquet(f"{s.table_dir}/ProductInfo"), "MainProductId", "Store") == [(1, "a.example"), (2, "a.example")]
    assert list((tmp_path / "a").iterdir()) and not list((tmp_path / "p/ProductInfo").glob("*.parquet"))
    bad = dataclasses.replace(s, store_urls="https://a.example/,bad.example/")
    with pytest.raises(pipeline.ScrapeFailed, match="1 of 2 stores"):
        pipeline.scrape_shop(spark, bad, DAY + datetime.timedelta(days=1))
    with pytest.raises(pipeline.ScrapeFailed, match="FAILED"):  # what bad.example has would be taken for deleted
        pipeline.parse_shop(spark, s)
    run = audit_rows(spark, s)
    assert [(r.status, r.stores_planned, r.stores_succeeded, r.stores_failed, r.pages_saved) for r in run] == [("COMPLETED", 1, 1, 0, 2), ("FAILED", 2, 1, 1, 2)]
    assert (run[1].http_error_events, run[1].page1_failures, run[1].http_status_summary, run[1].failed_store_summary) == (3, 3, '{"503":3}', '["https://bad.example/"]')
    assert run[1].error_summary == '["status 503"]' and run[1].failed_request_summary.count("attempt=") == 3 and run[0].run_id == first
    again = pipeline.scrape_shop(spark, s, DAY + datetime.timedelta(days=2))
    assert [p.name for p in (tmp_path / "raw/shop_feed").iterdir() if p.name.startswith("run=")] == [f"run={again}"]  # pages of other runs go
    pipeline.parse_shop(spark, s)
    assert pipeline.run_id(DAY, "x") != pipeline.run_id(DAY, "x")


def test_scrape_that_breaks_is_failed(spark, tmp_path):
    s = scraped(tmp_path, store_urls="https://a.example/")
    with pytest.raises(Exception, match="nothing_there"):
        pipeline.scrape_shop(spark, dataclasses.replace(s, fetcher="test_flow:nothing_there"), DAY)
    run = audit_rows(spark, s)
    assert [(r.status, r.error_count) for r in run] == [("FAILED", 1)] and "nothing_there" in run[0].error_summary and run[0].completed_at


def test_stores_from_the_table(spark, tmp_path):
    (tmp_path / "s.csv").write_text("URL,API_URL,IsShopify,UseUnpagedProductsJson\na.example,b.example,1,1\nc.example,c.example,0,\nd.example,d.example,1,\n")
    s = scraped(tmp_path)
    assert len(pipeline.store_list(spark, s)) == 13  # those that are known
    pipeline.load_stores(spark, s, f"file://{tmp_path}/s.csv")
    assert pipeline.store_list(spark, s) == [("https://b.example/", True), ("https://d.example/", False)]
    run = pipeline.scrape_shop(spark, s, DAY)
    got = rows(spark.read.parquet(f"{s.raw_dir}/shop_feed/run={run}").groupBy("store_url", "event_type").count())
    assert got == [("https://b.example/", "page_success", 1), ("https://d.example/", "page_empty", 1), ("https://d.example/", "page_success", 2)]


def test_run_all_begins_with_scraping(spark, tmp_path):
    assert pipeline.ALL[0] == "scrape-shop" and pipeline.ALL_INGESTION[:2] == ("scrape-shop", "scrape-records")
    s = scraped(tmp_path, store_urls="https://a.example/", poster="test_flow:records", record_page_size=4, record_least_page_size=2, record_wait=0.0)
    took = pipeline.run_all(spark, s, pipeline.ALL_INGESTION)
    assert set(took) == {*pipeline.ALL_INGESTION, "total"}
    log = spark.read.schema(schemas.VARIANT_CHANGES).parquet(f"{s.table_dir}/VariantChanges")
    assert log.where("operation = 'UPSERT'").count() == 2 + 11  # feed and records
    assert rows(spark.read.parquet(f"{s.table_dir}/Stock"), "Id") == [(i,) for i in sorted(range(11), key=str)]


def records(url, payload):
    """Eleven records; slices of more than three fail, and a slice gives two at most."""
    if payload["Length"] > 3:
        return 500, "too many"
    data = [{"Id": str(i), "ModelName": "M", "StockPrice": "1", "ModelLink": f"/{i}"} for i in range(11)][payload["Start"] : payload["Start"] + min(payload["Length"], 2)]
    return 200, json.dumps({"recordsTotal": 11, "data": data})


def broken_records(url, payload):
    return (200, json.dumps({"recordsTotal": 9, "data": [{"Id": "1"}] if payload["Start"] < 4 else []})) if payload["Start"] != 2 else (404, "no")


def test_record_source(spark, tmp_path):
    spark.dataSource.register(http.RecordPages)
    df = spark.read.format("record_pages").options(poster="test_flow:records", size="4", least="2", wait="0").load()
    assert rows(df, "start", "n_records") == sorted([(0, 2), (2, 2), (4, 2), (6, 2), (8, 2), (10, 1)], key=str) and df.rdd.getNumPartitions() == 3
    asked = []
    client = http.RecordClient(lambda url, p: asked.append((p["Start"], p["Length"])) or records(url, p), "u", 8, 2, tries=2, wait=0.0)
    assert [s[:2] for s in client.slices(0, 5, 1)] == [(0, 2), (2, 2), (4, 1)]
    assert asked == [(0, 5), (0, 5), (0, 2), (2, 2), (4, 1)]
    s = scraped(tmp_path, poster="test_flow:broken_records", record_page_size=2, record_least_page_size=1, record_wait=0.0)
    with pytest.raises(Exception, match="no records from 2 on: status 404"):
        pipeline.scrape_records(spark, s, DAY)
    with pytest.raises(pipeline.ScrapeFailed, match="FAILED"):
        (tmp_path / "raw/record_feed").mkdir(parents=True, exist_ok=True)
        pipeline.parse_records(spark, s)
    request = http.record_request(5, 2, 3)
    assert (request["Start"], request["Length"], request["Draw"]) == (5, 2, 3) and json.loads(request["Filter"])["ResultType"] == "I"


def test_stream_fails_with_its_batches(spark, tmp_path):
    log = [("b", DAY, "UPSERT", "1", DAY)]
    df = schemas.conform(spark.createDataFrame(log, "batch_run_id string, batch_run_ts timestamp, operation string, id string, change_ts timestamp"), schemas.VARIANT_CHANGES)
    df.write.parquet(f"file://{tmp_path}/log")
    sent = []

    def start(failed):
        sink = lambda put, gone: sent.append(put.count()) or failed
        return stream_changes(spark, f"file://{tmp_path}/log", RunTable(spark, f"file://{tmp_path}/runs"), sink, f"file://{tmp_path}/c")

    with pytest.raises(Exception, match="failed"):
        start(1).awaitTermination()
    start(0).awaitTermination()
    assert len(sent) == 2  # what failed is sent again


def test_settings(monkeypatch, tmp_path):
    (tmp_path / ".env").write_text("# c\nSTORE_URLS='a, b'\nINDEX_BATCH_SIZE=5\n")
    monkeypatch.delenv("STORE_URLS", raising=False)
    monkeypatch.setenv("INDEX_BATCH_SIZE", "7")
    load_env(str(tmp_path / ".env"))
    s = Settings.from_env()
    assert s.stores() == ["a", "b"] and s.index_batch_size == 7
    monkeypatch.delenv("STORE_URLS")


def test_versions_need_their_marker(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    t.publish(spark.range(1).select(F.col("id").alias("a")))
    (tmp_path / "t/v2").mkdir()
    assert t.read("a long").count() == 1


def test_archive(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/f.parquet").write_text("1")
    assert sinks.archive(spark, [f"file://{tmp_path}/x/f.parquet"], f"file://{tmp_path}/done") == 1
    assert len(list((tmp_path / "done").glob("*f.parquet"))) == 1
