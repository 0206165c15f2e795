"""The steps of a run: raw files to parsed tables, tables to a snapshot and its changes, changes to search documents."""

from __future__ import annotations

import datetime
import json
import logging
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import urls
from shelfwise.operators import audit, cdc, classify, combine, html_shops, products, snapshot, stores
from shelfwise.settings import Settings
from shelfwise.sources import crawls, http, readers, schemas, sinks
from shelfwise.sources.schemas import LOG_TYPES, VARIANT_CHANGES
from shelfwise.streaming.changes import RunTable, Sink, index_batch

log = logging.getLogger(__name__)


def run_id(now: datetime.datetime, command: str = "") -> str:
    """Command, second, and a random part, so that runs that start at once have rows of their own."""
    return f"{command}-{now:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}".lstrip("-")


def audit_table(spark: SparkSession, s: Settings) -> combine.VersionedTable:
    return combine.VersionedTable(spark, f"{s.table_dir}/RunAudit")


class Run:
    """A run's row in RunAudit: STARTED on entry, FAILED with the error if the block raises; done() enters how it ended."""

    def __init__(self, spark: SparkSession, s: Settings, command: str, planned: int, now: datetime.datetime | None = None) -> None:
        self._spark, self._s, self.command, self._planned = spark, s, command, planned
        self._at = now or datetime.datetime.now(datetime.UTC)
        self.id, self._over = run_id(self._at, command), False

    def _enter(self, row: DataFrame) -> None:
        table, at = audit_table(self._spark, self._s), F.lit(self._at).cast("timestamp")
        old = table.read(schemas.RUN_AUDIT)
        table.publish(combine.upsert(old, schemas.conform(audit.run_row(row, old, at, "run_id"), schemas.RUN_AUDIT), ["run_id"]))

    def _row(self, status: str, **more: object) -> DataFrame:
        kinds = {"error_count": "bigint", "error_summary": "string", "pages_saved": "bigint", "output_mode": "string"}
        names = ["run_id string", "command string", "status string", "stores_planned bigint", *(f"{k} {kinds[k]}" for k in more)]
        return self._spark.createDataFrame([(self.id, self.command, status, self._planned, *more.values())], ", ".join(names))

    def __enter__(self) -> Run:
        self._enter(self._row("STARTED"))
        return self

    def __exit__(self, kind: object, error: BaseException | None, trace: object) -> None:
        if error is not None and not self._over:
            self._enter(self._row("FAILED", error_count=1, error_summary=json.dumps([f"{type(error).__name__}: {error}"[:1000]])))

    def done(self, row: DataFrame | None = None, **more: object) -> None:
        """row: one row of counters with its status; without, the run is COMPLETED."""
        self._enter(self._row("COMPLETED", **more) if row is None else row)
        self._over = True


class ScrapeFailed(RuntimeError):
    """A scrape whose pages aren't whole."""


def store_list(spark: SparkSession, s: Settings) -> list[tuple[str, bool]]:
    """Addresses of the shops with a product feed, and whether they have one page only: those of the settings, else those of the
    Stores table, else the known ones."""
    if s.stores():
        return [(u if u.startswith(("http://", "https://")) else f"https://{u}", False) for u in s.stores()]
    table = combine.VersionedTable(spark, f"{s.table_dir}/Stores")
    rows = readers.scrape_list(table.read(schemas.STORES)).where("API_URL is not null")
    rows = rows.groupBy(urls.with_scheme(F.col("API_URL")).alias("url")).agg(F.max("use_unpaged").alias("unpaged")).orderBy("url")
    return [(r["url"], bool(r["unpaged"])) for r in rows.collect()] or [(u, False) for u in urls.STORE_URLS.values()]


def scrape_shop(spark: SparkSession, s: Settings, now: datetime.datetime | None = None, command: str = "scrape-shop") -> str:
    """Reads all stores' feeds into a folder of the run's own and enters the run in RunAudit; returns the run's id.

    Each store is read by a task of its own. If a store's pages aren't whole, the run is FAILED and this raises; the pages of
    the last whole run stay and are what parse_shop() refuses to mix with. Pages of runs before it go once a run is whole.
    """
    store_urls = store_list(spark, s)
    with Run(spark, s, command, len(store_urls), now) as run:
        spark.dataSource.register(http.ShopFeed)
        options = {"stores": ",".join(u for u, _ in store_urls), "unpaged": ",".join(u for u, x in store_urls if x), "fetcher": s.fetcher, "waits": s.fetch_waits}
        path = f"{s.raw_dir}/shop_feed/run={run.id}"
        counters = Observation("events")
        spark.read.format("shop_feed").options(**options).load().observe(counters, *audit.event_counters()).write.parquet(path)
        row = audit.scrape_row(spark.read.parquet(path), counters.get, run.id, run.command, len(store_urls)).persist()
        run.done(row)
        found = row.first()
        row.unpersist()
        if found["status"] == "FAILED":
            raise ScrapeFailed(f"{found['stores_failed']} of {len(store_urls)} stores failed: {found['failed_store_summary']}")
        sinks.keep_only(spark, f"{s.raw_dir}/shop_feed", f"run={run.id}")
    return run.id


def last_scrape(spark: SparkSession, s: Settings, folder: str, commands: tuple[str, ...]) -> str | None:
    """The folder of the newest run of a scrape; None if there was none. A run that isn't whole is refused."""
    runs = audit_table(spark, s).read(schemas.RUN_AUDIT).where(F.col("command").isin(*commands))
    newest = runs.orderBy(F.desc("started_at"), F.desc("run_id")).select("run_id", "status", "failed_store_summary").first()
    if newest is None or not sinks.exists(spark, f"{s.raw_dir}/{folder}"):
        return None
    if newest["status"] != "COMPLETED":
        raise ScrapeFailed(f"run {newest['run_id']} is {newest['status']}: what it lacks would be taken for deleted")
    return f"{s.raw_dir}/{folder}/run={newest['run_id']}"


SHOP_COMMANDS = ("scrape-shop", "run-all", "run-all-ingestion")


def parse_shop(spark: SparkSession, s: Settings) -> None:
    """Shops' feeds to ProductInfo and Products, one read of the raw pages each, all stores in one job.

    Pages are those of the last scrape, which must be whole, or raw files where nothing was scraped.
    """
    scraped = last_scrape(spark, s, "shop_feed", SHOP_COMMANDS)
    if scraped:
        pages = spark.read.parquet(scraped).where("event_type = 'page_success'")
        page = F.from_json("products", f"array<struct<{schemas.SHOP_PAGE}>>".replace("\n", " "))
        feed, store = pages.select("store_url", F.inline(page)), F.col("store_url")
    else:
        feed = readers.read_json(spark, f"{s.raw_dir}/shop", schemas.SHOP_PAGE.replace("\n", " "))
        store = urls.store_of_reference(urls.reference_of_file(F.col("source_file")))
    sinks.write_parquet(products.product_info(feed, urls.host(store), store), f"{s.parsed_dir}/ProductInfo")
    sinks.write_parquet(products.variants(feed), f"{s.parsed_dir}/Products")


def scrape_records(spark: SparkSession, s: Settings, now: datetime.datetime | None = None) -> str:
    """Reads the record interface, a task a range of offsets, into a folder of the run's own; returns the run's id.

    The run is FAILED, and this raises, where a slice can't be had or the records are fewer than the interface says.
    """
    with Run(spark, s, "scrape-records", 1, now) as run:
        spark.dataSource.register(http.RecordPages)
        options = {"url": s.record_url, "poster": s.poster, "size": str(s.record_page_size), "least": str(s.record_least_page_size), "wait": str(s.record_wait)}
        path, seen = f"{s.raw_dir}/record_feed/run={run.id}", Observation("records")
        pages = spark.read.format("record_pages").options(**options).load()
        counts = (F.count(F.lit(1)).alias("pages"), F.sum("n_records").alias("records"), F.max("total").alias("total"))
        pages.observe(seen, *counts).write.parquet(path)
        got = seen.get
        if (got["records"] or 0) < (got["total"] or 0):
            raise ScrapeFailed(f"{got['records'] or 0} of {got['total']} records")
        run.done(pages_saved=got["pages"])
        sinks.keep_only(spark, f"{s.raw_dir}/record_feed", f"run={run.id}")
    return run.id


def scrape_pages(spark: SparkSession, s: Settings, kind: str, now: datetime.datetime | None = None) -> str:
    """Crawls the shop of a kind (table, listed or option) into a folder of the run's own; returns the run's id.

    A crawl that was broken off is gone on with: its folder is the newest one that no run has completed.
    """
    command = f"scrape-{kind}-shop"
    with Run(spark, s, command, 1, now) as run:
        top = f"{s.raw_dir}/{kind}_crawl"
        path = f"{top}/open"
        if kind == "option":
            most_pages, most = s.option_max_pages or None, s.option_max_products or None
            crawl = crawls.crawl_links(spark, s.site(crawls.OPTION_SITE), path, s.fetcher, s.option_wait, most_pages, most)
            pages = crawl.pages()
        else:
            site = s.site({"table": crawls.TABLE_SITE, "listed": crawls.LISTED_SITE}[kind])
            pages = crawls.crawl_sitemap(spark, site, path, s.fetcher, s.table_wait, s.table_max_products or None).pages()
        found = crawls.summary(pages).first()
        sinks.move(spark, path, f"{top}/run={run.id}")
        run.done(pages_saved=found["product_count"], error_count=found["skipped_count"])
        sinks.keep_only(spark, top, f"run={run.id}")
    return run.id


def parse_records(spark: SparkSession, s: Settings) -> None:
    """Records to Stock: those of the last scrape, which must be whole, or raw files where nothing was scraped."""
    scraped = last_scrape(spark, s, "record_feed", ("scrape-records",))
    if scraped:
        pages = spark.read.parquet(scraped).select(F.from_json("body", schemas.struct(schemas.STOCK_PAGE)).alias("p")).select("p.*")
    else:
        pages = readers.read_json(spark, f"{s.raw_dir}/records", schemas.STOCK_PAGE)
    sinks.write_parquet(products.stock(pages, s.record_base, F.current_timestamp()), f"{s.parsed_dir}/Stock")


def parse_pages(spark: SparkSession, s: Settings, kind: str) -> None:
    """Crawled pages of the two kinds of shops: `table` or `option`; those of the last crawl, or raw files where there was none."""
    scraped = last_scrape(spark, s, f"{kind}_crawl", (f"scrape-{kind}-shop",))
    if scraped:
        crawl = crawls.products_of(crawls.Crawl(spark, scraped).pages())
    else:
        crawl = readers.read_json(spark, f"{s.raw_dir}/{kind}", schemas.CRAWL.replace("\n", " ")).select(F.inline("products"))
    rows = {"table": html_shops.table_shop, "option": html_shops.option_shop}[kind](crawl, F.current_timestamp())
    sinks.write_parquet(rows, f"{s.parsed_dir}/{kind.title()}Shop")


def load(spark: SparkSession, s: Settings, name: str) -> None:
    """A parsed table in place of the one of that name; its files then go to the archive, if there is one."""
    parsed = spark.read.parquet(f"{s.parsed_dir}/{name}")
    files = parsed.inputFiles() if s.archive_dir else []
    sinks.write_parquet(parsed, f"{s.table_dir}/{name}")
    if files:
        sinks.archive(spark, files, s.archive_dir)


def load_stores(spark: SparkSession, s: Settings, csv: str) -> dict[str, int]:
    """New stores of a list are added to the known ones; returns how many were new and why the others weren't.

    The new ones are counted while they are written.
    """
    rows = readers.read_stores(spark, csv).withColumn("__line", F.monotonically_increasing_id())
    table = combine.VersionedTable(spark, f"{s.table_dir}/Stores")
    known = table.read(rows.drop("__line").schema)
    skipped = {r["reason"]: r["count"] for r in stores.skipped_stores(rows, known, "__line").groupBy("reason").count().collect()}
    seen = Observation("stores")
    new = stores.new_stores(rows, known, "__line").drop("__line").observe(seen, F.count(F.lit(1)).alias("new"))
    table.publish(known.unionByName(new))
    return {"new": seen.get["new"], **skipped}


def views(spark: SparkSession, s: Settings) -> tuple[DataFrame, DataFrame]:
    """The stock source's and the shops' variants from the loaded tables."""
    info, items, stock = (spark.read.parquet(f"{s.table_dir}/{n}") for n in ("ProductInfo", "Products", "Stock"))
    kinds = classify.derived_product_type(info, stock)
    return snapshot.stock_variants(stock, kinds, "infinitediscs", s.record_base), snapshot.shop_variants(items, info, kinds)


def process(spark: SparkSession, s: Settings, now: datetime.datetime | None = None) -> str:
    """Classification, snapshot, changes and state; returns the batch id."""
    stock, shops = views(spark, s)
    snapshot.variant_snapshot(stock, shops).createOrReplaceTempView("v_VariantSnapshot")
    rows = snapshot.hashed(snapshot.variant_snapshot(stock, shops, LOG_TYPES))
    now = now or datetime.datetime.now(datetime.UTC)
    return cdc.run(spark, rows, f"{s.table_dir}/VariantState", f"{s.table_dir}/VariantChanges", now, s.state_buckets)


def index(spark: SparkSession, s: Settings, sink: Sink | None = None) -> str | None:
    """The newest batch, or the one that settings name, to the search service (or to files without one)."""
    changes = spark.read.schema(VARIANT_CHANGES).parquet(f"{s.table_dir}/VariantChanges")
    if sink is None:
        sink = sinks.http_sink(s.search_host, s.search_collection, s.search_key, s.index_batch_size) if s.search_host else sinks.file_sink(f"{s.table_dir}/search")
    return index_batch(changes, RunTable(spark, f"{s.table_dir}/IndexRuns"), sink, s.batch_run_id or None, s.index_batch_size, bool(s.batch_run_id))


def steps(spark: SparkSession, s: Settings) -> dict[str, Callable[[], object]]:
    return {
        "scrape-shop": lambda: scrape_shop(spark, s),
        "scrape-records": lambda: scrape_records(spark, s),
        "scrape-table-shop": lambda: scrape_pages(spark, s, "table"),
        "scrape-listed-shop": lambda: scrape_pages(spark, s, "listed"),
        "scrape-option-shop": lambda: scrape_pages(spark, s, "option"),
        "parse-shop": lambda: parse_shop(spark, s),
        "parse-records": lambda: parse_records(spark, s),
        "parse-table-shop": lambda: parse_pages(spark, s, "table"),
        "parse-option-shop": lambda: parse_pages(spark, s, "option"),
        "load-shop": lambda: [load(spark, s, n) for n in ("ProductInfo", "Products")],
        "load-records": lambda: load(spark, s, "Stock"),
        "load-table-shop": lambda: load(spark, s, "TableShop"),
        "load-option-shop": lambda: load(spark, s, "OptionShop"),
        "process": lambda: process(spark, s),
        "index": lambda: index(spark, s),
    }


ALL = ("scrape-shop", "parse-shop", "load-shop", "process", "index")
ALL_INGESTION = ("scrape-shop", "scrape-records", "parse-shop", "parse-records", "load-shop", "load-records", "process", "index")


def run_all(spark: SparkSession, s: Settings, names: tuple[str, ...] = ALL) -> dict[str, float]:
    """Runs the steps in order, the first failure ends the run; returns seconds by step, and their sum as total."""
    known, took = steps(spark, s), {}
    for name in names:
        began = time.time()
        known[name]()
        took[name] = time.time() - began
        log.info("%s took %.1f s", name, took[name])
    return {**took, "total": sum(took.values())}
