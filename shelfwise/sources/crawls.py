"""Crawls of shops as tables that are written level by level, or round by round.

What is to be fetched is a table of addresses; fetching is one pass over it, a task a host, which waits between requests to
that host. Locations of sitemaps and links of pages are native expressions over what was fetched. Every level and every round
is a folder that counts once it is whole, so a crawl that was broken off goes on after the last whole one, and nothing of a
site passes through the driver but the lengths of its queues.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.functions import text, urls
from shelfwise.operators.html_shops import is_product_page, page_links
from shelfwise.sources import http
from shelfwise.sources.sinks import exists, remove

PAGE = "url string, kind string, place bigint, status_code int, html string, error string, error_type string, headers map<string,string>, fetched_at timestamp"


@dataclass(frozen=True)
class SitemapSite:
    """A shop whose sitemap lists its products; with `index`, a sitemap of sitemaps, of which those that hold `index` count."""

    name: str
    sitemap: str
    product: str
    least_wait: float
    index: str = ""
    escaped: bool = False


@dataclass(frozen=True)
class LinkedSite:
    """A shop whose section is crawled by its links."""

    name: str
    start: str
    section: str
    product_links: str


# Sitemaps, sections, links and least waits of the crawled shops.
TABLE_SITE = SitemapSite("table", "https://otbdiscs.com/product-sitemap.xml", "/product/", 5.0)
LISTED_SITE = SitemapSite("listed", "https://discnation.com/xmlsitemap.php", "", 10.0, index="xmlsitemap.php?type=products", escaped=True)
OPTION_SITE = LinkedSite(
    "option", "https://www.sunkingdiscs.com/all-flying-discs", "/all-flying-discs/",
    r'(?i)<div class="product-photo">\s*<a\s+href="([^"]+)"\s+class="product-thumbnail">',
)


def fetched(addresses: DataFrame, fetcher: str, wait: float, wait_after_errors: bool = True) -> DataFrame:
    """PAGE of every address (url, kind, place): a host's are asked for one after another, in order of place.

    A failed request is a row with its error; statuses from 400 on are failures. wait: seconds between requests to a host.
    """

    def get_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, last = http.named(fetcher), None
        for batch in batches:
            for url, kind, place, host in zip(batch["url"], batch["kind"], batch["place"], batch["host"], strict=True):
                if host == last:
                    time.sleep(wait)
                last, status, body, error, known = host, None, None, None, None
                try:
                    answer = http.Answer(*get(url))
                    status, known = answer.status, answer.known()
                    if status >= 400:
                        error = ("HTTPError", f"status {status}: {answer.snippet()}".rstrip(": "))
                    else:
                        body = answer.text
                except (OSError, ValueError) as e:
                    error = (type(e).__name__, str(e))
                if error and not wait_after_errors:
                    last = None
                row = (url, kind, place, status, body, error and error[1], error and error[0], known, datetime.now(UTC))
                yield pd.DataFrame([row], columns=[c.split()[0] for c in PAGE.split(", ")]).astype({"status_code": "Int32"})

    rows = addresses.select("url", "kind", "place", urls.host(F.col("url")).alias("host"))
    return rows.repartition("host").sortWithinPartitions("host", "place").mapInPandas(get_all, PAGE)


def locations(pages: DataFrame, base: str, holding: str, escaped: bool) -> DataFrame:
    """url and place of the addresses in sitemaps (place, html) that hold a text, each once, in the order of the sitemaps.

    escaped: character references are decoded and relative addresses resolved, as some shops need.
    """
    listed = pages.select(F.col("place").alias("page"), F.posexplode(urls.sitemap_locations(F.col("html"))).alias("pos", "url"))
    if escaped:
        listed = listed.withColumn("url", text.unescape(F.col("url")))
        listed = listed.withColumn("url", urls.resolved(text.trim(F.col("url")), F.lit(base)))
    first = listed.where(F.col("url").contains(holding)).groupBy("url").agg(F.min(F.struct("page", "pos")).alias("first"))
    return first.select("url", "first")


def placed(first: DataFrame, most: int | None = None) -> DataFrame:
    """url and place from 0 on, in order of `first`: the place of each page's first address is a running sum over pages."""
    if most is not None:
        first = first.orderBy("first").limit(most)
    rows = first.select("url", "first.page", "first.pos")
    sizes = rows.groupBy("page").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("page", (F.sum("n").over(Window.orderBy("page")) - F.col("n")).alias("before"))  # a row a sitemap
    own = F.row_number().over(Window.partitionBy("page").orderBy("pos"))
    return rows.withColumn("own", own).join(before, "page").select("url", (F.col("before") + F.col("own") - 1).alias("place"))


class Crawl:
    """The folder of one crawl: levels or rounds below it, each whole or not there."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def whole(self, name: str) -> bool:
        return exists(self.spark, f"{self.path}/{name}/_SUCCESS")

    def step(self, name: str, make, schema: str) -> DataFrame:
        """The table of that name; made and written, unless an earlier run left it whole."""
        if not self.whole(name):
            make().write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def sitemaps(self, name: str, addresses: DataFrame, fetcher: str, wait: float) -> DataFrame:
        """A level of sitemaps. One that can't be had ends the crawl, and the next run asks for the level again."""
        got = self.step(name, lambda: fetched(addresses, fetcher, wait), PAGE)
        bad = got.where("error is not null").orderBy("place").select("url", "error").first()
        if bad:
            remove(self.spark, f"{self.path}/{name}")
            raise RuntimeError(f"{bad['url']}: {bad['error']}")
        return got

    def pages(self) -> DataFrame:
        """All pages that were asked for: PAGE with role (product, category or skipped), in place order by column place."""
        return self.spark.read.schema(f"{PAGE}, role string").parquet(f"{self.path}/pages")


def crawl_sitemap(spark: SparkSession, site: SitemapSite, path: str, fetcher: str, wait: float | None = None, most: int | None = None) -> Crawl:
    """Fetches a sitemap (or an index and its sitemaps), then the pages that it lists, the first `most` if given.

    Levels: index, sitemaps, addresses, pages. Waits are never below the site's least; pages that can't be had are skipped.
    """
    crawl, wait = Crawl(spark, path), max(site.least_wait, wait or 0.0)
    found = spark.createDataFrame([(site.sitemap, "sitemap", 0)], "url string, kind string, place bigint")
    if site.index:
        index = crawl.sitemaps("index", found, fetcher, wait)
        listed = placed(locations(index, site.sitemap, site.index, site.escaped))
        found = crawl.step("sitemap_addresses", lambda: listed.withColumn("kind", F.lit("sitemap")), "url string, place bigint, kind string")
    sitemaps = crawl.sitemaps("sitemaps", found, fetcher, wait)
    listed = placed(locations(sitemaps, site.sitemap, site.product, site.escaped), most)
    addresses = crawl.step("addresses", lambda: listed.withColumn("kind", F.lit("product")), "url string, place bigint, kind string")
    role = F.when(F.col("error").isNull(), "product").otherwise("skipped")
    crawl.step("pages", lambda: fetched(addresses, fetcher, wait).withColumn("role", role), f"{PAGE}, role string")
    return crawl


@dataclass(frozen=True)
class Turn:
    """How many of each queue a round takes, which comes first, and which is due after it."""

    categories: int
    products: int
    first: str
    due: str


def turn(categories: int, products: int, due: str) -> Turn:
    """The next round of a crawl that takes categories and products in turn, for queues of that length.

    A round is the longest run of takings that doesn't depend on what its own pages add to the queues: in turn until one
    queue runs out; all products where no category waits, as products add nothing; one category where no product waits.
    """
    if not categories:
        return Turn(0, products, "product", due)
    if not products:
        return Turn(1, 0, "category", due)
    if due == "category":
        return Turn(categories, categories - 1, due, "product") if categories <= products else Turn(products, products, due, "category")
    return Turn(products - 1, products, due, "category") if products <= categories else Turn(categories, categories, due, "product")


QUEUE = "url string, kind string, page bigint, pos int"
STATE = "due string, n_visited bigint, n_products bigint, n_categories bigint, n_skipped bigint, over boolean"


def _picked(waiting: DataFrame, now: Turn, start: int, room: int | None) -> DataFrame:
    """url, kind and place of what a round takes, in turn; with room, no more than that."""

    def some(kind: str, n: int) -> DataFrame:
        rows = waiting.where(F.col("kind") == kind).orderBy("page", "pos").limit(n)
        i = F.row_number().over(Window.partitionBy("kind").orderBy("page", "pos")) - 1
        both = now.categories and now.products
        place = F.lit(start) + (2 * i + (0 if kind == now.first else 1) if both else i)
        return rows.select("url", "kind", place.cast("bigint").alias("place"))

    picked = some("category", now.categories).unionByName(some("product", now.products))
    return picked if room is None else picked.where(F.col("place") < start + room)


def found_links(pages: DataFrame, site: LinkedSite) -> DataFrame:
    """QUEUE rows of the category pages (url, place, html): product links before all links of the section, each address once."""
    host = site.start.split("/")[2]
    kinds = [("product", site.product_links, True), ("category", r'(?i)href="([^"]+)"', False)]
    every = None
    for order, (kind, pattern, assets) in enumerate(kinds):
        links = page_links(pages, pattern, host, site.section, assets, positions=True)
        links = links.join(pages.select("url", F.col("place").alias("page")), "url").select(F.col("link"), F.struct("page", F.lit(order).alias("order"), "pos", F.lit(kind).alias("kind")).alias("f"))
        every = links if every is None else every.unionByName(links)
    first = every.groupBy("link").agg(F.min("f").alias("f"))
    # products and categories are queues of their own, so places need only be in order within each
    return first.select(F.col("link").alias("url"), "f.kind", "f.page", "f.pos")


def crawl_links(
    spark: SparkSession, site: LinkedSite, path: str, fetcher: str, wait: float = 0.0, most_pages: int | None = None, most_products: int | None = None
) -> Crawl:
    """Crawls a section by its links: category pages add product and category links to two queues that are taken in turn.

    A round fetches what is due (see turn()), writes its pages (pages/round=N), then the addresses that are new (queue/round=N,
    by anti-join with all that were ever queued), then its totals (state/round=N), which make it count. An address is queued
    once, in the class in which it was first found. most_pages bounds requests, failed ones included, most_products the
    products; both end the crawl where one page at a time would. A page that says it is a product's is one, whatever queue it
    was in, and its links aren't followed.
    """
    crawl = Crawl(spark, path)
    number = 0
    while crawl.whole(f"state/round={number}"):
        number += 1
    if number:
        state = spark.read.schema(STATE).parquet(f"{crawl.path}/state/round={number - 1}").first().asDict()
    else:
        spark.createDataFrame([(site.start.rstrip("/"), "category", -1, 0)], QUEUE).write.mode("overwrite").parquet(f"{crawl.path}/queue/round=-1")
        state = {"due": "category", "n_visited": 0, "n_products": 0, "n_categories": 0, "n_skipped": 0, "over": False}
    while not state["over"]:
        whole_rounds = [f"{crawl.path}/queue/round={n}" for n in range(-1, number)]
        queued = spark.read.schema(QUEUE).parquet(*whole_rounds)
        waiting = queued
        if number:
            visited = spark.read.schema(PAGE).parquet(*[f"{crawl.path}/pages/round={n}" for n in range(number)])
            waiting = queued.join(visited.select("url"), "url", "left_anti")
        length = {r["kind"]: r["count"] for r in waiting.groupBy("kind").count().collect()}
        now = turn(length.get("category", 0), length.get("product", 0), state["due"])
        room = None if most_pages is None else most_pages - state["n_visited"]
        if now.categories + now.products == 0 or room is not None and room <= 0:
            state["over"] = True
            _write_state(spark, crawl, number, state)
            break
        picked = _picked(waiting, now, state["n_visited"], room)
        role = F.when(F.col("error").isNotNull(), "skipped").when((F.col("kind") == "product") | is_product_page(F.col("html")), "product").otherwise("category")
        got = crawl.step(f"fetched/round={number}", lambda: fetched(picked, fetcher, wait, wait_after_errors=False).withColumn("role", role), f"{PAGE}, role string")  # noqa: B023
        if most_products is not None:  # those that one page at a time would not have come to
            left = most_products - state["n_products"]
            last = got.where("role = 'product'").orderBy("place").limit(left).agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("last")).first()
            if last["n"] >= left:
                got, state["over"] = got.where(F.col("place") <= last["last"]), True
        got.write.mode("overwrite").parquet(f"{crawl.path}/pages/round={number}")
        got = spark.read.schema(f"{PAGE}, role string").parquet(f"{crawl.path}/pages/round={number}")
        new = found_links(got.where("role = 'category'"), site).join(queued.select("url"), "url", "left_anti")
        new.write.mode("overwrite").parquet(f"{crawl.path}/queue/round={number}")
        counts = {r["role"]: r["count"] for r in got.groupBy("role").count().collect()}
        state = {
            "due": now.due, "n_visited": state["n_visited"] + sum(counts.values()), "n_products": state["n_products"] + counts.get("product", 0),
            "n_categories": state["n_categories"] + counts.get("category", 0), "n_skipped": state["n_skipped"] + counts.get("skipped", 0), "over": state["over"],
        }
        _write_state(spark, crawl, number, state)
        number += 1
    return crawl


def _write_state(spark: SparkSession, crawl: Crawl, number: int, state: dict) -> None:
    names = [c.split()[0] for c in STATE.split(", ")]
    spark.createDataFrame([tuple(state[n] for n in names)], STATE).coalesce(1).write.mode("overwrite").parquet(f"{crawl.path}/state/round={number}")


def summary(pages: DataFrame) -> DataFrame:
    """One row of counters of a crawl's pages: visited, products, categories, skipped, and the first error texts by place."""
    n = lambda role: F.count_if(F.col("role") == role)
    return pages.agg(F.count(F.lit(1)).alias("visited_count"), n("category").alias("category_count"), n("product").alias("product_count"), n("skipped").alias("skipped_count"))


def products_of(pages: DataFrame) -> DataFrame:
    """url, fetched_at and html of the product pages of a crawl, as parsers take them."""
    return pages.where("role = 'product'").select("url", F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("fetched_at"), "html")

