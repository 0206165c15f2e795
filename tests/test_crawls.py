"""Crawls of shops against a site that a function plays."""

import random
import time
from collections import deque

import pytest
from helpers import rows

from shelfwise.functions import urls
from shelfwise.operators.html_shops import page_links
from shelfwise.plans import pipeline
from shelfwise.settings import Settings
from shelfwise.sources import crawls, http
from shelfwise.sources.sinks import exists

from pyspark.sql import functions as F  # isort: skip

LOC = "<url><loc>{}</loc></url>"


def sitemap_site(url):
    path = url.removeprefix("https://s.example")
    if path == "/product-sitemap.xml":
        return 200, "<urlset>" + "".join(LOC.format(u) for u in ("https://s.example/product/b", "https://s.example/about", "https://s.example/product/a", "https://s.example/product/b", "https://s.example/product/gone")) + "</urlset>"
    if path == "/xmlsitemap.php":
        return 200, "".join(LOC.format(u) for u in ("/xmlsitemap.php?type=products&amp;page=1", "/xmlsitemap.php?type=pages", " https://s.example/xmlsitemap.php?type=products&amp;page=2 "))
    if path == "/xmlsitemap.php?type=products&page=1":
        return 200, LOC.format("/z") + LOC.format("/y?a=1&amp;b=2")
    if path == "/xmlsitemap.php?type=products&page=2":
        return 200, LOC.format("/y?a=1&amp;b=2") + LOC.format("/x")
    if path == "/product/gone":
        return 404, "not  here"
    if path == "/product/a":
        raise TimeoutError("slow")
    return 200, f"<html>{path}</html>"


def broken_index(url):
    return (503, "busy") if "type=products" in url else sitemap_site(url)


def test_sitemap_crawl(spark, tmp_path):
    site = crawls.SitemapSite("t", "https://s.example/product-sitemap.xml", "/product/", 0.0)
    pages = crawls.crawl_sitemap(spark, site, f"file://{tmp_path}/c", "test_crawls:sitemap_site").pages()
    got = [(r.url[-4:], r.place, r.role, r.error, r.error_type, r.html) for r in pages.orderBy("place").collect()]
    assert got == [
        ("ct/b", 0, "product", None, None, "<html>/product/b</html>"), ("ct/a", 1, "skipped", "slow", "TimeoutError", None),
        ("gone", 2, "skipped", "status 404: not here", "HTTPError", None),
    ]
    assert crawls.summary(pages).first().asDict() == {"visited_count": 3, "category_count": 0, "product_count": 1, "skipped_count": 2}
    few = crawls.crawl_sitemap(spark, site, f"file://{tmp_path}/d", "test_crawls:sitemap_site", most=2).pages()
    assert few.count() == 2


def test_two_level_sitemap(spark, tmp_path):
    site = crawls.SitemapSite("t", "https://s.example/xmlsitemap.php", "", 0.0, index="xmlsitemap.php?type=products", escaped=True)
    with pytest.raises(RuntimeError, match="status 503"):
        crawls.crawl_sitemap(spark, site, f"file://{tmp_path}/c", "test_crawls:broken_index")
    assert exists(spark, f"file://{tmp_path}/c/index") and not exists(spark, f"file://{tmp_path}/c/sitemaps")
    pages = crawls.crawl_sitemap(spark, site, f"file://{tmp_path}/c", "test_crawls:sitemap_site").pages()  # goes on after the index
    assert [r.url for r in pages.orderBy("place").collect()] == [f"https://s.example/{x}" for x in ("z", "y?a=1&b=2", "x")]


def test_least_waits(spark, tmp_path, monkeypatch):
    assert (crawls.TABLE_SITE.least_wait, crawls.LISTED_SITE.least_wait) == (5.0, 10.0)
    asked = []
    monkeypatch.setattr(crawls, "fetched", lambda a, f, wait: asked.append(wait) or _frozen(a))
    _frozen = lambda a: a.selectExpr("url", "kind", "place", "200 status_code", "'' html", "cast(null as string) error", "cast(null as string) error_type", "cast(null as map<string,string>) headers", "current_timestamp() fetched_at")
    crawls.crawl_sitemap(spark, crawls.TABLE_SITE, f"file://{tmp_path}/c", "x", wait=1.0)
    crawls.crawl_sitemap(spark, crawls.LISTED_SITE, f"file://{tmp_path}/d", "x", wait=12.0)
    assert asked[:2] == [5.0, 5.0] and set(asked[2:]) == {12.0}


def test_waits_between_requests_to_a_host(spark):
    rows_ = [(f"https://{h}.example/{i}", "x", i) for i in range(3) for h in "ab"]
    df = spark.createDataFrame(rows_, "url string, kind string, place bigint")
    began = time.time()
    got = crawls.fetched(df, "test_crawls:sitemap_site", 0.3).collect()
    assert time.time() - began >= 0.6 and len(got) == 6
    at = sorted(r.fetched_at for r in got if "//a." in r.url)
    assert all((y - x).total_seconds() >= 0.25 for x, y in zip(at, at[1:], strict=False))


def one_at_a_time(pages, products, bad, marked, start, most_pages=None, most_products=None):
    """(url, role) as a crawler with two queues visits a site (links by page), one page at a time."""
    waiting = {"category": deque([start]), "product": deque()}
    queued, due, out, taken = {start}, "category", [], 0
    other = {"category": "product", "product": "category"}
    while waiting["category"] or waiting["product"]:
        kind = due if waiting[due] else other[due]
        url = waiting[kind].popleft()
        if kind == due:
            due = other[due] if waiting[other[due]] else due
        if most_pages is not None and len(out) >= most_pages:
            break
        if url in bad:
            out.append((url, "skipped"))
            continue
        if kind == "product" or url in marked:
            out.append((url, "product"))
            taken += 1
            if taken == most_products:
                break
            continue
        out.append((url, "category"))
        for k, links in (("product", products), ("category", pages)):
            for x in links.get(url, []):
                if x not in queued:
                    queued.add(x)
                    waiting[k].append(x)
    return out


def test_turns_are_those_of_one_page_at_a_time():
    """Rounds of turn(), played on random sites, visit pages in the order of the plain crawler."""
    for seed in range(400):
        rng = random.Random(seed)
        n = rng.randint(1, 25)
        pages = {i: [rng.randrange(n) for _ in range(rng.randint(0, 3))] for i in range(n)}
        products = {i: [100 + rng.randrange(30) for _ in range(rng.choice([0, 0, 1, 4]))] for i in range(n)}
        waiting, queued, due, got = {"category": deque([0]), "product": deque()}, {0}, "category", []
        while waiting["category"] or waiting["product"]:
            now = crawls.turn(len(waiting["category"]), len(waiting["product"]), due)
            left, kind, round_ = {"category": now.categories, "product": now.products}, now.first, []
            while any(left.values()):
                if left[kind]:
                    round_.append((waiting[kind].popleft(), kind))
                    left[kind] -= 1
                kind = "product" if kind == "category" else "category"
            due = now.due
            got += round_
            for url, kind in round_:
                for k, links in (("product", products), ("category", pages)) if kind == "category" else ():
                    for x in links.get(url, []):
                        if x not in queued:
                            queued.add(x)
                            waiting[k].append(x)
        assert got == one_at_a_time(pages, products, set(), set(), 0)


BASE = "https://shop.example/all"
PAGES = {"": ["c1", "c2", "p1", "c3"], "c1": ["c4", "c2", "x.png", "p9"], "c2": ["c5"], "c4": ["c1", "odd"], "c5": ["bad", "c6"], "c6": ["p2"]}
PRODUCTS = {"": ["p1", "p2"], "c1": ["p3", "p1", "gone"], "c3": ["p4"], "c5": ["p5", "c2"]}
BAD, MARKED = {"gone", "bad"}, {"odd", "p9"}


def linked_site(url):
    name = url.removeprefix(BASE).strip("/")
    if name in BAD:
        return 500, ""
    head = '<meta property="og:type" content="product">' if name in MARKED else "<p>"
    found = "".join(f'<div class="product-photo"> <a href="/all/{x}/" class="product-thumbnail">' for x in PRODUCTS.get(name, []))
    return 200, head + found + "".join(f'<a href="{BASE}/{x}?q=1#f">' for x in PAGES.get(name, [])) + '<a href="https://other.example/all/c9"><a href="/else">'


def fails_once(url):
    if url.endswith("c5") and not FAILED:
        FAILED.append(url)
        raise RuntimeError("the task dies")
    return linked_site(url)


FAILED = []
SITE = crawls.LinkedSite("t", BASE, "/all/", crawls.OPTION_SITE.product_links)


def visited(crawl):
    return [(r.url.removeprefix(BASE).strip("/"), r.role) for r in crawl.pages().orderBy("place").collect()]


def wanted(**most):
    pages = {k: [x for x in v if not x.endswith(".png")] for k, v in PAGES.items()}
    return one_at_a_time(pages, PRODUCTS, BAD, MARKED, "", **most)


def test_linked_crawl_order(spark, tmp_path):
    whole = crawls.crawl_links(spark, SITE, f"file://{tmp_path}/c", "test_crawls:linked_site")
    assert visited(whole) == wanted()
    assert crawls.summary(whole.pages()).first().asDict() == {"visited_count": 16, "category_count": 7, "product_count": 7, "skipped_count": 2}
    for i, most in enumerate(({"most_pages": 5}, {"most_products": 3}, {"most_pages": 11, "most_products": 6})):
        assert visited(crawls.crawl_links(spark, SITE, f"file://{tmp_path}/m{i}", "test_crawls:linked_site", **most)) == wanted(**most)


def test_linked_crawl_goes_on(spark, tmp_path):
    """A round that dies is made again; rounds before it aren't."""
    path = f"file://{tmp_path}/c"
    once = crawls.fetched

    def dies(addresses, *rest, **more):
        if addresses.where("url like '%c5'").count() and not FAILED:
            FAILED.append(1)
            raise RuntimeError("the driver dies")
        return once(addresses, *rest, **more)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(crawls, "fetched", dies)
        with pytest.raises(RuntimeError, match="dies"):
            crawls.crawl_links(spark, SITE, path, "test_crawls:linked_site")
    before = {p.name: p.stat().st_mtime for p in (tmp_path / "c/pages").glob("round=*/*.parquet")}
    assert before and visited(crawls.crawl_links(spark, SITE, path, "test_crawls:linked_site")) == wanted()
    assert all((tmp_path / "c/pages").rglob(name) for name in before)
    assert visited(crawls.crawl_links(spark, SITE, path, "test_crawls:nothing")) == wanted()  # over: nothing is asked again


def test_crawl_steps(spark, tmp_path):
    s = Settings(raw_dir=f"file://{tmp_path}/raw", parsed_dir=f"file://{tmp_path}/p", table_dir=f"file://{tmp_path}/t", fetcher="test_crawls:option_pages", crawl_base="https://shop.example")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(crawls, "OPTION_SITE", crawls.LinkedSite("option", BASE, "/all/", crawls.OPTION_SITE.product_links))
        run = pipeline.scrape_pages(spark, s, "option")
    assert exists(spark, f"{s.raw_dir}/option_crawl/run={run}") and not exists(spark, f"{s.raw_dir}/option_crawl/open")
    audit = pipeline.audit_table(spark, s).read("run_id string, command string, status string, pages_saved bigint, error_count bigint")
    assert rows(audit, "command", "status", "pages_saved", "error_count") == [("scrape-option-shop", "COMPLETED", 7, 2)]
    pipeline.parse_pages(spark, s, "option")
    parsed = spark.read.parquet(f"{s.parsed_dir}/OptionShop")
    assert parsed.count() == 7 and rows(parsed.where("ProductId is not null"), "ProductId") == [(7,)]
    assert {"scrape-records", "scrape-table-shop", "scrape-listed-shop", "scrape-option-shop"} <= set(pipeline.steps(spark, s))


def option_pages(url):
    status, html = linked_site(url)
    return status, html + ('<title>D</title><script>{"product_id":7}</script>' if url.endswith("p3") else "")


def test_links_resolve_as_browsers_do(spark):
    from urllib.parse import urljoin, urlparse

    base = "https://h.example/a/b/c.html"
    links = ["x", "x//y", "/x//y", "../u", "./v/../w", "?q=1", "x?q=/../z", "//o.example/p", "HTTP://O.example/Q", "https:x", "\t z", "x\ty", "/..//t", "a/./b/", "x#f", "mailto:q@r"]
    links = [x for x in links if x not in ("https:x", "/..//t")]
    df = spark.createDataFrame([(x,) for x in links], "l string").select("l", urls.resolved(F.col("l"), F.lit(base)).alias("r"), urls.crawl_link(F.col("l"), F.lit(base)).alias("c"))
    for r in df.collect():
        want = urljoin(base, r.l.lstrip(" \t"))
        clean = urlparse(want)._replace(query="", fragment="").geturl().rstrip("/")
        assert r.c == (None if r.l.startswith("mailto:") else clean), r.l
    pages = spark.createDataFrame([(base, '<a href="x.CSS"><a href="/a/q"><a href="/b/r"><a href="//o.example/a/s">')], "url string, html string")
    assert rows(page_links(pages, site="h.example", prefix="/a/", assets=False), "link") == [("https://h.example/a/q",)]


def test_a_page_that_two_rows_hold_gives_each_link_once(spark):
    pages = spark.createDataFrame([("https://h.example/a", '<a href="/x"><a href="/y"><a href="/x">'), ("https://h.example/a", '<a href="/y#f"><a href="/z">')], "url string, html string")
    found = rows(page_links(pages), "link")
    assert found == [("https://h.example/x",), ("https://h.example/y",), ("https://h.example/z",)]
    assert rows(page_links(pages, positions=True), "pos", "link") == [(0, found[0][0]), (0, found[1][0]), (1, found[1][0]), (1, found[2][0])]


def test_answer():
    answer = http.Answer(429, " a \n b ", {"Retry-After": "5", "Cookie": "x"})
    assert answer.known() == {"retry-after": "5"} and answer.snippet() == "a b"
