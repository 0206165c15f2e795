"""Shops' web interfaces as Spark data sources, and the fetching that crawls share.

spark.dataSource.register(ShopFeed); spark.read.format("shop_feed").options(stores=..., pages=39).load() reads one
partition a store; format "record_pages" reads a record interface, one partition a range of offsets. A fetcher is a function
(url) -> (status, text) or (status, text, headers), a poster one of (url, payload); tests and machines without a network give
their own by the options fetcher and poster as "module:function".
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetch = Callable[[str], tuple]
#: Page size, pages, waits between attempts.
PAGE_SIZE, PAGES, WAITS = 250, 39, (5.0, 10.0, 10.0)
SNIPPET = 300
#: What is kept of a failed answer's headers.
HEADERS = ("content-type", "server", "cf-ray", "retry-after", "x-request-id")
BROWSER = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/122.0.0.0 Safari/537.36"


class Answer(NamedTuple):
    status: int
    text: str
    headers: dict[str, str] = {}

    def known(self) -> dict[str, str]:
        lower = {k.lower(): v for k, v in self.headers.items()}
        return {h: lower[h] for h in HEADERS if lower.get(h)}

    def snippet(self) -> str:
        return " ".join(self.text.split())[:SNIPPET]


def _send(request: urllib.request.Request, timeout: float) -> tuple[int, str, dict[str, str]]:
    try:
        with urllib.request.build_opener(urllib.request.ProxyHandler({})).open(request, timeout=timeout) as answer:
            return answer.status, answer.read().decode("utf-8", "replace"), dict(answer.headers)
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace"), dict(e.headers)


def fetch(url: str) -> tuple[int, str, dict[str, str]]:
    accept = "text/html,application/xhtml+xml,application/xml;q=0.9,application/json,*/*;q=0.8"
    return _send(urllib.request.Request(url, headers={"User-Agent": BROWSER, "Accept": accept}), 10)


def post(url: str, payload: dict) -> tuple[int, str, dict[str, str]]:
    origin = "/".join(url.split("/")[:3])
    headers = {
        "Accept": "application/json, text/javascript, */*; q=0.01", "Content-Type": "application/json; charset=UTF-8", "Origin": origin,
        "Referer": f"{origin}/advanced-search-results", "User-Agent": BROWSER, "X-Requested-With": "XMLHttpRequest",
    }
    return _send(urllib.request.Request(url, json.dumps(payload).encode(), headers, method="POST"), 30)


def named(function: str) -> Callable:
    """The function behind "module:function"."""
    module, _, name = function.partition(":")
    return getattr(importlib.import_module(module), name)


def attempts(get: Fetch, url: str, waits: tuple[float, ...], event: Callable[..., None], page: int = 1) -> list | None:
    """The products of the first good answer, or None; each failure is an event with what is known of it.

    An answer of 200 that is no JSON object (a block page, say) is a failed attempt like a transport error.
    """
    for attempt in range(1, len(waits) + 2):
        answer, error = None, None
        try:
            answer = Answer(*get(url))
            if answer.status == 200:
                products = json.loads(answer.text).get("products") or []
                if products and attempt > 1:
                    event("retry_success", page=page, attempt=attempt, url=url, status_code=200)
                return products
        except (OSError, ValueError, AttributeError) as e:
            error = e
        what = {"status_code": answer.status, "headers": answer.known(), "body": answer.snippet()} if answer else {}
        if error is None:
            event("http_error", page=page, attempt=attempt, url=url, **what)
        else:
            event("request_exception", page=page, attempt=attempt, url=url, error=str(error), error_type=type(error).__name__, **what)
        if attempt <= len(waits):
            time.sleep(waits[attempt - 1])
    return None


def feed_pages(get: Fetch, store: str, pages: int, unpaged: bool, waits: tuple[float, ...], event: Callable[..., None]) -> Iterator[str]:
    """Texts of a store's product pages until an empty one."""
    for page in range(1, 2 if unpaged else pages + 1):
        url = f"{store}products.json" + ("" if unpaged else f"?limit={PAGE_SIZE}&page={page}")
        products = attempts(get, url, waits, event, page)
        if not products:
            if products is not None:
                event("page_empty", page=page, attempt=1, url=url, status_code=200)
            return
        event("page_success", page=page, attempt=1, url=url, status_code=200, product_count=len(products))
        yield json.dumps(products)


class _Store(InputPartition):
    def __init__(self, url: str, unpaged: bool) -> None:
        self.url, self.unpaged = url, unpaged


class _FeedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self._options = options

    def partitions(self) -> list[InputPartition]:
        listed = lambda name: [u.strip() for u in self._options.get(name, "").split(",") if u.strip()]
        unpaged = set(listed("unpaged"))
        return [_Store(u, u in unpaged) for u in listed("stores")]

    def read(self, partition: _Store) -> Iterator[tuple]:
        get = named(self._options.get("fetcher", f"{__name__}:fetch"))
        waits = tuple(float(x) for x in self._options.get("waits", ",".join(map(str, WAITS))).split(",") if x)
        events: list[tuple] = []

        def event(kind: str, page: int, attempt: int, url: str, **known: object) -> None:
            rest = [known.get(c) for c in ("status_code", "error", "error_type", "product_count", "headers", "body")]
            events.append((kind, page, attempt, url, *rest, partition.url, partition.unpaged, None))

        for text in feed_pages(get, partition.url, int(self._options.get("pages", PAGES)), partition.unpaged, waits, event):
            kind = events.pop()
            yield from events
            events.clear()
            yield (*kind[:-1], text)
        yield from events


class ShopFeed(DataSource):
    """Events of reading shops' feeds; products holds a page's JSON on success. unpaged: those stores that have one page."""

    @classmethod
    def name(cls) -> str:
        return "shop_feed"

    def schema(self) -> str:
        return (
            "event_type string, page int, attempt int, url string, status_code int, error string, error_type string, product_count int, "
            "headers map<string,string>, body string, store_url string, use_unpaged_products_json boolean, products string"
        )

    def reader(self, schema) -> DataSourceReader:
        return _FeedReader(self.options)


# Where records are asked for, and the filters of a request, all open.
RECORDS_URL = "https://infinitediscs.com/Search/SearchedData"
FILTERS = (
    "DiscBrand DiscType DiscStability DiscColor DiscWeight DiscWeight2 PlasticGrade DiscPlastic DiscDiameter DiscHeight DiscDepth DiscWidth "
    "DiscSpeed DiscGlide DiscTurn DiscFade PlasticGlow DiscExtra SkillLevel DiscStamp"
).split()


def record_request(start: int, length: int, draw: int) -> dict:
    wanted = json.dumps({**dict.fromkeys(FILTERS), "ResultType": "I"})
    return {"Draw": draw, "Start": start, "Length": length, "Type": "Advanced", "Filter": wanted, "DiscBrand": "", "DiscModel": "", "Weight1": "", "Weight2": ""}


class RecordClient:
    """Asks a record interface for slices: tries times with growing waits, then for half as much, down to `least`."""

    def __init__(self, send: Callable[[str, dict], tuple], url: str, size: int, least: int, tries: int = 5, wait: float = 2.0, growth: float = 2.0) -> None:
        self._send, self._url, self._size, self._least = send, url, size, least
        self._tries, self._wait, self._growth = tries, wait, growth

    def _asked(self, start: int, length: int, draw: int) -> tuple[dict | None, str]:
        """An answer, or None and why. A status of 500 and more, transport errors and answers that are no JSON are tried again."""
        pause, why = self._wait, ""
        for attempt in range(self._tries):
            try:
                answer = Answer(*self._send(self._url, record_request(start, length, draw)))
                if answer.status < 400:
                    return json.loads(answer.text), ""
                why = f"status {answer.status}"
                if answer.status < 500:
                    break
            except (OSError, ValueError) as e:
                why = f"{type(e).__name__}: {e}"
            if attempt + 1 < self._tries:
                time.sleep(pause)
                pause *= self._growth
        return None, why

    def slices(self, start: int, end: int, draw: int) -> Iterator[tuple[int, int, dict]]:
        """start, number of records and answer of all slices from start to end. An answer that holds less than was asked for is
        followed by the rest; an empty one ends the range."""
        size = self._size
        while start < end:
            length = min(size, end - start)
            answer, why = self._asked(start, length, draw)
            if answer is None:
                if length <= self._least:
                    raise OSError(f"no records from {start} on: {why}")
                size = max(self._least, length // 2)
                continue
            got = len(answer.get("data") or [])
            if not got:
                return
            yield start, got, answer
            start, draw = start + got, draw + 1

    def total(self) -> int:
        """recordsTotal, from the least slice that may be asked for."""
        answer, why = self._asked(0, self._least, 1)
        if answer is None:
            raise OSError(f"no number of records: {why}")
        return int(answer.get("recordsTotal") or 0)


class _Range(InputPartition):
    def __init__(self, number: int, start: int, end: int) -> None:
        self.number, self.start, self.end = number, start, end


class _RecordReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self._options = options
        self._size = int(options.get("size", 2000))

    def _client(self) -> RecordClient:
        o = self._options
        return RecordClient(
            named(o.get("poster", f"{__name__}:post")), o.get("url", RECORDS_URL), self._size, int(o.get("least", 250)),
            int(o.get("tries", 5)), float(o.get("wait", 2.0)), float(o.get("growth", 2.0)),
        )

    def partitions(self) -> list[InputPartition]:
        """A slice of `size` records each, as many as the interface's total asks for."""
        starts = range(0, self._client().total(), self._size)
        total = starts.stop
        return [_Range(i, s, min(s + self._size, total)) for i, s in enumerate(starts)] or [_Range(0, 0, 0)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        for start, got, answer in self._client().slices(partition.start, partition.end, partition.number + 1):
            yield start, got, int(answer.get("recordsTotal") or 0), json.dumps(answer)


class RecordPages(DataSource):
    """Answers of a record interface: where each starts, how many records it holds, the total it names, and its JSON."""

    @classmethod
    def name(cls) -> str:
        return "record_pages"

    def schema(self) -> str:
        return "start bigint, n_records int, total bigint, body string"

    def reader(self, schema) -> DataSourceReader:
        return _RecordReader(self.options)
