"""Settings from the environment or a .env file; what is set first wins."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace
from pathlib import Path
from typing import TypeVar

Site = TypeVar("Site")


def load_env(path: str = ".env") -> None:
    """KEY=VALUE lines into the environment, where a key isn't set yet."""
    file = Path(path)
    for line in file.read_text("utf-8").splitlines() if file.exists() else []:
        key, sign, value = line.strip().partition("=")
        if sign and not key.startswith("#"):
            os.environ.setdefault(key.strip(), value.strip().strip("'\""))


@dataclass(frozen=True)
class Settings:
    """Each field is read from the variable of its name in capitals. Folders may be on any file system that Spark reads."""

    raw_dir: str = "output/raw"
    parsed_dir: str = "output/parsed"
    table_dir: str = "output/tables"
    archive_dir: str = ""
    store_urls: str = ""
    fetcher: str = "shelfwise.sources.http:fetch"
    fetch_waits: str = "5,10,10"
    poster: str = "shelfwise.sources.http:post"
    record_base: str = "https://records.example"
    record_url: str = "https://infinitediscs.com/Search/SearchedData"
    record_page_size: int = 2000
    record_least_page_size: int = 250
    record_wait: float = 2.0
    crawl_base: str = ""
    table_wait: float = 0.0
    table_max_products: int = 0
    option_wait: float = 0.0
    option_max_pages: int = 0
    option_max_products: int = 0
    state_buckets: int = 64
    landing_done: str = "archive"
    search_host: str = ""
    search_key: str = ""
    search_collection: str = "discs_v4"
    index_batch_size: int = 200
    batch_run_id: str = ""

    @classmethod
    def from_env(cls) -> Settings:
        found = {f.name: os.environ[f.name.upper()] for f in fields(cls) if os.environ.get(f.name.upper())}
        return cls(**{n: type(getattr(cls, n))(v) for n, v in found.items()})

    def stores(self) -> list[str]:
        return [s.strip() for s in self.store_urls.split(",") if s.strip()]

    def site(self, known: Site) -> Site:
        """A crawled shop as it is known, or at another address (crawl_base, for tests and mirrors)."""
        if not self.crawl_base:
            return known
        field = "start" if hasattr(known, "start") else "sitemap"
        path = "/".join(getattr(known, field).split("/")[3:])
        return replace(known, **{field: f"{self.crawl_base.rstrip('/')}/{path}"})
