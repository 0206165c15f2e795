"""URL functions over columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import once, present, slug_words

HTTP = r"(?i)^https?://"
#: Shops that are known by a short name.
STORE_URLS = {
    "discgolfstar": "https://discgolfstar.com/",
    "discgod": "https://discgod.com/",
    "discstore": "https://discstore.com/",
    "dzdiscs": "https://dzdiscs.com/",
    "fadegear": "https://fadegear.com/",
    "foundationdiscs": "https://foundationdiscs.com/",
    "jerseydiscs": "https://jerseydiscs.com/",
    "maverickdiscgolf": "https://maverickdiscgolf.com/",
    "shopledgestone": "https://shopledgestone.com/",
    "skybreed-discs": "https://skybreed-discs.com/",
    "throwshop": "https://throwshop.us/",
    "titandiscgolf": "https://titandiscgolf.com/",
    "unitedsport": "https://unitedsport.ca/",
}


def with_scheme(c: Column) -> Column:
    """https where there is no scheme; blank is null."""
    url = present(c)
    return F.when(url.rlike(HTTP), url).otherwise(F.concat(F.lit("https://"), url))


def store_key(c: Column) -> Column:
    """A store's address in one form: scheme and authority in lower case, no query or fragment, one slash at the end."""
    url = with_scheme(c)
    head = F.lower(F.regexp_extract(url, "^([^:/]+://[^/?#]*)", 1))
    path = F.regexp_extract(url, "^[^:/]+://[^/?#]*([^?#]*)", 1)
    return F.concat(head, F.regexp_replace(path, "/+$", ""), F.lit("/"))


def store_base(c: Column) -> Column:
    """A store's address with one slash at the end, else as it stands."""
    return F.concat(F.regexp_replace(with_scheme(c), "/+$", ""), F.lit("/"))


def host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, "^[^:/]+://([^/?#]*)", 1))


def path(c: Column) -> Column:
    return F.regexp_extract(c, "^[^:/]+://[^/?#]*([^?#]*)", 1)


def host_reference(c: Column) -> Column:
    """A host as a file name writes it."""
    return F.replace(c, F.lit("."), F.lit("__"))


def store_of_reference(c: Column, known: dict[str, str] = STORE_URLS) -> Column:
    """The address behind a file's store name: the host it spells, or a known shop."""
    decoded = F.replace(c, F.lit("__"), F.lit("."))
    lookup = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return F.when(decoded.contains("."), F.concat(F.lit("https://"), decoded, F.lit("/"))).otherwise(F.try_element_at(lookup, c))


def reference_of_file(c: Column) -> Column:
    """The store name of a raw file: without folder, extension and page and time numbers."""
    name = F.regexp_replace(F.substring_index(c, "/", -1), r"\.[^.]*$", "")
    return F.regexp_replace(name, r"_\d+_\d+$", "")


def product_link(store: Column, handle: Column) -> Column:
    """Null if either is missing."""
    return F.when(handle != "", F.concat(store, F.lit("products/"), handle))


def absolute(c: Column, base: str) -> Column:
    """http addresses as they stand, others below base; blank is null."""
    return F.when(c != "", F.when(c.rlike("^https?://"), c).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(c, "^/+", ""))))


def is_web_address(c: Column) -> Column:
    return F.coalesce(present(c).rlike(HTTP + ".+"), F.lit(False))


def path_parts(c: Column, section: str) -> Column:
    """The parts of a path that aren't empty, without a leading section."""
    parts = F.filter(F.split(path(c), "/"), lambda p: p != "")
    return F.when(F.get(parts, F.lit(0)) == section, F.slice(parts, 2, 1_000_000)).otherwise(parts)


def category_path(parts: Column) -> Column:
    """All parts but the last as words, joined by slashes; null for less than two."""
    names = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), slug_words)
    return F.when(F.size(parts) > 1, F.array_join(names, " / "))


def _without_dots(path: Column) -> Column:
    """A path without `.` and `..` parts; those above the top vanish."""

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    parts = F.split(F.regexp_replace(path, "^/+", ""), "/")
    return F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))


def resolved(link: Column, base: Column) -> Column:
    """A link resolved against the address of its page, as browsers do: line ends and tabs are dropped wherever they are, control
    characters and spaces before it, and empty parts within a relative path. Query and fragment stay."""
    clean = F.regexp_replace(F.regexp_replace(link, "[\\t\\r\\n]", ""), "^[\\x00-\\x20]+", "")
    origin = F.regexp_extract(base, "^([^:/]+://[^/?#]*)", 1)
    folder = F.regexp_replace(path(base), "[^/]*$", "")

    def whole(x: Column) -> Column:
        tail = F.regexp_extract(x, "[?#].*$", 0)
        bare = F.regexp_replace(x, "[?#].*$", "")
        inner = F.regexp_replace(bare, "(?<=[^/])/{2,}", "/")
        full = (
            F.when(bare.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(F.lower(F.regexp_extract(bare, "^([^:]+):", 1)), F.regexp_replace(bare, "^[^:]+", "")))
            .when(bare.startswith("//"), F.concat(F.substring_index(origin, "//", 1), bare))
            .when(bare.startswith("/"), F.concat(origin, _without_dots(bare)))
            .when(bare == "", F.concat(origin, path(base)))
            .otherwise(F.concat(origin, _without_dots(F.concat(folder, inner))))
        )
        return F.concat(full, tail)

    return once(clean, whole)


def crawl_link(link: Column, base: Column) -> Column:
    """A link of a page as a crawler keeps it: resolved() against the page's address, no query or fragment, no slash at the end.

    Null for empty links, fragments, scripts, mail and phone links.
    """
    kept = (link != "") & ~link.rlike("^(#|javascript:|mailto:|tel:)")
    return F.when(kept, F.regexp_replace(F.regexp_replace(resolved(link, base), "[?#].*$", ""), "/+$", ""))


#: Ends of paths that are no pages.
ASSETS = (".png", ".jpg", ".jpeg", ".gif", ".webp", ".svg", ".css", ".js", ".ico", ".pdf")


def is_asset(c: Column) -> Column:
    low = F.lower(path(c))
    return reduce(lambda a, b: a | b, [low.endswith(end) for end in ASSETS])


def in_section(c: Column, site: str, prefix: str) -> Column:
    """Whether an address is on a site (a host with its port) and its path starts with prefix."""
    return (F.regexp_extract(c, "^[^:/]+://([^/?#]*)", 1) == site) & path(c).startswith(prefix)


def quoted(c: Column) -> Column:
    """Every reserved character percent-encoded."""
    return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))


def sitemap_locations(c: Column) -> Column:
    """The addresses in a sitemap's loc elements, first seen first."""
    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"(?i)<loc>([^<]*)</loc>")), lambda u: F.trim(u)), lambda u: u != ""))


def sitemap_products(c: Column, part: str = "/product/") -> Column:
    """Those addresses of a sitemap that lead to products."""
    return F.filter(sitemap_locations(c), lambda u: u.contains(part))
