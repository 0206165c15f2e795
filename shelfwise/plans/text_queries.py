"""Queries of text, URL, cast and page functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import casts, identity, text, urls
from shelfwise.operators import html_shops
from shelfwise.plans.standins import table


def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(text.untag(F.col("html")), 256).alias("text_hash"))


def html_unescaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole html of every page without tags, all character references decoded.

    SQL has no decoder: its text decodes the four references that the given pages hold, a test the others.
    """
    return table(spark, sf_dir, "pages").select("page_id", text.strip_html(F.col("html")).alias("text"))


def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.first_group(F.col("html"), "(?is)<title>(.*?)</title>").alias("title"))


def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = text.all_groups(F.col("html"), r'(?is)<a href="([^"]+)"[^>]*>.*?</a>')
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(links).alias("pos", "link"))


def html_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html_shops.description(F.col("html")).alias("description"))


def crawl_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all pages, to which relative ones of all kinds are added."""
    more = "".join(f'<a href="{x}">' for x in _RELATIVE)
    pages = table(spark, sf_dir, "pages").select("url", F.concat("html", F.lit(more)).alias("html"))
    return html_shops.page_links(pages)


#: Relative links: beside, below and above the page, to another host, to itself, and one that no crawler follows.
_RELATIVE = ("next", "./a/b/", "../up", "//cdn.example/x", "?page=2", "/top/./in/../out", "mailto:a@b")


_TABLE_PAGE = """<html><head><meta property="og:url" content="https://t.example/product/{i}/" /><meta name="description" content="About {i}" />
<meta property="og:image" content="https://t.example/{i}.jpg" /></head><body><h1 class="product_title entry-title">{t}</h1><span class="sku">S-{i}</span>
<span class="posted_in"><a href="https://t.example/product-category/manufacturers/m/">Maker</a>, <a href="https://t.example/product-category/products/p/">Putters</a></span>
<p>Speed: 5, Glide: 4.5, Turn: -1, Fade: 2</p><p>First {i}.</p><p></p><p>Second.</p><p>Third.</p>
<table class="x vartable y"><thead></thead><tbody>
<tr><td class="optionscol attribute_pa_color" data-label="Color"> Red </td><td class="optionscol attribute_pa_plastic" data-label="Plastic">Base</td>
<td class="pricecol q" data-price="12.50"></td><td class="stockcol z"><span class="in-stock">3 in stock</span></td>
<input name="product_id" value="{i}"><input name="variation_id" value="1{i}"></tr>
<tr><td class="optionscol attribute_pa_color" data-label="Color">Blue</td><td class="stockcol z"><span class="out">Out of Stock</span></td>
<input name="product_id" value="{i}"><input name="variation_id" value="2{i}"></tr></tbody></table></body></html>"""


def _dealt_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, dealt out to all tasks before pages are made of them: a small file is one task, and parsing its pages is long work."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return parts.repartition(4 * spark.sparkContext.defaultParallelism, "p_partkey", "p_name")


def _filled(template: str):
    filled = F.replace(F.lit(template), F.lit("{i}"), F.col("p_partkey").cast("string"))
    return F.replace(filled, F.lit("{t}"), F.col("p_name"))


def table_shop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages made from parts, parsed to rows of variants."""
    pages = _dealt_parts(spark, sf_dir).select(F.lit("https://t.example/product/x/").alias("url"), _filled(_TABLE_PAGE).alias("html"))
    rows = html_shops.table_shop(pages, F.lit("2024-01-01").cast("timestamp"))
    return rows.select("ProductId", "VariationId", "ProductName", "Sku", "ProductLink", "Description", "ManufacturerName", "DiscTypeName", "ColorName",
                       "PlasticName", "StockPrice", "Currency", "StockText", "AvailableStock", "IsOutOfStock", "Speed", "Glide", "Turn", "Fade")


_OPTION_PAGE = """<html><head><title>{t}</title><meta property="og:url" content="https://o.example/x/{i}" /><meta property="product:price:amount" content="9.99">
</head><body>"product_id":{i}, <li class="identifier product-sku"><b>x</b><span class="value">K{i}</span></li>
<span class="stock-level in-stock">In stock</span><div><strong>Catalog Number/Disc Weight</strong></div> <span class="plain-field">170s</span>
<li class=""> <label class="title">Weight</label><select name="a"><option value="">Pick</option><option value="7">173-175g</option><option value="8">180G</option></select></li></body></html>"""


def option_shop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("https://o.example/all-flying-discs/big-maker/soft-plastic/disc-"), F.col("p_partkey").cast("string"))
    pages = _dealt_parts(spark, sf_dir).select(url.alias("url"), _filled(_OPTION_PAGE).alias("html"))
    rows = html_shops.option_shop(pages, F.lit("2024-01-01").cast("timestamp"))
    return rows.select("ProductId", "ProductName", "Sku", "ProductLink", "IsOutOfStock", "ListPrice", "ManufacturerName", "PlasticSlug", "PlasticName", "ProductSlug",
                       "CategoryPath", "CatalogWeightSummary", "VariantLabel", "VariantOptionId", "VariantOptionLabel", "VariantWeightGrams")


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    parts = urls.path_parts(u, "en")
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.host(u).alias("host"), urls.path(u).alias("path"), F.try_element_at(parts, F.lit(-1)).alias("last"), F.size(parts).alias("n"),
        urls.host_reference(urls.host(u)).alias("reference"),
    )


def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.when(F.col("page_id") % 3 == 0, F.upper("url")).when(F.col("page_id") % 3 == 1, F.regexp_replace("url", "^https?://", " ")).otherwise(F.concat("url", F.lit("//")))
    return table(spark, sf_dir, "pages").select("page_id", urls.store_key(u).alias("store_key"), urls.store_base(F.col("url")).alias("store_base"))


def slug_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = F.replace(F.upper("p_name"), F.lit(" "), F.lit("--"))
    return table(spark, sf_dir, "part").select("p_partkey", text.slug_title(slug).alias("title"), text.slug_words(slug).alias("words"))


_VALUES = ["", "12", " 12 ", "12.5", "abc", "-3.75", "TRUE ", "1", "yes", "y", "0", "1e3"]


def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.element_at(F.array(*map(F.lit, _VALUES)), (F.col("event_id") % len(_VALUES) + 1).cast("int"))
    v = F.when(F.col("event_id") % 13 != 0, v)
    return table(spark, sf_dir, "events").select(
        "event_id", casts.to_int(v).alias("strict"), casts.to_int_cut(v).alias("cut"), casts.to_float(v).alias("number"), casts.safe_int(v).alias("whole"),
        casts.safe_float(v).alias("some"), casts.safe_bool(v).alias("flag"), casts.safe_string(v).alias("string"),
    )


_STOCK = ["Out of Stock", "Sold out", "3 in stock", "In stock", "-2.9 left", "173-175g", "170+ g", "180G", "none"]


def stock_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.element_at(F.array(*map(F.lit, _STOCK)), (F.col("event_id") % len(_STOCK) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", text.available_stock(v).alias("stock"), text.grams(v).alias("grams"), text.numeric_token(v).alias("token"))


def json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "value"))


def parse_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit('["'), F.col("p_name"), F.lit('",null,"x"]'))).when(F.col("p_partkey") % 4 == 1, F.replace("p_name", F.lit(" "), F.lit(", ,")))
    t = t.when(F.col("p_partkey") % 4 == 2, F.lit("[]"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(identity.parse_tags(t), "|").alias("tags"), F.size(identity.parse_tags(t)).alias("n"))


def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.split("p_name", " ")
    brand = F.when(F.col("p_size") > 10, F.col("p_brand")).otherwise(F.lit(""))
    return table(spark, sf_dir, "part").select("p_partkey", text.search_text([F.col("p_type"), brand, F.lit(None).cast("string")], tags).alias("search_text"))


_UNTAG = "trim(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"
_V = "CASE WHEN event_id % 13 <> 0 THEN [" + ", ".join(f"'{v}'" for v in _VALUES) + f"][event_id % {len(_VALUES)} + 1] END"
_S = "[" + ", ".join(f"'{v}'" for v in _STOCK) + f"][event_id % {len(_STOCK)} + 1]"

QUERIES = {f.__name__: f for f in (
    html_strip, html_unescaped, html_title, html_links, html_description, crawl_links, table_shop_rows, option_shop_rows, url_parts, url_normalize,
    slug_title, safe_casts, stock_texts, json_explode, parse_tags, search_text,
)}
SQL = {
    "html_strip": f"SELECT page_id, sha256({_UNTAG.format('html')}) AS text_hash FROM pages",
    "html_unescaped": f"""SELECT page_id, regexp_replace(replace(replace(replace({_UNTAG.format("coalesce(html, '')")}, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') AS text FROM pages""",
    "html_title": "SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<title>(.*?)</title>') THEN regexp_extract(html, '(?is)<title>(.*?)</title>', 1) END AS title FROM pages",
    "html_links": """SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, l[i] AS link FROM (
        SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a href="([^"]+)"[^>]*>.*?</a>', 1) AS l FROM pages))""",
    "html_description": f"""SELECT page_id, nullif(array_to_string(list_filter(list_transform(regexp_extract_all(html, '(?is)<p>(.*?)</p>', 1), lambda x: {_UNTAG.format('x')}),
        lambda p: p <> '' AND NOT starts_with(p, 'Speed:') AND NOT starts_with(p, 'Flight Numbers') AND p <> '{html_shops.SOLD_OUT}')[1:2], chr(10)), '') AS description FROM pages""",
    "crawl_links": """WITH p AS (SELECT url, html, regexp_extract(url, '^([^:/]+://[^/?#]*)', 1) AS origin, regexp_extract(url, '^[^:/]+://[^/?#]*([^?#]*)', 1) AS path FROM pages
          WHERE html <> '' AND url <> ''),
        d AS (SELECT *, CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END AS dir FROM p),
        l AS (SELECT url, origin, unnest(regexp_extract_all(html, '(?i)href="([^"]*)"', 1)) AS raw FROM p),
        own AS (SELECT url, origin, regexp_replace(regexp_replace(ltrim(raw), '[?#].*$', ''), '/+$', '') AS bare FROM l WHERE raw <> '' AND NOT regexp_matches(raw, '^(#|javascript:|mailto:|tel:)'))
        SELECT DISTINCT url, CASE WHEN regexp_matches(bare, '(?i)^https?://') THEN bare WHEN starts_with(bare, '//') THEN split_part(origin, '//', 1) || bare ELSE origin || bare END AS link FROM own
        UNION SELECT url, origin || dir || 'next' FROM d UNION SELECT url, origin || dir || 'a/b' FROM d
        UNION SELECT url, origin || CASE WHEN dir = '/' THEN '/' ELSE regexp_replace(dir, '[^/]+/$', '') END || 'up' FROM d
        UNION SELECT url, split_part(origin, '//', 1) || '//cdn.example/x' FROM d UNION SELECT url, origin || regexp_replace(path, '/+$', '') FROM d UNION SELECT url, origin || '/top/out' FROM d""",
    "table_shop_rows": """SELECT p_partkey AS ProductId, CAST(v || CAST(p_partkey AS VARCHAR) AS BIGINT) AS VariationId, p_name AS ProductName, 'S-' || CAST(p_partkey AS VARCHAR) AS Sku,
        'https://t.example/product/' || CAST(p_partkey AS VARCHAR) || '/' AS ProductLink, 'First ' || CAST(p_partkey AS VARCHAR) || '.' || chr(10) || 'Second.' AS Description,
        'Maker' AS ManufacturerName, 'Putters' AS DiscTypeName, CASE v WHEN '1' THEN 'Red' ELSE 'Blue' END AS ColorName, CASE v WHEN '1' THEN 'Base' END AS PlasticName,
        CAST(CASE v WHEN '1' THEN 12.5 END AS DOUBLE) AS StockPrice, 'USD' AS Currency, CASE v WHEN '1' THEN '3 in stock' ELSE 'Out of Stock' END AS StockText,
        CAST(CASE v WHEN '1' THEN 3 ELSE 0 END AS BIGINT) AS AvailableStock, v = '2' AS IsOutOfStock, CAST(5 AS DOUBLE) AS Speed, CAST(4.5 AS DOUBLE) AS Glide,
        CAST(-1 AS DOUBLE) AS Turn, CAST(2 AS DOUBLE) AS Fade FROM part, (VALUES ('1'), ('2')) t(v)""",
    "option_shop_rows": """SELECT p_partkey AS ProductId, p_name AS ProductName, 'K' || CAST(p_partkey AS VARCHAR) AS Sku, 'https://o.example/x/' || CAST(p_partkey AS VARCHAR) AS ProductLink,
        false AS IsOutOfStock, CAST(9.99 AS DOUBLE) AS ListPrice, 'Big Maker' AS ManufacturerName, 'soft-plastic' AS PlasticSlug, 'Soft Plastic' AS PlasticName,
        'disc-' || CAST(p_partkey AS VARCHAR) AS ProductSlug, 'big maker / soft plastic' AS CategoryPath, '170s' AS CatalogWeightSummary, 'Weight' AS VariantLabel, o AS VariantOptionId,
        CASE o WHEN '7' THEN '173-175g' ELSE '180G' END AS VariantOptionLabel, CASE o WHEN '7' THEN '173-175' ELSE '180' END AS VariantWeightGrams
        FROM part, (VALUES ('7'), ('8')) t(o)""",
    "url_parts": """WITH p AS (SELECT page_id, lower(regexp_extract(url, '^[^:/]+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[^:/]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        q AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS l FROM p), r AS (SELECT *, CASE WHEN l[1] = 'en' THEN l[2:] ELSE l END AS k FROM q)
        SELECT page_id, host, path, k[-1] AS last, CAST(len(k) AS INTEGER) AS n, replace(host, '.', '__') AS reference FROM r""",
    "url_normalize": """WITH p AS (SELECT page_id, url, trim(CASE page_id % 3 WHEN 0 THEN upper(url) WHEN 1 THEN regexp_replace(url, '^https?://', ' ') ELSE url || '//' END) AS u FROM pages),
        q AS (SELECT page_id, url, CASE WHEN regexp_matches(u, '(?i)^https?://') THEN u ELSE 'https://' || u END AS u FROM p)
        SELECT page_id, lower(regexp_extract(u, '^([^:/]+://[^/?#]*)', 1)) || regexp_replace(regexp_extract(u, '^[^:/]+://[^/?#]*([^?#]*)', 1), '/+$', '') || '/' AS store_key,
        regexp_replace(url, '/+$', '') || '/' AS store_base FROM q""",
    "slug_title": """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
        replace(upper(p_name), ' ', '  ') AS words FROM part""",
    "safe_casts": f"""WITH v AS (SELECT event_id, {_V} AS v FROM events), t AS (SELECT event_id, v, trim(v) AS t FROM v),
        n AS (SELECT *, CASE WHEN regexp_matches(t, '^[+-]?[0-9]+$') THEN CAST(t AS BIGINT) END AS strict, TRY_CAST(t AS DOUBLE) AS number FROM t)
        SELECT event_id, strict, CAST(trunc(number) AS BIGINT) AS cut, number, coalesce(CAST(trunc(number) AS BIGINT), 0) AS whole, coalesce(number, 0.0) AS some,
        coalesce(lower(t) IN ('true', '1', 'yes'), false) AS flag, coalesce(v, '') AS string FROM n""",
    "stock_texts": f"""WITH v AS (SELECT event_id, {_S} AS v FROM events)
        SELECT event_id, CASE WHEN contains(lower(v), 'out of stock') OR contains(lower(v), 'sold out') THEN 0
          ELSE CAST(trunc(TRY_CAST(nullif(regexp_extract(v, '-?[0-9]+(?:\\.[0-9]+)?'), '') AS DOUBLE)) AS BIGINT) END AS stock,
        nullif(regexp_extract(lower(v), '([0-9]+(?:-[0-9]+)?\\+?)\\s*g', 1), '') AS grams, nullif(regexp_extract(v, '-?[0-9]+(?:\\.[0-9]+)?'), '') AS token FROM v""",
    "json_explode": "SELECT event_id, 'k' AS key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS value FROM events",
    "parse_tags": """WITH t AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN [p_name, 'x'] WHEN 1 THEN string_split(p_name, ' ') ELSE [] END AS l FROM part)
        SELECT p_partkey, coalesce(array_to_string(l, '|'), '') AS tags, CAST(len(l) AS INTEGER) AS n FROM t""",
    "search_text": "SELECT p_partkey, lower(p_type || CASE WHEN p_size > 10 THEN ' ' || p_brand ELSE '' END || ' ' || p_name) AS search_text FROM part",
}
