"""Product rows from two kinds of shop pages: those that list variants in a table, and those that offer options.

All patterns are native expressions; texts are unescaped in one Arrow batch call at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import casts, text, urls
from shelfwise.sources import schemas

# The markup of the two shop systems.
META_NAME = r'(?i)<meta\s+(?:property|name)="([^"]+)"\s+content="([^"]*)"\s*/?>'
TABLE_TITLE = r'(?is)<h1 class="product_title entry-title">(.*?)</h1>'
TABLE_SKU = r'(?is)<span class="sku">\s*(.*?)\s*</span>'
POSTED_IN = r'(?is)<span class="posted_in">(.*?)</span>'
CATEGORY_LINK = r'(?is)<a href="([^"]+)"[^>]*>(.*?)</a>'
PARAGRAPH = r"(?is)<p>(.*?)</p>"
FLIGHT_TEXT = r"(?i)Speed:\s*([-\d.]+)\s*,?\s*Glide:\s*([-\d.]+)\s*,?\s*Turn:\s*([-\d.]+)\s*,?\s*Fade:\s*([-\d.]+)"
FLIGHT_TABLE = r'(?is)<div class="woocommerce-product-gallery"[^>]*><table[^>]*class="round-table"[^>]*><tbody><tr>(.*?)</tr>'
FLIGHT_CELL = r"(?is)<td[^>]*>.*?<br>\s*([^<]+)</td>"
ROW_TABLE = r'(?is)<table[^>]*class="[^"]*\bvartable\b[^"]*"[^>]*>.*?<tbody>(.*?)</tbody>.*?</table>'
ROW = r"(?is)<tr[^>]*>(.*?)</tr>"
THUMBNAIL = r'(?i)<a href="([^"]+)"[^>]*class="[^"]*\bthumb\b'
OPTION_CELL = r'(?is)<td class="optionscol\s+attribute_pa_([^"]+)"[^>]*data-label="([^"]+)">\s*(.*?)</td>'
PRICE_CELL = r'(?is)<td class="pricecol [^"]*"[^>]*data-price="([^"]+)"'
STOCK_CELL = r'(?is)<td class="stockcol [^"]*"[^>]*><span class="([^"]+)">(.*?)</span>'
FORM_PRODUCT = r'(?i)name="product_id"\s+value="(\d+)"'
FORM_VARIATION = r'(?i)name="variation_id"\s+value="(\d+)"'
ATTRIBUTE_JSON = r"(?is)name=\"form_vartable_attribute_json\"\s+value='([^']+)'"
PAGE_PRODUCT = r"(?i)mlw_pid%3D(\d+)"
SOLD_OUT = "Currently Sold Out!"
MANUFACTURERS, PRODUCTS = "/product-category/manufacturers/", "/product-category/products/"
OPTION_TITLE = r"(?is)<title>(.*?)</title>"
OPTION_SKU = r'(?is)<li class="identifier product-sku">.*?<span class="value">(.*?)</span>'
OPTION_WEIGHT = r'(?is)<li class="product-weight">.*?<span>(.*?)</span>'
STOCK_LEVEL = r'(?is)<span class="stock-level ([^"]*)">(.*?)</span>'
PLAIN_FIELD = r'(?is)<div><strong>(.*?)</strong></div>\s*<span class="plain-field">(.*?)</span>'
ATTRIBUTE_BLOCK = r'(?is)<li class="">\s*<label class="title">(.*?)</label>\s*<select[^>]*>(.*?)</select>'
OPTION = r'(?is)<option[^>]*value="([^"]+)"[^>]*>(.*?)</option>'
OPTION_PRODUCT = r'(?i)"product_id":(\d+)'
SECTION = "all-flying-discs"
WEIGHT_FIELDS = ("Catalog Number/Weight (See Pics)", "Catalog Number/Disc Weight")


def _pairs(c: Column, pattern: str, key: int, value: int) -> Column:
    """Array of (k, v) from two groups of all matches; v without tags unless it is an attribute's value."""
    return F.arrays_zip(text.all_groups(c, pattern, key).alias("k"), text.all_groups(c, pattern, value).alias("v"))


def meta_tags(html: Column) -> Column:
    """Array of (k, v): names in lower case and contents of the meta tags that name first."""
    return F.transform(_pairs(html, META_NAME, 1, 2), lambda p: F.struct(F.lower(p["k"]).alias("k"), p["v"].alias("v")))


def meta(pairs: Column, name: str) -> Column:
    return text.blank_to_null(text.last_of_pairs(pairs, "k", "v", name))


def _labelled(c: Column, pattern: str, key: int, value: int, key_is_text: bool = True) -> Column:
    clean = text.untag if key_is_text else (lambda x: x)
    return F.transform(_pairs(c, pattern, key, value), lambda p: F.struct(clean(p["k"]).alias("k"), text.untag(p["v"]).alias("v")))


def description(html: Column) -> Column:
    """The first two paragraphs that say something, joined by a line end; null without any."""
    said = F.filter(
        F.transform(text.all_groups(html, PARAGRAPH), text.untag),
        lambda p: (p != "") & ~p.startswith("Speed:") & ~p.startswith("Flight Numbers") & (p != SOLD_OUT),
    )
    return text.blank_to_null(F.array_join(F.slice(said, 1, 2), "\n"))


def flight_numbers(html: Column) -> Column:
    """Struct of speed, glide, turn and fade from the text, else from the first four cells of the table."""
    cells = text.all_groups(F.regexp_extract(html, FLIGHT_TABLE, 1), FLIGHT_CELL)
    told, names = F.regexp_extract(html, FLIGHT_TEXT, 0), ("Speed", "Glide", "Turn", "Fade")

    def all_four(found: Column) -> Column:
        from_text = F.struct(*[casts.to_float(F.regexp_extract(found, FLIGHT_TEXT, i + 1)).alias(n) for i, n in enumerate(names)])
        from_cells = text.once(cells, lambda c: F.struct(*[casts.to_float(text.numeric_token(text.untag(F.get(c, F.lit(i))))).alias(n) for i, n in enumerate(names)]))
        return F.when(found != "", from_text).otherwise(from_cells)

    return text.once(told, all_four)


def usable(pages: DataFrame) -> DataFrame:
    """Pages with an address and content."""
    return pages.where("coalesce(html, '') <> '' and coalesce(url, '') <> ''")


def _finished(df: DataFrame, schema: str, escaped: list[str]) -> DataFrame:
    return schemas.conform(df.withColumns({c: text.unescape(F.col(c)) for c in escaped}), schema)


def table_shop(pages: DataFrame, at: Column) -> DataFrame:
    """Rows of pages (url, html): one for each row of the variants' table, else one from the page itself."""
    html = F.col("html")
    p = usable(pages)
    links = F.transform(_pairs(F.regexp_extract(html, POSTED_IN, 1), CATEGORY_LINK, 1, 2), lambda x: F.struct(x["k"].alias("k"), text.untag(x["v"]).alias("v")))
    titled = lambda pattern: text.once(text.first_group(html, pattern), lambda t: F.when(t.isNotNull(), text.untag(t)))
    p = p.select(
        "url", meta_tags(html).alias("m"), titled(TABLE_TITLE).alias("ProductName"), titled(TABLE_SKU).alias("Sku"), description(html).alias("said"), links.alias("links"),
        html.contains(SOLD_OUT).alias("sold_out"), flight_numbers(html).alias("flight"), text.first_group(html, PAGE_PRODUCT).alias("page_product"),
        text.all_groups(F.regexp_extract(html, ROW_TABLE, 1), ROW).alias("rows"),
    )
    p = p.select("*", "flight.*", F.coalesce("said", meta(F.col("m"), "og:description"), meta(F.col("m"), "description")).alias("Description"))
    p = p.withColumn("r", F.explode_outer("rows"))
    r, m = F.col("r"), F.col("m")
    option = lambda name: text.last_of_pairs(F.col("o"), "k", "v", name)
    listed = r.isNotNull()
    p = p.withColumns({
        "o": _labelled(r, OPTION_CELL, 2, 3, key_is_text=False),
        "stock": F.when(listed, text.once(text.first_group(r, STOCK_CELL, 2), lambda t: F.when(t.isNotNull(), text.untag(t)))).otherwise(F.when(F.col("sold_out"), F.lit(SOLD_OUT))),
    })
    left = F.when(listed, text.available_stock(F.col("stock"))).otherwise(F.when(F.col("sold_out"), F.lit(0).cast("bigint")))
    out = p.select(
        casts.to_int(F.when(listed, text.first_group(r, FORM_PRODUCT)).otherwise(F.col("page_product"))).alias("ProductId"),
        casts.to_int(text.first_group(r, FORM_VARIATION)).alias("VariationId"),
        "ProductName", "Sku", F.coalesce(meta(m, "og:url"), F.col("url")).alias("ProductLink"), F.col("url").alias("ProductUrl"),
        text.last_of_pairs(m, "k", "v", "og:url").alias("CanonicalUrl"),
        F.coalesce(text.blank_to_null(text.first_group(r, THUMBNAIL)), text.last_of_pairs(m, "k", "v", "og:image")).alias("ImageUrl"),
        "Description",
        text.first_of_pairs(F.col("links"), "k", "v", MANUFACTURERS).alias("ManufacturerName"),
        text.first_of_pairs(F.col("links"), "k", "v", PRODUCTS).alias("DiscTypeName"),
        option("Color").alias("ColorName"),
        F.coalesce(text.blank_to_null(option("Plastic")), option("Plastic-UK")).alias("PlasticName"),
        option("Stamp Foil").alias("StampFoil"), option("Weight").alias("Weight"), option("Scaled Weight").alias("ScaledWeight"),
        option("Flatness").alias("Flatness"), option("Stiffness").alias("Stiffness"),
        casts.to_float(F.when(listed, text.first_group(r, PRICE_CELL)).otherwise(meta(m, "product:price:amount"))).alias("StockPrice"),
        F.coalesce(meta(m, "product:price:currency"), F.lit("USD")).alias("Currency"),
        F.col("stock").alias("StockText"), left.alias("AvailableStock"), (left == 0).alias("IsOutOfStock"),
        text.first_group(r, ATTRIBUTE_JSON).alias("VariantAttributesJson"), "Speed", "Glide", "Turn", "Fade", at.alias("record_timestamp"),
    )
    escaped = "ProductName Sku ProductLink CanonicalUrl ImageUrl Description ManufacturerName DiscTypeName ColorName PlasticName StampFoil Weight ScaledWeight Flatness Stiffness StockText VariantAttributesJson"
    return _finished(out, schemas.TABLE_SHOP, escaped.split())


def option_shop(pages: DataFrame, at: Column) -> DataFrame:
    """Rows of pages (url, html): one for each option of the first group of options, else one without."""
    html, url = F.col("html"), F.col("url")
    p = usable(pages).withColumns({
        "m": meta_tags(html), "parts": urls.path_parts(url, SECTION), "plain": _labelled(html, PLAIN_FIELD, 1, 2),
        "label": F.when(html.rlike(ATTRIBUTE_BLOCK), text.untag(F.regexp_extract(html, ATTRIBUTE_BLOCK, 1))),
        "options": _labelled(F.regexp_extract(html, ATTRIBUTE_BLOCK, 2), OPTION, 1, 2, key_is_text=False),
        "stock": F.when(html.rlike(STOCK_LEVEL), text.untag(F.regexp_extract(html, STOCK_LEVEL, 2))),
        "level": F.lower(text.first_group(html, STOCK_LEVEL)),
    })
    p = p.withColumn("o", F.explode_outer("options"))
    m, parts = F.col("m"), F.col("parts")
    tag = lambda name: text.last_of_pairs(m, "k", "v", name)
    slug = lambda i, least: F.when(F.size(parts) >= least, F.get(parts, F.lit(i)))
    plain = [text.blank_to_null(text.last_of_pairs(F.col("plain"), "k", "v", f)) for f in WEIGHT_FIELDS]
    own = lambda pattern: text.blank_to_null(text.untag(text.first_group(html, pattern)))
    out = p.select(
        casts.to_int(text.first_group(html, OPTION_PRODUCT)).alias("ProductId"),
        F.coalesce(own(OPTION_TITLE), tag("og:title")).alias("ProductName"),
        F.coalesce(own(OPTION_SKU), tag("product:retailer_item_id")).alias("Sku"),
        F.when(tag("og:url").startswith("http"), tag("og:url")).otherwise(url).alias("ProductLink"),
        url.alias("ProductUrl"), tag("og:url").alias("CanonicalUrl"), tag("og:image").alias("ImageUrl"),
        F.coalesce(meta(m, "og:description"), tag("description")).alias("Description"), tag("product:availability").alias("Availability"),
        F.col("stock").alias("StockStatusText"),
        (F.col("level").contains("out-of-stock") | F.lower("stock").contains("out of stock")).alias("IsOutOfStock"),
        casts.to_float(tag("product:price:amount")).alias("ListPrice"), casts.to_float(tag("product:sale_price:amount")).alias("SalePrice"),
        tag("product:price:currency").alias("Currency"), casts.to_float(tag("product:weight:value")).alias("ProductWeightValue"),
        tag("product:weight:units").alias("ProductWeightUnits"), F.when(html.rlike(OPTION_WEIGHT), text.untag(F.regexp_extract(html, OPTION_WEIGHT, 1))).alias("ProductWeightText"),
        slug(0, 2).alias("ManufacturerSlug"), text.slug_title(slug(0, 2)).alias("ManufacturerName"),
        slug(1, 3).alias("PlasticSlug"), text.slug_title(slug(1, 3)).alias("PlasticName"),
        F.try_element_at(parts, F.lit(-1)).alias("ProductSlug"), urls.category_path(parts).alias("CategoryPath"),
        F.coalesce(*plain).alias("CatalogWeightSummary"), at.alias("record_timestamp"),
        F.when(F.col("o").isNotNull(), F.col("label")).alias("VariantLabel"), F.col("o.k").alias("VariantOptionId"), F.col("o.v").alias("VariantOptionLabel"),
        text.grams(F.col("o.v")).alias("VariantWeightGrams"),
    )
    escaped = "ProductName Sku ProductLink CanonicalUrl ImageUrl Description Availability StockStatusText Currency ProductWeightUnits ProductWeightText CatalogWeightSummary VariantLabel VariantOptionLabel"
    return _finished(out, schemas.OPTION_SHOP, escaped.split())


def page_links(
    pages: DataFrame, pattern: str = r'(?i)href="([^"]*)"', site: str | None = None, prefix: str = "/", assets: bool = True, positions: bool = False
) -> DataFrame:
    """url, link: what a crawler would follow from each page; with positions, pos of each among those of its row.

    Each link of a page once, also where several rows are of one page; with positions, once a row. With a site, only links on it whose path starts with prefix; without assets, no images, styles and the like.
    """

    def wanted(link: Column) -> Column:
        keep = link.isNotNull()
        keep = keep if site is None else keep & urls.in_section(link, site, prefix)
        return keep if assets else keep & ~urls.is_asset(link)

    links = F.array_distinct(F.filter(F.transform(text.all_groups(F.col("html"), pattern), lambda x: urls.crawl_link(x, F.col("url"))), wanted))
    if positions:
        return usable(pages).select("url", F.posexplode(links).alias("pos", "link"))
    return usable(pages).select("url", F.explode(links).alias("link")).distinct()


def is_product_page(html: Column) -> Column:
    return F.lower(html).contains('property="og:type" content="product"')
