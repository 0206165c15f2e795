"""Keys and hashes of variants, and JSON in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.casts import first_present
from shelfwise.functions.text import blank_to_null, present, trim


def json_hash(columns: dict[str, Column]) -> Column:
    """SHA-256 of the columns as JSON in the order given, nulls kept: null and blank differ."""
    return F.sha2(F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()]), {"ignoreNullFields": "false"}), 256)


def shop_variant_id(store: Column, store_url: Column, variant_id: Column, own_id: Column, product_id: Column) -> Column:
    """Store and the first id that isn't blank. A blank store is kept, a null one falls back."""
    return shop_id(store, store_url, first_present(variant_id, own_id, product_id))


def shop_id(store: Column, store_url: Column, key: Column) -> Column:
    shop = F.lower(trim(F.coalesce(store.cast("string"), store_url.cast("string"), F.lit("unknown-store"))))
    return F.concat(F.lit("shopify:"), shop, F.lit(":"), key)


def content_variant_id(store: Column, store_url: Column, link: Column, title: Column, variant: Column, weight: Column) -> Column:
    """A hash of what a variant is, without price and stock, so that it stays the same when those move."""
    shop = F.lower(trim(F.coalesce(store.cast("string"), store_url.cast("string"), F.lit("infinitediscs"))))
    some = lambda c: F.coalesce(present(c), F.lit(""))
    return json_hash({
        "source": F.lit("infinite"), "store": shop, "product_link": some(link), "title": some(title),
        "variant_title": some(variant), "weight_g": some(weight),
    })


def tags_json(tags: Column) -> Column:
    """A list of tags as JSON; a missing one as an empty list."""
    return F.to_json(F.coalesce(tags, F.array().cast("array<string>")))


def parse_tags(c: Column) -> Column:
    """Tags of a JSON list, or of a list with commas; null and blank give none. Null members are dropped."""
    text = trim(c)
    listed = F.when(text.startswith("[") & text.endswith("]"), F.from_json(text, "array<string>"))
    split = F.filter(F.transform(F.split(text, ","), trim), lambda t: t != "")
    none = F.array().cast("array<string>")
    return F.when(blank_to_null(text).isNull(), none).otherwise(F.filter(F.coalesce(listed, split), lambda t: t.isNotNull()))


def batch_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
