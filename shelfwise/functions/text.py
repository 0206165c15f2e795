"""Text functions over columns. Native but for unescape(), which is one Arrow batch call."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), with c evaluated once however often use refers to it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


#: White space in Unicode.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def trim(c: Column) -> Column:
    """Without white space of any kind at both ends; SQL's trim only knows the space."""
    return F.btrim(c, F.lit(WHITE))


def present(c: Column) -> Column:
    """The trimmed value, or null if nothing is left."""
    return F.nullif(trim(c.cast("string")), F.lit(""))


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return trim(F.regexp_replace(c, r"(?U)\s+", " "))


def untag(c: Column) -> Column:
    """Tags become spaces, white space is collapsed; null gives an empty text. Character references stay."""
    return collapse(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "))


def unescape(c: Column) -> Column:
    """Character references decoded. Spark has no function for that."""

    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return decode(c)


def strip_html(c: Column) -> Column:
    """untag(), then unescape(): an escaped tag ends up as text that looks like one."""
    return unescape(untag(c))


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without a match, empty if the group is. The pattern must not look around itself or match nothing."""
    return once(F.regexp_extract(c, pattern, 0), lambda found: F.when(found != "", F.regexp_extract(found, pattern, group)))


def all_groups(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def numeric_token(c: Column) -> Column:
    """The first signed decimal number, as text."""
    return blank_to_null(F.regexp_extract(c, r"-?\d+(?:\.\d+)?", 0))


def available_stock(c: Column) -> Column:
    """0 for what is sold out, else the first number cut to a whole one, else null."""
    sold_out = F.lower(c).contains("out of stock") | F.lower(c).contains("sold out")
    return F.when(c != "", F.when(sold_out, F.lit(0).cast("long")).otherwise(numeric_token(c).try_cast("double").try_cast("long")))


def grams(c: Column) -> Column:
    """`175`, `173-175` or `170+` before a g."""
    return first_group(F.lower(c), r"(\d+(?:-\d+)?\+?)\s*g")


def slug_words(c: Column) -> Column:
    return present(F.replace(c, F.lit("-"), F.lit(" ")))


def slug_title(c: Column) -> Column:
    """Words of a slug with a capital first letter each and the rest in lower case."""
    return F.initcap(collapse(slug_words(c)))


def first_of_pairs(pairs: Column, key: str, value: str, fragment: str) -> Column:
    """value of the first struct whose key contains fragment."""
    return F.get(F.filter(pairs, lambda p: p[key].contains(fragment)), F.lit(0))[value]


def last_of_pairs(pairs: Column, key: str, value: str, name: str) -> Column:
    """value of the last struct whose key is name: what a map that is filled in order holds."""
    return F.try_element_at(F.filter(pairs, lambda p: p[key] == name), F.lit(-1))[value]


def search_text(parts: list[Column], tags: Column) -> Column:
    """Parts and tags that aren't blank, joined by spaces, lower-cased."""
    return F.lower(F.concat_ws(" ", *[blank_to_null(p) for p in parts], blank_to_null(F.array_join(tags, " "))))


def shortened(c: Column, most: int) -> Column:
    return F.substring(c, 1, most)
