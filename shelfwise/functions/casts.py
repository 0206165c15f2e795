"""Casts that give null, or a default, where a value doesn't fit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import present, trim


def to_int(c: Column) -> Column:
    """Whole numbers only: '12.5' is null."""
    return trim(c.cast("string")).try_cast("bigint")


def to_int_cut(c: Column) -> Column:
    """Any number, cut towards zero; NaN and infinities are null."""
    return to_float(c).try_cast("bigint")


def to_float(c: Column) -> Column:
    return trim(c.cast("string")).try_cast("double")


def safe_int(c: Column) -> Column:
    return F.coalesce(to_int_cut(c), F.lit(0).cast("bigint"))


def safe_float(c: Column) -> Column:
    return F.coalesce(to_float(c), F.lit(0.0))


def safe_string(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def safe_bool(c: Column) -> Column:
    """true for true, 1 and yes in any case; false for the rest, null too."""
    return F.coalesce(F.lower(trim(c.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def first_present(*columns: Column) -> Column:
    """The first value that isn't blank, trimmed."""
    return F.coalesce(*[present(c) for c in columns])


def any_present(*columns: Column) -> Column:
    return reduce(lambda a, b: a | b, [present(c).isNotNull() for c in columns])


def money_text(c: Column) -> Column:
    """A price as text with two decimals, the same for every way in which its number may be written."""
    return c.cast("decimal(18,2)").cast("string")
