"""Text to typed values. Spark 4 casts raise on bad text, so every parser here yields null instead."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: characters of a money text, and of a list text
MONEY_SIGNS = "$,"
LIST_SIGNS = '\\]["'


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_to_double(c: str | Column) -> Column:
    """Drop ``$`` and ``,`` and read the rest as a number."""
    return F.translate(as_col(c), MONEY_SIGNS, "").try_cast("double")


def strip_currency(c: str | Column) -> Column:
    return F.regexp_replace(as_col(c), "[$,]", "")


def parse_money(c: str | Column) -> Column:
    """Keep digits and dots only. A minus sign is lost; see ``parse_money_signed``."""
    return F.regexp_replace(as_col(c).cast("string"), "[^0-9.]", "").try_cast("double")


def parse_money_signed(c: str | Column) -> Column:
    """As ``parse_money`` but ``-$5.00`` stays negative."""
    text = as_col(c).cast("string")
    return F.when(F.ltrim(text).startswith("-"), -parse_money(text)).otherwise(parse_money(text))


def tf_equal(c: str | Column) -> Column:
    """``t`` is true, null stays null, any other text is false."""
    return as_col(c) == "t"


def tf_bool(c: str | Column) -> Column:
    """``t``/``f`` in any case; any other text is null."""
    text = F.lower(as_col(c).cast("string"))
    return F.when(text == "t", True).when(text == "f", False)


def tf_int(c: str | Column) -> Column:
    """``t`` is 1, ``f`` is 0, any other text is null."""
    return F.when(as_col(c) == "t", 1).when(as_col(c) == "f", 0)


def leading_number(c: str | Column) -> Column:
    """The first blank-separated token as a number."""
    return F.get(F.split(as_col(c), " "), F.lit(0)).try_cast("double")


def bathrooms(c: str | Column) -> Column:
    """Bathroom count of a text such as ``1.5 shared baths``; a half bath has no number and is 0.5."""
    half = F.when(F.lower(as_col(c)).contains("half-bath"), F.lit(0.5))
    return F.coalesce(leading_number(c), half)


def parse_list(c: str | Column, trim: bool = False, drop_empty: bool = False) -> Column:
    """Text such as ``["Wifi", "TV"]`` as an array. Items keep a leading blank unless ``trim``."""
    items = F.split(F.translate(as_col(c), LIST_SIGNS, ""), ",")
    if trim:
        items = F.transform(items, lambda item: F.trim(item))
    if drop_empty:
        items = F.filter(items, lambda item: F.trim(item) != "")
    return items


def safe_date(c: str | Column) -> Column:
    """Date of a text, null where it is none."""
    return as_col(c).try_cast("date")
