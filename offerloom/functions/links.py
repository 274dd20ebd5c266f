"""URLs of offers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.functions.text import text


def without_query(url: Column) -> Column:
    return F.regexp_replace(text(url), "\\?.*$", "")


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(text(url), "#.*$", "")


def without_ref(url: Column) -> Column:
    return F.regexp_replace(text(url), "/ref=.*$", "")


def clean(url: Column) -> Column:
    """The key that offers of one product page share: no query, fragment or referrer."""
    return without_ref(without_query(without_fragment(url)))


def unwrapped(url: Column) -> Column:
    """The target of a redirect's ``url`` parameter, decoded; else the url."""
    target = F.regexp_extract(text(url), "[?&]url=([^&#]+)", 1)
    return F.when(F.length(target) > 0, F.coalesce(F.try_url_decode(target), target)).otherwise(text(url))


def absolute(url: Column, origin: str) -> Column:
    return F.when(text(url).startswith("/"), F.concat(F.lit(origin), url)).otherwise(text(url))


def product_number(url: Column) -> Column:
    return F.regexp_extract(text(url), "-p-(\\d+)", 1)


def product_barcode(url: Column) -> Column:
    return F.regexp_extract(without_query(url), "-p-(\\d{8,13})$", 1)


def product_code(url: Column) -> Column:
    return F.regexp_extract(text(url), "/p/(\\d+)", 1)


def first_segment(url: Column) -> Column:
    return F.regexp_extract(text(url), "://[^/?#]*/([^/?#]*)", 1)


def category_of(url: Column, parts: dict[str, str], otherwise: str = "") -> Column:
    """The category of the first part (in order) that the url contains."""
    chain = F.lit(otherwise)
    for part, category in reversed(parts.items()):
        chain = F.when(text(url).contains(part), category).otherwise(chain)
    return chain
