"""Prices, ratings and counts in text.

Sellers write amounts differently, and each profile keeps its seller's reading,
literal faults included (``first_pair`` cuts 1.234,50 to 1234). A text without an
amount is 0, the value that the quality filter takes for unknown.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.functions.text import text


def number(c: Column) -> Column:
    """A plain decimal, else 0."""
    return F.coalesce(F.nullif(c, F.lit("")).try_cast("double"), F.lit(0.0))


def turkish(c: Column) -> Column:
    """1.234,50 as 1234.5: points group, the comma is decimal."""
    return number(F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))


def _found(c: Column, rule: str) -> Column:
    return F.regexp_extract_all(text(c), F.lit(rule), F.lit(0))


def _least(amounts: Column) -> Column:
    return F.coalesce(F.array_min(F.filter(amounts, lambda x: x > 0)), F.lit(0.0))


def comma_strip(c: Column) -> Column:
    """All digits and the first comma as the decimal point."""
    digits = F.regexp_replace(text(c), "[^0-9,]", "")
    return number(F.regexp_extract(F.regexp_replace(digits, "^([0-9]*),", "$1."), "^[0-9]*\\.?[0-9]*", 0))


def lira_anchored(c: Column) -> Column:
    """The first amount before TL or the lira sign."""
    return turkish(F.regexp_extract(text(c), "\\d[\\d.]*(?:,\\d+)?(?=\\s*(?:TL|₺))", 0))


def strict(c: Column) -> Column:
    """The whole text is an amount with two decimals."""
    return turkish(F.regexp_extract(F.trim(text(c)), "^[\\d.]+,\\d{2}$", 0))


def least_of_all(c: Column) -> Column:
    """The smallest of all amounts with two decimals that are plausible, else the first number."""
    amounts = F.transform(_found(c, "[\\d.]+,\\d{2}"), turkish)
    best = _least(F.filter(amounts, lambda x: x < 100000))
    return F.when(best > 0, best).otherwise(turkish(F.regexp_extract(text(c), "\\d[\\d.]*", 0)))


def first_pair(c: Column) -> Column:
    """The first two digit groups around a point or comma; the point is dropped and the comma decimal."""
    return turkish(F.regexp_extract(text(c), "\\d+[.,]\\d+", 0))


def lira_or_first(c: Column) -> Column:
    """The amount before TL, else the first number."""
    amount = F.regexp_extract(text(c), "([\\d.,]+)\\s*TL", 1)
    return turkish(F.when(F.length(amount) > 0, amount).otherwise(F.regexp_extract(text(c), "[\\d.,]+", 0)))


PROFILES: dict[str, Callable[[Column], Column]] = {
    "comma_strip": comma_strip,
    "lira_anchored": lira_anchored,
    "strict": strict,
    "least_of_all": least_of_all,
    "first_pair": first_pair,
    "lira_or_first": lira_or_first,
}


def least_positive(*amounts: Column) -> Column:
    """The smallest positive amount, else 0."""
    return _least(F.array(*(F.coalesce(a.cast("double"), F.lit(0.0)) for a in amounts)))


def minor_units(discounted: Column, normal: Column) -> Column:
    """An amount in hundredths: the discounted one if positive, else the normal one."""
    return F.coalesce(F.when(discounted > 0, discounted), normal, F.lit(0)) / 100.0


def two_decimals(c: Column) -> Column:
    """Rounded as binary doubles round: floor(100 x + 0.5) / 100."""
    return F.floor(c * 100 + 0.5) / 100.0


def one_decimal(c: Column) -> Column:
    return F.floor(c * 10 + 0.5) / 10.0


def least_of(amounts: Column) -> Column:
    """The smallest positive one of an array, else 0."""
    return _least(amounts)


def leading_number(c: Column) -> Column:
    """The plain decimal that a text begins with, else 0."""
    return number(F.regexp_extract(text(c), "^\\s*([0-9]+\\.?[0-9]*|\\.[0-9]+)", 1))


def rating_with_comma(c: Column) -> Column:
    """The first run of digits and commas, the first comma decimal; as it is."""
    return leading_number(F.regexp_replace(F.regexp_extract(text(c), "([0-9,]+)", 1), "^([0-9]*),", "$1."))


def rating_of_five(c: Column, exact: bool = False) -> Column:
    """The number in front with one decimal (or as it is); 0 above 5."""
    n = leading_number(c)
    return F.when((n > 0) & (n <= 5), n if exact else one_decimal(n)).otherwise(0.0)


def rating_of_percent(c: Column) -> Column:
    """The number in front, of a hundred, on the scale of five with one decimal."""
    return one_decimal(leading_number(c) / 20)


def rating_of_either(c: Column) -> Column:
    """The first run of digits and points: as it is up to 5, of a hundred above, 0 above that."""
    n = leading_number(F.regexp_extract(text(c), "([0-9.]+)", 1))
    return F.when(n <= 5, n).when(n <= 100, one_decimal(n / 20)).otherwise(0.0)


def count(c: Column) -> Column:
    """All digits of the text as one number, else 0."""
    return F.coalesce(F.nullif(F.regexp_replace(text(c), "[^0-9]", ""), F.lit("")).try_cast("long"), F.lit(0).cast("long"))


def plausible(c: Column, below: float = 50000.0) -> Column:
    return (c > 0) & (c < below)
