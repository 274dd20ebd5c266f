"""Landed pages of paged sources: which of them a walk from the first page reads, and what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets that one window looks at; a key of any number of pages is spread over its spans.
SPAN = 1 << 16


def walked(pages: DataFrame, key: str, start: str, held: str, total: str, step: int, first: int = 0) -> DataFrame:
    """The pages that a walk of each key reads: from ``first`` on in steps of ``step``, up to a page that is missing, holds nothing or states no total, and below the total that the page before states.

    ``held`` is a page's number of products. Of pages landed twice the one that holds more
    counts, then the larger total; which of equal ones is left open. Offsets that no step reaches, and
    the page that ends a walk, aren't returned. A page is held against the one before it by an equi-join on key and
    offset, so no key is one task's, and only numbers move but for the last semi-join.
    Keys and offsets that are null are read by no walk.
    """
    at, value = F.col(start).cast("long"), F.struct(F.coalesce(F.col(held).cast("long"), F.lit(0)).alias("n"), F.col(total).cast("long").alias("t"))
    numbers = pages.filter((at >= first) & ((at - first) % step == 0)).groupBy(F.col(key).alias("_key"), at.alias("_at")).agg(F.max(value).alias("_v"))
    going = (F.col("_v.n") > 0) & F.col("_v.t").isNotNull()
    before = numbers.filter(going).select(F.col("_key").alias("_bk"), (F.col("_at") + step).alias("_ba"), F.col("_v.t").alias("_bt"))
    led = numbers.join(before, (F.col("_key") == F.col("_bk")) & (F.col("_at") == F.col("_ba")), "left")
    follows = (F.col("_at") == first) | F.coalesce(F.col("_bt") > F.col("_at") - first, F.lit(False))
    ends = led.groupBy(F.col("_key").alias("_ek")).agg(F.min(F.when(~(going & follows), F.col("_at"))).alias("_end"))
    reached = led.join(ends, F.col("_key") == F.col("_ek")).filter(F.col("_end").isNull() | (F.col("_at") < F.col("_end"))).select("_key", "_at", "_v")
    # the numbers are compared by order, as the join's keys are then those of the next step, and pages move once
    return pages.join(reached, (F.col(key) == F.col("_key")) & (at == F.col("_at")) & (value >= F.col("_v")), "left_semi").dropDuplicates([key, start])


def gaps(pages: DataFrame, key: str, start: str, held: str, total: str, span: int = SPAN) -> DataFrame:
    """(key, from, to): the ranges [from, to) of what each key's pages state in total and none of them holds.

    A page holds [start, start + held). The total is the one that the last page states
    (the largest, if the last one landed twice); without one nothing is known to be missing
    behind the last page. Offsets are looked at in spans: within one by a window, and each span
    learns how far the spans before it reach from a row a span. Null keys and offsets take no part.
    """
    zero = F.lit(0).cast("long")
    at, n = F.col(start).cast("long"), F.coalesce(F.col(held).cast("long"), zero)
    rows = pages.select(F.col(key).alias("_key"), at.alias("_at"), (at + n).alias("_to"), F.col(total).cast("long").alias("_t")).filter("_key IS NOT NULL AND _at IS NOT NULL")
    last = F.max_by("_t", F.when(F.col("_t").isNotNull(), F.struct("_at", "_t")))
    ends = rows.groupBy("_key").agg(F.max(F.when(F.col("_to") > F.col("_at"), F.col("_to"))).alias("_most"), last.alias("_total"))
    filled = rows.filter("_to > _at").withColumn("_span", F.floor(F.col("_at") / span))
    earlier = Window.partitionBy("_key").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = filled.groupBy("_key", "_span").agg(F.max("_to").alias("_max")).select("_key", "_span", F.max("_max").over(earlier).alias("_carry"))
    near = Window.partitionBy("_key", "_span").orderBy("_at", "_to").rowsBetween(Window.unboundedPreceding, -1)
    inner = filled.join(spans, ["_key", "_span"]).select("_key", F.greatest(F.max("_to").over(near), "_carry", zero).alias("from"), F.col("_at").alias("to"))
    # a gap can't go on behind the total
    within = inner.join(ends.select("_key", "_total"), "_key").select("_key", "from", F.least("to", F.coalesce("_total", "to")).alias("to"))
    return within.union(ends.select("_key", F.greatest(F.coalesce("_most", zero), zero), "_total")).filter("from < to").select(F.col("_key").alias(key), "from", "to")


def complete(pages: DataFrame, key: str, start: str, held: str, total: str) -> DataFrame:
    """A row a key: ``n_pages``, ``n_held`` (products of all pages), ``total`` as the last page states it, ``n_missing`` and whether nothing is missing of a total that is known."""
    stated = pages.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("n_pages"),
        F.coalesce(F.sum(F.col(held).cast("long")), F.lit(0)).alias("n_held"),
        F.max_by(F.col(total).cast("long"), F.when(F.col(total).isNotNull(), F.struct(F.col(start).cast("long"), F.col(total).cast("long")))).alias("_total"),
    )
    missing = gaps(pages, key, start, held, total).groupBy(F.col(key).alias("_gk")).agg(F.sum(F.col("to") - F.col("from")).alias("_missing"))
    out = stated.join(missing, F.col(key) == F.col("_gk"), "left").withColumn("n_missing", F.coalesce("_missing", F.lit(0)))
    return out.select(key, "n_pages", "n_held", F.col("_total").alias("total"), "n_missing", (F.col("_total").isNotNull() & (F.col("n_missing") == 0)).alias("complete"))
