"""Offers in landed pages: linked data first, cards of the markup where there is none."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom import schemas

LINKED = "(?is)<script[^>]*application/ld\\+json[^>]*>(.*?)</script>"


def linked_data(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row a JSON-LD script, in ``body``; broken ones are left to the reader of the body."""
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, F.posexplode(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINKED), F.lit(1))).alias("script", "body"))


def item_lists(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, name, imageUrl, productUrl, price) of ItemList entries; an entry is its ``item`` or itself."""
    entries = linked_data(pages.select(key, html), html).select(key, F.from_json("body", schemas.ITEM_LIST).alias("l")).filter("l.`@type` = 'ItemList'").select(key, F.explode("l.itemListElement").alias("e"))
    of = lambda f: F.coalesce(F.col(f"e.item.{f}"), F.when(F.col("e.item").isNull(), F.col(f"e.{f}")))
    price = F.coalesce(F.col("e.item.offers.price"), F.col("e.item.offers.lowPrice"), F.col("e.offers.price"), F.col("e.offers.lowPrice"), F.lit(0.0))
    return entries.select(key, of("name").alias("name"), of("image").alias("imageUrl"), of("url").alias("productUrl"), (F.floor(price * 100 + 0.5) / 100.0).alias("price")).filter((F.col("price") > 0) & F.col("name").isNotNull())


def with_fallback(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """``first``, and the rows of ``second`` for keys that ``first`` has none of."""
    return first.unionByName(second.join(first.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def variants(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, name, url, image, price): variants of products in linked data, the first of each name."""
    rows = linked_data(pages.select(key, html), html).select(key, "script", F.posexplode(F.from_json("body", schemas.VARIANTS)["hasVariant"]).alias("pos", "v"))
    first = rows.groupBy(key, F.col("v.name").alias("name")).agg(F.min_by("v", F.struct("script", "pos")).alias("v"), F.min(F.struct("script", "pos")).alias("at"))
    return first.select(key, "name", F.col("v.url").alias("url"), F.col("v.image").alias("image"), F.coalesce("v.offers.price", F.lit(0.0)).alias("price"), "at").drop("at")


@dataclass(frozen=True)
class Cards:
    """How a seller's result page lays out offers.

    ``card`` and the candidates of ``fields`` are (tag, class part, attribute):
    an empty tag or part fits all, an empty attribute means the text. A field
    takes its first candidate that isn't empty.
    """

    card: tuple[str, str]
    fields: dict[str, tuple[tuple[str, str, str], ...]] = field(default_factory=dict)


class _Tree(HTMLParser):
    """Elements of a page in order, each with its range of following elements and texts."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements: list[list] = []  # tag, attributes, texts, end
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs):
        self.elements.append([tag, {k: v or "" for k, v in attrs}, [], None])
        if tag not in self.VOID:
            self.open.append(len(self.elements) - 1)

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.elements[self.open[at]][0] == tag:
                for i in self.open[at:]:
                    self.elements[i][3] = len(self.elements)
                del self.open[at:]
                return

    def handle_data(self, data):
        for i in self.open:
            self.elements[i][2].append(data)


def _fits(element: list, tag: str, part: str) -> bool:
    return (not tag or element[0] == tag) and (not part or part in element[1].get("class", ""))


def cards_of(page: str, layout: Cards) -> list[dict[str, str]]:
    tree = _Tree()
    tree.feed(page or "")
    out, n = [], len(tree.elements)
    for i, e in enumerate(tree.elements):
        if not _fits(e, *layout.card):
            continue
        inside = tree.elements[i : e[3] if e[3] is not None else n]
        row = {}
        for name, candidates in layout.fields.items():
            values = (" ".join("".join(x[2]).split()) if not a else x[1].get(a, "") for t, c, a in candidates for x in inside if _fits(x, t, c))
            row[name] = next((v for v in values if v), "")
        out.append(row)
    return out


def cards(pages: DataFrame, layout: Cards, key: str, html: str = "html") -> DataFrame:
    """(key, card, fields as strings): offers in the markup of each page."""
    names = list(layout.fields)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(k, i, *(r[n] for n in names)) for k, page in zip(frame[key], frame[html]) for i, r in enumerate(cards_of(page, layout))]
            yield pd.DataFrame(rows, columns=[key, "card", *names])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, ", ".join([f"{key} {kind}", "card int", *(f"{n} string" for n in names)]))
