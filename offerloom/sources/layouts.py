"""Offers in sellers' result pages, by declared layouts.

A layout says what makes a card and which elements a field is read from, in the order
of preference; the reading gives every candidate as a text. What a seller makes of the
candidates (the first plausible price, the last name tried) are Spark columns over the
cards of a page, which stay one row until they are done: no shuffle keeps the first of
equal cards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions import links, prices, text
from offerloom.sources.selectors import Page, Selectors, parsed


@dataclass(frozen=True)
class Read:
    """Candidates of a field: of each selector the first element's (or ``every`` one's) first filled attribute, the text if the name is empty.

    They are looked for below the card, below its first ``inside`` element or in the
    ``anchor`` that the card was found by; ``own`` reads that itself, and ``around`` its
    nearest such ancestor. Values longer than ``most`` are left out unread.
    """

    selectors: tuple[str, ...] = ()
    attributes: tuple[str, ...] = ("",)
    every: bool = False
    inside: str = ""
    anchor: bool = False
    own: bool = False
    around: str = ""
    most: int | None = None

    def values(self, page: Page, card: int, anchor: int) -> list[str]:
        at: int | None = anchor if self.anchor or self.own else card
        if self.inside:
            at = page.first(self.inside, at)
        if at is not None and self.around:
            at = page.closest(self.around, at)
        if at is None:
            return []
        if self.own or self.around:
            return [page.read(at, self.attributes)]
        found = [i for s in self.selectors if page.found[s] for i in (page.all(s, at) if self.every else [page.first(s, at)]) if i is not None]
        if not found:
            return []
        if self.most is not None:
            found = [i for i in found if sum(map(len, page.pieces[page.elements[i].text_from : page.elements[i].text_to])) <= 2 * self.most]
        out = [page.read(i, self.attributes) for i in found]
        return [v for v in out if self.most is None or len(v) <= self.most]


@dataclass(frozen=True)
class Up:
    """The card of an anchor: itself, its nearest ``closest`` (or parent, or itself with ``stay``), its ``nth`` ancestor, or the last element below a list of several ``cards``."""

    closest: str = ""
    stay: bool = False
    nth: int = 0
    below_list: str = ""

    def card(self, page: Page, at: int) -> int | None:
        parent = lambda i: page.elements[i].parent
        if self.closest:
            found = page.closest(self.closest, at)
            return found if found is not None else at if self.stay else parent(at) if parent(at) >= 0 else None
        for _ in range(self.nth):
            up = parent(at)
            if up < 0:
                break
            if self.below_list and page.elements[up].children > 3 and len(page.all(self.below_list, up)) > 1:
                break
            at = up
        return at

    @property
    def selectors(self) -> tuple[str, ...]:
        return tuple(s for s in (self.closest, self.below_list) if s)


@dataclass(frozen=True)
class Layout:
    """``anchors``: of these selectors the first that any element fits; ``others`` with their own way up if none does."""

    origin: str
    anchors: tuple[str, ...]
    fields: dict[str, Read]
    shape: Callable[[Column, str], dict[str, Column]]
    up: Up = Up()
    others: tuple[str, Up] | None = None

    def selectors(self) -> Selectors:
        reads = [s for r in self.fields.values() for s in (*r.selectors, r.inside, r.around) if s]
        return Selectors([*self.anchors, *self.up.selectors, *reads, *((self.others[0], *self.others[1].selectors) if self.others else ())])

    def cards(self, page: Page) -> list[tuple[int, int]]:
        """(card, anchor), in order."""
        for anchor in self.anchors:
            if at := page.all(anchor):
                return [(c, a) for a in at if (c := self.up.card(page, a)) is not None]
        if not self.others:
            return []
        found = {c: a for a in reversed(page.all(self.others[0])) if (c := self.others[1].card(page, a)) is not None}
        return sorted(found.items(), key=lambda x: x[1])


OFFER = ("name", "brand", "price", "imageUrl", "productUrl", "rating", "reviews", "barcode")


def offers_of(pages: DataFrame, layout: Layout, key: str, html: str = "html") -> DataFrame:
    """(key, pos, name, brand, price, imageUrl, productUrl, rating, reviews, barcode): the offers of each page in order.

    A page that is null, empty or of another layout gives none. A seller's shape tells
    besides what makes two cards one (``unique``; the first counts, with an empty one none) and which are offers (``keep``).
    """
    names, selectors = list(layout.fields), layout.selectors()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for html in frame["html"]:
                page = parsed(html, selectors)
                rows.append([{n: layout.fields[n].values(page, card, anchor) for n in names} for card, anchor in layout.cards(page)])
            yield pd.DataFrame({key: frame[key], "cards": rows})

    kind = pages.schema[key].dataType.simpleString()
    raw = pages.select(key, F.col(html).alias("html")).mapInPandas(run, f"{key} {kind}, cards array<struct<{','.join(f'{n}:array<string>' for n in names)}>>")
    shaped = F.transform("cards", lambda c: F.struct(*(v.alias(n) for n, v in layout.shape(c, layout.origin).items())))
    rows = raw.select(key, shaped.alias("cards"))
    if "unique" in layout.shape(F.lit(None), layout.origin):
        keys = F.transform("cards", lambda c: c["unique"])
        first = F.filter("cards", lambda c, i: (c["unique"] != "") & (F.array_position(F.col("_keys"), c["unique"]) == i + 1))
        rows = rows.withColumn("_keys", keys).select(key, first.alias("cards"))
    return rows.select(key, F.posexplode(F.filter("cards", lambda c: c["keep"])).alias("pos", "c")).select(key, "pos", *(F.col(f"c.{n}").alias(n) for n in OFFER))


# what sellers make of candidates -------------------------------------------


def first(values: Column) -> Column:
    """The first candidate, empty without any."""
    return F.coalesce(F.get(values, F.lit(0)), F.lit(""))


def first_that(values: Column, ok: Callable[[Column], Column], otherwise: Column | None = None) -> Column:
    return F.coalesce(F.get(F.filter(values, ok), F.lit(0)), F.lit("") if otherwise is None else otherwise)


def last(values: Column) -> Column:
    return F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit(""))


def first_price(values: Column, parse: Callable[[Column], Column], below: float | None = None) -> Column:
    """The first candidate's price that is positive (and below a limit), else 0."""
    amounts = F.transform(values, parse)
    return F.coalesce(F.get(F.filter(amounts, lambda x: (x > 0) & (x < below) if below else x > 0), F.lit(0)), F.lit(0.0))


def _offer(name: Column, url: Column, price: Column, keep: Column, brand: Column | None = None, image: Column | None = None, rating: Column | None = None, reviews: Column | None = None, barcode: Column | None = None, unique: Column | None = None) -> dict[str, Column]:
    blank, zero = F.lit(""), F.lit(0.0)
    out = {"name": name, "brand": blank if brand is None else brand, "price": price, "imageUrl": blank if image is None else image, "productUrl": url, "rating": zero if rating is None else rating}
    out |= {"reviews": F.lit(0).cast("long") if reviews is None else reviews, "barcode": blank if barcode is None else barcode, "keep": keep}
    return out | ({} if unique is None else {"unique": unique})


def _amazon(c: Column, origin: str) -> dict[str, Column]:
    code, raw = first(c["code"]), links.absolute(first(c["link"]), origin)
    target = F.when(raw.contains("/sspa/click") & (links.unwrapped(raw) != raw), links.absolute(links.unwrapped(raw), origin)).otherwise("")
    url = F.when(target != "", target).when(raw.contains("/dp/"), raw).otherwise(F.concat(F.lit(f"{origin}/dp/"), code))
    name, price = first(c["name"]), prices.comma_strip(first(c["price"]))
    return _offer(name, url, price, (name != "") & (price > 0), image=links.absolute(first(c["image"]), origin), rating=prices.rating_with_comma(first(c["rating"])), reviews=prices.count(first(c["reviews"])), unique=code)


def _gratis(c: Column, origin: str) -> dict[str, Column]:
    names = F.transform(c["name"], text.squeezed)
    found = first_that(names, lambda n: (F.length(n) > 3) & (F.length(n) < 200) & ~n.contains("TL"))
    name = F.when(found != "", found).otherwise(F.when(first(c["title"]) != "", first(c["title"])).otherwise(text.squeezed(first(c["label"]))))
    brand = first_that(F.transform(c["brand"], text.squeezed), lambda b: (F.length(b) > 1) & (F.length(b) < 80))
    price = first_price(F.filter(c["amounts"], lambda t: t.contains("TL") & (F.length(t) < 30)), prices.comma_strip, 50000.0)
    image = first_that(F.transform(c["images"], lambda u: links.absolute(u, origin)), lambda u: (u.contains("gratis") | u.contains("cdn") | u.startswith("http")) & ~u.contains("data:image"), first(c["source"]))
    href = first(c["href"])
    url = F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(origin), F.when(href.startswith("/"), "").otherwise("/"), href))
    return _offer(name, url, price, F.length(name) >= 3, brand, image, prices.rating_of_five(first(c["rating"])), prices.count(first(c["reviews"])), unique=links.product_number(href))


def _hepsiburada(c: Column, origin: str) -> dict[str, Column]:
    hrefs = F.transform(c["links"], lambda u: links.absolute(u, origin))
    url = first_that(hrefs, lambda u: u.contains("hepsiburada.com") & ~u.contains("adservice") & ~u.contains("/ara?"))
    name = text.squeezed(first(c["name"]))
    price = prices.least_of(F.transform(c["prices"], lambda t: prices.first_pair(F.regexp_replace(t, f"[{text.SPACE}]+", ""))))
    return _offer(name, links.without_query(url), price, name != "", first(c["brand"]), links.absolute(first(c["image"]), origin), prices.rating_of_five(F.replace(first(c["rating"]), F.lit(","), F.lit(".")), exact=True), unique=links.without_query(url))


def _idefix(c: Column, origin: str) -> dict[str, Column]:
    link = F.when(F.size(c["product"]) > 0, first(c["product"])).otherwise(first(c["page"]))
    url = links.without_fragment(links.absolute(link, origin))
    name, price = first(c["name"]), first_price(c["prices"], prices.strict)
    # a name that is too short makes no card, so it doesn't count as the first of its url
    return _offer(name, url, price, price > 0, last(c["brand"]), links.absolute(first(c["image"]), origin), unique=F.when(F.length(name) >= 5, F.when(link != "", url).otherwise("")).otherwise(""))


def _linked(c: Column, origin: str, parse: Callable[[Column], Column]) -> tuple[Column, ...]:
    url = links.absolute(first(c["href"]), origin)
    name = F.when(first(c["name"]) != "", first(c["name"])).otherwise(first(c["label"]))
    price = first_price(F.filter(c["prices"], lambda t: t.rlike("[0-9]")), parse, 100000.0)
    unique = F.when(F.length(first(c["href"])) >= 10, links.without_query(url)).otherwise("")
    return name, url, price, (F.length(name) >= 5) & (price > 0), links.absolute(first(c["image"]), origin), unique


def _least_or_digits(t: Column) -> Column:
    amounts = F.transform(F.regexp_extract_all(t, F.lit(r"[\d.]+,\d{2}"), F.lit(0)), prices.turkish)
    best = prices.least_of(F.filter(amounts, lambda x: x < 100000))
    return F.when(best > 0, best).otherwise(prices.comma_strip(t))


def _pazarama(c: Column, origin: str) -> dict[str, Column]:
    name, url, price, keep, image, unique = _linked(c, origin, _least_or_digits)
    return _offer(name, url, price, keep, first(c["brand"]), image, barcode=links.product_barcode(url), unique=unique)


def _pttavm(c: Column, origin: str) -> dict[str, Column]:
    name, url, price, keep, image, unique = _linked(c, origin, prices.comma_strip)
    return _offer(name, url, price, keep, image=image, unique=unique)


def _trendyol(c: Column, origin: str) -> dict[str, Column]:
    name, brand, price = first(c["name"]), first(c["brand"]), first_price(c["prices"], prices.lira_anchored)
    shown = F.when(name != "", name).otherwise(brand)
    return _offer(shown, links.absolute(first(c["href"]), origin), price, (shown != "") & (price > 0), brand, links.absolute(first(c["image"]), origin), prices.leading_number(F.replace(first(c["rating"]), F.lit(","), F.lit("."))), prices.count(first(c["reviews"])))


def _sephora(c: Column, origin: str) -> dict[str, Column]:
    name, url = text.squeezed(first(c["name"])), links.absolute(first(c["href"]), origin)
    return _offer(name, url, prices.comma_strip(first(c["price"])), (name != "") & (url != ""), first(c["brand"]), links.absolute(first(c["image"]), origin), prices.rating_of_percent(first(c["rating"])), prices.count(first(c["reviews"])))


def _watsons(c: Column, origin: str) -> dict[str, Column]:
    names, brands = F.transform(c["name"], text.squeezed), F.transform(c["brand"], text.squeezed)
    name, brand = first_that(names, lambda n: F.length(n) > 2, last(names)), first_that(brands, lambda b: F.length(b) > 1, last(brands))
    url = links.absolute(first_that(c["href"], lambda u: u != ""), origin)
    image = first_that(c["image"], lambda u: (u != "") & ~u.contains("placeholder") & ~u.startswith("data:"), last(c["image"]))
    rating = F.coalesce(F.get(F.filter(F.transform(c["rating"], prices.rating_of_either), lambda r: r > 0), F.lit(0)), F.lit(0.0))
    reviews = F.regexp_extract(first_that(c["reviews"], lambda t: t.rlike("[0-9]")), "([0-9]+)", 1)
    return _offer(F.when(name != "", name).otherwise("Bilinmeyen Urun"), url, first_price(c["price"], prices.lira_or_first), (name != "") | (url != ""), brand, image, rating, F.coalesce(reviews.try_cast("long"), F.lit(0).cast("long")))


#: How sellers' result pages name their elements.
_PRODUCT_LINK = 'a[href*="-p-"]'
_CONTAINER = '[class*="product"], [class*="card"], [class*="item"], li, article'

LAYOUTS: dict[str, Layout] = {
    "Amazon": Layout(
        "https://www.amazon.com.tr",
        ('[data-component-type="s-search-result"]',),
        {
            "code": Read(attributes=("data-asin",), own=True),
            "name": Read(("span",), inside="h2"),
            "link": Read(attributes=("href",), inside="h2", around="a"),
            "image": Read(("img.s-image",), ("src",)),
            "price": Read((".a-price .a-offscreen",)),
            "rating": Read((".a-icon-alt",)),
            "reviews": Read((".a-size-base.s-underline-text",)),
        },
        _amazon,
    ),
    "Gratis": Layout(
        "https://www.gratis.com",
        (_PRODUCT_LINK,),
        {
            "href": Read(attributes=("href",), own=True),
            "title": Read(attributes=("title",), own=True),
            "label": Read(own=True),
            "name": Read(("h2", "h3", "h4", '[class*="product-name"]', '[class*="productName"]', '[class*="product-title"]', '[class*="productTitle"]', '[class*="name"]', '[class*="title"]', "span", "p")),
            "brand": Read(('[class*="brand"]', '[class*="Brand"]', '[class*="marka"]')),
            "amounts": Read(("*",), every=True, most=29),
            "images": Read(("img",), ("data-src", "data-lazy", "src"), every=True),
            "source": Read(("picture source",), ("srcset",)),
            "rating": Read(('[class*="rating"], [class*="star"], [data-rating]',), ("data-rating", "")),
            "reviews": Read(('[class*="review"], [class*="comment"]',)),
        },
        _gratis,
        Up(nth=6, below_list=_PRODUCT_LINK),
    ),
    "Hepsiburada": Layout(
        "https://www.hepsiburada.com",
        ("article",),
        {
            "links": Read(("a[href]",), ("href",), every=True),
            "name": Read(('h2, h3, [data-test-id*="title"], [class*="title"]',)),
            "brand": Read(('[class*="brand"], [data-test-id*="brand"]',)),
            "prices": Read(('[data-test-id*="price"], [class*="price"], [class*="Price"]',), every=True),
            "image": Read(('img[src*="productimages"], img[src*="hbcdn"], img[src]',), ("src",)),
            "rating": Read(('[class*="rating"], [class*="star"], [aria-label*="puan"]',)),
        },
        _hepsiburada,
    ),
    "Idefix": Layout(
        "https://www.idefix.com",
        ("h3",),
        {
            "name": Read(own=True),
            "brand": Read(('span[class*="font-semibold"]',), every=True, anchor=True),
            "product": Read((_PRODUCT_LINK,), ("href",)),
            "page": Read(('a[href*="idefix.com/"]',), ("href",)),
            "prices": Read(('[class*="text-neutral-1000"]',), every=True),
            "image": Read(("img",), ("src", "data-src")),
        },
        _idefix,
        Up(nth=4),
    ),
    "Pazarama": Layout(
        "https://www.pazarama.com",
        (_PRODUCT_LINK,),
        {
            "href": Read(attributes=("href",), own=True),
            "label": Read(own=True),
            "name": Read(('h2, h3, h4, [class*="name"], [class*="title"], [class*="Name"], [class*="Title"]',)),
            "brand": Read(('[class*="brand"], [class*="Brand"]',)),
            "prices": Read(('[class*="price"], [class*="Price"], [class*="fiyat"]',), every=True),
            "image": Read(("img",), ("src", "data-src")),
        },
        _pazarama,
        Up(closest=_CONTAINER),
    ),
    "PttAvm": Layout(
        "https://www.pttavm.com",
        (_PRODUCT_LINK,),
        {
            "href": Read(attributes=("href",), own=True),
            "label": Read(own=True),
            "name": Read(('h2, h3, h4, [class*="name"], [class*="title"]',)),
            "prices": Read(('[class*="price"], [class*="Price"], [class*="fiyat"]',), every=True),
            "image": Read(("img",), ("src", "data-src")),
        },
        _pttavm,
        Up(closest=_CONTAINER),
    ),
    "Trendyol": Layout(
        "https://www.trendyol.com",
        ("a.product-card",),
        {
            "href": Read(attributes=("href",), own=True),
            "name": Read((".product-name",)),
            "brand": Read((".product-brand",)),
            "prices": Read((".discounted-price .price-value", ".sale-price", ".single-price", ".price-value")),
            "image": Read(('img.image, img[src*="cdn.dsmcdn"]',), ("src",)),
            "rating": Read((".average-rating",)),
            "reviews": Read((".total-count",)),
        },
        _trendyol,
    ),
    "Sephora": Layout(
        "https://www.sephora.com.tr",
        (".grid-tile",),
        {
            "name": Read((".product-title, .name",)),
            "brand": Read((".product-brand",)),
            "href": Read(('a.product-tile-link, a[href*="/p/"]',), ("href",)),
            "image": Read(("img.product-first-img",), ("src",)),
            "price": Read((".price-sales-standard, .product-min-price",)),
            "rating": Read((".product-rating-wrapper",), ("data-rating",)),
            "reviews": Read(('.product-rating-count, [class*="rating-count"]',)),
        },
        _sephora,
    ),
    "Watsons": Layout(
        "https://www.watsons.com.tr",
        (".product-card", ".product-item", ".productCard", ".product-list-item", ".product__item", ".product-tile", ".grid-tile", ".plp-card", "[data-product]", ".product-box", ".search-product-card", 'li[class*="product"]', 'div[class*="ProductCard"]', 'div[class*="product-card"]', 'a[class*="product"]'),
        {
            "name": Read((".product-name", ".product-title", ".productName", ".product__name", ".name", "h3", "h2", '[class*="productName"]', '[class*="product-name"]', '[class*="ProductName"]', '[class*="title"]', "a[title]"), ("title", "")),
            "brand": Read((".product-brand", ".brand", ".productBrand", '[class*="brand"]', '[class*="Brand"]', ".product__brand", ".manufacturer")),
            "href": Read(('a[href*="/p/"]', 'a[href*="/product/"]', 'a[href*="/urun/"]', "a.product-link", "a.product-tile-link", "a"), ("href",)),
            "image": Read(('img[src*="product"]', "img[data-src]", "img.product-image", "img.lazyload", 'img[class*="product"]', "img"), ("src", "data-src", "data-lazy-src", "data-original")),
            "price": Read((".product-price", ".price", ".productPrice", ".price-sales", '[class*="price"]', '[class*="Price"]', ".product__price", ".sale-price", ".current-price")),
            "rating": Read(('[class*="rating"]', '[class*="star"]', "[data-rating]"), ("data-rating", "aria-label", "")),
            "reviews": Read(('[class*="review-count"]', '[class*="reviewCount"]', '[class*="rating-count"]', ".reviews")),
        },
        _watsons,
        others=('a[href*="/p/"], a[href*="/product/"], a[href*="/urun/"]', Up(closest="div, li, article", stay=True)),
    ),
}


# product pages ---------------------------------------------------------------

#: Where product pages hold codes, brands, texts and shades.
_DETAIL = {
    "rows": Read(('tr, [class*="spec"] div, [class*="detail"] li',), every=True),
    "meta": Read(('meta[itemprop="gtin13"], meta[property="product:ean"]',), ("content",)),
    "brand": Read(('[class*="brand"], [itemprop="brand"]',)),
    "desc": Read(('.product-description-content, [itemprop="description"], .description-content',)),
    "image": Read((".product-primary-image img, .primary-image, .product-image-container img",), ("src",)),
    "size": Read(('.product-size, [class*="size"]',)),
    "links": Read(("a",), every=True, inside=".product-variations"),
    "items": Read((".product-variations li[data-value], .product-variations li[data-attr-value]",), ("data-value", "data-attr-value"), every=True),
    "labels": Read((".product-variations button[aria-label], .product-variations [title]",), ("aria-label", "title"), every=True),
    "selected": Read((".variations-shade-selected, .selected-shade, .shade-name",)),
    "scripts": Read(('script[type="application/ld+json"]',), every=True),
}


#: What codes and brands are made of, and details and shades.
CODES = ("rows", "meta", "brand", "scripts")
DETAILS = ("visible", "desc", "image", "size", "links", "items", "labels", "selected")


def detail_elements(pages: DataFrame, key: str, html: str = "html", names: tuple[str, ...] = ("visible", *_DETAIL)) -> DataFrame:
    """(key, visible string, and an array of texts for each element that product pages are read by), of these ``names`` only: what nobody asks for isn't looked for."""
    reads = {n: _DETAIL[n] for n in names if n != "visible"}
    selectors = Selectors(s for r in reads.values() for s in (*r.selectors, r.inside) if s)
    kinds = {n: "string" if n == "visible" else "array<string>" for n in names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string() if n == "visible" else pa.list_(pa.string()) for n in names]
        for batch in batches:
            found: dict[str, list] = {n: [] for n in names}
            for html in batch.column(1).to_pylist():
                page = parsed(f"<html>{html or ''}", selectors)
                if "visible" in found:
                    found["visible"].append(page.visible())
                for n, read in reads.items():
                    found[n].append(read.values(page, 0, 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[n], t) for n, t in zip(names, types, strict=True))], [key, *names])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, F.col(html).alias("html")).mapInArrow(run, f"{key} {kind}, " + ", ".join(f"{n} {k}" for n, k in kinds.items()))


def _filled(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull() & (v != ""))


def page_barcode() -> Column:
    """Of ``detail_elements``: the last of gtin13 and gtin of linked data; else what the meta tag holds; else the code in the last specification row that names one."""
    linked = _filled(F.flatten(F.transform("scripts", lambda s: F.array(F.get_json_object(s, "$.gtin13"), F.get_json_object(s, "$.gtin")))))
    named = F.filter("rows", lambda r: r.rlike("(?i)barkod|barcode|ean|gtin") & r.rlike("[0-9]{8,14}"))
    row = F.coalesce(F.regexp_extract(F.try_element_at(named, F.lit(-1)), "([0-9]{8,14})", 1), F.lit(""))
    return F.coalesce(F.try_element_at(linked, F.lit(-1)), F.get("meta", F.lit(0)), row)


def page_brand() -> Column:
    """Of ``detail_elements``: the last brand name of linked data, else the text of the first element that is named so."""
    linked = _filled(F.transform("scripts", lambda s: F.get_json_object(s, "$.brand.name")))
    return F.coalesce(F.try_element_at(linked, F.lit(-1)), F.get("brand", F.lit(0)), F.lit(""))


def page_details() -> dict[str, Column]:
    """Of ``detail_elements``: desc (400 characters at most), imageUrl, vegan, crueltyFree and size."""
    seen = F.lower(F.col("visible"))
    return {
        "desc": F.substring(text.squeezed(first(F.col("desc"))), 1, 400),
        "imageUrl": first(F.col("image")),
        "vegan": seen.contains("vegan"),
        "crueltyFree": seen.contains("cruelty-free") | seen.contains("hayvanlarda test edilmez"),
        "size": first(F.col("size")),
    }


def page_shades() -> Column:
    """Of ``detail_elements``: the shades by links, then by list values, then by labels, each once; the selected one only where there are none. Sizes in brackets go after that."""
    fits = lambda s: (F.length(s) > 1) & (F.length(s) < 80)
    labels = F.transform("labels", lambda s: text.strip(F.regexp_replace(s, f"(?i)^(?:Seçili[{text.SPACE}]+)?renk:[{text.SPACE}]*", "")))
    listed = F.array_distinct(F.concat(F.filter("links", fits), F.filter("items", lambda s: s != ""), F.filter(labels, fits)))
    chosen = F.when(F.size(listed) > 0, listed).otherwise(F.filter(F.slice("selected", 1, 1), fits))
    return F.filter(F.transform(chosen, lambda s: text.strip(F.regexp_replace(s, f"(?i)[{text.SPACE}]*\\([0-9]+[{text.SPACE}]*(?:ml|g|oz)\\)", ""))), lambda s: F.length(s) > 0)
