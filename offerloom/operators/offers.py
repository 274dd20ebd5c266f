"""Offers of all sellers: order, normal form, quality filter, and de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.functions import dictionaries as d
from offerloom.functions import links, text
from offerloom.operators.distinct import of_distinct


def union_sources(offers: dict[str, DataFrame] | DataFrame, order: tuple[str, ...] = d.SELLERS) -> DataFrame:
    """All offers with ``site``, ``source_rank`` and ``idx``, a number that follows (source_rank, pos).

    Offers come as a frame for each seller, or as one with ``site``, which is read
    once. ``pos`` is an offer's place in its seller's file. ``idx`` packs both and needs no
    sort: order is all that later steps take from it. Sellers that ``order`` doesn't name come last.
    """
    ranks = {s: i for i, s in enumerate(order)}
    if isinstance(offers, DataFrame):
        known = F.create_map(*(F.lit(x) for pair in ranks.items() for x in pair))
        every = offers.withColumn("source_rank", F.coalesce(F.element_at(known, F.col("site")), F.lit(len(ranks))))
    else:
        parts = [df.withColumns({"site": F.lit(s), "source_rank": F.lit(ranks.get(s, len(ranks) + i))}) for i, (s, df) in enumerate(offers.items())]
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.withColumn("idx", F.shiftleft(F.col("source_rank").cast("long"), 52) + F.col("pos"))


def _normal_names(names: DataFrame) -> DataFrame:
    name = F.when(F.col("name").startswith("*"), text.strip(F.regexp_replace("name", r"^\*+", ""))).otherwise(text.text(F.col("name")))
    trimmed = text.strip(F.regexp_replace(text.strip(F.regexp_replace(name, f"^\\+\\d+[{text.SPACE}]*", "")), f"[{text.SPACE}]*\\(\\d+\\)[{text.SPACE}]*$", ""))
    rows = names.withColumn("raw_name", F.col("name")).withColumn("name", F.when(F.col("_gratis"), trimmed).otherwise(name))
    blank = F.length(text.strip(F.col("brand"))) == 0
    rows = rows.withColumn("_found", F.when(blank, text.brand_in_name(F.col("name"))).otherwise(""))
    rows = rows.withColumn("name", text.name_without(F.col("name"), F.col("_found")))
    rows = rows.withColumn("brand", F.when(blank, F.when(F.col("_found") != "", F.col("_found")).otherwise(text.brand_of_line(F.col("name")))).otherwise(F.col("brand")))
    category = text.category_by_name(F.col("raw_name"), text.category_name(F.col("category")))
    rows = rows.withColumns({"brand": text.brand_shown(F.col("brand")), "category": category}).drop("_found")
    return rows.withColumn("categoryLabel", text.lookup(F.col("category"), d.LABEL_OF_CATEGORY, text.category_label(F.col("categoryLabel"))))


def normalised(offers: DataFrame, barcodes: DataFrame | None = None, site: str = "Trendyol") -> DataFrame:
    """Brand, name, category, label and barcode in normal form; ``raw_name`` keeps the name.

    ``barcodes`` (id, code) overrides the barcode of an offer of ``site`` where it has one for the offer's id.
    """
    flagged = offers.withColumn("_gratis", F.coalesce(F.col("site") == "Gratis", F.lit(False)))
    rows = of_distinct(flagged, ["_gratis", "name", "brand", "category", "categoryLabel"], _normal_names).drop("_gratis").withColumn("barcode", F.coalesce("barcode", F.lit("")))
    if barcodes is None:
        return rows
    known = barcodes.filter(F.length("code") > 0).groupBy(F.col("id").cast("string").alias("_id")).agg(F.max("code").alias("_code"))
    keyed = rows.withColumn("_id", F.when(F.col("site") == site, F.col("id").cast("string")))
    return keyed.join(known, "_id", "left").withColumn("barcode", F.coalesce("_code", "barcode")).drop("_id", "_code")


def _word(rule: str) -> str:
    return r"\b" + rule + r"\b"


def reject_reasons(name: Column, brand: Column, price: Column, reviews: Column) -> dict[str, Column]:
    """The quality rules in order; a row goes if any holds. A missing price or count breaks no rule."""
    n = text.strip(name)
    m = lambda rule: text.matches(n, rule)
    quote, product, combined = "['’]?", "(?:maskara|ruj|far)", "(?:kalemli|hediyeli|kremli)"
    return {
        "price_low": F.coalesce(price < 5, F.lit(False)),
        "name_short": F.length(n) < 5,
        "card_price": m(r"^gratis\s+kart\s+ile\b"),
        "count_only": m(r"^\d+\s+(?:tür|renk|çeşit|adet|tip)$"),
        "no_brand_short": (F.length(text.strip(brand)) == 0) & (F.length(n) < 10),
        "store_brand": F.lower(text.text(brand)).rlike(text.alternatives(d.STORE_WORDS)),
        "catalogue": m(text.alternatives(d.CATALOGUE_WORDS)),
        "catalogue_title": m(r"\d{4}\s*\|") | m(r"\|\s*trendyol"),
        "banner": m(text.alternatives(d.BANNER_WORDS)),
        "reviews_high": F.coalesce(reviews > 50000, F.lit(False)),
        "gift": m(text.alternatives(d.GIFT_WORDS)),
        "multi_set": m(rf"\b\d{quote}l[iıuü]\s*(?:set|paket)\b"),
        "multi_mascara": m(rf"\b\d{quote}l[iıuü]\s*maskara\b"),
        "combo_before": m(rf"\b{combined}\s+{product}\b"),
        "combo_after": m(rf"\b{product}\s+{combined}\b"),
        "combo_pencil": m(r"göz\s*kalemli\s"),
        "price_high": F.coalesce(price > 10000, F.lit(False)),
        "car": m(_word(text.alternatives(d.CAR_WORDS))),
        "other_goods": m(_word(text.alternatives(d.OTHER_GOODS))),
        "clothes": m(_word(text.alternatives(d.CLOTHES))),
        "with_gift": m(r"&.*hediye\b") | m(r"&.*\bset\b"),
        "name_long": F.length(n) > 120,
    }


#: The rules that read more than an offer's name and brand.
ROW_RULES = ("price_low", "reviews_high", "price_high")


def with_reject_reason(offers: DataFrame, name: str = "name", brand: str = "brand", price: str = "price", reviews: str = "reviews") -> DataFrame:
    """Adds ``reject_reason``: the first rule that rejects, null if none. Rules of names run once a distinct name and brand."""
    of = lambda p, r: list(reject_reasons(F.col(name), F.col(brand), p, r).items())
    first = lambda rules: F.coalesce(*(F.when(c, i) for i, c in rules))
    named = [(i, c) for i, (k, c) in enumerate(of(F.lit(None).cast("double"), F.lit(None).cast("long"))) if k not in ROW_RULES]
    own = [(i, c) for i, (k, c) in enumerate(of(F.col(price), F.col(reviews))) if k in ROW_RULES]
    rows = of_distinct(offers, [name, brand], lambda names: names.withColumn("_rule", first(named)))
    reasons = F.array(*(F.lit(k) for k, _ in of(F.col(price), F.col(reviews))))
    return rows.withColumn("reject_reason", F.get(reasons, F.least("_rule", first(own)))).drop("_rule")


def quality_filter(offers: DataFrame, **columns: str) -> DataFrame:
    return with_reject_reason(offers, **columns).filter("reject_reason IS NULL").drop("reject_reason")


def keep_first(rows: DataFrame, keys: list[str], idx: str = "idx", blank: str = "group") -> DataFrame:
    """The first row of each key. Rows with a blank first key are one group, dropped ("drop") or all kept ("keep").

    An aggregate finds the places and a semi-join takes the rows, so a hot key
    meets as partial minima and wide rows are never gathered by key.
    """
    empty = F.length(F.coalesce(F.col(keys[0]).cast("string"), F.lit(""))) == 0
    some = rows.filter(~empty) if blank != "group" else rows
    first = some.groupBy(*keys).agg(F.min(idx).alias(idx)).select(idx)
    kept = some.join(first, idx, "left_semi")
    return kept.unionByName(rows.filter(empty)) if blank == "keep" else kept


def keep_cheapest(rows: DataFrame, keys: list[str], price: str = "price", idx: str = "idx") -> DataFrame:
    """The cheapest row of each key, the first on a tie, at the place (``first_idx``) of the key's first row."""
    best = rows.groupBy(*keys).agg(F.min(F.struct(price, idx)).alias("_b"), F.min(idx).alias("first_idx"))
    return rows.join(best.select(F.col("_b")[idx].alias(idx), "first_idx"), idx)


def todo(rows: DataFrame, done: DataFrame, key: str, value: str | None = None) -> DataFrame:
    """Rows that a checkpoint doesn't have: by key, or with ``value`` by keys that have one (nulls are tried again)."""
    seen = done if value is None else done.filter(F.col(value).isNotNull() & (F.col(value).cast("string") != ""))
    return rows.join(seen.select(key).distinct(), key, "left_anti")


def filled(rows: DataFrame, known: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``out`` from a checkpoint's non-empty ``value``, else as it was; every row stays."""
    table = known.filter(F.length(F.col(value).cast("string")) > 0).select(F.col(key), F.col(value).alias("_v")).dropDuplicates([key])
    old = F.col(out) if out in rows.columns else F.lit(None)
    return rows.join(table, key, "left").withColumn(out, F.coalesce("_v", old)).drop("_v")


def union_options(rows: DataFrame, shades: DataFrame, key: str, at_least: int = 1) -> DataFrame:
    """``shadeOptions`` joined with a checkpoint's shades, where it has ``at_least`` of them."""
    table = shades.filter(F.size("shades") >= at_least).select(F.col(key), F.col("shades").alias("_s"))
    old = F.coalesce(F.col("shadeOptions"), F.array().cast("array<string>")) if "shadeOptions" in rows.columns else F.array().cast("array<string>")
    return rows.join(table, key, "left").withColumn("shadeOptions", F.array_union(old, F.coalesce("_s", F.array().cast("array<string>")))).drop("_s")


def seller_options(rows: DataFrame, shades: DataFrame, seller: str = "sephora", at_least: int = 2, key: str = "key", url: str = "productUrl", id_col: str = "id", source: str = "source") -> DataFrame:
    """``shadeOptions`` of one seller's products joined with a checkpoint (key, shades) by url, else by id, where that holds ``at_least`` shades.

    An entry by url counts even if it has too few: the id is tried only where the url
    is unknown. Products of other sellers stay as they are, and so do those that gain none.
    """
    none = F.array().cast("array<string>")
    table = shades.select(F.col(key).cast("string").alias("_k"), F.coalesce("shades", none).alias("_s")).groupBy("_k").agg(F.max("_s").alias("_s"))
    by = lambda c, n: table.select(F.col("_k").alias(f"_{n}k"), F.col("_s").alias(f"_{n}s"))
    old = F.coalesce("shadeOptions", none) if "shadeOptions" in rows.columns else none
    own = F.coalesce(F.col(source) == seller, F.lit(False))
    keyed = rows.withColumns({"_uk": F.when(own, F.col(url)), "_ik": F.when(own, F.col(id_col).cast("string"))})
    both = keyed.join(by(url, "u"), "_uk", "left").join(by(id_col, "i"), "_ik", "left")
    found = F.coalesce("_us", "_is")
    grown = F.array_union(old, found)
    return both.withColumn("shadeOptions", F.when((F.size(found) >= at_least) & (F.size(grown) > F.size(old)), grown).otherwise(old)).drop("_uk", "_ik", "_us", "_is")


def kept_pages(rows: DataFrame, groups: list[str], page: str, key: str, least_new: float = 0.2) -> DataFrame:
    """Rows of the pages that an adaptive crawl reads.

    After the first page, one with no new keys or less than ``least_new`` of them
    is the last that is read. Pages are counted by their first sight of keys; the
    running flag goes over one row a page.
    """
    first = rows.groupBy(*groups, key).agg(F.min(page).alias("first_page"))
    new = first.groupBy(*groups, F.col("first_page").alias(page)).agg(F.count("*").alias("n_new"))
    pages = rows.groupBy(*groups, page).agg(F.count_distinct(key).alias("n_keys")).join(new, [*groups, page], "left")
    pages = pages.withColumn("stops", (F.col(page) > 1) & (F.coalesce("n_new", F.lit(0)) < least_new * F.col("n_keys")) | (F.col(page) > 1) & F.col("n_new").isNull())
    before = Window.partitionBy(*groups).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    read = pages.withColumn("over", F.coalesce(F.max("stops").over(before), F.lit(False))).filter("NOT over")
    return rows.join(read.select(*groups, page, "n_keys", F.coalesce("n_new", F.lit(0)).alias("n_new"), "stops"), [*groups, page])


def with_sign(rows: DataFrame, category: str = "category", out: str = "emoji") -> DataFrame:
    return rows.withColumn(out, text.lookup(F.col(category), d.CATEGORY_SIGNS, F.lit(d.OTHER_SIGN)))


def by_url_category(rows: DataFrame, url: str = "productUrl") -> DataFrame:
    """Rows that aren't make-up by their url, with the ``category`` that it tells; rows that it tells none of are left out."""
    make_up = F.greatest(*(F.coalesce(F.col(url).contains(x), F.lit(False)) for x in d.MAKE_UP_URLS))
    return rows.filter(~make_up).withColumn("category", links.category_of(F.col(url), d.URL_CATEGORIES)).filter("category != ''")


def with_code_in(rows: DataFrame, codes: DataFrame, url: str = "productUrl") -> DataFrame:
    """Rows whose url has one of ``codes`` (code)."""
    return rows.withColumn("_code", links.product_code(F.col(url))).join(codes.select(F.col("code").alias("_code")).distinct(), "_code", "left_semi").drop("_code")


def first_pages(rows: DataFrame, most: int, page: str = "page") -> DataFrame:
    return rows.filter(F.col(page) <= most)


def top_rows(rows: DataFrame, keys: list[str], most: int, idx: str = "idx") -> DataFrame:
    """The first ``most`` rows of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(idx))
    return rows.withColumn("_n", rank).filter(F.col("_n") <= most).drop("_n")


def looks_missing(body: Column, status: Column) -> Column:
    """Whether a landed page is an error page: by status (403, 404, 500 and above), by what it says, or by a 404 in a text under 2,000 characters."""
    code, said = F.coalesce(status, F.lit(200)), F.lower(text.text(body))
    return code.isin(403, 404) | (code >= 500) | said.contains("sayfa bulunamadi") | said.contains("page not found") | said.contains("404") & (F.length(said) < 2000)


def alternative_paths(name: Column, label: Column) -> Column:
    """Paths that a category is tried at when its own one is missing, in order."""
    encoded = F.url_encode(text.text(label))
    for escaped, plain in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(escaped), F.lit(plain))
    return F.array(F.concat(F.lit("/c/"), name), F.concat(F.lit("/search?q="), encoded), F.concat(F.lit("/makyaj/c/003?q=%3Arelevance%3Acategory%3A"), name))


def first_working(attempts: DataFrame, key: str, order: str, body: str = "body", status: str = "status") -> DataFrame:
    """The first landed attempt of each key that is no error page; keys without one are left out.

    Partial minima meet by key and a semi-join takes the rows, so pages move once.
    """
    good = attempts.filter(~looks_missing(F.col(body), F.col(status)))
    first = good.groupBy(key).agg(F.min(order).alias(order))
    return good.join(first, [key, order], "left_semi")
