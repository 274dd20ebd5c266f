"""Landed files as DataFrames: offer arrays, maps, API pages, sitemaps and scripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom import schemas
from offerloom.functions import links, prices, text
from offerloom.sources import arrays


def exists(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system, whichever it is."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jvm_path)
    return found is not None and len(found) > 0


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def offer_array(spark: SparkSession, path: str, schema: str = schemas.OFFER) -> DataFrame:
    """Rows of a JSON array with ``pos``, their place in it; none from a file that is missing, empty, no array or broken.

    Files are read by ranges (``arrays.elements``), so a large one is many tasks' work.
    """
    if not exists(spark, path):
        return _empty(spark, schema + ", pos long")
    rows = arrays.elements(spark, path).select(F.from_json("body", f"struct<{_fields(schema)}>", {"mode": "PERMISSIVE"}).alias("o"), "pos")
    return rows.select("o.*", "pos")


def _fields(schema: str) -> str:
    return T._parse_datatype_string(schema).simpleString()[len("struct<") : -1]


def offers(spark: SparkSession, folder: str, sellers: dict[str, str]) -> dict[str, DataFrame]:
    """{seller: offers} for files of ``folder``."""
    return {seller: offer_array(spark, f"{folder}/{name}") for seller, name in sellers.items()}


def key_map(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of one JSON object of strings; nulls stay, as looked up and absent."""
    if not exists(spark, path):
        return _empty(spark, "key string, value string")
    body = spark.read.text(path, wholetext=True)
    return body.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))


def script_array(spark: SparkSession, path: str, schema: str, name: str = "products") -> DataFrame:
    """Rows of ``const NAME = [...];`` below comment lines. The script is read as text and never run."""
    body = F.regexp_extract(F.regexp_replace("value", "(?m)^//[^\\n]*\\n", ""), f"(?s)const\\s+{name}\\s*=\\s*(\\[.*\\])\\s*;?\\s*$", 1)
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json(body, f"array<struct<{_fields(schema)}>>")).alias("pos", "o"))
    return rows.select("o.*", "pos")


def script_header(spark: SparkSession, path: str) -> list[str]:
    """The comment lines that one script file begins with."""
    found = spark.read.text(path, wholetext=True).select(F.regexp_extract("value", "^((?://[^\\n]*\\n)*+)", 1).alias("h")).first()
    return found.h.split("\n")[:-1] if found else []


def search_pages(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Offers of search API pages, with the least positive of their four prices."""
    hit = bodies.select(*(c for c in bodies.columns if c != body), F.explode(F.from_json(body, schemas.SEARCH_PAGE)["product"]["hits"]["hits"]["_source"]).alias("h"))
    price = prices.least_positive(*(F.col(f"h.{c}") for c in ("special_price", "crm_price", "ross_60_price", "price")))
    return hit.select(*(c for c in bodies.columns if c != body), "h.name", "h.brand", "h.barcode", price.alias("price"), F.col("h.image").alias("imageUrl"), F.col("h.url_key").alias("productUrl"), F.col("h.rating").alias("rating"), F.col("h.review_count").alias("reviews"))


def search_total(body: Column) -> Column:
    return F.get_json_object(body, "$.product.hits.total.value").cast("long")


def search_held(body: Column) -> Column:
    """How many products a search page holds; 0 for a body that can't be read."""
    return F.coalesce(F.json_array_length(F.get_json_object(body, "$.product.hits.hits")), F.lit(0)).cast("long")


def detail_pages(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Offers of product-detail API bodies: attributes by key, the last non-empty value; prices in hundredths.

    Products out of stock, without a price or a name are left out.
    """
    rows = bodies.withColumn("_d", F.from_json(body, schemas.DETAIL_PAGE))
    value = lambda key: F.try_element_at(F.transform(F.filter("_d.product.attributes", lambda a: (a["key"] == key) & (F.length(a["value"]) > 0)), lambda a: a["value"]), F.lit(-1))
    price = prices.minor_units(F.col("_d.product.prices.discountedPrice"), F.col("_d.product.prices.normalPrice"))
    out = rows.select(
        *(c for c in bodies.columns if c != body),
        F.coalesce(value("name"), F.lit("")).alias("name"),
        F.coalesce(value("brand"), value("brandName"), F.lit("")).alias("brand"),
        F.coalesce(value("barcode"), F.lit("")).alias("barcode"),
        price.alias("price"),
        F.coalesce(F.get("_d.product.imageUrls", F.lit(0))["fileUrl"], F.lit("")).alias("imageUrl"),
        F.coalesce("_d.reviewAverage", F.lit(0.0)).alias("rating"),
        F.coalesce("_d.reviewCount", F.lit(0)).alias("reviews"),
        F.col("_d.product.stockStatus").alias("_stock"),
    )
    return out.filter((F.coalesce("_stock", F.lit("")) != "OUT_OF_STOCK") & (F.col("price") > 0) & (F.col("name") != "")).drop("_stock")


def sitemap(bodies: DataFrame, categories: dict[str, str] | None = None, body: str = "body") -> DataFrame:
    """(url, segment, product_id, category) of the ``loc`` entries with a product number; of mapped first segments only, if given."""
    urls = bodies.select(F.explode(F.regexp_extract_all(body, F.lit("<loc>\\s*([^<]*?)\\s*</loc>"), F.lit(1))).alias("url"))
    rows = urls.select("url", links.first_segment(F.col("url")).alias("segment"), links.product_number(F.col("url")).alias("product_id")).filter("product_id != ''")
    if categories is None:
        return rows.withColumn("category", F.col("segment"))
    known = F.create_map(*(F.lit(x) for pair in categories.items() for x in pair))
    return rows.withColumn("category", F.element_at(known, F.col("segment"))).filter("category IS NOT NULL")


def page_state(pages: DataFrame, variable: str, schema: str, html: str = "html") -> DataFrame:
    """``state``: the JSON object that a page's script assigns to ``variable``, which is a pattern; null without one.

    The parser stops where the object ends, so what follows it doesn't matter, and
    ``};</script>`` within a string doesn't end it. Of an object that is cut off, or
    isn't JSON, all fields that couldn't be read are null.
    """
    raw = F.regexp_extract(html, f"(?s){variable}\\s*=\\s*(\\{{.*)", 1)
    return pages.withColumn("state", F.from_json(F.when(raw != "", raw), schema))


def state_pages(pages: DataFrame, variable: str, html: str = "html") -> DataFrame:
    """``n_pages`` and ``products`` of the product list in a page's state; one page where it states no number, null without a list."""
    listed = F.col("state.components")["product-list"]
    found = page_state(pages, variable, schemas.PRODUCT_LIST, html)
    n_pages = F.when(listed.isNotNull(), F.coalesce(F.nullif(listed["pagination"]["totalPages"], F.lit(0)), F.lit(1)))
    return found.withColumns({"n_pages": n_pages, "products": F.when(listed.isNotNull(), F.coalesce(listed["products"], F.array()))}).drop("state")


def state_products(listed: DataFrame, image_base: str, page_base: str) -> DataFrame:
    """Offers of ``state_pages``, whose other columns they keep: products that can be bought, with a name, an address and a price above 0."""
    keep = [c for c in listed.columns if c not in ("products", "n_pages")]
    p = lambda c: F.col(f"_p.{c}")
    based = lambda url, base: F.when(url == "", "").when(url.startswith("http"), url).otherwise(F.concat(F.lit(base), url))
    text_of = lambda c: F.coalesce(c, F.lit(""))
    rows = listed.select(*keep, F.posexplode("products").alias("place", "_p")).select(
        *keep,
        "place",
        text_of(p("code")).alias("code"),
        text.strip(text_of(p("name"))).alias("name"),
        F.coalesce(p("price.value"), F.lit(0.0)).alias("price"),
        based(F.substring_index(text_of(p("picture.url")), "?", 1), image_base).alias("imageUrl"),
        based(text_of(p("url")), page_base).alias("productUrl"),
        F.coalesce(p("averageRating"), F.lit(0.0)).alias("rating"),
        F.coalesce(p("numberOfReviews"), F.lit(0)).alias("reviews"),
        F.coalesce(p("purchasable"), F.lit(True)).alias("_can"),
    )
    return rows.filter("_can AND name <> '' AND price > 0 AND productUrl <> ''").drop("_can")


def inline_barcode(html: Column) -> Column:
    return F.regexp_extract(text.text(html), '"barcode":"?(\\d{8,14})"?', 1)


def response_barcode(detail: Column, other: Column) -> Column:
    """The barcode of a product's landed responses: of the detail body, whose product lies below ``result`` or at the top; the other endpoint's only where there is no detail body that can be read.

    Empty where neither has one. Numbers count as their digits.
    """
    first = lambda body, *paths: F.coalesce(*(F.nullif(text.strip(F.get_json_object(body, p)), F.lit("")) for p in paths))
    of = lambda root: [f"{root}.product.{x}" for x in ("variants[0].barcode", "variants[0].gtin", "barcode", "gtin")]
    below = F.get_json_object(detail, "$.result").isNotNull()
    found = F.when(below, first(detail, *of("$.result"))).otherwise(first(detail, *of("$")))
    return F.coalesce(F.when(F.get_json_object(detail, "$").isNotNull(), found).otherwise(first(other, "$.result.variants[0].barcode", "$.result.variants[0].gtin")), F.lit(""))


def first_filled(*candidates: Column) -> Column:
    """The first candidate that isn't empty."""
    return F.coalesce(*(F.nullif(text.strip(c), F.lit("")) for c in candidates), F.lit(""))


def product_image(images: Column, gallery: Column, picture: Column) -> Column:
    """The url of the primary image (by its type or as the first of the gallery), of the first one if none is; where it has none the gallery's first, or the picture; null without any."""
    primary = F.get(F.filter(images, lambda i: (i["imageType"] == "PRIMARY") | (i["galleryIndex"] == 0)), F.lit(0))
    url = F.when(primary.isNotNull(), primary["url"]).otherwise(F.get(images, F.lit(0))["url"])
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in (url, F.get(gallery, F.lit(0))["url"], picture)))
