"""Registered queries of rules on hand-made cases, one for each branch, and of landed bodies made from the driver's tables.

What a case gives is written down by hand, so the SQL shares no pattern and no table with the code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.functions import links, prices, text
from offerloom.operators import offers, robots
from offerloom.plans.samples import pick, sql_pick, table
from offerloom.queries import query
from offerloom.sources import landed, markup, sinks

#: Offers (name, brand, price, reviews) with the rule that rejects each, empty if none.
JUDGED = (
    ("Mat Ruj Koyu", "Flormar", "4.99", "10", "price_low"),
    ("Mat Ruj Koyu", "Flormar", "5", "10", ""),
    ("Ruj", "Flormar", "50", "10", "name_short"),
    ("Gratis Kart ile Allık", "Flormar", "50", "10", "card_price"),
    ("12 renk", "Flormar", "50", "10", "count_only"),
    ("Pudra 01", "", "50", "10", "no_brand_short"),
    ("Pudra 01", "Flormar", "50", "10", ""),
    ("Kirpik Serumu", "Süper Market", "50", "10", "store_brand"),
    ("Ruj Yorumlar ve Renkler", "Flormar", "50", "10", "catalogue"),
    ("Maskara 2024 | Flormar", "Flormar", "50", "10", "catalogue_title"),
    ("Yeni Sezonu Keşfet", "Flormar", "50", "10", "banner"),
    ("Mat Likit Ruj", "Flormar", "50", "50001", "reviews_high"),
    ("Mat Likit Ruj", "Flormar", "50", "50000", ""),
    ("Parfüm Kofre 50 ml", "Flormar", "50", "10", "gift"),
    ("3'lü Paket Oje", "Flormar", "50", "10", "multi_set"),
    ("2'li Maskara", "Flormar", "50", "10", "multi_mascara"),
    ("Kalemli Ruj Pembe", "Flormar", "50", "10", "combo_before"),
    ("Maskara Hediyeli Siyah", "Flormar", "50", "10", "combo_after"),
    ("Göz Kalemli Palet", "Flormar", "50", "10", "combo_pencil"),
    ("Altın Kapaklı Krem", "Flormar", "10000.5", "10", "price_high"),
    ("Altın Kapaklı Krem", "Flormar", "10000", "10", ""),
    ("Passat Ayna Kapağı", "Flormar", "50", "10", "car"),
    ("Renkli Havlu Takımı", "Flormar", "50", "10", "other_goods"),
    ("Siyah Pantolon Dar", "Flormar", "50", "10", "clothes"),
    ("Ruj & Kalem Set", "Flormar", "50", "10", "with_gift"),
    ("Mat Ruj " + "a" * 113, "Flormar", "50", "10", "name_long"),
    ("Mat Ruj " + "a" * 112, "Flormar", "50", "10", ""),
)


def _column(cases: tuple[tuple[str, ...], ...], i: int) -> tuple[str, ...]:
    return tuple(c[i] for c in cases)


def _numbers(cases: tuple[tuple[str, ...], ...], i: int) -> str:
    """SQL of a picked number; an empty text is null."""
    return f"TRY_CAST(nullif({sql_pick(_column(cases, i), 'p_partkey')}, '') AS DOUBLE)"


def _cases(spark: SparkSession, sf_dir: str, cases: tuple[tuple[str, ...], ...], *names: str) -> DataFrame:
    """(part, names): the cases in turn over the parts."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(key.alias("part"), *(pick(_column(cases, i), key).alias(n) for i, n in enumerate(names)))


@query(f"SELECT p_partkey AS part, nullif({sql_pick(_column(JUDGED, 4), 'p_partkey')}, '') AS reject_reason FROM part")
def q45_every_quality_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _cases(spark, sf_dir, JUDGED, "name", "brand", "price", "reviews")
    rows = rows.withColumns({"price": F.col("price").cast("double"), "reviews": F.col("reviews").cast("long")})
    return offers.with_reject_reason(rows).select("part", "reject_reason")


#: Fixed values: (name, brand, the name for comparison, the name that is shown, the brand in front, the name without it).
NAMED = (
    ("*Flormar  Velvet Glow 6 ml", "Flormar", "velvet glow 6", "* Velvet Glow 6 ml", "", "*Flormar  Velvet Glow 6 ml"),
    ("Flormar Lip Stick No 12", "Flormar", "lipstick 12", "Lip Stick No 12", "Flormar", "Lip Stick No 12"),
    ("NYX Professional Makeup Glow Up", "NYX Professional Makeup", "glow up", "Glow Up", "NYX Professional Makeup", "Glow Up"),
    ("Glow NYX Professional Makeup", "", "glow nyx professional makeup", "Glow NYX Professional Makeup", "", "Glow NYX Professional Makeup"),
    ("Velvet 123456 Glow!", "a.b", "velvet glow", "Velvet 123456 Glow!", "", "Velvet 123456 Glow!"),
    ("", "", "", "", "", ""),
    ("axb " + "y" * 90, "a.b", "axb " + "y" * 90, "axb " + "y" * 76, "", "axb " + "y" * 90),
)


@query(f"""
SELECT p_partkey AS part, {sql_pick(_column(NAMED, 2), "p_partkey")} AS compared, {sql_pick(_column(NAMED, 3), "p_partkey")} AS shown,
       {sql_pick(_column(NAMED, 4), "p_partkey")} AS prefix, {sql_pick(_column(NAMED, 5), "p_partkey")} AS rest FROM part
""")
def q46_names_compared_and_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, brand = F.col("name"), F.col("brand")
    rows = _cases(spark, sf_dir, NAMED, "name", "brand").withColumn("prefix", text.brand_prefix(name))
    return rows.select("part", text.match_name(name, brand).alias("compared"), text.shown_name(name, brand).alias("shown"), "prefix", text.without_prefix(name, F.col("prefix")).alias("rest"))


@query("""
WITH d AS (SELECT p_partkey AS part, p_size AS n, p_partkey % 10 AS digit FROM part)
SELECT part, CASE WHEN n BETWEEN 1 AND 5 AND digit = 0 THEN n::DOUBLE WHEN n < 5 THEN (n || '.' || digit)::DOUBLE ELSE 0 END AS of_five, (n || '.' || digit)::DOUBLE AS with_comma,
       floor((n * 2 + digit / 10) / 20 * 10 + 0.5) / 10 AS of_percent, CASE WHEN n * 3 <= 5 THEN n * 3 WHEN n * 3 <= 100 THEN floor(n * 3 / 20 * 10 + 0.5) / 10 ELSE 0 END::DOUBLE AS of_either,
       (n || '0' || digit)::BIGINT AS n_reviews, n * 1100 > 0 AND n * 1100 < 50000 AS plausible FROM d
""")
def q47_ratings_and_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings by each seller's reading: of five (0 above), with a comma, of a hundred, or of whichever fits."""
    n, digit = F.col("p_size"), F.col("p_partkey") % 10
    of = lambda *x: F.concat(*(F.lit(v) if isinstance(v, str) else v.cast("string") for v in x))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"),
        prices.rating_of_five(of(" ", n, ".", digit, " / 5")).alias("of_five"),
        prices.rating_with_comma(of("Puan: ", n, ",", digit, " (5)")).alias("with_comma"),
        prices.rating_of_percent(of(n * 2, ".", digit, "%")).alias("of_percent"),
        prices.rating_of_either(of("yıldız ", n * 3, "/100")).alias("of_either"),
        prices.count(of("(", n, ".0", digit, " yorum)")).alias("n_reviews"),
        prices.plausible((n * 1100).cast("double")).alias("plausible"),
    )


#: Fixed values: (url, unwrapped, with its origin, product number, barcode, code).
LINKED = (
    ("https://a/r?x=1&url=https%3A%2F%2Fb%2Fc%3Fd&y=2", "https://b/c?d", "https://a/r?x=1&url=https%3A%2F%2Fb%2Fc%3Fd&y=2", "", "", ""),
    ("/ruj-p-12345678?m=1", "/ruj-p-12345678?m=1", "https://s/ruj-p-12345678?m=1", "12345678", "12345678", ""),
    ("https://s/ruj-p-77", "https://s/ruj-p-77", "https://s/ruj-p-77", "77", "", ""),
    ("https://s/a/p/90210/x", "https://s/a/p/90210/x", "https://s/a/p/90210/x", "", "", "90210"),
    ("", "", "", "", "", ""),
)


@query(f"""
SELECT p_partkey AS part, {", ".join(f"{sql_pick(_column(LINKED, i), 'p_partkey')} AS {n}" for i, n in enumerate(("target", "whole", "number", "barcode", "code"), 1))} FROM part
""")
def q48_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, url = _cases(spark, sf_dir, LINKED, "url"), F.col("url")
    return rows.select("part", links.unwrapped(url).alias("target"), links.absolute(url, "https://s").alias("whole"), links.product_number(url).alias("number"), links.product_barcode(url).alias("barcode"), links.product_code(url).alias("code"))


@query("SELECT p_partkey AS part, p_name AS name, least(CASE WHEN p_size % 3 > 0 THEN p_size END, p_retailprice) AS price, 'k' || p_partkey AS \"productUrl\", 2::BIGINT AS total FROM part")
def q49_search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of search bodies; zero and missing prices don't count."""
    source = F.struct(F.col("p_name").alias("name"), F.lit(0.0).alias("special_price"), F.when(F.col("p_size") % 3 > 0, F.col("p_size").cast("double")).alias("crm_price"), F.col("p_retailprice").alias("price"), F.concat(F.lit("k"), F.col("p_partkey")).alias("url_key"))
    body = F.to_json(F.struct(F.struct(F.struct(F.struct(F.lit(2).alias("value")).alias("total"), F.array(F.struct(source.alias("_source"))).alias("hits")).alias("hits")).alias("product")))
    bodies = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), body.alias("body")).withColumn("total", landed.search_total(F.col("body")))
    return landed.search_pages(bodies).select("part", "name", "price", "productUrl", "total")


@query("""
SELECT 'https://s/' || seg || '/x-p-' || p_partkey AS url, seg AS segment, p_partkey::VARCHAR AS product_id, CASE seg WHEN 'makyaj' THEN 'ruj' ELSE 'cilt' END AS category
FROM (SELECT p_partkey, list_extract(['makyaj', 'bakim', 'diger'], (p_partkey % 3 + 1)::INT) AS seg FROM part) WHERE seg <> 'diger'
""")
def q50_sitemap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("https://s/"), pick(("makyaj", "bakim", "diger"), F.col("p_partkey")), F.lit("/x"))
    body = F.concat(F.lit("<urlset><url><loc> "), url, F.lit("-p-"), F.col("p_partkey").cast("string"), F.lit("\n</loc></url><url><loc>"), url, F.lit("</loc></url></urlset>"))
    return landed.sitemap(table(spark, sf_dir, "part").select(body.alias("body")), {"makyaj": "ruj", "bakim": "cilt"})


@query("SELECT p_partkey AS part, CASE WHEN p_partkey % 4 > 0 THEN 'E' || p_partkey END AS ean, CASE WHEN p_partkey % 4 > 0 THEN p_size::INT END AS pages FROM part")
def q51_page_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page count and EAN of the state that a page's script holds; null without one."""
    state = F.to_json(F.struct(F.struct(F.concat(F.lit("E"), F.col("p_partkey")).alias("ean"), F.col("p_size").cast("int").alias("pages")).alias("product")))
    html = F.concat(F.lit("<p>x</p><script>window.data = "), state, F.lit("; </script><b>y</b>"))
    pages = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.when(F.col("p_partkey") % 4 > 0, html).otherwise("<p>none</p>").alias("html"))
    return landed.page_state(pages, "window[.]data", "product struct<ean:string,pages:int>").select("part", "state.product.ean", "state.product.pages")


@query("""
SELECT p_partkey AS part, p_name AS name, 'u' AS url, 'i' AS image, p_retailprice AS price FROM part
UNION ALL SELECT p_partkey, p_name || ' 2', 'w', NULL, 0.0 FROM part
""")
def q52_linked_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of linked data: the first of a name counts, a missing price is 0."""
    price = F.struct(F.col("p_retailprice").alias("price"))
    one = lambda n, u, i, p: F.struct(n.alias("name"), F.lit(u).alias("url"), F.lit(i).cast("string").alias("image"), p.alias("offers"))
    second = F.concat(F.col("p_name"), F.lit(" 2"))
    body = F.to_json(F.struct(F.col("p_name").alias("name"), F.array(one(F.col("p_name"), "u", "i", price), one(F.col("p_name"), "v", "j", price), one(second, "w", None, F.when(F.lit(False), price))).alias("hasVariant")))
    html = F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script><script>{</script>"))
    return markup.variants(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), html.alias("html")), "part")


@query("""
SELECT p_partkey AS part, CASE WHEN p_partkey % 3 = 0 THEN 'x' WHEN p_partkey % 3 = 1 THEN p_type ELSE '' END AS filled,
       CASE WHEN p_partkey % 7 IN (0, 1) THEN 'main ' || p_name WHEN p_partkey % 7 = 2 THEN 'first ' || p_name WHEN p_partkey % 7 IN (3, 4) THEN 'gallery ' || p_name WHEN p_partkey % 7 = 5 THEN 'picture ' || p_name END AS image FROM part
""")
def q55_first_filled_and_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The primary image by type or by place, else the first; one without a url leaves it to the gallery, and that to the picture."""
    k, turn = F.col("p_partkey"), F.col("p_partkey") % 7
    url = lambda kind: F.concat(F.lit(f"{kind} "), F.col("p_name"))
    image = lambda kind, place, url: F.struct(F.lit(kind).alias("imageType"), F.lit(place).cast("int").alias("galleryIndex"), (F.lit("") if url is None else url).alias("url"))
    other = image("GALLERY", 3, url("first"))
    images = F.when(turn == 0, F.array(other, image("PRIMARY", 2, url("main")))).when(turn == 1, F.array(other, image("GALLERY", 0, url("main")), image("PRIMARY", 1, url("late"))))
    images = images.when(turn == 2, F.array(other, image("GALLERY", None, url("second")))).when(turn == 3, F.array(other, image("PRIMARY", 1, None)))
    gallery = F.when(turn.isin(0, 3, 4), F.array(F.struct(url("gallery").alias("url")), F.struct(F.lit("x").alias("url")))).when(turn == 5, F.array(F.struct(F.lit("").alias("url"))))
    filled = landed.first_filled(F.when(k % 3 == 0, "x").otherwise("  "), F.when(k % 3 != 2, F.col("p_type")), F.lit(""))
    return table(spark, sf_dir, "part").select(k.alias("part"), filled.alias("filled"), landed.product_image(images, gallery, F.when(turn != 6, url("picture"))).alias("image"))


@query("""
SELECT p_partkey AS part, CASE WHEN p_partkey % 3 = 0 THEN 'new' || p_partkey ELSE 'old' END AS image, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 5 > 0 THEN '869' || p_partkey ELSE 'b' || p_partkey END AS barcode FROM part
""")
def q57_filled_from_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of checkpoints by url; an empty or missing value leaves what was there. Barcodes come in with the normal form, by id, and for one seller alone."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    url = F.concat(F.lit("u"), F.col("part"))
    known = part.select(url.alias("productUrl"), F.when(F.col("part") % 3 == 0, F.concat(F.lit("new"), F.col("part"))).when(F.col("part") % 3 == 1, "").alias("value"))
    codes = part.select("id", F.when(F.col("part") % 2 == 0, F.concat(F.lit("869"), F.col("part"))).otherwise("").alias("code"))
    site = F.when(F.col("part") % 5 == 0, "Gratis").otherwise("Trendyol")
    rows = part.withColumns({"productUrl": url, "image": F.lit("old"), "barcode": F.concat(F.lit("b"), F.col("part")), "site": site, "category": F.lit("ruj"), "categoryLabel": F.lit("Ruj")})
    return offers.normalised(offers.filled(rows, known, "productUrl", "value", "image"), codes).select("part", "image", "barcode")


@query("SELECT event_type AS cat, count(*) AS n FROM events WHERE event_id // 60 + 1 <= 5 GROUP BY event_type")
def q58_page_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("cat"), (F.floor(F.col("event_id") / 60) + 1).alias("page"))
    return offers.first_pages(rows, 5).groupBy("cat").agg(F.count("*").alias("n"))


@query("""
WITH r AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'timeout' WHEN o_orderkey % 5 = 0 THEN 'error' ELSE 'ok' END AS status, o_orderkey % 3 AS n FROM orders)
SELECT status, count(*) AS n_runs, sum(n)::BIGINT AS n_rows, status = 'ok' AS usable FROM r GROUP BY status
""")
def q59_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.cast("string").alias("name"), F.when(k % 7 == 0, "timeout").when(k % 5 == 0, "error").otherwise("ok").alias("status"), (k % 3).cast("long").alias("count"))
    return sinks.run_summary(rows)


@query("""
WITH p AS (SELECT regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT NOT starts_with(path, '/en/') AS allowed, count(*) AS n_paths, 7.5::DOUBLE AS crawl_delay FROM p GROUP BY 1
""")
def q60_robots_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed and blocked paths, and the longest delay that the host asks for."""
    paths = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1).alias("path"))
    rules = spark.createDataFrame([("h", "disallow", "/en/"), ("h", "crawl-delay", "3"), ("h", "crawl-delay", "7.5"), ("h", "crawl-delay", "soon")], "host string, kind string, pattern string")
    return robots.report(robots.decisions(paths, rules, "page_id")).crossJoin(F.broadcast(robots.crawl_delay(rules).drop("host")))


@query("""
SELECT page_id, CASE page_id % 8 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN length(url) + 4 < 2000 WHEN 3 THEN FALSE WHEN 4 THEN TRUE WHEN 5 THEN FALSE WHEN 6 THEN TRUE ELSE FALSE END AS missing FROM pages
""")
def q61_looks_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error pages by what they say, by a 404 in a short text, and by status 403, 404 and 500 and above."""
    turn, url = F.col("page_id") % 8, F.coalesce("url", F.lit(""))
    said = F.when(turn == 0, F.concat(url, F.lit(" SAYFA BULUNAMADI"))).when(turn == 1, F.concat(F.lit("Page not found: "), url)).when(turn == 2, F.concat(url, F.lit(" 404")))
    said = said.when(turn == 3, F.concat(F.lit("404 TL "), F.repeat(F.lit("x"), 1993))).otherwise("Sayfa bulunamadı")
    status = F.when(turn == 4, 404).when(turn == 5, 410).when(turn == 6, 503).when(turn < 4, 200)
    return table(spark, sf_dir, "pages").select("page_id", offers.looks_missing(said, status).alias("missing"))
