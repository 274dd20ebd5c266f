"""Registered queries of sellers' pages: the driver's parts, set in each seller's markup, and read back.

What a page holds is written down here; what its seller makes of it is written by hand in the SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerloom import schemas
from offerloom.operators import offers
from offerloom.plans.samples import table
from offerloom.queries import query
from offerloom.sources import arrays, landed, layouts, paging, sinks, versions
from offerloom.worktables import materialize, work_path


def filled(template: str, **columns: Column) -> Column:
    """``template`` with the columns in the places of their names in double brackets."""
    cut = re.split(r"\[\[(\w+)\]\]", template)
    return F.concat(*(F.lit(x) if i % 2 == 0 else columns[x].cast("string") for i, x in enumerate(cut) if i % 2 or x))


#: A result page of each seller, with a card that counts and others that don't.
RESULT_PAGES = {
    "Amazon": """<div data-component-type="s-search-result" data-asin=""><h2><a href="/dp/X"><span>Asin yok</span></a></h2></div>
<div class="s" data-component-type="s-search-result" data-asin="B[[key]]"><a href="/sspa/click?x=1&amp;url=%2Fdp%2FB[[key]]%2Fref"><h2><span> [[name]] </span><span>2</span></h2></a><img class="s-image big" src="https://i/[[key]].jpg">
<span class="a-price"><span class="a-offscreen">[[tl]] TL</span></span><i><span class="a-icon-alt">4,[[digit]] yıldız</span></i><span class="a-size-base s-underline-text">(1.2[[digit]]4)</span></div>
<div data-component-type="s-search-result" data-asin="B[[key]]"><h2><span>Aynı ürün</span></h2><span class="a-price"><b class="a-offscreen">1,00 TL</b></span></div>""",
    "Gratis": """<ul class="grid"><li><div class="card"><a href="/x-p-[[key]]"><img src="data:image/gif;base64,R" data-src="https://cdn.gratis.com/[[key]].jpg"></a><h3>TL</h3><div class="product-name">[[name]]</div><span class="marka">[[brand]]</span>
<span><s>[[tl]] TL</s></span><div class="rating" data-rating="4.[[digit]]6"></div><span class="review">([[digit]]1)</span></div></li>
<li><a href="/y-p-9[[key]]" title="Yan ürün"></a></li><li><a href="/x-p-[[key]]?again">yine</a></li><li>4</li></ul>""",
    "Hepsiburada": """<article><a href="https://adservice.hepsiburada.com/x">reklam</a><a href="/[[key]]-p?magaza=1">git</a><h3> [[name]]
 </h3><span class="brandName">[[brand]]</span><div class="price-old">1.234,50 TL</div><div data-test-id="price-current">[[tl]] TL</div><img src="/logo.png"><img src="https://productimages.hepsiburada.net/[[key]]"><span class="star">4,[[digit]]</span></article>
<article><a href="/[[key]]-p?magaza=2">git</a><h2>Aynı ürün</h2></article><article><a href="/ara?q=x">ara</a><h2>Aranan</h2></article><article><a href="/r[[key]]">git</a><h2>Puanı yüksek</h2><b class="rating">45</b></article>""",
    "Idefix": """<section><div class="kart"><div><a href="/[[key]]-p-1#yorum"><div><div><h3><span class="font-semibold x">[[brand]]</span> <span>[[name]]</span></h3></div></div></a><b class="text-neutral-1000">4.5</b><b class="text-neutral-1000 z">[[tl]]</b><img data-src="/i/[[key]].jpg"></div></div></section>
<section><div><div><div><div><h3>Ucuz</h3></div></div></div></div></section>""",
    "Pazarama": """<div class="product-list"><div class="product-card"><a href="/urun-p-[[barcode]]?m=1"><img src="/i/[[key]].jpg"></a><div class="product-card__title">[[name]]</div><div class="brand">[[brand]]</div>
<div class="price">1.799,90 TL [[tl]] TL</div></div><div class="item"><a href="/diger-p-2[[key]]">Fiyatı olmayan ürün</a></div><div class="item"><a href="/ucuz-p-3[[key]]">Küsuratı bir hane</a><i class="fiyat">12,5 TL</i></div></div>""",
    "PttAvm": """<ul><li><a href="/urun-p-7[[key]]">[[name]] ptt</a><span class="fiyat">Fiyat yok</span><span class="fiyat">[[tl]] TL</span><img data-src="/i/[[key]].jpg"><li><a href="/urun-p-7[[key]]?x">Aynı ürün</a><em class="price">5 TL</em><li><a href="/urun-p-8[[key]]">Kısa</a><em class="price">5 TL</em></ul>""",
    "Trendyol": """<a class="product-card x" href="/m/u-p-[[key]]"><img class="logo" src="/l"><img src="https://cdn.dsmcdn.com/[[key]]"><b class="product-brand">[[brand]]</b><b class="product-name">[[name]]</b><div class="strikethrough-price"><i class="price-value">2.000 TL</i></div>
<div class="discounted-price"><i class="price-value">sepette</i></div><div class="sale-price">-%17[[tl]] TL</div><i class="average-rating">4,[[digit]]</i><i class="total-count">(1.[[digit]]00)</i></a>
<a class="product-card" href="/m/v-p-[[key]]"><b class="product-brand">[[brand]]</b><div class="single-price">2.856 TL</div></a><a class="product-card" href="/m/w"><b class="product-name">Fiyatsız</b></a>""",
    "Sephora": """<div class="grid-tile"><h3 class="product-title">[[name]]
  x</h3><span class="product-brand">[[brand]]</span><a href="/p/[[key]].html">git</a><img class="product-first-img" src="/i/[[key]]"><span class="price-sales-standard">[[tl]] TL</span><div class="product-rating-wrapper" data-rating="9[[digit]]"></div><b class="my-rating-count">([[digit]]2)</b></div>
<div class="grid-tile"><h3 class="name">Adressiz</h3></div><div class="grid-tile"><h3 class="name">Fiyatsız</h3><a class="product-tile-link" href="/u/[[key]]"></a></div>""",
    "Watsons": """<div class="product-item"><h3 class="product-name">x</h3><h2 class="n" title="[[name]]">y</h2><i class="brand">z</i><i class="theBrand">[[brand]]</i><a href="#">a</a><a href="/u/p/[[key]]">b</a><img src="/placeholder-product.png"><img data-src="/i/[[key]].jpg">
<i class="price">yok</i><i class="nowPrice">Şimdi [[tl]] TL</i><i class="ratings">yok</i><i class="stars">8[[digit]]</i><i class="reviews">[[digit]]3 yorum</i></div><div class="product-item"><p>boş</p></div>""",
}

_SQL_OF = {
    "Amazon": "SELECT part, 0 AS pos, name, '' AS brand, price, 'https://i/' || key || '.jpg' AS image, 'https://www.amazon.com.tr/dp/B' || key || '/ref' AS url, ('4.' || digit)::DOUBLE AS rating, ('12' || digit || '4')::BIGINT AS reviews, '' AS barcode",
    "Gratis": """SELECT part, 0, name, brand, price, 'https://cdn.gratis.com/' || key || '.jpg', 'https://www.gratis.com/x-p-' || key, CASE WHEN digit = 9 THEN 5.0 ELSE ('4.' || (digit + 1))::DOUBLE END, (digit || '1')::BIGINT, '' FROM s UNION ALL BY POSITION
SELECT part, 1, 'Yan ürün', '', 0.0, '', 'https://www.gratis.com/y-p-9' || key, 0.0, 0, ''""",
    "Hepsiburada": """SELECT part, 0, name, brand, least(price, 1234.5), 'https://www.hepsiburada.com/logo.png', 'https://www.hepsiburada.com/' || key || '-p', ('4.' || digit)::DOUBLE, 0, '' FROM s UNION ALL BY POSITION
SELECT part, 1, 'Puanı yüksek', '', 0.0, '', 'https://www.hepsiburada.com/r' || key, 0.0, 0, ''""",
    "Idefix": "SELECT part, 0, brand || ' ' || name, brand, price, 'https://www.idefix.com/i/' || key || '.jpg', 'https://www.idefix.com/' || key || '-p-1', 0.0, 0, ''",
    "Pazarama": """SELECT part, 0, name, brand, price, 'https://www.pazarama.com/i/' || key || '.jpg', 'https://www.pazarama.com/urun-p-' || barcode || '?m=1', 0.0, 0, barcode FROM s UNION ALL BY POSITION
SELECT part, 1, 'Küsuratı bir hane', '', 12.5, '', 'https://www.pazarama.com/ucuz-p-3' || key, 0.0, 0, ''""",
    "PttAvm": "SELECT part, 0, name || ' ptt', '', price, 'https://www.pttavm.com/i/' || key || '.jpg', 'https://www.pttavm.com/urun-p-7' || key, 0.0, 0, ''",
    "Trendyol": """SELECT part, 0, name, brand, ('17' || price_text)::DOUBLE, 'https://cdn.dsmcdn.com/' || key, 'https://www.trendyol.com/m/u-p-' || key, ('4.' || digit)::DOUBLE, ('1' || digit || '00')::BIGINT, '' FROM s UNION ALL BY POSITION
SELECT part, 1, brand, brand, 2856.0, '', 'https://www.trendyol.com/m/v-p-' || key, 0.0, 0, ''""",
    "Sephora": """SELECT part, 0, name || ' x', brand, price, 'https://www.sephora.com.tr/i/' || key, 'https://www.sephora.com.tr/p/' || key || '.html', floor((90 + digit) / 20 * 10 + 0.5) / 10, (digit || '2')::BIGINT, '' FROM s UNION ALL BY POSITION
SELECT part, 1, 'Fiyatsız', '', 0.0, '', 'https://www.sephora.com.tr/u/' || key, 0.0, 0, ''""",
    "Watsons": "SELECT part, 0, name, brand, price, '/i/' || key || '.jpg', 'https://www.watsons.com.tr/u/p/' || key, floor((80 + digit) / 20 * 10 + 0.5) / 10, (digit || '3')::BIGINT, ''",
}


def _dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts in as many partitions as the session shuffles to, which Spark doesn't join again for being small."""
    return table(spark, sf_dir, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part, key, name, brand, price, tl, digit, barcode) of the parts; ``tl`` writes the price with a comma.

    The table may be one file that one task reads; the pages that parts become are dealt to all tasks.
    """
    part, key = _dealt(spark, sf_dir), F.col("p_partkey")
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    return part.select(key.alias("part"), key.alias("key"), F.concat_ws(" ", "p_name", "p_type").alias("name"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"), F.concat(F.floor(cents / 100), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0")).alias("tl"), (key % 10).alias("digit"), F.lpad((key + 8690000000000).cast("string"), 13, "0").alias("barcode"))


_SQL_PARTS = """s AS (
  SELECT p_partkey AS part, p_partkey AS key, p_name || ' ' || p_type AS name, p_brand AS brand, round(p_retailprice, 2) AS price, p_partkey % 10 AS digit, (p_partkey + 8690000000000)::VARCHAR AS barcode,
         (round(p_retailprice * 100)::BIGINT // 100) || '.' || lpad((round(p_retailprice * 100)::BIGINT % 100)::VARCHAR, 2, '0') AS price_text
  FROM part)"""


def _layouts_sql() -> str:
    rows = []
    for seller, sql in _SQL_OF.items():
        rows += [f"SELECT '{seller}', * FROM ({x.strip()}{'' if x.strip().endswith('FROM s') else ' FROM s'})" for x in sql.split("UNION ALL BY POSITION")]
    return f"WITH {_SQL_PARTS}, r(seller, part, pos, name, brand, price, image, url, rating, reviews, barcode) AS ({' UNION ALL '.join(rows)}) SELECT seller, part, pos::INT AS pos, name, brand, price, image AS \"imageUrl\", url AS \"productUrl\", rating::DOUBLE AS rating, reviews::BIGINT AS reviews, barcode FROM r"


@query(_layouts_sql())
def q62_seller_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a result page of each of the nine sellers, read by that seller's layout."""
    parts, found = _parts(spark, sf_dir), []
    columns = {c: F.col(c) for c in parts.columns}
    for seller, template in RESULT_PAGES.items():
        pages = parts.select("part", filled(template, **columns).alias("html"))
        found.append(layouts.offers_of(pages, layouts.LAYOUTS[seller], "part").select(F.lit(seller).alias("seller"), "part", "pos", *layouts.OFFER))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


#: Product pages; in turn all four ways to shades, and all writers of codes and brands.
DETAIL_PAGES = (
    """<meta property="product:ean" content="1[[barcode]]"><table><tr><td>Barkod: [[barcode]]</td></tr><tr><td>Menşei 12345678</td></tr></table><div class="product-description-content"> [[name]]
 vegan  krem </div><div class="product-variations"><a>Nude [[digit]] (30 ml)</a><a> Rose </a><a>x</a></div><div class="product-variations"><a>Rose</a><i title="Mat"></i></div><i class="bigsize"> 30 ml </i><div class="primary-image" src="/i"></div><b class="the-brand"> [[brand]] </b>""",
    """<script type="application/ld+json">{"gtin": "3[[barcode]]", "gtin13": "2[[barcode]]", "brand": {"name": "L [[brand]]"}}</script><script type="application/ld+json">{"name": "son"}</script><script type="application/ld+json">{oops</script>
<ul class="product-variations"><li data-value="Ton [[digit]]"></li><li data-attr-value="Bej (5 g) x"></li><li data-value=""></li></ul><ul class="spec"><div>EAN 87654321</div></ul><p>Cruelty-Free</p><i itemprop="brand">B</i>""",
    """<div class="product-variations"><button aria-label="Seçili Renk: Mercan [[digit]]"></button><i title="renk: Kum"></i><a title="Kum">Gül (10 oz)</a></div><p>hayvanlarda test edilmez</p><script>var vegan = 1</script>""",
    """<b class="selected-shade"> Vişne [[digit]] (4 G)</b><b class="shade-name">Diğer</b><div class="detail"><li>gtin [[barcode]]</li></div><p>hayvanlar üzerinde test edilmez</p>""",
)


def _detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir)
    columns = {c: F.col(c) for c in parts.columns}
    return parts.select("part", F.coalesce(*(F.when(F.col("part") % 4 == i, filled(t, **columns)) for i, t in enumerate(DETAIL_PAGES))).alias("html"))


@query(f"""
WITH {_SQL_PARTS}
SELECT part, CASE part % 4 WHEN 0 THEN '1' || barcode WHEN 1 THEN '3' || barcode WHEN 2 THEN '' ELSE barcode END AS barcode,
       CASE part % 4 WHEN 0 THEN brand WHEN 1 THEN 'L ' || brand ELSE '' END AS brand, CASE part % 4 WHEN 2 THEN '' WHEN 3 THEN barcode ELSE '7' || barcode END AS inline
FROM s
""")
def q53_page_codes_and_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and brands of product pages by all their writers, and the code in a script."""
    pages = _detail_pages(spark, sf_dir)
    found = layouts.detail_elements(pages, "part", names=layouts.CODES).select("part", layouts.page_barcode().alias("barcode"), layouts.page_brand().alias("brand"))
    code = F.lpad((F.col("part") + 8690000000000).cast("string"), 13, "0")
    script = F.when(F.col("part") % 4 < 2, F.concat(F.lit('{"barcode":"7'), code, F.lit('","barcode":"1"}'))).when(F.col("part") % 4 == 2, F.lit('"barcode":"1234567"')).otherwise(F.concat(F.lit('"barcode":'), code, F.lit("}")))
    inline = pages.select(F.col("part").alias("p"), landed.inline_barcode(F.concat("html", script)).alias("inline"))
    # a row a part on either side: by the size of the parts' file Spark would take one for small and send it whole through the driver
    return found.join(inline.hint("merge"), found["part"] == inline["p"]).drop("p")


@query(f"""
WITH {_SQL_PARTS}
SELECT part, CASE part % 4 WHEN 0 THEN name || ' vegan krem' ELSE '' END AS "desc", part % 4 = 0 AS vegan, part % 4 IN (1, 2) AS "crueltyFree", CASE part % 4 WHEN 0 THEN '/i' ELSE '' END AS "imageUrl", CASE part % 4 WHEN 0 THEN '30 ml' ELSE '' END AS size,
       CASE part % 4 WHEN 0 THEN 'Nude ' || digit || ',Rose,Mat' WHEN 1 THEN 'Ton ' || digit || ',Bej x' WHEN 2 THEN 'Gül,Mercan ' || digit || ',Kum' ELSE 'Vişne ' || digit END AS shades
FROM s
""")
def q56_detail_flags_and_shades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details and shades of product pages, each of the four ways to shades in turn."""
    found = layouts.detail_elements(_detail_pages(spark, sf_dir), "part", names=layouts.DETAILS)
    return found.select("part", *(c.alias(n) for n, c in layouts.page_details().items()), F.array_join(layouts.page_shades(), ",").alias("shades"))


@query("""
WITH a AS (
  SELECT p_partkey AS part, CASE WHEN p_partkey % 5 < 2 THEN 0 WHEN p_partkey % 5 = 2 THEN 1 WHEN p_partkey % 5 = 3 THEN 3 END AS attempt, p_type, p_name FROM part)
SELECT part, attempt::INT AS attempt, CASE attempt WHEN 0 THEN '/own/' || part WHEN 1 THEN '/c/' || p_type ELSE '/makyaj/c/003?q=%3Arelevance%3Acategory%3A' || p_type END AS path FROM a WHERE attempt IS NOT NULL
""")
def q63_alternative_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category's own page, or else the first of its alternatives that is no error page: a 404 counts in short texts only."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    tried = part.select(key.alias("part"), F.posexplode(F.concat(F.array(F.concat(F.lit("/own/"), key)), offers.alternative_paths(F.col("p_type"), F.concat_ws(" & ", "p_name", "p_brand")))).alias("attempt", "path"))
    turn = F.col("part") % 5
    works = ((turn < 2) & (F.col("attempt") == 0)) | ((turn == 2) & (F.col("attempt") >= 1)) | ((turn == 3) & (F.col("attempt") == 3))
    price = F.concat(F.lit("Ürünler 404 TL "), F.repeat(F.lit("uzun liste "), 200))
    body = F.when(works & (turn == 0), price).when(works, "Ürünler").when(F.col("attempt") == 1, "SAYFA BULUNAMADI").when(F.col("attempt") == 2, "Hata 404").otherwise("")
    status = F.when(works, F.when(turn == 1, 410).otherwise(200)).when(F.col("attempt") == 0, 403).when(F.col("attempt") == 3, 503).otherwise(200)
    return offers.first_working(tried.withColumns({"body": body, "status": status}), "part", "attempt").select("part", "attempt", "path")


@query("""
SELECT p_partkey AS part, CASE WHEN p_partkey % 2 = 1 THEN 'own' WHEN p_partkey % 3 = 0 AND p_partkey % 4 <> 2 THEN 'own,u1,u2' WHEN p_partkey % 3 = 1 THEN 'own,i1,i2' ELSE 'own' END AS shades FROM part
""")
def q64_shades_by_url_or_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shades of one seller's products by url, else by id; one shade is too few, and hides what the id has."""
    key = F.col("p_partkey")
    part = table(spark, sf_dir, "part").select(key.alias("part"), key.alias("id"), F.concat(F.lit("http://u/"), key).alias("productUrl"), F.when(key % 2 == 0, "sephora").otherwise("gratis").alias("source"), F.array(F.lit("own")).alias("shadeOptions"))
    listed = lambda *names: F.array(*map(F.lit, names))
    by_url = part.filter("part % 3 = 0").select(F.col("productUrl").alias("key"), F.when(F.col("part") % 4 == 2, listed("u1")).otherwise(listed("u1", "own", "u2")).alias("shades"))
    by_id = part.filter("part % 3 < 2").select(F.col("id").cast("string").alias("key"), listed("i1", "i2").alias("shades"))
    return offers.seller_options(part, by_url.union(by_id)).select("part", F.array_join("shadeOptions", ",").alias("shades"))


@query("""
SELECT p_partkey AS part, CASE p_partkey % 6 WHEN 0 THEN 'v' || p_partkey WHEN 1 THEN 'g' || p_partkey WHEN 2 THEN 'b' || p_partkey WHEN 3 THEN '8' || p_partkey WHEN 4 THEN 'o' || p_partkey ELSE '' END AS barcode FROM part
""")
def q54_api_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes of two endpoints' responses, by their envelopes; the second only counts where the first can't be read."""
    parts = _parts(spark, sf_dir)
    columns = {c: F.col(c) for c in parts.columns}
    bodies = ('{"result":{"product":{"variants":[{"barcode":" v[[key]] ","gtin":"x"}],"barcode":"y"}}}', '{"product":{"variants":[{"barcode":"","gtin":"g[[key]]"}]}}', '{"result":{"product":{"variants":[],"barcode":"b[[key]]"}}}', '{"result":{"product":{"gtin":8[[key]]}}}', "<html>", '{"result":{"product":{}}}')
    detail = F.coalesce(*(F.when(F.col("part") % 6 == i, filled(t, **columns)) for i, t in enumerate(bodies)))
    other = filled('{"result":{"variants":[{"gtin":"o[[key]]"}]}}', **columns)
    return parts.select("part", landed.response_barcode(detail, other).alias("barcode"))


@query("""
SELECT 'k=' || (p_partkey // 500) AS file, row_number() OVER (PARTITION BY p_partkey // 500 ORDER BY p_partkey) - 1 AS pos, p_partkey::VARCHAR AS id, p_name || ' "}{' AS name, p_brand AS brand, p_retailprice AS price, '["' || p_type || '","]"]' AS image FROM part
""")
def q65_offer_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers of landed array files, one for each 500 parts, read by ranges; names hold braces and quotes."""
    part, path = table(spark, sf_dir, "part"), work_path(spark, "arrays")
    offer = F.struct(F.col("p_partkey").alias("id"), F.concat("p_name", F.lit(' "}{')).alias("name"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"), F.array(F.col("p_type"), F.lit("]")).alias("imageUrl"))
    files = part.groupBy(F.floor(F.col("p_partkey") / 500).alias("k")).agg(F.to_json(F.array_sort(F.collect_list(offer))).alias("value"))
    files.repartition("k").write.partitionBy("k").text(path)
    body = F.from_json("body", schemas.OFFER)
    found = arrays.elements(spark, f"{path}/*").select(F.regexp_extract("path", "(k=[0-9]+)", 1).alias("file"), "pos", body.alias("o"))
    return found.select("file", "pos", "o.id", "o.name", "o.brand", "o.price", F.col("o.imageUrl").alias("image"))


#: Parts by brand in pages of five, as a search API lands them: by a rule, some pages lack and some are empty.
_SQL_PAGES = """
n AS (SELECT p_brand AS brand, p_partkey, p_retailprice, regexp_extract(p_brand, '([0-9]+)$', 1)::BIGINT AS turn, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS n, count(*) OVER (PARTITION BY p_brand) AS total FROM part),
p AS (SELECT brand, n // 5 * 5 AS pos, n // 5 + turn AS k, total, count(*) AS held, sum(p_retailprice) AS price FROM n GROUP BY ALL),
l AS (SELECT brand, pos, k % 17 = 9 AS empty, total, CASE WHEN k % 17 = 9 THEN 0 ELSE held END AS held, price FROM p WHERE k % 23 <> 6)"""


def _landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_brand = Window.partitionBy("p_brand")
    turn = F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("long")
    parts = table(spark, sf_dir, "part").withColumns({"n": F.row_number().over(by_brand.orderBy("p_partkey")) - 1, "total": F.count("*").over(by_brand), "turn": turn})
    source = F.struct(F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"), F.concat(F.lit("k"), "p_partkey").alias("url_key"))
    k = F.floor(F.col("n") / 5)
    pages = parts.withColumns({"at": k * 5, "k": k + F.col("turn")}).groupBy("p_brand", "at", "k", "total").agg(F.collect_list(F.struct(source.alias("_source"))).alias("hits"))
    hits = F.struct(F.struct(F.col("total").alias("value")).alias("total"), F.when(F.col("k") % 17 == 9, F.slice("hits", 1, 0)).otherwise(F.col("hits")).alias("hits"))
    return pages.filter("k % 23 <> 6").select(F.col("p_brand").alias("brand"), "at", F.to_json(F.struct(F.struct(hits.alias("hits")).alias("product"))).alias("body"))


@query(f"""
WITH {_SQL_PAGES},
lost AS (SELECT brand, pos, pos + p.held AS upto, pos // 5 - row_number() OVER (PARTITION BY brand ORDER BY pos) AS island FROM p WHERE (brand, pos) NOT IN (SELECT brand, pos FROM l WHERE NOT empty)),
ranges AS (SELECT brand, min(pos) AS lo, max(upto) AS hi FROM lost GROUP BY brand, island),
m AS (SELECT brand, string_agg(lo || '-' || hi, ',' ORDER BY lo) AS missing, sum(hi - lo) AS n FROM ranges GROUP BY brand),
stop AS (SELECT brand, min(pos) AS pos FROM lost GROUP BY brand),
w AS (SELECT l.brand, count(*) AS n_walked, sum(held) AS n_offers, sum(price) AS price FROM l LEFT JOIN stop s ON l.brand = s.brand WHERE s.pos IS NULL OR l.pos < s.pos GROUP BY l.brand)
SELECT brand, n_pages, n_held, total, coalesce(n, 0)::BIGINT AS n_missing, n IS NULL AS complete, coalesce(missing, '') AS missing, coalesce(n_walked, 0)::BIGINT AS n_walked, coalesce(n_offers, 0)::BIGINT AS n_offers, round(coalesce(price, 0), 2) AS price
FROM (SELECT brand, count(*) AS n_pages, sum(held)::BIGINT AS n_held, max(total) AS total FROM l GROUP BY brand) LEFT JOIN m USING (brand) LEFT JOIN w USING (brand)
""")
def q66_paged_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages of each brand: what they state in total, the ranges that none holds, and what a walk from the first page reads."""
    pages = materialize(_landed_pages(spark, sf_dir), "landed-pages").withColumns({"total": landed.search_total(F.col("body")), "held": landed.search_held(F.col("body"))})
    of = ("brand", "at", "held", "total")
    each = F.struct(F.col("from"), F.concat_ws("-", "from", "to").alias("r"))
    missing = paging.gaps(pages, *of).groupBy("brand").agg(F.array_join(F.array_sort(F.collect_list(each))["r"], ",").alias("missing"))
    reached = paging.walked(pages, *of, step=5)
    offers_of = landed.search_pages(reached.select(F.col("brand").alias("b"), F.col("at").alias("page"), "body"))
    walk = offers_of.groupBy("b", "page").agg(F.count("*").alias("n"), F.sum("price").alias("price")).groupBy("b").agg(F.count("*").alias("n_walked"), F.sum("n").alias("n_offers"), F.sum("price").alias("price"))
    status = paging.complete(pages, *of).join(missing, "brand", "left")
    filled = status.join(walk, F.col("brand") == F.col("b"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return filled.select("brand", "n_pages", "n_held", "total", "n_missing", "complete", F.coalesce("missing", F.lit("")).alias("missing"), zero("n_walked"), zero("n_offers"), F.round(F.coalesce("price", F.lit(0.0)), 2).alias("price"))


@query("""
SELECT p_partkey AS part, i AS place, 'c' || p_partkey AS code, p_name || ' };</script>' AS name, p_retailprice AS price, CASE WHEN p_partkey % 3 = 0 THEN 'http://x/' || p_partkey ELSE 'https://i/' || p_partkey END AS "imageUrl", 'https://s/' || p_partkey AS "productUrl", (1 + p_size % 4)::INT AS n_pages
FROM part, (VALUES (0::INT), (3::INT)) t(i) WHERE p_partkey % 5 > 0 AND (i = 0 OR p_partkey % 2 = 0)
""")
def q67_page_state_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of the lists that pages' scripts hold; strings hold ends of scripts, and other objects follow. Some pages have none."""
    key = F.col("p_partkey").cast("string")
    picture = F.concat(F.when(key.cast("long") % 3 == 0, F.concat(F.lit("http://x/"), key)).otherwise(F.concat(F.lit("/"), key)), F.lit("?w=2"))
    product = lambda can, price, url: F.struct(F.concat(F.lit("c"), key).alias("code"), F.concat(F.lit(" "), "p_name", F.lit(" };</script>")).alias("name"), url.alias("url"), F.struct(price.alias("value")).alias("price"), F.struct(picture.alias("url")).alias("picture"), can.alias("purchasable"))
    some, url, price = F.lit(True), F.concat(F.lit("/"), key), F.col("p_retailprice")
    products = F.array(product(some, price, url), product(F.lit(False), price, url), product(some, F.lit(0.0), url), product(F.lit(None).cast("boolean"), price, F.when(key.cast("long") % 2 == 0, url)))
    listed = F.struct(F.struct(F.struct((F.col("p_size") % 4 + 1).alias("totalPages")).alias("pagination"), products.alias("products")).alias("product-list"))
    script = F.concat(F.lit("<script>window.data = "), F.to_json(F.struct(listed.alias("components"))), F.lit(';var more = {"components": {}};</script><b>}</b>'))
    html = F.when(F.col("p_partkey") % 5 > 0, script).otherwise("<p>window.data</p>")
    pages = landed.state_pages(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), html.alias("html")), "window[.]data")
    offers_of = landed.state_products(pages.withColumn("pages", F.col("n_pages")).drop("html"), "https://i", "https://s")
    return offers_of.select("part", "place", "code", "name", "price", "imageUrl", "productUrl", F.col("pages").alias("n_pages"))


@query("""
WITH p AS (SELECT p_partkey AS id, p_name || ' // ' || p_type AS name, (p_partkey % 4)::INT AS n_prices, CASE WHEN p_size % 3 = 0 THEN 'Nude,' || p_brand ELSE '' END AS shades FROM part),
h AS (SELECT count(*) AS n, count(*) FILTER (WHERE n_prices > 1) AS multi FROM p)
SELECT id, name, n_prices, shades FROM p
UNION ALL SELECT -1, '// Parts — ' || n || ' urun, ' || (SELECT count(DISTINCT p_brand) FROM part WHERE p_size > 0) || ' satici', 0, '' FROM h
UNION ALL SELECT -2, '// Otomatik uretildi: 01.02.2026', 0, '' FROM h
UNION ALL SELECT -3, '// Coklu fiyat: ' || multi || ' urunde birden fazla satici', 0, '' FROM h
""")
def q68_script_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published script, read back, filled with shades and written in its own place: the comment lines above it stay."""
    path, key = work_path(spark, "script"), F.col("p_partkey")
    part = table(spark, sf_dir, "part")
    price = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.struct(F.concat(F.lit("s"), i).alias("site"), F.col("p_retailprice").alias("price")))
    products = part.select(key.alias("id"), F.concat("p_name", F.lit(" // "), "p_type").alias("name"), F.slice(price, F.lit(1), (key % 4).cast("int")).alias("prices"))
    sellers = part.groupBy(F.col("p_brand").alias("site")).agg(F.count_if(F.col("p_size") > 0).alias("n"))
    sinks.publish_script(products, path, ["id"], sinks.script_header(sinks.summary(products, sellers), "Parts", "01.02.2026"))
    schema = "id long, name string, prices array<struct<site:string,price:double>>, shadeOptions array<string>"
    shades = part.select(key.alias("part"), F.when(F.col("p_size") % 3 == 0, F.array(F.lit("Nude"), F.col("p_brand"))).alias("found"))
    now = sinks.script_rows(spark, path, schema)
    sinks.publish_script(now.join(shades, F.col("id") == F.col("part"), "left").select("id", "name", "prices", F.coalesce("found", "shadeOptions").alias("shadeOptions")), path, ["id"])
    text = versions.read(spark, path, "value string").filter(F.col("value").startswith("//"))
    number = F.when(F.col("value").contains("satici") & F.col("value").contains("Parts"), -1).when(F.col("value").contains("Otomatik"), -2).otherwise(-3)
    rows = sinks.script_rows(spark, path, schema).select("id", "name", F.size("prices").alias("n_prices"), F.coalesce(F.array_join("shadeOptions", ","), F.lit("")).alias("shades"))
    return rows.union(text.select(number.cast("long"), F.col("value"), F.lit(0), F.lit("")))


@query("SELECT event_id, event_type FROM events")
def q69_batches_added_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpoint table that gets its batches by two writers, some of them again, after a snapshot that nothing replaced."""
    path, events = work_path(spark, "batches"), table(spark, sf_dir, "events").select("event_id", "event_type")
    turn = F.pmod(F.xxhash64("event_id"), F.lit(5))
    versions.replace(events.filter(turn == 0), path)
    versions.replace(events.limit(0), path, unless_empty=True)
    for writer, batch, of in (("a", 0, 1), ("a", 1, 2), ("b", 0, 3), ("a", 1, 2), ("a", 0, 1), ("b", 0, 3), ("b", 1, 4)):
        versions.append(events.filter(turn == of), path, writer, batch)
    return versions.read(spark, path, "event_id long, event_type string")
