"""The registered queries of the offer pipeline on the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerloom.functions import dictionaries as d
from offerloom.functions import links, prices, text
from offerloom.operators import masters, matching, offers, robots
from offerloom.operators.distinct import of_distinct
from offerloom.plans import sql_text as q
from offerloom.plans.integrate import clean_offers, integrate, variants_of_sellers
from offerloom.plans.samples import BRANDS, CATEGORIES, LINE_OFFERS, NAMED_PARTS, NAMES, line_offers, named_parts, pick, seller_offers, sql_list, sql_pick, table
from offerloom.sources import landed, markup, sinks
from offerloom.streaming import limiter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its own name, with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def cents(c: Column) -> Column:
    return prices.two_decimals(c)


CENTS = "floor({} * 100 + 0.5) / 100"
part_sql = lambda body: f"WITH {NAMED_PARTS}\n{body}"


@query(f"""
WITH {LINE_OFFERS},
best AS (SELECT part, site, min(price) AS price FROM offers GROUP BY part, site),
kept AS (SELECT * FROM (SELECT *, min(price) OVER (PARTITION BY part) AS least FROM best) WHERE price <= 3 * least)
SELECT part, count(*)::INT AS price_count, {CENTS.format("min(price)")} AS min_price, {CENTS.format("max(price)")} AS max_price,
       string_agg(site::VARCHAR, ',' ORDER BY price, site) AS sellers
FROM kept GROUP BY part
""")
def q01_best_offer_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest offer of each product and seller, without sellers above three times the cheapest."""
    best = line_offers(spark, sf_dir).groupBy("part", "site").agg(F.min("price").alias("price"))
    entries = best.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("price", "site"))).alias("p"))
    kept = entries.withColumn("p", matching.without_outliers(F.col("p")))
    least, most = F.col("p")[0]["price"], F.element_at("p", -1)["price"]
    return kept.select("part", F.size("p").alias("price_count"), cents(least).alias("min_price"), cents(most).alias("max_price"), F.array_join(F.transform("p", lambda x: x["site"].cast("string")), ",").alias("sellers"))


@query(f"""
WITH {LINE_OFFERS}
SELECT site, part, min(idx) AS first_idx, count(*)::INT AS variant_count, arg_min(idx, (price, idx)) AS rep_idx,
       {CENTS.format("min(price)")} AS min_price, {CENTS.format("max(price)")} AS max_price,
       string_agg(idx::VARCHAR, ',' ORDER BY price, idx) AS variants
FROM offers GROUP BY site, part
""")
def q02_variant_group_rep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_offers(spark, sf_dir).withColumns({"name": F.col("idx").cast("string"), "productUrl": F.lit("")})
    groups = matching.variant_groups(rows, ["site", "part"])
    return groups.select("site", "part", F.col("idx").alias("first_idx"), "variant_count", F.col("name").cast("long").alias("rep_idx"), cents(F.col("min_price")).alias("min_price"), cents(F.col("max_price")).alias("max_price"), F.array_join("variants.name", ",").alias("variants"))


@query(f"""
WITH {LINE_OFFERS}
SELECT first_value(idx) OVER (PARTITION BY site, part ORDER BY idx) AS group_idx, idx, row_number() OVER (PARTITION BY site, part ORDER BY price, idx) AS place, {CENTS.format("price")} AS price FROM offers
""")
def q70_variant_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All offers of a seller's product as rows, in the order in which they would be nested."""
    rows = line_offers(spark, sf_dir).withColumns({"name": F.col("idx").cast("string"), "productUrl": F.lit("")})
    place = F.row_number().over(Window.partitionBy("group_idx").orderBy("order", "idx")).cast("long")
    return matching.variant_members(rows, ["site", "part"]).select("group_idx", "idx", place.alias("place"), cents(F.col("price")).alias("price"))


def _master_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(F.col("part").cast("string").alias("site"), F.col("price").alias("price"), F.lit("").alias("url"), F.lit(1).alias("variantCount"), F.lit("").alias("imageUrl"))
    rows = named_parts(spark, sf_dir).withColumns({"tier": F.lit(0), "tier_key": F.col("part"), "idx": F.col("part"), "imageUrl": F.lit(""), "prices": F.array(entry)})
    return rows.drop("price")


@query(part_sql(f"""
, k AS (SELECT part, name, price, {q.brand_key("brand")} AS brand_key, category, {q.core_name("name", "brand")} AS core,
        coalesce(nullif({q.variant_shade("name")}, ''), 'Standart') AS shade, array_to_string({q.sizes("name")}, '-') AS size FROM parts)
SELECT brand_key, category, core, min(part) AS base, count(*)::INT AS n_variants,
       string_agg(shade || '/' || size, ';' ORDER BY price, part) AS variants, {CENTS.format("min(price)")} AS first_price
FROM k GROUP BY brand_key, category, core
"""))
def q03_master_nested_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = masters.master_groups(_master_input(spark, sf_dir))
    names = F.transform("variants", lambda v: F.concat(v["shade"], F.lit("/"), v["size"]))
    return made.select("brand_key", "category", "core", F.col("part").alias("base"), F.size("variants").alias("n_variants"), F.array_join(names, ";").alias("variants"), cents(F.col("variants")[0]["prices"][0]["price"]).alias("first_price"))


@query(part_sql(f"""
, k AS (SELECT part, price, {q.brand_key("brand")} AS brand_key, category, {q.core_name("name", "brand")} AS core, {q.variant_shade("name")} AS shade, array_to_string({q.sizes("name")}, '-') AS size FROM parts),
std AS (SELECT brand_key, category, core, min(part) AS std FROM k WHERE shade = '' AND size = '' GROUP BY ALL)
SELECT brand_key, category, core, sum(CASE WHEN std IS NULL OR part = std THEN 1 ELSE 2 END)::BIGINT AS n_prices
FROM k LEFT JOIN std USING (brand_key, category, core) GROUP BY brand_key, category, core
"""))
def q04_standard_price_inherit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of a master's variants, with those that the plain variant gives to the others."""
    made = masters.master_groups(_master_input(spark, sf_dir))
    total = F.aggregate("variants", F.lit(0).cast("long"), lambda s, v: s + F.size(v["prices"]))
    return made.select("brand_key", "category", "core", total.alias("n_prices"))


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = line_offers(spark, sf_dir)
    code = F.when(F.col("part") % 7 < 6, F.lpad((F.col("part") % 400 + 8680000000000).cast("string"), 13, "8")).otherwise("123")
    return matching.with_features(
        line.select(
            "idx", F.col("site").cast("string").alias("site"), pick(NAMES, F.col("part") % 5).alias("name"), pick(BRANDS, (F.col("part") % 400) % 3).alias("brand"), pick(CATEGORIES, F.col("part") % 5).alias("category"),
            "price", F.col("price").alias("min_price"), F.lit(1).alias("variant_count"), F.lit("").alias("productUrl"), F.lit("").alias("imageUrl"), code.alias("barcode"),
        )
    )


@query(f"""
WITH {LINE_OFFERS},
c AS (SELECT idx, site::VARCHAR AS site, price, CASE WHEN part % 7 < 6 THEN lpad((part % 400 + 8680000000000)::VARCHAR, 13, '8') ELSE '123' END AS barcode,
             {sql_pick(NAMES, "(part % 5)")} AS name, {sql_pick(BRANDS, "((part % 400) % 3)")} AS brand, {sql_pick(CATEGORIES, "(part % 5)")} AS category FROM offers),
r AS (SELECT * FROM c WHERE length(barcode) IN (8, 12, 13)),
b AS (SELECT barcode, site, min(idx) AS site_idx, arg_min(idx, (price, idx)) AS idx FROM r GROUP BY barcode, site),
n AS (SELECT barcode, name, brand, category, {q.brand_key("brand")} AS bk, array_to_string({q.sizes("name")}, ',') AS sz, {q.word_set("name")} AS ws, {q.shade_codes("name", "brand")} AS sh, idx FROM r),
s AS (SELECT b.*, n.bk, n.sz, n.ws, n.category, n.sh, r.price FROM b JOIN n USING (barcode, idx) JOIN r USING (barcode, idx)),
u AS (SELECT barcode, bk, sz, ws, category, sh, min(site_idx) AS i, count(*) AS n FROM s GROUP BY ALL),
bad AS (
  SELECT DISTINCT x.barcode FROM u x JOIN u y ON x.barcode = y.barcode
  WHERE NOT (x.bk = y.bk AND (x.sz = '' OR y.sz = '' OR x.sz = y.sz) AND greatest(len(x.ws), len(y.ws)) > 0
    AND len(list_intersect(x.ws, y.ws)) >= 0.25 * greatest(len(x.ws), len(y.ws)) AND {q.compatible("x.category", "y.category")}
    AND (len(x.sh) = 0 OR len(y.sh) = 0 OR list_has_any(x.sh, y.sh)))),
g AS (SELECT barcode, count(*) AS n_sites FROM s WHERE barcode NOT IN (SELECT barcode FROM bad) GROUP BY barcode HAVING count(*) >= 2),
k AS (SELECT * FROM (SELECT s.*, min(price) OVER (PARTITION BY barcode) AS least FROM s JOIN g USING (barcode)) WHERE price <= 3 * least)
SELECT barcode, arg_min(s.idx, s.site_idx) AS base_idx, (SELECT count(*) FROM k WHERE k.barcode = s.barcode)::INT AS n_prices, count(*) AS n_consumed
FROM s JOIN g USING (barcode) GROUP BY barcode
""")
def q05_key_match_multi_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = ["idx", "site", "price", "min_price", "variant_count", "productUrl", "imageUrl", "barcode", "category", "brand_key", "sizes", "word_set", "shades"]
    coded = matching.materialize(_coded(spark, sf_dir).select(*needed), "coded")
    matched, used = matching.barcode_matches(coded)
    taken = coded.join(used, "idx").groupBy("barcode").agg(F.count("*").alias("n_consumed"))
    return matched.select("barcode", F.col("idx").alias("base_idx"), F.size("prices").alias("n_prices")).join(taken, "barcode")


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = named_parts(spark, sf_dir)
    rows = part.select(
        F.col("part").alias("idx"), F.concat(F.lit("s"), F.col("part") % 5).alias("site"), "name", "brand", "category", "price", F.col("price").alias("min_price"),
        F.lit(1).alias("variant_count"), F.lit("").alias("productUrl"), F.lit("").alias("imageUrl"), F.lit("").alias("barcode"),
    )
    return matching.with_features(rows)


_PAIRS = rf"""
, f AS (
  SELECT part AS idx, 's' || (part % 5) AS site, name, category, price, {q.brand_key("brand")} AS bk, {q.core_name("name", "brand")} AS core, {q.product_line("name", "brand")} AS line,
         {q.shade_codes("name", f"({q.brand_key('brand')})")} AS sh, {q.sizes("name")} AS sz,
         {q.matches("name", r"\b(?:seyahat|travel|mini|minyat[uü]r|sample|deneme)\b")} AS tr, {q.matches("name", r"\b(?:waterproof|su\s*ge[cç]irmez)\b")} AS wp
  FROM parts),
w AS (SELECT *, {q.compared("core")} AS cw, {q.tokens("core")} AS tk, list_distinct(list_filter({q.synonyms(q.tokens("core"))}, lambda w: w NOT IN ({q.GENERIC}))) AS sig FROM f),
x AS (SELECT *, list_distinct({q.synonyms("cw")}) AS st, {q.bigrams("cw")} AS bg FROM w),
base AS (SELECT bk, arg_min(site, idx) AS base_site FROM x GROUP BY bk HAVING count(DISTINCT site) > 1),
p AS (
  SELECT a.bk, a.idx AS base_idx, b.idx AS cand_idx, b.site AS cand_site, a.category AS ca, b.category AS cb, a.price AS pa, b.price AS pb, a.sz AS za, b.sz AS zb, a.sh AS ha, b.sh AS hb,
         a.tr = b.tr AND a.wp = b.wp AS flags, a.line <> '' AND b.line <> '' AS lines, a.line = b.line AS same_line, len(a.tk) <= 2 OR len(b.tk) <= 2 AS short,
         len(list_filter(a.sig, lambda v: NOT list_contains(b.sig, v))) + len(list_filter(b.sig, lambda v: NOT list_contains(a.sig, v))) AS unmatched,
         CASE WHEN len(a.tk) = 0 OR len(b.tk) = 0 THEN 0.0 ELSE greatest(
           len(list_intersect(a.st, b.st))::DOUBLE / greatest(len(a.st), len(b.st), 1),
           CASE WHEN len(a.bg) > 0 AND len(b.bg) > 0 THEN len(list_filter(a.bg, lambda v: list_contains(b.bg, v)))::DOUBLE / greatest(len(a.bg), len(b.bg)) ELSE 0.0 END) END AS sim
  FROM x a JOIN base ON a.bk = base.bk AND a.site = base.base_site JOIN x b ON a.bk = b.bk AND b.site <> base.base_site),
pairs AS (
  SELECT bk AS brand_key, cand_site, base_idx, cand_idx, sim FROM p
  WHERE {q.compatible("ca", "cb")} AND (len(za) = 0 OR len(zb) = 0 OR list_has_any(za, zb)) AND ((len(za) > 0) = (len(zb) > 0) OR greatest(pa, pb) <= 2 * least(pa, pb))
  AND (len(ha) = 0 OR len(hb) = 0 OR list_has_any(ha, hb)) AND flags AND (NOT lines OR same_line)
  AND sim > 0 AND sim >= greatest(CASE WHEN lines AND same_line THEN 0.78 ELSE 0.85 END, CASE WHEN short THEN 0.90 ELSE 0.0 END)
  AND (unmatched = 0 OR unmatched = 1 AND lines AND same_line) AND greatest(pa, pb) <= 3 * least(pa, pb))
"""


@query(part_sql(_PAIRS + "SELECT brand_key, cand_site, base_idx, cand_idx, floor(sim * 10000 + 0.5) / 10000 AS sim FROM pairs"))
def q06_blocked_fuzzy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fuzzy(_named(spark, sf_dir)).withColumn("sim", F.floor(F.col("sim") * 10000 + 0.5) / 10000)


def _fuzzy(named: DataFrame) -> DataFrame:
    return matching.fuzzy_pairs(*matching.sides(matching.materialize(named, "fuzzy-features")))


_WALK = """,
steps AS (SELECT brand_key, cand_site, base_idx, row_number() OVER (PARTITION BY brand_key, cand_site ORDER BY base_idx) AS k FROM (SELECT DISTINCT brand_key, cand_site, base_idx FROM pairs)),
walk AS (
  SELECT DISTINCT brand_key, cand_site, 0::BIGINT AS k, []::BIGINT[] AS taken, NULL::BIGINT AS base_idx, NULL::BIGINT AS cand_idx FROM pairs
  UNION ALL
  SELECT w.brand_key, w.cand_site, w.k + 1, list_concat(w.taken, [arg_min(p.cand_idx, (-p.sim, p.cand_idx)) FILTER (NOT list_contains(w.taken, p.cand_idx))]), s.base_idx,
         arg_min(p.cand_idx, (-p.sim, p.cand_idx)) FILTER (NOT list_contains(w.taken, p.cand_idx))
  FROM walk w JOIN steps s ON s.brand_key = w.brand_key AND s.cand_site = w.cand_site AND s.k = w.k + 1
  JOIN pairs p ON p.brand_key = s.brand_key AND p.cand_site = s.cand_site AND p.base_idx = s.base_idx
  GROUP BY w.brand_key, w.cand_site, w.k, w.taken, s.base_idx)
"""


@query(part_sql(_PAIRS + _WALK + "SELECT brand_key, cand_site, base_idx, cand_idx FROM walk WHERE cand_idx IS NOT NULL").replace("WITH", "WITH RECURSIVE", 1))
def q07_greedy_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate a base and seller; its SQL walks over the bases one by one."""
    rows = matching.materialize(_named(spark, sf_dir), "assignment-features")
    bases, others = matching.sides(rows)
    of = rows.select(F.col("idx").alias("cand_idx"), "brand_key", F.col("site").alias("cand_site"))
    return matching.assignment(bases, others).join(of, "cand_idx").select("brand_key", "cand_site", "base_idx", "cand_idx")


_USED = f"""first AS (SELECT barcode, site, min(idx) AS site_idx, arg_min(idx, (price, idx)) AS idx FROM coded GROUP BY barcode, site),
s AS (SELECT coded.*, site_idx FROM first JOIN coded USING (barcode, idx)),
bad AS (
  SELECT DISTINCT a.barcode FROM s a JOIN s b ON a.barcode = b.barcode
  WHERE NOT (a.bk = b.bk AND (a.sz = '' OR b.sz = '' OR a.sz = b.sz) AND greatest(len(a.ws), len(b.ws)) > 0
    AND len(list_intersect(a.ws, b.ws)) >= 0.25 * greatest(len(a.ws), len(b.ws)) AND {q.compatible("a.category", "b.category")}
    AND (len(a.sh) = 0 OR len(b.sh) = 0 OR list_has_any(a.sh, b.sh)))),
used AS (SELECT * FROM s WHERE barcode NOT IN (SELECT barcode FROM bad) AND barcode IN (SELECT barcode FROM s GROUP BY barcode HAVING count(*) > 1))"""
_TIERS = rf"""
, coded AS (
  SELECT part AS idx, 's' || (part % 5) AS site, price, category, {q.brand_key("brand")} AS bk, array_to_string({q.sizes("name")}, ',') AS sz, {q.word_set("name")} AS ws, {q.shade_codes("name", "brand")} AS sh,
         (8690000000000 + CASE WHEN part % 22 = 0 THEN part % 264 ELSE 300 + part % 21 END)::VARCHAR AS barcode
  FROM parts WHERE part % 11 = 0),
{_USED}
{_PAIRS.replace("FROM parts)", "FROM parts WHERE part NOT IN (SELECT idx FROM used))")}{_WALK.rstrip()},
chosen AS (SELECT base_idx, cand_idx FROM walk WHERE cand_idx IS NOT NULL),
bases AS (SELECT x.idx, x.price FROM x JOIN base ON x.bk = base.bk AND x.site = base.base_site),
entries AS (
  SELECT 0 AS tier, barcode AS product, price FROM used
  UNION ALL SELECT 1, idx::VARCHAR, price FROM bases
  UNION ALL SELECT 1, base_idx::VARCHAR, x.price FROM chosen JOIN x ON x.idx = cand_idx
  UNION ALL SELECT 2, idx::VARCHAR, price FROM x WHERE idx NOT IN (SELECT idx FROM bases) AND idx NOT IN (SELECT cand_idx FROM chosen)),
products AS (
  SELECT tier, product, count(*) FILTER (price <= 3 * least) AS n
  FROM (SELECT *, min(price) OVER (PARTITION BY tier, product) AS least FROM entries) GROUP BY tier, product)
SELECT tier, CASE WHEN tier = 0 THEN 'barcode' WHEN n > 1 THEN 'name' ELSE 'single' END AS match_method, count(*) AS n_products, sum(n)::BIGINT AS n_prices FROM products GROUP BY ALL
"""


@query(part_sql(_TIERS).replace("WITH", "WITH RECURSIVE", 1))
def q08_leftover_union_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products and prices by tier; of the barcodes some hold one product of several sellers, others products that don't agree."""
    code = F.when(F.col("idx") % 22 == 0, F.col("idx") % 264).when(F.col("idx") % 11 == 0, F.col("idx") % 21 + 300)
    rows = matching.materialize(_named(spark, sf_dir).withColumn("barcode", F.coalesce((code + 8690000000000).cast("string"), F.lit(""))), "tiers")
    return matching.matched(rows).groupBy("tier", "match_method").agg(F.count("*").alias("n_products"), F.sum(F.size("prices")).alias("n_prices"))


_QF = rf"""
SELECT part, CASE
  WHEN price < 5 THEN 'price_low'
  WHEN length(n) < 5 THEN 'name_short'
  WHEN {q.matches("n", r"^gratis\s+kart\s+ile\b")} THEN 'card_price'
  WHEN {q.matches("n", r"^\d+\s+(?:tür|renk|çeşit|adet|tip)$")} THEN 'count_only'
  WHEN length(trim(brand)) = 0 AND length(n) < 10 THEN 'no_brand_short'
  WHEN regexp_matches(lower(brand), '{"|".join(d.STORE_WORDS)}') THEN 'store_brand'
  WHEN {q.matches("n", "|".join(d.CATALOGUE_WORDS))} THEN 'catalogue'
  WHEN {q.matches("n", r"\d{4}\s*\|")} OR {q.matches("n", r"\|\s*trendyol")} THEN 'catalogue_title'
  WHEN {q.matches("n", "|".join(d.BANNER_WORDS))} THEN 'banner'
  WHEN part * 30 > 50000 THEN 'reviews_high'
  WHEN {q.matches("n", "|".join(d.GIFT_WORDS))} THEN 'gift'
  WHEN {q.matches("n", r"\b\d['’]?l[iıuü]\s*(?:set|paket)\b")} THEN 'multi_set'
  WHEN {q.matches("n", r"\b\d['’]?l[iıuü]\s*maskara\b")} THEN 'multi_mascara'
  WHEN {q.matches("n", r"\b(?:kalemli|hediyeli|kremli)\s+(?:maskara|ruj|far)\b")} THEN 'combo_before'
  WHEN {q.matches("n", r"\b(?:maskara|ruj|far)\s+(?:kalemli|hediyeli|kremli)\b")} THEN 'combo_after'
  WHEN {q.matches("n", r"göz\s*kalemli\s")} THEN 'combo_pencil'
  WHEN price > 10000 THEN 'price_high'
  WHEN {q.matches("n", r"\b(?:" + "|".join(d.CAR_WORDS) + r")\b")} THEN 'car'
  WHEN {q.matches("n", r"\b(?:" + "|".join(d.OTHER_GOODS) + r")\b")} THEN 'other_goods'
  WHEN {q.matches("n", r"\b(?:" + "|".join(d.CLOTHES) + r")\b")} THEN 'clothes'
  WHEN {q.matches("n", r"&.*hediye\b")} OR {q.matches("n", r"&.*\bset\b")} THEN 'with_gift'
  WHEN length(n) > 120 THEN 'name_long' END AS reject_reason
FROM (SELECT *, trim(name) AS n FROM parts)
"""


@query(part_sql(_QF))
def q09_quality_filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = named_parts(spark, sf_dir).withColumn("reviews", F.col("part") * 30)
    return offers.with_reject_reason(rows).select("part", "reject_reason")


@query(part_sql(f"SELECT part, {q.first_contained('lower(name)', ((k, c) for c, keys in d.CATEGORY_RULES for k in keys), 'category')} AS category FROM parts"))
def q10_category_first_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_parts(spark, sf_dir).select("part", text.category_by_name(F.col("name"), F.col("category")).alias("category"))


@query(part_sql(f"SELECT part, {q.brand_key('brand')} AS brand_key, CASE WHEN trim(brand) = '' THEN '' ELSE {q.lookup('(' + q.brand_key('brand') + ')', d.BRAND_DISPLAY, 'brand')} END AS shown FROM parts"))
def q11_brand_normalise_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_parts(spark, sf_dir).select("part", text.brand_key(F.col("brand")).alias("brand_key"), text.brand_shown(F.col("brand")).alias("shown"))


@query(part_sql(f"SELECT part, {q.core_name('name', 'brand')} AS core, {q.product_line('name', 'brand')} AS line FROM parts"))
def q12_core_name_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, brand = F.col("name"), F.col("brand")
    rules = {"core": text.core_name(name, brand), "line": text.product_line(name, brand)}
    return of_distinct(named_parts(spark, sf_dir), ["name", "brand"], lambda names: names.withColumns(rules)).select("part", "core", "line")


@query(part_sql(f"SELECT part, {q.variant_shade('name')} AS shade, array_to_string({q.sizes('name')}, '-') AS size, array_to_string({q.shade_codes('name', 'brand')}, ',') AS codes FROM parts"))
def q13_shade_size_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("name")
    return named_parts(spark, sf_dir).select("part", text.variant_shade(name).alias("shade"), text.variant_size(name).alias("size"), F.array_join(text.shade_codes(name, F.col("brand")), ",").alias("codes"))


@query(f"""
WITH n AS (SELECT unnest({sql_list(NAMES)}) AS name), c AS (SELECT name, {q.core_name("name", "''")} AS core FROM n),
w AS (SELECT name, core, {q.tokens("core")} AS tk, {q.compared("core")} AS cw FROM c), x AS (SELECT *, list_distinct({q.synonyms("cw")}) AS st, {q.bigrams("cw")} AS bg FROM w)
SELECT p_partkey AS part, a.name AS a, b.name AS b, floor(CASE WHEN len(a.tk) = 0 OR len(b.tk) = 0 THEN 0.0 ELSE greatest(
         len(list_intersect(a.st, b.st))::DOUBLE / greatest(len(a.st), len(b.st), 1),
         CASE WHEN len(a.bg) > 0 AND len(b.bg) > 0 THEN len(list_filter(a.bg, lambda v: list_contains(b.bg, v)))::DOUBLE / greatest(len(a.bg), len(b.bg)) ELSE 0.0 END) END * 10000 + 0.5) / 10000 AS sim
FROM part JOIN x a ON a.name = {sql_pick(NAMES, "p_partkey")} JOIN x b ON b.name = {sql_pick(NAMES, "p_size")}
""")
def q14_token_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), pick(NAMES, F.col("p_partkey")).alias("a"), pick(NAMES, F.col("p_size")).alias("b"))
    none = F.lit("")
    cores = {"ca": text.core_name(F.col("a"), none), "cb": text.core_name(F.col("b"), none)}
    sim = F.floor(text.similarity(F.col("ca"), F.col("cb")) * 10000 + 0.5) / 10000
    return of_distinct(part, ["a", "b"], lambda pairs: pairs.withColumns(cores).withColumn("sim", sim)).select("part", "a", "b", "sim")


@query("""
WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]{8,14}')) AS code FROM documents)
SELECT doc_id, code, length(code) IN (8, 12, 13) AND NOT (length(code) = 8 AND starts_with(code, '30')) AND NOT (length(code) = 13 AND starts_with(code, '205')) AS reliable FROM c
""")
def q15_barcode_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9]{8,14}"), F.lit(0))).alias("code"))
    return codes.select("doc_id", "code", text.reliable_barcode(F.col("code")).alias("reliable"))


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY text")
def q16_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return offers.keep_first(docs, ["digest"], "doc_id")


@query(f"WITH {LINE_OFFERS} SELECT site, part, arg_min(idx, (price, idx)) AS idx, min(idx) AS first_idx, {CENTS.format('min(price)')} AS price FROM offers GROUP BY site, part")
def q17_dedup_keep_cheapest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offers.keep_cheapest(line_offers(spark, sf_dir), ["site", "part"]).withColumn("price", cents(F.col("price"))).select("site", "part", "idx", "first_idx", "price")


@query(r"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '\?.*$', ''), '/ref=.*$', '') AS clean,
       regexp_extract(url, '://[^/?#]*/([^/?#]*)', 1) AS segment FROM pages
""")
def q18_url_canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", links.clean(F.col("url")).alias("clean"), links.first_segment(F.col("url")).alias("segment"))


@query("""
WITH a AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS t FROM pages)
SELECT page_id, (unnest(range(len(h))))::INT AS card, unnest(h) AS href, unnest(t) AS label FROM a
""")
def q19_html_links_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = markup.Cards(card=("a", ""), fields={"href": (("a", "", "href"),), "label": (("a", "", ""),)})
    return markup.cards(table(spark, sf_dir, "pages"), layout, "page_id")


#: The sample of robots rules.
ROBOTS = (("disallow", "/en/"), ("allow", "/en/1"), ("disallow", "/fr/*2"), ("allow", "/fr/"), ("disallow", "/de/39"), ("allow", "/de/39"))


@query(r"""
WITH r(kind, pattern) AS (VALUES ('disallow', '/en/'), ('allow', '/en/1'), ('disallow', '/fr/*2'), ('allow', '/fr/'), ('disallow', '/de/39'), ('allow', '/de/39')),
p AS (SELECT page_id, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
h AS (SELECT page_id, kind, pattern FROM p JOIN r ON CASE WHEN contains(pattern, '*') THEN regexp_matches(path, '^' || replace(pattern, '*', '.*')) ELSE starts_with(path, pattern) END),
b AS (SELECT page_id, arg_max(kind, (length(pattern), kind = 'disallow')) AS kind FROM h GROUP BY page_id)
SELECT p.page_id, path, coalesce(kind = 'allow', true) AS allowed FROM p LEFT JOIN b USING (page_id)
""")
def q20_robots_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1).alias("path"))
    return robots.decisions(paths, spark.createDataFrame(ROBOTS, "kind string, pattern string"), "page_id")


@query("""
WITH e AS (SELECT event_type AS cat, event_id // 60 + 1 AS page, user_id AS item FROM events),
f AS (SELECT cat, item, min(page) AS page FROM e GROUP BY cat, item), n AS (SELECT cat, page, count(*) AS n_new FROM f GROUP BY cat, page),
p AS (SELECT cat, page, count(DISTINCT item) AS n_keys FROM e GROUP BY cat, page),
s AS (SELECT p.*, coalesce(n_new, 0) AS n_new, page > 1 AND coalesce(n_new, 0) < 0.2 * n_keys OR page > 1 AND n_new IS NULL AS stops FROM p LEFT JOIN n USING (cat, page)),
o AS (SELECT *, coalesce(bool_or(stops) OVER (PARTITION BY cat ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS over FROM s)
SELECT cat, page, n_keys, n_new, stops FROM o WHERE NOT over
""")
def q21_adaptive_page_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("cat"), (F.floor(F.col("event_id") / 60) + 1).alias("page"), F.col("user_id").alias("item"))
    return offers.kept_pages(rows, ["cat"], "page", "item").select("cat", "page", "n_keys", "n_new", "stops").distinct()


@query("""
WITH RECURSIVE e AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
w AS (
  SELECT event_id, user_id, ts, k, ts AS start, 1::BIGINT AS count FROM e WHERE k = 1
  UNION ALL
  SELECT e.event_id, e.user_id, e.ts, e.k, CASE WHEN e.ts > w.start + INTERVAL 1 DAY THEN e.ts ELSE w.start END, CASE WHEN e.ts > w.start + INTERVAL 1 DAY THEN 1 ELSE w.count + 1 END
  FROM w JOIN e ON e.user_id = w.user_id AND e.k = w.k + 1)
SELECT event_id, user_id, count, count > 5 AS limited FROM w
""")
def q22_rate_limiter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return limiter.counted(events, "user_id", "ts", 86400, 5, "event_id").select("event_id", "user_id", "count", "limited")


@query(r"""
WITH m AS (SELECT doc_id, regexp_extract(text, '[A-Za-z0-9._-]+@[A-Za-z0-9._-]+', 0) AS email FROM documents)
SELECT doc_id, email, CASE WHEN doc_id % 3 = 0 THEN 405 WHEN doc_id % 5 = 0 THEN 429
       WHEN email = '' OR NOT regexp_matches(email, '^[^\s@]+@[^\s@]+\.[^\s@]{2,}$') OR doc_id % 7 = 0 THEN 400 ELSE 200 END AS status FROM m
""")
def q23_request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract("text", "[A-Za-z0-9._-]+@[A-Za-z0-9._-]+", 0).alias("email"))
    method = F.when(F.col("doc_id") % 3 == 0, "GET").otherwise("POST")
    product = F.when(F.col("doc_id") % 7 == 0, "1x").otherwise(F.col("doc_id").cast("string"))
    return rows.withColumn("status", limiter.response(method, F.col("doc_id") % 5 == 0, product, F.col("email")))


@query("""
WITH r(hb, hp, db, dp) AS (VALUES ('BRAND#2', 'red', 'BRAND#4', 'blue'), ('BRAND#17', 'ring', 'BRAND#3', 'bolt')),
p AS (SELECT p_partkey AS id, upper(p_brand) AS b, lower(p_name) AS n FROM part)
SELECT DISTINCT h.id AS high_id, x.id AS dupe_id FROM r JOIN p h ON h.b = hb AND contains(h.n, hp) JOIN p x ON x.b = db AND contains(x.n, dp)
""")
def q24_dupe_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([("BRAND#2", "red", "BRAND#4", "blue"), ("BRAND#17", "ring", "BRAND#3", "bolt")], "high_brand string, high_part string, dupe_brand string, dupe_part string")
    products = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"))
    return masters.substitute_links(products, rules)


@query("""
WITH r(rule, hb, hp, db, dp) AS (VALUES ('red', 'BRAND#2', 'red', 'BRAND#4', 'blue'), ('ring', 'BRAND#17', 'ring', 'BRAND#3', 'bolt'), ('', 'BRAND#5', '', 'BRAND#5', 'o')),
p AS (SELECT p_partkey AS id, upper(p_brand) AS b, lower(p_name) AS n FROM part),
s AS (SELECT rule, (SELECT count(*) FROM p WHERE b = hb AND contains(n, hp)) AS n_high, (SELECT count(*) FROM p WHERE b = db AND contains(n, dp)) AS n_dupe FROM r)
SELECT n_high, n_dupe, n_high * n_dupe AS n_links FROM s WHERE n_high + n_dupe > 0
""")
def q71_substitute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many products the rules find for either side, and how many links that is, without making them."""
    rules = spark.createDataFrame([("BRAND#2", "red", "BRAND#4", "blue"), ("BRAND#17", "ring", "BRAND#3", "bolt"), ("BRAND#5", "", "BRAND#5", "o")], "high_brand string, high_part string, dupe_brand string, dupe_part string")
    products = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"))
    return masters.substitute_counts(masters.substitute_classes(products, rules)).drop("rule")


_IMAGE = "CASE WHEN {0} % 4 = 0 THEN 'data:image/x' WHEN {0} % 4 = 1 THEN '' ELSE 'http://img/' || {0} END"


@query(f"""
WITH {LINE_OFFERS},
b AS (SELECT part, ({sql_list(d.IMAGE_SELLERS + d.SELLERS)})[(site % 14 + 1)::INT] AS seller, min(idx) AS idx FROM offers GROUP BY ALL),
i AS (SELECT *, {_IMAGE.format("idx")} AS image FROM b),
o AS (SELECT part, arg_min(seller, idx) AS seller, arg_min(image, idx) AS image FROM i GROUP BY part),
e AS (SELECT part, seller, arg_min(image, idx) AS image FROM i WHERE image <> '' GROUP BY part, seller),
r AS (SELECT unnest({sql_list(d.IMAGE_SELLERS)}) AS seller, unnest(range(5)) AS rank),
c AS (
  SELECT part, rank * 2 AS k, image FROM o JOIN r USING (seller) UNION ALL SELECT part, rank * 2 + 1, image FROM e JOIN r USING (seller)),
g AS (SELECT part, arg_min(image, k) AS image FROM c WHERE image <> '' AND NOT contains(image, 'data:image') AND NOT contains(image, 'placeholder') GROUP BY part)
SELECT o.part, coalesce(g.image, o.image) AS image FROM o LEFT JOIN g USING (part)
""")
def q25_image_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = line_offers(spark, sf_dir).groupBy("part", pick(d.IMAGE_SELLERS + d.SELLERS, F.col("site")).alias("seller")).agg(F.min("idx").alias("idx"))
    image = F.when(F.col("idx") % 4 == 0, "data:image/x").when(F.col("idx") % 4 == 1, "").otherwise(F.concat(F.lit("http://img/"), F.col("idx")))
    rows = best.withColumn("image", image).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("idx", F.col("seller").alias("site"), F.col("image").alias("imageUrl")))).alias("e"))
    return rows.select("part", masters.best_image(F.col("e")[0]["site"], F.col("e")[0]["imageUrl"], F.col("e")).alias("image"))


@query("""
WITH c AS (SELECT o_custkey AS cust, avg(o_totalprice) / 60000.0 AS rating, count(*) * 40 AS reviews FROM orders GROUP BY o_custkey)
SELECT cust, (rating >= 4.6 AND reviews >= 100) OR (rating >= 4.4 AND reviews >= 500) OR (rating >= 4.8 AND reviews >= 30) AS trending FROM c
""")
def q26_trending_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("cust")).agg((F.avg("o_totalprice") / 60000.0).alias("rating"), (F.count("*") * 40).alias("reviews"))
    return rows.select("cust", masters.trending(F.col("rating"), F.col("reviews")).alias("trending"))


@query("SELECT p_type AS \"categoryLabel\", count(*) AS n FROM part GROUP BY p_type")
def q27_category_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.category_report(table(spark, sf_dir, "part").withColumnRenamed("p_type", "categoryLabel"))


@query(part_sql("SELECT count(*) AS n, count(*) FILTER (part % 5 = 0) AS n_barcode, count(*) FILTER (brand <> '') AS n_brand, count(*) FILTER (price > 0) AS n_price FROM parts"))
def q28_coverage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.coverage(named_parts(spark, sf_dir).withColumn("barcode", F.when(F.col("part") % 5 == 0, "x").otherwise("")))


@query("""
SELECT 'customer' AS site, c_name AS name, 0::INT AS source_rank, c_custkey AS idx FROM customer
UNION ALL SELECT 'supplier', s_name, 1::INT, (1::BIGINT << 52) + s_suppkey FROM supplier
""")
def q29_union_sources_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("pos"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("pos"))
    return offers.union_sources({"customer": a, "supplier": b}, ("customer", "supplier")).select("site", "name", "source_rank", "idx")


@query("""
WITH l AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE quality END AS v FROM labels)
SELECT doc_id, 'no_key' AS todo FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM l)
UNION ALL SELECT doc_id, 'no_value' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM l WHERE v IS NOT NULL)
""")
def q30_resume_todo_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    done = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("doc_id") % 4 != 0, F.col("quality")).alias("v"))
    by_key, by_value = offers.todo(docs, done, "doc_id"), offers.todo(docs, done, "doc_id", "v")
    return by_key.withColumn("todo", F.lit("no_key")).unionByName(by_value.withColumn("todo", F.lit("no_value")))


#: The sample of price texts.
PRICE_TEXTS = ("1.234,50 TL", "474,99 TL", "833 TL", "2.856 TL", "474,99", "-17%662,50 TL", "129,00", "4.5", "799,90 TL 399,00 TL", "", "abc", "662.5")


@query(rf"""
WITH t AS (SELECT o_orderkey AS id, {sql_pick(PRICE_TEXTS, "o_orderkey")} AS s FROM orders),
a AS (
  SELECT id, s, regexp_replace(regexp_replace(s, '[^0-9,]', '', 'g'), '^([0-9]*),', '\1.') AS cs, regexp_extract(s, '(\d[\d.]*(?:,\d+)?)\s*(?:TL|₺)', 1) AS la, regexp_extract(s, '^[\d.]+,\d{{2}}$') AS st, regexp_extract(s, '\d+[.,]\d+') AS fp FROM t)
SELECT id, s, coalesce(try_cast(nullif(cs, '') AS DOUBLE), 0) AS comma_strip,
       coalesce(try_cast(nullif(replace(replace(la, '.', ''), ',', '.'), '') AS DOUBLE), 0) AS lira_anchored,
       coalesce(try_cast(nullif(replace(replace(st, '.', ''), ',', '.'), '') AS DOUBLE), 0) AS strict,
       coalesce(try_cast(nullif(replace(replace(fp, '.', ''), ',', '.'), '') AS DOUBLE), 0) AS first_pair FROM a
""".replace("coalesce(try_cast(nullif(cs, '') AS DOUBLE), 0)", "coalesce(try_cast(nullif(regexp_extract(cs, '^[0-9]*\\.?[0-9]*'), '') AS DOUBLE), 0)"))
def q31_price_text_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), pick(PRICE_TEXTS, F.col("o_orderkey")).alias("s"))
    return rows.select("id", "s", *(prices.PROFILES[p](F.col("s")).alias(p) for p in ("comma_strip", "lira_anchored", "strict", "first_pair")))


ROBOTS_TEXT = "User-agent: a\nDisallow:\nUser-agent: *\nDisallow: /x\nAllow: /x/y\nCrawl-delay: 3\n\nUser-agent: b\nDisallow: /"


@query("SELECT n_name AS host, unnest(['disallow', 'allow', 'crawl-delay']) AS kind, unnest(['/x', '/x/y', '3']) AS pattern FROM nation")
def q32_robots_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "nation").select(F.col("n_name").alias("host"), F.lit(ROBOTS_TEXT).alias("body"))
    return robots.parsed_rules(files, "*")


@query("SELECT p_partkey AS part, p_name AS name, 'u' || p_partkey AS \"productUrl\", 'i' AS \"imageUrl\", floor(p_retailprice * 100 + 0.5) / 100 AS price FROM part WHERE p_retailprice > 0")
def q33_jsonld_itemlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.to_json(F.struct(F.struct(F.col("p_name").alias("name"), F.lit("i").alias("image"), F.concat(F.lit("u"), "p_partkey").alias("url"), F.struct(F.col("p_retailprice").alias("lowPrice")).alias("offers")).alias("item")))
    html = F.concat(F.lit('<html><script type="application/ld+json">{"@type":"ItemList","itemListElement":['), item, F.lit("]}</script></html>"))
    pages = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), html.alias("html"))
    return markup.item_lists(pages, "part")


@query("SELECT p_partkey AS part, p_name AS name, p_brand AS brand, lpad(p_partkey::VARCHAR, 8, '4') AS barcode, p_size / 100.0 AS price FROM part WHERE p_size > 0 AND p_partkey % 9 <> 0")
def q34_attribute_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    attribute = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
    body = F.to_json(F.struct(F.struct(
        F.when(F.col("p_partkey") % 9 == 0, "OUT_OF_STOCK").otherwise("IN_STOCK").alias("stockStatus"),
        F.struct(F.lit(0.0).alias("discountedPrice"), F.col("p_size").cast("double").alias("normalPrice")).alias("prices"),
        F.array(attribute("name", F.lit("old")), attribute("name", F.col("p_name")), attribute("brandName", F.col("p_brand")), attribute("barcode", F.lpad(F.col("p_partkey").cast("string"), 8, "4"))).alias("attributes"),
    ).alias("product")))
    bodies = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), body.alias("body"))
    return landed.detail_pages(bodies).select("part", "name", "brand", "barcode", "price")


@query("SELECT l_orderkey, l_linenumber, least(CASE WHEN l_discount > 0 THEN l_discount END, CASE WHEN l_tax > 0 THEN l_tax END, l_quantity) AS price FROM lineitem")
def q35_min_positive_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", prices.least_positive(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity")).alias("price"))


@query("""
SELECT p_partkey AS part, CASE WHEN p_partkey % 3 = 0 THEN 'own,' || p_type || CASE WHEN p_name <> p_type THEN ',' || p_name ELSE '' END ELSE 'own' END AS shades FROM part
""")
def q36_shade_union_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    rows = part.select(F.col("p_partkey").alias("part"), F.array(F.lit("own")).alias("shadeOptions"))
    known = part.select(F.col("p_partkey").alias("part"), F.when(F.col("p_partkey") % 3 == 0, F.array("p_type", "p_name")).otherwise(F.array("p_type")).alias("shades"))
    return offers.union_options(rows, known, "part", at_least=2).select("part", F.array_join("shadeOptions", ",").alias("shades"))


@query("""
SELECT p_partkey AS part, CASE WHEN p_partkey % 3 = 0 THEN p_type WHEN p_partkey % 3 = 1 THEN string_split(p_name, ' ')[2] || ' ' || p_type ELSE p_brand || ' ' || p_name END AS shade FROM part
""")
def q37_common_prefix_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shades named after their product lose its words, those named after its first word lose that, and those that are only its name keep all."""
    part = table(spark, sf_dir, "part")
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat_ws(" ", brand, name, kind)).when(F.col("p_partkey") % 3 == 1, F.concat_ws(" ", name, kind)).otherwise(F.concat_ws(" ", brand, name))
    product = F.when(F.col("p_partkey") % 3 == 1, F.concat_ws(" ", F.substring_index(name, " ", 1), F.lit("other"))).otherwise(name)
    return part.select(F.col("p_partkey").alias("part"), text.common_prefix_cut(raw, brand, product).alias("shade"))


@query(f"""
WITH n AS (SELECT p_partkey AS part, {sql_pick(("Flormar Ruj 12", "yeni NYX Professional Makeup Pudra", "L’Oréal Paris - Maskara", "Sky High Mascara Siyah", "bilinmeyen krem"), "p_partkey")} AS name FROM part)
SELECT part, list_extract(['Flormar', 'NYX Professional Makeup', 'L''Oréal Paris', '', ''], (part % 5 + 1)::INT) AS brand,
       list_extract(['Ruj 12', 'yeni  Pudra', 'Maskara', 'Sky High Mascara Siyah', 'bilinmeyen krem'], (part % 5 + 1)::INT) AS rest,
       list_extract(['', '', '', 'Maybelline', ''], (part % 5 + 1)::INT) AS line_brand FROM n
""")
def q38_brand_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("Flormar Ruj 12", "yeni NYX Professional Makeup Pudra", "L’Oréal Paris - Maskara", "Sky High Mascara Siyah", "bilinmeyen krem")
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), pick(names, F.col("p_partkey")).alias("name"))
    rows = rows.withColumn("brand", text.brand_in_name(F.col("name")))
    return rows.select("part", "brand", text.name_without(F.col("name"), F.col("brand")).alias("rest"), text.brand_of_line(F.col("name")).alias("line_brand"))


_BRAND_FOUND = q.first_contained("lower(name)", ((b.lower(), b) for b in sorted(d.KNOWN_BRANDS, key=len, reverse=True)), "''")
_QF_OFFERS = _QF.replace("SELECT part, CASE", "SELECT *, CASE", 1).replace("part * 30 > 50000", "reviews > 50000")


_CLEAN = f"""{LINE_OFFERS},
landed AS (
  SELECT {sql_pick(d.SELLERS, "site")} AS site, idx AS line, ((site % {len(d.SELLERS)})::BIGINT << 52) + idx AS idx, {sql_pick(NAMES, "part")} || CASE WHEN part % 3 = 0 THEN ' ' || lpad((part % 40)::VARCHAR, 2, '0') ELSE '' END AS raw,
         {sql_pick(BRANDS, "part")} AS given, {sql_pick(CATEGORIES, "part")} AS landed_category, floor(price) / 4 AS price, idx % 900 AS reviews, CASE WHEN part % 5 = 0 THEN (8680000000000 + part)::VARCHAR ELSE '' END AS barcode
  FROM offers JOIN part ON p_partkey = part),
starred AS (SELECT *, trim(ltrim(raw, '*')) AS name FROM landed),
found AS (SELECT *, CASE WHEN trim(given) = '' THEN {_BRAND_FOUND} ELSE '' END AS hit FROM starred),
cut AS (
  SELECT * REPLACE (CASE WHEN hit = '' THEN name ELSE trim(regexp_replace(trim(name[:strpos(lower(name), lower(hit)) - 1] || name[strpos(lower(name), lower(hit)) + length(hit):]), '^[-–, ]+', '')) END AS name)
  FROM found),
branded AS (SELECT *, CASE WHEN trim(given) <> '' THEN given WHEN hit <> '' THEN hit ELSE {q.first_contained("lower(name)", d.LINE_TO_BRAND.items(), "''")} END AS b FROM cut),
parts AS (
  SELECT site, line, idx, name, price, reviews, barcode, CASE WHEN trim(b) = '' THEN '' ELSE {q.lookup("(" + q.brand_key("b") + ")", d.BRAND_DISPLAY, "b")} END AS brand,
         {q.first_contained("lower(raw)", ((k, c) for c, keys in d.CATEGORY_RULES for k in keys), "landed_category")} AS category
  FROM branded),
judged AS ({_QF_OFFERS}),
keyed AS (
  SELECT *, {q.brand_key("brand")} AS bk, {q.core_name("name", "brand")} AS core, {q.variant_shade("name")} AS shade, array_to_string({q.sizes("name")}, '-') AS size FROM judged WHERE reject_reason IS NULL)"""


_GROUP_PAIRS = _PAIRS.replace("part AS idx, 's' || (part % 5) AS site", "idx, site").replace("FROM parts)", "FROM groups WHERE idx NOT IN (SELECT idx FROM used))")
_IMAGES = ", ".join(f"CASE WHEN b.site = '{s}' THEN b.image END, list_filter(prices, lambda p: p.site = '{s}')[1].image" for s in d.IMAGE_SELLERS)


@query(f"""
WITH RECURSIVE {_CLEAN},
cheapest AS (SELECT site, category, min(idx) AS idx, arg_min({{'name': name, 'brand': brand, 'price': price, 'line': line, 'barcode': barcode}}, (price, idx)) AS r FROM keyed GROUP BY site, bk, category, core, shade, size),
groups AS (SELECT site, category, idx, r.name AS name, r.brand AS brand, r.price AS price, 'http://img/' || r.line AS image, r.barcode AS barcode FROM cheapest),
coded AS (
  SELECT idx, site, price, image, category, barcode, {q.brand_key("brand")} AS bk, array_to_string({q.sizes("name")}, ',') AS sz, {q.word_set("name")} AS ws, {q.shade_codes("name", "brand")} AS sh FROM groups WHERE barcode <> ''),
{_USED}
{_GROUP_PAIRS}{_WALK.rstrip()},
chosen AS (SELECT base_idx, cand_idx FROM walk WHERE cand_idx IS NOT NULL),
bases AS (SELECT x.idx, (SELECT min(y.idx) FROM x y WHERE y.bk = x.bk) AS tier_key FROM x JOIN base ON x.bk = base.bk AND x.site = base.base_site),
entries AS (
  SELECT 0 AS tier, first_value(idx) OVER w AS tier_key, first_value(idx) OVER w AS base_idx, idx, site_idx AS ord FROM used WINDOW w AS (PARTITION BY barcode ORDER BY site_idx)
  UNION ALL SELECT 1, tier_key, idx, idx, -1 FROM bases
  UNION ALL SELECT 1, tier_key, base_idx, cand_idx, cand_idx FROM chosen JOIN bases ON bases.idx = base_idx
  UNION ALL SELECT 2, idx, idx, idx, -1 FROM x WHERE idx NOT IN (SELECT idx FROM bases) AND idx NOT IN (SELECT cand_idx FROM chosen)),
priced AS (SELECT e.*, g.site, g.price, g.image, min(g.price) OVER (PARTITION BY tier, base_idx) AS least FROM entries e JOIN groups g USING (idx)),
matched AS (SELECT tier, tier_key, base_idx AS idx, list({{'site': site, 'price': price, 'image': image}} ORDER BY price, ord) AS prices FROM priced WHERE price <= 3 * least GROUP BY ALL),
variants AS (
  SELECT m.*, g.name, g.brand, g.category, g.site, g.image, {q.brand_key("g.brand")} AS bk, {q.core_name("g.name", "g.brand")} AS core, coalesce(nullif({q.variant_shade("g.name")}, ''), 'Standart') AS shade, array_to_string({q.sizes("g.name")}, '-') AS size
  FROM matched m JOIN groups g USING (idx)),
plain AS (SELECT bk, category, core, arg_min({{'idx': idx, 'prices': prices}}, (tier, tier_key, idx)) AS std FROM variants WHERE shade = 'Standart' AND size = '' GROUP BY bk, category, core),
shared AS (
  SELECT v.*, CASE WHEN std IS NULL OR std.idx = v.idx THEN prices ELSE list_concat(prices, list_filter(std.prices, lambda p: NOT list_contains(list_transform(v.prices, lambda z: z.site), p.site))) END AS all_prices
  FROM variants v LEFT JOIN plain USING (bk, category, core)),
masters AS (
  SELECT category, arg_min({{'tier': tier, 'tier_key': tier_key, 'idx': idx, 'name': name, 'brand': brand, 'site': site, 'image': image}}, (tier, tier_key, idx)) AS b,
         count(*)::INT AS n_variants, arg_min(all_prices, (all_prices[1].price, tier, tier_key, idx)) AS prices
  FROM shared GROUP BY bk, category, core),
shown AS (
  SELECT *, b.brand AS own, trim(b.brand) AS given FROM masters),
products AS (
  SELECT row_number() OVER (ORDER BY b.tier, b.tier_key, b.idx) AS id, CASE WHEN given = '' THEN own ELSE {q.lookup("(" + q.brand_key("own") + ")", d.BRAND_DISPLAY, "own")} END AS brand,
         trim(left(trim(CASE WHEN own = '' THEN {q.erase("b.name", chr(92) + "s+", " ")} ELSE regexp_replace({q.erase("b.name", chr(92) + "s+", " ")}, '(?i)' || regexp_escape(own), '', 'g') END), 80)) AS name,
         category, n_variants, len(prices)::INT AS "priceCount", prices[1].price AS first_price, coalesce({_IMAGES}, b.image) AS "imageUrl"
  FROM shown),
rules(high_brand, high_part, dupe_brand, dupe_part) AS (VALUES {", ".join("(" + ", ".join(map(q.lit, r)) + ")" for r in d.SUBSTITUTES)}),
links AS (
  SELECT h.id, count(DISTINCT l.id)::INT AS n FROM products h JOIN rules ON upper(h.brand) = high_brand AND contains(lower(h.name), high_part)
  JOIN products l ON upper(l.brand) = dupe_brand AND contains(lower(l.name), dupe_part) GROUP BY h.id)
SELECT products.*, coalesce(n, 0) AS n_dupe_for FROM products LEFT JOIN links USING (id)
""")
def q39_integrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the sellers' offers; ratings that are unknown are drawn by a hash, so reruns agree."""
    rules = spark.createDataFrame(d.SUBSTITUTES, "high_brand string, high_part string, dupe_brand string, dupe_part string")
    products = integrate(seller_offers(spark, sf_dir), rules=rules)
    return products.select("id", "brand", "name", "category", F.size("variants").alias("n_variants"), "priceCount", F.col("prices")[0]["price"].alias("first_price"), "imageUrl", F.size("dupeFor").alias("n_dupe_for"))


_KINDS = (*d.SKIN_TYPES, "ruj")


@query(f"""
WITH {NAMED_PARTS},
m AS (
  SELECT part, part % 3 AS tier, name, brand AS own, trim(brand) AS given, {sql_pick(_KINDS, "part")} AS kind, CASE WHEN part % 4 = 0 THEN 0.0 ELSE 3 + (part % 21) / 10.0 + 0.04 END AS rating, CASE WHEN part % 5 = 0 THEN 0 ELSE part % 700 END AS reviews,
         CASE WHEN part % 3 = 0 THEN 0.0 ELSE price * (part % 7) + 0.004 END AS p1 FROM parts)
SELECT row_number() OVER (ORDER BY tier, part) AS id, CASE WHEN given = '' THEN own ELSE {q.lookup("(" + q.brand_key("own") + ")", d.BRAND_DISPLAY, "own")} END AS brand,
       trim(left(trim(CASE WHEN own = '' THEN {q.erase("name", chr(92) + "s+", " ")} ELSE regexp_replace({q.erase("name", chr(92) + "s+", " ")}, '(?i)' || regexp_escape(own), '', 'g') END), 80)) AS name,
       kind AS category, 'L ' || kind AS "categoryLabel", array_to_string(coalesce(MAP {{{", ".join(f"{q.lit(k)}: {sql_list(v)}" for k, v in d.SKIN_TYPES.items())}}}[kind], ['normal']), ',') AS "skinType",
       CASE part % 3 WHEN 0 THEN '' WHEN 1 THEN 's1' ELSE 's1,s2' END AS shades, CASE WHEN part % 3 > 0 THEN floor(p1 * 100 + 0.5) / 100 END AS "firstPrice", (part % 3)::INT AS "priceCount",
       CASE WHEN rating > 0 THEN floor(rating * 10 + 0.5) / 10 END AS rating, CASE WHEN reviews > 0 THEN reviews END AS reviews, TRUE AS drawn, CASE WHEN rating > 0 AND reviews > 0 THEN (rating >= 4.6 AND reviews >= 100) OR (rating >= 4.4 AND reviews >= 500) OR (rating >= 4.8 AND reviews >= 30) END AS trending,
       'http://img/' || part AS "imageUrl", 'http://shop/' || part AS "productUrl", CASE WHEN part % 2 = 0 THEN 'd' || part ELSE '' END AS "desc", part % 2 = 0 AS vegan, coalesce(CASE WHEN part % 6 < 4 THEN part % 6 = 1 END, FALSE) AS "crueltyFree",
       FALSE AS spf, 0 AS "ingredients", 0 AS "ingredientWarnings", CASE WHEN part % 10 = 0 THEN 'unknown' ELSE 'gratis' END AS source, '05.03.26' AS "lastUpdated"
FROM m
""")
def q72_published_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of published products; ratings and reviews that are drawn must lie within their price's band."""
    key, price = F.col("part"), F.when(F.col("part") % 3 == 0, 0.0).otherwise(F.col("price") * (F.col("part") % 7) + 0.004)
    entry = lambda site, p: F.struct(F.lit(site).alias("site"), p.alias("price"), F.lit("u").alias("url"), F.lit(1).alias("variantCount"), F.lit("").alias("imageUrl"))
    entries = F.slice(F.array(entry("x", price), entry("y", price * 2)), F.lit(1), (key % 3).cast("int"))
    variant = lambda shade: F.struct(F.lit(shade).alias("shade"), F.lit("").alias("size"), F.col("name").alias("name"), entries.alias("prices"), F.lit("").alias("imageUrl"))
    made = named_parts(spark, sf_dir).withColumns({
        "tier": key % 3, "tier_key": key, "idx": key, "category": pick(_KINDS, key), "categoryLabel": F.concat(F.lit("L "), pick(_KINDS, key)), "prices": entries, "variants": F.slice(F.array(variant("s1"), variant("s2")), F.lit(1), (key % 3).cast("int")),
        "rating": F.when(key % 4 == 0, 0.0).otherwise(3 + (key % 21) / 10.0 + 0.04), "reviews": F.when(key % 5 == 0, 0).otherwise(key % 700), "imageUrl": F.concat(F.lit("http://img/"), key), "productUrl": F.concat(F.lit("http://shop/"), key),
        "site": F.when(key % 10 > 0, "Gratis"), "desc": F.when(key % 2 == 0, F.concat(F.lit("d"), key)), "vegan": key % 2 == 0, "crueltyFree": F.when(key % 6 < 4, key % 6 == 1),
    })
    shown = masters.final_products(made, F.lit("2026-03-05").cast("date")).withColumn("part", F.regexp_extract("productUrl", "([0-9]+)$", 1).cast("long"))
    p1, known_rating, known_reviews = F.coalesce(F.get("prices", F.lit(0))["price"], F.lit(0.0)), F.col("part") % 4 != 0, (F.col("part") % 5 != 0) & (F.col("part") % 700 > 0)
    band = lambda c, high, mid, low: F.when(p1 > 3000, c.between(*high)).when(p1 > 1500, c.between(*mid)).otherwise(c.between(*low))
    drawn = (known_rating | band(F.col("rating"), (4.5, 4.9), (4.2, 4.7), (3.8, 4.5))) & (known_reviews | band(F.col("reviews"), (50, 550), (100, 1100), (200, 3200)))
    return shown.select(
        "id", "brand", "name", "category", "categoryLabel", F.array_join("skinType", ",").alias("skinType"), F.array_join("variants.shade", ",").alias("shades"), F.get("prices", F.lit(0))["price"].alias("firstPrice"), "priceCount",
        F.when(known_rating, F.col("rating")).alias("rating"), F.when(known_reviews, F.col("reviews")).alias("reviews"), drawn.alias("drawn"), F.when(known_rating & known_reviews, F.col("trending")).alias("trending"),
        "imageUrl", "productUrl", "desc", "vegan", "crueltyFree", "spf", F.size("ingredients").alias("ingredients"), F.size("ingredientWarnings").alias("ingredientWarnings"), "source", "lastUpdated",
    )


@query(f"""
WITH {_CLEAN},
variants AS (SELECT count(*) AS n FROM keyed GROUP BY site, bk, category, core, shade, size)
SELECT count(*) AS total_groups, sum(n)::BIGINT AS total_products, sum(n - 1)::BIGINT AS merged_away FROM variants
""")
def q40_variant_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the sellers' offers in normal form after the quality rules, and the variants that they make."""
    return matching.variant_statistics(variants_of_sellers(clean_offers(seller_offers(spark, sf_dir))))


@query(f"""
SELECT part, coalesce(MAP {{{", ".join(f"{q.lit(k)}: {q.lit(v)}" for k, v in d.CATEGORY_SIGNS.items())}}}[category], {q.lit(d.OTHER_SIGN)}) AS emoji
FROM (SELECT p_partkey AS part, {sql_pick(CATEGORIES, "p_partkey")} AS category FROM part)
""")
def q41_category_sign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offers.with_sign(named_parts(spark, sf_dir)).select("part", "emoji")


#: The sample of url paths.
PATHS = ("/serum/x/p/1", "/makyaj/serum/p/2", "/maske/peeling/p/3", "/diger/p/4", "/cilt-bakimi/a/p/5")


@query(f"""
SELECT part, url, list_extract(['serum', '', 'cilt-maskesi', '', 'nemlendirici'], (part % 5 + 1)::INT) AS category
FROM (SELECT p_partkey AS part, 'http://s' || {sql_pick(PATHS, "p_partkey")} || p_partkey AS url FROM part) WHERE part % 5 NOT IN (1, 3)
""")
def q42_url_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.concat(F.lit("http://s"), pick(PATHS, F.col("p_partkey")), F.col("p_partkey").cast("string")).alias("url"))
    return offers.by_url_category(part, "url").select("part", "url", "category")


@query("SELECT p_partkey AS part FROM part WHERE p_partkey IN (SELECT s_suppkey FROM supplier)")
def q43_code_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.concat(F.lit("http://s/p/"), F.col("p_partkey")).alias("productUrl"))
    codes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("code"))
    return offers.with_code_in(part, codes).select("part")


@query(f"""
WITH {LINE_OFFERS}, r AS (SELECT part, idx, row_number() OVER (PARTITION BY part ORDER BY idx) AS n FROM offers)
SELECT part, idx, row_number() OVER (ORDER BY part, idx) + 4999 AS id FROM r WHERE n <= 3
""")
def q44_top_rows_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three offers of each product, numbered from 5000 on."""
    rows = offers.top_rows(line_offers(spark, sf_dir), ["part"], 3).select("part", "idx")
    return masters.numbered(rows, ["part", "idx"], "id", first=5000)
