"""Master products with nested variants, and their presentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.functions import dictionaries as d
from offerloom.functions import prices, text
from offerloom.operators import crossing
from offerloom.operators.distinct import of_distinct
from offerloom.operators.matching import first_image
from offerloom.worktables import materialize

ORDER = ("tier", "tier_key", "idx")


def master_groups(matches: DataFrame) -> DataFrame:
    """One row a (brand key, category, core), the first match's, with all its variants nested.

    Sellers of the variant without shade and size are added to the variants that
    lack them. Variants come in order of their first price, those without one
    last; the first one's prices become the master's. A master has as many
    variants as its shades, so what a key gathers is bounded by a product line.
    """
    name, brand = F.col("name"), F.col("brand")
    keys = {"brand_key": text.brand_key(brand), "core": text.core_name(name, brand), "_shade": text.variant_shade(name), "_size": text.variant_size(name), "_shown": text.shown_name(name, brand)}
    rows = of_distinct(matches, ["name", "brand"], lambda names: names.withColumns(keys))
    variant = F.struct(
        *ORDER,
        F.when(F.col("_shade") == "", "Standart").otherwise(F.col("_shade")).alias("shade"),
        F.col("_size").alias("size"),
        F.col("_shown").alias("name"),
        F.col("prices"),
        first_image(F.col("imageUrl")).alias("imageUrl"),
    )
    rest = [c for c in matches.columns if c not in ("brand_key", "core", "category", "variants", "prices")]
    grouped = rows.groupBy("brand_key", "category", "core").agg(
        F.min_by(F.struct(*rest), F.struct(*ORDER)).alias("_base"), F.array_sort(F.collect_list(variant)).alias("_v")
    )
    grouped = grouped.withColumn("_std", F.get(F.filter("_v", lambda v: (v["shade"] == "Standart") & (v["size"] == "")), F.lit(0)))

    def shared(v: Column) -> Column:
        is_std = F.struct(*(v[c] for c in ORDER)) == F.struct(*(F.col("_std")[c] for c in ORDER))
        lacking = F.filter(F.col("_std")["prices"], lambda p: ~F.exists(v["prices"], lambda q: q["site"] == p["site"]))
        return F.when(F.col("_std").isNull() | is_std, v["prices"]).otherwise(F.concat(v["prices"], lacking))

    filled = F.transform("_v", lambda v, i: F.struct(F.coalesce(F.get(v["prices"], F.lit(0))["price"], F.lit(float("inf"))).alias("p0"), i.alias("i"), v["shade"].alias("shade"), v["size"].alias("size"), v["name"].alias("name"), shared(v).alias("prices"), v["imageUrl"].alias("imageUrl")))
    again = F.array_sort(F.transform(filled, lambda v: F.struct(F.coalesce(F.get(v["prices"], F.lit(0))["price"], F.lit(float("inf"))).alias("p0"), v["i"].alias("i"), v["shade"].alias("shade"), v["size"].alias("size"), v["name"].alias("name"), v["prices"].alias("prices"), v["imageUrl"].alias("imageUrl"))))
    made = grouped.withColumn("variants", again)
    cheapest = F.get("variants", F.lit(0))["prices"]
    return made.select("brand_key", "category", "core", *(F.col("_base")[c].alias(c) for c in rest), F.transform("variants", lambda v: v.dropFields("p0", "i")).alias("variants"), F.coalesce(cheapest, F.array().cast(dict(matches.dtypes)["prices"])).alias("prices"))


def usable_image(c: Column) -> Column:
    return F.when((F.length(c) > 0) & ~c.contains("data:image") & ~c.contains("placeholder"), c)


def _first_of(entries: Column, seller: str) -> Column:
    return F.get(F.filter(entries, lambda p: (p["site"] == seller) & (F.length(p["imageUrl"]) > 0)), F.lit(0))


def best_image(site: Column, image: Column, prices_col: Column, sellers: tuple[str, ...] = d.IMAGE_SELLERS) -> Column:
    """For each seller by priority: the row's own image, then the seller's first one among the prices; else the own one."""
    own = first_image(image)
    choices: list[Column] = []
    for s in sellers:
        entry = _first_of(prices_col, s)
        choices += [F.when(site == s, usable_image(own)), usable_image(entry["imageUrl"])]
    return F.coalesce(*choices, own)


def trending(rating: Column, reviews: Column) -> Column:
    return (rating >= 4.6) & (reviews >= 100) | (rating >= 4.4) & (reviews >= 500) | (rating >= 4.8) & (reviews >= 30)


def imputed(rating: Column, reviews: Column, price: Column, key: Column, seed: int = 1) -> tuple[Column, Column]:
    """Rating and reviews, where unknown drawn from the price's band by a hash of ``key``: reruns agree."""
    u = lambda n: F.pmod(F.xxhash64(F.lit(seed + n), key), F.lit(1 << 20)) / float(1 << 20)
    band = lambda high, mid, low: F.when(price > 3000, high).when(price > 1500, mid).otherwise(low)
    drawn = prices.one_decimal(band(4.5 + u(0) * 0.4, 4.2 + u(0) * 0.5, 3.8 + u(0) * 0.7))
    counted = F.floor(band(50 + u(1) * 500, 100 + u(1) * 1000, 200 + u(1) * 3000))
    return F.when(rating > 0, rating).otherwise(drawn), F.when(reviews > 0, reviews).otherwise(counted)


def final_products(masters: DataFrame, run_time: Column | None = None) -> DataFrame:
    """The published columns, numbered in order of the tiers.

    The number counts the products before a row: those of earlier ranges of the
    order from counts by range, and a rank within the range. No task ranks all.
    """
    first = F.coalesce(F.get("prices", F.lit(0))["price"], F.lit(0.0))
    rating, reviews = imputed(F.col("rating"), F.col("reviews"), first, F.col("productUrl"))
    shown = F.transform("prices", lambda p: F.struct(p["site"].alias("site"), prices.two_decimals(F.coalesce(p["price"], F.lit(0.0))).alias("price"), p["url"].alias("url"), p["variantCount"].alias("variantCount")))
    variants = F.transform("variants", lambda v: F.struct(v["shade"].alias("shade"), v["size"].alias("size"), v["name"].alias("name"), v["imageUrl"].alias("imageUrl"), F.transform(v["prices"], lambda p: p.dropFields("imageUrl")).alias("prices")))
    shown_brand = text.brand_shown(F.col("brand"))
    text_of = lambda c: F.coalesce(F.col(c), F.lit("")) if c in masters.columns else F.lit("")
    flag_of = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in masters.columns else F.lit(False)
    rows = masters.select(
        *ORDER,
        F.when(shown_brand == "", F.col("brand")).otherwise(shown_brand).alias("brand"),
        text.shown_name(F.col("name"), F.col("brand")).alias("name"),
        "category",
        "categoryLabel",
        text.skin_types(F.col("category")).alias("skinType"),
        variants.alias("variants"),
        shown.alias("prices"),
        prices.one_decimal(rating).alias("rating"),
        F.floor(reviews + 0.5).alias("reviews"),
        best_image(F.col("site"), F.col("imageUrl"), F.col("prices")).alias("imageUrl"),
        "productUrl",
        text_of("desc").alias("desc"),
        trending(rating, reviews).alias("trending"),
        flag_of("vegan").alias("vegan"),
        flag_of("crueltyFree").alias("crueltyFree"),
        F.lit(False).alias("spf"),
        F.array().cast("array<string>").alias("ingredients"),
        F.array().cast("array<string>").alias("ingredientWarnings"),
        F.lower(F.coalesce("site", F.lit("unknown"))).alias("source"),
        F.size("prices").alias("priceCount"),
        F.date_format(F.current_timestamp() if run_time is None else run_time, "dd.MM.yy").alias("lastUpdated"),
    )
    return numbered(rows, list(ORDER), "id").drop(*ORDER)


def numbered(rows: DataFrame, order: list[str], out: str, first: int = 1) -> DataFrame:
    """Adds a gapless number in the given order, from a sort by ranges and one count for each of them."""
    ranged = materialize(rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "numbered")
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return ranged.withColumn("_k", within).join(F.broadcast(starts.drop("_n")), "_p").withColumn(out, F.col("_start") + F.col("_k") + (first - 1)).drop("_p", "_k", "_start")


def substitute_links(products: DataFrame, rules: DataFrame, strict: bool = True) -> DataFrame:
    """(high_id, dupe_id): products that a rule links; ``rules`` (high_brand, high_part, dupe_brand, dupe_part) is a few rows.

    Brands are compared as shown, in upper case, so accented ones never match;
    with ``strict=False`` they are compared by their keys.
    """
    classes = materialize(substitute_classes(products, rules, strict), "substitutes")
    return expanded_links(classes)


def substitute_classes(products: DataFrame, rules: DataFrame, strict: bool = True) -> DataFrame:
    """(rule, side, id): the products that a rule finds for either side, ``high`` and ``dupe``, once each.

    What all links amount to in linear size: every high of a rule is linked with every
    dupe of it. Rules are numbered by their content; null brands and names fit none. How rules meet products is
    Spark's choice, by the size of their table.
    """
    brand = F.upper("brand") if strict else text.brand_key(F.col("brand"))
    sides = ("high", "dupe")
    keyed = rules.distinct().select(F.xxhash64(*rules.columns).alias("rule"), F.posexplode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"{s}_brand").alias("b"), F.col(f"{s}_part").alias("part")) for s in sides))).alias("_i", "_s"))
    keyed = keyed.select("rule", "_s.side", F.col("_s.b").alias("_rb"), F.col("_s.part").alias("_part"))
    rows = products.select("id", brand.alias("_b"), F.lower("name").alias("_n"))
    return rows.join(keyed, (F.col("_b") == F.col("_rb")) & F.col("_n").contains(F.col("_part"))).select("rule", "side", "id").distinct()


def substitute_counts(classes: DataFrame) -> DataFrame:
    """(rule, n_high, n_dupe, n_links) of ``substitute_classes``: how many links a rule stands for, before any is made."""
    n = lambda s: F.count_if(F.col("side") == s)
    return classes.groupBy("rule").agg(n("high").alias("n_high"), n("dupe").alias("n_dupe"), (n("high") * n("dupe")).alias("n_links"))


def expanded_links(classes: DataFrame, parts: int | None = None) -> DataFrame:
    """(high_id, dupe_id) of ``substitute_classes``, each link once.

    Products that the same rules find for a side are one class, so a link that several
    rules make lies in one pair of classes and no links meet. Pairs of classes are made by
    blocks (see ``crossing``) in ``parts`` tasks (the session's shuffle partitions): neither a rule with most products
    nor the number of links, which is quadratic, weighs on one task.
    """
    of = materialize(classes.groupBy("side", "id").agg(F.array_sort(F.collect_set("rule")).alias("rules")).withColumn("cls", F.array_join("rules", ",")), "substitute-sides")
    side = lambda s: of.filter(F.col("side") == s)
    ruled = lambda s, name: side(s).select(F.col("cls").alias(name), "rules").distinct().select(name, F.explode("rules").alias("rule"))
    edges = materialize(ruled("high", "a").join(ruled("dupe", "b"), "rule").select("a", "b").distinct(), "substitute-pairs")
    pairs = crossing.crossed(side("high").select("cls", "id"), side("dupe").select("cls", "id"), edges, parts)
    return pairs.select(F.col("l.id").alias("high_id"), F.col("r.id").alias("dupe_id"))


def with_substitutes(products: DataFrame, links: DataFrame) -> DataFrame:
    """Adds dupeFor and dupeOf, sorted ids from both sides of ``links``."""
    of = links.groupBy(F.col("high_id").alias("id")).agg(F.array_sort(F.collect_set("dupe_id")).alias("dupeFor"))
    by = links.groupBy(F.col("dupe_id").alias("id")).agg(F.array_sort(F.collect_set("high_id")).alias("dupeOf"))
    none = F.array().cast("array<bigint>")
    return products.join(of, "id", "left").join(by, "id", "left").withColumns({"dupeFor": F.coalesce("dupeFor", none), "dupeOf": F.coalesce("dupeOf", none)})
