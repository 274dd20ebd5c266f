"""Offers, pages and texts made from the driver's tables and from literals, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.functions import dictionaries as d

NAMES = (
    "Fit Me Fondöten 120 Classic Ivory 30 ml", "fit me foundation 30ml 120", "Super Stay Matte Ink Likit Mat Ruj 15", "Lash Sensational Sky High Maskara",
    "Göz Kalemi No: 25 Siyah", "Kaş Farı 02", "Mini Allık - 130 Light Beige", "Waterproof Eyeliner 1,5 ml", "2'li Maskara Seti", "Oto Far Ampul", "Kampanya Ruj",
    "Pudra 01 n10 15ml SPF30", "BB Krem", "Keşfet Ruj Fırsatı", "Teint Idole Ultra Wear 30 ml", "Teint Idole Ultra Wear Care & Glow 30 ml", "Ruj", "Hediye Seti Parfüm 50 ml",
    "Double Wear Kapatıcı 1N1", "*Radiant Creamy Concealer 6 ml Vanilla", "Lip Glow Oil 001 Pink", "Fat Oil Lip Drip Brown", "Velvet Matte Lipstick 12", "velvet matte lip stick no 12",
)
BRANDS = ("Maybelline New York", "MAYBELLINE", "L’Oréal Paris", "M·A·C", "NYX Professional Makeup", "Golden Rose", "", "Lancôme", "Estée Lauder", "Dior", "rom&nd")
CATEGORIES = ("fondoten", "ruj", "far", "eyeliner", "goz-kalemi", "cilt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def sql_list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_pick(values: tuple[str, ...], index: str) -> str:
    return f"list_extract({sql_list(values)}, ({index} % {len(values)} + 1)::INT)"


def named_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part, name, brand, category, price) of parts under names of the trade."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("part"), pick(NAMES, F.col("p_partkey")).alias("name"), pick(BRANDS, F.col("p_partkey")).alias("brand"), pick(CATEGORIES, F.col("p_partkey")).alias("category"), F.col("p_retailprice").alias("price"))


NAMED_PARTS = f"""parts AS (
  SELECT p_partkey AS part, {sql_pick(NAMES, "p_partkey")} AS name, {sql_pick(BRANDS, "p_partkey")} AS brand, {sql_pick(CATEGORIES, "p_partkey")} AS category, p_retailprice AS price
  FROM part)"""


def line_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, site, part, price): an offer a line, by its supplier."""
    line = table(spark, sf_dir, "lineitem")
    return line.select((((F.col("l_orderkey") * 16 + F.col("l_linenumber")) * 20000 + F.col("l_partkey")) * 1000 + F.col("l_suppkey")).alias("idx"), F.col("l_suppkey").alias("site"), F.col("l_partkey").alias("part"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))


LINE_OFFERS = "offers AS (SELECT ((l_orderkey * 16 + l_linenumber) * 20000 + l_partkey) * 1000 + l_suppkey AS idx, l_suppkey AS site, l_partkey AS part, l_extendedprice / l_quantity AS price FROM lineitem)"


def seller_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed offers of all sellers: every line as an offer of the seller (``site``) that its supplier stands for."""
    lines = line_offers(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part")), "part")
    return lines.select(
        pick(d.SELLERS, F.col("site")).alias("site"),
        F.col("idx").alias("pos"),
        F.col("idx").cast("string").alias("id"),
        F.concat(pick(NAMES, F.col("part")), F.when(F.col("part") % 3 == 0, F.concat(F.lit(" "), F.lpad((F.col("part") % 40).cast("string"), 2, "0"))).otherwise("")).alias("name"),
        pick(BRANDS, F.col("part")).alias("brand"),
        pick(CATEGORIES, F.col("part")).alias("category"),
        F.lit("Ruj").alias("categoryLabel"),
        (F.floor(F.col("price")) / 4).alias("price"),
        F.concat(F.lit("http://img/"), F.col("idx")).alias("imageUrl"),
        F.concat(F.lit("http://shop/p-"), F.col("idx")).alias("productUrl"),
        (F.col("idx") % 50 / 10.0).alias("rating"),
        (F.col("idx") % 900).alias("reviews"),
        F.when(F.col("part") % 5 == 0, F.lpad((F.col("part") + 8680000000000).cast("string"), 13, "8")).otherwise("").alias("barcode"),
    )
