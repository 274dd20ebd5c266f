"""The whole integration of landed offers, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.operators import masters, matching, offers
from offerloom.operators.distinct import of_distinct
from offerloom.functions import text
from offerloom.worktables import materialize


def variants_of_sellers(clean: DataFrame) -> DataFrame:
    """One row a seller's variant: same brand key, category, core, shade and size."""
    name, brand = F.col("name"), F.col("brand")
    keys = {"_brand": text.brand_key(brand), "_core": text.core_name(name, brand), "_shade": text.variant_shade(name), "_size": text.variant_size(name)}
    keyed = of_distinct(clean, ["name", "brand"], lambda names: names.withColumns(keys))
    return matching.variant_groups(keyed, ["site", "_brand", "category", "_core", "_shade", "_size"], nested=False).drop("_brand", "_core", "_shade", "_size")


def clean_offers(sellers: dict[str, DataFrame] | DataFrame, barcodes: DataFrame | None = None) -> DataFrame:
    """Offers of all sellers in normal form that no quality rule rejects.

    The normal form is written first: the filter would be pushed below it and
    make names and brands anew for each of its rules.
    """
    return offers.quality_filter(materialize(offers.normalised(offers.union_sources(sellers), barcodes), "offers"))


def integrate(sellers: dict[str, DataFrame] | DataFrame, barcodes: DataFrame | None = None, rules: DataFrame | None = None) -> DataFrame:
    """Final products from each seller's offers (with ``pos``).

    Union, normal form, quality filter, variants, matching over sellers, masters,
    presentation and substitutes. Features are computed once and written, as
    three tiers read them.
    """
    featured = materialize(matching.with_features(variants_of_sellers(clean_offers(sellers, barcodes))), "features")
    matches = materialize(matching.matched(featured), "matches")
    products = masters.final_products(masters.master_groups(matches))
    if rules is None:
        return products
    products = materialize(products, "products")
    return masters.with_substitutes(products, masters.substitute_links(products, rules))
