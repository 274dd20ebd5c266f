import pytest
from pyspark.sql import functions as F

from offerloom.functions import links, prices, text
from offerloom.operators import masters, matching, offers


def values(spark, column, rows, *names):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} string" for n in names))
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


PRICES = {
    "comma_strip": [("1.234,50 TL", 1234.5), ("", 0.0), ("abc", 0.0)],
    "lira_anchored": [("474,99 TL", 474.99), ("833 TL", 833.0), ("2.856 TL", 2856.0), ("474,99", 0.0), ("-17%662,50 TL", 662.5)],
    "strict": [("129,00", 129.0), ("4.5", 0.0)],
    "least_of_all": [("799,90 TL 399,00 TL", 399.0)],
    "first_pair": [("1.234,50 TL", 1234.0), ("662.5", 6625.0)],
}


@pytest.mark.parametrize("profile", list(PRICES))
def test_price_texts(spark, profile):
    cases = PRICES[profile]
    assert values(spark, prices.PROFILES[profile](F.col("s")), [c[0] for c in cases], "s") == [c[1] for c in cases]


def test_candidate_prices(spark):
    assert spark.range(1).select(prices.least_positive(F.lit(0), F.lit(80), F.lit(75), F.lit(100))).first()[0] == 75
    assert spark.range(1).select(prices.minor_units(F.lit(12990.0), F.lit(0.0))).first()[0] == 129.9
    assert [r[0] for r in spark.createDataFrame([(1.005,), (2.675,)], "x double").select(prices.two_decimals(F.col("x"))).collect()] == [1.0, 2.68]


def test_barcodes(spark):
    cases = {"8682118108773": True, "30123456": False, "2051234567890": False, "12345678901": False, "12345678901234": False, "012345678905": True, "86A2118108773": False, "": False, None: False}
    assert values(spark, text.reliable_barcode(F.col("s")), list(cases), "s") == list(cases.values())


def test_brands(spark):
    cases = {"L’Oréal Paris": "LOREAL PARIS", "M·A·C": "MAC", "Lancôme": "LANCOME", "Şölen": "OLEN", "Kaş & Göz": "KA & GOZ", "rom&nd": "ROM&ND", "NYX PROFESSIONAL MAKEUP": "NYX", "": "", None: ""}
    assert values(spark, text.brand_key(F.col("s")), list(cases), "s") == list(cases.values())
    assert values(spark, text.brand_shown(F.col("s")), ["MAC", " ", "x"], "s") == ["M·A·C", "", "x"]


def test_first_rule_categories(spark):
    cases = {"kaş farı": "far", "brow powder": "pudra", "kaş sabitleyici": "primer", "brow gel": "kas-sabitleyici", "body glow": "aydinlatici", "setting spray": "makyaj-sabitleyici", "xyz": "c"}
    assert values(spark, text.category_by_name(F.col("s"), F.lit("c")), list(cases), "s") == list(cases.values())


def test_boundaries_and_case(spark):
    assert values(spark, F.regexp_count("s", F.lit(text.pattern(r"\bmor\b"))), ["mor çizgi morç"], "s") == [2]
    assert values(spark, text.matches(F.col("s"), r"kaş\b"), ["ruj kaş"], "s") == [False]
    assert values(spark, text.matches(F.col("s"), "fırsat"), ["FIRSAT", "fırsat"], "s") == [False, True]
    assert values(spark, text.matches(F.col("s"), "keşfet"), ["KEŞFET"], "s") == [True]
    assert values(spark, text.squeezed(F.col("s")), [" a   b﻿"], "s") == ["a b"]


def test_codes_and_sizes(spark):
    assert values(spark, text.variant_size(F.col("s")), ["30 ml 01 n10 15ml spf30"], "s") == ["15ML-30ML"]
    assert values(spark, text.variant_shade(F.col("s")), ["30 ml 01 n10 15ml spf30"], "s") == ["01-15ML-30-N10"]


def test_similarity(spark):
    got = values(spark, text.similarity(F.col("a"), F.col("b")), [("teint idole ultra wear", "teint idole ultra wear care glow"), ("a", "teint"), ("lip eye", "lip eye")], "a", "b")
    assert got == [pytest.approx(0.8), 0.0, 1.0]


def test_shade_names(spark):
    cut = text.common_prefix_cut(F.col("r"), F.lit("Flormar"), F.col("p"))
    assert values(spark, cut, [("Flormar Ruj 12", "Ruj Mat"), ("Ruj Mat", "Ruj Mat"), ("05 Rose", "Ruj")], "r", "p") == ["12", "Ruj Mat", "05 Rose"]


def test_links(spark):
    assert values(spark, links.clean(F.col("u")), ["http://a/b?x=1#y", "http://a/b/ref=zz", None], "u") == ["http://a/b", "http://a/b", ""]
    assert values(spark, links.product_barcode(F.col("u")), ["http://a/x-p-8682118108773?z=1"], "u") == ["8682118108773"]
    assert values(spark, links.unwrapped(F.col("u")), ["http://r?url=http%3A%2F%2Fa%2Fb"], "u") == ["http://a/b"]


def test_outliers(spark):
    def kept(*amounts):
        rows = spark.createDataFrame([([{"price": float(a)} for a in amounts],)], "p array<struct<price:double>>")
        return [x.price for x in rows.select(matching.without_outliers(F.col("p")).alias("p")).first().p]

    assert kept(400, 90, 120) == [90, 120]
    assert kept(300, 100) == [100, 300]
    assert kept(700) == [700]


def test_greedy_assignment(spark):
    rows = [(0, 10, 0.9), (0, 11, 0.95), (1, 11, 0.99), (1, 10, 0.8), (2, 11, 0.9), (2, 12, 0.85), (3, 10, 0.9)]
    pairs = spark.createDataFrame([("g", *r) for r in rows], "g string, b long, c long, s double")
    assert sorted((r.b, r.c) for r in matching.assigned(pairs, ["g"], "b", "c", "s").collect()) == [(0, 11), (1, 10), (2, 12)]


def test_assignment_equals_the_walk(spark):
    import random

    rng = random.Random(7)
    rows = {(g, b, c): rng.choice([0.8, 0.85, 0.9, 0.95]) for g in "xyz" for b in range(12) for c in range(100, 110) if rng.random() < 0.5}
    expected = set()
    for g in "xyz":
        used = set()
        for b in range(12):
            free = [(-s, c) for (h, a, c), s in rows.items() if h == g and a == b and c not in used]
            if free:
                used.add(min(free)[1])
                expected.add((g, b, min(free)[1]))
    pairs = spark.createDataFrame([(*k, s) for k, s in rows.items()], "g string, b long, c long, s double")
    assert {(r.g, r.b, r.c) for r in matching.assigned(pairs, ["g"], "b", "c", "s").collect()} == expected


def feature_rows(spark, rows):
    df = spark.createDataFrame(rows, "idx long, site string, price double, name string, brand string")
    return matching.with_features(df.selectExpr("*", "'ruj' AS category", "price AS min_price", "1 AS variant_count", "'' AS productUrl", "'' AS imageUrl", "'8682118108773' AS barcode"))


def test_key_tier(spark):
    rows = [(0, "A", 100.0, "red velvet lip", "X"), (1, "A", 90.0, "red velvet balm", "X"), (2, "B", 120.0, "red velvet lip", "X"), (3, "C", 400.0, "red velvet lip", "X")]
    matched, used = matching.barcode_matches(feature_rows(spark, rows))
    got = matched.collect()
    assert [(r.idx, [(p.site, p.price) for p in r.prices]) for r in got] == [(1, [("A", 90.0), ("B", 120.0)])]
    assert sorted(r.idx for r in used.collect()) == [1, 2, 3]
    for changed in ([*rows[:2], (2, "B", 120.0, "red velvet lip", "Y"), rows[3]], [*rows[:2], (2, "B", 120.0, "aaa bbb ccc", "X"), rows[3]], rows[:2]):
        assert matching.barcode_matches(feature_rows(spark, changed))[0].count() == 0


def test_quality_reasons(spark):
    rows = [("Ruj Mat 12", "X", 4.0, 0), ("abc", "X", 50.0, 0), ("Gratis Kart ile 5", "X", 50.0, 0), ("12 renk", "X", 50.0, 0), ("Ruj Mat", "", 50.0, 0), ("Ruj Mat Uzun", "Ucuz Mağaza", 50.0, 0), ("Ruj & Hediye", "X", 50.0, 0), ("Ford Far", "X", 50.0, 0), ("Ruj Mat Uzun", "X", None, None)]
    got = offers.with_reject_reason(spark.createDataFrame(rows, "name string, brand string, price double, reviews long")).collect()
    assert [r.reject_reason for r in got] == ["price_low", "name_short", "card_price", "count_only", "no_brand_short", "store_brand", "with_gift", "car", None]


def test_dedup_of_blank_keys(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "a"), (2, ""), (3, None), (4, "b")], "idx long, url string")
    assert sorted(r.idx for r in offers.keep_first(rows, ["url"], blank="drop").collect()) == [0, 4]
    assert sorted(r.idx for r in offers.keep_first(rows, ["url"], blank="keep").collect()) == [0, 2, 3, 4]


def test_adaptive_stop(spark):
    def pages(second_new):
        first = [("c", 1, f"k{i}") for i in range(10)]
        second = [("c", 2, f"n{i}" if i < second_new else f"k{i}") for i in range(10)]
        df = spark.createDataFrame(first + second + [("c", 3, f"z{i}") for i in range(10)], "c string, page int, k string")
        return sorted({r.page for r in offers.kept_pages(df, ["c"], "page", "k").collect()})

    assert pages(1) == [1, 2]
    assert pages(2) == [1, 2, 3]


def test_standard_variant_gives_its_sellers(spark):
    rows = [(0, "Ruj 01", [("B", 50.0)]), (1, "Ruj", [("A", 40.0)])]
    df = spark.createDataFrame([(0, i, i, n, "X", "ruj", "", [(s, p, "", 1, "") for s, p in e]) for i, n, e in rows], "tier int, tier_key long, idx long, name string, brand string, category string, imageUrl string, prices array<struct<site:string,price:double,url:string,variantCount:int,imageUrl:string>>")
    made = masters.master_groups(df).collect()
    assert [(v.shade, [p.site for p in v.prices]) for v in made[0].variants] == [("Standart", ["A"]), ("01", ["B", "A"])]
    assert [p.site for p in made[0].prices] == ["A"]
