import random

from pyspark.sql import functions as F

from offerloom.operators import masters, matching, robots


def test_links_by_classes(spark):
    """Rules that share products, one that most products fit, a product on both sides, null and empty fields, repeated rules."""
    rng = random.Random(2)
    products = [(i, rng.choice(["A", "b", "Ç", None, ""]), rng.choice(["red ring", "Blue bolt", "red bolt", "", None])) for i in range(120)]
    rules = [("A", "red", "B", "bolt"), ("A", "", "A", ""), ("B", "blue", "A", "red"), ("A", "red", "B", "bolt"), ("none", "x", "A", "red"), ("", "", "B", "ring")]
    fits = lambda p, brand, part: p[1] is not None and p[2] is not None and p[1].upper() == brand and part in p[2].lower()
    expected = {(h[0], d[0]) for hb, hp, db, dp in rules for h in products if fits(h, hb, hp) for d in products if fits(d, db, dp)}
    table = spark.createDataFrame(products, "id long, brand string, name string")
    rule_table = spark.createDataFrame(rules, "high_brand string, high_part string, dupe_brand string, dupe_part string")
    classes = masters.substitute_classes(table, rule_table)
    for parts in (1, 7):
        got = [tuple(r) for r in masters.expanded_links(classes, parts).collect()]
        assert len(got) == len(set(got)) and set(got) == expected
    assert {tuple(r) for r in masters.substitute_links(table, rule_table).collect()} == expected
    counted = masters.substitute_counts(classes).collect()
    assert sorted((r.n_high, r.n_dupe, r.n_links) for r in counted) == sorted(
        (h, d, h * d) for hb, hp, db, dp in dict.fromkeys(rules) for h, d in [(sum(fits(p, hb, hp) for p in products), sum(fits(p, db, dp) for p in products))] if h + d
    )
    assert masters.substitute_links(table.filter("id < 0"), rule_table).count() == 0


def test_members_are_what_is_nested(spark):
    """Null keys, offers without a price, ties; without nesting the groups are the same but for the array."""
    rng = random.Random(7)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([1, 2, None]), f"n{i}", rng.choice([None, 0.0, 5.0, 5.0, 7.5]), f"u{i}") for i in range(150)]
    offers = spark.createDataFrame(rows, "idx long, site string, k int, name string, price double, productUrl string").repartition(3)
    nested = matching.variant_groups(offers, ["site", "k"])
    plain = matching.variant_groups(offers, ["site", "k"], nested=False)
    assert sorted(map(repr, nested.drop("variants").collect())) == sorted(map(repr, plain.collect()))
    members = matching.variant_members(offers, ["site", "k"]).orderBy("group_idx", "order", "idx").collect()
    assert len(members) == len(rows)
    for g in nested.collect():
        assert [(v.name, v.price, v.url) for v in g.variants] == [(m.name, m.price, m.url) for m in members if m.group_idx == g.idx]


def test_groups_without_nesting_sort_cheapest_offers_only(spark, monkeypatch):
    """Offers are read twice and their numbers added up by hash; what is sorted are the few that are the cheapest of their key."""
    seen = []
    write = matching.materialize
    monkeypatch.setattr(matching, "materialize", lambda df, name: (seen.append((name, df._jdf.queryExecution().executedPlan().toString())), write(df, name))[1])
    offers = spark.range(600).selectExpr("id AS idx", "'s' AS site", "cast(id % 4 AS string) AS k", "concat('n', id) AS name", "CAST(1 + id DIV 100 AS double) AS price", "concat('u', id) AS productUrl")
    groups = matching.variant_groups(offers, ["site", "k"], nested=False)
    assert sorted((g.k, g.name, g.idx, g.variant_count, g.min_price, g.max_price) for g in groups.collect()) == [(str(k), f"n{k}", k, 150, 1.0, 6.0) for k in range(4)]
    plans = dict(seen)
    assert set(plans) == {"variant-numbers", "variants"} and "Sort" not in plans["variant-numbers"] and "HashAggregate" in plans["variant-numbers"]
    assert "Range" not in groups._jdf.queryExecution().executedPlan().toString()  # what reads the groups twice doesn't make them twice


def test_many_rules_decide_as_few(spark):
    """Prefixes, wildcards, signs that patterns read as more than text, ties and empty and null paths: a broadcast and a join by heads agree."""
    rng = random.Random(11)
    bits = ["/a", "/b", "b?", "*", "c", "/", "+", "|", "x.", "$", "-"]
    rules = [(rng.choice(["allow", "disallow"]), "/" + "".join(rng.choice(bits) for _ in range(rng.randrange(0, 4)))) for _ in range(80)]
    rules = [r for r in rules if "++" not in r[1] and "?+" not in r[1] and "**" not in r[1]] + [("disallow", "*"), ("allow", "/"), ("disallow", "/a*c")]
    paths = [(i, "/" + "".join(rng.choice(["a", "b", "/a", "c", "/", "b?", "x1", "-"]) for _ in range(rng.randrange(0, 6)))) for i in range(200)] + [(900, ""), (901, None)]
    table, asked = spark.createDataFrame(rules, "kind string, pattern string"), spark.createDataFrame(paths, "i int, path string")
    few, many = ({r.i: r.allowed for r in robots.decisions(asked, table, "i", max_rules=n).collect()} for n in (1000, 3))
    assert few == many and set(few.values()) == {True, False} and len(few) == len(paths)
    narrow = table.filter(F.length("pattern") > 2)
    assert {r.i: r.allowed for r in robots.decisions(asked, narrow, "i", max_rules=3).collect()} == {r.i: r.allowed for r in robots.decisions(asked, narrow, "i").collect()}


def test_links_do_not_meet(spark):
    """Two rules that make the same links: each link once, without an aggregate over links, whose number is quadratic."""
    table = spark.createDataFrame([(i, "AB"[i % 2], "red bolt") for i in range(60)], "id long, brand string, name string")
    rules = spark.createDataFrame([("A", "red", "B", "bolt"), ("A", "bolt", "B", "red"), ("A", "", "A", "red")], "high_brand string, high_part string, dupe_brand string, dupe_part string")
    links = masters.substitute_links(table, rules)
    got = [tuple(r) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in range(0, 60, 2) for b in range(60)}
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert not any(step in plan[: plan.rindex("Generate")] for step in ("Aggregate", "Distinct", "Join"))
