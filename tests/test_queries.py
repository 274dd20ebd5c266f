import duckdb
import pytest

from offerloom import queries, sample_queries, seller_queries


@pytest.fixture
def parts(spark, tmp_path):
    rows = [(i, "widget", "Brand#1", "SMALL", 1 + i % 50, 900.0 + i / 10) for i in range(300)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_greedy_assignment_of_all_products(spark, parts):
    """Every product takes part, and the result is the walk over the bases."""
    named = queries._named(spark, parts)
    assert sorted(r.idx for r in named.select("idx").collect()) == list(range(300))
    walk, taken = set(), set()
    by_base: dict[tuple, list] = {}
    for p in queries._fuzzy(named).collect():
        by_base.setdefault((p.base_idx, p.brand_key, p.cand_site), []).append((-p.sim, p.cand_idx))
    for (base, *group), cands in sorted(by_base.items()):
        free = [c for _, c in sorted(cands) if (*group, c) not in taken]
        if free:
            taken.add((*group, free[0]))
            walk.add((base, free[0]))
    got = {(r.base_idx, r.cand_idx) for r in queries.q07_greedy_assignment(spark, parts).collect()}
    assert got == walk and any(c % 10 == 8 or b % 10 == 8 for b, c in got)


def test_tiers_of_all_products(spark, parts):
    """Prices are alike and no seller has a barcode twice, so each product has its price somewhere."""
    found = queries.q08_leftover_union_tiers(spark, parts).collect()
    assert sum(r.n_prices for r in found) == 300
    con = duckdb.connect()
    con.sql(f"CREATE VIEW part AS SELECT * FROM '{parts}/part.parquet/*.parquet'")
    expected = con.sql(queries.ORACLE_SQL["q08_leftover_union_tiers"]).fetchall()
    assert sorted((r.tier, r.match_method, r.n_products, r.n_prices) for r in found) == sorted(expected)
    assert {r.tier for r in found} == {0, 1, 2}


ON_PARTS = sorted(n for n in queries.QUERIES if (getattr(sample_queries, n, None) or getattr(seller_queries, n, None)) and "FROM part" in queries.ORACLE_SQL[n])


@pytest.mark.parametrize("name", ON_PARTS)
def test_cases_written_by_hand(spark, parts, name):
    """All cases occur among 300 parts, and each gives what is written beside it."""
    found = queries.QUERIES[name](spark, parts)
    columns = sorted(found.columns)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW part AS SELECT * FROM '{parts}/part.parquet/*.parquet'")
    expected = con.sql(queries.ORACLE_SQL[name])
    assert sorted(expected.columns) == columns
    rows = lambda found: sorted(found, key=repr)
    assert rows(tuple(r) for r in found.select(columns).collect()) == rows(expected.project(", ".join(f'"{c}"' for c in columns)).fetchall())


@pytest.mark.parametrize("name", ["q12_core_name_tokens", "q14_token_similarity"])
def test_names_are_worked_out_once(spark, parts, name):
    """Rules of names run over distinct names and are written; over the parts only a join is left."""
    found = queries.QUERIES[name](spark, parts)
    assert found.count() == 300
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "regexp_replace" not in plan and "array_intersect" not in plan
