import json
import random

from pyspark.sql import functions as F

from offerloom.sources import landed, paging

SCHEMA = "k string, at long, held long, total long, body string"


def _walk(pages, step, first):
    """The loop over one key's pages as a crawler runs it."""
    best = {}
    for at, held, total in pages:
        if at is not None:
            best[at] = max(best.get(at, (-1, -1)), (held or 0, -1 if total is None else total))
    at, out = first, []
    total = float("inf")
    while at - first < total and at in best and best[at][0] > 0 and best[at][1] >= 0:
        out.append(at)
        total = best[at][1]
        at += step
    return out


def _gaps(pages):
    covered, total = set(), None
    stated = [(at, total) for at, held, total in pages if at is not None and total is not None]
    for at, held, _ in pages:
        covered |= set(range(at, at + (held or 0))) if at is not None else set()
    last = max(stated)[1] if stated else None
    upto = max([*covered, -1]) + 1 if last is None else last
    return [x for x in range(upto) if x not in covered]


def test_walks_and_gaps_by_brute_force(spark):
    """Missing, empty and repeated pages, totals that change or lack, offsets off the steps, null keys; any span."""
    rng = random.Random(3)
    rows = []
    for k in [f"k{i}" for i in range(25)] + [None]:
        n = rng.randrange(0, 60)
        for at in range(0, max(n, 1), 5):
            if rng.random() < 0.9:
                rows.append((k, at, min(5, n - at) if rng.random() < 0.93 else rng.choice([0, None, 2, 9]), n if rng.random() < 0.93 else rng.choice([0, None, n + 3, 10]), f"{k}{at}"))
            if rng.random() < 0.08:
                rows.append((k, rng.choice([at, at + 2, None]), rng.choice([1, 5]), rng.choice([n, None]), "again"))
    pages = spark.createDataFrame(rows, SCHEMA)
    of = {k: [(r[1], r[2], r[3]) for r in rows if r[0] == k] for k in {r[0] for r in rows} if k}
    for step, first in ((5, 0), (10, 5)):
        got = sorted((r.k, r.at) for r in paging.walked(pages, "k", "at", "held", "total", step, first).collect())
        assert got == sorted((k, at) for k, v in of.items() for at in _walk(v, step, first))
    for span in (4, 1 << 16):
        found = paging.gaps(pages, "k", "at", "held", "total", span).collect()
        assert sorted((r.k, x) for r in found for x in range(r["from"], r["to"])) == sorted((k, x) for k, v in of.items() for x in _gaps(v))
        touching = {(r.k, r["from"]) for r in found} & {(r.k, r["to"]) for r in found}
        assert not touching, "one gap, one range"
    status = {r.k: r for r in paging.complete(pages, "k", "at", "held", "total").collect()}
    assert set(status) == set(of)
    assert all(status[k].n_missing == len(_gaps(v)) and status[k].n_pages == len(v) for k, v in of.items())
    none = pages.filter("false")
    assert paging.walked(none, "k", "at", "held", "total", 5).count() == paging.gaps(none, "k", "at", "held", "total").count() == paging.complete(none, "k", "at", "held", "total").count() == 0


def test_page_states(spark):
    """Ends of scripts and braces within strings, other objects behind, objects cut off, pages without a list, products that can't be sold."""
    product = {"code": "c", "name": " Krem };</script> {\" ", "url": "/p", "price": {"value": 2.5}, "picture": {"url": "/i.jpg?w=1"}, "averageRating": 4.5, "numberOfReviews": 3}
    listed = {"components": {"x": {}, "product-list": {"pagination": {"totalPages": 4}, "products": [product, {**product, "purchasable": False}, {**product, "price": None}, {**product, "name": None}, {**product, "url": "http://other/p", "picture": None}]}}}
    script = lambda o: f"<script>var a={{}};window.data = {json.dumps(o)}; var b = {{\"components\": 1}};</script><p>}}</p>"
    htmls = [script(listed), script({"components": {"product-list": {}}}), script({"components": {}}), script(listed)[:90], "<p>none</p>", "", None]
    pages = landed.state_pages(spark.createDataFrame(list(enumerate(htmls)), "page int, html string"), "window[.]data")
    assert {r.page: (r.n_pages, None if r.products is None else len(r.products)) for r in pages.collect()} == {0: (4, 5), 1: (1, 0), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None), 6: (None, None)}
    got = landed.state_products(pages.drop("html"), "https://i", "https://s").orderBy("place").collect()
    assert [(r.page, r.place, r.name, r.price, r.imageUrl, r.productUrl, r.rating, r.reviews) for r in got] == [
        (0, 0, 'Krem };</script> {"', 2.5, "https://i/i.jpg", "https://s/p", 4.5, 3),
        (0, 4, 'Krem };</script> {"', 2.5, "", "http://other/p", 4.5, 3),
    ]
    walked = paging.walked(pages.withColumns({"k": F.lit("a"), "held": F.when(F.col("products").isNotNull(), 1)}), "k", "page", "held", "n_pages", 1)
    assert [r.page for r in walked.orderBy("page").collect()] == [0, 1]
