import random

import pytest

from offerloom import seller_queries
from offerloom.operators import offers
from offerloom.sources import layouts
from offerloom.sources.selectors import ENDED_BY, VOID, Selectors, parsed

TAGS = ["div", "p", "ul", "li", "span", "a", "b", "img"]
SELECTORS = ["div", ".x", "div.x.y", "ul > li", "div p", "div > .x b", '[title]', 'a[href*="/p/"]', 'a[href^="/p"], img', '[class~="y"]', "#k", "ul li > a, .z", "*", "div ul div b"]


def page(rng):
    """A made-up page, and its elements as (tag, attributes, chain of ancestors)."""
    out, open_, seen = [], [], []

    def start():
        tag = rng.choice(TAGS)
        while open_ and seen[open_[-1]][0] in ENDED_BY.get(tag, ()):
            open_.pop()
        attributes = {}
        if rng.random() < 0.6:
            attributes["class"] = " ".join(rng.sample(["x", "y", "z", "xx"], rng.randrange(3)))
        if rng.random() < 0.2:
            attributes["id"] = rng.choice("kl")
        if tag == "a":
            attributes["href"] = rng.choice(["/p/1", "/q/p/2", "#"])
        if rng.random() < 0.2:
            attributes["title"] = "t"
        seen.append((tag, attributes, list(open_)))
        out.append("<" + tag + "".join(f' {k}="{v}"' for k, v in attributes.items()) + ">" + rng.choice(["", "text", " "]))
        if tag not in VOID:
            open_.append(len(seen) - 1)

    for _ in range(60):
        if open_ and rng.random() < 0.35:
            k = rng.randrange(max(0, len(open_) - 2), len(open_))
            tag = seen[open_[k]][0]
            k = max(i for i in range(len(open_)) if seen[open_[i]][0] == tag)
            out.append(f"</{tag}>")
            del open_[k:]
        else:
            start()
    return "".join(out), seen


def simple(one, tag, attributes):
    """Whether an element fits a selector without combinators, cut by hand."""
    import re

    ok = True
    for t, c, i, n, op, v in re.findall(r'(\*|^[a-z]+)|\.([a-z]+)|#([a-z]+)|\[([a-z]+)(?:([*^~]?=)"([^"]*)")?\]', one):
        have = attributes.get(n, "")
        ok &= t in ("", "*", tag) and (not c or c in attributes.get("class", "").split()) and (not i or attributes.get("id") == i)
        ok &= not n or n in attributes and {"": True, "*=": v in have, "^=": have.startswith(v), "~=": v in have.split()}[op]
    return ok


def fits(selector, seen, at):
    def walk(parts, at):
        tag, attributes, above = seen[at]
        if not simple(parts[-1], tag, attributes):
            return False
        if len(parts) == 1:
            return True
        if parts[-2] == ">":
            return bool(above) and walk(parts[:-2], above[-1])
        return any(walk(parts[:-1], a) for a in above)

    return any(walk(one.split(), at) for one in selector.split(","))


def test_selectors_against_walks_of_the_tree():
    rng, compiled, hits = random.Random(1), Selectors(SELECTORS), 0
    for _ in range(150):
        html, seen = page(rng)
        got = parsed(html, compiled)
        assert [(e.tag, e.attributes) for e in got.elements] == [(t, a) for t, a, _ in seen]
        for s in SELECTORS:
            expected = [i for i in range(len(seen)) if fits(s, seen, i)]
            assert got.all(s) == expected, (s, html)
            hits += len(expected)
            for i, (_, _, above) in enumerate(seen):
                inside = [k for k in expected if i in seen[k][2]]
                assert got.all(s, i) == inside and got.first(s, i) == (inside[0] if inside else None)
                assert got.closest(s, i) == next((k for k in [i, *reversed(above)] if k in expected), None)
    assert hits > 5000


def test_texts_and_deep_pages():
    compiled = Selectors(["b", "script", "td"])
    got = parsed("<b> a&amp;<i>b </i></b><script>1 < 2</script><table><tr><td>x<td>y</table>", compiled)
    assert [got.text(i) for s in ("b", "script", "td") for i in got.all(s)] == ["a&b", "1 < 2", "x", "y"]
    assert got.visible() == "a& b x y"
    deep = parsed("<div>" * 3000 + "<b>z</b>", compiled)
    assert [deep.text(i) for i in deep.all("b")] == ["z"] and deep.text(0) == "z"
    assert parsed(None, compiled).all("b") == parsed("", compiled).all("b") == []


@pytest.mark.parametrize("text", ["", "a >", "a:hover", "[x", "a + b"])
def test_no_selector(text):
    with pytest.raises(ValueError):
        Selectors([text])


def offers_of(spark, seller, *pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "page int, html string")
    found = layouts.offers_of(rows, layouts.LAYOUTS[seller], "page").orderBy("page", "pos").collect()
    return [(r.page, r.name, r.price, r.productUrl) for r in found]


def test_pages_without_cards(spark):
    for seller in layouts.LAYOUTS:
        assert offers_of(spark, seller, None, "", "<p>x</p>", "<<<") == []


def test_cards_from_links_only(spark):
    """No card class fits, so links make the cards, each container once."""
    html = '<section><div><a href="/p/1">Bir</a><a href="/p/2"></a><h3>Birinci</h3><b class="price">1.234,50 tl 9</b></div><a href="/urun/3" title="Uc numara">x</a></section>'
    # of the second a link itself is the card, and nothing is below it
    assert offers_of(spark, "Watsons", html) == [(0, "Birinci", 1234.5, "https://www.watsons.com.tr/p/1")]


def test_climbing_stops_below_a_list(spark):
    html = '<div><i></i><i></i><i></i><p><a href="https://g/a-p-1"><span>Adı bir</span></a></p><p><a href="b-p-2" title="Başlık iki"></a></p></div>'
    assert offers_of(spark, "Gratis", html) == [(0, "Adı bir", 0.0, "https://g/a-p-1"), (0, "Başlık iki", 0.0, "https://www.gratis.com/b-p-2")]


def test_barcodes_at_the_end_of_links(spark):
    """As pazarama-scraper.js:127 has it: 8 to 13 digits at the end of a link are a barcode, whatever numbers them, and its query doesn't count."""
    card = '<div class="item"><a href="/{}">Uzun adı olan ürün</a><i class="fiyat">12,50 TL</i></div>'
    links = ["x-p-3999999", "x-p-31000000", "x-p-8690000000001?m=1", "x-p-86900000000012", "x-p-31000000-y"]
    rows = spark.createDataFrame([("".join(map(card.format, links)),)], "html string").selectExpr("1 AS page", "html")
    found = layouts.offers_of(rows, layouts.LAYOUTS["Pazarama"], "page").orderBy("pos").collect()
    assert [r.barcode for r in found] == ["", "31000000", "8690000000001", "", ""]


def test_shades_in_order(spark):
    html = ['<div class="product-variations"><a> A (3 ml) B</a><a>A (3 ml) B</a><a>' + "x" * 80 + '</a></div><li class="product-variations"><li data-value="v"></li></li>', '<div class="product-variations"></div><i class="selected-shade">x</i><i class="shade-name">yz</i>', None]
    rows = layouts.detail_elements(spark.createDataFrame(list(enumerate(html)), "k int, html string"), "k")
    assert [r.s for r in rows.orderBy("k").select(layouts.page_shades().alias("s")).collect()] == [["A B"], [], []]


def test_working_pages(spark):
    rows = [(1, 0, "x", 404), (1, 1, "404", 200), (1, 2, "Sayfa bulunamadi", 200), (1, 3, "y", 301), (1, 4, "z", 200), (2, 0, None, None), (3, 0, "x", 500), (None, 0, "x", 200)]
    got = offers.first_working(spark.createDataFrame(rows, "k int, n int, body string, status int"), "k", "n").collect()
    assert sorted((r.k, r.n) for r in got if r.k) == [(1, 3), (2, 0)]
    paths = spark.range(1).select(offers.alternative_paths(offers.F.lit("c"), offers.F.lit("Göz & 'Kaş'")).alias("p")).first().p
    assert paths == ["/c/c", "/search?q=G%C3%B6z%20%26%20'Ka%C5%9F'", "/makyaj/c/003?q=%3Arelevance%3Acategory%3Ac"]


def test_plain_pages_are_read_without_the_standard_parser(monkeypatch):
    """The sellers' pages are plain markup; what is read of plain and other pages is what the standard parser reads."""
    pieces = ['<div class="card x">', '<a href="/x-p-1?a=1&amp;b=2">', "</a>", "</div>", "<li>", "<br/>", "text", " a&amp;b ", "&", "<p class>", '<script type="x">{"a":"&amp;"}</script>', "<b>", "</b>", "<SCRIPT>a<b</SCRIPT>", "1 < 2", "<!-- c -->", "<i x='1'>", '<i title="&copyx=1" title="2">', "<textarea>", "</b >"]
    rng, compiled = random.Random(3), Selectors(SELECTORS)
    pages = ["".join(rng.choice(pieces[: 13 if k % 2 else None]) for _ in range(12)) for k in range(400)]
    fast = [parsed(h, compiled) for h in pages]
    with monkeypatch.context() as m:
        m.setattr("offerloom.sources.selectors._Reader.plain", lambda self, html: False)
        assert fast == [parsed(h, compiled) for h in pages]
    monkeypatch.setattr("html.parser.HTMLParser.feed", None)
    for seller, template in seller_queries.RESULT_PAGES.items():
        assert layouts.LAYOUTS[seller].cards(parsed(template, layouts.LAYOUTS[seller].selectors()))


def test_pages_of_one_file_are_dealt_to_all_tasks(spark, tmp_path):
    rows = [(i, "widget", "Brand#1", "SMALL", 1, 900.0) for i in range(40)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert seller_queries._detail_pages(spark, str(tmp_path)).rdd.getNumPartitions() == 4


def test_codes_of_pages_meet_without_a_broadcast(spark, tmp_path):
    """Both sides have a row a part, so neither goes whole through the driver, however small the parts' file is."""
    from offerloom import seller_queries

    parts = spark.range(8).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type", "1 AS p_size", "2.0D AS p_retailprice", "'m' AS p_mfgr", "'c' AS p_container")
    parts.write.parquet(f"{tmp_path}/part.parquet")
    found = seller_queries.q53_page_codes_and_brands(spark, str(tmp_path))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 8


def test_plain_pages_neither_set_up_the_standard_parser_nor_match_a_tag_twice(monkeypatch):
    template = seller_queries.DETAIL_PAGES[0]
    compiled = Selectors(["a", ".product-variations"])
    first, seen = parsed(template, compiled), []
    monkeypatch.setattr("html.parser.HTMLParser.__init__", None)
    monkeypatch.setattr("offerloom.sources.selectors.Selectors.known", lambda self, raw: seen.append(raw))
    assert parsed(template, compiled) == first and first.all("a") and not seen


def test_only_asked_elements_are_looked_for(spark):
    html = [*seller_queries.DETAIL_PAGES, None]
    pages = spark.createDataFrame(list(enumerate(html)), "k int, html string")
    whole = layouts.detail_elements(pages, "k")
    for names in (layouts.CODES, layouts.DETAILS):
        found = layouts.detail_elements(pages, "k", names=names)
        assert found.columns == ["k", *names]
        assert found.orderBy("k").collect() == whole.select("k", *names).orderBy("k").collect()
    assert set(whole.columns) == {"k", *layouts.CODES, *layouts.DETAILS}
