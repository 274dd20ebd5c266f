import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from offerloom.llm import line_dedup, mixing, quality, topk, urls

LONG = "x" * 20 + " Long line of boilerplate text " + "y" * 10


def test_line_dedup(spark):
    rows = [(i, f"own {i}\n{LONG.upper() if i % 2 else '  ' + LONG}\n\ntail") for i in range(6)] + [(7, None), (8, ""), (9, f"{LONG}\n{LONG}\nend"), (9, f"{LONG}\n{LONG}\nend")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, pos int, n_dropped int")
    got = line_dedup.dedup_lines(docs).collect()
    texts = sorted((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got)
    assert texts == sorted([(i, f"own {i}\n\ntail", 4, 1) for i in range(6)] + [(7, "", 1, 0), (8, "", 1, 0)] + [(9, f"{LONG}\n{LONG}\nend", 3, 0)] * 2)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_drops_whole_texts(spark):
    docs = spark.createDataFrame([(i, LONG) for i in range(5)] + [(None, LONG + "\nkeep")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {0: "", 1: "", 2: "", 3: "", 4: LONG, None: "keep"}


def measures(text):
    words = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x.split()]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") if i % 2 else rng.choice(["é", "bb", "#c", "d"]) for _ in range(rng.randrange(40))).replace("d", "\n"), "s") for i in range(60)] + [(90, None, None), (91, "", "s"), (91, "", "s"), (92, "a b c d e " * 400, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.judged(docs).collect()), key=str)
    assert got == sorted(((i, *measures(t)) for i, t, _ in rows), key=str)
    assert quality.judged(docs.limit(0)).count() == 0


def brute_quality(rows, limits=quality.Limits()):
    """({row number: kept}, {row number: cleaned text}) of rows (doc_id, text, source)."""
    strip = lambda x: re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", x)
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in strip(x))
    holders, hosts = {}, {}
    for i, t, s in rows:
        hosts.setdefault(s, set()).add(i)
        for x in (t or "").split("\n"):
            if x.split():
                holders.setdefault((s, key(x)), set()).add(i)
    over = {(s, k) for (s, k), ids in holders.items() if len(ids) >= limits.line_docs and len(ids) > limits.line_share * len(hosts[s])}
    kept, cleaned = {}, {}
    for n, (_, t, s) in enumerate(rows):
        m = measures(t)
        lines = (t or "").split("\n")
        left = m[0] - sum(len(x.split()) for x in lines if (s, key(x)) in over)
        good = m[0] >= limits.min_words and 100 * m[4] <= limits.max_repeat_percent * m[0]
        kept[n] = good and left >= limits.min_words and left >= m[0] * limits.min_left
        cleaned[n] = "\n".join(x for x in lines if (s, key(x)) not in over)
    return kept, cleaned


def test_frequent_lines_by_default_limits(spark):
    """Both outcomes on hosts of 5, 50 and 500 documents, on a null host, for base failures, repeated rows and a very long text."""
    rng = random.Random(8)
    body = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows, at = [], 0
    for host, n in (("five", 5), ("fifty", 50), ("many", 500), (None, 30), ("four", 4)):
        for k in range(n):
            at += 1
            often = "  Shared MENU line of this site \t" if k % 2 else "shared menu line of this site"
            rows.append((at, (f"{often}\n" if n < 6 or k % 6 == 0 else "rare line of it\n" if k % 11 == 0 else "") + body(rng.choice([4, 9, 14, 40])), host))
    rows += [(at + 1, "shared menu line of this site\n" + "same words here again now " * 9, "fifty")] * 2
    rows += [(at + 2, "\n".join([body(9000), *["shared menu line of this site"] * 3000]), "many"), (at + 3, None, "five"), (None, "", None)]
    docs = spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in rows], "doc_id long, text string, source string, n_lost int, host int")
    kept, cleaned = brute_quality(rows)
    base = [measures(t)[0] >= 10 and 100 * measures(t)[4] <= 20 * measures(t)[0] for _, t, _ in rows]
    by_lines = [s for n, (_, _, s) in enumerate(rows) if base[n] and not kept[n]]
    assert {"five", "fifty", "many", None} <= set(by_lines) and "four" not in by_lines
    got = sorted((r.id if r.id is not None else -1, r.kept, r.base_failed) for r in quality.judged(docs).collect())
    assert got == sorted((i if i is not None else -1, kept[n], not base[n]) for n, (i, _, _) in enumerate(rows))
    assert sorted((r.doc_id, r.text) for r in quality.clean(docs).collect()) == sorted((i, cleaned[n]) for n, (i, _, _) in enumerate(rows) if kept[n])


def test_mixing(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(1, 60))), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)] + [(700, None, "a"), (701, "", "d"), (702, "same words", "b"), (702, "same words", "b"), (None, "x y", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    plan = mixing.mixed(docs).collect()
    again = mixing.mixed(docs.repartition(7)).collect()
    key = lambda r: (str(r.id), r.th1, str(r.source), r.times, r.target)
    assert sorted(map(key, plan)) == sorted(map(key, again))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    total, weight = 1.5 * sum(sizes.values()), dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    clamped: set = set()
    while True:
        level = (total - sum(2 * sizes[s] for s in clamped)) / max(1e-9, sum(w for s, w in weight.items() if s not in clamped))
        over = {s for s in weight if s not in clamped and weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        clamped |= over
    for s in weight:
        target = 2 * sizes[s] if s in clamped else weight[s] * level
        mine = [r for r in plan if r.source == s]
        assert all(r.target == pytest.approx(target) and r.source_size == sizes[s] and r.times in (0, 1, 2) for r in mine)
        assert abs(sum(r.size * r.copies * r.times for r in mine) - target) <= 2
    assert mixing.mix(docs).count() == sum(r.times * r.copies for r in plan)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_urls(spark):
    vocabulary = urls.Vocabulary((("casino", 10), ("bet", 5), ("free", 5), ("win", 5), ("x", 4)))
    cases = {
        "http://WWW.Example.com/en/x": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://a.example.com/en/casino": ("a.example.com", "/en/casino", "example.com/en/", "block"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://x.org/Casino?y": ("x.org", "/Casino", None, "block"),
        "http://x.org/casinos": ("x.org", "/casinos", None, "allow"),
        "http://x.org/free-free": ("x.org", "/free-free", None, "allow"),
        "http://x.org/free_bet": ("x.org", "/free_bet", None, "block"),
        "http://y.net/fr/free/bet": ("y.net", "/fr/free/bet", "net/fr/", "block"),
        "http://x.com?bet=free": ("x.com", "", None, "block"),
        "http://y.net/free-x": ("y.net", "/free-x", None, "allow"),
        "no scheme casino": ("", "", None, "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://é.org/casinoé\n": ("é.org", "/casinoé\n", None, "block"),
    }
    pages = spark.createDataFrame([(u, 1) for u in cases], "url string, host int")
    got = urls.judge(pages, vocabulary=vocabulary).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == list(cases.values())
    assert urls.judge(pages.limit(0)).count() == 0


def test_mixing_of_texts_that_share_an_id(spark):
    """Texts of one id share their hash; sizes, a very long one too, columns of the function's own names, and ties by size."""
    rows = [(7, "a " * 5, "a", 1, 2), (7, "b " * 5, "a", 1, 2), (7, "c " * 4, "a", 1, 2), (8, "long " * 200_000, "b", 1, 2), (9, "x " * 3, None, 1, 2)] + [(20 + i, "same size here", "a", 1, 2) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight int, want int")
    plan = mixing.mixed(docs).collect()
    for s in ("a", "b", None):
        mine = [r for r in plan if r.source == s]
        assert sum(r.copies for r in mine) == sum(r[2] == s for r in rows)
        taken = sum(r.size * r.copies * r.times for r in mine)
        assert mine[0].target - min(r.size for r in mine) < taken <= mine[0].target + 1e-6
    mix = mixing.mix(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r.times * r.copies for r in plan)


def test_vocabulary_on_labelled_urls(spark):
    """The default vocabulary against urls with a verdict by hand: no clean one is blocked, and nine tenths of the others are."""
    bad = [
        "https://free-bets.example.org/a", "https://blog.casino-win.example.org/en/1", "https://cheap-pills.example.org", "https://m.adult-x.example.org/1.html", "http://site.org/sexy-cams/", "http://site.org/Poker_Bonus",
        "http://site.org/hot-dating?ref=x", "http://jackpot.site.org/", "http://site.org/buy/viagra", "http://site.org/xxx/1", "http://site.org/a?q=nude+cams", "http://site.org/loans/cheap", "http://site.org/torrent/crack", "http://slots.site.org/win",
    ]
    clean = [
        "https://site.org/adult-education", "https://site.org/free/software", "https://site.org/essex/middlesex", "https://site.org/alphabet", "https://site.org/hotel/free-wifi", "https://site.org/download?ref=x", "https://site.org/student-loans", "https://site.org/news?page=2&ref=x",
        "https://site.org/winter/hot-soup", "https://site.org/better/betty", "https://site.org/escorted-tours", "https://site.org/sex-ratio", "https://site.org/crackers", "https://site.org/casinoroyale-review",
    ]
    got = {r.url: r.verdict for r in urls.judge(spark.createDataFrame([(u,) for u in bad + clean], "url string")).collect()}
    assert [u for u in clean if got[u] == "block"] == []
    assert sum(got[u] == "block" for u in bad) >= 0.9 * len(bad)
    table = spark.createDataFrame([("Foo ", 10), ("foo", 3), ("bar", 5), (None, 5), ("baz", None), ("", 10)], "term string, weight int")
    assert urls.vocabulary_of(table) == urls.Vocabulary((("bar", 5), ("foo", 10)))
    with pytest.raises(ValueError):
        urls.vocabulary_of(table, most=1)


@pytest.mark.parametrize("tile_bytes,waves", [(8 << 20, 16), (8 << 20, 2), (100, 3)])
def test_top_k(spark, monkeypatch, tile_bytes, waves):
    for name, value in (("TILE", 16), ("QUERY_TILE", 2), ("TILES_AT_ONCE", 2), ("TILE_BYTES", tile_bytes), ("QUERY_BYTES", tile_bytes), ("WAVES", waves)):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(4)]) for i in range(0, 200, 2)] + [(1, None), (3, [1.0, None]), (5, [float("nan")]), (None, [9.0]), (7, [0.5]), (7, [0.5]), (9, []), (50, [1.0])]
    rows += [(rows[25][0], list(rows[25][1])), (11, [2.0] * 40), (11, [2.0] * 40)]  # a repeated query, and repeated candidates
    vectors = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5).collect())
    whole = [(i, tuple(int(256 * x // 1) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and x == x for x in v)]
    expected = []
    for qid in {i for i, _ in whole if i % 50 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for j, q in set(whole) if j == qid for i, v in whole if i != qid)[:5]
        expected += [(qid, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got == sorted(expected)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_products_beyond_doubles():
    import numpy as np

    q, v = np.array([[2**40 + 1, 3]]), np.array([[2**20 + 1, -5], [1, 1]])
    assert topk.products(q, v).tolist() == [[(2**40 + 1) * (2**20 + 1) - 15, 2**40 + 4]]


def test_digest_of_dropped(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    row = line_dedup.dedup_lines(docs).select(F.sha2("text", 256).alias("d")).first()
    assert row.d == hashlib.sha256(b"a\nb").hexdigest()


def test_mixing_of_empty_documents_in_a_clamped_source(spark):
    """A source that gives all that it may gives its empty documents no more often than the others; sizes that tie are taken once each."""
    rows = [(i, "", "a") for i in range(5)] + [(10 + i, "w w", "a") for i in range(4)] + [(20 + i, "x " * 500, "b") for i in range(20)] + [(90, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = {r.id: r for r in mixing.mixed(docs).collect()}
    assert plan[10].target == 2 * plan[10].source_size and {plan[i].times for i in [*range(5), *range(10, 14), 90]} == {2}
    assert max(r.times for r in plan.values()) <= 2
    assert mixing.mix(docs).filter("source = 'a'").count() == 20
