import datetime as dt
import json
import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from offerloom.operators import robots
from offerloom.sources import arrays, landed, markup, sinks
from offerloom.streaming import limiter


def test_offer_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"name": "x", "price": 3.5, "imageUrl": ["u", "v"]}, {"name": "y"}]))
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "broken.json").write_text("{oops")
    got = landed.offers(spark, str(tmp_path), {"A": "a.json", "B": "empty.json", "C": "broken.json", "D": "missing.json"})
    assert {s: df.count() for s, df in got.items()} == {"A": 2, "B": 0, "C": 0, "D": 0}
    assert [(r.name, r.price, r.pos, r.imageUrl) for r in got["A"].orderBy("pos").collect()] == [("x", 3.5, 0, '["u","v"]'), ("y", None, 1, None)]


def test_arrays_by_any_cut(spark, tmp_path):
    """Whatever the splits, elements are those that a parser of whole files finds: braces and quotes in strings, nested objects, long elements."""
    rng = random.Random(4)
    words = ["a}b", '{"', '\\"', "\\\\", "}", "[", "é漢", "x" * 50, "", "\n"]
    made = {"a": [{"name": rng.choice(words), "v": {"k": [{"z": rng.choice(words)}], "t": rng.choice(words)}, "n": i} for i in range(9)], "empty": [], "one": [{}], "flat": [{"n": 1}, 5, "s", None, {"n": 2}]}
    for name, rows in made.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=rng.choice([None, 1]), ensure_ascii=False))
    whole = (tmp_path / "a.json").read_text()
    for name, text in {"cut": whole[: len(whole) // 2], "object": '{"a":[{"n":1}]}', "none": "", "more": whole + "]", "string": whole.rstrip("]") + '"]'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    expected = sorted((name, i, json.dumps(r)) for name, rows in made.items() for i, r in enumerate(x for x in rows if isinstance(x, dict)))
    for cut in (37, 500):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(cut))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            found = arrays.elements(spark, f"{tmp_path}/*.json").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted((r.path.split("/")[-1][:-5], r.pos, json.dumps(json.loads(r.body))) for r in found) == expected


def test_key_maps_and_scripts(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"1": "8690000000000", "2": null}')
    assert {r.key: r.value for r in landed.key_map(spark, f"{tmp_path}/m.json").collect()} == {"1": "8690000000000", "2": None}
    (tmp_path / "p.js").write_text('// head\n// more\nconst products = [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}];\n')
    assert [(r.id, r.name, r.pos) for r in landed.script_array(spark, f"{tmp_path}/p.js", "id long, name string").collect()] == [(1, "a", 0), (2, "b", 1)]


def test_search_and_sitemap(spark):
    body = json.dumps({"product": {"hits": {"total": {"value": 2}, "hits": [{"_source": {"name": "n", "price": 100.0, "special_price": 0.0, "crm_price": 80.0, "ross_60_price": 75.0}}]}}})
    rows = landed.search_pages(spark.createDataFrame([(body,)], "body string")).collect()
    assert (rows[0].name, rows[0].price) == ("n", 75.0)
    xml = "<urlset><url><loc>https://s/makyaj/x-p-12</loc></url><url><loc>https://s/diger/y-p-13</loc></url><url><loc>https://s/makyaj/z</loc></url></urlset>"
    got = landed.sitemap(spark.createDataFrame([(xml,)], "body string"), {"makyaj": "ruj"}).collect()
    assert [(r.product_id, r.category) for r in got] == [("12", "ruj")]


def test_linked_data(spark):
    html = '<script type="application/ld+json">{"name":"P","hasVariant":[{"name":"a","url":"u","offers":{"price":1.5}},{"name":"a","url":"v"},{"name":"b"}]}</script><script type="application/ld+json">oops</script>'
    rows = markup.variants(spark.createDataFrame([(1, html)], "page long, html string"), "page").orderBy("name").collect()
    assert [(r.name, r.url, r.price) for r in rows] == [("a", "u", 1.5), ("b", None, 0.0)]
    a = spark.createDataFrame([(1, "x")], "k long, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z")], "k long, v string")
    assert sorted(tuple(r) for r in markup.with_fallback(a, b, "k").collect()) == [(1, "x"), (2, "z")]


def test_cards():
    page = '<div class="card big"><a href="/1"><img src="i.png"></a><span class="name"> One  more </span><b class="old"></b><b class="now">12,00 TL</b></div><div class="card"><span class="title">Two</span></div>'
    layout = markup.Cards(("div", "card"), {"name": (("span", "name", ""), ("span", "title", "")), "price": (("b", "old", ""), ("b", "now", "")), "url": (("a", "", "href"),)})
    assert markup.cards_of(page, layout) == [{"name": "One more", "price": "12,00 TL", "url": "/1"}, {"name": "Two", "price": "", "url": ""}]


def test_snapshot_stays_when_empty(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "x long")
    path = f"{tmp_path}/s"
    assert sinks.snapshot_unless_empty(rows, path, "parquet")
    assert not sinks.snapshot_unless_empty(rows.limit(0), path, "parquet")
    assert spark.read.parquet(path).count() == 1
    assert sinks.checkpoint_table(spark, f"{tmp_path}/none", "k string").count() == 0


def test_robots(spark):
    body = "User-agent: a\nDisallow:\nUser-agent: *\nDisallow: /x\n# note\nUser-agent: b\nDisallow: /b"
    files = spark.createDataFrame([("h", body)], "host string, body string")
    rules = lambda agent: sorted((r.kind, r.pattern) for r in robots.parsed_rules(files, agent).collect())
    assert rules("a") == rules("zzz") == [("disallow", "/x")] and rules("b") == [("disallow", "/b")]
    table = spark.createDataFrame([("disallow", "/a"), ("allow", "/a/b"), ("allow", "/t"), ("disallow", "/t"), ("disallow", "/x?q=*")], "kind string, pattern string")
    paths = spark.createDataFrame([(i, p) for i, p in enumerate(["/a/b/c", "/a/x", "/t", "/none", "/x?q=1"])], "i int, path string")
    assert [r.allowed for r in robots.decisions(paths, table, "i").orderBy("i").collect()] == [True, False, False, True, True]


START = dt.datetime(2024, 1, 1)


def events(spark, seconds, key="k"):
    return spark.createDataFrame([(i, key, START + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)], "i long, key string, ts timestamp")


def test_limiter_windows(spark):
    rows = limiter.counted(events(spark, [0, 10, 60, 61, 121, 122]), "key", "ts", 60, 5, "i").orderBy("i").collect()
    assert [r["count"] for r in rows] == [1, 2, 3, 1, 2, 1]
    assert [r.limited for r in limiter.counted(events(spark, range(6)), "key", "ts", 60, 5, "i").orderBy("i").collect()] == [False] * 5 + [True]


def test_limiter_equals_walk_over_events(spark):
    """Windows and keys that go on in the next batch, a null key, ties and an empty table."""
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(300)), i) for i in range(200)]
    expected, state = {}, {}
    for k, t, i in sorted(rows, key=lambda r: r[1:]):
        start, n = state.get(k, (t, 0))
        start, n = (t, 0) if t > start + timedelta(seconds=20) else (start, n)
        state[k], expected[i] = (start, n + 1), (n + 1, n + 1 > 4)
    table = spark.createDataFrame(rows, "key string, ts timestamp, i long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = {r.i: (r["count"], r.limited) for r in limiter.counted(table, "key", "ts", 20, 4, "i").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == expected
    assert limiter.counted(table.filter("i < 0"), "key", "ts", 20, 4, "i").count() == 0


def _hot(rng, n):
    """One key has nearly all events: dense, sparse and equal times, and some without one."""
    rows, at = [], 0.0
    for i in range(n):
        at += rng.choice([0, 0, 0.001, 0.5, 1, 7, 19, 20, 21, 45])
        rows.append(("hot" if rng.random() < 0.9 else rng.choice(["a", None, "z"]), START + dt.timedelta(seconds=at), i))
    rows += [("none", None, n + i) for i in range(40)] + [("none", START + dt.timedelta(seconds=i * 50), n + 100 + i) for i in range(5)]
    rng.shuffle(rows)
    return rows


def _by_walk(rows, width, limit):
    expected, state = {}, {}
    for k, t, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or START, r[2])):
        start, n = state.get(k, (t, 0))
        start, n = (t, 0) if start is not None and t > start + timedelta(seconds=width) else (start, n)
        state[k], expected[i] = (start, n + 1), (n + 1, n + 1 > limit)
    return expected


def test_limiter_spreads_a_hot_key(spark):
    """Ranges of one key meet by their maps: windows within a range, over one, and over many, or one for all."""
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for seed, width in ((1, 1), (2, 20), (3, 200), (4, 10**7)):
            rows = _hot(random.Random(seed), 700)
            table = spark.createDataFrame(rows, "key string, ts timestamp, i long").repartition(5)
            found = limiter.counted(table, "key", "ts", width, 4, "i")
            assert {r.i: (r["count"], r.limited) for r in found.collect()} == _by_walk(rows, width, 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_limiter_stream_equals_batch(spark, tmp_path):
    """Events shuffled over batches, within the delay; a last event far off lets all others pass."""
    rng = random.Random(9)
    times = sorted(rng.randrange(0, 900) for _ in range(120))
    rows = [(rng.choice("jk"), START + dt.timedelta(seconds=s, milliseconds=rng.randrange(1000))) for s in times]
    late = sorted(rows, key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(50)))
    batches = [late[i : i + 20] for i in range(0, len(late), 20)] + [[("end", START + dt.timedelta(days=9))], [("end", START + dt.timedelta(days=10))]]
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, "key string, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/{i}")
        (tmp_path / "in").mkdir(exist_ok=True)
        part = next((tmp_path / str(i)).glob("part-*"))
        part.rename(tmp_path / "in" / f"{i:03d}.parquet")
        os.utime(tmp_path / "in" / f"{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        source = spark.readStream.schema("key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        run = limiter.stream(source, "key", "ts", 60, 5).writeStream.trigger(availableNow=True).format("memory").queryName("limited").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
        assert run.awaitTermination(170)
        assert not run.exception(), run.exception()
    finally:
        spark.conf.unset(provider)
    table = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "key string, ts timestamp, i long")
    batch = sorted((r.key, r.ts, r["count"], r.limited) for r in limiter.counted(table, "key", "ts", 60, 5, "i").collect())
    assert sorted((r.key, r.ts, r["count"], r.limited) for r in spark.table("limited").filter("key != 'end'").collect()) == batch


def test_request_order(spark):
    rows = [("GET", False, "12", "a@b.co", 405), ("POST", True, "12", "a@b.co", 429), ("POST", False, "12", "", 400), ("POST", False, "12", "a@b.c", 400), ("POST", False, "12", "a@b.co", 200), ("POST", False, "1x", "a@b.co", 400), ("POST", False, None, None, 400)]
    df = spark.createDataFrame(rows, "m string, l boolean, p string, e string, x int")
    assert all(r.s == r.x for r in df.select("x", limiter.response(F.col("m"), F.col("l"), F.col("p"), F.col("e")).alias("s")).collect())
    backed = limiter.backed_off(spark.createDataFrame([("k", i, i != 3) for i in range(22)], "k string, i int, f boolean"), "k", "i", "f", 15).orderBy("i").collect()
    assert [r.i for r in backed if r.backs_off] == [19]
