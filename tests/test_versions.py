import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from offerloom.sources import landed, sinks, versions


def _xs(spark, path, number=None):
    return sorted(r.x for r in versions.read(spark, path, "x long", number).collect())


def test_versions(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert versions.read(spark, path, "x long").count() == 0
    assert versions.replace(spark.range(3).toDF("x"), path, header=["// one"])
    assert versions.replace(versions.read(spark, path, "x long").withColumn("x", F.col("x") + 10), path), "a table may be made from itself"
    assert not versions.replace(spark.range(0).toDF("x"), path, unless_empty=True)
    assert _xs(spark, path) == [10, 11, 12] and versions.version(spark, path).header == ("// one",)
    assert _xs(spark, path, 1) == [0, 1, 2]
    with pytest.raises(Exception, match="boom"):
        versions.replace(spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("long").alias("x")), path)
    assert _xs(spark, path) == [10, 11, 12], "a write that is lost changes nothing"
    assert versions.clean(spark, path, keep=1) == 0, "young folders may be a writer's"
    assert versions.clean(spark, path, keep=1, grace=-5) >= 1 and versions.numbers(spark, path) == [2]
    assert _xs(spark, path) == [10, 11, 12] and len(os.listdir(f"{path}/data")) == 1
    assert versions.replace(spark.range(0).toDF("x"), path) and _xs(spark, path) == []


def test_overtaken(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.replace(spark.range(1).toDF("x"), path)
    stale = versions.version(spark, path)
    versions.replace(spark.range(2).toDF("x"), path)
    with pytest.raises(versions.Overtaken):
        versions._publish(spark, path, stale)
    assert _xs(spark, path) == [0, 1] and not [n for n in os.listdir(f"{path}/versions") if n.startswith(".") and not n.endswith(".crc")]


def test_appends_once_and_merges(spark, tmp_path, monkeypatch):
    """Batches that come again, in any number; levels of folders; two writers at once."""
    monkeypatch.setattr(versions, "MERGED", 3)
    path = f"{tmp_path}/t"
    did = [versions.append(spark.range(b, b + 1).toDF("x"), path, "w", b) for b in (0, 1, 1, 0, 2, 3, 4, 4, 5, 6, 7, 8, 9)]
    assert did == [True, True, False, False, True, True, True, False, True, True, True, True, True]
    assert _xs(spark, path) == list(range(10))
    assert sorted(level for _, level in versions.version(spark, path).folders) == [0, 2]
    both = [threading.Thread(target=lambda w=w: [versions.append(spark.range(100 * w + b, 100 * w + b + 1).toDF("x"), path, f"w{w}", b) for b in range(3)]) for w in (1, 2)]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert _xs(spark, path) == [*range(10), 100, 101, 102, 200, 201, 202]


def test_stream_that_starts_again(spark, tmp_path):
    """A stream whose last batch was added but not noted sends it again."""
    path = f"{tmp_path}/t"
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).toDF("x").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")

    def run():
        source = spark.readStream.schema("x long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        q = source.writeStream.foreachBatch(versions.appender(path, "s")).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        assert q.awaitTermination(120) and not q.exception()

    run()
    assert _xs(spark, path) == list(range(30))
    os.remove(f"{tmp_path}/c/commits/2")
    if os.path.exists(f"{tmp_path}/c/commits/.2.crc"):
        os.remove(f"{tmp_path}/c/commits/.2.crc")
    run()
    assert _xs(spark, path) == list(range(30))


def test_scripts_keep_their_headers(spark, tmp_path):
    path = f"{tmp_path}/s"
    products = spark.createDataFrame([(i, f'n{i} // ];\n"', [{"site": "a"}] * (i % 3)) for i in range(1, 8)], "id long, name string, prices array<struct<site:string>>")
    counts = spark.createDataFrame([("a", 3), ("b", 0)], "site string, n long")
    header = sinks.script_header(sinks.summary(products, counts), "Ürünler", "28.11.2026")
    assert header == ["// Ürünler — 7 urun, 1 satici", "// Otomatik uretildi: 28.11.2026", "// Coklu fiyat: 2 urunde birden fazla satici"]
    sinks.publish_script(products, path, ["id"], header, parts=3)
    schema = "id long, name string, prices array<struct<site:string>>, shades array<string>"
    now = sinks.script_rows(spark, path, schema)
    assert {r.id: r.name for r in now.collect()} == {r.id: r.name for r in products.collect()}
    sinks.publish_script(now.withColumn("shades", F.when(F.col("id") > 5, F.array(F.lit("x")))), path, ["id"], parts=2)
    folder = versions.version(spark, path).folders[0][0]
    parts = sorted(n for n in os.listdir(f"{path}/data/{folder}") if n.startswith("part-"))
    whole = "".join(open(f"{path}/data/{folder}/{n}").read() for n in parts)
    assert whole.split("\n")[:4] == [*header, "const products = ["] and whole.endswith("\n];\n")
    listed = json.loads(whole[whole.index("= ") + 2 : whole.rindex(";")])
    assert [(p["id"], p.get("shades")) for p in listed] == [(i, ["x"] if i > 5 else None) for i in range(1, 8)]
    (tmp_path / "whole.js").write_text(whole)
    assert [r.id for r in landed.script_array(spark, f"{tmp_path}/whole.js", "id long").orderBy("pos").collect()] == list(range(1, 8))
    assert landed.script_header(spark, f"{tmp_path}/whole.js") == header
    sinks.publish_script(products.limit(0), path, ["id"])
    assert sinks.script_rows(spark, path, schema).count() == 0
