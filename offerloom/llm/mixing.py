"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm import words
from offerloom.llm.line_rules import join_key, row_key
from offerloom.llm.storage import materialize

#: Ranges of the sampling hash in which a source's words are summed before the cut is looked for, and of each again.
RANGES = 4096
#: Documents at most that each source gets to come nearer to its target.
TOP_UPS = 8
#: Bits of the sampling hash, which both Spark and other engines make of an MD5 digest.
HASH_BITS = 60


def source_key(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("-"))


def sized(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, th1, th2, source, size, h): a row a document; ``h`` in [0, 2^60) orders a source's documents."""
    rows = docs.select(*row_key(docs, id_col, text_col), F.col(source_col).alias("source"), source_key(source_col).alias("sk"), words.word_count(F.col(text_col)).alias("size"))
    copy = rows.groupBy("id", "th1", "th2", "source", "sk", "size").agg(F.count("*").alias("copies"))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("-")), "sk"))
    return copy.withColumn("h", F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long"))


def turns(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``turn`` (long): the place of its source in the order of code points, null last, from 0.

    Sources are dealt by range and counted, a number a range comes to the driver,
    and each range is numbered by itself.
    """
    n = max(1, int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = sizes.withColumn("last", F.col("source").isNull()).repartitionByRange(n, "last", "source").withColumn("range", F.spark_partition_id())
    dealt = materialize(dealt, "mix-turns")
    first, upto = [], 0
    for r, count in sorted((x["range"], x["count"]) for x in dealt.groupBy("range").count().collect()):
        first += [F.lit(r), F.lit(upto)]
        upto += count
    start = F.element_at(F.create_map(*first), F.col("range")) if first else F.lit(0)
    place = F.row_number().over(Window.partitionBy("range").orderBy("last", "source"))
    return dealt.withColumn("turn", (start + place - 1).cast("long")).drop("last", "range")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_epochs: float) -> DataFrame:
    """(sk, source_size, target): what the mix takes of each source.

    ``sizes`` (sk, source, source_size) is a row a source. The sources in order of
    code points, null last, take the weights in turn and share ``share`` of all
    words in proportion to them. Sources that would have to give more than
    ``max_epochs`` times their words are clamped there and the rest is shared
    anew, until none is above. A round sends two sums to the driver.
    """
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("turn", F.lit(len(weights))) + 1).cast("int"))
    table = materialize(turns(sizes).withColumn("weight", turn.cast("double")).withColumn("cap", max_epochs * F.col("source_size")), "mix-sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, words_left = None, share * total
    while True:
        free = F.lit(True) if level is None else F.col("weight") * level <= F.col("cap")
        got = table.agg(F.sum(F.when(free, F.col("weight"))).alias("w"), F.sum(F.when(~free, F.col("cap"))).alias("used")).first()
        weight, used = got["w"] or 0.0, got["used"] or 0.0
        if not weight:  # all are clamped
            level = float("inf")
            break
        new = max(0.0, (words_left - used) / weight)
        if level is not None and new <= level * (1 + 1e-12):
            break
        level = new
    level_col = F.lit(float(level))
    share_of = F.when(F.col("cap") <= 0, 0.0).otherwise(F.least(F.col("cap"), F.col("weight") * level_col))
    return table.select("sk", "source_size", share_of.alias("target"))


def _cut_range(rows: DataFrame, keys: list[str], shift: int) -> DataFrame:
    """The range of ``h`` in which a source's words pass ``want``, of its rows in the ranges ``keys``: (sk, r, before), ``before`` the words below it."""
    sums = rows.groupBy("sk", *keys, F.shiftright("h", shift).alias("r")).agg(F.sum("weight").alias("words"), F.first("want").alias("want"))
    running = F.sum("words").over(Window.partitionBy("sk").orderBy("r"))
    cut = sums.withColumn("upto", running).filter(F.col("upto") > F.col("want"))
    cut = cut.groupBy("sk").agg(F.min(F.struct("r", (F.col("upto") - F.col("words")).alias("before"))).alias("c"))
    return cut.select(F.concat(F.lit("k"), "sk").alias("ck"), F.col("c.r").alias("cut"), F.col("c.before").alias("before"))


def _below_cut(rows: DataFrame) -> DataFrame:
    """Adds ``chosen``: a source's first documents by (h, text) whose words (``weight``) sum to ``want`` at most.

    Words are summed by source and range of the hash first, then within the one
    range a source whose words pass ``want``; only the documents of a range of that
    range, one in 16 million, are put in order.
    """
    bits = RANGES.bit_length() - 1
    coarse, fine = HASH_BITS - bits, HASH_BITS - 2 * bits
    keyed = rows.withColumn("ck", F.concat(F.lit("k"), "sk"))
    first = materialize(_cut_range(rows, [], coarse), "mix-coarse")
    inside = keyed.join(first, "ck").filter(F.shiftright("h", coarse) == F.col("cut")).withColumn("want", F.col("want") - F.col("before")).drop("ck", "cut", "before")
    second = materialize(_cut_range(inside, [], fine), "mix-fine")
    both = second.select("ck", "cut", F.col("before").alias("more")).join(first.select("ck", "before"), "ck").select("ck", "cut", (F.col("before") + F.col("more")).alias("before"))
    placed = keyed.join(both, "ck", "left")
    last = placed.filter(F.shiftright("h", fine) == F.col("cut"))
    order = Window.partitionBy("sk").orderBy("h", "th1", "th2").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("chosen", F.sum("weight").over(order) + F.col("before") <= F.col("want"))
    rest = placed.filter(F.col("cut").isNull() | (F.shiftright("h", fine) != F.col("cut"))).withColumn("chosen", F.col("cut").isNull() | (F.shiftright("h", fine) < F.col("cut")))
    return last.unionByName(rest).drop("ck", "cut", "before")


def _top_ups(chosen: DataFrame) -> DataFrame:
    """(sk, weight, h): the documents that fill what is missing to ``want``: the largest that fits, again for the rest, and so on.

    Of each source and weight the first document by hash that isn't taken stands
    for all; what a source gathers is one entry a distinct weight, bounded by the
    longest text.
    """
    missing = chosen.groupBy("sk").agg(F.first("want").alias("want"), F.sum(F.when(F.col("chosen"), F.col("weight")).otherwise(0)).alias("has"))
    missing = missing.select(F.concat(F.lit("t"), "sk").alias("tk"), (F.col("want") - F.col("has")).alias("left"))
    free = chosen.filter(~F.col("chosen") & (F.col("weight") > 0)).groupBy("sk", "weight").agg(F.min("h").alias("h"))
    fits = free.withColumn("tk", F.concat(F.lit("t"), "sk")).join(missing, "tk").filter(F.col("weight") <= F.col("left"))
    lists = fits.groupBy("sk").agg(F.sort_array(F.collect_list(F.struct("weight", "h")), asc=False).alias("free"), F.first("left").alias("left"))
    start = F.struct(F.col("left").alias("left"), F.filter("free", lambda x: F.lit(False)).alias("taken"))
    take = lambda s, x: F.when((x["weight"] <= s["left"]) & (F.size(s["taken"]) < TOP_UPS), F.struct((s["left"] - x["weight"]).alias("left"), F.concat(s["taken"], F.array(x)).alias("taken"))).otherwise(s)
    return lists.select("sk", F.explode(F.aggregate("free", start, take)["taken"]).alias("x")).select("sk", "x.weight", "x.h")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 20, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, th1, th2, source, size, source_size, target, times): how often the mix takes each distinct row.

    A document is taken whole, floor(target / source size) times, and once more if
    the seeded order of its source's documents puts it before the cut that the
    remaining fraction makes. What is missing there is filled by the largest document
    that fits, by the seeded order among those of its size, and so on with smaller
    ones, ``TOP_UPS`` at most, so that a source comes near its target though
    documents are never cut. Nothing depends on partitioning: reruns agree. A very
    long text is a large size and nothing more. Null and empty texts have size 0; a null source is a source of its own,
    the last one; rows equal in id, text and source are taken alike.
    """
    rows = materialize(sized(docs, seed, id_col, text_col, source_col), "mix-sizes")
    sizes = rows.groupBy("sk").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    goal = targets(sizes, weights, share, max_epochs)
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int"))
    goal = goal.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    joined = rows.withColumn("jk", F.concat(F.lit("j"), "sk")).join(goal.select(F.concat(F.lit("j"), "sk").alias("jk"), "source_size", "target", "whole", "part"), "jk").drop("jk")
    joined = joined.withColumns({"weight": F.col("size") * F.col("copies"), "want": F.col("part")})
    chosen = materialize(_below_cut(joined), "mix-cut")
    extra = _top_ups(chosen).withColumn("extra", F.lit(True))
    key = lambda: F.concat_ws("|", F.lit("x"), "sk", "weight", "h").alias("xk")
    # rows that share a hash are texts of one id: the first of them is meant
    one = Window.partitionBy("xk").orderBy("th1", "th2")
    rest = chosen.filter(~F.col("chosen")).withColumn("xk", key()).join(extra.select(key(), "extra"), "xk").withColumn("n", F.row_number().over(one)).filter("n = 1")
    added = materialize(rest.select(join_key("id", "th1", "th2", "sk").alias("row"), "extra"), "mix-extra")
    more = (F.col("chosen") | F.coalesce("extra", F.lit(False))) & (F.col("want") > 0)  # nothing is wanted of a source that gives whole repetitions only, empty documents neither
    chosen = chosen.withColumn("row", join_key("id", "th1", "th2", "sk")).join(added, "row", "left").withColumn("chosen", more)
    return chosen.select("id", "th1", "th2", "source", "sk", "copies", "size", "source_size", "target", (F.col("whole") + F.col("chosen").cast("int")).alias("times"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixture itself: the rows of ``docs``, each as often as the mix takes it; columns as in ``docs``."""
    plan = mixed(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options).filter("times > 0")
    plan = plan.select(join_key("id", "th1", "th2", "sk").alias("_mix_row"), F.col("times").alias("_mix_times"))
    keyed = docs.withColumn("_mix_row", F.struct(*row_key(docs, id_col, text_col), source_key(source_col).alias("sk")))
    keyed = keyed.withColumn("_mix_row", join_key("_mix_row.id", "_mix_row.th1", "_mix_row.th2", "_mix_row.sk"))
    taken = keyed.join(plan, "_mix_row")
    return taken.withColumn("_mix_n", F.explode(F.sequence(F.lit(1), F.col("_mix_times")))).select(*docs.columns)
