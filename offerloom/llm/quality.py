"""Quality rules: base rules within a text, then the frequency of lines across a host's documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm import words
from offerloom.llm.line_rules import drop_lines, join_key, moved, row_key
from offerloom.llm.storage import materialize


@dataclass(frozen=True)
class Limits:
    """Limits of the rules.

    A line is above its limit in a host when more than ``line_share`` of the host's
    documents hold it; at least ``line_docs`` must, which only keeps chance out of
    hosts of a few documents. A document is depleted when such lines leave it fewer
    than ``min_words`` words or less than ``min_left`` of its words: 30 % of a text
    in repeated lines is the limit that the published Gopher rules set within one.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    line_docs: int = 5
    line_share: float = 0.1
    min_left: float = 0.7


SYMBOLS = "[#*$%&|<>]"


def measured(docs: DataFrame, text_col: str = "text", window: int = 5) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long) to ``docs``.

    Windows of words are compared by 64-bit hashes within their text. Only where
    two are equal are they sorted to find the words that they cover.
    """
    text = F.col(text_col)
    word_lines = F.filter(words.lines(text), lambda x: x.rlike(words.WORD))
    found = docs.withColumns({"_words": words.words(text), "_lines": word_lines})
    n = F.size("_words")
    shifted = [F.slice("_words", i + 1, F.greatest(n - window + 1, F.lit(0))).alias(f"w{i}") for i in range(window)]
    grams = F.transform(F.arrays_zip(*shifted), lambda g: F.xxhash64(g))
    found = found.withColumns({"n_words": n.cast("long"), "word_chars": F.char_length(F.array_join("_words", "")).cast("long"), "_grams": grams})
    found = found.withColumn("_repeats", F.size("_grams") > F.size(F.array_distinct("_grams")))
    ordered = F.when(F.col("_repeats"), F.array_sort(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    found = found.withColumn("_ordered", ordered)
    beside = F.arrays_zip(
        F.col("_ordered").alias("x"),
        F.concat(F.slice("_ordered", 2, F.size("_ordered")), F.array(F.lit(None).cast("struct<g:bigint,i:int>"))).alias("next"),
        F.concat(F.array(F.lit(None).cast("struct<g:bigint,i:int>")), F.col("_ordered")).alias("last"),
    )
    twice = F.filter(beside, lambda z: (z["x"]["g"] == z["next"]["g"]) | (z["x"]["g"] == z["last"]["g"]))
    found = found.withColumn("_at", F.when(F.col("_repeats"), F.sort_array(F.transform(twice, lambda z: z["x"]["i"]))))
    gaps = F.zip_with(F.slice("_at", 2, F.size("_at")), F.slice("_at", 1, F.size("_at") - 1), lambda b, a: F.least(b - a, F.lit(window)))
    covered = F.aggregate(gaps, F.lit(window), lambda s, g: s + g)
    found = found.withColumns(
        {
            "n_repeat_words": F.when(F.col("_repeats"), covered).otherwise(0).cast("long"),
            "n_symbols": F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    return found.drop("_words", "_lines", "_grams", "_repeats", "_ordered", "_at")


def host_key(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("-"))


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, th1, th2, host, pos, k1, k2, n): every line with a word, by its key, and its words; ``host`` is hashed in."""
    rows = docs.select(*row_key(docs, id_col, text_col), host_key(source_col).alias("host"), F.posexplode(words.lines(F.col(text_col))).alias("pos", "line"))
    k1, k2 = words.fingerprint(F.col("host"), words.line_key(F.col("line")))
    return rows.select("id", "th1", "th2", "host", "pos", k1.alias("k1"), k2.alias("k2"), words.word_count(F.col("line")).alias("n")).filter("n > 0")


def frequent_lines(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, th1, th2, pos, n): the lines above their host's limit, with their words.

    A document is an id (null is one too), and counts once for a line of its host
    however often it holds it. The lines are cut, keyed and written once; equal
    (host, line, id) meet first, and what is dealt by (host, line) are sums.
    """
    lines = materialize(keyed_lines(docs, id_col, text_col, source_col), "quality-keys")
    held = lines.groupBy("k1", "k2", "id").agg(F.first("host").alias("host"))
    counts = held.groupBy("k1", "k2").agg(F.first("host").alias("host"), F.count("*").alias("n_docs")).filter(F.col("n_docs") >= limits.line_docs)
    documents = docs.select(host_key(source_col).alias("host"), F.col(id_col).alias("id")).distinct()
    hosts = documents.groupBy("host").agg(F.count("*").alias("host_docs"))
    over = counts.withColumn("hk", F.concat(F.lit("h"), "host")).join(hosts.select(F.concat(F.lit("h"), "host").alias("hk"), "host_docs"), "hk")
    over = over.filter(F.col("n_docs") > F.col("host_docs") * limits.line_share).select(*moved("k1", "k2"))
    return lines.select("*", *moved("k1", "k2")).join(over, ["m0", "m1"]).select("id", "th1", "th2", "pos", "n")


def judged(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", over: DataFrame | None = None) -> DataFrame:
    """(id, th1, th2, the measures, base_failed, kept): a verdict a row of ``docs``.

    ``base_failed``: fewer than ``min_words`` words, or words in repeated windows
    above ``max_repeat_percent`` of all. ``kept``: not that, and not depleted.
    Null and empty texts have no words and fail. A null source is a host of its
    own. Repeated rows get a verdict each; the same one where id and text are equal.
    Lines above the limit count against whole texts, however long, and a text that
    fails by the base rules is counted among its host's documents all the same.
    Columns of ``docs`` but those three are ignored.
    ``over``: the result of ``frequent_lines``, where it is there already.
    """
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = measured(docs.select(F.col(id_col), F.col(text_col)), text_col, limits.window).select(*row_key(docs, id_col, text_col), *measures)
    over = frequent_lines(docs, limits, id_col, text_col, source_col) if over is None else over
    lost = over.distinct().groupBy("id", "th1", "th2").agg(F.sum("n").alias("n_lost"))
    lost = lost.select(join_key("id", "th1", "th2").alias("row_key"), "n_lost")
    both = rows.withColumn("row_key", join_key("id", "th1", "th2")).join(lost, "row_key", "left").drop("row_key")
    left = F.col("n_words") - F.coalesce("n_lost", F.lit(0))
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    depleted = (left < limits.min_words) | (left < F.col("n_words") * limits.min_left)
    return both.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~depleted).drop("n_lost")


def clean(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the lines above their limits removed; columns as in ``docs``.

    The lines above their limits are found once and written, and so are the
    verdicts: a filter on them would be pushed below the measures and make each
    of them many times over. ``drop_lines`` states what column names it keeps for itself.
    """
    over = materialize(frequent_lines(docs, limits, id_col, text_col, source_col), "quality-lines")
    verdicts = materialize(judged(docs, limits, id_col, text_col, source_col, over).select(join_key("id", "th1", "th2").alias("_line_row"), "kept"), "quality-verdicts")
    return drop_lines(docs, over, id_col, text_col, only=verdicts.filter("kept").select("_line_row").distinct()).select(*docs.columns)
