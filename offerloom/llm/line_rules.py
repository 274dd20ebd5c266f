"""What the line operators share: keyed lines, counts of documents by key, and removal by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm import words


def row_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """(id, th1, th2): what tells rows apart. Rows equal in id and text are treated alike."""
    h1, h2 = words.fingerprint(F.col(text_col))
    return [F.col(id_col).alias("id"), h1.alias("th1"), h2.alias("th2")]


def join_key(*cols: str) -> Column:
    """One string of several columns, null-safe.

    A join on it doesn't reuse the dealing of an aggregate on the columns
    themselves, so both of its sides are dealt for the join and Spark may split
    the partition of a hot key.
    """
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols))


def moved(*cols: str) -> list[Column]:
    """Long columns ``m0``, ``m1``, ... that are equal where ``cols`` (longs) are, for a join.

    They have the use of ``join_key`` for rows of many: two or three longs a row and no string.
    """
    return [F.col(c).bitwiseXOR(F.lit(0x5DEECE66D)).alias(f"m{i}") for i, c in enumerate(cols)]


def drop_lines(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text", only: DataFrame | None = None) -> DataFrame:
    """``docs`` without the lines at ``dropped`` (id, th1, th2, pos from 0), reassembled by position.

    Adds ``n_lines`` and ``n_dropped`` (long) and replaces the text; a text with
    nothing dropped stays as it is, null included. The runs of lines between two
    dropped positions are sliced out and joined, so a text takes time in
    proportion to its length. ``only`` (_line_row, each once: ``join_key`` of id, th1 and th2)
    leaves out the rows that it doesn't name, in the same join. Columns of ``docs``
    whose names begin with ``_line_`` are the function's own.
    """
    gone = dropped.groupBy("id", "th1", "th2").agg(F.sort_array(F.collect_set("pos")).alias("_line_gone"))
    gone = gone.select(join_key("id", "th1", "th2").alias("_line_row"), "_line_gone")
    if only is not None:
        gone = only.join(gone, "_line_row", "left")
    keyed = docs.withColumns({"_line_row": F.struct(*row_key(docs, id_col, text_col)), "_line_list": words.lines(F.col(text_col))})
    keyed = keyed.withColumn("_line_row", join_key("_line_row.id", "_line_row.th1", "_line_row.th2"))
    both = keyed.join(gone, "_line_row", "left" if only is None else "inner")
    n = F.size("_line_list")
    starts = F.concat(F.array(F.lit(0)), F.transform("_line_gone", lambda p: p + 1))
    ends = F.concat(F.col("_line_gone"), F.array(n))
    runs = F.filter(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda r: r["b"] > r["a"])
    kept = F.flatten(F.transform(runs, lambda r: F.slice("_line_list", r["a"] + 1, r["b"] - r["a"])))
    text = F.when(F.col("_line_gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    out = both.withColumns({text_col: text, "n_lines": n.cast("long"), "n_dropped": F.coalesce(F.size("_line_gone"), F.lit(0)).cast("long")})
    return out.withColumn("n_dropped", F.greatest("n_dropped", F.lit(0))).drop("_line_row", "_line_list", "_line_gone")
