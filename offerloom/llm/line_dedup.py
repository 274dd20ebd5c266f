"""Line dedup: lines found in many documents stay in one of them only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm import words
from offerloom.llm.line_rules import drop_lines, moved, row_key
from offerloom.llm.storage import materialize


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th1, th2, pos): the lines to drop."""
    lines = docs.select(*row_key(docs, id_col, text_col), F.posexplode(words.lines(F.col(text_col))).alias("pos", "line"))
    stripped = lines.withColumn("line", words.strip(F.col("line"))).filter(F.char_length("line") >= min_chars)
    k1, k2 = words.fingerprint(words.ascii_lower(F.col("line")))
    keyed = materialize(stripped.select("id", "th1", "th2", "pos", k1.alias("k1"), k2.alias("k2")), "line-keys")
    # one row a document and key, then counts that are summed before they are dealt
    held = keyed.groupBy("k1", "k2", "id").agg(F.lit(1).alias("one"))
    common = held.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("id").alias("last_id")).filter(F.col("n_docs") >= min_docs)
    marked = keyed.select("*", *moved("k1", "k2")).join(common.select(*moved("k1", "k2"), "last_id"), ["m0", "m1"])
    return marked.filter(~F.col("id").eqNullSafe(F.col("last_id"))).select("id", "th1", "th2", "pos")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated lines removed, and ``n_lines`` and ``n_dropped`` added.

    A line's key is the line without white space at both ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points found in at least ``min_docs``
    documents lose all their lines but those in the largest id that holds them.
    Null and empty texts are one empty line; a null id is smaller than any other.
    Rows equal in id and text are treated alike; an id with several texts is one
    document (null is one too), and all of its texts keep the lines that the largest
    id keeps. Texts of any length are cut into lines by Spark; a line's key and place
    are all that is counted and dealt, whatever its length. Other columns stay as they are; columns named ``n_lines``
    or ``n_dropped`` are replaced.
    """
    return drop_lines(docs, dropped_lines(docs, min_chars, min_docs, id_col, text_col), id_col, text_col)
