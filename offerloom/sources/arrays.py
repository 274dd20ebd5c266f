"""Elements of JSON array files of any size, read by byte ranges.

Spark's text reader cuts a file at its closing braces instead of its newlines, and
reads it in splits as it does lines. What a fragment means depends on what is before
it: whether it begins within a string, and how deep. Its own share of that is a number
of quotes and, for either beginning, a difference of depth, and shares add up: those of
a split's fragments are added within the split, those of the splits in order, a row a split,
and then every split knows how it begins and takes out its elements at once. Only an
element that several splits hold is put together from pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerloom.worktables import materialize

SPLIT = ["path", "block", "length"]


def _shares(value: Column) -> dict[str, Column]:
    """odd: whether the fragment has an odd number of quotes; d0, d1: how much deeper it ends, its brace apart, if it begins outside or within a string."""
    parts = F.split(F.regexp_replace(value, "(?s)\\\\.", ""), '"', -1)
    outside = lambda h: F.array_join(F.filter(parts, lambda x, i: i % 2 == h), "")
    without = lambda s, some: F.length(s) - F.length(F.translate(s, some, ""))
    deeper = lambda h: without(outside(h), "{[") - without(outside(h), "]")
    return {"odd": (F.size(parts) - 1) % 2, "d0": deeper(0), "d1": deeper(1)}


def _states(frame: pd.DataFrame, within: int) -> tuple[np.ndarray, np.ndarray]:
    """(whether each fragment ends within a string, its difference of depth with the brace after it), if the first begins ``within`` one."""
    odd = frame["odd"].to_numpy()
    after = (within + np.cumsum(odd)) % 2
    before = np.append(within, after[:-1])
    return after, np.where(before == 0, frame["d0"].to_numpy(), frame["d1"].to_numpy()) - (after == 0)


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The fragments of each split, in batches, in order."""
    for frame in frames:
        keys = list(zip(*(frame[c] for c in SPLIT)))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                yield keys[a], frame.iloc[a:b]


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, body): the objects that the arrays in the files at ``path`` hold, as text, with their place in their file's array.

    Objects within objects belong to their element, elements that aren't objects
    are passed over (they may hold no braces). A file that isn't one whole array gives none: brackets that don't match, text cut off, an
    object. The driver sees nothing; a row a split goes to every task.
    """
    raw = spark.read.option("lineSep", "}").text(path)
    fragments = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_block_length").alias("length"), "value", *(c.alias(n) for n, c in _shares(F.col("value")).items()))

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple | None = None
        for key, frame in _blocks(frames):
            if held is None or held[0] != key:
                if held:
                    yield pd.DataFrame([(*held[0], *held[1])], columns=[*SPLIT, "odd", "t0", "t1"])
                held = (key, [0, 0, 0])
            odd = held[1][0]
            for h in (0, 1):
                held[1][1 + h] += int(_states(frame, (h + odd) % 2)[1].sum())
            held[1][0] = (odd + int(frame["odd"].sum())) % 2
        if held:
            yield pd.DataFrame([(*held[0], *held[1])], columns=[*SPLIT, "odd", "t0", "t1"])

    splits = materialize(fragments.drop("value").mapInPandas(sums, "path string, block long, length long, odd int, t0 long, t1 long"), "array-splits")
    upto = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.withColumn("within", (F.coalesce(F.sum("odd").over(upto), F.lit(0)) % 2).cast("int")).withColumn("total", F.when(F.col("within") == 0, F.col("t0")).otherwise(F.col("t1")))
    begun = begun.withColumn("depth", F.coalesce(F.sum("total").over(upto), F.lit(0)))
    # the last fragment has no brace after it but is counted with one: an array ends a step below where it begins
    files = begun.groupBy("path").agg(((F.sum("total") == -1) & (F.sum("odd") % 2 == 0)).alias("good"))
    begun = materialize(begun.join(files, "path").select(*SPLIT, "within", "depth", "good"), "array-begun")

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "block", "n", "ended", "whole", "body"]
        at, within, depth, n, whole, text = None, 0, 0, 0, False, []
        out, held = [], 0
        for key, frame in _blocks(frames):
            if pd.isna(frame["depth"].iat[0]):
                raise RuntimeError("the files' splits are others than they were: run it again")
            if not frame["good"].iat[0]:
                continue
            if key != at:
                if text and (depth > 1 or within):  # an element goes on in the next split
                    out.append((*at[:2], n, False, False, "".join(text)))
                at, within, depth, n, text = key, int(frame["within"].iat[0]), int(frame["depth"].iat[0]), 0, []
                whole = depth <= 1 and not within
            after, delta = _states(frame, within)
            depths = depth + np.cumsum(delta)
            for value, end in zip(frame["value"], ((depths == 1) & (after == 0)).tolist()):
                text.append(value + "}")
                if end:
                    out.append((*at[:2], n, True, whole, "".join(text)))
                    held += len(out[-1][-1])
                    n, text, whole = n + 1, [], True
            within, depth = int(after[-1]), int(depths[-1])
            if held > 1 << 20:
                yield pd.DataFrame(out, columns=names)
                out, held = [], 0
        if text and (depth > 1 or within):
            out.append((*at[:2], n, False, False, "".join(text)))
        yield pd.DataFrame(out, columns=names)

    known = fragments.join(F.broadcast(begun), SPLIT, "left")
    found = materialize(known.mapInPandas(pieces, "path string, block long, n long, ended boolean, whole boolean, body string"), "array-pieces")
    ends = found.filter("ended").groupBy("path", "block").agg(F.count("*").alias("ends"))
    before = begun.join(ends, ["path", "block"], "left").select("path", "block", F.coalesce(F.sum("ends").over(upto), F.lit(0)).alias("before"))
    placed = found.join(F.broadcast(before), ["path", "block"]).select("path", "block", (F.col("before") + F.col("n")).alias("pos"), "ended", "whole", "body")
    parts = placed.filter("NOT whole").groupBy("path", "pos").agg(F.array_sort(F.collect_list(F.struct("block", "body"))).alias("p"), F.max("ended").alias("ended")).filter("ended")
    every = placed.filter("whole").select("path", "pos", "body").union(parts.select("path", "pos", F.array_join("p.body", "")))
    return every.select("path", "pos", F.regexp_replace("body", "^[^{]*", "").alias("body"))
