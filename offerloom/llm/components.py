"""Connected components by labels that spread in Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.storage import materialize

#: Edges of a node that one part holds.
HUB = 1024


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component; ``edges`` is (a long, b long).

    Every round a node takes the smallest label among its neighbours and then
    that label's own label, so a path of n nodes takes about log n rounds. A
    round's table is written to the shared folder; the driver sees one count.
    The edges of a node with over ``HUB`` of them are dealt in parts of about so
    many, and its label goes to each part.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "components-edges")
    hubs = materialize(both.groupBy("b").agg(F.ceil(F.count("*") / HUB).cast("int").alias("parts")).filter("parts > 1"), "components-hubs")
    if not hubs.isEmpty():
        part = F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1))).cast("int")
        both = materialize(both.withColumn("hb", F.hex("b")).join(hubs.select(F.hex("b").alias("hb"), "parts"), "hb", "left").select("a", "b", part.alias("part")), "components-parts")
    else:
        both = both.withColumn("part", F.lit(0))
        hubs = None
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "components-labels")
    while True:
        told = labels.select(F.col("node").alias("b"), "label")
        if hubs is None:
            told = told.withColumn("part", F.lit(0))
        else:
            told = told.join(hubs, "b", "left").select("b", "label", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
        near = both.join(told, ["b", "part"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("new"))
        own = labels.select(F.col("node").alias("new"), F.col("label").alias("own"))
        moved = materialize(step.join(own, "new").select("node", F.least("new", "own").alias("label"), (F.col("label") != F.least("new", "own")).alias("moved")), "components-labels")
        labels = moved.select("node", "label")
        if moved.filter("moved").isEmpty():
            return labels


def root_of(parent: dict, x: int) -> int:
    """The class of ``x`` in a task's own table of parents."""
    while parent.setdefault(x, x) != x:
        parent[x] = x = parent[parent[x]]
    return x


def joined(parent: dict, a: int, b: int) -> bool:
    """Puts two classes together; says whether they were apart."""
    a, b = root_of(parent, a), root_of(parent, b)
    parent[b] = a
    return a != b


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, label) after ``edges`` (a, b) more: only the graph of labels that they link is searched."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    known = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    linked = known.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")).filter("a != b").distinct()
    moved = components(linked).select(F.col("node").alias("was"), F.col("label").alias("now"))
    kept = labels.join(moved, labels["label"] == moved["was"], "left").select("node", F.coalesce("now", "label").alias("label"))
    fresh = moved.join(labels.select(F.col("node").alias("was")), "was", "left_anti").select(F.col("was").alias("node"), F.col("now").alias("label"))
    return materialize(kept.unionByName(fresh), "components-merged")
