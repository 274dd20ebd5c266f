"""Connected components in Spark jobs, and ranks that no task counts alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.worktables import materialize, release


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (a long, b long) reaches.

    A round gives every node the smallest label among its neighbours' and then that
    label's own label, so a path of n nodes takes about log n rounds; the driver sees one flag a round.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "graph-edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "graph-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("own"))
        after = materialize(step.join(jump, "new").select("node", F.least("new", "own").alias("label"), (F.col("label") != F.least("new", "own")).alias("moved")), "graph-labels")
        release(labels)
        done, labels = after.filter("moved").isEmpty(), after.drop("moved")
        if done:
            release(both)
            return labels
        labels._work_path = after._work_path


def ranked(rows: DataFrame, key: str, order: str, out: str = "rank") -> DataFrame:
    """``rows`` with ``out`` (long): each row's place from 1 within ``key`` by ``order``, which tells a key's rows apart.

    Rows are dealt by range, so a hot key lies in several parts; each part is
    numbered by itself and what is before it added. Only keys that lie in several
    parts need that, and these are fewer than there are parts: a broadcast of known size.
    """
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = materialize(rows.repartitionByRange(n, key, order).withColumn("_part", F.spark_partition_id()), "ranked")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(key, "_part").agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(before)).filter("_before > 0").drop("_n")
    place = F.row_number().over(Window.partitionBy(key, "_part").orderBy(order))
    return dealt.withColumn("_place", place).join(F.broadcast(counts), [key, "_part"], "left").withColumn(out, F.col("_place") + F.coalesce("_before", F.lit(0))).drop("_part", "_place", "_before")
