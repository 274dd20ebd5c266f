"""Work tables, and how much of a table a Python worker gets at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

from offerloom.worktables import materialize, release, shared_dir, work_path

__all__ = ["bounded_batches", "materialize", "release", "shared_dir", "work_path"]


def bounded_batches(spark: SparkSession, most: str = "4m") -> None:
    """Rows go to Python workers in batches of this size, not of 64 MB: long texts fill no worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)
