"""Work tables in the folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one is set only where none is named (local tests)."""
    named = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF, None)
    if not named:
        named = tempfile.mkdtemp(prefix="offerloom-")
        spark.conf.set(_CONF, named)
    return named.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/offerloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it again.

    The lineage ends at files that outlive any executor, and whatever reads the
    result repeatedly doesn't compute it again.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes work tables of ``materialize`` that nothing reads any more; other frames are left alone."""
    for table in tables:
        path = getattr(table, "_work_path", None)
        if path:
            context = table.sparkSession.sparkContext
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
