"""What the pipeline leaves behind: snapshots, checkpoints and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.sources import versions
from offerloom.sources.landed import exists


def snapshot(rows: DataFrame, path: str, form: str = "json") -> None:
    rows.write.mode("overwrite").format(form).save(path)


def snapshot_unless_empty(rows: DataFrame, path: str, form: str = "json") -> bool:
    """Replaces the snapshot unless there are no rows; then the one before stays. Says whether it wrote."""
    if rows.isEmpty():
        return False
    snapshot(rows, path, form)
    return True


def checkpoint_append(rows: DataFrame, path: str) -> None:
    """Adds a batch of looked-up rows to a checkpoint table."""
    rows.write.mode("append").parquet(path)


def checkpoint_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def publish(products: DataFrame, path: str, counts: DataFrame) -> None:
    """Products as Parquet, with a one-row summary beside them."""
    products.write.mode("overwrite").parquet(f"{path}/products")
    summary(products, counts).write.mode("overwrite").json(f"{path}/summary")


def script_header(summary_row: DataFrame, title: str, day: str) -> list[str]:
    """Comment lines above published products, from the row of ``summary``."""
    s = summary_row.first()
    return [f"// {title} — {s.n_products} urun, {s.n_sellers} satici", f"// Otomatik uretildi: {day}", f"// Coklu fiyat: {s.n_multi} urunde birden fazla satici"]


def script_lines(products: DataFrame, order: list[str], header: list[str], name: str = "products", parts: int | None = None) -> DataFrame:
    """``value``: the lines of a script that assigns the products, in order, to ``name``, a product a line.

    Lines are dealt by ranges of their order, so the files of a written table make the script if put
    together by name; no task holds it all. A line other than the first product's begins with its comma.
    """
    spark = products.sparkSession
    key = F.struct(*order)
    rows = products.select(F.lit(1).alias("kind"), F.lit(0).alias("line"), key.alias("key"), F.to_json(F.struct(*products.columns)).alias("value"))
    least = rows.agg(F.min("key").alias("least"))
    rows = rows.join(F.broadcast(least)).select("kind", "line", "key", F.when(F.col("key").eqNullSafe(F.col("least")), F.col("value")).otherwise(F.concat(F.lit(","), "value")).alias("value"))
    around = [(0, i, x) for i, x in enumerate([*header, f"const {name} = ["])] + [(2, 0, "];")]
    frame = spark.createDataFrame(around, "kind int, line int, value string").select("kind", "line", F.lit(None).cast(rows.schema["key"].dataType).alias("key"), "value")
    by = ["kind", "line", "key"]
    dealt = rows.union(frame).repartitionByRange(*([parts] if parts else []), *by)
    return dealt.sortWithinPartitions(*by).select("value")


def publish_script(products: DataFrame, path: str, order: list[str], header: list[str] | None = None, name: str = "products", parts: int | None = None) -> None:
    """Replaces the script at ``path``, a table in versions; without a header the one that it had stays. ``order`` tells products apart.

    The products may be read from the script itself (``script_rows``).
    """
    kept = list(versions.version(products.sparkSession, path).header) if header is None else header
    versions.replace(script_lines(products, order, kept, name, parts), path, "text", kept)


def script_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Products of a published script's current version."""
    lines = versions.read(spark, path, "value string")
    return lines.filter(F.col("value").startswith("{") | F.col("value").startswith(",{")).select(F.from_json(F.ltrim("value", F.lit(",")), schema).alias("p")).select("p.*")


def summary(products: DataFrame, counts: DataFrame) -> DataFrame:
    """n_products, n_sellers with offers, n_multi (products with several prices)."""
    sellers = counts.agg(F.count_if(F.col("n") > 0).alias("n_sellers"))
    return products.agg(F.count("*").alias("n_products"), F.count_if(F.size("prices") > 1).alias("n_multi")).crossJoin(F.broadcast(sellers))


def category_report(rows: DataFrame, label: str = "categoryLabel") -> DataFrame:
    return rows.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)


def coverage(rows: DataFrame) -> DataFrame:
    filled = lambda c: F.length(F.coalesce(F.col(c).cast("string"), F.lit(""))) > 0
    return rows.agg(F.count("*").alias("n"), F.count_if(filled("barcode")).alias("n_barcode"), F.count_if(filled("brand")).alias("n_brand"), F.count_if(F.col("price") > 0).alias("n_price"))


def run_summary(results: DataFrame) -> DataFrame:
    """Of (name, status, count): runs by status, their rows, and whether any is ok."""
    return results.groupBy("status").agg(F.count("*").alias("n_runs"), F.sum("count").alias("n_rows")).withColumn("usable", F.col("status") == "ok")
