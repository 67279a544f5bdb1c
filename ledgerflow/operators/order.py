"""Total order of a written table (L1): where each part begins and ends, checked by the rows' positions in the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def with_position(table: DataFrame) -> DataFrame:
    """``table`` (read from Parquet files) with ``position``, each row's place when the files are read by name.

    Only the row counts of the files meet in one task, one row a file."""
    rows = table.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (rows.join(F.broadcast(files.select("_file", before.alias("_before"))), "_file")
                .withColumn("position", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before"))


def parts_by_position(table: DataFrame, key: str, rows_per_part: int) -> DataFrame:
    """(part, first_id, last_id, rows): runs of ``rows_per_part`` rows in file order, with the keys that stand at their ends."""
    placed = with_position(table.select(key))
    part = F.floor(F.col("position") / rows_per_part).cast("long")
    return placed.groupBy(part.alias("part")).agg(
        F.min_by(key, "position").alias("first_id"), F.max_by(key, "position").alias("last_id"), F.count(F.lit(1)).alias("rows"))


def order_manifest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(part, first_id, last_id, rows, sorted) of each file of a table that ``sinks.tables.write_ordered`` wrote.

    ``sorted``: the file's rows are in ascending order, told by comparing each row with the one before it in the file,
    and begin no lower than the part before it ends. A whole order is one where every part is sorted."""
    rows = spark.read.parquet(path).select(F.col(key).alias("id"), F.col("_metadata.file_name").alias("part"),
                                           F.col("_metadata.row_index").alias("row"))
    before = F.lag("id").over(Window.partitionBy("part").orderBy("row"))
    files = rows.withColumn("before", before).groupBy("part").agg(
        F.min_by("id", "row").alias("first_id"), F.max_by("id", "row").alias("last_id"), F.count(F.lit(1)).alias("rows"),
        F.bool_and(F.col("before").isNull() | (F.col("before") <= F.col("id"))).alias("within"))
    earlier = F.lag("last_id").over(Window.orderBy("part"))  # one row a file
    return files.withColumn("earlier", earlier).select(
        "part", "first_id", "last_id", "rows",
        (F.col("within") & (F.col("earlier").isNull() | (F.col("earlier") <= F.col("first_id")))).alias("sorted"))
