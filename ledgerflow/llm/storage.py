"""Intermediate tables in the shared folder that the session names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.session import scratch_path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: work that an executor loses later starts from these files, not from the input.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme; without one it belongs to the session's default file system (``fs.defaultFS``)."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hpath).toString()
