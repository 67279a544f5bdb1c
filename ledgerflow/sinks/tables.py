"""Sinks (K1-K9). No sink moves data through the driver, and each write tells how many rows it wrote: the count is
observed by the write itself, so nothing is read back or computed twice to learn it."""

from __future__ import annotations

import json
import posixpath
import uuid

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from ..contracts import conform
from ..sources.fixed_width import FORMAT_NAME, register
from ..sources.tables import bucket_spec_path, bucketed_name, hadoop_path, qualified, remove, write_text


#: Codec of the Parquet layers: hexadecimal hashes, most of what they hold, shrink to half with it and not at all with LZ codecs.
PARQUET_CODEC = "zstd"


def counted(df: DataFrame, **counts) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its rows (``rows``) and of further aggregates; read it when a write has ended.

    It stands last in the plan, in the stage that writes, where a task that is run again counts once."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()]), seen


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> int:
    """K1. Returns the rows written."""
    df, seen = counted(df)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "parquet":
        writer = writer.option("compression", PARQUET_CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return seen.get["rows"]


def write_dlq(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """K2/K3/K4: JSON dead-letter queue. Written on every run, even when empty, so a clean
    run never leaves the previous run's rejects in place. Returns the rows written."""
    return write_table(df, path, "json", mode)


def write_conforming(df: DataFrame, contract, path: str, dlq_path: str, fmt: str = "parquet",
                     prefix: str = "CONTRACT_VIOLATION") -> tuple[int, int]:
    """Write the rows that keep the contract with its schema, and the others to a dead-letter queue.
    Returns both counts."""
    valid, rejects = conform(df, contract, prefix)
    return write_table(valid, path, fmt), write_dlq(rejects, dlq_path)


def _columns_of(df: DataFrame, columns: dict[str, Column] | None) -> dict[str, Column]:
    return columns if columns is not None else {c: F.col(f"`{c}`") for c in df.columns}


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None,
                   columns: dict[str, Column] | None = None) -> int:
    """K9: a Parquet table of hash buckets by ``key`` at ``path``, registered in the session's catalog.

    Rows are shuffled once, here, one file a bucket; joins and groupings on ``key`` then need no exchange. ``buckets``
    is the session's number of shuffle partitions by default, and is kept beside the files for later sessions.
    ``columns`` are those of the table, computed from ``df`` behind the shuffle, which carries the columns of ``df``
    alone: short natural keys in place of their hashes. Returns the rows written.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = qualified(spark, path)
    columns = _columns_of(df, columns)
    df, seen = counted(df.repartition(buckets, columns[key]).select(*[c.alias(n) for n, c in columns.items()]))
    (df.write.format("parquet").mode("overwrite").option("compression", PARQUET_CODEC).bucketBy(buckets, key).sortBy(key).option("path", path)
       .saveAsTable(bucketed_name(path)))
    write_text(spark, bucket_spec_path(path), json.dumps({"key": key, "buckets": buckets, "schema": df.schema.jsonValue()}))
    return seen.get["rows"]


def write_ordered(df: DataFrame, path: str, key: str, fmt: str = "parquet", columns: dict[str, Column] | None = None) -> int:
    """L1: parts by ranges of ``key``, sorted, with a Bloom filter of it: a lookup reads the row groups that may hold
    the key, and the parts in order are the whole table in order. ``columns`` are as in :func:`write_bucketed`.
    Returns the rows written."""
    columns = _columns_of(df, columns)
    ranged = df.repartitionByRange(columns[key]).select(*[c.alias(n) for n, c in columns.items()])
    ordered, seen = counted(ranged.sortWithinPartitions(key))
    writer: DataFrameWriter = ordered.write.format(fmt).mode("overwrite")
    if fmt == "parquet":
        writer = (writer.option("compression", PARQUET_CODEC).option(f"parquet.bloom.filter.enabled#{key}", "true")
                  .option("parquet.bloom.filter.adaptive.enabled", "true"))
    writer.save(path)
    return seen.get["rows"]


def publish(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """K5/K6: publish a product as Parquet (nested columns kept); an empty frame is a no-op. Returns the rows published.

    The rows are written once, into a folder below ``path`` that readers pass over. If there are any, its files move
    into place, new ones before old ones go; else the folder is dropped.
    """
    spark = df.sparkSession
    pending = posixpath.join(path, f"_pending-{uuid.uuid4().hex[:12]}")
    rows = write_table(df, pending)
    if rows == 0:
        drop_pending(spark, pending)
        return 0
    old = data_files(spark, path) if mode == "overwrite" else []
    adopt(spark, pending, path)
    for file in old:
        remove(spark, file)
    return rows


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files directly in ``path`` that readers see."""
    fs, hpath = hadoop_path(spark, path)
    found = fs.listStatus(hpath) if fs.exists(hpath) else []
    return [s.getPath().toString() for s in found if s.isFile() and not s.getPath().getName().startswith(("_", "."))]


def adopt(spark: SparkSession, source: str, path: str) -> None:
    """Move the data files of ``source`` into ``path`` and drop ``source``. Spark's part names hold the write's own id,
    so they clash with none; one rename a file, as when a write's own commit puts its files in place."""
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target)
    for file in data_files(spark, source):
        _, from_path = hadoop_path(spark, file)
        to_path = hadoop_path(spark, posixpath.join(path, from_path.getName()))[1]
        if not fs.rename(from_path, to_path):
            raise OSError(f"cannot move {file} to {path}")
    remove(spark, source)


def drop_pending(spark: SparkSession, pending: str) -> None:
    """Remove a folder of an unpublished write, and its parent if that was made for it."""
    remove(spark, pending)
    fs, parent = hadoop_path(spark, posixpath.dirname(pending))
    if len(fs.listStatus(parent)) == 0:
        fs.delete(parent, False)


def dump_json(df: DataFrame, path: str) -> None:
    """K7: JSON lines; timestamps are written as ISO strings."""
    df.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(path)


def write_fixed(df: DataFrame, path: str, record_length: int | None = 35, mode: str = "overwrite") -> None:
    """Each task writes its records back to back into one part file."""
    register(df.sparkSession)
    writer = df.select("raw_bytes").write.format(FORMAT_NAME).mode(mode)
    if record_length:
        writer = writer.option("recordLength", record_length)
    writer.save(qualified(df.sparkSession, path))


def preview(df: DataFrame, n: int = 5) -> None:
    """K11/L4."""
    df.printSchema()
    df.show(n, truncate=False)
