"""Table-shaped sources (S1 entry point, S2, S4-S8, S10)."""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..layout import LEDGER_LAYOUT
from .fixed_width import DEFAULT_SPLIT_BYTES, FORMAT_NAME, by_value, range_reader, register


#: Files up to this size are read as one row each where a folder holds ragged files; larger ones are read by ranges.
WHOLE_FILE_BYTES = 64 * 1024 * 1024


def scan_fixed(spark: SparkSession, path: str, record_length: int = LEDGER_LAYOUT.record_length,
               tail: str = "drop", split_bytes: int | None = None, with_position: bool = False,
               whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Fixed-length records from one file or a directory, split across tasks.

    Files of whole records go through Hadoop's fixed-length input format: the JVM reads them, on any file system
    that the session knows, with its settings. Where some files end in a partial record, told by the lengths alone, the
    listing itself is the manifest and the tails are dropped, kept or fail: files of up to ``whole_file_bytes`` are one
    JVM scan, however many there are, and larger ones are cut into ranges, rows of (file, range, tail) that tasks read.
    No list of paths comes to the driver's Python. ``with_position`` reads all files with the ``fixedwidth`` source,
    and so do paths with a character that the input format takes for a pattern.
    """
    if tail not in ("drop", "keep", "fail"):
        raise ValueError("tail must be drop, keep or fail")
    path = qualified(spark, path)
    if with_position or _PATTERN.search(path):
        return _scan_python(spark, path, record_length, tail, split_bytes, with_position)
    files = input_files(spark, path)
    ragged, size = F.col("length") % record_length != 0, F.col("length")
    split = max(1, (split_bytes or DEFAULT_SPLIT_BYTES) // record_length) * record_length
    large = files.where(size > whole_file_bytes)
    seen = files.agg(F.count_if(ragged).alias("ragged"), F.count_if(size <= whole_file_bytes).alias("small"),
                     F.sum(F.when(size > whole_file_bytes, F.ceil(size / split))).alias("ranges")).first()
    if not seen["ragged"]:
        return _scan_jvm(spark, path, record_length, split_bytes)
    if tail == "fail":
        raise ValueError(f"{seen['ragged']} files below {path} end in a partial record")
    parts = []
    if seen["small"]:
        parts.append(_records(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                              .where(size <= whole_file_bytes), record_length, tail))
    if seen["ranges"]:
        parts.append(scan_ranges(byte_ranges(large, record_length, split, tail).repartition(min(seen["ranges"], MAX_TASKS)),
                                 record_length))
    return reduce(DataFrame.union, parts)


#: Tasks of one scan by ranges; beyond, a task reads several ranges.
MAX_TASKS = 100_000


def byte_ranges(files: DataFrame, record_length: int, split_bytes: int, tail: str = "drop") -> DataFrame:
    """The manifest: (path, start, end, tail) rows that cover the records of ``files`` (path, length).

    ``tail`` is the length of the partial record that follows the range, 0 unless it is the file's last range and kept.
    """
    whole = F.col("length") - F.col("length") % record_length
    partial = (F.col("length") - whole) if tail == "keep" else F.lit(0).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(whole - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    ranges = files.select("path", whole.alias("whole"), partial.alias("partial"), F.explode(starts).alias("start"))
    end = F.least(F.col("start") + split_bytes, F.col("whole"))
    return ranges.select("path", "start", end.alias("end"),
                         F.when(end == F.col("whole"), F.col("partial")).otherwise(F.lit(0)).cast("long").alias("tail")
                         ).where("end > start or tail > 0")


def scan_ranges(ranges: DataFrame, record_length: int = LEDGER_LAYOUT.record_length) -> DataFrame:
    """Records of the byte ranges of a manifest (path, start, end, tail), as Arrow batches; a lost task reads its ranges again."""
    by_value()
    return ranges.select("path", "start", "end", "tail").mapInArrow(range_reader(record_length), "raw_bytes binary")


#: Characters that Hadoop's input formats read as patterns or separators.
_PATTERN = re.compile(r"[,{}\[\]*?\\]")


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the data files below ``path``; nothing of their content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "length"))


def _scan_jvm(spark: SparkSession, path: str, record_length: int, split_bytes: int | None) -> DataFrame:
    jvm, context = spark._jvm, spark.sparkContext._jsc.sc()
    conf = jvm.org.apache.hadoop.conf.Configuration(context.hadoopConfiguration())
    conf.set("mapreduce.input.fileinputformat.input.dir.recursive", "true")
    conf.set("mapreduce.input.fileinputformat.split.maxsize", str(split_bytes or DEFAULT_SPLIT_BYTES))
    records = context.binaryRecords(path, record_length, conf)
    frame = spark._jsparkSession.createDataset(records, jvm.org.apache.spark.sql.Encoders.BINARY()).toDF()
    return DataFrame(frame, spark).toDF("raw_bytes")


def _scan_python(spark: SparkSession, path: str, record_length: int, tail: str, split_bytes: int | None,
                 with_position: bool) -> DataFrame:
    register(spark)
    reader = (spark.read.format(FORMAT_NAME).option("recordLength", record_length).option("tail", tail)
              .option("withPosition", str(with_position).lower()))
    if split_bytes:
        reader = reader.option("splitBytes", split_bytes)
    return reader.load(path)


def scan_small_files(spark: SparkSession, path: str, record_length: int = LEDGER_LAYOUT.record_length,
                     tail: str = "drop") -> DataFrame:
    """Many small files, all on the JVM: ``binaryFile`` reads each file as one row
    and ``explode`` cuts it into records. Each file must fit in one row (< 2 GB);
    use ``scan_fixed`` for large dumps.
    """
    return _records(spark.read.format("binaryFile").load(path), record_length, tail)


def _records(files: DataFrame, record_length: int, tail: str) -> DataFrame:
    """The records of files that are one row each (content, length)."""
    n = F.lit(record_length)
    count = F.floor(F.col("length") / n).cast("int")
    has_tail = (F.col("length") % n) != 0
    if tail == "keep":
        count = count + F.when(has_tail, 1).otherwise(0)
    elif tail == "fail":
        count = F.when(~has_tail, count).otherwise(F.raise_error(F.lit("binaryFile input has a partial record")))
    idx = F.explode(F.sequence(F.lit(0), count - 1))
    return (files.filter(count > 0).select("content", idx.alias("i"))
                 .select(F.substring("content", F.col("i") * n + 1, n).alias("raw_bytes")))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S4."""
    return spark.read.format(fmt).load(path)


BRONZE_DLQ_SCHEMA = T.StructType([
    T.StructField("tx_id", T.StringType()), T.StructField("cust_id", T.StringType()),
    T.StructField("raw_balance", T.StringType()), T.StructField("tx_status", T.StringType()),
    T.StructField("unpacked_balance", T.DoubleType()), T.StructField("rejection_reason", T.StringType()),
])


def read_dlq(spark: SparkSession, path: str, schema: T.StructType = BRONZE_DLQ_SCHEMA) -> DataFrame:
    """A JSON dead-letter queue with an explicit schema; base64 binary is decoded back."""
    df = spark.read.schema(schema).json(path)
    for f in schema.fields:
        if f.name == "raw_balance":
            df = df.withColumn("raw_balance", F.unbase64("raw_balance"))
    return df


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Previously published output, or an empty frame of the same schema."""
    if path_exists(spark, path):
        return spark.read.schema(schema).format(fmt).load(path)
    return spark.createDataFrame([], schema)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's, with the session's settings."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme; without one it belongs to the session's default file system (``fs.defaultFS``)."""
    fs, hpath = hadoop_path(spark, path)
    return fs.makeQualified(hpath).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = hadoop_path(spark, path)
    return bool(fs.exists(hpath))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made."""
    fs, hpath = hadoop_path(spark, path)
    fs.delete(hpath, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, on any file system that the session knows."""
    fs, hpath = hadoop_path(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, replacing an earlier one."""
    fs, hpath = hadoop_path(spark, path)
    stream = fs.create(hpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def bucketed_name(path: str) -> str:
    """Catalog name of the bucketed table at a qualified path."""
    return "ledgerflow_" + hashlib.md5(path.encode()).hexdigest()[:20]


def bucket_spec_path(path: str) -> str:
    return posixpath.join(path, "_buckets.json")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """K9: a table that ``sinks.tables.write_bucketed`` wrote, in this session or another, with its buckets known."""
    path = qualified(spark, path)
    name = bucketed_name(path)
    spec = json.loads(read_text(spark, bucket_spec_path(path)))
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(spec["schema"]))
        key = spec["key"]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                  f"INTO {int(spec['buckets'])} BUCKETS LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def require_path(spark: SparkSession, path: str) -> str:
    """Fail early on a missing input, listing what the parent folder holds."""
    fs, hpath = hadoop_path(spark, path)
    if fs.exists(hpath):
        return path
    parent = hpath.getParent()
    siblings = []
    if parent is not None and fs.exists(parent):
        siblings = sorted(str(s.getPath().getName()) for s in fs.listStatus(parent))
    raise FileNotFoundError(f"Input '{path}' not found. Available: {siblings}")
