"""Fixed-width binary records as a Spark data source (S1-S3 scan, K10 sink).

``spark.read.format("fixedwidth").option("recordLength", 35).load(path)``
returns one ``raw_bytes`` row per record. The planner cuts every file into
byte ranges aligned to the record length, so a multi-terabyte dump is read by
many tasks in parallel with no driver-side read. Each task turns its range
into Arrow batches with numpy (no per-record Python).

A file whose size is not a multiple of the record length has a ragged tail.
``tail="drop"`` (default) skips the partial record; ``tail="keep"`` emits
it as a short row so the bronze gate can route it to the dead-letter queue;
``tail="fail"`` stops the job.

The writer is the inverse: each task writes the ``raw_bytes`` of its rows
back to back into one part file. Files appear under their final names only
when the job commits, so a lost or retried task leaves nothing behind.
"""

from __future__ import annotations

import posixpath
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Iterator

from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

FORMAT_NAME = "fixedwidth"
DEFAULT_SPLIT_BYTES = 128 * 1024 * 1024   # bytes of a range unless splitBytes is given, like spark.sql.files.maxPartitionBytes
BATCH_RECORDS = 65536
PART_SUFFIX = ".bin"
COMMIT_THREADS = 32                       # renames and deletes in flight at commit


def _fs_and_path(path: str):
    import pyarrow.fs as pafs

    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), posixpath.abspath(path)
    if path.startswith("file:") and not path.startswith("file://"):
        return pafs.LocalFileSystem(), path[len("file:"):]
    return pafs.FileSystem.from_uri(path)


def _list_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the data files under ``path``, a file or a directory. A file whose name, or any folder's
    below ``path``, begins with ``_`` or ``.`` is not data (Spark's own rule: uncommitted output, markers)."""
    import pyarrow.fs as pafs

    fs, root = _fs_and_path(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"input path not found: {path}")
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    out: list[tuple[str, int]] = []
    prefix = path[: len(path) - len(root)] if path.endswith(root) else ""
    for child in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
        below = posixpath.relpath(child.path, root).split("/")
        if child.type == pafs.FileType.File and not any(part.startswith(("_", ".")) for part in below):
            out.append((prefix + child.path, child.size))
    return sorted(out)


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int      # first byte (multiple of the record length)
    end: int        # one past the last full-record byte of this range
    tail: int       # bytes of a partial last record to handle here (0 if none)

    def __init__(self, path: str, start: int, end: int, tail: int):
        super().__init__(None)
        self.path, self.start, self.end, self.tail = path, start, end, tail


class FixedWidthReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path = options.get("path") or options.get("paths")
        if not self.path:
            raise ValueError("fixedwidth: a path is required")
        self.record_length = int(options.get("recordLength", 35))
        if self.record_length <= 0:
            raise ValueError("fixedwidth: recordLength must be positive")
        self.max_split = int(options.get("splitBytes", DEFAULT_SPLIT_BYTES))
        self.min_split = min(self.max_split, int(options.get("minSplitBytes", self.record_length)))
        self.min_partitions = int(options.get("minPartitions", 1))
        self.tail = options.get("tail", "drop").lower()
        if self.tail not in ("drop", "keep", "fail"):
            raise ValueError("fixedwidth: tail must be drop, keep or fail")
        self.with_position = options.get("withPosition", "false").lower() == "true"

    def _split_bytes(self, total: int) -> int:
        """Like Spark's file sources: spread the input over ``minPartitions`` tasks,
        within [minSplitBytes, splitBytes], aligned to whole records."""
        per_task = -(-total // max(1, self.min_partitions))
        split = min(self.max_split, max(self.min_split, per_task))
        return max(self.record_length, split - split % self.record_length)

    def partitions(self):
        parts: list[ByteRange] = []
        files = _list_files(self.path)
        self.split_bytes = self._split_bytes(sum(size for _, size in files))
        for path, size in files:
            full = size - size % self.record_length
            tail = size - full
            if tail and self.tail == "fail":
                raise ValueError(f"fixedwidth: {path} has a partial record of {tail} bytes")
            starts = list(range(0, full, self.split_bytes)) or [0]
            for i, start in enumerate(starts):
                end = min(start + self.split_bytes, full)
                last = i == len(starts) - 1
                keep_tail = tail if (last and self.tail == "keep") else 0
                if end > start or keep_tail:
                    parts.append(ByteRange(path, start, end, keep_tail))
        return parts

    def read(self, partition: ByteRange) -> Iterator:
        if partition is None:  # no input bytes at all: Spark asks for one empty partition
            return
        for pos, values in read_range(partition.path, partition.start, partition.end, partition.tail, self.record_length):
            yield self._batch(values, partition.path, pos)

    def _batch(self, values, path: str, pos: int):
        import numpy as np
        import pyarrow as pa

        count = len(values)
        cols = [values]
        names = ["raw_bytes"]
        if self.with_position:
            first = pos // self.record_length
            cols += [pa.repeat(pa.scalar(path, pa.string()), count), pa.array(np.arange(first, first + count, dtype=np.int64))]
            names += ["source_file", "record_index"]
        return pa.RecordBatch.from_arrays(cols, names=names)


def read_range(path: str, start: int, end: int, tail: int, record_length: int) -> Iterator:
    """(position, Arrow array of records) of a range of whole records, then of the partial record behind it if ``tail``."""
    import pyarrow as pa

    def records(data: bytes, width: int):
        return pa.Array.from_buffers(pa.binary(width), len(data) // width, [None, pa.py_buffer(data)]).cast(pa.binary())

    fs, real = _fs_and_path(path)
    with fs.open_input_file(real) as fh:
        fh.seek(start)
        pos = start
        while pos < end + tail:
            want = min(BATCH_RECORDS * record_length, end - pos) if pos < end else tail
            data = fh.read(want)
            if len(data) != want:
                raise IOError(f"fixedwidth: short read in {path} at {pos}")
            yield pos, records(data, record_length if pos < end else tail)
            pos += want


def range_reader(record_length: int):
    """Task function for ``mapInArrow``: (path, start, end, tail) rows -> the records of those ranges."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                for _, values in read_range(row["path"], row["start"], row["end"], row["tail"], record_length):
                    yield pa.RecordBatch.from_arrays([values], names=["raw_bytes"])

    return run


@dataclass
class PartWritten(WriterCommitMessage):
    temp: str
    final: str
    records: int


def _concat_values(col):
    """The data buffer of a binary Arrow array: all values back to back, no copy per value."""
    import numpy as np
    import pyarrow as pa

    if len(col) == 0:
        return b""
    width = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    offsets = np.frombuffer(col.buffers()[1], dtype=width, count=len(col) + 1,
                            offset=col.offset * np.dtype(width).itemsize)
    return col.buffers()[2][int(offsets[0]):int(offsets[-1])]


class FixedWidthWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("fixedwidth: a path is required")
        self.record_length = int(options["recordLength"]) if options.get("recordLength") else None
        self.overwrite = overwrite
        self.job = options.get("jobId") or uuid.uuid4().hex[:12]

    def write(self, iterator) -> PartWritten:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx else 0
        attempt = ctx.attemptNumber() if ctx else 0
        fs, root = _fs_and_path(self.path)
        fs.create_dir(root, recursive=True)
        final = f"{root}/part-{part:05d}-{self.job}{PART_SUFFIX}"
        temp = f"{root}/_temporary-{self.job}-{part:05d}-{attempt}-{uuid.uuid4().hex[:8]}"
        records = 0
        with fs.open_output_stream(temp) as out:
            for batch in iterator:
                col = batch.column(0)
                if col.null_count:
                    raise ValueError("fixedwidth: NULL record")
                if self.record_length is not None:
                    lengths = pc.binary_length(col)
                    if pc.any(pc.not_equal(lengths, self.record_length)).as_py():
                        raise ValueError(f"fixedwidth: record is not {self.record_length} bytes")
                out.write(_concat_values(col))
                records += len(col)
        return PartWritten(temp, final, records)

    def commit(self, messages) -> None:
        import pyarrow.fs as pafs

        fs, root = _fs_and_path(self.path)
        done = [m for m in messages if m is not None]
        with ThreadPoolExecutor(COMMIT_THREADS) as pool:  # the new parts stand before any old one goes
            list(pool.map(lambda m: fs.move(m.temp, m.final), done))
            stale = [i.path for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
                     if i.type == pafs.FileType.File and self._is_stale(posixpath.basename(i.path))]
            list(pool.map(fs.delete_file, stale))
        with fs.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def _is_stale(self, name: str) -> bool:
        """Temporaries of this job (failed or superseded attempts) and, when overwriting, earlier parts."""
        if name.startswith(f"_temporary-{self.job}-"):
            return True
        return self.overwrite and name.startswith("part-") and not name.endswith(self.job + PART_SUFFIX)

    def abort(self, messages) -> None:
        import pyarrow.fs as pafs

        fs, root = _fs_and_path(self.path)
        for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if posixpath.basename(info.path).startswith(f"_temporary-{self.job}-"):
                fs.delete_file(info.path)


class FixedWidthDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT_NAME

    def schema(self) -> str:
        if self.options.get("withPosition", "false").lower() == "true":
            return "raw_bytes binary, source_file string, record_index long"
        return "raw_bytes binary"

    def reader(self, schema):
        return FixedWidthReader(self.options, schema)

    def writer(self, schema, overwrite: bool):
        return FixedWidthWriter(self.options, overwrite)


def register(spark) -> None:
    """Make ``format("fixedwidth")`` available on this session (idempotent).

    The module is pickled by value, so Python workers (the planner on the
    driver and the readers and writers on executors) need no installed copy
    of this package.
    """
    by_value()
    spark.dataSource.register(FixedWidthDataSource)


def by_value() -> None:
    """Pickle this module's functions and classes by value."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
