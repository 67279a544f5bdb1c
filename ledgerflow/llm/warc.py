"""WARC archives as seekable Zstandard bundles.

One record per page. Of pages with equal payloads of LEAST_PAYLOAD bytes or
more, the one with the smallest id is a response and the others are revisits
that refer to it and carry no payload. A task groups its records into frames
of about FRAME_BYTES and its frames into bundle files of about BUNDLE_BYTES;
each bundle ends in a seek table. The index maps every record id to bundle,
frame and offset in the frame, so one record is read by decompressing one
frame.

Bundles get a name of their own per attempt, and the index names the bundles
of attempts that ended well: files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerflow.llm import seekable
from ledgerflow.llm.storage import materialise, qualified
from ledgerflow.session import scratch_path

LEAST_PAYLOAD = 100
#: Uncompressed bytes of a frame and of a bundle, about: a record is never split.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 64 << 20

# Fixed values of the archive format.
VERSION, END = b"WARC/1.1\r\n", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: The tables hold no crawl time.
DATE = "1970-01-01T00:00:00Z"

_INDEX = ("page_id long, record_id string, record_type string, bundle string, bundle_bytes long, "
          "frame int, offset long, length long")
_RECORDS = "record_id string, page_id long, url string, payload string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, copy, url, payload, payload_digest, record_type, refers_to, refers_to_copy) of each page.

    ``copy`` numbers the rows as they are read, so that each has a record id of its own, whatever its page id is.
    A null payload is empty. Rows that repeat the smallest id are all responses. A null id is never the smallest;
    pages without id revisit the response, and are responses themselves if no copy has an id. Only digests that
    occur twice or more enter the join, which the session's adaptive skew handling splits for a hot payload.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.monotonically_increasing_id().alias("copy"),
                        F.col(url_col).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "copy"))
    firsts = (rows.where(F.octet_length("payload") >= LEAST_PAYLOAD)
              .groupBy("payload_digest").agg(first.alias("first"), F.count("*").alias("copies"))
              .where("copies > 1").select("payload_digest", F.col("first.page_id").alias("first"), F.col("first.copy").alias("first_copy")))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, "payload_digest", "left").select(
        "page_id", "copy", "url", "payload", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"), F.when(revisit, F.col("first_copy")).alias("refers_to_copy"))


def record_name(page_id: int | None, copy: int) -> str:
    """The record id of a page's row; ``copy`` tells rows of one page id, or without any, apart."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{copy}')}>"


def _line(text: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in text)


def format_record(page_id: int | None, copy: int, url: str | None, payload: str, digest: str, kind: str,
                  refers_to: int | None, refers_to_copy: int | None) -> bytes:
    raw = payload.encode()
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_name(page_id, copy)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_line(url) if url else 'about:blank'}", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {len(raw)}", "Content-Type: application/http;msgtype=response"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers_to, refers_to_copy)}", f"X-Refers-To-Page: {refers_to}"]
    block = HTTP if kind == "revisit" else HTTP + raw
    head.append(f"Content-Length: {len(block)}")
    return VERSION + "\r\n".join(head).encode() + END + block + END


def parse_record(data: bytes, at: int) -> tuple[dict[str, object], int]:
    """The record that begins at ``at`` and where the next one begins. A response's digest is taken anew."""
    if data[at:at + len(VERSION)] != VERSION:
        raise ValueError(f"no record begins at offset {at}")
    end = data.index(END, at)
    head = dict(line.split(": ", 1) for line in data[at + len(VERSION):end].decode().split("\r\n"))
    start, size = end + len(END), int(head["Content-Length"])
    raw = data[data.index(END, start) + len(END):start + size]
    said = head["WARC-Payload-Digest"].removeprefix("sha256:")
    if head["WARC-Type"] == "response":
        digest, length = hashlib.sha256(raw).hexdigest(), len(raw)
        if digest != said:
            raise ValueError(f"{head['WARC-Record-ID']}: the payload's digest is {digest}, not {said}")
    else:
        digest, length = said, int(head["X-Payload-Length"])
    page, refers = head.get("X-Page-Id"), head.get("X-Refers-To-Page")
    return {"record_id": head["WARC-Record-ID"], "page_id": None if page is None else int(page), "url": head["WARC-Target-URI"],
            "payload": raw.decode() if head["WARC-Type"] == "response" else None, "payload_bytes": length,
            "payload_digest": digest, "record_type": head["WARC-Type"],
            "refers_to": None if refers is None else int(refers)}, start + size + len(END)


def open_store(uri: str):
    """(file system, path) of a folder or file that every executor can reach, given with its scheme."""
    from pyarrow import fs

    if ":/" not in uri:
        raise ValueError(f"a path of a store names its scheme: {uri}")
    if uri.startswith("file:") and not uri.startswith("file://"):
        return fs.LocalFileSystem(), uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the planned records as bundles below ``folder`` and return the index, one row per record.

    The index is a written table: what it names is complete. Memory is bounded by a frame and a record. A folder without
    a scheme belongs to the session's default file system. Every row has a record, repeated rows and those without page
    id too, under a record id of its own; no columns but the planned ones are read.
    """
    folder = qualified(records.sparkSession, folder)
    schema = [f.split(" ")[0] for f in _INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        bundle, rows, frame = None, [], []

        def close_frame():
            data = b"".join(x for _, x in frame)
            number, at = bundle["writer"].add_frame(data), 0
            for (page_id, name, kind), x in frame:
                rows.append([page_id, name, kind, bundle["path"], 0, number, at, len(x)])
                at += len(x)
            bundle["bytes"] += at
            frame.clear()

        def close_bundle():
            if frame:
                close_frame()
            bundle["writer"].finish()
            size = bundle["file"].tell()
            bundle["file"].close()
            for row in rows:
                row[4] = size
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.string(),
                                                            pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=schema)
            rows.clear()
            return out

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, copy, url, payload, digest, kind, refers, refers_copy = (c[i].as_py() for c in batch.columns)
                if bundle is None:
                    name = f"{root}/bundle-{uuid.uuid4().hex}.warc.zst"
                    file = store.open_output_stream(name, compression=None)
                    bundle = {"file": file, "writer": seekable.Writer(file), "bytes": 0, "open": 0,
                              "path": f"{folder}/{name.rsplit('/', 1)[1]}"}
                frame.append(((page_id, record_name(page_id, copy), kind),
                              format_record(page_id, copy, url, payload, digest, kind, refers, refers_copy)))
                bundle["open"] += len(frame[-1][1])
                if bundle["open"] >= FRAME_BYTES:
                    close_frame()
                    bundle["open"] = 0
                if bundle["bytes"] >= BUNDLE_BYTES:
                    yield close_bundle()
                    bundle = None
        if bundle is not None:
            yield close_bundle()

    ordered = records.select("page_id", "copy", "url", "payload", "payload_digest", "record_type", "refers_to", "refers_to_copy")
    return materialise(ordered.mapInArrow(run, _INDEX), "warc-index")


def read_archives(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the bundles that the index names, read from the files alone; one bundle per row of work.

    Rows stay as many as were written: repeated pages and pages without id come back once a record. An empty index has
    no records."""
    names = [f.split(" ")[0] for f in _RECORDS.split(", ")]
    wanted = [n for n in names if with_payload or n != "payload"]
    schema = ", ".join(f for f in _RECORDS.split(", ") if f.split(" ")[0] in wanted)

    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, size in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = open_store(bundle)
                with store.open_input_file(path) as file:
                    reader = seekable.Reader(file, size)
                    for number in range(len(reader)):
                        data, at, rows = reader.frame(number), 0, []
                        while at < len(data):
                            record, at = parse_record(data, at)
                            rows.append({n: record[n] for n in wanted})
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    bundles = index.groupBy("bundle").agg(F.max("bundle_bytes").alias("bundle_bytes"))
    tasks = max(1, bundles.count())
    return bundles.repartition(tasks).mapInArrow(run, schema)


def fetch(index: DataFrame, ids: list[int] | None = None, record_ids: list[str] | None = None) -> list[dict[str, object]]:
    """The records of a few page ids, or those of a few record ids (one each), by decompressing their own frames only."""
    wanted = F.col("page_id").isin(list(ids)) if ids is not None else F.col("record_id").isin(list(record_ids or []))
    out = []
    for row in index.where(wanted).select("bundle", "bundle_bytes", "frame", "offset").collect():
        store, path = open_store(row["bundle"])
        with store.open_input_file(path) as file:
            data = seekable.Reader(file, row["bundle_bytes"]).frame(row["frame"])
        out.append(parse_record(data, row["offset"])[0])
    return out


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive every page below ``folder`` (a new one in the shared folder if None) and read all records back."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(plan_records(pages), folder), with_payload=False).drop("url", "record_id")


def round_trip_sql(table: str = "pages") -> str:
    """DuckDB SQL for :func:`round_trip`."""
    return f"""
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload FROM {table}),
digests AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM rows),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM digests WHERE payload_bytes >= {LEAST_PAYLOAD} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM digests LEFT JOIN firsts USING (payload_digest)"""
