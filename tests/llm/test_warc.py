import glob
import hashlib
import io

import pytest
import zstandard

from ledgerflow.llm import seekable, warc

LONG = "<p>" + "é" * 100 + "</p>"
ROWS = [(5, "http://a", LONG), (2, "http://b\r\nX: y", LONG), (9, None, LONG), (1, "u", "short"), (3, "u", "short"),
        (4, "u", None), (6, "u", ""), (None, "u", LONG), (2, "again", LONG), (None, "u", "z" * 500), (None, "v", "z" * 500),
        (7, "u", "WARC/1.1\r\n\r\n" * 20), (8, "u", "big" * 400_000)]


def brute(rows):
    firsts = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= warc.LEAST_PAYLOAD and i is not None:
            firsts[raw] = min(firsts.get(raw, i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        first = firsts.get(raw)
        revisit = first is not None and first != i
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, record_type string")


def test_round_trip(pages, tmp):
    got = warc.round_trip(pages, f"file://{tmp}/w").collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == brute(ROWS)


def test_one_record_by_its_offset(pages, tmp, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 300)
    index = warc.write_archives(warc.plan_records(pages).repartition(1), f"{tmp}/w")
    found = warc.fetch(index, [1, 5, 8])
    by = {r["page_id"]: r for r in found}
    assert by[1]["payload"] == "short" and by[5]["refers_to"] == 2 and by[8]["payload"] == "big" * 400_000
    assert len({r["bundle"] for r in index.collect()}) == 1 and max(r["frame"] for r in index.collect()) >= 1


def test_files_of_lost_attempts_are_not_read(pages, tmp):
    index = warc.write_archives(warc.plan_records(pages), f"{tmp}/w")
    with open(f"{tmp}/w/bundle-lost.warc.zst", "wb") as f:
        f.write(b"half a file")
    assert warc.read_archives(index).count() == len(ROWS)


def test_bundles_are_plain_zstandard(pages, tmp):
    warc.write_archives(warc.plan_records(pages), f"{tmp}/w")
    for name in glob.glob(f"{tmp}/w/*.zst"):
        with open(name, "rb") as f:
            assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read().startswith(b"WARC/1.1")


def test_seek_table():
    file = io.BytesIO()
    writer = seekable.Writer(file)
    parts = [b"a" * 1000, b"", b"xyz"]
    for part in parts:
        writer.add_frame(part)
    writer.finish()
    reader = seekable.Reader(file, len(file.getvalue()))
    assert [reader.frame(i) for i in (2, 0)] == [b"xyz", b"a" * 1000] and len(reader) == 3
    with pytest.raises(ValueError):
        seekable.Reader(io.BytesIO(b"0" * 50), 50)


def test_damage_is_found():
    record = warc.format_record(1, 0, "u", "payload", hashlib.sha256(b"payload").hexdigest(), "response", None, None)
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload\r", b"pAyload\r"), 0)


def test_empty_table(spark, tmp):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none, f"{tmp}/w").count() == 0


def test_every_record_has_its_own_id(pages, tmp):
    index = warc.write_archives(warc.plan_records(pages), f"file:{tmp}/w")
    rows = index.collect()
    assert len({r["record_id"] for r in rows}) == len(ROWS)  # repeated and null page ids too
    for r in rows:
        (found,) = warc.fetch(index, record_ids=[r["record_id"]])
        assert found["record_id"] == r["record_id"] and found["page_id"] == r["page_id"]
    responses = {r["record_id"]: r["page_id"] for r in rows if r["record_type"] == "response"}
    for name in glob.glob(f"{tmp}/w/*.zst"):
        with open(name, "rb") as f:
            data = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        for head in data.split(b"WARC-Type: revisit")[1:]:
            refers = head.split(b"WARC-Refers-To: ")[1].split(b"\r\n")[0].decode()
            page = int(head.split(b"X-Refers-To-Page: ")[1].split(b"\r\n")[0])
            assert responses[refers] == page  # a response of that page, there to be read


def test_paths_without_a_scheme_go_to_the_default_file_system(spark, pages, tmp):
    index = warc.write_archives(warc.plan_records(pages), f"{tmp}/w")
    assert all(r["bundle"].startswith("file:/") for r in index.collect())
    with pytest.raises(ValueError, match="scheme"):
        warc.open_store("/tmp/x")
