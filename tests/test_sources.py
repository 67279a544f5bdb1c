import os

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.bronze import SHORT_RECORD_REASON, process_bronze
from ledgerflow.sinks.tables import write_fixed
from ledgerflow.sources.tables import require_path, scan_fixed, scan_small_files


def _write(path, data):
    with open(path, "wb") as fh:
        fh.write(data)


def _records(n, width=35):
    return [bytes([65 + (i % 26)]) * width for i in range(n)]


def test_scan_splits_and_order(spark, tmp):
    recs = _records(1000)
    _write(os.path.join(tmp, "a.bin"), b"".join(recs))
    df = scan_fixed(spark, tmp, split_bytes=35 * 64, with_position=True)
    assert df.rdd.getNumPartitions() == 16
    rows = df.orderBy("record_index").collect()
    assert [bytes(r.raw_bytes) for r in rows] == recs
    assert [r.record_index for r in rows] == list(range(1000))


def test_ragged_tail_policies(spark, tmp):
    _write(os.path.join(tmp, "r.bin"), b"".join(_records(10)) + b"x" * 7)
    assert scan_fixed(spark, tmp).count() == 10
    kept = scan_fixed(spark, tmp, tail="keep")
    assert sorted(len(r.raw_bytes) for r in kept.collect())[0] == 7
    valid, rejects = process_bronze(kept, check_length=True)
    assert valid.count() + rejects.count() == 11
    assert rejects.where(F.col("rejection_reason") == SHORT_RECORD_REASON).count() == 1
    with pytest.raises(Exception):
        scan_fixed(spark, tmp, tail="fail").count()


def test_empty_file_and_missing_path(spark, tmp):
    _write(os.path.join(tmp, "empty.bin"), b"")
    assert scan_fixed(spark, tmp).count() == 0
    with pytest.raises(FileNotFoundError) as err:
        require_path(spark, os.path.join(tmp, "nope.bin"))
    assert "empty.bin" in str(err.value)


def test_writer_roundtrip_and_overwrite(spark, tmp):
    df = spark.createDataFrame([(r,) for r in _records(100)], "raw_bytes binary").repartition(3)
    out = os.path.join(tmp, "dump")
    write_fixed(df, out)
    write_fixed(df, out)  # overwrite leaves one set of part files
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 3 and sum(os.path.getsize(os.path.join(out, f)) for f in parts) == 3500
    assert not [f for f in os.listdir(out) if f.startswith("_temporary")]
    back = scan_fixed(spark, out)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_writer_rejects_wrong_width(spark, tmp):
    df = spark.createDataFrame([(b"short",)], "raw_bytes binary")
    with pytest.raises(Exception):
        write_fixed(df, os.path.join(tmp, "bad"))


def test_small_files_scan(spark, tmp):
    for k in range(3):
        _write(os.path.join(tmp, f"f{k}.bin"), b"".join(_records(5 + k)) + (b"z" if k == 2 else b""))
    assert scan_small_files(spark, tmp).count() == 18
    assert scan_small_files(spark, tmp, tail="keep").count() == 19


def test_medallion_rejects_kept_tail(spark, tmp):
    from ledgerflow.functions.codec import comp3_encode, encode_text_field
    from ledgerflow.plans.medallion import run_medallion

    df = spark.createDataFrame([("TXN000000001", "CUST000001", 100, "ACTIVE")],
                               "t string, c string, n long, s string").select(F.concat(
        encode_text_field("t", 12), encode_text_field("c", 10), comp3_encode("n"),
        encode_text_field("s", 8)).alias("raw_bytes"))
    rec = df.first().raw_bytes
    path = os.path.join(tmp, "in")
    os.makedirs(path)
    _write(os.path.join(path, "d.bin"), bytes(rec) * 3 + bytes(rec)[:30])
    dropped = run_medallion(spark, path, os.path.join(tmp, "o1"), tail="drop")
    assert (dropped["ingested"], dropped["delivered"], dropped["dropped_tails"]) == (3, 3, 1)
    kept = run_medallion(spark, path, os.path.join(tmp, "o2"))
    assert (kept["ingested"], kept["structural_rejects"], kept["delivered"], kept["dropped_tails"]) == (4, 1, 3, 0)
    bronze = spark.read.parquet(os.path.join(tmp, "o2", "bronze"))
    assert bronze.columns == ["tx_id", "cust_id", "raw_balance", "tx_status"] and bronze.count() == 3


def test_split_planning():
    from ledgerflow.sources.fixed_width import FixedWidthReader

    assert FixedWidthReader({"path": "x", "splitBytes": "1000"}, None)._split_bytes(100 * 2**40) == 980  # as asked, in whole records
    assert FixedWidthReader({"path": "x", "minPartitions": "8"}, None)._split_bytes(35 * 1000) <= 35 * 125


def test_whole_files_are_read_by_the_jvm(spark, tmp):
    recs = _records(500)
    os.makedirs(os.path.join(tmp, "in", "sub"))
    _write(os.path.join(tmp, "in", "x.bin"), b"".join(recs[:300]))
    _write(os.path.join(tmp, "in", "sub", "y.bin"), b"".join(recs[300:]))
    os.makedirs(os.path.join(tmp, "in", "_temporary", "0"))
    _write(os.path.join(tmp, "in", "_temporary", "0", "z.bin"), b"".join(recs))
    _write(os.path.join(tmp, "in", ".hidden"), b"x" * 7)
    df = scan_fixed(spark, os.path.join(tmp, "in"), split_bytes=35 * 64)
    assert sorted(bytes(r.raw_bytes) for r in df.collect()) == sorted(recs)
    assert df.rdd.getNumPartitions() >= 8
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchScan" not in plan
    os.rename(os.path.join(tmp, "in", "sub"), os.path.join(tmp, "in", "sub,1"))
    assert scan_fixed(spark, os.path.join(tmp, "in", "sub,1")).count() == 200
    _write(os.path.join(tmp, "in", "ragged.bin"), b"".join(recs[:3]) + b"tail")
    assert scan_fixed(spark, os.path.join(tmp, "in")).count() == 503
    assert scan_fixed(spark, os.path.join(tmp, "in"), tail="keep").count() == 504


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_ragged_files_are_one_scan(spark, tmp):
    folder = os.path.join(tmp, "in")
    os.makedirs(folder)
    want = []
    for k in range(1000):
        recs = [bytes([65 + k % 26]) * 30 + f"{k:05d}".encode()] * (k % 4)
        want += recs
        _write(os.path.join(folder, f"f{k:04d}.bin"), b"".join(recs) + b"z" * (k % 3))
    df = scan_fixed(spark, folder)
    plan = _plan(df)
    assert plan.count("Scan binaryFile") == 1 and "Union" not in plan and "Python" not in plan and "InArrow" not in plan
    assert sorted(bytes(r.raw_bytes) for r in df.collect()) == sorted(want)
    tails = sum(1 for k in range(1000) if k % 3)
    assert scan_fixed(spark, folder, tail="keep").count() == len(want) + tails
    with pytest.raises(ValueError, match=f"{tails} files"):
        scan_fixed(spark, folder, tail="fail")


@pytest.mark.parametrize("tail", ["drop", "keep"])
def test_large_ragged_files_are_read_by_ranges(spark, tmp, tail):
    folder = os.path.join(tmp, "in")
    os.makedirs(os.path.join(folder, "sub"))
    recs = _records(1000)
    _write(os.path.join(folder, "large.bin"), b"".join(recs) + b"tail")
    _write(os.path.join(folder, "sub", "exact.bin"), b"".join(recs[:640]))   # ends with a range
    _write(os.path.join(folder, "small.bin"), b"".join(recs[:5]) + b"cut")
    _write(os.path.join(folder, "stump.bin"), b"x" * 34)
    _write(os.path.join(folder, "empty.bin"), b"")
    df = scan_fixed(spark, folder, tail=tail, split_bytes=35 * 64, whole_file_bytes=35 * 10)
    want = recs + recs[:640] + recs[:5] + ([b"tail", b"cut", b"x" * 34] if tail == "keep" else [])
    plan = _plan(df)
    assert sorted(bytes(r.raw_bytes) for r in df.collect()) == sorted(want)
    assert plan.count("MapInArrow") == 1 and plan.count("Scan binaryFile") == 2 and "BatchScan" not in plan


def test_byte_ranges_cover_each_record_once(spark):
    from ledgerflow.sources.tables import byte_ranges

    sizes = [0, 1, 34, 35, 36, 70, 350, 351, 700, 35 * 64, 35 * 64 + 34]
    files = spark.createDataFrame([(str(i), n) for i, n in enumerate(sizes)], "path string, length long")
    for tail in ("drop", "keep"):
        got = {}
        for r in byte_ranges(files, 35, 350, tail).collect():
            assert r.start % 35 == 0 and (r.end - r.start) % 35 == 0 and r.end - r.start <= 350
            got.setdefault(r.path, []).append((r.start, r.end, r.tail))
        for i, n in enumerate(sizes):
            ranges, left = sorted(got.get(str(i), [])), n % 35 if tail == "keep" else 0
            assert sum(e - s for s, e, _ in ranges) == n - n % 35 and sum(t for *_, t in ranges) == left
            assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))


def test_checkpoint_dir_is_required_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from ledgerflow.session import ensure_checkpoint_dir

    unset = SimpleNamespace(get=lambda *a: None)
    session = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: unset, master="spark://x:7077"), conf=unset)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)
