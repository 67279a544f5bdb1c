"""FIXTURES.md §6 edge cases."""

import os

from pyspark.sql import functions as F

from ledgerflow.contracts import load_contract
from ledgerflow.operators import adjudicate as adj
from ledgerflow.operators.bronze import process_bronze
from ledgerflow.operators.product import RISK_OUT_OF_BOUNDS, apply_masking, process_gold, risk_bucket
from ledgerflow.operators.split import Rule, split
from ledgerflow.plans.medallion import layer_paths, run_medallion

BRONZE = "tx_id string, cust_id string, raw_balance binary, tx_status string"


def test_null_key_lands_in_dlq(spark):
    df = spark.createDataFrame([("TXN000000001", None, b"\x00\x00\x00\x10\x0c", "ACTIVE"),
                                ("            ", "CUST000001", b"\x00\x00\x00\x10\x0c", "ACTIVE"),
                                ("TXN000000003", "\t", b"\x00\x00\x00\x10\x0c", "ACTIVE"),
                                (None, "CUST000004", b"\x00\x00\x00\x10\x0c", "ACTIVE")], BRONZE)
    from ledgerflow.operators.bronze import structural_rules
    valid, rejects = split(df, structural_rules())
    assert valid.count() + rejects.count() == 4
    assert sorted(r.cust_id or "<null>" for r in rejects.collect()) == ["<null>", "CUST000004"]
    assert sorted(r.cust_id for r in valid.collect()) == ["\t", "CUST000001"]  # blank tx id and tab pass


def test_risk_bucket_status(spark):
    df = spark.createDataFrame([("SUSPEND", 1.0), (None, 1.0), ("ACTIVE", -0.01), ("ACTIVE", 0.0)],
                               "tx_status string, account_balance double")
    out = [r.b for r in df.select(risk_bucket().alias("b")).collect()]
    assert out == [RISK_OUT_OF_BOUNDS, RISK_OUT_OF_BOUNDS, RISK_OUT_OF_BOUNDS, "LOW"]


def test_label_thresholds_are_strict(spark):
    df = spark.createDataFrame([(0.6,), (0.8,), (0.6000001,), (0.9,), (0.7,)], "r double")
    batch = [r.l for r in df.select(adj.label("r").alias("l")).collect()]
    assert batch == ["APPROVE", "REVIEW", "REVIEW", "BLOCK", "REVIEW"]
    req = [r.l for r in df.select(adj.label("r", adj.REQUEST_THRESHOLDS).alias("l")).collect()]
    assert req == ["APPROVE", "REVIEW", "APPROVE", "REVIEW", "APPROVE"]


def test_request_contract_failures(spark):
    reqs = spark.createDataFrame([("a", 0.5, 1.01), ("b", 1.2, 0.5), ("c", 0.95, 0.9), ("d", float("nan"), 0.5)],
                                 "transaction_hash_id string, calculated_risk double, agent_confidence double")
    out = {r.transaction_id: r for r in adj.score_requests(reqs, snapshot_ts="2026-01-01 00:00:00").collect()}
    assert out["a"].status_code == 400 and "confidence_score" in out["a"].failures[0]
    assert out["b"].status_code == 400 and "risk_score" in out["b"].failures[0]
    assert out["c"].status_code == 201 and out["c"].adjudication_label == "BLOCK" and out["c"].failures == []
    assert out["d"].status_code == 400
    strict = adj.score_requests(reqs, require_rationale=True).where("status_code = 201").count()
    assert strict == 0  # the legacy payload has no rationale, so every request fails


def test_duplicate_ids_adjudicated_once(spark):
    gold = spark.createDataFrame([("x", 100.0, "LOW"), ("x", 50.0, "LOW"), ("y", 250000.0, "LOW")],
                                 "transaction_hash_id string, account_balance double, risk_category string")
    valid, rejects = adj.adjudicate(gold, snapshot_ts="2026-01-01 00:00:00")
    rows = {r.transaction_id: r for r in valid.collect()}
    assert set(rows) == {"x", "y"} and rejects.count() == 0
    assert rows["x"].risk_score == 50.0 / 300000.0
    assert rows["y"].adjudication_label == "BLOCK"


def test_contract_failure_goes_to_adjudication_dlq(spark):
    gold = spark.createDataFrame([("x", 100.0, "LOW")], "transaction_hash_id string, account_balance double, "
                                 "risk_category string")

    def overconfident(dim):
        return dim.withColumns({"semantic_confidence": F.lit(5.0), "rationale": F.lit("sure")})

    valid, rejects = adj.adjudicate(gold, provider=overconfident, snapshot_ts="2026-01-01 00:00:00")
    assert valid.count() == 0
    assert rejects.first().rejection_reason.startswith("CONTRACT_VIOLATION: confidence_score")


def test_masking_policy_shapes(spark):
    df = spark.createDataFrame([(" a ", "b")], "x string, y string")
    h = spark.range(1).select(F.sha2(F.lit("a"), 256)).first()[0]
    for policy in ({"apply_sha256": ["x", "missing"]}, [{"apply_sha256": ["x"]}]):
        r = apply_masking(df, policy).first()
        assert r.x == h and r.y == "b"
    c = load_contract("consumer")
    assert c.allowed_values("risk_category") == ["LOW", "MEDIUM", "HIGH"]
    assert c.masking_targets() == ["masked_customer_id", "transaction_hash_id"]


def test_clean_run_replaces_stale_dlq(spark, tmp):
    from ledgerflow.functions.codec import comp3_encode, encode_text_field

    def dump(rows, path):
        df = spark.createDataFrame(rows, "t string, c string, n long, s string").select(F.concat(
            encode_text_field("t", 12), encode_text_field("c", 10), comp3_encode("n"),
            encode_text_field("s", 8)).alias("raw_bytes"))
        from ledgerflow.sinks.tables import write_fixed
        write_fixed(df, path)

    dirty = os.path.join(tmp, "dirty")
    clean = os.path.join(tmp, "clean")
    dump([("TXN000000001", "", 100, "ACTIVE"), ("TXN000000002", "CUST000002", -5, "ACTIVE")], dirty)
    dump([("TXN000000003", "CUST000003", 100, "ACTIVE")], clean)
    out = os.path.join(tmp, "out")
    k1 = run_medallion(spark, dirty, out)
    assert (k1["structural_rejects"], k1["semantic_rejects"]) == (1, 1)
    k2 = run_medallion(spark, clean, out)
    assert (k2["structural_rejects"], k2["semantic_rejects"], k2["delivered"]) == (0, 0, 1)
    p = layer_paths(out)
    for name in ("dlq/structural", "dlq/semantic"):
        files = [f for f in os.listdir(p[name]) if f.endswith(".json")]
        assert sum(os.path.getsize(os.path.join(p[name], f)) for f in files) == 0


def test_bronze_keeps_untrimmed_ids(spark):
    from ledgerflow.functions.codec import encode_text_field, comp3_encode
    df = spark.createDataFrame([("TXN1", "CUST1", 1, "ACTIVE")], "t string, c string, n long, s string").select(
        F.concat(encode_text_field("t", 12), encode_text_field("c", 10), comp3_encode("n"),
                 encode_text_field("s", 8)).alias("raw_bytes"))
    valid, _ = process_bronze(df)
    r = valid.first()
    assert (r.tx_id, r.cust_id, r.tx_status) == ("TXN1        ", "CUST1     ", "ACTIVE")
    gold, _ = process_gold(valid.withColumn("unpacked_balance", F.lit(0.01)))
    g = gold.first()
    assert g.transaction_hash_id == spark.range(1).select(F.sha2(F.lit("TXN1"), 256)).first()[0]
