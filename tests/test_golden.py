"""The legacy job's own goldens (FIXTURES.md §4): 10,000 records built with spark.range."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.codec import encode_text_field, make_id
from ledgerflow.operators import adjudicate as adj
from ledgerflow.plans.medallion import layer_paths, run_medallion
from ledgerflow.sinks.tables import write_fixed
from legacy import comp3_encode_hex_quirk


def golden_records(spark, n=10000):
    i = F.col("id")
    structural = i % 2500 == 0
    negative = i % 3333 == 0
    cust = (F.when(structural, F.lit(" " * 10))
             .when(negative, make_id("CUST", i, 6))
             .otherwise(make_id("CUST", F.lit(990000) + i % 100, 6)))
    balance = (F.when(structural, comp3_encode_hex_quirk(F.lit(50000)))
                .when(negative, F.unhex(F.lit("000000500D")))
                .otherwise(comp3_encode_hex_quirk(F.lit(550000000) + i * 100)))
    status = F.when(~structural & ~negative & (i % 5000 == 0), F.lit("SUSPEND")).otherwise(F.lit("ACTIVE"))
    return spark.range(1, n + 1).select(F.concat(
        encode_text_field(F.concat(F.lit("TXN"), (F.lit(202600000) + i).cast("string")), 12),
        encode_text_field(cust, 10), balance, encode_text_field(status, 8)).alias("raw_bytes"))


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("golden"))
    write_fixed(golden_records(spark), base + "/landing")
    kpi = run_medallion(spark, base + "/landing", base + "/out")
    return base, kpi


def test_golden_counts(golden):
    _, kpi = golden
    assert kpi["ingested"] == 10000
    assert kpi["structural_rejects"] == 4
    assert kpi["malformed_rejects"] == 0
    assert kpi["hub_customer"] == 103
    assert kpi["lnk_transaction"] == 9996
    assert kpi["sat_account_state"] == 9996
    assert kpi["semantic_rejects"] == 3
    assert kpi["delivered"] == 9993
    assert kpi["survival_pct"] == 100.0


def test_golden_gold_values(spark, golden):
    base, _ = golden
    p = layer_paths(base + "/out")
    gold = spark.read.parquet(p["gold"])
    s = gold.agg(F.min("account_balance").alias("lo"), F.max("account_balance").alias("hi"),
                 F.sum(F.col("account_balance").cast("decimal(20,2)")).alias("total"),
                 F.countDistinct("account_balance").alias("nd"),
                 F.count_if(F.col("risk_category") != "LOW").alias("not_low")).first()
    assert (s.lo, s.hi) == (212856.44, 213797.58)
    assert str(s.total) == "2131816133.76"
    assert s.nd == 9825 and s.not_low == 0
    sem = spark.read.json(p["dlq/semantic"]).collect()
    assert sorted(r.tx_id for r in sem) == ["TXN202603333", "TXN202606666", "TXN202609999"]
    assert {r.account_balance for r in sem} == {-5.0}
    assert {r.rejection_reason for r in sem} == {"CONSUMER_VIOLATION: Negative Analytical Balance Value"}
    assert {r.masked_customer_id for r in sem} == {"CUST003333", "CUST006666", "CUST009999"}  # clear ids in the DLQ
    structural = spark.read.json(p["dlq/structural"]).collect()
    assert sorted(r.tx_id for r in structural) == ["TXN202602500", "TXN202605000", "TXN202607500", "TXN202610000"]
    assert {r.raw_balance for r in structural} == {"AAAMNQw="}


def test_golden_hashes(spark, golden):
    base, _ = golden
    p = layer_paths(base + "/out")
    link = spark.read.parquet(p["silver/lnk_transaction"]).where("source_tx_id = 'TXN202600001'").first()
    assert link.transaction_link_hash_key.startswith("d862f61e")
    assert link.customer_hash_key.startswith("b602e663")
    gold = spark.read.parquet(p["gold"]).where(F.col("account_balance") == 212856.44).first()
    assert gold.transaction_hash_id.startswith("6a320c73")
    assert gold.masked_customer_id.startswith("b602e663")


def test_golden_strict_decoder_rejects_hex_packing(spark, golden):
    base, _ = golden
    kpi = run_medallion(spark, base + "/landing", base + "/strict", strict=True)
    assert kpi["malformed_rejects"] == 9993 + 3 - 3  # every hex-packed balance has an A-F digit
    assert kpi["delivered"] == 0


def test_golden_adjudication(spark, golden):
    base, _ = golden
    gold = spark.read.parquet(layer_paths(base + "/out")["gold"])
    valid, rejects = adj.adjudicate(gold, run_id="t", snapshot_ts="2026-06-14 17:06:00")
    rows = valid.select("adjudication_label", "confidence_score", "adjudication_rationale",
                        "governance_metadata.model_version", "governance_metadata.compliance_tag").distinct().collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.adjudication_label, r.confidence_score) == ("REVIEW", 0.91)
    assert r.adjudication_rationale == "Heuristic fallback applied for risk level 0.71."
    assert (r.model_version, r.compliance_tag) == ("v3.1.0-sovereign-xai", "AML_2026_SOVEREIGN")
    assert valid.count() == 9993 and rejects.count() == 0
