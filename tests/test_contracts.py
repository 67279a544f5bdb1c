from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.contracts import load_contract, required
from ledgerflow.operators.split import split
from ledgerflow.plans.medallion import kpi_lines


def test_bundled_contracts_load(spark):  # struct types parse through the session
    producer = load_contract("producer")
    assert producer.names == ["tx_id", "cust_id", "raw_balance", "tx_status"]
    assert producer.schema()["raw_balance"].dataType == T.BinaryType()
    product = load_contract("product")
    assert product.allowed_values("adjudication_label") == ["APPROVE", "REVIEW", "BLOCK"]
    assert isinstance(product.schema()["governance_metadata"].dataType, T.StructType)


def test_producer_rules_route_every_row(spark):
    df = spark.createDataFrame([("TXN000000001", "CUST000001"), (None, "CUST000002"), ("TXN0000000003X", "C")],
                               "tx_id string, cust_id string")
    rules = load_contract("producer").rules(columns=df.columns)  # absent columns are skipped
    valid, rejects = split(df, rules)
    assert valid.count() == 1
    reasons = sorted(r.rejection_reason for r in rejects.collect())
    assert reasons == ["CONTRACT_VIOLATION: tx_id is null", "CONTRACT_VIOLATION: tx_id longer than 12"]


def test_required_checks_struct_leaves(spark):
    df = spark.createDataFrame([(1, ("a", None)), (2, ("a", "b")), (3, None)], "id int, s struct<x:string,y:string>")
    ok = sorted(r.id for r in df.where(required(["id", "s"], df)).collect())
    assert ok == [2]


def test_kpi_lines_format():
    lines = kpi_lines({"ingested": 10000, "delivered": 9993, "structural_rejects": 4, "malformed_rejects": 0,
                       "semantic_rejects": 3, "survival_pct": 100.0})
    assert lines[0].endswith("10,000") and lines[-1].endswith("100.00%")
