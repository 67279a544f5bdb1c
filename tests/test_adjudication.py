"""Adjudication of bad, repeated and missing ids; resumed and streamed runs."""

import glob

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.scalar import clamp01, format_score, round_score
from ledgerflow.operators import adjudicate as adj
from ledgerflow.plans.adjudication import run_adjudication
from ledgerflow.plans.bridge import ledger_fields
from ledgerflow.streaming.resume import adjudicate_available_now

GOLD = "transaction_hash_id string, masked_customer_id string, account_balance double, risk_category string"


def gold(spark, rows):
    return spark.createDataFrame([(i, "m", b, c) for i, b, c in rows], GOLD)


def test_bad_balances_are_rejected(spark):
    valid, rejects = adj.adjudicate(gold(spark, [("a", None, "LOW"), ("b", float("nan"), "LOW"), ("c", 290000.0, "HIGH"), ("c", None, "LOW")]))
    assert [(r["transaction_id"], r["adjudication_label"]) for r in valid.collect()] == [("c", "BLOCK")]
    assert {r["transaction_id"]: r["rejection_reason"] for r in rejects.collect()} == dict.fromkeys(
        "ab", "CONTRACT_VIOLATION: missing required field")


def test_clamp_keeps_null(spark):
    row = spark.range(1).select(clamp01(F.lit(None).cast("double")).alias("n"), clamp01(F.lit(float("nan"))).alias("x"),
                                clamp01(F.lit(float("inf"))).alias("i")).first()
    assert (row["n"], row["x"], row["i"]) == (None, None, 1.0)


@pytest.mark.parametrize("fn", [round_score, format_score])
@pytest.mark.parametrize("value", [2.675, -0.5, float("nan"), 2.0])
def test_rounding_refuses_other_numbers(spark, fn, value):
    with pytest.raises(Exception, match="scores in"):
        spark.range(1).select(fn(F.lit(value), 2)).collect()
    assert spark.range(1).select(fn(F.lit(None).cast("double"), 2).alias("v")).first()["v"] is None


def test_one_id_has_its_own_rationale_and_an_absent_one_is_a_reject(spark):
    table = gold(spark, [("a", 10000.0, "LOW"), ("b", 170000.0, "LOW")])
    valid, rejects = adj.adjudicate_one(table, "b")
    assert "0.57" in valid.first()["adjudication_rationale"] and rejects.count() == 0
    valid, rejects = adj.adjudicate_one(table, "zzz")
    assert valid.count() == 0 and rejects.first()["rejection_reason"] == adj.MISSING_FROM_GOLD


def test_one_shuffle_of_the_ids_and_no_sort(spark, tmp):
    gold(spark, [("a", 1.0, "LOW"), ("b", 250000.0, "HIGH")]).write.parquet(f"{tmp}/g")
    valid, _ = adj.adjudicate(spark.read.parquet(f"{tmp}/g"))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan and "SortAggregate(key=[transaction" not in plan  # the label minima have no key
    assert plan.count("Exchange hashpartitioning") <= 2  # the second is reused when it runs


def test_ordered_ids_are_in_order(spark):
    ids = [r[0] for r in adj.ordered_ids(gold(spark, [(x, 1.0, "LOW") for x in "dacbad"])).collect()]
    assert ids == sorted(set(ids)) == list("abcd")


def test_streamed_ids_come_out_once_and_batches_are_counted(spark, tmp):
    for i, rows in enumerate([["a", "b"], ["a", "c"], ["d"], ["b"], ["e"], ["e", "f"]]):
        gold(spark, [(x, 1000.0, "LOW") for x in rows]).coalesce(1).write.mode("append").parquet(f"{tmp}/gold")
    limit = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(limit, "3")
    try:
        n = adjudicate_available_now(spark, f"{tmp}/gold", f"{tmp}/out", f"{tmp}/ckpt", max_files_per_trigger=1)
    finally:
        spark.conf.unset(limit)
    assert n == 6
    assert sorted(r["transaction_id"] for r in spark.read.parquet(f"{tmp}/out").collect()) == list("abcdef")
    assert adjudicate_available_now(spark, f"{tmp}/gold", f"{tmp}/out", f"{tmp}/ckpt") == 0
    # a label that the first run did not see
    gold(spark, [("z", 290000.0, "HIGH")]).coalesce(1).write.mode("append").parquet(f"{tmp}/gold")
    assert adjudicate_available_now(spark, f"{tmp}/gold", f"{tmp}/out", f"{tmp}/ckpt") == 1
    assert spark.read.parquet(f"{tmp}/out").where("transaction_id = 'z'").first()["adjudication_label"] == "BLOCK"


def test_a_run_with_nothing_to_do_adds_no_file(spark, tmp):
    gold(spark, [("a", 1.0, "LOW"), ("n", None, "LOW")]).write.parquet(f"{tmp}/gold")
    assert run_adjudication(spark, f"{tmp}/gold", f"{tmp}/out", "r1") == {"published": 1, "rejected": 1}
    before = sorted(glob.glob(f"{tmp}/out/published_product/*"))
    assert run_adjudication(spark, f"{tmp}/gold", f"{tmp}/out", "r2") == {"published": 0, "rejected": 1}
    assert sorted(glob.glob(f"{tmp}/out/published_product/*")) == before


def test_ids_hold_a_billion_customers(spark):
    orders = spark.createDataFrame([(10_000_000_001, 999_999_999, 12.5, "O")], "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string")
    row = ledger_fields(orders).first()
    assert (row["tx_id"], row["cust_id"]) == ("T10000000001", "C999999999")
