"""Check queries: each operator of the inventory as a Spark query over the given
tables, paired with an independent DuckDB SQL oracle.

Spark side: ``orders`` -> fixed-width EBCDIC/COMP-3 dump (bridge) -> scan ->
decode -> gates -> vault / gold / adjudication. Oracle side: the same answer
computed straight from ``orders`` in SQL, so a codec bug shows as a mismatch.
Binary values are compared as hex strings and nested structs are flattened so
the two engines' results compare cell by cell.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import (comp3_decode, comp3_encode,
                               ebcdic_decode, ebcdic_encode)
from ..layout import LEDGER_LAYOUT
from ..operators import adjudicate as adj
from ..operators.bronze import process_bronze
from ..operators.kpi import kpi_report, layer_audit, route_records
from ..operators.order import parts_by_position
from ..operators.product import apply_masking, process_gold
from ..operators.split import with_reason
from ..operators.vault import build_vault, process_silver, vault_join
from ..contracts import conform, load_contract
from ..session import scratch_path
from ..sinks.tables import dump_json
from ..sources.tables import qualified, read_bucketed, read_dlq, write_text
from .bridge import BLANK_EVERY, CORRUPT_EVERY, NEGATIVE_EVERY
from .dumps import ledger_dump
from .medallion import layer_paths, read_layer, run_medallion

# Fixed parameters of the checks (not of the library).
RUN_ID = "RUN"
SNAPSHOT_TS = _dt.datetime(2026, 1, 1)
SNAPSHOT_SQL = "TIMESTAMP '2026-01-01 00:00:00'"
EARLIER_SNAPSHOT = "1998-01-01"
CUSTOMER_CONTRACT = {"schema": [
    {"name": "c_custkey", "type": "long", "constraints": [{"is_not_null": True}]},
    {"name": "c_name", "type": "string", "length": 18, "constraints": [{"is_not_null": True}]},
    {"name": "c_acctbal", "type": "double", "constraints": [{"range": [0.0, 9999.99]}]},
    {"name": "c_mktsegment", "type": "string", "allowed_values": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]},
]}
CUSTOMER_MASKING = [{"apply_sha256": ["c_name", "c_mktsegment", "c_not_a_column"]}]

ORDERED_ROWS = 1000
ORDER_CONTRACT = [
    {"name": "order_ref", "type": "string", "length": 12, "constraints": [{"is_not_null": True}]},
    {"name": "customer", "type": "long", "constraints": [{"is_not_null": True}]},
    {"name": "total", "type": "double", "constraints": [{"range": [0.0, 300000.0]}]},
    {"name": "status", "type": "string", "allowed_values": ["F", "O"]},
]

Query = Callable[[SparkSession, str], DataFrame]


def _hex(c: str) -> F.Column:
    return F.hex(F.col(c))


# ------------------------------------------------------------- Spark side

def _bronze(spark, sf, corrupt=None):
    return process_bronze(ledger_dump(spark, sf, corrupt))


def _silver(spark, sf, strict=False, corrupt=None):
    return process_silver(_bronze(spark, sf, corrupt)[0], strict=strict)


def _gold(spark, sf):
    return process_gold(_silver(spark, sf)[0])


def _flatten_payload(df: DataFrame, *more: str) -> DataFrame:
    return df.select("transaction_id", "risk_score", "adjudication_label", "confidence_score",
                     "adjudication_rationale", "governance_metadata.*", *more)


def q_bronze_valid(spark, sf):
    valid, _ = _bronze(spark, sf)
    return valid.select("tx_id", "cust_id", _hex("raw_balance").alias("raw_balance_hex"), "tx_status")


def q_dlq_structural(spark, sf):
    _, rejects = _bronze(spark, sf)
    return rejects.select("tx_id", "cust_id", _hex("raw_balance").alias("raw_balance_hex"), "tx_status",
                          "rejection_reason")


def q_comp3_lenient(spark, sf):
    valid, _ = _bronze(spark, sf, CORRUPT_EVERY)
    return valid.select("tx_id", comp3_decode(F.col("raw_balance")).alias("balance"))


def q_comp3_strict(spark, sf):
    valid, _ = _bronze(spark, sf, CORRUPT_EVERY)
    return valid.select("tx_id", comp3_decode(F.col("raw_balance"), strict=True).alias("balance"))


def q_comp3_encode_hex(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    signed = F.when(F.col("o_orderkey") % NEGATIVE_EVERY == 0, -cents).otherwise(cents)
    return orders.select("o_orderkey", F.hex(comp3_encode(signed)).alias("packed_hex"))


def q_ebcdic_roundtrip(spark, sf):
    cust = spark.read.parquet(f"{sf}/customer.parquet")
    enc = cust.select("c_custkey", ebcdic_encode(F.col("c_name")).alias("b"),
                      ebcdic_encode(F.col("c_mktsegment")).alias("m"))
    return enc.select("c_custkey", F.hex("b").alias("c_name_ebcdic_hex"), ebcdic_decode(F.col("b")).alias("c_name"),
                      ebcdic_decode(F.col("m")).alias("c_mktsegment"))


def q_malformed_balance(spark, sf):
    _, malformed = _silver(spark, sf, strict=True, corrupt=CORRUPT_EVERY)
    return malformed.select("tx_id", "cust_id", _hex("raw_balance").alias("raw_balance_hex"), "tx_status",
                            "rejection_reason")


def _vault(spark, sf):
    return build_vault(_silver(spark, sf)[0])


def q_hub_customer(spark, sf):
    return _vault(spark, sf)["hub_customer"]


def q_lnk_transaction(spark, sf):
    return _vault(spark, sf)["lnk_transaction"]


def q_sat_account_state(spark, sf):
    return _vault(spark, sf)["sat_account_state"]


def q_vault_gold(spark, sf):
    """The written vault, joined again and put through the consumer gates and masking; it equals gold."""
    joined = q_vault_join(spark, sf)
    silver = joined.select(F.col("source_tx_id").alias("tx_id"), F.col("source_cust_id").alias("cust_id"),
                           F.col("ledger_status").alias("tx_status"), F.col("account_balance").alias("unpacked_balance"))
    return process_gold(silver)[0]


def q_dlq_read(spark, sf):
    """The written producer dead-letter queue, read with its explicit schema."""
    out, _ = written_medallion(spark, sf)
    return read_dlq(spark, layer_paths(out)["dlq/structural"]).select(
        "tx_id", _hex("raw_balance").alias("raw_balance_hex"), "unpacked_balance", "rejection_reason")


def q_vault_join(spark, sf):
    """The written vault joined again; it is written once a session."""
    out, kpi = written_medallion(spark, sf)
    tables = [read_bucketed(spark, layer_paths(out)[f"silver/{t}"]) for t in ("hub_customer", "lnk_transaction", "sat_account_state")]
    return vault_join(*tables, hub_rows=kpi["hub_customer"])


def q_vault_join_salted(spark, sf):
    """The same join by the way for hubs too large to broadcast."""
    out, _ = written_medallion(spark, sf)
    return vault_join(*[read_bucketed(spark, layer_paths(out)[f"silver/{t}"])
                        for t in ("hub_customer", "lnk_transaction", "sat_account_state")])


_WRITTEN: dict[tuple, tuple[str, dict]] = {}


def written_medallion(spark, sf):
    """(folder, counts) of a full run over ``sf``, made on first use in a session."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf))
    if key not in _WRITTEN:
        _WRITTEN[key] = _medallion(spark, sf)
    return _WRITTEN[key]


def q_risk_bucket(spark, sf):
    from ..operators.product import to_product_columns
    silver, _ = _silver(spark, sf)
    return to_product_columns(silver).select("tx_id", "account_balance", "risk_category")


def q_gold_product(spark, sf):
    return _gold(spark, sf)[0]


def q_dlq_semantic(spark, sf):
    _, rejects = _gold(spark, sf)
    return rejects.select("tx_id", "cust_id", _hex("raw_balance").alias("raw_balance_hex"), "tx_status",
                          "account_balance", "transaction_hash_id", "masked_customer_id", "risk_category",
                          "rejection_reason")


def q_producer_dlq_union(spark, sf):
    _, structural = _bronze(spark, sf, CORRUPT_EVERY)
    _, malformed = _silver(spark, sf, strict=True, corrupt=CORRUPT_EVERY)
    both = structural.unionByName(malformed, allowMissingColumns=True)
    return both.select("tx_id", _hex("raw_balance").alias("raw_balance_hex"),
                       F.col("unpacked_balance").cast("double").alias("unpacked_balance"), "rejection_reason")


def q_masking(spark, sf):
    cust = spark.read.parquet(f"{sf}/customer.parquet")
    return apply_masking(cust, CUSTOMER_MASKING).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


def q_contract_rules(spark, sf):
    cust = spark.read.parquet(f"{sf}/customer.parquet")
    rules = load_contract(CUSTOMER_CONTRACT).rules()
    return with_reason(cust, rules).select("c_custkey", "rejection_reason")


def q_kpi_report(spark, sf):
    routed = route_records(ledger_dump(spark, sf, CORRUPT_EVERY), strict=True)
    return kpi_report(routed)


def q_route_records(spark, sf):
    routed = route_records(ledger_dump(spark, sf, CORRUPT_EVERY), strict=True)
    return routed.select("tx_id", "stage", "rejection_reason")


def _adjudicated(spark, sf):
    gold, _ = _gold(spark, sf)
    return adj.adjudicate(gold, run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS)


def q_structural_metrics(spark, sf):
    gold, _ = _gold(spark, sf)
    return adj.structural_metrics(gold).select("transaction_hash_id", "calculated_risk", "structural_confidence")


def q_adjudicate_labels(spark, sf):
    gold, _ = _gold(spark, sf)
    scored = adj.structural_metrics(gold)
    return scored.select("transaction_hash_id", "calculated_risk",
                         adj.label("calculated_risk").alias("adjudication_label"),
                         adj.label("calculated_risk", adj.REQUEST_THRESHOLDS).alias("request_label"))


def q_rationale_by_label(spark, sf):
    gold, _ = _gold(spark, sf)
    return adj.label_dimension(gold)


def q_rationale_json_defaults(spark, sf):
    gold, _ = _gold(spark, sf)

    def answers(dim):  # a provider that only sometimes sends a confidence
        return F.when(F.col("adjudication_label") == "BLOCK",
                      F.to_json(F.struct(F.lit(0.5).alias("semantic_confidence")))).otherwise(
            F.to_json(F.struct(F.concat(F.lit("label "), F.col("adjudication_label")).alias("rationale"))))

    return adj.label_dimension(gold, adj.json_rationale(answers))


def q_binaryfile_scan(spark, sf):
    from ..sources.tables import scan_small_files
    from .dumps import ledger_dump_path

    valid, _ = process_bronze(scan_small_files(spark, ledger_dump_path(spark, sf)))
    return valid.select("tx_id", "cust_id", _hex("raw_balance").alias("raw_balance_hex"), "tx_status")


def q_adjudicated(spark, sf):
    valid, _ = _adjudicated(spark, sf)
    return _flatten_payload(valid)


def _faulty_gold(spark, sf):
    """Gold with faults by the id's first digit: NULL (0) and NaN (1) balances, copies with a NULL (2) or larger (3) balance."""
    gold, _ = _gold(spark, sf)
    first = F.substring("transaction_hash_id", 1, 1)
    broken = gold.withColumn("account_balance", F.when(first == "0", F.lit(None)).when(first == "1", F.lit(float("nan")))
                             .otherwise(F.col("account_balance")))
    copies = gold.where(first.isin("2", "3")).withColumn(
        "account_balance", F.when(first == "3", F.col("account_balance") + 1000.0))
    return broken.unionByName(copies)


def q_adjudication_rejects(spark, sf):
    def answers(dim):  # a provider that is too sure of one label
        return F.when(F.col("adjudication_label") == "BLOCK", F.lit('{"semantic_confidence": 2.0, "rationale": "sure"}')).otherwise(F.lit("{}"))

    _, rejects = adj.adjudicate(_faulty_gold(spark, sf), run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS, provider=adj.json_rationale(answers))
    return rejects.select("transaction_id", "risk_score", "adjudication_label", "confidence_score", "rejection_reason")


def q_ordered_ids(spark, sf):
    gold, _ = _gold(spark, sf)
    return adj.ordered_ids(gold)


def q_ordered_parts(spark, sf):
    """The written gold table in file order, a thousand rows a part: what stands first and last in each."""
    out, _ = written_medallion(spark, sf)
    return parts_by_position(spark.read.parquet(layer_paths(out)["gold"]), "transaction_hash_id", ORDERED_ROWS)


def q_layers_by_run(spark, sf):
    """Layers of two runs side by side: one lenient and one strict, and a third that died after its first layers."""
    out = scratch_path(spark, "runs")
    dump = ledger_dump_path_for(spark, sf)
    run_medallion(spark, dump, out, run_id="lenient")
    run_medallion(spark, dump, out, strict=True, run_id="strict")
    try:
        run_medallion(spark, dump, out, run_id="broken", contract={"required_schema": [{"name": "risk_category", "allowed_values": ["LOW"]}],
                                                                   "data_security": {"masking_policy": {"apply_sha256": 1}}})
    except TypeError:  # a masking policy that is no list: bronze and the vault are written by then
        pass
    layers = {"bronze": "bronze", "gold": "gold", "lnk": "silver/lnk_transaction", "semantic": "dlq/semantic"}
    read = [(run, name, read_layer(spark, out, path, None if run == "last" else run))
            for run in ("lenient", "strict", "last") for name, path in layers.items()]
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(run).alias("run"), F.lit(name).alias("layer"), "row_count")
              for run, name, df in read]
    return reduce(DataFrame.unionByName, counts)


def q_contract_enforced(spark, sf):
    """Orders as text, put through a contract file: valid rows with the contract's types, rejects with their reason."""
    path = f"{qualified(spark, scratch_path(spark, 'contract'))}.yaml"
    write_text(spark, path, json.dumps({"schema": ORDER_CONTRACT}))  # JSON is YAML
    key = F.col("o_orderkey")
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.concat(F.lit("T"), F.lpad(key.cast("string"), 11, "0"), F.when(key % 7 == 0, "XYZ").otherwise("")).alias("order_ref"),
        F.when(key % 11 == 0, "unknown").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.when(key % 13 == 0, "n/a").when(key % 17 != 0, F.col("o_totalprice").cast("string")).alias("total"),
        F.col("o_orderstatus").alias("status"))
    valid, rejects = conform(orders, path)
    typed = valid.select("order_ref", F.col("customer").cast("string").alias("customer"), F.col("total").cast("string").alias("total"),
                         F.lit(None).cast("string").alias("rejection_reason"))
    assert valid.schema.simpleString() == "struct<order_ref:string,customer:bigint,total:double,status:string>"
    return typed.withColumn("total", F.col("total").cast("double")).unionByName(
        rejects.select("order_ref", "customer", F.col("total").try_cast("double").alias("total"), "rejection_reason"))


def q_adjudication_all_failures(spark, sf):
    """Every rule that a rejected id breaks, not the first one alone."""
    _, rejects = adj.adjudicate(_faulty_gold(spark, sf), run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS, all_failures=True)
    return rejects.select("transaction_id", F.concat_ws("; ", "failures").alias("failure_list"))


def q_adjudicate_one(spark, sf):
    gold, _ = _gold(spark, sf)
    last = gold.agg(F.max("transaction_hash_id")).first()[0]  # not the first of its label
    answers = [adj.adjudicate_one(gold, i, run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS) for i in (last, "absent")]
    return (_flatten_payload(answers[0][0]).withColumn("rejection_reason", F.lit(None).cast("string"))
            .unionByName(_flatten_payload(answers[1][1], "rejection_reason")))


def _requests(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return ev.select(
        F.sha2(F.col("event_id").cast("string"), 256).alias("transaction_hash_id"),
        (F.col("value") / F.lit(300.0)).alias("calculated_risk"),
        ((F.col("event_id") % 110).cast("double") / F.lit(100.0)).alias("agent_confidence"),
    )


def q_score_requests(spark, sf):
    scored = adj.score_requests(_requests(spark, sf), run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS)
    return scored.select("transaction_id", "risk_score", "adjudication_label", "confidence_score",
                         "adjudication_rationale", "governance_metadata.*", "status_code",
                         F.concat_ws("; ", "failures").alias("failure_list"))


def _published_earlier(spark, sf) -> DataFrame:
    """Output of an earlier run over the orders of an earlier snapshot, published as Parquet."""
    from ..sinks.tables import publish
    from ..sources.tables import read_or_empty

    gold_then, _ = process_gold(process_silver(process_bronze(ledger_dump(spark, sf, None, EARLIER_SNAPSHOT))[0])[0])
    done, _ = adj.adjudicate(gold_then, run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS)
    path = scratch_path(spark, "published")
    publish(done, path)
    return read_or_empty(spark, path, done.schema)


def q_resume_remaining(spark, sf):
    from ..streaming.resume import resume_batch

    gold, _ = _gold(spark, sf)
    published = _published_earlier(spark, sf)
    remaining, _ = resume_batch(gold, published, run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS)
    return _flatten_payload(remaining)


def q_resume_total(spark, sf):
    from ..streaming.resume import resume_batch

    gold, _ = _gold(spark, sf)
    published = _published_earlier(spark, sf)
    remaining, _ = resume_batch(gold, published, run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS)
    return _flatten_payload(published.unionByName(remaining))


def q_availablenow_adjudicated(spark, sf):
    from ..streaming.resume import adjudicate_available_now

    gold, _ = _gold(spark, sf)
    gold_path = scratch_path(spark, "gold")
    gold.write.parquet(gold_path)
    # some ids come again in a later file
    gold.where(F.substring("transaction_hash_id", 1, 1) == "5").write.mode("append").parquet(gold_path)
    out = scratch_path(spark, "streamed")
    adjudicate_available_now(spark, gold_path, out, scratch_path(spark, "stream-ckpt"),
                             run_id=RUN_ID, snapshot_ts=SNAPSHOT_TS, max_files_per_trigger=2)
    return _flatten_payload(spark.read.parquet(out))


def q_results_json(spark, sf):
    valid, _ = _adjudicated(spark, sf)
    path = scratch_path(spark, "results-json")
    dump_json(valid, path)
    return _flatten_payload(spark.read.schema(valid.schema).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(path))


def _medallion(spark, sf):
    out = scratch_path(spark, "medallion")
    kpi = run_medallion(spark, ledger_dump_path_for(spark, sf), out, strict=True)
    return out, kpi


def ledger_dump_path_for(spark, sf):
    from .dumps import ledger_dump_path
    return ledger_dump_path(spark, sf, CORRUPT_EVERY)


def q_medallion_run(spark, sf):
    _, kpi = _medallion(spark, sf)
    cols = ["ingested", "structural_rejects", "malformed_rejects", "semantic_rejects", "delivered",
            "hub_customer", "lnk_transaction", "sat_account_state"]
    return spark.createDataFrame([tuple(int(kpi[c]) for c in cols)], ", ".join(f"{c} long" for c in cols))


def q_layer_audit(spark, sf):
    out, _ = written_medallion(spark, sf)
    p = layer_paths(out)
    audit = layer_audit(spark, [
        ("BRONZE LAYER", p["bronze"]),
        ("GOLD LAYER", p["gold"]),
        ("STRUCTURAL DLQ", p["dlq/structural"]),
        ("SEMANTIC DLQ", p["dlq/semantic"]),
        ("MISSING LAYER", p["bronze"] + "-missing"),
    ])
    return audit.drop("path")


QUERIES: dict[str, Query] = {
    "bronze_valid": q_bronze_valid,
    "dlq_structural": q_dlq_structural,
    "comp3_lenient": q_comp3_lenient,
    "comp3_strict": q_comp3_strict,
    "comp3_encode_hex": q_comp3_encode_hex,
    "ebcdic_roundtrip": q_ebcdic_roundtrip,
    "malformed_balance": q_malformed_balance,
    "producer_dlq_union": q_producer_dlq_union,
    "hub_customer": q_hub_customer,
    "lnk_transaction": q_lnk_transaction,
    "sat_account_state": q_sat_account_state,
    "vault_join": q_vault_join,
    "vault_join_salted": q_vault_join_salted,
    "vault_gold": q_vault_gold,
    "dlq_read": q_dlq_read,
    "risk_bucket": q_risk_bucket,
    "gold_product": q_gold_product,
    "dlq_semantic": q_dlq_semantic,
    "masking": q_masking,
    "contract_rules": q_contract_rules,
    "route_records": q_route_records,
    "kpi_report": q_kpi_report,
    "structural_metrics": q_structural_metrics,
    "adjudicate_labels": q_adjudicate_labels,
    "rationale_by_label": q_rationale_by_label,
    "rationale_json_defaults": q_rationale_json_defaults,
    "binaryfile_scan": q_binaryfile_scan,
    "adjudicated": q_adjudicated,
    "adjudication_rejects": q_adjudication_rejects,
    "ordered_ids": q_ordered_ids,
    "ordered_parts": q_ordered_parts,
    "layers_by_run": q_layers_by_run,
    "contract_enforced": q_contract_enforced,
    "adjudication_all_failures": q_adjudication_all_failures,
    "adjudicate_one": q_adjudicate_one,
    "score_requests": q_score_requests,
    "resume_remaining": q_resume_remaining,
    "resume_total": q_resume_total,
    "availablenow_adjudicated": q_availablenow_adjudicated,
    "results_json": q_results_json,
    "medallion_run": q_medallion_run,
    "layer_audit": q_layer_audit,
}


# ------------------------------------------------------------ oracle side

def _ebcdic_hex_map() -> str:
    """DuckDB MAP from each Latin-1 character to its cp500 byte in hex, built from the codec."""
    raw = bytes(range(256))
    text = raw.decode(LEDGER_LAYOUT.codepage)
    entries = []
    for byte, ch in zip(raw, text):
        if ch in ("'",):
            key = "''''"
        elif 32 <= ord(ch) < 127 or ord(ch) >= 160:
            key = "'" + ch + "'"
        else:
            key = f"chr({ord(ch)})"
        entries.append(f"{key}: '{byte:02X}'")
    return "MAP {" + ", ".join(entries) + "}"


def _adjudication_ctes(labeled: str = "labeled", suffix: str = "") -> str:
    """dim / dim2 / adjudicated CTEs over a labelled set (suffix names a second copy)."""
    return f"""
dim{suffix} AS (
  SELECT adjudication_label, min(transaction_hash_id) AS first_transaction_id,
         arg_min(calculated_risk, transaction_hash_id) AS calculated_risk
  FROM {labeled} GROUP BY adjudication_label),
dim2{suffix} AS (
  SELECT *, CASE WHEN calculated_risk < 0.5 THEN CAST(0.965 AS DOUBLE) ELSE CAST(0.85 AS DOUBLE) END AS semantic_confidence,
         printf('Heuristic fallback applied for risk level %.2f.', calculated_risk) AS rationale
  FROM dim{suffix}),
adjudicated{suffix} AS (
  SELECT l.transaction_hash_id AS transaction_id, l.calculated_risk AS risk_score, l.adjudication_label,
         CAST(round(CAST(0.6 AS DOUBLE) * l.structural_confidence + CAST(0.4 AS DOUBLE) * d.semantic_confidence, 3) AS DOUBLE)
           AS confidence_score,
         d.rationale AS adjudication_rationale,
         'v3.1.0-sovereign-xai' AS model_version,
         'graph-ctx-' || substr(sha256('{RUN_ID}' || l.transaction_hash_id), 1, 12) AS graph_context_id,
         {SNAPSHOT_SQL} AS source_snapshot_ts,
         'AML_2026_SOVEREIGN' AS compliance_tag,
         l.o_orderdate
  FROM {labeled} l JOIN dim2{suffix} d USING (adjudication_label))"""


_BRIDGE = f"""
src AS (
  SELECT o_orderkey, o_orderdate,
         'T' || lpad(CAST(o_orderkey AS VARCHAR), 11, '0') AS tx_id,
         CASE WHEN o_orderkey % {BLANK_EVERY} = 0 THEN repeat(' ', 10)
              ELSE 'C' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS cust_id,
         CAST(round(o_totalprice * 100) AS BIGINT) * (CASE WHEN o_orderkey % {NEGATIVE_EVERY} = 0 THEN -1 ELSE 1 END) AS cents,
         CASE WHEN o_orderstatus = 'P' THEN 'SUSPEND' ELSE 'ACTIVE' END AS tx_status,
         o_orderkey % {CORRUPT_EVERY} = 0 AS corrupt
  FROM orders),
enc AS (
  SELECT *, lpad(CAST(abs(cents) AS VARCHAR), 9, '0') || CASE WHEN cents < 0 THEN 'D' ELSE 'C' END AS bal_hex,
         CAST(cents AS DOUBLE) / 100.0 AS balance
  FROM src),
bronze AS (SELECT * FROM enc WHERE trim(cust_id) <> '' AND tx_id IS NOT NULL),
structural AS (SELECT * FROM enc WHERE NOT (trim(cust_id) <> '' AND tx_id IS NOT NULL)),
silver AS (
  SELECT *, balance AS account_balance,
         CASE WHEN tx_status = 'ACTIVE' AND balance >= 0 THEN 'LOW' ELSE 'OUT_OF_BOUNDS' END AS risk_category
  FROM bronze),
gold AS (
  SELECT sha256(trim(tx_id)) AS transaction_hash_id, sha256(trim(cust_id)) AS masked_customer_id,
         account_balance, risk_category, o_orderdate
  FROM silver WHERE account_balance >= 0 AND risk_category IN ('LOW', 'MEDIUM', 'HIGH')),
scored AS (
  SELECT transaction_hash_id, o_orderdate,
         least(greatest(account_balance / CAST(300000.0 AS DOUBLE), CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS calculated_risk,
         CASE WHEN upper(risk_category) = 'LOW' THEN CAST(0.95 AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END AS structural_confidence
  FROM gold),
labeled AS (
  SELECT *, CASE WHEN calculated_risk > 0.8 THEN 'BLOCK' WHEN calculated_risk > 0.6 THEN 'REVIEW' ELSE 'APPROVE' END
         AS adjudication_label
  FROM scored),
{_adjudication_ctes()}
"""

_PAYLOAD = ("transaction_id, risk_score, adjudication_label, confidence_score, adjudication_rationale, "
            "model_version, graph_context_id, source_snapshot_ts, compliance_tag")

_NEG = "CONSUMER_VIOLATION: Negative Analytical Balance Value"
_SCOPE = "CONSUMER_VIOLATION: Risk Bound Assignment Out of Scope"
_MISSING = "PRODUCER_VIOLATION: Missing Core Banking Business Key"
_MALFORMED = "PRODUCER_VIOLATION: Malformed raw_balance"


def _w(body: str) -> str:
    return "WITH " + _BRIDGE + body


_LENIENT_CORRUPT = ("(CASE WHEN corrupt THEN CAST(1500000000 + abs(cents) % 100000000 AS DOUBLE) "
                    "ELSE CAST(abs(cents) AS DOUBLE) END) * (CASE WHEN cents < 0 THEN -1.0 ELSE 1.0 END) / 100.0")
_RAW_HEX_CORRUPT = "CASE WHEN corrupt THEN 'F' || substr(bal_hex, 2) ELSE bal_hex END"

_EARLIER = (f", labeled_e AS (SELECT * FROM labeled WHERE o_orderdate < TIMESTAMP '{EARLIER_SNAPSHOT} 00:00:00'), "
            + _adjudication_ctes("labeled_e", "_e") + " ")

ORACLE_SQL: dict[str, str] = {
    "bronze_valid": _w("SELECT tx_id, cust_id, bal_hex AS raw_balance_hex, tx_status FROM bronze"),
    "dlq_structural": _w(f"SELECT tx_id, cust_id, bal_hex AS raw_balance_hex, tx_status, '{_MISSING}' AS rejection_reason "
                         "FROM structural"),
    "comp3_lenient": _w(f"SELECT tx_id, {_LENIENT_CORRUPT} AS balance FROM bronze"),
    "comp3_strict": _w("SELECT tx_id, CASE WHEN corrupt THEN NULL ELSE CAST(balance AS DECIMAL(9,2)) END AS balance "
                       "FROM bronze"),
    "comp3_encode_hex": _w(
        "SELECT o_orderkey, bal_hex AS packed_hex FROM enc JOIN orders USING (o_orderkey)"),
    "ebcdic_roundtrip": (
        "SELECT c_custkey, array_to_string(list_transform(string_split(c_name, ''), lambda x: "
        + _ebcdic_hex_map() + "[x]), '') AS c_name_ebcdic_hex, c_name, c_mktsegment FROM customer"),
    "malformed_balance": _w(f"SELECT tx_id, cust_id, {_RAW_HEX_CORRUPT} AS raw_balance_hex, tx_status, "
                            f"'{_MALFORMED}' AS rejection_reason FROM bronze WHERE corrupt"),
    "producer_dlq_union": _w(
        f"SELECT tx_id, {_RAW_HEX_CORRUPT} AS raw_balance_hex, CAST(NULL AS DOUBLE) AS unpacked_balance, "
        f"'{_MISSING}' AS rejection_reason FROM structural "
        f"UNION ALL SELECT tx_id, {_RAW_HEX_CORRUPT}, CAST(NULL AS DOUBLE), '{_MALFORMED}' FROM bronze WHERE corrupt"),
    "hub_customer": _w("SELECT DISTINCT sha256(trim(cust_id)) AS customer_hash_key, trim(cust_id) AS source_cust_id "
                       "FROM bronze"),
    "lnk_transaction": _w(
        "SELECT DISTINCT sha256(concat_ws('||', trim(tx_id), trim(cust_id))) AS transaction_link_hash_key, "
        "sha256(trim(cust_id)) AS customer_hash_key, trim(tx_id) AS source_tx_id FROM bronze"),
    "sat_account_state": _w(
        "SELECT DISTINCT sha256(concat_ws('||', trim(tx_id), trim(cust_id))) AS transaction_link_hash_key, "
        "balance AS account_balance, trim(tx_status) AS ledger_status FROM bronze"),
    "vault_join": _w(
        "SELECT DISTINCT sha256(concat_ws('||', trim(tx_id), trim(cust_id))) AS transaction_link_hash_key, "
        "sha256(trim(cust_id)) AS customer_hash_key, trim(tx_id) AS source_tx_id, trim(cust_id) AS source_cust_id, "
        "CAST(balance AS DECIMAL(9,2)) AS account_balance, trim(tx_status) AS ledger_status FROM bronze WHERE NOT corrupt"),
    "vault_gold": _w("SELECT g.transaction_hash_id, g.masked_customer_id, g.account_balance, g.risk_category "
                     "FROM gold g JOIN bronze b ON g.transaction_hash_id = sha256(trim(b.tx_id)) WHERE NOT b.corrupt"),
    "dlq_read": _w(
        f"SELECT tx_id, {_RAW_HEX_CORRUPT} AS raw_balance_hex, CAST(NULL AS DOUBLE) AS unpacked_balance, "
        f"'{_MISSING}' AS rejection_reason FROM structural "
        f"UNION ALL SELECT tx_id, {_RAW_HEX_CORRUPT}, CAST(NULL AS DOUBLE), '{_MALFORMED}' FROM bronze WHERE corrupt"),
    "risk_bucket": _w("SELECT tx_id, account_balance, risk_category FROM silver"),
    "gold_product": _w("SELECT transaction_hash_id, masked_customer_id, account_balance, risk_category FROM gold"),
    "dlq_semantic": _w(
        "SELECT tx_id, cust_id, bal_hex AS raw_balance_hex, tx_status, account_balance, tx_id AS transaction_hash_id, "
        f"cust_id AS masked_customer_id, risk_category, CASE WHEN account_balance < 0 THEN '{_NEG}' ELSE '{_SCOPE}' END "
        "AS rejection_reason FROM silver WHERE NOT (account_balance >= 0 AND risk_category IN ('LOW', 'MEDIUM', 'HIGH'))"),
    "masking": "SELECT c_custkey, sha256(trim(c_name)) AS c_name, sha256(trim(c_mktsegment)) AS c_mktsegment, c_acctbal "
               "FROM customer",
    "contract_rules": (
        "SELECT c_custkey, CASE "
        "WHEN c_custkey IS NULL THEN 'CONTRACT_VIOLATION: c_custkey is null' "
        "WHEN c_name IS NULL THEN 'CONTRACT_VIOLATION: c_name is null' "
        "WHEN NOT coalesce(length(c_name) <= 18, true) THEN 'CONTRACT_VIOLATION: c_name longer than 18' "
        "WHEN NOT coalesce(c_acctbal BETWEEN 0.0 AND 9999.99 AND NOT isnan(c_acctbal), false) "
        "THEN 'CONTRACT_VIOLATION: c_acctbal outside [0.0, 9999.99]' "
        "WHEN NOT coalesce(c_mktsegment IS NULL OR c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'), false) "
        "THEN 'CONTRACT_VIOLATION: c_mktsegment not in allowed values' END AS rejection_reason FROM customer"),
    "route_records": _w(
        "SELECT tx_id, CASE WHEN NOT (trim(cust_id) <> '' AND tx_id IS NOT NULL) THEN 'structural' "
        "WHEN corrupt THEN 'malformed' "
        "WHEN NOT (balance >= 0 AND tx_status = 'ACTIVE') THEN 'semantic' ELSE 'gold' END AS stage, "
        f"CASE WHEN NOT (trim(cust_id) <> '' AND tx_id IS NOT NULL) THEN '{_MISSING}' "
        f"WHEN corrupt THEN '{_MALFORMED}' WHEN balance < 0 THEN '{_NEG}' "
        f"WHEN tx_status <> 'ACTIVE' THEN '{_SCOPE}' END AS rejection_reason FROM enc"),
    "kpi_report": _w(
        "SELECT count(*) AS ingested, "
        "count_if(NOT (trim(cust_id) <> '' AND tx_id IS NOT NULL)) AS structural_rejects, "
        "count_if(trim(cust_id) <> '' AND corrupt) AS malformed_rejects, "
        "count_if(trim(cust_id) <> '' AND NOT corrupt AND NOT (balance >= 0 AND tx_status = 'ACTIVE')) AS semantic_rejects, "
        "count_if(trim(cust_id) <> '' AND NOT corrupt AND balance >= 0 AND tx_status = 'ACTIVE') AS delivered, "
        "CAST(100.0 AS DOUBLE) AS survival_pct, true AS conserved FROM enc"),
    "structural_metrics": _w("SELECT transaction_hash_id, calculated_risk, structural_confidence FROM scored"),
    "adjudicate_labels": _w(
        "SELECT transaction_hash_id, calculated_risk, adjudication_label, "
        "CASE WHEN calculated_risk > 0.9 THEN 'BLOCK' WHEN calculated_risk > 0.7 THEN 'REVIEW' ELSE 'APPROVE' END "
        "AS request_label FROM labeled"),
    "rationale_by_label": _w(
        "SELECT adjudication_label, first_transaction_id, calculated_risk, semantic_confidence, rationale FROM dim2"),
    "adjudicated": _w(f"SELECT {_PAYLOAD} FROM adjudicated"),
    "rationale_json_defaults": _w(
        "SELECT adjudication_label, first_transaction_id, calculated_risk, "
        "CASE WHEN adjudication_label = 'BLOCK' THEN CAST(0.5 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END AS semantic_confidence, "
        "CASE WHEN adjudication_label = 'BLOCK' THEN 'No reasoning provided.' ELSE 'label ' || adjudication_label END "
        "AS rationale FROM dim"),
    "binaryfile_scan": _w("SELECT tx_id, cust_id, bal_hex AS raw_balance_hex, tx_status FROM bronze"),
    "adjudication_rejects": _w(
        ", faulty AS (SELECT transaction_hash_id AS id, risk_category, CASE left(transaction_hash_id, 1) WHEN '0' THEN NULL "
        "WHEN '1' THEN CAST('NaN' AS DOUBLE) ELSE account_balance END AS balance FROM gold "
        "UNION ALL SELECT transaction_hash_id, risk_category, NULL FROM gold WHERE left(transaction_hash_id, 1) = '2' "
        "UNION ALL SELECT transaction_hash_id, risk_category, account_balance + 1000 FROM gold WHERE left(transaction_hash_id, 1) = '3'), "
        "good AS (SELECT id, min(risk_category) AS risk_category, "
        "min(balance) FILTER (WHERE balance IS NOT NULL AND NOT isnan(balance)) AS balance FROM faulty GROUP BY id), "
        "risks AS (SELECT *, least(greatest(balance / CAST(300000.0 AS DOUBLE), CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS risk FROM good) "
        "SELECT id AS transaction_id, CASE WHEN balance IS NOT NULL THEN risk END AS risk_score, "
        "CASE WHEN balance IS NOT NULL THEN 'BLOCK' END AS adjudication_label, "
        "CASE WHEN balance IS NOT NULL THEN CAST(round(CAST(0.6 AS DOUBLE) * CASE WHEN risk_category = 'LOW' THEN CAST(0.95 AS DOUBLE) "
        "ELSE CAST(0.75 AS DOUBLE) END + CAST(0.4 AS DOUBLE) * 2, 3) AS DOUBLE) END AS confidence_score, "
        "CASE WHEN balance IS NULL THEN 'CONTRACT_VIOLATION: missing required field' "
        "ELSE 'CONTRACT_VIOLATION: confidence_score outside [0.0, 1.0]' END AS rejection_reason "
        "FROM risks WHERE balance IS NULL OR risk > 0.8"),
    "ordered_ids": _w("SELECT transaction_hash_id FROM gold ORDER BY transaction_hash_id"),
    "adjudicate_one": _w(
        ", mine AS (SELECT * FROM labeled WHERE transaction_hash_id = (SELECT max(transaction_hash_id) FROM labeled)), "
        + _adjudication_ctes("mine", "_m") + f" SELECT {_PAYLOAD}, CAST(NULL AS VARCHAR) AS rejection_reason FROM adjudicated_m "
        "UNION ALL SELECT 'absent', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'transaction id is missing from gold'"),
    "results_json": _w(f"SELECT {_PAYLOAD} FROM adjudicated"),
    "score_requests": (
        "WITH req AS (SELECT sha256(CAST(event_id AS VARCHAR)) AS transaction_id, value / 300.0 AS risk_score, "
        "CAST(event_id % 110 AS DOUBLE) / 100.0 AS confidence_score FROM events) "
        "SELECT transaction_id, risk_score, "
        "CASE WHEN risk_score > 0.9 THEN 'BLOCK' WHEN risk_score > 0.7 THEN 'REVIEW' ELSE 'APPROVE' END AS adjudication_label, "
        "confidence_score, CAST(NULL AS VARCHAR) AS adjudication_rationale, 'v2.0.0' AS model_version, "
        f"'graph-ctx-' || substr(sha256('{RUN_ID}'), 1, 12) AS graph_context_id, {SNAPSHOT_SQL} AS source_snapshot_ts, "
        "'AML_2026' AS compliance_tag, "
        "CASE WHEN risk_score BETWEEN 0 AND 1 AND confidence_score BETWEEN 0 AND 1 THEN 201 ELSE 400 END AS status_code, "
        "concat_ws('; ', CASE WHEN NOT (risk_score BETWEEN 0 AND 1) THEN 'CONTRACT_VIOLATION: risk_score outside [0.0, 1.0]' END, "
        "CASE WHEN NOT (confidence_score BETWEEN 0 AND 1) THEN 'CONTRACT_VIOLATION: confidence_score outside [0.0, 1.0]' END) "
        "AS failure_list FROM req"),
    "resume_remaining": _w(f"{_EARLIER} SELECT {_PAYLOAD} FROM adjudicated WHERE transaction_id NOT IN "
                           "(SELECT transaction_id FROM adjudicated_e)"),
    "resume_total": _w(f"{_EARLIER} SELECT {_PAYLOAD} FROM adjudicated_e UNION ALL SELECT {_PAYLOAD} FROM adjudicated "
                       "WHERE transaction_id NOT IN (SELECT transaction_id FROM adjudicated_e)"),
    "availablenow_adjudicated": _w(f"SELECT {_PAYLOAD} FROM adjudicated"),
    "medallion_run": _w(
        "SELECT count(*) AS ingested, "
        "count_if(NOT (trim(cust_id) <> '' AND tx_id IS NOT NULL)) AS structural_rejects, "
        "count_if(trim(cust_id) <> '' AND corrupt) AS malformed_rejects, "
        "count_if(trim(cust_id) <> '' AND NOT corrupt AND NOT (balance >= 0 AND tx_status = 'ACTIVE')) AS semantic_rejects, "
        "count_if(trim(cust_id) <> '' AND NOT corrupt AND balance >= 0 AND tx_status = 'ACTIVE') AS delivered, "
        "count(DISTINCT CASE WHEN trim(cust_id) <> '' AND NOT corrupt THEN trim(cust_id) END) AS hub_customer, "
        "count_if(trim(cust_id) <> '' AND NOT corrupt) AS lnk_transaction, "
        "count_if(trim(cust_id) <> '' AND NOT corrupt) AS sat_account_state FROM enc"),
    "layer_audit": _w(
        "SELECT 'BRONZE LAYER' AS layer, 'parquet' AS format, 'ok' AS status, count(*) AS row_count FROM bronze "
        "UNION ALL SELECT 'GOLD LAYER', 'parquet', 'ok', count_if(NOT corrupt AND balance >= 0 AND tx_status = 'ACTIVE') FROM bronze "
        "UNION ALL SELECT 'STRUCTURAL DLQ', 'json', 'ok', count_if(NOT (trim(cust_id) <> '') OR corrupt) FROM enc "
        "UNION ALL SELECT 'SEMANTIC DLQ', 'json', 'ok', count_if(NOT corrupt AND NOT (balance >= 0 AND tx_status = 'ACTIVE')) FROM bronze "
        "UNION ALL SELECT 'MISSING LAYER', NULL, 'inaccessible', NULL"),
}
ORACLE_SQL["vault_join_salted"] = ORACLE_SQL["vault_join"]
ORACLE_SQL["ordered_parts"] = _w(
    f", placed AS (SELECT transaction_hash_id AS id, (row_number() OVER (ORDER BY transaction_hash_id) - 1) // {ORDERED_ROWS} AS part "
    "FROM gold WHERE transaction_hash_id NOT IN (SELECT sha256(trim(tx_id)) FROM bronze WHERE corrupt)) "
    "SELECT part, min(id) AS first_id, max(id) AS last_id, count(*) AS rows FROM placed GROUP BY part")
_COUNTS = ("(SELECT count(*) FROM bronze) AS bronze, count_if({0} AND balance >= 0 AND tx_status = 'ACTIVE') AS gold, "
           "count_if({0}) AS lnk, count_if({0} AND NOT (balance >= 0 AND tx_status = 'ACTIVE')) AS semantic FROM decoded")
ORACLE_SQL["layers_by_run"] = _w(
    f", decoded AS (SELECT tx_status, corrupt, {_LENIENT_CORRUPT} AS balance FROM bronze), "
    f"wide AS (SELECT 'lenient' AS run, {_COUNTS.format('true')} UNION ALL SELECT 'strict', {_COUNTS.format('NOT corrupt')} "
    f"UNION ALL SELECT 'last', {_COUNTS.format('NOT corrupt')}) "
    "SELECT run, layer, row_count FROM (UNPIVOT wide ON bronze, gold, lnk, semantic INTO NAME layer VALUE row_count)")
ORACLE_SQL["contract_enforced"] = (
    "WITH raw AS (SELECT 'T' || lpad(CAST(o_orderkey AS VARCHAR), 11, '0') || CASE WHEN o_orderkey % 7 = 0 THEN 'XYZ' ELSE '' END AS order_ref, "
    "CASE WHEN o_orderkey % 11 = 0 THEN 'unknown' ELSE CAST(o_custkey AS VARCHAR) END AS customer, "
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS total, "
    "o_orderkey % 13 = 0 AS bad_total, o_orderstatus AS status FROM orders) "
    "SELECT order_ref, customer, total, CASE WHEN length(order_ref) > 12 THEN 'CONTRACT_VIOLATION: order_ref longer than 12' "
    "WHEN TRY_CAST(customer AS BIGINT) IS NULL THEN 'CONTRACT_VIOLATION: customer is not a bigint' "
    "WHEN bad_total THEN 'CONTRACT_VIOLATION: total is not a double' "
    "WHEN NOT coalesce(total BETWEEN 0 AND 300000, false) THEN 'CONTRACT_VIOLATION: total outside [0.0, 300000.0]' "
    "WHEN status NOT IN ('F', 'O') THEN 'CONTRACT_VIOLATION: status not in allowed values' END AS rejection_reason FROM raw")
ORACLE_SQL["adjudication_all_failures"] = _w(
    "SELECT transaction_hash_id AS transaction_id, 'CONTRACT_VIOLATION: missing required field; "
    "CONTRACT_VIOLATION: risk_score outside [0.0, 1.0]; CONTRACT_VIOLATION: confidence_score outside [0.0, 1.0]' AS failure_list "
    "FROM gold WHERE left(transaction_hash_id, 1) IN ('0', '1')")
