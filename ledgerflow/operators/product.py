"""Gold: risk bucket, consumer gate, SHA-256 masking and the product projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import Contract, existing, load_contract
from .split import Rule, split

# Risk buckets, the status that qualifies, and consumer-side reasons.
RISK_LOW = "LOW"
RISK_OUT_OF_BOUNDS = "OUT_OF_BOUNDS"
ACTIVE_STATUS = "ACTIVE"
NEGATIVE_BALANCE_REASON = "CONSUMER_VIOLATION: Negative Analytical Balance Value"
OUT_OF_SCOPE_REASON = "CONSUMER_VIOLATION: Risk Bound Assignment Out of Scope"

GOLD_COLUMNS = ["transaction_hash_id", "masked_customer_id", "account_balance", "risk_category"]


def risk_bucket(status: str = "tx_status", balance: str = "account_balance") -> Column:
    """D3: ``LOW`` for an active, non-negative balance, else ``OUT_OF_BOUNDS``.
    A NULL status or balance takes the ``OUT_OF_BOUNDS`` branch."""
    low = (F.col(status) == F.lit(ACTIVE_STATUS)) & (F.col(balance) >= F.lit(0.0))
    return F.when(low, F.lit(RISK_LOW)).otherwise(F.lit(RISK_OUT_OF_BOUNDS))


def to_product_columns(df: DataFrame, balance: str = "unpacked_balance") -> DataFrame:
    """P5: copy ids into product columns, rename the balance in place, add the risk bucket."""
    renamed = df.withColumnRenamed(balance, "account_balance")
    return renamed.withColumns({
        "transaction_hash_id": F.col("tx_id"),
        "masked_customer_id": F.col("cust_id"),
        "risk_category": risk_bucket("tx_status", "account_balance"),
    })


def semantic_rules(allowed: list[str]) -> list[Rule]:
    """non-negative balance first, then an allowed risk bucket."""
    return [
        Rule("non_negative_balance", NEGATIVE_BALANCE_REASON, F.col("account_balance") >= F.lit(0.0)),
        Rule("risk_in_scope", OUT_OF_SCOPE_REASON, F.col("risk_category").isin(list(allowed))),
    ]


def apply_masking(df: DataFrame, policy: Contract | dict | list | str = "consumer") -> DataFrame:
    """Replace each policy target present in ``df`` by ``sha2(trim(c), 256)``.

    ``policy`` may be a contract, or the masking policy itself as a mapping
    or a one-element list holding one mapping.
    """
    if isinstance(policy, (dict, list)) and not (isinstance(policy, dict) and "data_security" in policy):
        targets = load_contract({"data_security": {"masking_policy": policy}}).masking_targets()
    else:
        targets = load_contract(policy).masking_targets()
    cols = existing(df, targets)
    if not cols:
        return df
    return df.withColumns({c: F.sha2(F.trim(F.col(c)), 256) for c in cols})


def gold_columns(df: DataFrame, contract: Contract | str | dict = "consumer") -> dict[str, Column]:
    """D4 + P9: the masked gold columns as expressions over valid product rows, for a sink that moves the clear rows."""
    targets = existing(df, load_contract(contract).masking_targets())
    columns = {c: F.sha2(F.trim(F.col(c)), 256) if c in targets else F.col(c) for c in GOLD_COLUMNS}
    return columns | {"account_balance": columns["account_balance"].cast("double")}


def project_gold(df: DataFrame) -> DataFrame:
    """P9. The balance is a double, as the contract says, whichever decoder made it."""
    return df.withColumn("account_balance", F.col("account_balance").cast("double")).select(*GOLD_COLUMNS)


def gate_gold(silver: DataFrame, contract: Contract | str | dict = "consumer",
              balance: str = "unpacked_balance") -> tuple[DataFrame, DataFrame]:
    """(valid product rows, semantic rejects), both with clear ids."""
    allowed = load_contract(contract).allowed_values("risk_category") or []
    return split(to_product_columns(silver, balance), semantic_rules(allowed))


def process_gold(silver: DataFrame, contract: Contract | str | dict = "consumer",
                 balance: str = "unpacked_balance", mask_rejects: bool = False) -> tuple[DataFrame, DataFrame]:
    """D5 (lazy): silver hand-off -> (gold product, semantic rejects).

    Rejects keep clear ids unless ``mask_rejects`` is set.
    """
    contract = load_contract(contract)
    valid, rejects = gate_gold(silver, contract, balance)
    gold = project_gold(apply_masking(valid, contract))
    if mask_rejects:
        rejects = apply_masking(rejects, contract)
    return gold, rejects
