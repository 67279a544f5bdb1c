"""Silver: COMP-3 decode, malformed-balance gate and the hashed Data Vault.

The hub, link and satellite are de-duplicated on their natural keys first and
hashed afterwards, so SHA-256 runs once per distinct key rather than once per
record, and the shuffle carries short keys instead of 64-character hashes.
The result equals hashing first and de-duplicating after, because each
hash is a function of the key it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codec import comp3_decode
from .split import Rule, split

# Producer-side rejection reason and the link-key separator.
MALFORMED_BALANCE_REASON = "PRODUCER_VIOLATION: Malformed raw_balance"
LINK_SEPARATOR = "||"


def customer_key() -> Column:
    return F.trim(F.col("cust_id"))


def link_key() -> Column:
    """Natural link key: trimmed tx id and customer id joined by ``||`` (NULLs skipped)."""
    return F.concat_ws(LINK_SEPARATOR, F.trim(F.col("tx_id")), F.trim(F.col("cust_id")))


def hash_key(c: Column) -> Column:
    return F.sha2(c, 256)


def with_balance(df: DataFrame, source: str = "raw_balance", out: str = "unpacked_balance",
                 strict: bool = False) -> DataFrame:
    """Add the decoded balance."""
    return df.withColumn(out, comp3_decode(F.col(source), strict=strict))


def balance_ok(c: str = "unpacked_balance") -> Column:
    """the balance decoded."""
    return F.col(c).isNotNull()


def balance_rules() -> list[Rule]:
    return [Rule("balance", MALFORMED_BALANCE_REASON, balance_ok())]


def hub_keys(df: DataFrame) -> DataFrame:
    """P6 + G1: one row per distinct customer business key."""
    return df.select(customer_key().alias("source_cust_id")).distinct()


def lnk_keys(df: DataFrame) -> DataFrame:
    """P7 + G1: one row per distinct (transaction, customer) relationship."""
    return df.select(F.trim(F.col("tx_id")).alias("source_tx_id"), customer_key().alias("_cust")).distinct()


def sat_keys(df: DataFrame, balance: str = "unpacked_balance") -> DataFrame:
    """P8 + G1: distinct (link, balance, status) states."""
    return df.select(
        link_key().alias("_link"),
        F.col(balance).alias("account_balance"),
        F.trim(F.col("tx_status")).alias("ledger_status"),
    ).distinct()


def vault_columns() -> dict[str, dict[str, Column]]:
    """The columns of each vault table, computed from its natural keys."""
    return {
        "hub_customer": {"customer_hash_key": hash_key(F.col("source_cust_id")), "source_cust_id": F.col("source_cust_id")},
        "lnk_transaction": {
            "transaction_link_hash_key": hash_key(F.concat_ws(LINK_SEPARATOR, F.col("source_tx_id"), F.col("_cust"))),
            "customer_hash_key": hash_key(F.col("_cust")),
            "source_tx_id": F.col("source_tx_id"),
        },
        "sat_account_state": {"transaction_link_hash_key": hash_key(F.col("_link")), "account_balance": F.col("account_balance"),
                              "ledger_status": F.col("ledger_status")},
    }


def process_silver(bronze: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """D2 (lazy): bronze -> (decoded rows for gold and the vault, malformed-balance rejects)."""
    unpacked = with_balance(bronze, strict=strict)
    return split(unpacked, balance_rules())


def vault_keys(silver: DataFrame) -> dict[str, DataFrame]:
    """The distinct natural keys of each vault table: what its rows are shuffled as."""
    return {"hub_customer": hub_keys(silver), "lnk_transaction": lnk_keys(silver), "sat_account_state": sat_keys(silver)}


def build_vault(silver: DataFrame) -> dict[str, DataFrame]:
    columns = vault_columns()
    return {name: keys.select(*[c.alias(n) for n, c in columns[name].items()]) for name, keys in vault_keys(silver).items()}


#: Bucket key of each vault table. The link and its satellite share theirs, so they join without a shuffle.
VAULT_KEYS = {"hub_customer": "customer_hash_key", "lnk_transaction": "transaction_link_hash_key",
              "sat_account_state": "transaction_link_hash_key"}
#: A hub of up to this many rows (of some 100 bytes) is broadcast.
BROADCAST_HUB_ROWS = 200_000
#: Parts that the transactions of one customer are dealt to when they meet a larger hub.
HUB_SALTS = 8


def vault_join(hub: DataFrame, lnk: DataFrame, sat: DataFrame, hub_rows: int | None = None) -> DataFrame:
    """Reassemble transactions from the vault (link ⋈ satellite ⋈ hub).

    The link and its satellite are the large sides and meet first, on the key that both are bucketed by: no exchange.
    The hub, one row per customer, is broadcast if ``hub_rows`` (the count its write returned) says that it is small.
    Otherwise every hub row stands in ``HUB_SALTS`` copies and the transactions are dealt to them, so a customer that
    holds a third of all transactions is spread over as many tasks.
    """
    states = lnk.join(sat, "transaction_link_hash_key")
    if hub_rows is not None and hub_rows <= BROADCAST_HUB_ROWS:
        joined = states.join(F.broadcast(hub), "customer_hash_key")
    else:
        copies = hub.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(HUB_SALTS - 1))))
        dealt = states.withColumn("_salt", F.pmod(F.xxhash64("transaction_link_hash_key"), F.lit(HUB_SALTS)).cast("int"))
        joined = dealt.join(copies, ["customer_hash_key", "_salt"])
    return joined.select("transaction_link_hash_key", "customer_hash_key", "source_tx_id",
                         "source_cust_id", "account_balance", "ledger_status")
