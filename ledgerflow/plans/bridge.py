"""Bridge from the TPC-H-like ``orders`` table to 35-byte ledger records.

Each order becomes one record; anomalies are injected by key so every stage
of the pipeline has something to route:

* ``o_orderkey % blank_every == 0``: blank customer id (structural reject)
* ``o_orderkey % negative_every == 0``: negative balance (semantic reject)
* ``o_orderkey % corrupt_every == 0``: first digit nibble set to ``F``
  (malformed under the strict decoder), off unless asked for
* ``o_orderstatus = 'P'`` maps to status ``SUSPEND`` (out of bounds), else ``ACTIVE``

The records are built with column expressions only, one row in, one row out,
so the bridge scales with ``orders`` and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codec import comp3_encode, encode_text_field, make_id
from ..layout import LEDGER_LAYOUT, RecordLayout

# Bridge id formats and anomaly cadence.
TX_PREFIX = "T"
CUST_PREFIX = "C"
BLANK_EVERY = 250
NEGATIVE_EVERY = 333
CORRUPT_EVERY = 499


def ledger_fields(orders: DataFrame, blank_every: int = BLANK_EVERY, negative_every: int = NEGATIVE_EVERY,
                  layout: RecordLayout = LEDGER_LAYOUT) -> DataFrame:
    """Clear-text ledger fields for each order: tx_id, cust_id, cents, tx_status."""
    key = F.col("o_orderkey")
    tx_width = layout.field("tx_id").length - len(TX_PREFIX)
    cust_len = layout.field("cust_id").length
    cust_width = cust_len - len(CUST_PREFIX)
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return orders.select(
        key.alias("o_orderkey"),
        make_id(TX_PREFIX, key, tx_width).alias("tx_id"),
        F.when(key % blank_every == 0, F.lit(" " * cust_len))
         .otherwise(make_id(CUST_PREFIX, F.col("o_custkey"), cust_width)).alias("cust_id"),
        F.when(key % negative_every == 0, -cents).otherwise(cents).alias("cents"),
        F.when(F.col("o_orderstatus") == "P", F.lit("SUSPEND")).otherwise(F.lit("ACTIVE")).alias("tx_status"),
    )


def corrupt_first_digit(balance: Column) -> Column:
    """Overwrite the first digit nibble with ``F`` (an invalid decimal digit)."""
    return F.unhex(F.concat(F.lit("F"), F.substring(F.hex(balance), 2, 1000)))


def encode_records(fields: DataFrame, layout: RecordLayout = LEDGER_LAYOUT, units: str = "cents",
                   corrupt: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """Clear-text fields -> ``raw_bytes`` per the layout (K10). Text fields are
    space-padded; a value wider than its field fails the job."""
    parts = []
    for f in layout.fields:
        if f.kind == "text":
            parts.append(encode_text_field(F.col(f.name), f.length, layout.codepage, f.name))
        else:
            packed = comp3_encode(F.col(units), f.digits)
            if corrupt is not None:
                packed = F.when(corrupt, corrupt_first_digit(packed)).otherwise(packed)
            parts.append(packed)
    return fields.select(*(keep or []), F.concat(*parts).alias("raw_bytes"))


def orders_to_records(orders: DataFrame, blank_every: int = BLANK_EVERY, negative_every: int = NEGATIVE_EVERY,
                      corrupt_every: int | None = None, keep: list[str] | None = None) -> DataFrame:
    fields = ledger_fields(orders, blank_every, negative_every)
    corrupt = (F.col("o_orderkey") % corrupt_every == 0) if corrupt_every else None
    return encode_records(fields, corrupt=corrupt, keep=keep)
