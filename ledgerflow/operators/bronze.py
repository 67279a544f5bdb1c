"""Bronze: slice and decode fixed-width records, gate on business keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import Contract, load_contract
from ..functions.codec import ebcdic_decode
from ..layout import LEDGER_LAYOUT, RecordLayout
from .split import Rule, split

# Producer-side rejection reasons.
MISSING_KEY_REASON = "PRODUCER_VIOLATION: Missing Core Banking Business Key"
SHORT_RECORD_REASON = "PRODUCER_VIOLATION: Truncated record"

BRONZE_COLUMNS = ["tx_id", "cust_id", "raw_balance", "tx_status"]


def slice_fields(df: DataFrame, layout: RecordLayout = LEDGER_LAYOUT, source: str = "raw_bytes",
                 keep: list[str] | None = None) -> DataFrame:
    """One binary column per layout field, cut by byte position."""
    cols = [F.substring(F.col(source), f.pos, f.length).alias(f.name) for f in layout.fields]
    return df.select(*(keep or []), *cols)


def decode_fields(df: DataFrame, layout: RecordLayout = LEDGER_LAYOUT) -> DataFrame:
    """Decode text fields from EBCDIC and trim the ones the layout marks.
    Packed-decimal fields stay binary until the silver layer."""
    exprs = []
    for name in df.columns:
        try:
            f = layout.field(name)
        except KeyError:
            exprs.append(F.col(name))
            continue
        if f.kind == "text":
            value = ebcdic_decode(F.col(name), layout.codepage)
            exprs.append((F.trim(value) if f.trim else value).alias(name))
        else:
            exprs.append(F.col(name))
    return df.select(*exprs)


def parse_records(df: DataFrame, layout: RecordLayout = LEDGER_LAYOUT, source: str = "raw_bytes",
                  keep: list[str] | None = None) -> DataFrame:
    """Slice + decode in a single projection."""
    return decode_fields(slice_fields(df, layout, source, keep), layout)


def structural_ok() -> Column:
    """the customer key is not blank and the transaction id is present.
    A blank (but non-NULL) ``tx_id`` passes, as in the legacy gate."""
    return (F.trim(F.col("cust_id")) != F.lit("")) & F.col("tx_id").isNotNull()


def structural_rules(contract: Contract | str | dict | None = "producer") -> list[Rule]:
    """the business key, then what the producer's contract declares (not-null, lengths, ranges, allowed values)."""
    declared = load_contract(contract).rules(prefix="PRODUCER_VIOLATION") if contract is not None else []
    return [Rule("business_key", MISSING_KEY_REASON, structural_ok()), *declared]


def record_length_rule(layout: RecordLayout = LEDGER_LAYOUT, source: str = "raw_bytes") -> Rule:
    """Optional rule for scans that keep ragged tails: the record must be full width."""
    return Rule("record_length", SHORT_RECORD_REASON, F.length(F.col(source)) == layout.record_length)


def process_bronze(raw: DataFrame, layout: RecordLayout = LEDGER_LAYOUT, source: str = "raw_bytes",
                   check_length: bool = False, contract: Contract | str | dict | None = "producer") -> tuple[DataFrame, DataFrame]:
    """D1 (lazy): raw records -> (bronze rows, structural rejects with reason)."""
    parsed = parse_records(raw, layout, source, keep=[source] if check_length else None)
    rules = ([record_length_rule(layout, source)] if check_length else []) + structural_rules(contract)
    valid, rejects = split(parsed, rules)
    if check_length:
        valid, rejects = valid.drop(source), rejects.drop(source)
    return valid, rejects
