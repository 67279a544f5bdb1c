"""Record-preserving split (F10): every input row lands in exactly one output.

A rule is a named predicate that must hold. The first failing rule gives a
row its rejection reason. A NULL predicate counts as a failure, so SQL's
three-valued logic can never make a row vanish from both sides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "rejection_reason"


@dataclass(frozen=True)
class Rule:
    name: str
    reason: str
    ok: Column  # true = the row passes

    def fails(self) -> Column:
        return ~F.coalesce(self.ok, F.lit(False))


def reason_column(rules: list[Rule]) -> Column:
    """First failing rule's reason, NULL when every rule holds."""
    if not rules:
        return F.lit(None).cast("string")
    expr = None
    for rule in rules:
        expr = F.when(rule.fails(), F.lit(rule.reason)) if expr is None else expr.when(rule.fails(), F.lit(rule.reason))
    return expr


def failures_column(rules: list[Rule]) -> Column:
    """The reasons of all rules that fail, in order; empty when every rule holds."""
    if not rules:
        return F.array().cast("array<string>")
    return F.filter(F.array(*[F.when(r.fails(), F.lit(r.reason)) for r in rules]), lambda x: x.isNotNull())


def passes(rules: list[Rule]) -> Column:
    """True when every rule holds (never NULL)."""
    out = F.lit(True)
    for rule in rules:
        out = out & F.coalesce(rule.ok, F.lit(False))
    return out


def with_reason(df: DataFrame, rules: list[Rule], reason_col: str = REASON) -> DataFrame:
    return df.withColumn(reason_col, reason_column(rules))


def split(df: DataFrame, rules: list[Rule], reason_col: str = REASON) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects): valid keeps the input columns, rejects add ``reason_col``."""
    valid = df.filter(passes(rules))
    rejects = df.filter(~passes(rules)).withColumn(reason_col, reason_column(rules))
    return valid, rejects

