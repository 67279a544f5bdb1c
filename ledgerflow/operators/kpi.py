"""Routing in one pass, KPI report, conservation check and layer audit."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Contract, load_contract
from ..functions.codec import comp3_decode
from ..layout import LEDGER_LAYOUT, RecordLayout
from ..sources.tables import hadoop_path, path_exists
from .bronze import parse_records, record_length_rule, structural_rules
from .product import risk_bucket, semantic_rules
from .split import reason_column
from .vault import balance_rules

STAGES = ("structural", "malformed", "semantic", "gold")


def route_records(raw: DataFrame, strict: bool = False, contract: Contract | str | dict = "consumer",
                  layout: RecordLayout = LEDGER_LAYOUT, check_length: bool = False,
                  producer: Contract | str | dict | None = "producer") -> DataFrame:
    """Every record with its decoded fields, its ``stage`` (where it ends up) and
    ``rejection_reason``. The same rules as the layer operators, evaluated once.
    ``check_length`` rejects records that are not of full width."""
    allowed = load_contract(contract).allowed_values("risk_category") or []
    decoded = parse_records(raw, layout, keep=["raw_bytes"] if check_length else None).withColumn(
        "unpacked_balance", comp3_decode(F.col("raw_balance"), strict=strict))
    structural = reason_column(([record_length_rule(layout)] if check_length else []) + structural_rules(producer))
    malformed = reason_column(balance_rules())
    product = decoded.withColumns({
        "account_balance": F.col("unpacked_balance"),
        "risk_category": risk_bucket("tx_status", "unpacked_balance"),
    })
    semantic = reason_column(semantic_rules(allowed))
    stage = (F.when(structural.isNotNull(), F.lit("structural"))
              .when(malformed.isNotNull(), F.lit("malformed"))
              .when(semantic.isNotNull(), F.lit("semantic"))
              .otherwise(F.lit("gold")))
    return product.withColumns({"stage": stage, "rejection_reason": F.coalesce(structural, malformed, semantic)}).drop("raw_bytes")


def stage_counts(routed: DataFrame) -> list[Column]:
    """All layer counts as aggregate expressions for one pass (or an ``Observation``)."""
    s = F.col("stage")
    return [
        F.count(F.lit(1)).alias("ingested"),
        F.count_if(s == "structural").alias("structural_rejects"),
        F.count_if(s == "malformed").alias("malformed_rejects"),
        F.count_if(s == "semantic").alias("semantic_rejects"),
        F.count_if(s == "gold").alias("delivered"),
    ]


def kpi_report(routed: DataFrame) -> DataFrame:
    """A1/A2: one row of counts plus the survival rate, computed rather than asserted."""
    counts = routed.agg(*stage_counts(routed))
    return with_survival(counts)


def with_survival(counts: DataFrame) -> DataFrame:
    accounted = (F.col("delivered") + F.col("structural_rejects") + F.col("malformed_rejects")
                 + F.col("semantic_rejects"))
    return counts.withColumns({
        "survival_pct": F.when(F.col("ingested") > 0, F.lit(100.0) * accounted / F.col("ingested")),
        "conserved": accounted == F.col("ingested"),
    })


def assert_conserved(kpi: dict) -> None:
    """A3: ingested = delivered + every kind of reject."""
    accounted = kpi["delivered"] + kpi["structural_rejects"] + kpi["malformed_rejects"] + kpi["semantic_rejects"]
    if accounted != kpi["ingested"]:
        raise AssertionError(f"records lost: ingested {kpi['ingested']}, accounted {accounted}")


AUDIT_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("format", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
])


def check_layer(spark: SparkSession, name: str, path: str, formats: tuple[str, ...] = ("parquet", "json"),
                where: str | None = None) -> tuple:
    """A4: count a layer, trying each format in turn; "inaccessible" when none loads.
    A format whose extension appears among the layer's files is tried first."""
    if not path_exists(spark, path):
        return (name, path, None, "inaccessible", None)
    formats = tuple(sorted(formats, key=lambda f: not _has_files_like(spark, path, f)))
    for fmt in formats:
        try:
            df = spark.read.format(fmt).load(path)
            if where:
                df = df.where(where)
            return (name, path, fmt, "ok", df.count())
        except AnalysisException:  # no such path, or not of this format; any other failure is the caller's to see
            continue
    return (name, path, None, "inaccessible", None)


def _has_files_like(spark: SparkSession, path: str, fmt: str) -> bool:
    try:
        fs, hpath = hadoop_path(spark, path)
        if not fs.exists(hpath):
            return False
        return any(f".{fmt}" in str(s.getPath().getName()) for s in fs.listStatus(hpath))
    except Exception:  # noqa: BLE001 - sniffing is only an ordering hint
        return False


def layer_audit(spark: SparkSession, layers: list[tuple[str, str]] | list[tuple[str, str, str]]) -> DataFrame:
    """A4 over several layers -> DataFrame(layer, path, format, status, row_count)."""
    rows = [check_layer(spark, *layer[:2], where=layer[2] if len(layer) > 2 else None) for layer in layers]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)
