"""Ledger dumps derived from the ``orders`` table, written once per session.

The check queries read a real fixed-width binary dump through the same scan as
production input. The dump is encoded from ``orders`` by Spark (bridge), written
with the fixed-width sink into the shared checkpoint folder, and scanned back.
Going through storage also keeps the encoder's expressions out of the decoder's
plan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.tables import write_fixed
from ..sources.tables import path_exists, scan_fixed
from .bridge import orders_to_records

_DUMPS: dict[tuple, str] = {}


def ledger_dump_path(spark: SparkSession, sf_dir: str, corrupt_every: int | None = None,
                     before: str | None = None) -> str:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), corrupt_every, before)
    path = _DUMPS.get(key)
    if path is None or not path_exists(spark, path):
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
        if before is not None:
            orders = orders.where(F.col("o_orderdate") < F.lit(before).cast("timestamp"))
        path = scratch_path(spark, "ledger-dump")
        write_fixed(orders_to_records(orders, corrupt_every=corrupt_every), path)
        _DUMPS[key] = path
    return path


def ledger_dump(spark: SparkSession, sf_dir: str, corrupt_every: int | None = None,
                before: str | None = None) -> DataFrame:
    """Raw 35-byte records for every order of ``sf_dir`` (optionally only orders before a date)."""
    return scan_fixed(spark, ledger_dump_path(spark, sf_dir, corrupt_every, before))
