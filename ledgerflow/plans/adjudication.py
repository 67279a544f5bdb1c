"""Batch adjudication run over a written gold table (D15 + R1 + K5-K7).

Finds the ids of the gold product that have no published result (only the id
columns are read), keeps the one narrow row that decides each of them in a
scratch table, and makes the payloads from it: valid ones are appended to the
product and contract failures, with every rule that they break, go to a queue of
the run, each row written once. The label dimension of
the first run is kept beside the product, so later runs give the same rationale
without reading all of gold. A run with nothing to publish reads ids alone and
adds no file. A crash between runs costs nothing: the next run picks up every id
without a published result.
"""

from __future__ import annotations

import datetime as _dt
import posixpath

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.adjudicate import (LOW_BUCKET, RationaleProvider, adjudicate, distinct_transactions, heuristic_rationale,
                                    label_dimension)
from ..session import scratch_path
from ..sinks.tables import dump_json, publish, write_table
from ..sources.tables import path_exists, read_table, remove, require_path
from ..streaming.resume import stored_dimension, unpublished


def run_adjudication(spark: SparkSession, gold_path: str, out_dir: str, run_id: str,
                     snapshot_ts: _dt.datetime | str | None = None,
                     provider: RationaleProvider = heuristic_rationale, fmt: str = "parquet",
                     json_dump: bool = False) -> dict:
    """Adjudicate every gold id not yet published; returns counts for this run."""
    gold = read_table(spark, require_path(spark, gold_path), fmt)
    product_path = posixpath.join(out_dir, "published_product")
    rejects_path = posixpath.join(out_dir, "dlq", "adjudication", f"run_id={run_id}")
    if path_exists(spark, product_path):
        published = spark.read.parquet(product_path)
    else:
        published = spark.createDataFrame([], "transaction_id string")
    done = {"published": 0, "rejected": 0}
    ids = scratch_path(spark, "unpublished")
    if write_table(unpublished(gold, published), ids):
        todo = gold.join(spark.read.schema("transaction_hash_id string").parquet(ids), "transaction_hash_id", "left_semi")
        rows = scratch_path(spark, "unjudged")  # one narrow row an id: what the payloads are made from
        distinct_transactions(todo).select("transaction_hash_id", "account_balance",
                                           F.when(F.col("is_low"), F.lit(LOW_BUCKET)).alias("risk_category")).write.parquet(rows)
        todo = spark.read.parquet(rows)
        dim = stored_dimension(spark, posixpath.join(out_dir, "labels"), lambda: label_dimension(gold, provider), todo, provider)
        valid, rejects = adjudicate(todo, run_id=run_id, snapshot_ts=snapshot_ts, rationale_dim=dim, assume_unique_ids=True,
                                    all_failures=True)
        done = {"published": publish(valid, product_path, mode="append"), "rejected": publish(rejects, rejects_path)}
        remove(spark, rows)
    remove(spark, ids)
    if json_dump and path_exists(spark, product_path):
        dump_json(spark.read.parquet(product_path), posixpath.join(out_dir, "results_json"))
    return done
