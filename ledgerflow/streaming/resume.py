"""Incremental, resumable adjudication.

Batch form: adjudicate only the ids that are not in the published output yet
(a left anti-join of ids alone), with the label rationale of the first run, so
a resumed run gives the same rows as an uninterrupted one.

Streaming form: the gold table is read as a file stream with
``trigger(availableNow=True)``. What is known of each id is kept in the stream's
own state store, as a streaming aggregate keyed by id: the least balances so
far, and the micro-batches in which the id first came with and without a usable
balance. A micro-batch costs what its own rows cost, as the state is kept in RocksDB, whose
commits write changed ids alone; the store in the executors' heap copies all of the
state in each micro-batch. No published file is read.
An id is published in the first micro-batch that brings a usable balance, and
rejected once if none has come yet. Every micro-batch writes to its own
``batch_id=<n>`` folder with overwrite, so a replayed batch replaces its own
output. The checkpoint holds the files done and the state: a second run over the
same input processes nothing, and one over more files knows every earlier id.

The label dimension (at most one row per label) is written on the first run and
read by later ones, so their rationale is the same and gold isn't read again; a
label that is new in a run is added from that run's rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.adjudicate import (LABELS, LOW_BUCKET, RationaleProvider, adjudicate, heuristic_rationale, judged,
                                    label_dimension)
from ..operators.split import REASON
from ..sources.tables import path_exists, remove


_STORE = "spark.sql.streaming.stateStore."
#: The state store of a stream's first run; later runs keep the one that their checkpoint names. Commits write changes
#: alone, and all stores of an executor share one bounded cache, off the heap.
STATE_CONF = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}rocksdb.trackTotalNumberOfRows": "false",
    f"{_STORE}rocksdb.boundedMemoryUsage": "true",
}


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session's settings with those of ``conf``, for as long as a query takes to start."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def remaining(gold: DataFrame, published: DataFrame, key: str = "transaction_hash_id") -> DataFrame:
    """Gold rows whose id has no published result."""
    done = published.select(F.col("transaction_id").alias(key))
    return gold.join(done, key, "left_anti")


def resume_judged(gold: DataFrame, published: DataFrame, run_id: str = "run",
                  snapshot_ts: _dt.datetime | str | None = None,
                  provider: RationaleProvider = heuristic_rationale, rationale_dim: DataFrame | None = None,
                  **kwargs) -> DataFrame:
    """R1 (batch): payloads and rejection reasons for the ids still missing from ``published``.

    ``rationale_dim`` is the dimension of an earlier run; without it, that of all of ``gold`` is computed."""
    dim = rationale_dim if rationale_dim is not None else label_dimension(gold, provider)
    return judged(remaining(gold, published), run_id=run_id, snapshot_ts=snapshot_ts, rationale_dim=dim, **kwargs)


def resume_batch(gold: DataFrame, published: DataFrame, **kwargs) -> tuple[DataFrame, DataFrame]:
    """R1 (batch): (valid, rejects) of :func:`resume_judged`.
    ``published.unionByName(valid)`` is the accumulated output (U2)."""
    out = resume_judged(gold, published, **kwargs)
    return out.where(F.col(REASON).isNull()).drop(REASON), out.where(F.col(REASON).isNotNull())


def unpublished(gold: DataFrame, published: DataFrame, key: str = "transaction_hash_id") -> DataFrame:
    """The distinct ids of ``gold`` that ``published`` (``transaction_id``) does not hold; reads ids alone."""
    done = published.select(F.col("transaction_id").alias(key))
    return gold.select(key).distinct().join(done, key, "left_anti")


def stored_dimension(spark: SparkSession, path: str, first: Callable[[], DataFrame], rows: DataFrame,
                     provider: RationaleProvider = heuristic_rationale) -> DataFrame:
    """The label dimension kept at ``path``: ``first()`` where there is none, with labels that are new in ``rows`` added."""
    if not path_exists(spark, path):
        first().write.parquet(path)
    dim = spark.read.parquet(path)
    known = [r["adjudication_label"] for r in dim.select("adjudication_label").limit(len(LABELS) + 1).collect()]
    if len(known) > len(LABELS) or len(set(known)) < len(known):
        raise ValueError(f"{path} has more than one row per label")
    if len(known) < len(LABELS):
        added = label_dimension(rows, provider).where(~F.col("adjudication_label").isin(known))
        added.write.mode("append").parquet(path)
        dim = spark.read.parquet(path)
    return dim


def _with_state(gold: DataFrame) -> DataFrame:
    """One row per id that a micro-batch brings, with all that its state holds.

    ``first_good`` and ``first_bad`` are the times of the micro-batches that first brought the id with a usable balance
    and without; the time of a micro-batch is one value, and stays the same when it is run again.
    """
    balance = F.col("account_balance").cast("double")
    low = F.coalesce(F.upper("risk_category") == LOW_BUCKET, F.lit(False))
    usable = balance.isNotNull() & ~F.isnan(balance)
    return gold.withColumn("_now", F.current_timestamp()).groupBy("transaction_hash_id").agg(
        F.min(F.when(low & usable, balance)).alias("_low"), F.min(F.when(~low & usable, balance)).alias("_other"),
        F.min(F.when(usable, F.col("_now"))).alias("first_good"), F.min(F.when(~usable, F.col("_now"))).alias("first_bad"),
        F.max("_now").alias("now"))


def _fresh(state: DataFrame) -> DataFrame:
    """Gold-like rows of the ids to judge in this micro-batch: new with a usable balance, or new without any."""
    is_low = F.col("_low").isNotNull() & (F.col("_other").isNull() | (F.col("_low") <= F.col("_other")))
    good = F.col("first_good") == F.col("now")
    bad = F.col("first_good").isNull() & (F.col("first_bad") == F.col("now"))
    return state.where(good | bad).select(
        "transaction_hash_id", F.when(is_low, F.col("_low")).otherwise(F.col("_other")).alias("account_balance"),
        F.when(is_low, F.lit(LOW_BUCKET)).alias("risk_category"))


def adjudicate_available_now(spark: SparkSession, gold_path: str, out_path: str, checkpoint: str,
                             run_id: str = "run", snapshot_ts: _dt.datetime | str | None = None,
                             provider: RationaleProvider = heuristic_rationale,
                             rationale_dim: DataFrame | None = None, max_files_per_trigger: int | None = None,
                             fmt: str = "parquet") -> int:
    """R1 (streaming): process every gold file not yet seen, then stop.
    Returns the number of micro-batches that ran."""
    schema = spark.read.format(fmt).load(gold_path).schema
    dim_path, staged = f"{checkpoint.rstrip('/')}_labels", f"{checkpoint.rstrip('/')}_staged"
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(gold_path)
    batches = []

    def first_dimension() -> DataFrame:
        return rationale_dim if rationale_dim is not None else label_dimension(spark.read.format(fmt).load(gold_path), provider)

    def one_batch(state: DataFrame, batch_id: int) -> None:
        batches.append(batch_id)
        path = f"{staged}/batch_id={batch_id}"  # the stateful plan runs once, into this narrow table
        _fresh(state).write.mode("overwrite").parquet(path)
        fresh = spark.read.parquet(path)
        dim = stored_dimension(spark, dim_path, first_dimension, fresh, provider)
        valid, rejects = adjudicate(fresh, run_id=run_id, snapshot_ts=snapshot_ts, rationale_dim=dim, assume_unique_ids=True)
        valid.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        rejects.write.mode("overwrite").parquet(f"{out_path}_rejects/batch_id={batch_id}")
        remove(spark, path)

    with _settings(spark, STATE_CONF):  # a query keeps the settings that it starts with
        query = (_with_state(stream).writeStream.outputMode("update").foreachBatch(one_batch)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return len(batches)
