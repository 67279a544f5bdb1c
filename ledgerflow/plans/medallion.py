"""The full medallion run (D6): source -> bronze -> vault -> gold, with dead-letter queues and KPIs.

Shape of the job, chosen for very large dumps:

1. One pass over the source decodes and judges every record and writes it
   once, partitioned by ``stage`` (where it ends up), with its balance and
   reason, to the shared scratch folder. That table cuts the lineage: later
   stages never read the dump again, and work that a lost executor repeats
   starts from it. Nothing is persisted on executors.
2. Bronze, the vault, gold and the dead-letter queues are reads of that table,
   pruned to their stages and columns. The scratch table goes when all layers
   are written.
3. Every count is observed by the write that it is about (G3); no table is read
   to count it.
4. The vault is written in hash buckets, so its joins need no shuffle; gold is
   written in order of its id, so a lookup reads few row groups. Both are
   shuffled as clear natural keys and hashed behind the shuffle, so it carries
   some 20 bytes a row and not 64 a hash.

With a ``run_id`` each layer is a folder ``run_id=<id>`` of its table, and the
run is entered in ``runs`` when all its layers stand. A run that dies half-way
leaves earlier runs whole and is not seen by :func:`read_layer`; run again under
its id it replaces its own folders, empty dead-letter queues included.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import Contract
from ..layout import LEDGER_LAYOUT
from ..operators.bronze import BRONZE_COLUMNS
from ..operators.kpi import STAGES, assert_conserved, route_records
from ..operators.product import gate_gold, gold_columns, process_gold
from ..operators.split import REASON
from ..operators.vault import VAULT_KEYS, build_vault, vault_columns, vault_keys
from ..session import scratch_path
from ..sinks.tables import PARQUET_CODEC, counted, write_bucketed, write_dlq, write_ordered, write_table
from ..sources.tables import input_files, path_exists, read_bucketed, remove, require_path, scan_fixed

LAYERS = ("bronze", "silver/hub_customer", "silver/lnk_transaction", "silver/sat_account_state", "gold",
          "dlq/structural", "dlq/semantic")
RUNS = "runs"


def layer_paths(out_dir: str, run_id: str | None = None) -> dict[str, str]:
    below = [] if run_id is None else [f"run_id={run_id}"]
    return {name: posixpath.join(out_dir, name, *below) for name in LAYERS}


def finished_runs(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """(run_id, finished_at and counts) of the runs whose layers are complete; None before the first."""
    path = posixpath.join(out_dir, RUNS)
    return spark.read.json(path) if path_exists(spark, path) else None


def read_layer(spark: SparkSession, out_dir: str, name: str, run_id: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A layer of one run; without ``run_id`` of the run that finished last."""
    if run_id is None:
        runs = finished_runs(spark, out_dir)
        if runs is None:
            raise FileNotFoundError(f"no finished run below {out_dir}")
        run_id = runs.orderBy(F.desc("finished_at"), F.desc("run_id")).first()["run_id"]
    path = layer_paths(out_dir, run_id)[name]
    if fmt == "parquet" and name.startswith("silver/"):
        return read_bucketed(spark, path)
    return spark.read.format("json" if name.startswith("dlq/") else fmt).load(path)


def run_medallion(spark: SparkSession, source: str | DataFrame, out_dir: str, strict: bool = False,
                  contract: Contract | str | dict = "consumer", fmt: str = "parquet", tail: str = "keep",
                  check: bool = True, run_id: str | None = None, buckets: int | None = None) -> dict:
    """Run every layer, write every table, return the KPI counts (A1/A2/A3).

    A partial record at a file's end is kept and rejected (``tail="keep"``), dropped and counted as
    ``dropped_tails`` (``"drop"``), or stops the run (``"fail"``). ``buckets`` of the vault tables: see
    ``sinks.tables.write_bucketed``; other formats than Parquet are written without buckets.
    """
    if run_id is not None and (not run_id or set(run_id) & set("/\\=%?#:*")):
        raise ValueError(f"run_id is a folder name: {run_id!r}")
    dropped = 0
    if isinstance(source, str):
        raw = scan_fixed(spark, require_path(spark, source), tail=tail)
        if tail == "drop":
            dropped = input_files(spark, source).where(F.col("length") % LEDGER_LAYOUT.record_length != 0).count()
    else:
        raw = source
    paths = layer_paths(out_dir, run_id)

    scratch = scratch_path(spark, "routed")
    columns = [*BRONZE_COLUMNS, "unpacked_balance", REASON, "stage"]
    stage, balance = F.col("stage"), F.col("unpacked_balance")
    judged, seen = counted(route_records(raw, strict=strict, contract=contract, check_length=tail == "keep").select(*columns),
                           **{name: F.count_if(stage == name) for name in STAGES})
    judged.write.partitionBy("stage").option("compression", PARQUET_CODEC).parquet(scratch)
    count = seen.get
    routed = spark.read.schema(judged.schema).parquet(scratch)

    write_table(routed.where(stage != "structural").select(*BRONZE_COLUMNS), paths["bronze"], fmt)
    producer = routed.where(stage.isin("structural", "malformed"))
    rejected = write_dlq(producer.select(*BRONZE_COLUMNS, REASON, F.when(stage == "malformed", balance).alias("unpacked_balance")),
                         paths["dlq/structural"])
    rows = {}
    silver = routed.where(stage.isin("semantic", "gold")).select(*BRONZE_COLUMNS, "unpacked_balance")
    for name, table in (vault_keys(silver) if fmt == "parquet" else build_vault(silver)).items():
        path = paths[f"silver/{name}"]
        rows[name] = (write_bucketed(table, path, VAULT_KEYS[name], buckets, vault_columns()[name]) if fmt == "parquet"
                      else write_table(table, path, fmt))
    clean = [*BRONZE_COLUMNS, "unpacked_balance"]
    valid = gate_gold(routed.where(stage == "gold").select(*clean), contract)[0]
    delivered = write_ordered(valid, paths["gold"], "transaction_hash_id", fmt, gold_columns(valid, contract))
    refused = write_dlq(process_gold(routed.where(stage == "semantic").select(*clean), contract)[1], paths["dlq/semantic"])
    remove(spark, scratch)

    kpi = {
        "ingested": count["rows"],
        "structural_rejects": count["structural"],
        "malformed_rejects": rejected - count["structural"],
        "semantic_rejects": refused,
        "delivered": delivered,
        "dropped_tails": dropped,
        **rows,
    }
    accounted = kpi["delivered"] + kpi["structural_rejects"] + kpi["malformed_rejects"] + kpi["semantic_rejects"]
    kpi["survival_pct"] = 100.0 * accounted / kpi["ingested"] if kpi["ingested"] else None
    if check:
        assert_conserved(kpi)
    if run_id is not None:
        numbers = [F.lit(v).alias(k) for k, v in kpi.items()]
        entry = spark.range(1).select(F.current_timestamp().alias("finished_at"), *numbers)
        write_table(entry, posixpath.join(out_dir, RUNS, f"run_id={run_id}"), "json")
    return kpi


def kpi_lines(kpi: dict) -> list[str]:
    """A1: the console report."""
    survival = "n/a" if kpi.get("survival_pct") is None else f"{kpi['survival_pct']:.2f}%"
    return [
        f"Total binary records ingested: {kpi['ingested']:,}",
        f"Clean data products loaded in gold: {kpi['delivered']:,}",
        f"Structural anomalies (producer DLQ): {kpi['structural_rejects'] + kpi['malformed_rejects']:,}",
        f"Semantic anomalies (consumer DLQ): {kpi['semantic_rejects']:,}",
        f"Partial records dropped at file ends: {kpi.get('dropped_tails', 0):,}",
        f"Record survival rate: {survival}",
    ]
