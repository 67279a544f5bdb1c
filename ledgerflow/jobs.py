"""Batch entry points for spark-submit.

    spark-submit ledgerflow/jobs.py medallion SOURCE OUT_DIR [--strict] [--tail keep|drop|fail] [--run-id ID]
    spark-submit ledgerflow/jobs.py adjudicate GOLD OUT_DIR RUN_ID [--json]

On a cluster, ship the package with ``--py-files`` and name the shared folder
in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerflow.plans.adjudication import run_adjudication  # noqa: E402
from ledgerflow.plans.medallion import kpi_lines, layer_paths, run_medallion  # noqa: E402
from ledgerflow.session import build_session  # noqa: E402
from ledgerflow.sinks.tables import preview  # noqa: E402


def main(argv: list[str] | None = None) -> list[str]:
    """Run one job, print its report and return the lines."""
    parser = argparse.ArgumentParser(prog="ledgerflow")
    jobs = parser.add_subparsers(dest="job", required=True)
    medallion = jobs.add_parser("medallion", help="fixed-width source to bronze, vault, gold and dead-letter queues")
    medallion.add_argument("source")
    medallion.add_argument("out_dir")
    medallion.add_argument("--strict", action="store_true", help="reject balances with non-decimal digits")
    medallion.add_argument("--tail", choices=("keep", "drop", "fail"), default="keep")
    medallion.add_argument("--run-id", help="keep this run's layers beside those of other runs")
    medallion.add_argument("--preview", action="store_true", help="show some gold rows")
    adjudicate = jobs.add_parser("adjudicate", help="score every gold id that has no published result")
    adjudicate.add_argument("gold")
    adjudicate.add_argument("out_dir")
    adjudicate.add_argument("run_id")
    adjudicate.add_argument("--json", action="store_true", help="also dump the product as JSON lines")
    args = parser.parse_args(argv)

    spark = build_session()
    if args.job == "medallion":
        lines = kpi_lines(run_medallion(spark, args.source, args.out_dir, strict=args.strict, tail=args.tail, run_id=args.run_id))
        if args.preview:
            preview(spark.read.parquet(layer_paths(args.out_dir, args.run_id)["gold"]))
    else:
        counts = run_adjudication(spark, args.gold, args.out_dir, args.run_id, json_dump=args.json)
        lines = [f"{name.capitalize()} results: {n:,}" for name, n in counts.items()]
    print("\n".join(lines))
    return lines


if __name__ == "__main__":
    main()
