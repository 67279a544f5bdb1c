"""The batch entry points on the bridge's dump of the smallest tables."""

from ledgerflow.jobs import main
from ledgerflow.plans.dumps import ledger_dump_path

SF = "/root/testdata/sf0.001"


def test_medallion_then_adjudication(spark, tmp, capsys):
    lines = main(["medallion", ledger_dump_path(spark, SF), f"{tmp}/lake", "--preview"])
    assert lines[0].endswith("1,500") and lines[-1].endswith("100.00%")
    n = spark.read.parquet(f"{tmp}/lake/gold").count()
    assert main(["adjudicate", f"{tmp}/lake/gold", f"{tmp}/out", "r1", "--json"]) == [f"Published results: {n:,}", "Rejected results: 0"]
    assert main(["adjudicate", f"{tmp}/lake/gold", f"{tmp}/out", "r2"])[0] == "Published results: 0"
    assert spark.read.json(f"{tmp}/out/results_json").count() == n
    assert "Clean data products" in capsys.readouterr().out
