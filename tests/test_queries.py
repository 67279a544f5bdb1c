"""Every library query against its DuckDB oracle at sf0.001 (the driver checks sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    import duckdb
    from check_oracle import TABLES

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["transaction_hash_id", "masked_customer_id", "account_balance", "risk_category"]
    assert df.count() > 0


def test_all_queries_match_oracle(spark, con):
    from check_oracle import compare
    from ledgerflow.plans.catalog import ORACLE_SQL, QUERIES

    from __spark_entry__ import oracle_sql, queries

    assert set(QUERIES) == set(ORACLE_SQL)  # every library query has an oracle
    assert set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql()) <= set(queries())
    bad = []
    for name, fn in QUERIES.items():
        line = compare(spark, con, name, fn, ORACLE_SQL[name], SF)
        if not line.startswith("OK"):
            bad.append(line)
    assert not bad, "\n".join(bad)
