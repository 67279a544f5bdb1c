from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import sharding as sh


def test_shares_differ_by_one_slot():
    counts = Counter(sh.fill_table(sh.SHARDS, sh.TABLE_SIZE))
    assert len(counts) == len(sh.SHARDS) and max(counts.values()) - min(counts.values()) <= 1


def test_a_lost_shard_moves_little():
    a, names = sh.fill_table(sh.SHARDS, sh.TABLE_SIZE), sh.SHARDS
    left = names[:10] + names[11:]
    b = sh.fill_table(left, sh.TABLE_SIZE)
    moved = sum(names[x] != left[y] for x, y in zip(a, b) if names[x] in left)
    assert moved < 0.1 * len(a)


def test_first_claims_by_preference():
    table = sh.fill_table(("a", "b"), 7)
    assert sorted(Counter(table).values()) == [3, 4] and sh.fill_table(("a",), 7) == [0] * 7


@pytest.mark.parametrize("shards,size", [((), 7), (("a", "a"), 7), (("a",), 8), (("a", "b"), 1)])
def test_bad_parameters(shards, size):
    with pytest.raises(ValueError):
        sh.fill_table(shards, size)


def test_placement(spark, make_docs):
    docs = make_docs([(i, "t") for i in range(2000)] + [(5, "again"), (None, "n"), (None, "m")])
    placed = sh.place(docs.withColumn("Shard", F.lit("clash")))
    rows = placed.collect()
    assert len(rows) == 2003 and "Shard" not in placed.columns
    assert len({r["shard"] for r in rows if r["doc_id"] == 5}) == 1 and len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    table = sh.fill_table(sh.SHARDS, sh.TABLE_SIZE)
    assert all(r["shard"] == sh.SHARDS[table[r["slot"]]] for r in rows)
    assert max(Counter(r["shard"] for r in rows).values()) < 3 * len(rows) / len(sh.SHARDS)
    assert "Python" not in placed._jdf.queryExecution().executedPlan().toString()
    assert sh.place(make_docs([])).count() == 0


def test_written_shards(spark, make_docs, tmp):
    placed = sh.place(make_docs(["a", "b", "c"]), shards=("x", "y"), size=101)
    sh.write_shards(placed, f"{tmp}/shards")
    assert spark.read.parquet(f"{tmp}/shards").count() == 3
