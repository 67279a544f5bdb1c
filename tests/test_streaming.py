import os

from ledgerflow.streaming.resume import adjudicate_available_now, remaining


def _gold(spark, n=40):
    return spark.createDataFrame([(f"id{i:03d}", 1000.0 * i, "LOW") for i in range(n)],
                                 "transaction_hash_id string, account_balance double, risk_category string")


def test_available_now_processes_each_file_once(spark, tmp):
    from ledgerflow.operators.adjudicate import adjudicate

    gold_path = os.path.join(tmp, "gold")
    _gold(spark).repartition(4).write.parquet(gold_path)
    out, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ckpt")
    batches = adjudicate_available_now(spark, gold_path, out, ckpt, run_id="r", snapshot_ts="2026-01-01 00:00:00",
                                       max_files_per_trigger=1)
    assert batches >= 4
    streamed = spark.read.parquet(out).drop("batch_id")
    batch, _ = adjudicate(spark.read.parquet(gold_path), run_id="r", snapshot_ts="2026-01-01 00:00:00")
    assert streamed.count() == 40
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    again = adjudicate_available_now(spark, gold_path, out, ckpt, run_id="r", snapshot_ts="2026-01-01 00:00:00")
    assert again == 0
    assert spark.read.parquet(out).count() == 40


GOLD = "transaction_hash_id string, account_balance double, risk_category string"


def _more_gold(spark, path, rows):
    spark.createDataFrame(rows, GOLD).coalesce(1).write.mode("append").parquet(path)


def test_state_knows_published_ids_without_reading_them(spark, tmp):
    gold_path, out, ckpt = (os.path.join(tmp, n) for n in ("gold", "out", "ckpt"))

    def run():
        return adjudicate_available_now(spark, gold_path, out, ckpt, run_id="r", snapshot_ts="2026-01-01 00:00:00")

    _more_gold(spark, gold_path, [("a", 200000.0, "LOW"), ("a", 30.0, "LOW"), ("b", None, "LOW"), ("c", float("nan"), "LOW")])
    assert run() == 1
    first = {r.transaction_id: r.risk_score for r in spark.read.parquet(out).collect()}
    assert first == {"a": 30.0 / 300000.0}
    os.rename(out, out + "-away")                      # no later micro-batch reads what was published
    _more_gold(spark, gold_path, [("a", 10.0, "LOW"), ("b", 600.0, "HIGH"), ("c", None, "LOW"), ("d", 900.0, "LOW")])
    assert run() == 1
    second = {r.transaction_id: r.risk_score for r in spark.read.parquet(out).collect()}
    assert second == {"b": 0.002, "d": 0.003}          # a came out before, b has a balance now
    rejects = sorted(r.transaction_id for r in spark.read.parquet(out + "_rejects").collect())
    assert rejects == ["b", "c"]                       # c once, though it failed in two files
    assert run() == 0


def test_later_micro_batch_plans_no_published_file(spark, tmp, monkeypatch):
    from ledgerflow.streaming import resume

    gold_path, out, ckpt = (os.path.join(tmp, n) for n in ("gold", "out", "ckpt"))
    plans, adjudicate = [], resume.adjudicate

    def spied(fresh, **kwargs):
        valid, rejects = adjudicate(fresh, **kwargs)
        plans.append(valid._jdf.queryExecution().executedPlan().toString())
        return valid, rejects

    monkeypatch.setattr(resume, "adjudicate", spied)
    _gold(spark).repartition(3).write.parquet(gold_path)
    assert adjudicate_available_now(spark, gold_path, out, ckpt, max_files_per_trigger=1) == len(plans) >= 3
    assert all(out not in p and "Exchange hashpartitioning" not in p and "Join LeftAnti" not in p for p in plans)


def test_remaining_is_anti_join(spark):
    gold = _gold(spark, 10)
    published = spark.createDataFrame([("id001",), ("id005",), ("zzz",)], "transaction_id string")
    left = sorted(r.transaction_hash_id for r in remaining(gold, published).collect())
    assert left == [f"id{i:03d}" for i in range(10) if i not in (1, 5)]


def test_run_adjudication_resumes(spark, tmp):
    from ledgerflow.plans.adjudication import run_adjudication

    gold_path = os.path.join(tmp, "gold")
    _gold(spark, 30).where("transaction_hash_id < 'id010'").write.parquet(gold_path)
    out = os.path.join(tmp, "adj")
    first = run_adjudication(spark, gold_path, out, run_id="r1", snapshot_ts="2026-01-01 00:00:00")
    assert first == {"published": 10, "rejected": 0}
    _gold(spark, 30).write.mode("overwrite").parquet(gold_path)   # the gold table grew
    second = run_adjudication(spark, gold_path, out, run_id="r2", snapshot_ts="2026-01-02 00:00:00", json_dump=True)
    assert second == {"published": 20, "rejected": 0}
    product = spark.read.parquet(os.path.join(out, "published_product"))
    assert product.count() == 30 and product.select("transaction_id").distinct().count() == 30
    assert sorted({r.adjudication_rationale for r in product.collect()}) == sorted(
        {r.rationale for r in spark.read.parquet(os.path.join(out, "labels")).collect() if r.adjudication_label == "APPROVE"})
    third = run_adjudication(spark, gold_path, out, run_id="r3", snapshot_ts="2026-01-03 00:00:00")
    assert third == {"published": 0, "rejected": 0}


def test_finding_unpublished_ids_reads_ids_alone(spark, tmp):
    from ledgerflow.streaming.resume import unpublished

    path = os.path.join(tmp, "gold")
    _gold(spark, 10).write.parquet(path)
    published = spark.createDataFrame([("id001",)], "transaction_id string")
    left = unpublished(spark.read.parquet(path), published)
    assert left.count() == 9
    assert "ReadSchema: struct<transaction_hash_id:string>" in left._jdf.queryExecution().executedPlan().toString()


def test_rationale_is_that_of_the_first_run(spark, tmp):
    from ledgerflow.plans.adjudication import run_adjudication

    gold_path, out = os.path.join(tmp, "gold"), os.path.join(tmp, "adj")
    _more_gold(spark, gold_path, [("m", 200.0, "LOW")])
    run_adjudication(spark, gold_path, out, run_id="r1")
    _more_gold(spark, gold_path, [("a", 90000.0, "LOW"), ("z", 299000.0, "LOW"), ("n", None, "LOW")])  # a new first id, a new label
    assert run_adjudication(spark, gold_path, out, run_id="r2") == {"published": 2, "rejected": 1}
    texts = {r.transaction_id: r.adjudication_rationale for r in spark.read.parquet(os.path.join(out, "published_product")).collect()}
    assert texts["a"] == texts["m"] != texts["z"]


def test_state_commits_write_changes_alone(spark, tmp):
    gold_path, out, ckpt = (os.path.join(tmp, n) for n in ("gold", "out", "ckpt"))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    _more_gold(spark, gold_path, [(f"id{i}", 100.0 * i, "LOW") for i in range(50)])
    _more_gold(spark, gold_path, [("id7", 1.0, "LOW"), ("new", 5.0, "LOW")])
    assert adjudicate_available_now(spark, gold_path, out, ckpt, run_id="r", snapshot_ts="2026-01-01 00:00:00",
                                    max_files_per_trigger=1) >= 2
    files = [f for _, _, names in os.walk(os.path.join(ckpt, "state")) for f in names]
    assert any(f.endswith(".changelog") for f in files) and not any(f.endswith(".delta") for f in files)
    assert spark.conf.get(key, None) == before  # the session's own streams keep their store
    assert spark.read.parquet(out).select("transaction_id").distinct().count() == spark.read.parquet(out).count() == 51
