"""run() of the pipeline against a brute-force version over a small folder of tables."""

import hashlib
import importlib
import re
import sys

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from ledgerflow.llm import quality

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, rng):
    path = str(tmp_path_factory.mktemp("tables"))
    words = [f"word{i}" for i in range(500)]

    def prose(n=60):
        return " ".join(rng.choice(words) for _ in range(n))

    def junk(n=60):
        return " ".join(rng.choice(["###", "!!", "$$$"]) + rng.choice(words) for _ in range(n))

    texts = [prose() for _ in range(120)] + [junk() for _ in range(60)]
    texts += [texts[5], texts[5], texts[7] + " ", texts[9].upper()]  # copies
    texts += [prose(30) + ". " + ITEM.title() + "! " + prose(20), ITEM + " tail words", "few words", None, "", "a b c d e " * 40]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 120), 0) for i in range(180) if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts, labels


def brute(texts, labels, tokenizer):
    counts = {i: np.array([quality.statistics(t)]) for i, t in enumerate(texts)}
    sample = [(counts[i], y) for i, y, _ in labels if not quality.base_failed(counts[i])[0]]
    forest = quality.fit(quality.features(np.concatenate([c for c, _ in sample])), np.array([y for _, y in sample], float),
                         np.array([d for _, d in quality.FEATURES]))
    kept = [i for i, c in counts.items() if not quality.base_failed(c)[0] and forest.score(quality.features(c))[0] >= 0]
    prints = {}
    for i in kept:
        w = texts[i].encode().lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[k:k + 3]), 42) for k in range(len(w) - 2)]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    group = {i: i for i in kept}
    changed = True
    while changed:
        changed = False
        for i in kept:
            for j in kept:
                if bin(prints[i] ^ prints[j]).count("1") <= 2 and group[j] < group[i]:
                    group[i], changed = group[j], True
    out = {}
    for i in sorted(set(group.values())):
        text = texts[i]
        for m in list(re.finditer(r"(?i)\b" + r"\W+".join(ITEM.split()) + r"\b", text))[::-1]:
            text = text[:m.start()] + text[m.end():]
        if re.search(r"\w", text):
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            out[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    return out


def test_run_equals_brute_force(spark, tables, tokenizer_path):
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path)
    path, texts, labels = tables
    want = brute(texts, labels, tokenizer)
    rows = corpus_pipeline.run(spark, path).collect()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows}
    assert len(rows) == len(got) and got == want
    assert 184 in got and not {180, 181, 183, 186, 187, 188, 189} & set(got) and len(got) > 100


def test_stages_keep_the_columns(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), tables[0]).columns == docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "BPE encoding"]


def test_entry_without_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("ledgerflow.llm") or m in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "__spark_entry__", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == "ledgerflow.llm":
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    entry = importlib.import_module("__spark_entry__")
    assert "gold_product" in entry.queries() and not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    monkeypatch.delitem(sys.modules, "__spark_entry__")


CLASHES = {"n_words": "'w'", "kept": "'k'", "emptied": "7", "__id": "'i'", "__in0": "1.5", "rest": "'r'", "row": "array(1)",
           "a.b": "'dot'", "fingerprint": "'f'", "spans": "'s'", "probability": "'p'"}


def _with_clashes(spark, source, target):
    docs = spark.read.parquet(f"{source}/documents.parquet")
    docs.selectExpr("*", *[f"concat({v}, '-', doc_id) AS `{c}`" if v.startswith("'") else f"{v} AS `{c}`" for c, v in CLASHES.items()]
                    ).write.parquet(f"{target}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{target}/{name}.parquet")


def test_stages_carry_columns_of_any_name(spark, tables, tmp):
    path, texts, _ = tables
    _with_clashes(spark, path, tmp)
    docs = plain = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs if docs is not None else spark.read.parquet(f"{tmp}/documents.parquet"), tmp)
        plain = stage(spark, plain if plain is not None else spark.read.parquet(f"{path}/documents.parquet"), path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]
        rows = docs.collect()
        assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted((r["doc_id"], r["text"]) for r in plain.collect())
        for r in rows:  # every document's own values
            assert [r[c] for c in ("n_words", "kept", "__id", "a.b")] == [f"{v}-{r['doc_id']}" for v in ("w", "k", "i", "dot")]
            assert (r["emptied"], float(r["__in0"]), list(r["row"]), r["source"]) == (7, 1.5, [1], "s")


def test_empty_tables_through_all_stages(spark, tables, tmp):
    path, _, _ = tables
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp}/{name}.parquet")
    out = corpus_pipeline.run(spark, tmp)
    assert out.count() == 0 and out.columns == ["doc_id", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256"]


def test_very_long_and_repeated_texts(spark, tables, tmp, rng):
    path, texts, _ = tables
    words = [f"term{i}" for i in range(5000)]
    long = " ".join(rng.choice(words) for _ in range(150_000)) + ". " + ITEM
    rows = [(0, long), (1, long), (2, texts[3]), (2, texts[3]), (3, None), (None, texts[8])]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).write.parquet(f"{tmp}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").write.parquet(f"{tmp}/{name}.parquet")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, tmp).collect()}
    assert set(out) == {0, 2, None}
    kept = long[:-len(ITEM)]
    assert out[0]["decoded_sha256"] == hashlib.sha256(kept.encode()).hexdigest() and out[0]["n_tokens"] > 150_000
