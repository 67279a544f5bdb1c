import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerflow.llm import lbl


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def brute_base(rows):
    counts = Counter(t for i, x in rows if not is_held(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    return [(is_held(i), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n,
             sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x))) for i, x in rows]


@pytest.fixture(scope="module")
def corpus(rng):
    """Two languages: which one a text is in shows in every word."""
    a, b = [f"the{i}" for i in range(40)], [f"und{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(a if i % 2 else b) + ("" if rng.random() < 0.9 else str(rng.randint(0, 10**6))) for _ in range(120)))
            for i in range(600)]
    return [*rows, (600, None), (601, ""), (602, "É É é"), (602, "É É é"), (None, "the1 new")]


@pytest.mark.parametrize("heavy", [lbl.HEAVY_WORDS, 30])
def test_base_and_held_out_gain(spark, make_docs, corpus, monkeypatch, heavy):
    monkeypatch.setattr(lbl, "HEAVY_WORDS", heavy)
    monkeypatch.setattr(lbl, "BATCH", 256)
    docs = make_docs(corpus).selectExpr("*", "1 AS score", "2 AS row_")
    got = sorted(lbl.score(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    for r, want in zip(got, brute_base(corpus)):
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:4]
        assert r["base_score"] == pytest.approx(want[4], rel=1e-9)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.1 * sum(r["n_tokens"] for r in held)


def test_probabilities_sum_to_one(rng):
    words = lbl.Vocabulary({b"": 0, b"a": 1}, {b"": 5, b"a": 9}, 20, 5, np.zeros(lbl.SYMBOLS), np.zeros(lbl.SYMBOLS))
    bucket = lbl.OWN_WORDS + 3
    words.symbol_count[[0, 1, bucket]], words.bucket_types[bucket] = [5, 9, 6], 3
    model = lbl.Model.start(words, seed=3)
    contexts = np.array([[0, 0], [1, bucket], [bucket, 0]])
    s = model.predicted(contexts) @ model.q.T + model.b
    p = np.exp(s - model.log_normalisers(contexts)[:, None])
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    # within a bucket: known words of counts 1, 2, 3 and one share for new words
    assert sum((c + 0.5) / words.bucket_total()[bucket] for c in (1, 2, 3, 0)) == pytest.approx(1)


def steps_of(model):
    return lbl.Steps.start(len(model.b))


def test_gradient_step_raises_the_true_words():
    r = np.random.default_rng(0)
    words = lbl.Vocabulary({b"": 0}, {}, 10, 1, np.full(lbl.SYMBOLS, 5.0), np.ones(lbl.SYMBOLS))
    model = lbl.Model.start(words)
    contexts, targets = np.tile([[3, 4]], (256, 1)), np.full(256, 7)
    steps, noise = steps_of(model), lbl.Noise.of(words)
    def score():
        return float((model.predicted(contexts[:1]) @ model.q[7])[0] + model.b[7] - model.log_normalisers(contexts[:1])[0])
    before = score()
    for _ in range(30):
        lbl.train_batch(model, steps, contexts, targets, targets, noise, r)
    assert score() > before + 0.5


def test_contexts_stop_at_text_ends():
    words = lbl.Vocabulary({b"": 0, b"a": 1, b"b": 2, b"c": 3}, {b"": 3, b"a": 1, b"b": 1, b"c": 1, b"d": 1}, 7, 5,
                           np.zeros(lbl.SYMBOLS), np.zeros(lbl.SYMBOLS))
    made = lbl.Coder(words).encode(["a b", None, "c", "D zz"])
    assert made.rows.tolist() == [1, 2, 0, 0, 3, 0, lbl.bucket_of(b"d"), lbl.bucket_of(b"zz"), 0]
    assert made.sizes.tolist() == [3, 1, 2, 3] and made.rare.tolist() == [7] and [made.words[i].as_py() for i in made.rare_words.tolist()] == [b"zz"]
    assert lbl.contexts_of(made.rows[:6]).tolist() == [[0, 0], [1, 0], [2, 1], [0, 0], [0, 0], [3, 0]]


def test_most_frequent_is_exact_where_counts_are_equal(spark):
    rows = [(b"flat%05d" % i, 50) for i in range(3000)] + [(b"top", 60), (b"low", 2)]
    counts = spark.createDataFrame([(bytearray(t), n) for t, n in rows], "token binary, n long").repartition(5)
    for limit in (1, 2, 1000, 3001, 5000):
        got = [(bytes(r["token"]), r["n"]) for r in lbl.most_frequent(counts, limit)]
        assert got == sorted(rows, key=lambda r: (-r[1], r[0]))[:limit]
    assert lbl.most_frequent(counts.limit(0), 5) == []


@pytest.mark.parametrize("scores", [1.0, 200.0])
def test_log_sums_of_small_and_large_scores(scores):
    r = np.random.default_rng(2)
    words = lbl.Vocabulary({b"": 0}, {}, 10, 1, np.full(lbl.SYMBOLS, 5.0), np.ones(lbl.SYMBOLS))
    model = lbl.Model.start(words)
    model.q = (r.normal(size=model.q.shape) * scores).astype(np.float32)
    v = r.normal(size=(300, lbl.DIMENSIONS)).astype(np.float32)
    s = v.astype(float) @ model.q.T.astype(float) + model.b
    top = s.max(axis=1, keepdims=True)
    want = top[:, 0] + np.log(np.exp(s - top).sum(axis=1))
    assert np.allclose(model.log_sums(v, slice(0, lbl.SYMBOLS)), want, rtol=1e-4, atol=1e-3)


def test_empty_tables(spark, make_docs):
    assert lbl.score(make_docs([])).count() == 0
    held = next(i for i in range(50) if is_held(i))
    row = lbl.score(make_docs([(held, "no training rows")])).first()
    assert (row["train_tokens"], row["n_known"], row["n_tokens"]) == (0, 0, 4)
    assert row["base_score"] == pytest.approx(0.0) and math.isfinite(row["score"])


def test_words_above_the_minimum_count_have_vectors(spark):
    frequent = {b"same%04d" % i: 3000 - i for i in range(2000)}
    rare = {b"tail%d" % i: lbl.MIN_COUNT - 1 for i in range(50)}
    rows = [(bytearray(t), n) for t, n in {**frequent, **rare, b"": 70}.items()]
    words = lbl.vocabulary(spark.createDataFrame(rows, "token binary, n long"))
    assert set(words.symbol) == {*frequent, b""} and len(set(words.symbol.values())) == 2001
    tokens = lbl.Coder(words).encode(["same1990 same1991 tail7"]).rows
    contexts = lbl.contexts_of(tokens)
    assert contexts[1, 0] != contexts[2, 0]  # words of one bucket are different contexts
    assert words.symbol_count.sum() == words.tokens and words.bucket_types.sum() == len(rare)
    assert words.symbol_count[lbl.bucket_of(b"tail7")] == 50 * (lbl.MIN_COUNT - 1)
    assert words.word_count.sum() == words.symbol_count[lbl.FIRST_CLASS:].sum() == sum(sorted(frequent.values())[:-lbl.OWN_WORDS])


def test_class_words_sum_to_their_class_and_learn():
    rng = np.random.default_rng(5)
    width = 3
    symbol = {b"": 0} | {b"w%04d" % i: lbl.SYMBOLS + i for i in range(lbl.CLASSES * width - 1)}
    count = rng.integers(5, 50, lbl.CLASSES * width - 1).astype(float)
    words = lbl.Vocabulary(symbol, {}, 10, 1, np.zeros(lbl.SYMBOLS), np.zeros(lbl.SYMBOLS), count)
    for i, part in enumerate(words.class_parts()):
        words.symbol_count[lbl.FIRST_CLASS + i] = count[part].sum()
    assert words.width == width
    model = lbl.Model.start(words, seed=3)
    everything = np.arange(lbl.SYMBOLS + len(count))
    v = np.repeat(model.predicted(np.array([[lbl.SYMBOLS + 9, 0]])), len(everything), axis=0)
    p = np.exp(model.log_in_class(words, v, everything))
    assert (p[:lbl.SYMBOLS] == 1).all()
    assert all(p[lbl.SYMBOLS:][part].sum() == pytest.approx(1, abs=1e-5) for part in words.class_parts())
    table, share = words.noise_table()
    assert all(np.exp(share[part]).sum() == pytest.approx(1, abs=1e-5) for part in words.class_parts())
    assert all(set(row) == set(range(part.start, part.stop)) for row, part in zip(table, words.class_parts()))
    # after w0009 comes w0100, after w0011 w0101: one class, so only the word's own vectors can tell them apart
    texts = [b"w0009 w0100".decode(), b"w0011 w0101".decode()] * 600
    words.heavy.update(dict.fromkeys(symbol, 5))
    tokens = lbl.Coder(words).encode(texts).rows
    contexts, targets = lbl.contexts_of(tokens), words.first_level(tokens)
    assert targets[1] == targets[4] and tokens[1] != tokens[4]
    steps, noise = steps_of(model), lbl.Noise.of(words)
    for _ in range(60):
        lbl.train_batch(model, steps, contexts, tokens, targets, noise, rng)
    inside = model.log_in_class(words, model.predicted(contexts), tokens)
    assert np.exp(inside[[1, 4]]).min() > 0.7


def test_frequent_words_beyond_the_first_ones_are_predicted_from_context(spark, make_docs, rng):
    """Two languages of 600 words with one prefix: the language shows only in whole words."""
    rows = [(i, " ".join(f"same{rng.randrange(600) * 2 + i % 2}" for _ in range(400))) for i in range(3000)]
    held = [r for r in lbl.score(make_docs(rows).repartition(16)).collect() if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert gain > 0.1


def test_scores_do_not_depend_on_the_partitions(spark, make_docs, rng, monkeypatch):
    """Several shards and rounds; the rows lie in 1, 16 and 128 partitions, in another order each."""
    monkeypatch.setattr(lbl, "SHARD_TOKENS", 20_000)
    monkeypatch.setattr(lbl, "BATCH", 128)
    rows = [(i, " ".join(f"same{rng.randrange(200) * 2 + i % 2}" for _ in range(200))) for i in range(600)]
    rows += [(None, "same1 same3")] * 3
    scores, gains = [], []
    for parts in (1, 16, 128):
        got = lbl.score(make_docs(rng.sample(rows, len(rows))).repartition(parts)).collect()
        scores.append(sorted((-1 if r["doc_id"] is None else r["doc_id"], r["score"]) for r in got))
        held = [r for r in got if r["held_out"]]
        gains.append(sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held))
    for other in scores[1:]:
        assert all(a[0] == b[0] and a[1] == pytest.approx(b[1], rel=0.01) for a, b in zip(scores[0], other))
    assert min(gains) > 0.9 * max(gains) > 0


def test_very_long_text_and_ties(spark, make_docs):
    long = "many words of one text " * 60_000
    got = {r["doc_id"]: r for r in lbl.score(make_docs([(0, long), (2, "many words"), (3, "many words")])).collect()}
    assert got[0]["n_tokens"] == 300_001 and math.isfinite(got[0]["score"])
    assert got[2]["score"] == got[3]["score"] and got[2]["base_score"] == got[3]["base_score"]


def test_tokens_are_cut_as_defined(rng):
    letters = ["a", "B", "Z", "é", "É", "\u2003", "\xa0", "\x1c", "\x85", "\x00", " ", " ", "\t", "\n", "\x0b", "\x0c", "\r", "日", "İ"]
    texts = [None, "", " ", "\n\n"] + ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(500)]
    index, words, sizes = lbl.split_tokens(texts)
    flat, at = [words[i].as_py() for i in index.tolist()], 0
    for text, size in zip(texts, sizes.tolist()):
        assert flat[at:at + size] == lbl.words_of(text)
        at += size
    assert at == len(flat) and len(set(words.to_pylist())) == len(words)
