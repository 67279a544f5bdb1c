import re
from collections import Counter

import numpy as np

from ledgerflow.llm import quality as q
from ledgerflow.llm.boosting import fit


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] >= 2 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


TEXTS = [None, "", " \n\t", "a b c d e a b c d e", "x " * 3000, "é|#\n\n \né|#\n", "one\x1ctwo three", "l\r\nl\r\nl \nl",
         "a b c d e f g h i j k l", " ".join(f"w{i}" for i in range(20_000)) + " w0 w1 w2 w3 w4"]


def test_counts_equal_brute_force(rng):
    some = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for text in [*TEXTS, *some]:
        assert q.statistics(text)[:5] == brute(text)


def _table(rng, n=400):
    good = [" ".join(rng.choice(["the", "of", "tree", "house", "walks", "and"]) + str(rng.randint(0, 99)) for _ in range(60)) for _ in range(n)]
    bad = [" ".join(rng.choice(["###", "buy!!", "$$$", "NOW"]) + str(rng.randint(0, 99)) for _ in range(60)) for _ in range(n)]
    return good, bad


def test_held_out_accuracy_and_rules(spark, make_docs, rng):
    good, bad = _table(rng)
    docs = make_docs([*good, *bad, None, "", "too few words"]).selectExpr("*", "true AS kept")
    labels = spark.createDataFrame([(i, int(i < 400), 0) for i in range(0, 800, 2)] + [(None, 1, 0), (3, None, 0), (0, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in q.judge(docs, q.train(docs, labels)).collect()}
    held = [i for i in range(800) if i % 2]
    assert sum(out[i]["kept"] == (i < 400) for i in held) >= 0.98 * len(held)
    assert all(out[i]["base_failed"] and not out[i]["kept"] for i in (800, 801, 802))


def test_forest_is_monotonic(rng):
    r = np.random.default_rng(0)
    x = r.normal(size=(600, 3))
    y = (x[:, 0] + 0.5 * np.sin(3 * x[:, 1]) + r.normal(size=600) > 0).astype(float)
    forest = fit(x, y, np.array([1, 0, -1]))
    grid = np.linspace(-3, 3, 50)
    for base in r.normal(size=(20, 3)):
        for f, sign in ((0, 1), (2, -1)):
            points = np.repeat(base[None], 50, axis=0)
            points[:, f] = grid
            assert (sign * np.diff(forest.score(points)) >= -1e-9).all()


def test_walk_equals_recursion():
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 2))
    forest = fit(x, (x[:, 0] > 0.3).astype(float), np.array([0, 0]), trees=5)

    def walk(t, row, i=0):
        inner = forest.feature.shape[1]
        if i >= inner:
            return forest.leaf[t, i - inner]
        return walk(t, row, 2 * i + 1 + int(row[forest.feature[t, i]] > forest.threshold[t, i]))

    want = [forest.bias + sum(walk(t, row) for t in range(5)) for row in x]
    assert np.allclose(forest.score(x), want)


def test_few_labels_leave_the_base_rules(spark, make_docs):
    docs = make_docs(["a b c d e f g h i j k l", "few"])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert q.train(docs, none) is None
    assert [r["kept"] for r in sorted(q.judge(docs, None).collect(), key=lambda r: r["doc_id"])] == [True, False]
    assert q.judge(make_docs([]), None).count() == 0
