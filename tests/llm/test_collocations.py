import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerflow.llm import collocations as col

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, percent, top):
    """The contract's rows by plain loops, and the paths by following lossless links."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    out = set()
    for lang, counts in f.items():
        frequent = {p: c for p, c in counts.items() if c >= min_count}
        dropped = set()
        for q, c in frequent.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    if 100 * c >= percent * frequent[q[i:i + k]]:
                        dropped.add(q[i:i + k])
        links = {}
        for e, c in frequent.items():
            if len(e) == 5 and frequent[e[1:]] == c:
                links.update({e: x for x, d in frequent.items() if len(x) == 5 and x[:4] == e[1:] and d == c})
        path = {}
        for e in frequent:
            if len(e) == 5 and e not in links.values():
                chain = [e]
                while chain[-1] in links:
                    chain.append(links[chain[-1]])
                whole = " ".join([*e, *(x[-1] for x in chain[1:])])
                path.update({x: whole for x in chain})
        scored = []
        for p, a in frequent.items():
            if len(p) > 1 and p not in dropped:
                score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                     for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r, p))
        for rank, (score, a, phrase, l, r, p) in enumerate(sorted(scored)[:top], 1):
            whole = path.get(p, phrase.decode())
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score, whole, len(whole.split(" "))))
    return out


def got(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def random_rows(rng, docs, words, separators=(" ", " ", " ", "\t ", ". ", "\n", ",")):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for i in range(docs):
        text = "".join(rng.choice(words) + rng.choice(separators) for _ in range(rng.randrange(40)))
        if rng.random() < 0.3:
            text += passage + rng.choice([". ", " ", "!"]) + text[:20]
        rows.append((i, text, rng.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("seed, percent, flush", [(1, 100, 2_000_000), (2, 60, 50), (3, 100, 1)])
def test_against_plain_loops(spark, monkeypatch, seed, percent, flush):
    monkeypatch.setattr(col, "FLUSH_WORDS", flush)
    monkeypatch.setattr(col, "CUT_BYTES", 20)
    rng = random.Random(seed)
    words = ["a", "B", "c", "the", "The", "é", "ÉA", "a\x01", "a\x00b", "\x08", " ", "日本", "x-y", "\x1f", "a\n"[:1] + "a"]
    rows = random_rows(rng, 150, words)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(col.collocations(frame, min_count=3, percent=percent, top=40)) == brute(rows, 3, percent, 40)


def test_many_partitions_and_hot_words(spark):
    rng = random.Random(4)
    rows = [(i, "of the " + " of the ".join(rng.choice("abcdefgh") for _ in range(12)), "en") for i in range(200)]
    was = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert got(col.collocations(spark.createDataFrame(rows, SCHEMA).repartition(9), min_count=5)) == brute(rows, 5, 100, 2000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was[1])


def test_words_that_share_a_hash_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(col, "TABLE_BITS", 64)
    rows = random_rows(random.Random(5), 80, [f"w{i}" for i in range(60)])
    assert got(col.collocations(spark.createDataFrame(rows, SCHEMA), min_count=4)) == brute(rows, 4, 100, 2000)


def test_long_path_is_compacted(spark):
    passage = " ".join(f"word{i}" for i in range(300))
    rows = [(i, f"{'x y z'.split()[i % 3]} {passage}", "en") for i in range(6)] + [(9, "word150 word151 word152 word153 word154", "en")]
    out = got(col.collocations(spark.createDataFrame(rows, SCHEMA), min_count=6))
    assert out == brute(rows, 6, 100, 2000)
    longest = max(r[9] for r in out)
    assert 140 < longest < 160  # the further occurrence in the middle parts the passage


def test_arithmetic_beyond_64_bits():
    rows = [(10 ** 9, 10 ** 11, 10 ** 9, 10 ** 9)]
    from ledgerflow.session import build_session

    spark = build_session()
    flows = [("en", b"a", 1, 3 * 10 ** 9), ("en", b"b", 1, 7 * 10 ** 9), ("en", b"a\tb", 2, 10 ** 9)]
    cuts = col.candidates(spark.createDataFrame(flows, "lang string, gram binary, words int, f long")).collect()
    assert [(c.f, c.k, c.l, c.r) for c in cuts] == [(10 ** 9, 1, 3 * 10 ** 9, 7 * 10 ** 9)]
    scored = spark.createDataFrame([(c.f, rows[0][1], c.l, c.r) for c in cuts], "f long, n long, l long, r long").selectExpr(
        "cast(1000 as decimal(4,0)) * cast(f as decimal(17,0)) * cast(n as decimal(17,0)) div "
        "(cast(l as decimal(19,0)) * cast(r as decimal(19,0))) AS score")
    assert scored.first().score == 1000 * 10 ** 9 * 10 ** 11 // (3 * 10 ** 9 * 7 * 10 ** 9)


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(1, None, "en"), (2, "", None), (3, "good day", None), (3, "good day", None), (3, "Good\tDay", "und"), (4, "good day", "")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "'x' AS gram", "2 AS f")
    assert got(col.collocations(frame, min_count=2)) == brute(rows, 2, 100, 2000)
    empty = spark.createDataFrame([], SCHEMA)
    assert col.collocations(empty).count() == 0
    assert col.collocations(spark.createDataFrame([(1, "one two", "en")], SCHEMA)).count() == 0


def test_very_long_text(spark):
    text = "Some words stand here. " * 200_000
    out = got(col.collocations(spark.createDataFrame([(1, text, "en")], SCHEMA)))
    assert [r[2:4] for r in out] == [("some words stand here", 200_000)]


def test_gram_rows_are_frequent_phrases_once_a_task(spark, monkeypatch):
    """Frequent pairs of rare triples: rows grew with distinct runs of words and with splits of the input."""
    made, keep = {}, col.materialise

    def counted(frame, name):
        out = keep(frame, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(col, "materialise", counted)
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(100)), "en") for i in range(1000)]
    rows.append((-1, ", ".join(["lonely"] * 90), "en"))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(60)
    table, _ = col.frequent_words_and_pairs(frame, min_count=50)
    flows = {(tuple(r.gram.decode().split("\t")), r.f) for r in col.phrase_flows(frame, table, min_count=50).collect()}
    counts = Counter(tuple(w[i:i + k]) for w in (r[1].split(" ") for r in rows[:-1]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert flows == {x for x in counts.items() if x[1] >= 50}
    assert max(len(p) for p, _ in flows) == 2
    assert made["collocation-grams"] <= col.GRAM_TASKS * spark.sparkContext.defaultParallelism * len(flows)


@pytest.mark.parametrize("held", [1, 40, 1_000_000])
def test_sums_within_a_task(spark, monkeypatch, held):
    monkeypatch.setattr(col, "SUM_GRAMS", held)
    monkeypatch.setattr(col, "FLUSH_WORDS", 60)
    rows = random_rows(random.Random(7), 120, ["a", "b", "c", "d", "e f"])
    assert got(col.collocations(spark.createDataFrame(rows, SCHEMA).coalesce(2), min_count=4)) == brute(rows, 4, 100, 2000)
