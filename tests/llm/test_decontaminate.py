import hashlib
import re

import numpy as np
import pytest

from ledgerflow.llm import decontaminate as dc
from ledgerflow.llm.fm_index import FMIndex, suffix_array


def brute(texts, items, window=dc.WINDOW):
    out = []
    windows = [(str(i) if i is not None else "", w[a:a + window]) for i, t in items for w in [dc.words_of(t)] if w
               for a in range(max(1, len(w) - window + 1))]
    for text in texts:
        words, hit, found = dc.words_of(text), set(), set()
        for item, w in windows:
            for a in range(len(words) - len(w) + 1):
                if words[a:a + len(w)] == w:
                    hit.update(range(a, a + len(w)))
                    found.add(item)
        out.append((len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def test_words():
    assert dc.words_of("Ab-cé_9 É日本\t") == ["ab".encode(), "cé".encode(), b"9", "É日本".encode()]
    assert dc.words_of(None) == dc.words_of("") == []


def test_suffix_array_with_stops():
    s = np.array([2, 1, 0, 2, 1, 0, 2, 1])
    def key(p):
        return [(0, q) if s[q] == 0 else (1, int(s[q])) for q in range(p, len(s))]
    assert suffix_array(s).tolist() == sorted(range(len(s)), key=key)


def test_search_and_locate(rng):
    for _ in range(40):
        s = np.array([rng.randint(0, 3) for _ in range(rng.randint(1, 150))] * 2)
        index = FMIndex(s, 3)
        phrase = [rng.randint(1, 3) for _ in range(rng.randint(1, 4))]
        low, high = index.search(np.array([[0] * (4 - len(phrase)) + phrase]), np.array([len(phrase)]))
        want = [i for i in range(len(s)) if s[i:i + len(phrase)].tolist() == phrase]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def _case(rng):
    words = ["the", "of", "and", "x1", "é", "to", "in"]
    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 30]))) for i in range(6)] + [(None, text(12)), (2, text(15)), (9, None), (10, "..."), (11, "")]
    texts = [None, "", "...", text(400)] + [text(20) + " " + (items[i % 8][1] or "").upper() + "; " + text(rng.randint(0, 30)) for i in range(20)]
    return [*texts, texts[-1]], items


@pytest.mark.parametrize("block_words", [dc.BLOCK_WORDS, 10])
def test_report_equals_brute_force(spark, make_docs, rng, block_words):
    texts, items = _case(rng)
    docs = make_docs(texts).selectExpr("*", "1 AS N_Hit")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(dc.report(docs, benchmark, block_words=block_words).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got] == brute(texts, items)
    for r in got:
        assert sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_hit"]


def test_pieces_of_long_texts(rng):
    texts, items = _case(rng)
    rows = [(i, dc.words_of(t)) for i, t in items if dc.words_of(t)]
    phrases = dc.Phrases.of(rows, dc.WINDOW)
    words = [dc.words_of(t) for t in texts]
    whole, small = dc.find(words, [phrases]), dc.find(words, [phrases], shard_words=13)
    assert all((a == b).all() for a, b in zip(whole.covered, small.covered)) and whole.items == small.items


def test_shards_are_indexed_once_for_all_blocks(rng, monkeypatch):
    texts, items = _case(rng)
    words = [dc.words_of(t) for t in texts]
    rows = [(i, dc.words_of(t)) for i, t in items if dc.words_of(t)]
    blocks = [dc.Phrases.of([row], dc.WINDOW) for row in rows]
    built = []
    monkeypatch.setattr(dc, "FMIndex", lambda *args: built.append(1) or FMIndex(*args))
    whole = dc.find(words, [dc.Phrases.of(rows, dc.WINDOW)], shard_words=50)
    once = len(built)
    apart = dc.find(words, blocks, shard_words=50)
    assert len(built) == 2 * once and once > 1
    assert all((a == b).all() for a, b in zip(whole.covered, apart.covered)) and whole.items == apart.items


def test_clean_leaves_no_window_and_clean_texts_alone(spark, make_docs):
    item = "one two three four five six seven eight nine ten eleven"
    texts = ["Keep this. " + item.upper() + "! And this.", "no hit here", None, "", item,
             # the cut joins the two halves of another occurrence
             "one two three four five " + item + " six seven eight nine ten eleven tail"]
    out = [r for r in sorted(dc.clean(make_docs(texts), spark.createDataFrame([(1, item)], "item_id long, text string")).collect(), key=lambda r: r["doc_id"])]
    assert [r["text"] for r in out[:4]] == ["Keep this. ! And this.", "no hit here", None, ""]
    assert [r["emptied"] for r in out] == [False, False, False, False, True, False]
    assert re.findall(r"\w+", out[5]["text"]) == ["tail"]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.report(make_docs([]), none).count() == 0
    row = dc.report(make_docs(["a b"]), none).first()
    assert (row["n_words"], row["n_hit"], row["items_sha256"]) == (2, 0, hashlib.sha256(b"").hexdigest())
