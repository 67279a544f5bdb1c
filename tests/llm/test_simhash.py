import numpy as np
import pytest
import xxhash

from ledgerflow.llm import simhash as sh


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, ids):
    """Smallest id of each connected component."""
    parent = list(range(len(values)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= sh.MAX_BITS:
                parent[find(i)] = find(j)
    least = {}
    for i, k in enumerate(ids):
        least[find(i)] = min(least.get(find(i), k), k)
    return [least[find(i)] for i in range(len(values))]


TEXTS = [None, "", " \n", "one", "One two", "a b c", "A B\tC", "a b c d e f g", "é É x y z", "w " * 5000]


def test_fingerprints():
    assert [sh.fingerprint(t) for t in TEXTS] == [brute_print(t) for t in TEXTS]


def test_golay_code_is_perfect():
    errors = sh.golay_errors()
    assert len(set(errors.tolist())) == 2048 and max(bin(e).count("1") for e in errors.tolist()) == 3
    words = np.arange(1 << 12) << 11
    coded = words ^ errors[sh.golay_syndrome(words)]
    assert not sh.golay_syndrome(coded).any()


def test_every_pair_within_two_bits_shares_a_key(rng):
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 2)):
            b ^= 1 << bit
        rows, keys = sh.fuzzy_keys(np.array([a, b], np.uint64).view(np.int64))
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


def _values(rng):
    """Distinct fingerprints: scattered ones, chains, and a dense group that fills large buckets."""
    base = rng.getrandbits(64)
    dense = {base ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    chain = [rng.getrandbits(64)]
    for _ in range(30):
        chain.append(chain[-1] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    return sorted({*dense, *chain, *(rng.getrandbits(64) for _ in range(200)), 0, 1, (1 << 64) - 1})


@pytest.mark.parametrize("small", [sh.SMALL_BUCKET, 4])
def test_roots_equal_brute_force(spark, rng, monkeypatch, small):
    monkeypatch.setattr(sh, "SMALL_BUCKET", small)
    values = _values(rng)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed + signed[:3]], "fingerprint long")
    got = {r["fingerprint"]: r["root"] for r in sh.rooted(frame).collect()}
    groups = brute_groups(values, list(range(len(values))))
    assert len(got) == len(values)
    seen = {}
    for v, g in zip(signed, groups):
        assert seen.setdefault(g, got[v]) == got[v]
    assert len(set(seen.values())) == len(seen)


def test_group_and_keep_one(spark, make_docs, rng):
    words = [f"w{i}" for i in range(300)]
    near = words[:150] + ["x"] + words[151:]
    docs = make_docs([(7, " ".join(words)), (3, " ".join(words)), (9, " ".join(near)), (1, "clean text of its own here"),
                      (20, None), (21, ""), (None, " ".join(words)), (7, " ".join(words)), (4, "another one altogether")])
    docs = docs.selectExpr("*", "1 AS fingerprint")
    rows = sh.group(docs).collect()
    prints = [brute_print(t) for t in (" ".join(words), " ".join(near))]
    linked = bin(prints[0] ^ prints[1]).count("1") <= 2
    want = {7: 3, 3: 3, 9: 3 if linked else 9, 1: 1, 20: 20, 21: 20, None: 3, 4: 4}
    assert len(rows) == 9 and all(r["component_id"] == want[r["doc_id"]] for r in rows)
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (20, 21)} == {"0" * 16}
    kept = sh.keep_one(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(want.values()))
    assert kept[0].asDict().keys() == docs.first().asDict().keys()


@pytest.mark.parametrize("table_bits", [sh.TABLE_BITS, 1 << 15])
def test_keep_one_on_many_copies(spark, make_docs, rng, monkeypatch, table_bits):
    """Copies under other ids, whole rows repeated, and one text that a third of all rows hold; the bits may all be set."""
    monkeypatch.setattr(sh, "TABLE_BITS", table_bits)
    monkeypatch.setattr(sh, "BITS_A_ROW", 64 if table_bits > 1 << 15 else 1)
    texts = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randint(0, 10**6)) for _ in range(12)) for _ in range(300)]
    rows = list(enumerate(texts)) + [(1000 + i, texts[i % 40]) for i in range(120)] + [(2000 + i, texts[5]) for i in range(400)]
    rows += rows[:60] + [(7, "same id but quite another text of some words")] * 3
    docs = make_docs(rows).selectExpr("*", "'own' AS stays", "doc_id AS h", "1 AS maybe").repartition(7)
    values = [brute_print(t) for _, t in rows]
    groups = brute_groups(values, list(range(len(rows))))
    best = {}
    for (i, t), g in zip(rows, groups):
        if g not in best or i < best[g][0]:
            best[g] = (i, t)
    kept = sh.keep_one(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted(best.values())
    assert all((r["stays"], r["h"], r["maybe"]) == ("own", r["doc_id"], 1) for r in kept)


def test_bit_table_holds_just_its_hashes(spark):
    bits = 1 << 17
    frame = spark.range(-1000, 1000).selectExpr("xxhash64(id) AS h", "id")
    marked = sh._in_table(frame, sh._bit_table(frame.where("id % 7 = 0").select("h"), bits), bits).collect()
    cells = {r["h"] % bits for r in marked if r["id"] % 7 == 0}
    assert len(marked) == 2000 and all(r["maybe"] == (r["h"] % bits in cells) for r in marked)


def test_null_ids_and_empty_tables(spark, make_docs):
    docs = make_docs([(None, "same words here now"), (None, "same words here now")])
    assert {r["component_id"] for r in sh.group(docs).collect()} == {None}
    assert sh.keep_one(docs).count() == 1
    assert sh.group(make_docs([])).count() == 0 and sh.keep_one(make_docs([])).count() == 0
