import hashlib
import heapq
import random
import re
import time
import zlib

import pytest

from ledgerflow.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def possible(initials):
    """Whether some further messages can complete the initials."""
    return any(PATTERN.fullmatch(initials + more) for more in ("", "a", "ua"))


def cheapest(rows):
    """(cost, edits, repaired rows) by uniform-cost search over edit strings; rows are (role, text, fault)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, i, initials, put = heapq.heappop(heap)
        if i == len(rows) and PATTERN.fullmatch(initials):
            return cost, edits, put
        state = (i, initials[-1:], bool(initials))
        if state in done:
            continue
        done.add(state)
        options = []
        if i < len(rows):
            role, text, fault = rows[i]
            options.append((4, "D", i + 1, None))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                options.append((more, "K", i + 1, (role, text)))
                options += [(more + 3, "R", i + 1, (new, text)) for new in ("user", "assistant")]
        options += [(3, "I", i, (new, "")) for new in ("user", "assistant")]
        for price, edit, at, row in options:
            after = initials + ((row[0][:1] or " ") if row else "")
            if possible(after):
                heapq.heappush(heap, (cost + price, edits + edit, at, after, put + ((row,) if row else ())))


def expected(rows):
    """The contract's columns for one conversation's damaged rows [(turn, role, text)], by plain loops."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, marked, faults = set(), [], []
    for turn, role, text in rows:
        bare = text.strip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        marked.append((role, text, fault))
        faults.append(fault)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, edits, put = cheapest(marked)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in put).encode()).hexdigest()
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, edits, digest)


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(":".join(shown).encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def held(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def test_query_by_brute_force(spark):
    from ledgerflow.llm.catalog import LLM_QUERIES

    sf = "/root/testdata/sf0.01"
    got = held(LLM_QUERIES["op12_conversation_repair"](spark, sf))
    want = {c: expected(r) for c, r in damaged(map(tuple, spark.read.parquet(f"{sf}/conversations.parquet").collect())).items()}
    assert got == want


def test_search_by_brute_force(monkeypatch):
    rng = random.Random(5)
    names = {0: None, 1: "truncated", 2: "blank", 3: "duplicate"}
    role = {"s": "system", "u": "user", "a": "assistant", "t": "tool", " ": " "}
    for _ in range(1500):
        n = rng.randrange(8)
        initials = "".join(rng.choice("suaat uu"[:rng.choice((3, 4, 8))]) for _ in range(n))
        faults = bytes(rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(n))
        monkeypatch.setattr(repair, "BLOCK_ROWS", rng.choice((1, 2, 3, 100)))
        want = cheapest([(role[i], "", names[f]) for i, f in zip(initials, faults)])
        assert repair.repair(initials, faults) == want[:2], (initials, faults)


def test_estimates_never_exceed_the_cost():
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randrange(12)
        initials = "".join(rng.choice("suat") for _ in range(n))
        faults = bytes(rng.choice((0, 1, 2)) for _ in range(n))
        ends = repair.exit_costs("", b"")[1]
        for i, row in enumerate(repair.estimates(initials, faults, ends)):
            exact = repair.exit_costs(initials[i:], faults[i:])[0]
            assert all(guess <= cost for guess, cost in zip(row, exact))


def test_long_conversations_take_linear_time():
    rng = random.Random(7)
    t = time.perf_counter()
    n = 50_000
    initials = "".join("ua"[i % 2] if rng.random() > 0.1 else rng.choice("sua") for i in range(n))
    cost, edits = repair.repair(initials, bytes(rng.choices((0, 1, 2, 3), (85, 5, 5, 5), k=n)))
    assert cost > 0 and sum(e != "I" for e in edits) == n
    assert repair.repair("s" * 2000, bytes([1]) * 2000) == (8000, "D" * 2000)
    assert time.perf_counter() - t < 20


CASES = {
    1: [(0, "system", "Be kind."), (1, "user", "Hi."), (2, "assistant", "Hello.")],
    2: [(None, "assistant", "b."), (None, "user", "a."), (3, "assistant", "b."), (3, "assistant", "b."), (9, "", "x.")],
    3: [(0, "user", "same."), (1, "user", "same."), (2, "assistant", "same."), (5, "user", "cut"), (6, "assistant", "")],
    4: [(0, None, "no role."), (1, "user", None), (2, "tool", "result."), (3, "system", "late.")],
    None: [(0, "user", "of no one."), (None, "user", "\t\n ")],
}


def test_cases_nulls_ties_and_repeats(spark):
    rows = [(c, *r) for c, rs in CASES.items() for r in rs]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS fault", "'x' AS audit")
    got = held(repair.repair_conversations(frame))
    want = {c: expected([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rs]) for c, rs in CASES.items()}
    assert got == want
    assert got[1] == (0, 0, 0, 0, 0, 0, "KKK", hashlib.sha256(b"system:Be kind.\nuser:Hi.\nassistant:Hello.").hexdigest())


def test_conversations_without_rows_and_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    ids = spark.createDataFrame([(7, 0, "u", "t"), (7, 1, "u", "t"), (None, 1, "u", "t")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert held(repair.repair_conversations(nothing, ids)) == {c: (0, 0, 0, 0, 0, 0, "", empty) for c in (7, None)}
    assert repair.repair_damaged(nothing).count() == 0


@pytest.mark.parametrize("limit", [0, 300])
def test_texts_too_long_to_hold(spark, monkeypatch, limit):
    monkeypatch.setattr(repair, "HELD_BYTES", limit)
    rows = [(c, *r) for c, rs in CASES.items() for r in rs] + [(5, t, "user", "long words " * 20_000 + f"{t}.") for t in range(40)]
    shown = [tuple(" " if v is None and i > 1 else v for i, v in enumerate(r)) for r in rows]
    want = {c: expected([r[1:] for r in shown if r[0] == c]) for c in {r[0] for r in rows}}
    assert held(repair.repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(3))) == want


def test_damage_equals_the_plain_loops(spark):
    rows = [(c, t, r, x) for c in (None, 1, 2) for t in [None, *range(60)] for r, x in (("assistant", "a. b! c?"), (None, None))]
    got = sorted(map(str, map(tuple, repair.damage(spark.createDataFrame(rows, SCHEMA)).collect())))
    assert got == sorted(str((c, *r)) for c, rs in damaged(rows).items() for r in rs)
