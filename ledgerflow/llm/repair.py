"""Conversation structure repair by iterative-deepening A*.

A conversation's rows, in turn order, should read ``(s?(ua)+)?`` by their role
initials. Edits make it so: Keep a row (0), Rerole it to user or assistant (3),
Delete it (4; blank rows and duplicates must go), Insert an empty user or
assistant message anywhere (3); a truncated row that stays costs 3 more. The
cheapest edit string is wanted, and among equally cheap ones the first in ASCII
order (``D`` < ``I`` < ``K`` < ``R``).

``search`` is a depth-first search that tries edits in that order under a cost
bound, which grows to the least cost estimate that went beyond it. Estimates
add to the cost so far what the remaining rows need at least: the deletions and
truncated rows, and the best set of disjoint neighbours that do not go
together. A table of failed states (row, state of the pattern) keeps the budget
that wasn't enough, so no state is searched twice with the same budget or less.
The first path that accepts is the answer, as no cheaper one exists under the
earlier bounds.

Long conversations are searched block by block: ``exit_costs`` gives the exact
cost of everything behind a block for each state of the pattern, so the blocks'
answers joined are the whole answer, and time stays linear in the rows.

Rows meet by conversation in one sorted shuffle and are read as a stream. Only a
byte or two a row is kept for the search; a conversation's texts are held up to
``HELD_BYTES`` and read again in a second sorted pass where they are longer (the
digest of a conversation is sequential, so one task streams it in any case).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.storage import materialise

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: Faults of a row, the first one counts.
NONE, TRUNCATED, BLANK, DUPLICATE = 0, 1, 2, 3
#: Rows that one search covers.
BLOCK_ROWS = 96
#: Texts of one conversation that a task holds until its edits are known.
HELD_BYTES = 16 * 1024 * 1024

#: States of the pattern: START (nothing yet), SYSTEM, USER, ASSISTANT by the role read last.
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
#: Next state by the initial of a role; a pair that is absent does not fit.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: State after a user or assistant message that may be put here, the only one that fits.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
ACCEPTING = (START, ASSISTANT)
NEVER = 10 ** 9

_BLANK = r"[^\x20\x09-\x0D]"
_SPACE = "[\\x20\\x09-\\x0D]"


def exit_costs(initials: str, faults: bytes) -> list[tuple[int, int, int, int]]:
    """Least cost of all rows from each block's border on, by state; one entry a border, the end included.

    One pass from the end, four numbers a row; only those at borders are kept.
    """
    costs = [0, NEVER, NEVER, 0]
    borders = [_with_inserts(costs)]
    for i in range(len(initials) - 1, -1, -1):
        costs = _before(initials[i], faults[i], _with_inserts(costs))
        if i % BLOCK_ROWS == 0:
            borders.append(_with_inserts(costs))
    return borders[::-1] if initials else [borders[0], borders[0]]


def _with_inserts(costs: list[int]) -> list[int]:
    """Cost by state where messages may be inserted first."""
    costs = list(costs)
    for _ in range(3):
        for state in range(4):
            costs[state] = min(costs[state], INSERT_COST + costs[NEXT[state]])
    return costs


def _before(initial: str, fault: int, after: list[int]) -> list[int]:
    out = []
    for state in range(4):
        best = DELETE_COST + after[state]
        if fault < BLANK:
            more = TRUNCATED_COST if fault else 0
            kept = STEP.get((state, initial))
            if kept is not None:
                best = min(best, more + after[kept])
            best = min(best, more + REROLE_COST + after[NEXT[state]])
        out.append(best)
    return out


def estimates(initials: str, faults: bytes, ends: tuple[int, int, int, int]) -> list[tuple[int, int, int, int]]:
    """For each row and state, a cost that the rows from there on need at least (the last entry: ``ends``).

    Forced: a row that must go costs 4, a truncated one 3. Structural: two neighbours among the other rows whose
    initials do not follow each other need an edit of one of them or between them, 3 at least, or 1 more than already
    counted where a truncated row is deleted instead. Pairs without a common row add up; the best set of them is found
    from the end. The state before the row counts as a neighbour; what comes after all rows costs the least of ``ends``.
    """
    follows = {("s", "u"), ("u", "a"), ("a", "u")}
    least = min(ends)
    out = [ends]
    forced = 0
    next_initial, next_fault = "", 0    # the nearest later row that may stay
    pairs_here, pairs_behind = 0, 0     # best sets over the rows from the nearest one on, and from the one behind it
    for i in range(len(initials) - 1, -1, -1):
        fault = faults[i]
        if fault >= BLANK:
            forced += DELETE_COST
        else:
            forced += TRUNCATED_COST if fault else 0
            best = pairs_here
            if next_initial and (initials[i], next_initial) not in follows:
                best = max(best, (1 if fault or next_fault else 3) + pairs_behind)
            pairs_behind, pairs_here = pairs_here, best
            next_initial, next_fault = initials[i], fault
        row = []
        for state in range(4):
            pairs = pairs_here
            if next_initial and (state, next_initial) not in STEP:
                pairs = max(pairs, (1 if next_fault else 3) + pairs_behind)
            row.append(forced + pairs + least)
        out.append(tuple(row))
    return out[::-1]


def search(initials: str, faults: bytes, state: int, ends: tuple[int, int, int, int]) -> tuple[str, int]:
    """(edits, state behind them) of the cheapest way over the rows, the first in ASCII order among equals.

    ``ends`` is the cost by state of what follows the rows; the edits end with the last row.
    """
    n = len(initials)
    least = estimates(initials, faults, ends)
    bound = least[0][state]
    while True:
        failed: dict[tuple[int, int], int] = {}
        beyond = NEVER
        # Depth-first with an explicit stack of (row, state, budget left, edits still to try).
        path: list[str] = []
        stack = [(0, state, bound, iter("DIKR"))]
        while stack:
            i, at, left, edits = stack[-1]
            if i == n and ends[at] <= left:
                return "".join(path), at
            for edit in edits if i < n else "":
                row, to, cost = i + 1, at, 0
                if edit == DELETE:
                    cost = DELETE_COST
                elif edit == INSERT:
                    row, to, cost = i, NEXT[at], INSERT_COST
                elif faults[i] >= BLANK:
                    continue
                elif edit == KEEP:
                    to = STEP.get((at, initials[i]), -1)
                    if to < 0:
                        continue
                    cost = TRUNCATED_COST if faults[i] else 0
                else:
                    to, cost = NEXT[at], REROLE_COST + (TRUNCATED_COST if faults[i] else 0)
                rest = left - cost
                need = least[row][to]
                if need > rest:
                    beyond = min(beyond, bound - rest + need)
                elif failed.get((row, to), -1) < rest:
                    path.append(edit)
                    stack.append((row, to, rest, iter("DIKR")))
                    break
            else:
                failed[i, at] = max(failed.get((i, at), -1), left)
                if i == n:
                    beyond = min(beyond, bound - left + ends[at])
                stack.pop()
                if path:
                    path.pop()
        if beyond >= NEVER:
            raise AssertionError("no edits lead to a valid conversation")
        bound = beyond


def repair(initials: str, faults: bytes) -> tuple[int, str]:
    """(cost, edits) for a conversation's role initials (one character a row) and faults (one byte a row)."""
    borders = exit_costs(initials, faults)
    state, parts = START, []
    for k, first in enumerate(range(0, len(initials), BLOCK_ROWS)):
        part, state = search(initials[first:first + BLOCK_ROWS], faults[first:first + BLOCK_ROWS], state, borders[k + 1])
        parts.append(part)
    while state not in ACCEPTING:  # behind the last row
        parts.append(INSERT)
        state = NEXT[state]
    return borders[0][START], "".join(parts)


class Rewriter:
    """Applies edits to a stream of (role, text) rows and digests the outcome."""

    def __init__(self, edits: str):
        self._edits, self._at, self._state = edits, 0, START
        self._digest, self._first = hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self._digest.update(f"{'' if self._first else chr(10)}{role}:{text}".encode())
        self._first = False

    def _inserts(self) -> None:
        while self._edits[self._at:self._at + 1] == INSERT:
            self._state = NEXT[self._state]
            self._put(ROLE[self._state], "")
            self._at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self._edits[self._at]
        self._at += 1
        if edit == KEEP:
            self._state = STEP[self._state, role[:1]]
            self._put(role, text)
        elif edit == REROLE:
            self._state = NEXT[self._state]
            self._put(ROLE[self._state], text)

    def digest(self) -> str:
        self._inserts()
        return self._digest.hexdigest()


# ------------------------------------------------------------------ on Spark

#: Parts that the turns of one digest are dealt to, so that no task meets a frequent message whole.
SALTS = 16


def damage(conversations: DataFrame) -> DataFrame:
    """The damaged rows (conv_id, turn, role, text) of the check query, by ``crc32(conv_id:turn) % 20``.

    Nulls read as one space in the key, and so do null roles and texts. 0 drops the row, 1 empties its text, 2 removes
    sentence ends, 3 repeats it, 4 makes it the user's.
    """
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(shown("conv_id"), F.lit(":"), shown("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1))
    return rows.where("kind != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                          F.explode(F.array_repeat(F.lit(True), copies)).alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with ``fault``, the row's first one.

    A row whose role and text an earlier turn of the conversation has is a duplicate; equal rows of one turn are told
    apart later, when the rows are read in order. First turns are found per (conversation, digest) from
    pre-aggregated turns, salted, and only digests with several turns are joined back.
    """
    marked = rows.select(
        "conv_id", "turn", "role", "text",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256).alias("same"),
        (~F.col("text").rlike(_BLANK)).alias("blank"),
        (~F.regexp_extract("text", f"([^\\x20\\x09-\\x0D]){_SPACE}*\\z", 1).rlike("[.!?]")).alias("truncated"))
    salt = F.pmod(F.xxhash64("turn"), F.lit(SALTS))
    salted = (marked.where("not blank").groupBy("conv_id", "same", salt.alias("salt"))
              .agg(F.min("turn").alias("first"), F.max("turn").alias("last"), F.max(F.col("turn").isNull().cast("int")).alias("unplaced")))
    firsts = (salted.groupBy("conv_id", "same").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max("unplaced").alias("unplaced"))
              .where("first < last or (unplaced = 1 and first is not null)")
              .select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "first", "unplaced",
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    joined = marked.withColumn("key_salt", salt).join(
        firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")) & (F.col("key_salt") == F.col("salt")), "left")
    # a row without a turn comes before all others
    repeated = F.coalesce(F.col("turn").isNotNull() & ((F.col("unplaced") == 1) | (F.col("first") < F.col("turn"))), F.lit(False))
    fault = (F.when(F.col("blank"), F.lit(BLANK)).when(repeated, F.lit(DUPLICATE)).when(F.col("truncated"), F.lit(TRUNCATED))
             .otherwise(F.lit(NONE)).cast("int"))
    return joined.select("conv_id", "turn", "role", "text", fault.alias("fault"))


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
_ORDER = ["conv_id", "turn", "role", "text"]


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for at in range(0, batch.num_rows, 512):
            yield from zip(*[c.slice(at, 512).to_pylist() for c in columns])


def _batch(out: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.string()) for f in RESULT.split(", ")])
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)


class _Conversation:
    """What is kept of one conversation while its rows go by."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.initials: list[str] = []
        self.faults = bytearray()
        self.illegal = self.turns = 0
        self.low = self.high = self.turn = None
        self.before = None
        self.held: list[tuple[str, str]] | None = []
        self.held_bytes = 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        same = self.before == (turn, role, text)
        if same and fault < BLANK:
            fault = DUPLICATE
        self.before = (turn, role, text)
        initial = role[:1] or " "
        if self.initials and self.initials[-1] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initials.append(initial)
        self.faults.append(fault)
        if turn is not None:
            if turn != self.turn:
                self.turns += 1
            self.low, self.high, self.turn = (turn if self.low is None else self.low), turn, turn
        if self.held is not None:
            self.held.append((role, text))
            self.held_bytes += 2 * len(role) + 4 * len(text) + 200
            if self.held_bytes > HELD_BYTES:
                self.held = None

    def result(self) -> tuple:
        faults = bytes(self.faults)
        cost, audit = repair("".join(self.initials), faults)
        digest = None
        if self.held is not None:
            rewriter = Rewriter(audit)
            for role, text in self.held:
                rewriter.row(role, text)
            digest = rewriter.digest()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), self.illegal,
                cost, audit, digest)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation -> one result each."""
    out: list[tuple] = []
    now = None
    for conv_id, turn, role, text, fault in _streams(batches):
        if now is None or now.conv_id != conv_id:
            if now is not None:
                out.append(now.result())
            now = _Conversation(conv_id)
        now.add(turn, role, text, fault)
        if len(out) >= 1000:
            yield _batch(out)
            out = []
    if now is not None:
        out.append(now.result())
        yield _batch(out)


def _digest_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, turn, role, text, audit) sorted, the audit's own row first in each conversation -> (conv_id, digest)."""
    now, rewriter, out = None, None, []
    for conv_id, _, _, role, text, audit in _streams(batches):
        if audit is not None:
            if rewriter is not None:
                out.append((now, rewriter.digest()))
            now, rewriter = conv_id, Rewriter(audit)
        else:
            rewriter.row(role, text)
    if rewriter is not None:
        out.append((now, rewriter.digest()))
    yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([d for _, d in out], pa.string())],
                                     names=["conv_id", "digest"])


def repair_conversations(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): its faults, the cheapest edits and their digest.

    Rows are taken by turn (nulls first), then role, then text; equal rows stand next to each other, the later ones are
    duplicates. Nulls in role and text read as one space, which makes the text blank and fits no role; so does an empty
    role. A null conversation id is a conversation like any other. ``conversations`` names more ids that the result
    holds: without rows they have zeros, an empty audit and the digest of nothing. Further columns are not read.
    """
    shown = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    faulty = with_faults(shown)
    ordered = faulty.repartition("conv_id").sortWithinPartitions(*[F.asc_nulls_first(c) for c in _ORDER])
    solved = materialise(ordered.mapInArrow(_solve, RESULT), "repair-solved")
    long = solved.where("repaired_sha256 is null").select("conv_id", "audit")
    if not long.isEmpty():
        ids = long.select(F.col("conv_id").alias("c"))
        texts = shown.join(ids, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
        both = (texts.select("conv_id", F.lit(1).alias("part"), "turn", "role", "text", F.lit(None).cast("string").alias("audit"))
                .unionByName(long.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"),
                                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit")))
        digests = (both.repartition("conv_id")
                   .sortWithinPartitions("conv_id", "part", *[F.asc_nulls_first(c) for c in _ORDER[1:]])
                   .mapInArrow(_digest_long, "conv_id long, digest string"))
        digests = digests.select(F.col("conv_id").alias("c"), "digest")
        solved = (solved.join(digests, F.col("conv_id").eqNullSafe(F.col("c")), "left")
                  .withColumn("repaired_sha256", F.coalesce("repaired_sha256", "digest")).drop("c", "digest"))
    if conversations is None:
        return solved
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    found = ids.join(solved, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The check query: ``conversations`` damaged, then repaired; every original id is in the result."""
    return repair_conversations(damage(conversations), conversations)
