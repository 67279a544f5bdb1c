"""Benchmark decontamination by an FM-index over each shard of the training texts.

A window is WINDOW consecutive words of a benchmark item; an item of fewer
words is one window. Each task cuts its texts into shards of bounded size,
indexes a shard's words (:mod:`ledgerflow.llm.fm_index`), searches all windows
backward at once, locates their occurrences and merges the covered words into
removal spans. Words that no window holds are stops in the index: they part
the text and are never sorted among the words.

The windows are the query set. They reach the tasks in broadcasts of bounded
size, which a task reads one at a time, so a benchmark of any size is searched
whole; texts are never shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from ledgerflow.llm.arrow import with_columns
from ledgerflow.llm.fm_index import FMIndex

WINDOW = 10
#: Words of a shard; a longer text is indexed in pieces that overlap by the longest window.
SHARD_WORDS = 250_000
#: Benchmark words of one broadcast of windows; an item that alone has more has one of its own.
BLOCK_WORDS = 1_000_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case; null has none."""
    return _WORD.findall(text.encode().lower()) if text else []


@dataclass
class Phrases:
    """The distinct windows of some benchmark items."""

    vocabulary: dict[bytes, int]
    matrix: np.ndarray  # (windows, WINDOW) word numbers from 1, right-aligned
    lengths: np.ndarray
    first: np.ndarray  # items of window p: items[first[p]:first[p + 1]]
    items: np.ndarray
    names: list[str]

    @classmethod
    def of(cls, rows: list[tuple[object, list[bytes]]], window: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        held: dict[tuple[int, ...], set[int]] = {}
        names = sorted({"" if item is None else str(item) for item, _ in rows})
        number = {name: i for i, name in enumerate(names)}
        for item, words in rows:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
            for at in range(max(1, len(ids) - window + 1)):
                held.setdefault(tuple(ids[at:at + window]), set()).add(number["" if item is None else str(item)])
        matrix = np.zeros((len(held), window), np.int64)
        for p, ids in enumerate(held):
            matrix[p, window - len(ids):] = ids
        lengths = np.array([len(ids) for ids in held], np.int64)
        sizes = [len(x) for x in held.values()]
        items = np.array([i for x in held.values() for i in sorted(x)], np.int64)
        return cls(vocabulary, matrix, lengths, np.concatenate([[0], np.cumsum(sizes)]), items, names)

    def translated(self, words: list[bytes], number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows that ``words`` can make, in the words' ``number``, and which windows these are."""
        to = np.full(len(self.vocabulary) + 1, -1, np.int64)
        own = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        to[own[own > 0]] = number[own > 0]
        to[0] = 0
        matrix = to[self.matrix]
        asked = np.flatnonzero((matrix >= 0).all(axis=1))
        return matrix[asked], asked


def phrase_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The items' windows, in blocks; the driver holds one block and one partition at a time. Items without words have none."""
    rows, held = [], 0
    for row in benchmark.select(id_col, text_col).toLocalIterator():
        words = words_of(row[1])
        if words:
            rows.append((row[0], words))
            held += len(words)
        if held >= block_words:
            yield Phrases.of(rows, window)
            rows, held = [], 0
    if rows:
        yield Phrases.of(rows, window)


def _shards(sizes: np.ndarray, window: int, shard_words: int) -> Iterator[list[tuple[int, int]]]:
    """Runs [from, to) of the concatenated texts, grouped into shards of about ``shard_words`` words."""
    shard, held, at = [], 0, 0
    for size in sizes.tolist():
        for start in range(0, size, shard_words):
            stop = min(size, start + shard_words + window - 1)
            shard.append((at + start, at + stop))
            held += stop - start
            if held >= shard_words:
                yield shard
                shard, held = [], 0
            if stop == size:
                break
        at += size
    if shard:
        yield shard


@dataclass
class Hits:
    covered: list[np.ndarray]  # per text, a flag per word
    items: list[set[str]]  # per text, the items with occurring windows


def _numbered(words: list[bytes], blocks: Iterable[Phrases]) -> np.ndarray:
    """A number from 1 for each distinct word that a window of any block has, else 0."""
    known = np.zeros(len(words), bool)
    for phrases in blocks:
        known |= np.fromiter((w in phrases.vocabulary for w in words), bool, len(words))
    return np.where(known, np.cumsum(known), 0)


def find(texts: list[list[bytes]], blocks: Iterable[Phrases], window: int = WINDOW, shard_words: int = SHARD_WORDS) -> Hits:
    """Covered words and occurring items of each text (a list of words).

    A shard is indexed once, over the words of all blocks, and searched block by block; of a block those windows are
    asked whose words all occur in ``texts``. ``blocks`` is gone through once and then once a shard.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    ends, seen = np.cumsum(sizes), {}
    local = np.fromiter((seen.setdefault(w, len(seen)) for t in texts for w in t), np.int64, int(sizes.sum()))
    edges = np.zeros(len(local) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    words = list(seen)
    number = _numbered(words, blocks)
    for shard in _shards(sizes, window, shard_words):
        parts, origin, at = [], [], 0
        for start, stop in shard:
            parts += [number[local[start:stop]], np.zeros(1, np.int64)]
            origin.append((at, start))
            at += stop - start + 1
        symbols = np.concatenate(parts)
        if not symbols.any():
            continue
        index, (in_shard, in_all) = FMIndex(symbols, int(number.max())), np.array(origin).T
        for phrases in blocks:
            matrix, asked = phrases.translated(words, number)
            low, high = index.search(matrix, phrases.lengths[asked])
            found = np.flatnonzero(high > low)
            count = (high - low)[found]
            if not len(found):
                continue
            phrase = np.repeat(asked[found], count)
            row = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[found], count)
            place = index.locate(row)
            piece = np.searchsorted(in_shard, place, side="right") - 1
            place = place - in_shard[piece] + in_all[piece]
            np.add.at(edges, place, 1)
            np.add.at(edges, place + phrases.lengths[phrase], -1)
            text = np.searchsorted(ends, place, side="right")
            pairs = np.unique(text * len(phrases.lengths) + phrase)
            for t, p in zip(*(x.tolist() for x in np.divmod(pairs, len(phrases.lengths)))):
                items[t].update(phrases.names[i] for i in phrases.items[phrases.first[p]:phrases.first[p + 1]])
    covered = np.cumsum(edges)[:-1] > 0
    return Hits(np.split(covered, ends[:-1]) if len(texts) else [], items)


def spans(covered: np.ndarray) -> list[tuple[int, int]]:
    """Merged runs [from, to) of covered words."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def cut(text: str, removed: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what stands between the words of one span."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.lower())]
    at, kept = 0, []
    for start, stop in removed:
        kept.append(raw[at:places[start][0]])
        at = places[stop - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


class _Stored:
    """The values of broadcasts, one at a time and as often as asked; not ``.value``, which would keep them all in memory."""

    def __init__(self, broadcasts: list):
        self.broadcasts = broadcasts

    def __iter__(self) -> Iterator[Phrases]:
        return (b.load_from_path(b._path) for b in self.broadcasts)


class Search:
    """The broadcast windows; picklable, used inside tasks."""

    def __init__(self, benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int):
        context = benchmark.sparkSession.sparkContext
        self.window = window
        self.blocks = [context.broadcast(b) for b in phrase_blocks(benchmark, id_col, text_col, window, block_words)]

    def __call__(self, texts: list[list[bytes]], shard_words: int = SHARD_WORDS) -> Hits:
        blocks = [b.value for b in self.blocks] if len(self.blocks) == 1 else _Stored(self.blocks)
        return find(texts, blocks, self.window, shard_words)


def report(df: DataFrame, benchmark: DataFrame, text_col: str = "text", carry: list[str] | None = None,
           item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """Add ``n_words``, ``n_hit`` (words in occurrences), ``n_items``, ``items_sha256``, ``contaminated`` and ``spans``.

    ``items_sha256`` is of the items' ids, sorted as strings and joined by commas; a null id counts as the empty
    string, rows of one id as one item. Null and empty texts have no words and no hits. An empty benchmark hits
    nothing. Columns of these names give way. No shuffle.
    """
    search = Search(benchmark, item_col, item_text_col, window, block_words)

    def compute(texts):
        words = [words_of(t) for t in texts]
        hits = search(words)
        n_hit = [int(np.count_nonzero(c)) for c in hits.covered]
        return {
            "n_words": [len(w) for w in words], "n_hit": n_hit, "n_items": [len(i) for i in hits.items],
            "items_sha256": [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in hits.items],
            "contaminated": [n > 0 for n in n_hit],
            "spans": [[{"start": a, "stop": b} for a, b in spans(c)] if n else [] for n, c in zip(n_hit, hits.covered)]}

    results = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
               "spans array<struct<start: long, stop: long>>")
    return with_columns(df, [text_col], carry, results, compute)


def clean(df: DataFrame, benchmark: DataFrame, text_col: str = "text", carry: list[str] | None = None,
          item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """Replace the text by itself without its removal spans and add ``emptied``: it had words and lost them all.

    Texts that lost words are searched again until no window is left, as the words beside a span meet. Texts
    without hits, null included, stay as they are.
    """
    search = Search(benchmark, item_col, item_text_col, window, block_words)

    def compute(texts):
        out, emptied, ask = list(texts), [False] * len(texts), list(range(len(texts)))
        while ask:
            hits, changed = search([words_of(out[i]) for i in ask]), []
            for i, covered in zip(ask, hits.covered):
                if covered.any():
                    out[i] = cut(out[i], spans(covered))
                    emptied[i] = bool(covered.all())
                    changed.append(i)
            ask = changed
        return {text_col: out, "emptied": emptied}

    return with_columns(df, [text_col], carry, f"`{text_col}` string, emptied boolean", compute)


def report_sql(docs: str = "documents", benchmark: str = "benchmark") -> str:
    """DuckDB SQL for the digest columns of :func:`report`: a join on whole windows."""
    def words(table: str, key: str) -> str:
        return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                f"'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}")

    return f"""
WITH d AS ({words(docs, 'doc_id')}), b AS ({words(benchmark, 'item_id')}),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, i, n FROM places JOIN windows USING (n, words)),
covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS items
          FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""
