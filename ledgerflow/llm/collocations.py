"""Phrase collocation mining on a weighted de Bruijn graph.

A text is cut into pieces and those into words. Every word begins a gram, the
longest run of up to ``ORDER`` words that its piece has from there. A whole gram
is an edge of the graph, from the node of its first ``ORDER - 1`` words to that
of its last; a shorter gram ends with its piece and is the node's correction.
Equal grams are summed, first within a task and then over all tasks, so the
shuffle carries one row per distinct gram and task.

Shorter counts come from the flow of the nodes: a phrase occurs as often as the
edges that leave it together, plus the pieces that end with it. Grams are
range-partitioned and sorted by word, so the phrases that begin alike stand next
to each other and one pass with ``ORDER`` counters sums them all. A frequent
first word or pair spreads over many partitions; the phrases that reach over a
partition's border come out as parts, a few per partition, and are summed again.

A phrase whose whole flow goes into one longer phrase lies inside a unary path,
and the path stands for it. Frequent edges that follow each other without loss
are compacted to such paths (pointer doubling over the links); a path is the
passage around a phrase that recurs as often as the phrase does.

Words, pairs and triples below the minimum count cannot be part of a frequent
phrase, so grams end before they would hold one. A first pass counts the hashes
of words and pairs, a second those of the triples of frequent pairs (as sorted,
packed blocks, a byte or two an entry), and bit tables of fixed size tell the
frequent ones. Words outside all frequent pairs begin no phrase and are no part
of one, so nobody asks for their counts and they make no grams. Hashes that two
triples share only let a rare one pass, which costs rows, not exactness: all
counts are of words as text.

What is left are little more than the frequent phrases, each once a task. Tasks
as many as the session's cores ask for, not as the input has splits, keep these
rows from growing with the product of both.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.storage import materialise

#: Words of the longest phrase, an edge of the graph.
ORDER = 5
#: Occurrences of a phrase.
MIN_COUNT = 100
#: A phrase goes when a longer one around it has at least this share of its occurrences, in per cent.
ABSORB_PERCENT = 100
#: Phrases of each language in the report.
TOP = 2000
#: Words that a task sums at once, and bytes of text that it cuts into words at once; they bound its memory.
FLUSH_WORDS, CUT_BYTES = 6_000_000, 4_000_000
#: Grams that a task holds to sum equal ones, and tasks per core that make grams.
SUM_GRAMS, GRAM_TASKS = 2_000_000, 1
#: Bits of a table of frequent words and pairs, or triples (8 MB), however many there are.
TABLE_BITS = 1 << 26
#: Parts that a key's rows are dealt to where many rows may look up one key.
SALTS = 16

# Piece separators, blanks inside a piece, and the language of rows without one.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
NO_LANG = "und"

#: Separator of a gram's words: below all other bytes of a gram, so that grams that begin alike are neighbours when sorted.
_TAB = b"\t"
#: Bytes below the separator stand as this byte, which no word holds, and a letter.
_ESCAPE = b"\n"
_CONTROLS = [bytes([c]) for c in range(9)]


def _byte_table() -> bytes:
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in SEPARATORS:
        table[c] = 10
    for c in BLANKS:
        table[c] = 32
    return bytes(table)


_TABLE = _byte_table()
_CONTROL = re.compile(rb"[\x00-\x08]")


def _tokens(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words of a text with ``b"\\n"`` between pieces, some at a time; empty strings are to be skipped."""
    data = text.translate(_TABLE)
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > CUT_BYTES:
            blank = data.find(b" ", at + CUT_BYTES)
            end = end if blank < 0 else blank
        part = data[at:end].replace(b"\n", b" \n ")
        tokens = part.split(b" ")
        if _CONTROL.search(part):
            tokens = [w if w == b"\n" else escape(w) for w in tokens]
        yield tokens
        at = end


def escape(word: bytes) -> bytes:
    for i, c in enumerate(_CONTROLS):
        word = word.replace(c, _ESCAPE + bytes([97 + i]))
    return word


class _Ids(dict):
    """Numbers of words in order of appearance; 0 is the end of a piece, -1 no word."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": -1})
        self.words: list[bytes] = [b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


_END = (0,)


class _Buffer:
    """Word numbers of one language's texts, a 0 behind each piece."""

    def __init__(self) -> None:
        self.ids = _Ids()
        self.parts: list = []

    def add(self, text: bytes) -> int:
        import numpy as np

        added = 1
        for tokens in _tokens(text):
            numbers = np.fromiter(map(self.ids.__getitem__, tokens), np.int32, len(tokens))
            self.parts.append(numbers[numbers >= 0])
            added += len(self.parts[-1])
        self.parts.append(_END)
        return added

    def numbers(self):
        import numpy as np

        return np.concatenate([np.asarray(part, np.int32) for part in self.parts])


def _buffered(batches: Iterator[pa.RecordBatch], flush) -> Iterator[pa.RecordBatch]:
    """Feed (lang, text) rows to a buffer per language, and emit ``flush(lang, buffer)`` of all whenever they are full."""
    buffers: dict[str, _Buffer] = {}
    filled = 0
    for batch in batches:
        langs, texts = batch.column(0), batch.column(1)
        for at in range(batch.num_rows):
            text = texts[at].as_py()
            if text:
                lang = langs[at].as_py()
                buffer = buffers.get(lang)
                if buffer is None:
                    buffer = buffers[lang] = _Buffer()
                filled += buffer.add(text)
                if filled >= FLUSH_WORDS:
                    for name in list(buffers):
                        yield from flush(name, buffers.pop(name))
                    filled = 0
    for name in list(buffers):
        yield from flush(name, buffers.pop(name))
    pa.default_memory_pool().release_unused()


def _mixed(a, b):
    """Well-spread 64-bit hashes of pairs of word hashes; a word alone is paired with 0."""
    import numpy as np

    h = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _hashes(lang: str, words: list[bytes]):
    """Hashes of the words, by number; that of no word is 0."""
    import numpy as np
    import xxhash

    prefix = lang.encode() + _TAB
    out = np.fromiter((xxhash.xxh64_intdigest(prefix + w, seed=42) | 1 for w in words), np.uint64, len(words))
    out[0] = 0
    return out


def _pack(entries, counts) -> bytes:
    """Sorted 32-bit entries and their counts, as compressed planes of bytes of the differences."""
    import numpy as np

    values = np.concatenate([np.diff(entries, prepend=entries[:1] * 0), counts]).astype(np.uint32)
    return zlib.compress(values.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(block: bytes):
    import numpy as np

    planes = np.frombuffer(zlib.decompress(block), np.uint8).reshape(4, -1)
    values = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
    half = len(values) // 2
    return np.cumsum(values[:half]), values[half:]


_BLOCK = "part int, lang string, n long, block binary"


def _part_key(hashes, parts: int):
    """A hash's part, above the 32 bits that stand for the hash within it."""
    import numpy as np

    return ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(parts) << np.uint64(32)) | (hashes >> np.uint64(32))


def _blocks(words, counts, keys, parts: int) -> list[tuple]:
    """One row a part: the words' keys with their counts, and the other keys (all occurrences) with theirs."""
    import numpy as np

    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
    counts = np.concatenate([counts, np.diff(np.append(first, len(keys)))])
    key = np.concatenate([words, keys[first]])
    rank = np.argsort(key, kind="stable")
    key, counts = key[rank], np.minimum(counts[rank], 0xFFFFFFFF)
    borders = np.searchsorted(key, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
    return [(p, None, None, _pack((key[a:b] & np.uint64(0xFFFFFFFF)).astype(np.int64), counts[a:b]))
            for p, (a, b) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist())) if b > a]


def _count_hashes(parts: int):
    """Task function: (lang, text) -> blocks of counted hashes of words and pairs by part, and words of each language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def flush(lang: str, buffer: _Buffer) -> Iterator[pa.RecordBatch]:
            numbers = buffer.numbers()
            hashes = _hashes(lang, buffer.ids.words)
            words = np.bincount(numbers, minlength=len(hashes))[1:]
            pairs = [_part_key(_mixed(hashes[pair[:-1]], hashes[pair[1:]])[(pair[:-1] > 0) & (pair[1:] > 0)], parts)
                     for pair in (numbers[at:at + (1 << 20) + 1] for at in range(0, len(numbers), 1 << 20))]
            rows = _blocks(_part_key(_mixed(hashes[1:], np.uint64(0)), parts), words, np.concatenate(pairs), parts)
            rows.append((zlib.crc32(lang.encode()) % parts, lang, int(words.sum()), None))
            yield _block_batch(rows)

        return _buffered(batches, flush)

    return run


def _count_triples(table: Table, parts: int, min_count: int):
    """Task function: (lang, text) -> blocks of counted hashes of the triples whose pairs ``table`` holds, by part.

    The words of such pairs come too, as often as a frequent one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def flush(lang: str, buffer: _Buffer) -> Iterator[pa.RecordBatch]:
            numbers = buffer.numbers()
            hashes = _hashes(lang, buffer.ids.words)
            numbers[~table.holds(_mixed(hashes, np.uint64(0)))[numbers]] = 0
            linked = _linked(numbers, hashes, table)
            at = np.flatnonzero(linked)
            if not len(at):
                return
            paired = np.zeros(len(hashes), bool)
            paired[numbers[at]] = paired[numbers[at + 1]] = True
            words = _part_key(_mixed(hashes[paired], np.uint64(0)), parts)
            at = at[linked[at + 1]]
            triples = [_part_key(_triples(numbers, hashes, at[i:i + (1 << 20)]), parts) for i in range(0, len(at), 1 << 20)]
            yield _block_batch(_blocks(words, np.full(len(words), min_count), np.concatenate([words[:0], *triples]), parts))

        return _buffered(batches, flush)

    return run


def _linked(numbers, hashes, table: Table):
    """Where a word and the next form a pair of the table; words not to be looked up are numbered 0."""
    import numpy as np

    linked = np.zeros(len(numbers) + ORDER, bool)
    for at in range(0, len(numbers) - 1, 1 << 20):
        pair = numbers[at:at + (1 << 20) + 1]
        both = np.flatnonzero((pair[:-1] > 0) & (pair[1:] > 0))
        linked[at + both] = table.holds(_mixed(hashes[pair[both]], hashes[pair[both + 1]]))
    return linked


def _triples(numbers, hashes, at):
    """Hashes of the three words from each place on."""
    return _mixed(_mixed(hashes[numbers[at]], hashes[numbers[at + 1]]), hashes[numbers[at + 2]])


def _block_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "lang", "n", "block"])


def _sum_hashes(cells: int, min_count: int):
    """Task function: blocks sorted by part -> each part's segment of the bit table; language totals pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        now, entries, counts, waiting = None, None, None, []

        def merge() -> None:
            nonlocal entries, counts, waiting
            both = [x for x in waiting if len(x[0])] + ([(entries, counts)] if entries is not None else [])
            key = np.concatenate([x for x, _ in both])
            n = np.concatenate([x for _, x in both])
            rank = np.argsort(key, kind="stable")
            key, n = key[rank], n[rank]
            first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
            entries, counts, waiting = key[first], np.add.reduceat(n, first), []

        def segment() -> tuple:
            merge()
            bits = np.zeros(cells, np.uint8)
            bits[entries[counts >= min_count] % cells] = 1
            return (now, None, None, np.packbits(bits, bitorder="little").tobytes())

        size = 0
        for batch in batches:
            for part, lang, n, block in zip(*[c.to_pylist() for c in batch.columns]):
                if block is None:
                    yield _block_batch([(part, lang, n, None)])
                    continue
                if part != now:
                    if now is not None:
                        yield _block_batch([segment()])
                    now, entries, counts, size = part, None, None, 0
                waiting.append(_unpack(block))
                size += len(waiting[-1][0])
                if size > max(1_000_000, 0 if entries is None else len(entries)):
                    merge()
                    size = 0
        if now is not None:
            yield _block_batch([segment()])

    return run


class Table:
    """Which words and pairs (or triples) may be frequent: one bit a cell, each part a segment of cells."""

    def __init__(self, segments: dict[int, bytes], parts: int, cells: int):
        self.parts, self.cells = parts, cells
        self.bits = b"".join(segments.get(p, bytes(cells // 8)) for p in range(parts))

    def holds(self, hashes):
        import numpy as np

        bits = np.frombuffer(self.bits, np.uint8)
        at = ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(self.parts)).astype(np.int64) * self.cells
        at += (hashes >> np.uint64(32)).astype(np.int64) % self.cells
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _batches(lang: str, texts: pa.Array, counts) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(texts)), texts, pa.array(counts, pa.int64())],
                                     names=["lang", "gram", "n"])


def _sum_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of (lang, gram, n) as one, as long as no more than ``SUM_GRAMS`` are held."""
    held, rows = [], 0

    def summed() -> list[pa.RecordBatch]:
        sums = pa.Table.from_batches(held).group_by(["lang", "gram"], use_threads=False).aggregate([("n", "sum")])
        return sums.select(["lang", "gram", "n_sum"]).rename_columns(["lang", "gram", "n"]).combine_chunks().to_batches(65536)

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= SUM_GRAMS:
            held = summed()
            rows = sum(part.num_rows for part in held)
            if 4 * rows > 3 * SUM_GRAMS:
                yield from held
                held, rows = [], 0
    if held:
        yield from summed()


def _count_grams(table: Table, triples: Table):
    """Task function: (lang, text) -> (lang, gram, n), the edges of ``ORDER`` words and the shorter ends of pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        def flush(lang: str, buffer: _Buffer) -> Iterator[pa.RecordBatch]:
            words = buffer.ids.words
            hashes = _hashes(lang, words)
            known = triples.holds(_mixed(hashes, np.uint64(0)))
            known[0] = False
            # numbers anew for the words of the table, in byte order: grams come out sorted and fit few bits
            kept = sorted(np.flatnonzero(known).tolist(), key=words.__getitem__)
            renumbered = np.zeros(len(words), np.int32)
            renumbered[kept] = np.arange(1, len(kept) + 1)
            numbers = renumbered[buffer.numbers()]
            starts = np.flatnonzero(numbers).astype(np.int32)
            if not len(starts):
                return
            hashes = np.append(np.uint64(0), hashes[kept])
            linked = _linked(numbers, hashes, table)
            joined = np.zeros(len(linked), bool)
            at = np.flatnonzero(linked[:-1] & linked[1:])
            for i in range(0, len(at), 1 << 20):
                part = at[i:i + (1 << 20)]
                joined[part] = triples.holds(_triples(numbers, hashes, part))
            del at
            follows = [linked, *[joined] * (ORDER - 2)]    # whether a gram goes on, by words so far; a triple also ends its pair
            padded = np.concatenate([numbers, np.zeros(ORDER, np.int32)])
            del numbers
            width = len(kept).bit_length()
            per_key = 63 // width
            keys, alive = [], np.ones(len(starts), bool)
            for i in range(ORDER):
                if i:
                    alive &= follows[i - 1][starts + max(0, i - 2)]
                column = np.where(alive, padded[starts + i], 0).astype(np.int64)
                if i % per_key == 0:
                    keys.append(column)
                else:
                    keys[-1] = (keys[-1] << width) | column
            rank = np.lexsort(keys[::-1])
            new = np.zeros(len(rank), bool)
            new[0] = True
            for key in keys:
                ordered = key[rank]
                new[1:] |= ordered[1:] != ordered[:-1]
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(rank)))
            sources = starts[rank[first]]
            del keys, key, ordered, rank, new, first, starts
            dictionary = pa.array([words[k] for k in kept], pa.binary())
            for part in range(0, len(sources), 65536):
                here = sources[part:part + 65536]
                columns, alive = [], np.ones(len(here), bool)
                for i in range(ORDER):
                    if i:
                        alive = alive & follows[i - 1][here + max(0, i - 2)]
                    columns.append(dictionary.take(pa.array(padded[here + i] - 1, mask=~alive)))
                yield from _batches(lang, pc.binary_join_element_wise(*columns, _TAB, null_handling="skip"), counts[part:part + 65536])

        return _sum_grams(_buffered(batches, flush))

    return run


def _sum_flows(min_count: int):
    """Task function: sorted (lang, gram, n) -> (lang, gram, words, f, part) of the phrases that begin grams.

    ``part`` marks the phrases that begin the partition's first or last gram: other partitions may hold more of them.
    All others are whole and come out only if frequent. Only the open phrases, those of the last row, are held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, phrase, count = None, [], []     # the open phrases: by words, their own texts and counts
        edge = []                              # which open phrases began with the partition's first gram
        out: list[tuple] = []
        first = True

        def close(depth: int) -> None:
            """The open phrases of more than ``depth`` words are whole, unless the partition began with them."""
            while len(phrase) > depth:
                text, n, part = _TAB.join(phrase), count.pop(), edge.pop()
                if part or n >= min_count:
                    out.append((lang, text, len(phrase), n, part))
                phrase.pop()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            grams = batch.column(1).to_pylist()
            counts = batch.column(2).to_pylist()
            for new_lang, gram, n in zip(langs, grams, counts):
                words = gram.split(_TAB)
                depth = 0
                if new_lang == lang:
                    for a, b in zip(phrase, words):
                        if a != b:
                            break
                        depth += 1
                if depth < len(phrase):
                    close(depth)
                lang = new_lang
                for i in range(depth):
                    count[i] += n
                for word in words[depth:]:
                    phrase.append(word)
                    count.append(n)
                    edge.append(first)
                first = False
            if len(out) >= 10_000:
                yield _flows(out)
                out.clear()
        edge[:] = [True] * len(edge)
        close(0)
        if out:
            yield _flows(out)

    return run


def _flows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.binary(), pa.int32(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                      names=["lang", "gram", "words", "f", "part"])


def _rows(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(docs[lang_col], F.lit(NO_LANG)).alias("lang"), docs[text_col].cast("binary").alias("text"))


def frequent_words_and_pairs(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                             min_count: int = MIN_COUNT) -> tuple[Table, DataFrame]:
    """The table of words and pairs that may reach ``min_count``, and (lang, n), all words of each language.

    Hashes are dealt to as many parts as the session has shuffle partitions; a task merges one part's blocks, so more
    data asks for more partitions, as in any shuffle. The driver gets the table's segments, ``TABLE_BITS`` in all.
    """
    parts = _parts(docs)
    table, totals = _table(_rows(docs, text_col, lang_col).mapInArrow(_count_hashes(parts), _BLOCK), parts, min_count)
    return table, totals.groupBy("lang").agg(F.sum("n").alias("n"))


def frequent_triples(docs: DataFrame, table: Table, text_col: str = "text", lang_col: str = "lang",
                     min_count: int = MIN_COUNT) -> Table:
    """The table of triples that may reach ``min_count``, and of the words of pairs that may; ``table`` holds the pairs."""
    parts = _parts(docs)
    return _table(_rows(docs, text_col, lang_col).mapInArrow(_count_triples(table, parts, min_count), _BLOCK), parts, min_count)[0]


def _parts(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _table(blocks: DataFrame, parts: int, min_count: int) -> tuple[Table, DataFrame]:
    """The table of summed blocks, and the rows without a block."""
    cells = max(8, TABLE_BITS // parts // 8 * 8)
    summed = materialise(blocks.repartition("part").sortWithinPartitions("part").mapInArrow(_sum_hashes(cells, min_count), _BLOCK),
                         "collocation-table")
    segments = {r["part"]: bytes(r["block"]) for r in summed.where("block is not null").select("part", "block").toLocalIterator()}
    return Table(segments, parts, cells), summed.where("block is null")


def phrase_flows(docs: DataFrame, table: Table, text_col: str = "text", lang_col: str = "lang",
                 min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, gram, words, f) of every phrase of 2 to ``ORDER`` words with ``min_count`` occurrences or more, and of their words.

    A task makes a row of each frequent phrase that it meets, so few tasks that read more make fewer rows than many; they
    hold ``FLUSH_WORDS`` and ``SUM_GRAMS`` at a time, however much they read.
    """
    triples = frequent_triples(docs, table, text_col, lang_col, min_count)
    tasks = GRAM_TASKS * docs.sparkSession.sparkContext.defaultParallelism
    grams = materialise(_rows(docs, text_col, lang_col).coalesce(tasks).mapInArrow(
        _count_grams(table, triples), "lang string, gram binary, n long"), "collocation-grams")
    ordered = grams.repartitionByRange("lang", "gram").sortWithinPartitions("lang", "gram")
    flows = materialise(ordered.mapInArrow(_sum_flows(min_count),
                                           "lang string, gram binary, words int, f long, part boolean"), "collocation-flows")
    whole = flows.where("not part").drop("part")
    parts = flows.where("part").groupBy("lang", "gram", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
    return whole.unionByName(parts)


def _cut(first: int | Column, length: int | Column) -> Column:
    """A run of the words ``w`` as a gram."""
    return F.encode(F.array_join(F.slice("w", first, length), "\t"), "UTF-8")


def with_words(flows: DataFrame) -> DataFrame:
    """``flows`` with ``w``, the words as an array."""
    return flows.withColumn("w", F.split(F.decode("gram", "UTF-8"), "\t", -1))


def _salt(gram: str) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SALTS)).cast("int")


def _all_salts() -> Column:
    return F.sequence(F.lit(0), F.lit(SALTS - 1))


def extended(flows: DataFrame) -> DataFrame:
    """(lang, gram, most): the largest count of a phrase with one word more, for phrases that have such.

    Any longer phrase around a phrase occurs at most as often as the one-word extension inside it, so these decide.
    """
    longer = with_words(flows.where("words > 1")).select(
        "lang", "f", F.explode(F.array(_cut(1, F.col("words") - 1), _cut(2, F.col("words") - 1))).alias("gram"))
    return longer.groupBy("lang", "gram").agg(F.max("f").alias("most"))


def candidates(flows: DataFrame, percent: int = ABSORB_PERCENT) -> DataFrame:
    """(lang, gram, f, k, l, r): each cut, behind the first ``k`` words, of each phrase that no longer one stands for."""
    phrases = flows.where("words > 1")
    kept = (phrases.join(extended(flows), ["lang", "gram"], "left")
            .where(F.col("most").isNull() | (F.col("most") * 100 < F.col("f") * percent)).drop("most"))
    cuts = with_words(kept).select(
        "lang", "gram", "f", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), "words", "w").select(
        "lang", "gram", "f", "k", _cut(1, F.col("k")).alias("left"), _cut(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    # A frequent word is looked up by very many phrases: its count stands in every salt.
    salted = cuts.withColumn("salt", _salt("gram"))
    counts = flows.where(f"words < {ORDER}").select("lang", "gram", "f", F.explode(_all_salts()).alias("salt"))
    for side, name in (("left", "l"), ("right", "r")):
        salted = salted.join(counts.select("lang", F.col("gram").alias(side), "salt", F.col("f").alias(name)), ["lang", side, "salt"])
    return salted.select("lang", "gram", "f", "k", "l", "r")


def _unescape(text: Column) -> Column:
    for i, c in enumerate(_CONTROLS):
        text = F.replace(text, F.lit("\n" + chr(97 + i)), F.lit(c.decode()))
    return text


def paths(flows: DataFrame) -> DataFrame:
    """(lang, gram, path, path_words): each frequent edge with the unary path that it lies on.

    Two edges follow each other on a path when the node between them passes its whole flow from the one to the other.
    Such links form chains: a path lies within a piece, so it cannot close to a ring. The edges of a chain find its head
    by pointer doubling, in as many rounds as the logarithm of the longest path; a path is as long as its piece at most.
    """
    edges = with_words(flows.where(F.col("words") == ORDER))
    nodes = flows.where(F.col("words") == ORDER - 1).select("lang", F.col("gram").alias("node"), "f")
    into = edges.select("lang", _cut(2, ORDER - 1).alias("node"), "f", F.col("gram").alias("head"))
    out = edges.select("lang", _cut(1, ORDER - 1).alias("node"), "f", "gram")
    links = (into.join(nodes, ["lang", "node", "f"]).select("lang", "node", "f", "head")
             .join(out, ["lang", "node", "f"]).select("lang", "gram", "head"))
    jumps = materialise(edges.select("lang", "gram").join(links, ["lang", "gram"], "left").select(
        "lang", "gram", F.coalesce("head", "gram").alias("head"), F.col("head").isNotNull().cast("long").alias("steps")),
        "collocation-links")
    more = not jumps.where("steps > 0").isEmpty()
    while more:
        further = jumps.where("steps > 0").select("lang", F.col("gram").alias("head"), F.col("head").alias("further"), F.col("steps").alias("added"))
        jumps = materialise(jumps.join(further, ["lang", "head"], "left").select(
            "lang", "gram", F.coalesce("further", "head").alias("head"), (F.col("steps") + F.coalesce("added", F.lit(0))).alias("steps"),
            F.col("further").isNotNull().alias("moved")), "collocation-links")
        more = not jumps.where("moved").isEmpty()
        jumps = jumps.drop("moved")
    words = with_words(jumps)
    chains = words.groupBy("lang", "head").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("steps", F.element_at("w", -1).alias("last")))), lambda x: x["last"]).alias("ends"))
    path = F.concat(F.slice(F.split(F.decode("head", "UTF-8"), "\t", -1), 1, ORDER - 1), "ends")
    return jumps.join(chains, ["lang", "head"]).select(
        "lang", "gram", _unescape(F.array_join(path, " ")).alias("path"), F.size(path).cast("long").alias("path_words"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 percent: int = ABSORB_PERCENT, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score, path, path_words.

    ``path`` is the passage around the phrase that occurs as often as the phrase, as far as edges tell (the phrase
    itself, unless it is an edge). Everything is counted over whole texts and all rows, per language (null: ``und``).
    Null and empty texts have no words; repeated rows count again. Ties of the lowest cut go to the smallest first part,
    ties of the ranking by count and then by phrase in byte order. An empty table, and one without frequent phrases, give
    no rows. Further columns are not read, so their names cannot clash. Texts of any length are read whole: a task holds
    the word numbers of one text and of ``FLUSH_WORDS`` words more.
    """
    table, totals = frequent_words_and_pairs(docs, text_col, lang_col, min_count)
    flows = materialise(phrase_flows(docs, table, text_col, lang_col, min_count), "collocation-phrases")
    totals = totals.select("lang", "n", F.explode(_all_salts()).alias("salt"))
    cuts = candidates(flows, percent).withColumn("salt", _salt("gram"))
    scored = cuts.join(totals, ["lang", "salt"]).withColumn("score", F.expr(
        "cast(1000 as decimal(4,0)) * cast(f as decimal(17,0)) * cast(n as decimal(17,0)) "
        "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    lowest = scored.groupBy("lang", "gram").agg(F.min(F.struct("score", "k", "l", "r", "f", "n")).alias("cut"))
    rows = lowest.select("lang", "gram", _unescape(F.replace(F.decode("gram", "UTF-8"), F.lit("\t"), F.lit(" "))).alias("phrase"),
                         F.col("cut.f").alias("a"), "cut.l", "cut.r", "cut.n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    few = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", _salt("gram")).orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(paths(flows), ["lang", "gram"], "left").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", F.coalesce("path", "phrase").alias("path"),
        F.coalesce("path_words", F.size(F.split("phrase", " ")).cast("long")).alias("path_words"))


def collocations_sql(table: str = "documents", min_count: int = MIN_COUNT, percent: int = ABSORB_PERCENT, top: int = TOP) -> str:
    """DuckDB SQL for :func:`collocations`: all phrases of all lengths are counted, and longer ones compared as text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE
pieces AS (SELECT coalesce(lang, '{NO_LANG}') AS lang,
                  unnest(regexp_split_to_array(translate(text, '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM {table}),
cut AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang),
lengths AS (SELECT lang, w, unnest(range(1, {ORDER + 1})) AS k FROM cut),
starts AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lengths),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM starts GROUP BY ALL HAVING count(*) >= {min_count}),
parts AS (SELECT *, string_split(phrase, ' ') AS w FROM f),
kept AS (SELECT * FROM parts p WHERE k > 1 AND NOT EXISTS (
  SELECT 1 FROM f q WHERE q.lang = p.lang AND q.k > p.k AND 100 * q.a >= {percent} * p.a
  AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))),
cuts AS (SELECT *, unnest(range(1, k)) AS c FROM kept),
scored AS (
  SELECT t.lang, t.phrase, t.a, x.a AS l, y.a AS r, n, c,
         CAST(CAST(1000 AS HUGEINT) * t.a * n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts t JOIN totals USING (lang) JOIN f x ON x.lang = t.lang AND x.phrase = array_to_string(t.w[1:c], ' ')
  JOIN f y ON y.lang = t.lang AND y.phrase = array_to_string(t.w[c + 1:t.k], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest),
links AS (SELECT x.lang, x.phrase AS before, y.phrase AS after, y.w[{ORDER}] AS last FROM parts x
          JOIN f v ON v.lang = x.lang AND v.a = x.a AND v.phrase = array_to_string(x.w[2:{ORDER}], ' ')
          JOIN parts y ON y.lang = x.lang AND y.a = x.a AND v.phrase = array_to_string(y.w[1:{ORDER - 1}], ' ')
          WHERE x.k = {ORDER} AND y.k = {ORDER} AND v.k = {ORDER - 1}),
walk AS (
  SELECT lang, phrase AS head, phrase, phrase AS path, {ORDER} AS path_words FROM f
  WHERE k = {ORDER} AND NOT EXISTS (SELECT 1 FROM links z WHERE z.lang = f.lang AND z.after = f.phrase)
  UNION ALL
  SELECT s.lang, s.head, z.after, s.path || ' ' || z.last, s.path_words + 1 FROM walk s JOIN links z ON z.lang = s.lang AND z.before = s.phrase),
whole AS (SELECT lang, head, arg_max(path, path_words) AS path, max(path_words) AS path_words FROM walk GROUP BY ALL)
SELECT t.lang, t.rank, t.phrase, t.a, t.l, t.r, t.n, t.score, coalesce(p.path, t.phrase) AS path,
       CAST(coalesce(p.path_words, len(string_split(t.phrase, ' '))) AS BIGINT) AS path_words
FROM ranked t LEFT JOIN walk s ON s.lang = t.lang AND s.phrase = t.phrase LEFT JOIN whole p ON p.lang = s.lang AND p.head = s.head
WHERE t.rank <= {top}"""
