"""Log-bilinear language model trained by noise-contrastive estimation, and scoring of whole texts.

Tokens are the words of a text in A-Z lower case and one end per text. The
training texts give every token's count, over all of them. The end and the
CLASS_WORDS + OWN_WORDS most frequent words of MIN_COUNT or more have vectors of
their own, as contexts and as predicted words; only the tail below them is
counted in buckets by its first bytes. The model predicts from the CONTEXT
tokens before:

    r(context) = sum_i C_i * R[context_i],   s(w) = r(context) . Q[w] + b[w]

in two levels: a symbol (the end, one of the OWN_WORDS most frequent words, a
bucket or a class of words), normalised over all symbols once per context, and
for a class the word, normalised over the words of the class. Both are batched
matrix products. A word in a bucket has its smoothed share of the bucket, with
one share for words never seen, so the probabilities of all tokens sum to one.

Training texts are dealt to logical shards by the hash of id and text, as many
as give each about SHARD_TOKENS tokens, so what is learned follows from the rows
and not from files or tasks. A shard's texts go, as token numbers and in order
of their hash, to one task, which runs stochastic gradient steps of
noise-contrastive estimation from the round's parameters. After each round the
shards' parameters are averaged, each token's weighted by its occurrences, and
so are the step sizes, which later rounds go on from. Each training text is used
in one round, so all of them are used once.

What a task holds is bounded: the symbols and the known counts of the
most frequent words, HEAVY_WORDS at most, are broadcast. The counts of all other words
stay distributed and meet the texts' rare words in a join.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrow import with_columns
from ledgerflow.llm.storage import materialise

#: Most frequent words with a symbol of their own, buckets of the tail, and words whose counts are broadcast, at most.
OWN_WORDS, BUCKETS, HEAVY_WORDS = 63, 64, 100_000
#: Classes of the next words, the words in them at most, and the least count of a word with vectors there.
CLASSES, CLASS_WORDS, MIN_COUNT = 224, 49_536, 5
CONTEXT, DIMENSIONS = 2, 16
#: Rounds of training, and tokens of a shard.
ROUNDS, SHARD_TOKENS = 4, 4_000_000
BATCH, NOISE, RATE = 4096, 64, 0.12
#: Noise words that up to GROUP words of one class share in a batch, and the places of the table they are drawn from.
CLASS_NOISE, GROUP, PLACES = 4, 16, 2048
#: Tokens whose parameters travel in one row when the shards' results are averaged.
BLOCK = 512
#: Distinct words that a counting task holds before it hands on partial counts.
HELD_WORDS = 500_000
FOLDS, HELD_OUT = 5, 1
END = b""  # no word is empty
FIRST_CLASS = OWN_WORDS + 1 + BUCKETS
#: Symbols of the first level; words of a class are numbered from here on.
SYMBOLS = FIRST_CLASS + CLASSES


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in A-Z lower case; null and empty texts have none."""
    return text.encode().lower().split() if text else []


def bucket_of(word: bytes) -> int:
    """The symbol of the bucket of a word without a symbol of its own."""
    return OWN_WORDS + 1 + zlib.crc32(word[:3]) % BUCKETS


def held_out(id_col: str):
    """Whether a document is held out; a null id trains."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def split_tokens(texts: pa.Array | list[str | None]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of each word, the distinct words by number, words of each text) of whole texts, as :func:`words_of` has them.

    Arrow's kernels fold A-Z and cut at ASCII blanks, so Python sees distinct words alone.
    """
    import pyarrow.compute as pc

    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "").cast(pa.binary()).cast(pa.string())))
    flat = lists.flatten()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    held = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # blanks at a text's ends leave empty strings
    if not held.all():
        text = np.repeat(np.arange(len(sizes)), sizes)
        sizes = np.bincount(text[held], minlength=len(sizes))
        flat = flat.filter(pa.array(held))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.cast(pa.binary()), sizes


class _Numbers(dict):
    """Numbers of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def count_tokens(training: DataFrame, text_col: str) -> DataFrame:
    """(token as binary, n) over all training texts, ends included; partial counts per task, summed in one shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(numbers, counts):
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.binary()), pa.array(counts[:len(numbers)], pa.int64())],
                                              names=["token", "n"])

        numbers, counts = _Numbers(), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                texts = batch.column(0).slice(at, 1000)
                index, words, _ = split_tokens(texts)
                place = np.fromiter(map(numbers.__getitem__, [*words.to_pylist(), END]), np.int64, len(words) + 1)
                if len(numbers) > len(counts):
                    counts = np.concatenate([counts, np.zeros(2 * len(numbers) - len(counts), np.int64)])
                counts[place] += np.append(np.bincount(index, minlength=len(words)), len(texts))
                if len(numbers) >= HELD_WORDS:
                    yield out(numbers, counts)
                    numbers, counts = _Numbers(), np.zeros(0, np.int64)
        if numbers:
            yield out(numbers, counts)

    return training.select(text_col).mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Everything about counts that a task needs; bounded by HEAVY_WORDS, whatever the corpus."""

    symbol: dict[bytes, int]  # tokens with vectors: the end is 0, from SYMBOLS on words of a class in order of bytes
    heavy: dict[bytes, int]  # exact counts of the most frequent tokens, own symbols included
    tokens: int  # N
    distinct: int  # V
    symbol_count: np.ndarray  # training tokens of each symbol
    bucket_types: np.ndarray  # distinct training words of each bucket symbol, 0 for own symbols
    word_count: np.ndarray = field(default_factory=lambda: np.zeros(0))  # training tokens of each word of a class

    @property
    def width(self) -> int:
        """Words in a class; only the last one may have fewer."""
        return max(1, -(-len(self.word_count) // CLASSES))

    def class_parts(self) -> list[slice]:
        """The words of each class that has any, in order."""
        return [slice(at, min(at + self.width, len(self.word_count))) for at in range(0, len(self.word_count), self.width)]

    def first_level(self, targets: np.ndarray) -> np.ndarray:
        """The symbol of each token: the class for a word of a class."""
        return np.where(targets < SYMBOLS, targets, FIRST_CLASS + (targets - SYMBOLS) // self.width)

    @property
    def base_total(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    def bucket_total(self) -> np.ndarray:
        return self.symbol_count + 0.5 * (self.bucket_types + 1)

    def log_start(self) -> np.ndarray:
        """Smoothed log probability of each symbol, the noise distribution and the first bias; none for classes without words."""
        counts = self.symbol_count + 0.5
        counts[FIRST_CLASS:][self.symbol_count[FIRST_CLASS:] == 0] = 1e-30
        return np.log(counts / counts.sum())

    def noise_table(self) -> tuple[np.ndarray, np.ndarray]:
        """((classes, PLACES) words to draw noise from, log share of each word's places in its class).

        Half of a class's places go by counts and half evenly, so every word has places.
        """
        parts = self.class_parts()
        table, log_share = np.zeros((len(parts), PLACES), np.int32), np.zeros(len(self.word_count), np.float32)
        for row, part in zip(table, parts):
            share = self.word_count[part] / self.word_count[part].sum() + 1 / (part.stop - part.start)
            edges = np.cumsum(share)
            row[:] = np.searchsorted(edges[:-1], (np.arange(PLACES) + 0.5) / PLACES * edges[-1])
            places = np.bincount(row, minlength=part.stop - part.start)
            log_share[part] = np.log(np.maximum(places, 1) / PLACES)
            row += part.start
        return table, log_share


def most_frequent(counts: DataFrame, limit: int) -> list:
    """The ``limit`` most frequent rows of (token, n), by n and then by token; exact, however many counts are equal.

    A histogram of the counts in steps of an eighth of a power of two, a few hundred rows, tells below which count
    nothing is wanted; the rest goes through a top-k of at most ``limit`` rows a partition.
    """
    step = F.floor(F.log2("n") * 8).alias("step")
    bars = sorted(counts.groupBy(step).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect(), reverse=True)
    least, words = 0, 0
    for bar in bars:
        least, words = bar["least"], words + bar["words"]
        if words >= limit:
            break
    return counts.where(F.col("n") >= least).orderBy(F.desc("n"), "token").limit(limit).collect()


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals and the most frequent tokens of the written counts; rows that reach the driver are bounded."""
    ends = F.sum(F.when(F.length("token") == 0, F.col("n")))
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct"),
                        F.coalesce(ends, F.lit(0)).alias("ends")).first()
    heavy = {bytes(r["token"]): r["n"] for r in most_frequent(counts, HEAVY_WORDS)}
    if totals["ends"]:
        heavy[END] = totals["ends"]
    ranked = sorted((t for t in heavy if t != END), key=lambda t: (-heavy[t], t))
    own = ranked[:OWN_WORDS]
    classed = sorted(t for t in ranked[OWN_WORDS:OWN_WORDS + CLASS_WORDS] if heavy[t] >= MIN_COUNT)
    symbol = {END: 0} | {t: i + 1 for i, t in enumerate(own)} | {t: SYMBOLS + i for i, t in enumerate(classed)}
    symbol_count, types = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    spread = (F.pmod(F.crc32(F.substring("token", 1, 3)), F.lit(BUCKETS)) + OWN_WORDS + 1).alias("bucket")
    for r in counts.where(F.length("token") > 0).groupBy(spread).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
        symbol_count[r["bucket"]], types[r["bucket"]] = r["n"], r["types"]
    for t in own + classed:  # words with vectors are in no bucket
        symbol_count[bucket_of(t)] -= heavy[t]
        types[bucket_of(t)] -= 1
    for t in [END, *own]:
        symbol_count[symbol[t]] = heavy.get(t, 0)
    words = Vocabulary(symbol, heavy, totals["tokens"], totals["distinct"], symbol_count, types,
                       np.array([heavy[t] for t in classed], np.float64))
    for i, part in enumerate(words.class_parts()):
        symbol_count[FIRST_CLASS + i] = words.word_count[part].sum()
    return words


@dataclass
class Model:
    """Parameters; float32. Rows are the symbols and, after them, the words of the classes."""

    r: np.ndarray  # (rows, DIMENSIONS) vectors of context tokens
    q: np.ndarray  # (rows, DIMENSIONS) vectors of predicted symbols and of words in their class
    b: np.ndarray  # (rows,) biases
    c: np.ndarray  # (CONTEXT, DIMENSIONS) weights of the context places

    @classmethod
    def start(cls, words: Vocabulary, seed: int = 0) -> Model:
        rng = np.random.default_rng(seed)
        shape = (SYMBOLS + len(words.word_count), DIMENSIONS)
        bias = [words.log_start()]
        bias += [np.log(words.word_count[part] / words.word_count[part].sum()) for part in words.class_parts()]
        return cls(rng.normal(0, 0.1, shape).astype(np.float32), rng.normal(0, 0.1, shape).astype(np.float32),
                   np.concatenate(bias).astype(np.float32), np.ones((CONTEXT, DIMENSIONS), np.float32))

    def rows(self, steps: Steps) -> np.ndarray:
        """(rows, 2 * DIMENSIONS + 4): all parameters and step sizes of a token side by side."""
        return np.concatenate([self.r, self.q, self.b[:, None], steps.r, steps.q, steps.b], axis=1)

    @classmethod
    def from_rows(cls, rows: np.ndarray, places: np.ndarray) -> tuple[Model, Steps]:
        r, q, b, sr, sq, sb = (x.copy() for x in np.split(
            rows.astype(np.float32), np.cumsum([DIMENSIONS, DIMENSIONS, 1, 1, 1]), axis=1))
        c, sc = np.split(places.astype(np.float32), [DIMENSIONS], axis=1)
        return cls(r, q, b[:, 0].copy(), c.copy()), Steps(sr, sq, sb, sc.copy())

    def copy(self) -> Model:
        return Model(self.r.copy(), self.q.copy(), self.b.copy(), self.c.copy())

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        """(n, DIMENSIONS) from (n, CONTEXT) tokens."""
        return (self.r[contexts] * self.c).sum(axis=1)

    def log_sums(self, v: np.ndarray, part: slice) -> np.ndarray:
        """Log of the sum over the rows ``part`` of the exponentiated scores, for each predicted vector."""
        # No product is larger than that of the largest norms, so with the largest bias it bounds the largest score from
        # both sides; float32 holds exp(60) and its sums.
        reach = np.sqrt(np.einsum("ij,ij->i", v, v).max(initial=0) * np.einsum("ij,ij->i", self.q[part], self.q[part]).max())
        small = reach + abs(self.b[part].max()) < 60
        q = np.concatenate([self.q[part].T, self.b[None, part]])  # a bias is one more dimension
        v = np.concatenate([v, np.ones((len(v), 1), np.float32)], axis=1)
        out, step = np.empty(len(v), np.float32), min(128, max(1, len(v)))
        scores, ones = np.empty((step, q.shape[1]), np.float32), np.ones(q.shape[1], np.float32)
        for at in range(0, len(v), step):
            some = v[at:at + step]
            s = np.matmul(some, q, out=scores[:len(some)])
            top = 0 if small else s.max(axis=1)
            if not small:
                s -= top[:, None]
            np.exp(s, out=s)
            out[at:at + step] = top + np.log(s @ ones)
        return out

    def log_normalisers(self, contexts: np.ndarray) -> np.ndarray:
        """Log of the sum over all symbols of each context's exponentiated scores."""
        return self.log_sums(self.predicted(contexts), slice(0, SYMBOLS))

    def log_in_class(self, words: Vocabulary, v: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Log probability of each token in its class: 0 for tokens that are symbols."""
        out = np.zeros(len(targets), np.float64)
        classes = words.first_level(targets)
        classes[targets < SYMBOLS] = -1
        classes = classes.astype(np.int16)  # sorted by radix
        order = np.argsort(classes, kind="stable")
        edges = np.searchsorted(classes[order], np.arange(FIRST_CLASS, SYMBOLS + 1).astype(np.int16))
        for i, part in enumerate(words.class_parts()):
            at = order[edges[i]:edges[i + 1]]
            if len(at):
                mine, t = v[at], targets[at]
                log_z = self.log_sums(mine, slice(SYMBOLS + part.start, SYMBOLS + part.stop))
                out[at] = (mine * self.q[t]).sum(axis=1) + self.b[t] - log_z
        return out


@dataclass
class Steps:
    """Sums of squared gradients, one a token and kind of parameter: they set the step sizes."""

    r: np.ndarray
    q: np.ndarray
    b: np.ndarray
    c: np.ndarray

    @classmethod
    def start(cls, rows: int) -> Steps:
        return cls(*(np.full((n, 1), 1e-6, np.float32) for n in (rows, rows, rows, CONTEXT)))

    def copy(self) -> Steps:
        return Steps(self.r.copy(), self.q.copy(), self.b.copy(), self.c.copy())


def _sums(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct indices, sums of the rows of ``values`` by ``index``)."""
    order = np.argsort(index.astype(np.uint16) if index.max() < 1 << 16 else index, kind="stable")  # 16 bits: by radix
    index = index[order]
    starts = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
    return index[starts], np.add.reduceat(values[order], starts, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


@dataclass
class Noise:
    """What noise is drawn from: symbols by their smoothed share, words of a class by its table."""

    cumulated: np.ndarray  # chances of the symbols, summed up
    log_share: np.ndarray  # log chance of each row: of a symbol among all, of a word in its class
    table: np.ndarray  # (classes, PLACES) rows

    @classmethod
    def of(cls, words: Vocabulary) -> Noise:
        log_noise = words.log_start()
        chance = np.exp(log_noise)
        table, log_share = words.noise_table()
        return cls(np.cumsum(chance / chance.sum()), np.concatenate([log_noise, log_share]).astype(np.float32), table + SYMBOLS)

    def symbols(self, rng: np.random.Generator) -> np.ndarray:
        return np.minimum(np.searchsorted(self.cumulated, rng.random(NOISE)), SYMBOLS - 1)


def train_batch(m: Model, steps: Steps, contexts: np.ndarray, tokens: np.ndarray, targets: np.ndarray, noise: Noise,
                rng: np.random.Generator) -> None:
    """One noise-contrastive step: noise symbols are shared by the batch, noise words by a class's words in it, by GROUP.

    ``tokens`` are rows and ``targets`` their symbols. Only rows that the batch touches change.
    """
    n, others = len(targets), noise.symbols(rng)
    offset = m.b - noise.log_share  # a score less its noise
    places = [m.r[contexts[:, i]] for i in range(CONTEXT)]
    v = sum(p * m.c[i] for i, p in enumerate(places))
    qt, qn = m.q[targets], m.q[others]
    shift = np.float32(np.log(len(others)))
    miss = 1 - _sigmoid(np.einsum("ij,ij->i", v, qt) + offset[targets] - shift)  # pull the true symbol up
    false = _sigmoid(v @ qn.T + (offset[others] - shift))  # push the noise symbols down
    dv = miss[:, None] * qt - false @ qn
    rows, pulls = [targets, others], [miss[:, None] * v, -(false.T @ v)]
    biases = [miss, -false.sum(axis=0)]
    at = np.flatnonzero(tokens >= SYMBOLS)
    if len(at):
        classes = (targets[at] - FIRST_CLASS).astype(np.uint16)
        order = np.argsort(classes, kind="stable")
        at, classes = at[order], classes[order]
        first = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
        within = np.arange(len(classes)) - np.repeat(first, np.diff(np.append(first, len(classes))))
        first = np.flatnonzero(within % GROUP == 0)  # a class's words in groups of few, with noise of their own
        size = np.diff(np.append(first, len(classes)))
        group, place = np.repeat(np.arange(len(first)), size), np.arange(len(at)) - np.repeat(first, size)
        word, u = tokens[at], v[at]
        drawn = noise.table[classes[first][:, None], rng.integers(0, PLACES, (len(first), CLASS_NOISE))]
        qw, qd = m.q[word], m.q[drawn]
        shift = np.float32(np.log(CLASS_NOISE))
        padded = np.zeros((len(first), GROUP, DIMENSIONS), np.float32)  # one matrix a group, its words' contexts
        padded[group, place] = u
        false = _sigmoid(padded @ qd.transpose(0, 2, 1) + (offset[drawn] - shift)[:, None, :])
        false *= (np.arange(GROUP) < size[:, None])[:, :, None]
        miss = 1 - _sigmoid(np.einsum("ij,ij->i", u, qw) + offset[word] - shift)
        dv[at] += miss[:, None] * qw - (false @ qd)[group, place]
        rows += [word, drawn.ravel()]
        pulls += [miss[:, None] * u, -(false.transpose(0, 2, 1) @ padded).reshape(-1, DIMENSIONS)]
        biases += [miss, -false.sum(axis=1).ravel()]
    row, grad = _sums(np.concatenate(rows), np.concatenate(
        [np.concatenate(pulls), np.concatenate(biases)[:, None]], axis=1))
    by_context, dr = _sums(contexts.T.ravel(), np.concatenate([dv * m.c[i] for i in range(CONTEXT)]))
    dc = np.stack([np.einsum("ij,ij->j", dv, places[i]) for i in range(CONTEXT)])
    for x, square, at, g in ((m.r, steps.r, by_context, dr), (m.q, steps.q, row, grad[:, :-1]),
                             (m.b[:, None], steps.b, row, grad[:, -1:]), (m.c, steps.c, slice(None), dc)):
        g = (g / np.float32(n)).astype(np.float32)
        total = square[at] + np.einsum("ij,ij->i", g, g)[:, None] / g.shape[1]
        square[at] = total
        x[at] += np.float32(RATE) * g / (np.sqrt(total) + np.float32(1e-6))


class Coder(dict):
    """The number of each heavy token, -1 for others; by number its row (``code``) and its count (``count``)."""

    def __init__(self, words: Vocabulary):
        super().__init__((t, i) for i, t in enumerate(words.heavy))
        self.code = np.array([words.symbol.get(t, -1) for t in words.heavy], np.int64)
        bucketed = np.flatnonzero(self.code < 0)
        tokens = list(words.heavy)
        self.code[bucketed] = [bucket_of(tokens[i]) for i in bucketed.tolist()]
        self.count = np.array(list(words.heavy.values()), np.float64)
        if END not in self:  # no training texts
            self[END] = len(tokens)
            self.code, self.count = np.append(self.code, 0), np.append(self.count, 0.0)

    def __missing__(self, token: bytes) -> int:
        return -1

    def encode(self, texts: pa.Array | list[str | None]) -> Encoded:
        index, words, sizes = split_tokens(texts)
        distinct = words.to_pylist()
        numbers = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))
        codes = self.code[numbers] if len(distinct) else numbers
        unknown = np.flatnonzero(numbers < 0)
        codes[unknown] = [bucket_of(distinct[i]) for i in unknown.tolist()]
        sizes = sizes + 1
        ends = np.cumsum(sizes) - 1
        inside = np.ones(int(sizes.sum()), bool)
        inside[ends] = False
        number, rows = np.full(len(inside), self[END], np.int64), np.zeros(len(inside), np.int64)
        number[inside], rows[inside] = numbers[index], codes[index]
        rare = np.flatnonzero(number < 0)
        return Encoded(sizes, number, rows, rare, index[np.flatnonzero(numbers[index] < 0)], words)


@dataclass
class Encoded:
    """Tokens of some texts, each text's end behind it."""

    sizes: np.ndarray  # tokens of each text
    number: np.ndarray  # the coder's number of each token
    rows: np.ndarray  # the row of each token in the model
    rare: np.ndarray  # places of the tokens that the coder doesn't know
    rare_words: np.ndarray  # and their numbers among the words
    words: pa.Array  # distinct words


def contexts_of(rows: np.ndarray) -> np.ndarray:
    """(n, CONTEXT) rows before each token. Contexts before a text's start are ends."""
    padded = np.concatenate([np.zeros(CONTEXT, rows.dtype), rows])
    contexts = np.stack([padded[CONTEXT - 1 - i:len(padded) - 1 - i] for i in range(CONTEXT)], axis=1)
    # beyond the nearest end the context is all ends
    for i in range(1, CONTEXT):
        contexts[contexts[:, i - 1] == 0, i] = 0
    return contexts


def _averaged(rows: DataFrame) -> DataFrame:
    """(block, weights, sums) of all tasks' rows of a block, as float64 bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for block, weights, values in zip(*(batch.column(i).to_pylist() for i in range(3))):
                w = np.frombuffer(weights)
                x = np.frombuffer(values, np.float32).reshape(len(w), -1) * w[:, None]
                if block in sums:
                    sums[block][0] += w
                    sums[block][1] += x
                else:
                    sums[block] = [w.copy(), x]
        for block, (w, x) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([w.tobytes()], pa.binary()),
                                              pa.array([x.tobytes()], pa.binary())], names=["block", "weights", "sums"])

    return rows.repartition("block").mapInArrow(run, "block int, weights binary, sums binary")


def encode_texts(own: DataFrame, text_col: str, carry: list[str], shared) -> DataFrame:
    """Add to each text what training and scoring need, so that it is cut into tokens once: ``ids`` (the rows of its tokens
    as 16-bit numbers), ``n_tokens``, ``sure`` (tokens with a broadcast count), ``base_part`` (sum of the logs of those
    counts + 0.5), ``known_part`` (the same over tokens in buckets) and ``rare`` (all other tokens, with their times)."""
    coders: list[Coder] = []  # a task's own

    def compute(texts):
        if not coders:
            coders.append(Coder(shared.value))
        coder = coders[0]
        made = coder.encode(texts)
        starts = np.cumsum(made.sizes) - made.sizes
        counts = np.where(made.number >= 0, coder.count[made.number], 0.0)
        logs = np.where(made.number >= 0, np.log(counts + 0.5), 0.0)
        inside = (made.rows > OWN_WORDS) & (made.rows < FIRST_CLASS)
        text_of = np.searchsorted(starts, made.rare, side="right") - 1
        pair, times = np.unique(text_of * len(made.words) + made.rare_words, return_counts=True)
        text, word = np.divmod(pair, max(1, len(made.words)))
        offsets = np.searchsorted(text, np.arange(len(made.sizes) + 1))
        rare = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
            [made.words.take(pa.array(word)), pa.array(times, pa.int64())], ["token", "times"]))
        ids = pa.Array.from_buffers(pa.binary(), len(made.sizes), [None, pa.py_buffer(
            np.concatenate([[0], 2 * np.cumsum(made.sizes)]).astype(np.int32).tobytes()), pa.py_buffer(made.rows.astype(np.uint16).tobytes())])
        return {"ids": ids, "n_tokens": made.sizes, "sure": _by_text((counts > 0).astype(np.int64), starts),
                "base_part": _by_text(logs, starts), "known_part": _by_text(np.where(inside, logs, 0.0), starts), "rare": rare}

    return with_columns(own, [text_col], carry, "ids binary, n_tokens long, sure long, base_part double, known_part double, "
                        "rare array<struct<token: binary, times: long>>", compute, as_lists=False)


def _by_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the tokens' values of each text; each has a token."""
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, values.dtype)


def train_round(training: DataFrame, shared, start: Model, steps: Steps, shards: int) -> tuple[Model, Steps]:
    """Parameters and step sizes after one round over the ``ids`` of ``training``, whose column ``place`` (0 to ``shards`` - 1)
    tells the shard and ``at`` the order in it: averages over the shards, each token's weighted by its occurrences there and those
    of the context places by all tokens. Without texts they stay as they are.
    """
    begin = training.sparkSession.sparkContext.broadcast((start, steps))
    n_rows = len(start.b)

    def learned(words: Vocabulary, texts: Iterator[bytes]) -> list[tuple[int, bytes, bytes]]:
        model, squares = (x.copy() for x in begin.value)
        noise, rng, seen = Noise.of(words), np.random.default_rng(0), np.zeros(n_rows)
        before, waiting = np.zeros(CONTEXT, np.int64), np.zeros(0, np.int64)  # a shard begins like a text

        def learn(stop: int) -> None:
            """Steps over the first ``stop`` tokens that wait; the rest goes on waiting."""
            nonlocal before, waiting
            joined = np.concatenate([before, waiting[:stop]])
            contexts, rows = contexts_of(joined)[CONTEXT:], joined[CONTEXT:]
            targets = words.first_level(rows)
            for at in range(0, stop, BATCH):
                part = slice(at, min(at + BATCH, stop))
                train_batch(model, squares, contexts[part], rows[part], targets[part], noise, rng)
            np.add(seen, np.bincount(targets, minlength=n_rows), out=seen)
            np.add(seen, np.bincount(rows[rows >= SYMBOLS], minlength=n_rows), out=seen)
            before, waiting = joined[len(joined) - CONTEXT:], waiting[stop:]

        held: list[np.ndarray] = []
        size = 0
        for ids in texts:
            held.append(np.frombuffer(ids, np.uint16))
            size += len(held[-1])
            if size >= 64 * BATCH:
                waiting = np.concatenate([waiting, *held])
                learn(len(waiting) // BATCH * BATCH)
                held, size = [], len(waiting)
        waiting = np.concatenate([waiting, *held]).astype(np.int64)
        if len(waiting):
            learn(len(waiting))
        rows = np.ascontiguousarray(model.rows(squares))
        places = np.concatenate([model.c, squares.c], axis=1)
        out = [(i, seen[at:at + BLOCK].tobytes(), rows[at:at + BLOCK].tobytes()) for i, at in enumerate(range(0, n_rows, BLOCK))]
        return [*out, (-1, np.full(CONTEXT, seen[:SYMBOLS].sum()).tobytes(), places.tobytes())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        rows = ((p, i) for batch in batches for p, i in zip(batch.column(0).to_pylist(), batch.column(2)))
        for _, group in itertools.groupby(rows, key=lambda x: x[0]):
            blocks = learned(words, (i.as_py() for _, i in group))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*blocks), (pa.int32(), pa.binary(), pa.binary()))],
                                             names=["block", "weights", "values"])

    dealt = training.select("place", "at", "ids").repartitionById(shards, F.col("place")).sortWithinPartitions("place", "at", "ids")
    parts = _averaged(dealt.mapInArrow(run, "block int, weights binary, values binary")).collect()
    rows, c = start.rows(steps), np.concatenate([start.c, steps.c], axis=1)
    for part in parts:
        w = np.frombuffer(part["weights"])
        x = np.frombuffer(part["sums"]).reshape(len(w), -1)
        to = c if part["block"] < 0 else rows[part["block"] * BLOCK:(part["block"] + 1) * BLOCK]
        to[w > 0] = x[w > 0] / w[w > 0, None]  # a token that no shard met stays as it is
    return Model.from_rows(rows, c)


def train(encoded: DataFrame, shared, words: Vocabulary) -> Model:
    """The model after all rounds over the encoded texts that are not held out. Shards are numbered by ``at``, the hash of
    id and text, and taken in turns by the rounds."""
    model, steps = Model.start(words), Steps.start(SYMBOLS + len(words.word_count))
    shards = max(1, round(words.tokens / SHARD_TOKENS))
    rounds = min(ROUNDS, shards)
    placed = encoded.where("not held_out").select("at", "ids", F.pmod("at", F.lit(shards)).alias("shard"))
    for k in range(rounds):
        mine = placed.where(F.col("shard") % rounds == k).withColumn("place", F.floor(F.col("shard") / rounds).cast("int"))
        model, steps = train_round(mine, shared, model, steps, -(-(shards - k) // rounds))
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row.

    Learns from the rows that are not held out (crc32 of the id as text, modulo FOLDS, is not HELD_OUT; a null id
    trains). A null text is the empty text, one end token. Without training rows all counts are zero and the model
    is its start. Repeated rows stay repeated.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col), F.col(text_col), held_out(id_col).alias("held_out"))
    training = own.where("not held_out")
    counts = materialise(count_tokens(training, text_col), "lbl-counts")
    words = vocabulary(counts)
    shared = spark.sparkContext.broadcast(words)
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    marked = own.select(F.col(id_col).alias("id"), "held_out", key.alias("at"), F.monotonically_increasing_id().alias("row"),
                        F.col(text_col).alias("text"))
    encoded = materialise(encode_texts(marked, "text", ["id", "held_out", "at", "row"], shared), "lbl-encoded")
    fitted = spark.sparkContext.broadcast(train(encoded, shared, words))
    return _scored(encoded, counts, shared, fitted, words, id_col)


def _scored(encoded: DataFrame, counts: DataFrame, shared, fitted, words: Vocabulary, id_col: str) -> DataFrame:
    scale = 1 / np.log(10)

    def compute(ids):
        known, model = shared.value, fitted.value
        texts = ids.to_pylist()
        sizes = np.array([len(x) // 2 for x in texts], np.int64)
        rows = np.frombuffer(b"".join(texts), np.uint16).astype(np.int64)
        targets, contexts = known.first_level(rows), contexts_of(rows)
        weighted = [model.r * model.c[i] for i in range(CONTEXT)]
        log_p = np.empty(len(rows), np.float64)
        for at in range(0, len(rows), 1 << 17):
            part = slice(at, at + (1 << 17))
            v, t = sum(w[contexts[part, i]] for i, w in enumerate(weighted)), targets[part]
            log_p[part] = np.einsum("ij,ij->i", v, model.q[t]) + model.b[t] - model.log_sums(v, slice(0, SYMBOLS))
            log_p[part] += model.log_in_class(known, v, rows[part])
        inside = (targets > OWN_WORDS) & (targets < FIRST_CLASS)  # a word's share of its bucket; its count comes apart
        log_p[inside] -= np.log(known.bucket_total())[targets[inside]]
        return {"model_part": _by_text(log_p, np.cumsum(sizes) - sizes)}

    scored = with_columns(encoded, ["ids"], ["id", "held_out", "row", "n_tokens", "sure", "base_part", "known_part"],
                          "model_part double", compute, as_lists=False)
    rare = encoded.select("row", F.inline("rare"))
    unseen = float(np.log(0.5))
    # hashed, not sorted: a partition's rare counts are small
    looked = (rare.join(counts.where(F.length("token") > 0).hint("shuffle_hash"), "token", "left")
              .groupBy("row").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("found"),
                                  F.sum(F.col("times") * F.when(F.col("n").isNotNull(), F.log(F.col("n") + 0.5))
                                        .otherwise(unseen)).alias("logs")))
    base_total = float(np.log(words.base_total)) if words.base_total > 0 else 0.0
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.join(looked, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("sure") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        ((F.col("base_part") + logs - F.col("n_tokens") * base_total) * scale).alias("base_score"),
        ((F.col("model_part") + F.col("known_part") + logs) * scale).alias("score"))
