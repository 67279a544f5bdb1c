"""Quality rules: fixed base rules, then gradient-boosted trees over document statistics.

The base rules reject texts of fewer than MIN_WORDS words and texts that
repeat themselves. The rest is judged by boosted trees fitted on a bounded
sample of the labelled documents. More symbols, repeated lines, repeated
words, capitals or exclamation marks can never raise a document's score: the
trees are monotonic in those statistics.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrow import with_columns
from ledgerflow.llm.boosting import Forest, fit

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
#: Labelled documents that the trees are fitted on, about; twice as many at most.
SAMPLE_ROWS = 20_000
#: Rows whose probability of being good is lower are rejected.
LEAST_PROBABILITY = 0.5
#: Fewer labelled rows than this, or rows of one label only, fit no trees: the base rules decide alone.
LEAST_SAMPLE = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_letters", "n_digits", "n_shouts", "n_points", "n_distinct")
#: The model's features with the direction in which each may move the score.
FEATURES = (("words", 0), ("word_length", 0), ("symbols", -1), ("dup_lines", -1), ("repeats", -1),
            ("capitals", -1), ("shouts", -1), ("digits", 0), ("points", 0), ("distinct", 0), ("line_words", 0))


def _ids(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter([seen.setdefault(w, len(seen)) for w in words], np.int64, len(words))


def repeated_words(ids: np.ndarray) -> int:
    """Words covered by windows of WINDOW words that occur twice or more in the text, the first one included."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    key, distinct = ids[:n], int(ids.max()) + 1
    for k in range(1, WINDOW):
        if int(key.max() + 1) * distinct >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
        key = key * distinct + ids[k:n + k]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    if not twice.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:n] += twice
    edge[WINDOW:WINDOW + n] -= twice
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def statistics(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one whole text; a null or empty text has none."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return (0,) * len(COUNTS)
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    ids = _ids(words)
    spaces = of[0x20] + of[0x09:0x0E].sum()
    return (len(words), int(len(raw) - of[0x80:0xC0].sum() - spaces), int(of[list(SYMBOLS)].sum()),
            len(lines) - len(set(lines)), repeated_words(ids), len(lines), int(of[0x41:0x5B].sum()),
            int(of[0x41:0x5B].sum() + of[0x61:0x7B].sum()), int(of[0x30:0x3A].sum()), int(of[0x21]),
            int(of[[0x2C, 0x2E]].sum()), int(ids.max()) + 1)


def features(counts: np.ndarray) -> np.ndarray:
    """(rows, FEATURES) from (rows, COUNTS)."""
    c = dict(zip(COUNTS, counts.T.astype(np.float64)))
    words = np.maximum(c["n_words"], 1)
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words,
        c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] / words,
        c["n_upper"] / np.maximum(c["n_letters"], 1), c["n_shouts"] / words, c["n_digits"] / words,
        c["n_points"] / words, c["n_distinct"] / words, words / np.maximum(c["n_lines"], 1)], axis=1)


def measure(df: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add the COUNTS (long) of each whole text. No shuffle."""
    def compute(texts):
        return dict(zip(COUNTS, np.array([statistics(t) for t in texts], np.int64).reshape(-1, len(COUNTS)).T))

    return with_columns(df, [text_col], carry, ", ".join(f"{c} long" for c in COUNTS), compute)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Forest | None:
    """Trees fitted on about ``sample_rows`` labelled documents, chosen by the hash of the id.

    Only ids of the sample (bounded by the parameter) are broadcast and only their counts come to the driver.
    None if there are too few labels or one kind only. Null ids and null labels take no part.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    share = min(1.0, sample_rows / max(1, usable.count()))
    hashed = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = (usable.where(hashed).groupBy(id_col).agg(F.min(label_col).alias("__label")).limit(2 * sample_rows))
    known = docs.select(id_col, text_col).join(F.broadcast(sample), id_col)
    rows = measure(known, text_col, [id_col, "__label"]).limit(2 * sample_rows).collect()
    rows.sort(key=lambda r: tuple(r))
    y = np.array([r["__label"] for r in rows], np.float64)
    if len(rows) < LEAST_SAMPLE or y.min() == y.max():
        return None
    counts = np.array([[r[c] for c in COUNTS] for r in rows], np.int64)
    judged = ~base_failed(counts)
    if judged.sum() < LEAST_SAMPLE or y[judged].min() == y[judged].max():
        return None
    return fit(features(counts[judged]), y[judged], np.array([d for _, d in FEATURES]))


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeats = counts[:, COUNTS.index("n_words")], counts[:, COUNTS.index("n_repeat_words")]
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def judge(docs: DataFrame, forest: Forest | None, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add the COUNTS, ``base_failed``, ``probability`` (of being good; 1 without trees) and ``kept``.

    ``kept`` is false where the base rules fail, else whether the probability is LEAST_PROBABILITY or more.
    Null and empty texts have no words and fail. Columns of these names give way to the results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def compute(texts):
        counts = np.array([statistics(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
        failed = base_failed(counts)
        trees = shared.value
        good = np.ones(len(counts)) if trees is None else 1 / (1 + np.exp(-trees.score(features(counts))))
        return dict(zip(COUNTS, counts.T)) | {
            "base_failed": failed, "probability": good, "kept": ~failed & (good >= LEAST_PROBABILITY)}

    results = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, probability double, kept boolean"
    return with_columns(docs, [text_col], carry, results, compute)
