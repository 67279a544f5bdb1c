"""SimHash near-duplicates by Golay-code fuzzy hashing.

A text's fingerprint has 64 bits, each the majority over the XXH64 hashes of
its three-word shingles. Two fingerprints link at MAX_BITS differing bits or
fewer; a group is a connected component of links.

Candidates. The fingerprint is cut into three segments. With two wrong bits
in all, some segment has none (pigeonhole) and the next one has two at most.
The [23,12,7] Golay code turns that tolerance into equal keys: every 23-bit
word lies within three bits of exactly one codeword, and two words within two
bits have a word in common that is within one bit of both. So the codewords
nearest to a word and to its one-bit neighbours (about six) are its keys, and
words within two bits share one. A key is an exact segment with one codeword of
the next: about 16 keys a fingerprint, 34 bits each.

Links. Fingerprints are made distinct first, so copies cost nothing. Within a
bucket of up to SMALL_BUCKET fingerprints all are compared, and a spanning
forest of the true links comes out: at most one link a fingerprint, however
dense the bucket. In larger buckets each fingerprint names the values within
one bit of it; two fingerprints within two bits name a value in common and
link to the smallest that names it. That is exact too, and linear.

Groups. Links go through alternating star contractions until nothing changes;
each round is written to the shared folder, which also cuts the lineage.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrow import with_columns
from ledgerflow.llm.storage import materialise

SHINGLE_WORDS, SEED, MAX_BITS = 3, 42, 2
#: Bits of the three segments, lowest first.
SEGMENTS = (22, 21, 21)
#: Buckets up to this size are compared pairwise in numpy; larger ones go through shared neighbours.
SMALL_BUCKET = 1024
#: Bits, at most (32 MB), and for each row, of the table that tells which rows of :func:`keep_one` may go; where they are
#: many more, more rows are shuffled with their texts, and the result is the same.
TABLE_BITS, BITS_A_ROW = 1 << 28, 64

# Length, message bits and generator polynomial of the binary Golay code.
GOLAY_BITS, GOLAY_MESSAGE, GOLAY_POLYNOMIAL = 23, 12, 0b110001110101


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of ``text``; 0 where it has no words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        starts, ends = [0], [sum(map(len, words)) + len(words) - 1]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        stops = np.cumsum(sizes)
        ends = (stops[SHINGLE_WORDS - 1:] - 1).tolist()
        starts = (stops - sizes)[:len(ends)].tolist()
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    hashes = np.array([hashed(joined[i:j], SEED) for i, j in zip(starts, ends)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``fingerprint`` (long, the 64 bits as a signed number) of each text; null and empty texts have 0."""
    def compute(texts):
        return {"fingerprint": np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)}

    return with_columns(df, [text_col], carry, "fingerprint long", compute)


def golay_errors() -> np.ndarray:
    """The error pattern of each 11-bit syndrome: all patterns of up to three bits, one per syndrome."""
    errors = np.zeros(1 << (GOLAY_BITS - GOLAY_MESSAGE), np.int64)
    for n in range(4):
        for bits in itertools.combinations(range(GOLAY_BITS), n):
            pattern = sum(1 << b for b in bits)
            errors[golay_syndrome(np.array([pattern]))[0]] = pattern
    return errors


def golay_syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of each word, as a polynomial over GF(2), by the generator."""
    rest = words.astype(np.int64)
    for shift in range(GOLAY_MESSAGE - 1, -1, -1):
        high = (rest >> (shift + GOLAY_BITS - GOLAY_MESSAGE)) & 1
        rest = rest ^ (high * (GOLAY_POLYNOMIAL << shift))
    return rest


def codeword_indices(words: np.ndarray, bits: int) -> np.ndarray:
    """(n, bits + 1) indices of the codewords nearest to each word and to its one-bit neighbours in ``bits`` bits."""
    flips = np.array([0, *(1 << b for b in range(bits))], np.int64)
    near = words[:, None] ^ flips[None, :]
    errors = golay_errors()
    return (near ^ errors[golay_syndrome(near)]) >> (GOLAY_BITS - GOLAY_MESSAGE)


def fuzzy_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of the value, key) for every key of every 64-bit value."""
    values = values.view(np.uint64)
    rows, keys, offsets = [], [], np.cumsum([0, *SEGMENTS])
    parts = [((values >> np.uint64(o)) & np.uint64((1 << n) - 1)).astype(np.int64) for o, n in zip(offsets, SEGMENTS)]
    for s in range(len(SEGMENTS)):
        t = (s + 1) % len(SEGMENTS)
        found = np.sort(codeword_indices(parts[t], SEGMENTS[t]), axis=1)
        new = np.ones(found.shape, bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        row, col = np.nonzero(new)
        rows.append(row)
        keys.append((np.int64(s) << 40) | (parts[s][row] << GOLAY_MESSAGE) | found[row, col])
    return np.concatenate(rows), np.concatenate(keys)


def candidate_keys(distinct: DataFrame) -> DataFrame:
    """(key, fingerprint) for each key of each distinct ``fingerprint``."""
    def run(batches):
        for batch in batches:
            values = batch.column(0).to_numpy()
            rows, keys = fuzzy_keys(values)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values[rows])], names=["key", "fingerprint"])

    return distinct.select("fingerprint").mapInArrow(run, "key long, fingerprint long")


def spanning_forest(values: np.ndarray) -> list[tuple[int, int]]:
    """Links (value, value) that connect exactly what the links of all pairs within MAX_BITS connect."""
    if len(values) == 2:
        a, b = values.tolist()
        return [(a, b)] if ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= MAX_BITS else []
    bits, out, left = values.view(np.uint64), [], np.arange(len(values))
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.bitwise_count(bits[left][:, None] ^ bits[front][None, :]) <= MAX_BITS
            found = near.any(axis=1)
            out += zip(values[left[found]].tolist(), values[front[near[found].argmax(axis=1)]].tolist())
            front, left = left[found], left[~found]
    return out


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): fingerprints whose components are those of all links."""
    keyed = materialise(candidate_keys(distinct), "simhash-keys")  # used twice
    sizes = keyed.groupBy("key").count().where("count > 1")
    shared = materialise(keyed.join(sizes, "key"), "simhash-buckets")

    def run(batches):
        for batch in batches:
            ends, values = batch.column(0).offsets.to_numpy(), batch.column(0).values.to_numpy()
            pairs = [p for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()) for p in spanning_forest(values[i:j])]
            a, b = zip(*pairs) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    small = shared.where(F.col("count") <= SMALL_BUCKET).groupBy("key").agg(F.collect_list("fingerprint").alias("all"))
    close = small.select("all").mapInArrow(run, "a long, b long")
    crowded = shared.where(F.col("count") > SMALL_BUCKET).select("fingerprint").distinct()
    one_off = F.transform(F.sequence(F.lit(-1), F.lit(63)),
                          lambda i: F.when(i < 0, F.col("fingerprint"))
                          .otherwise(F.col("fingerprint").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    named = crowded.select(F.col("fingerprint").alias("a"), F.explode(one_off).alias("near"))
    firsts = named.groupBy("near").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1").select("near", "b")
    return close.union(named.join(firsts, "near").where("a != b").select("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, for every node of the edges (a, b) but the roots.

    Alternating large and small stars: every node hands its larger neighbours, then its smaller ones, to the
    smallest it knows. The number of rounds is logarithmic; only two totals come to the driver per round.
    """
    def hand_over(both: DataFrame, larger: bool) -> DataFrame:
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(least, "a")
        if larger:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))

    def total(frame: DataFrame):
        return frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    stars = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b"),
                        "simhash-links")
    state = total(stars)
    while True:
        if not state[0]:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        large = hand_over(stars.union(stars.select("b", "a")), larger=True).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        stars = materialise(hand_over(down, larger=False).where("a != b").distinct(), "simhash-stars")
        before, state = state, total(stars)
        if before == state:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def rooted(printed: DataFrame) -> DataFrame:
    """(fingerprint, root) of each distinct fingerprint; equal roots mean one group."""
    distinct = printed.select("fingerprint").distinct()
    roots = components(links(distinct)).withColumnRenamed("node", "fingerprint")
    return distinct.join(roots, "fingerprint", "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id): the smallest id reachable over links, one row per input row.

    Null and empty texts have fingerprint zero and link like any other. Null ids take part but are never a
    component's id, unless all ids of the component are null. Repeated rows stay repeated.
    """
    printed = materialise(fingerprints(df.select(id_col, text_col), text_col, [id_col]), "simhash-prints")
    firsts = printed.groupBy("fingerprint").agg(F.min(id_col).alias("least"))
    known = firsts.join(rooted(printed), "fingerprint")
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = known.join(smallest, "root").select("fingerprint", "component_id")
    return (printed.join(named, "fingerprint")
            .select(id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"))


def _bit_table(keys: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap): a bit for each hash in ``h``, of ``bits`` bits in all; a row holds 32,768 of them."""
    place = F.pmod("h", F.lit(bits)) + 1
    return keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))


def _in_table(df: DataFrame, table: DataFrame, bits: int) -> DataFrame:
    """``df`` with ``maybe``: the bit of the hash in ``h`` is set."""
    place = F.pmod("h", F.lit(bits)) + 1
    position = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1))
    return (df.withColumn("bucket", F.bitmap_bucket_number(place)).join(F.broadcast(table), "bucket", "left")
            .withColumn("maybe", F.coalesce(bit == 1, F.lit(False))).drop("bucket", "bitmap"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with one row for each group: the smallest id's (ids before null), ties by the text's hash.

    Null and empty texts are one text. Who goes is found from ids and hashes alone; a bit table of bounded size, by their
    number, tells which rows may go or are repeated, and only these (and a few that share a bit) are shuffled with their
    texts. Repeated rows are made one before that, so a row repeated without end costs each task one row. All columns
    come through as they are, whatever their names; an empty table stays empty.
    """
    keys = {"id": F.coalesce(F.col(id_col).cast("string"), F.lit("")), "no_id": F.col(id_col).isNull(),
            "text_hash": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))}
    # the row's own columns lie in a struct, out of the way of the keys
    marked = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), df[id_col].alias("own_id"), df[text_col].alias("own_text"),
                       *[c.alias(k) for k, c in keys.items()])
    printed = materialise(fingerprints(marked.select("own_id", "own_text", *keys), "own_text", ["own_id", *keys]), "simhash-prints")
    best = printed.groupBy("fingerprint").agg(F.min(F.struct("no_id", "own_id", "text_hash", "id")).alias("best"))
    stay = best.join(rooted(printed), "fingerprint").groupBy("root").agg(F.min("best").alias("best"))
    stay = stay.select(*[F.col(f"best.{k}").alias(k) for k in keys], F.lit(True).alias("stays"))
    copies = printed.groupBy(*keys).agg(F.count("*").alias("n")).join(stay, list(keys), "left")
    surplus = materialise(copies.where("stays IS NULL OR n > 1").select(*keys, F.coalesce("stays", F.lit(False)).alias("stays")),
                          "simhash-surplus")
    bits = min(TABLE_BITS, max(1 << 15, 1 << (surplus.count() * BITS_A_ROW).bit_length()))
    table = materialise(_bit_table(surplus.select(F.xxhash64(*keys).alias("h")), bits), "simhash-table")
    sorted_out = _in_table(marked.select("row", *keys, F.xxhash64(*keys).alias("h")), table, bits)
    sure = sorted_out.where("NOT maybe").select("row")
    others = (sorted_out.where("maybe").select("row", *keys).dropDuplicates(list(keys))
              .join(surplus.where("NOT stays").select(*keys), list(keys), "left_anti").select("row"))
    return sure.unionByName(others).select(*[F.col("row").getField(c).alias(c) for c in df.columns])
