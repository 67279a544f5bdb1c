"""BPE encoding and decoding as bounded-lookahead streaming transducers.

A byte-pair encoder applies its merges in rank order over a whole pretoken.
The transducer gets the same tokens from left to right. A chain of tokens is
the encoding of its bytes exactly if each neighbouring pair can stand side by
side, that is if no merge would have joined them across their border. So it
takes the longest token that fits its left neighbour, and goes back a token
where none fits. More bytes can change only tokens near the end, and
:meth:`BytePairModel.lookahead` bounds how near: a change moves left by merges
of strictly rising rank, each of which takes in the token left of the border,
so the longest such chain of merges is a sufficient lookahead. Tokens that end
further back are stable and emitted; what is held is that constant and one
chunk, however long the input.

Decoding maps ids to bytes and runs an incremental UTF-8 state machine that
holds at most three bytes of an unfinished character.

Null text encodes as the empty text; null ids decode to null.
"""

from __future__ import annotations

import codecs
import functools
import json
import struct
from collections.abc import Iterable, Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrow import with_columns

# Fixed value: the pattern that splits text into pretokens before the merges.
# Letters come first, which changes no match, as no other alternative can begin with one, and splits prose 9% faster.
PRETOKEN = r""" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Longest vocabulary that is broadcast; a larger file is refused.
MAX_VOCABULARY = 1_000_000
#: Pretokens of up to MEMO_BYTES characters are remembered, in two generations of MEMO_SIZE; PAIRS pairs of tokens are.
MEMO_BYTES, MEMO_SIZE, PAIRS = 64, 80_000, 200_000
#: Bytes of a long pretoken that enter the transducer at a time.
CHUNK = 4096
#: Texts of up to so many characters are split into pretokens at once, longer ones as they are needed.
WHOLE = 1 << 16

_NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable, else from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def refuse_unknown(spec: dict) -> None:
    """Raise where a tokenizer file asks for something else than plain byte-level pairs with the usual pretokens."""
    model, split, decoder = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
    wrong = [f"{name} {spec[name]}" for name in ("normalizer", "post_processor") if spec.get(name)]
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        wrong.append(f"pre_tokenizer {split}")
    if decoder.get("type") != "ByteLevel":
        wrong.append(f"decoder {decoder}")
    if model.get("type", "BPE") != "BPE":
        wrong.append(f"model type {model['type']}")
    wrong += [f"model {k} {model[k]!r}" for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                  "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    wrong += [f"added token {t['content']!r} {k}" for t in spec.get("added_tokens", [])
              for k in ("lstrip", "rstrip", "single_word", "normalized") if t.get(k)]
    if wrong:
        raise ValueError("tokenizer settings that are not implemented: " + "; ".join(wrong))


class BytePairModel:
    """Vocabulary and merges of a byte-level tokenizer file; small, fixed and broadcast whole."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]], special: dict[str, int]):
        if len(vocabulary) > MAX_VOCABULARY:
            raise ValueError(f"a vocabulary of {len(vocabulary)} tokens exceeds {MAX_VOCABULARY}")
        self.special = special
        self.text = {i: b for b, i in vocabulary.items()} | {i: s.encode() for s, i in special.items()}
        self.parts: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for r, (a, b) in enumerate(merges):
            for part in (a, b):
                if len(part) > 1 and part not in self.parts:
                    raise ValueError(f"merge {r} uses {part!r} before any merge makes it")
            if a + b in self.parts:
                raise ValueError(f"two merges make {a + b!r}")
            self.parts[a + b] = (r, a, b)
            self.rank[a, b] = r
        reachable = {bytes([b]) for b in range(256)} & set(vocabulary)
        for whole, (r, a, b) in self.parts.items():
            if a in reachable and b in reachable and whole in vocabulary and not self._crossed(a, b, r):
                reachable.add(whole)
        #: every prefix of a token, with the token's id or -1
        self.trie = {t[:n]: -1 for t in reachable for n in range(1, len(t))} | {t: vocabulary[t] for t in reachable}
        self.window = self.lookahead()
        self.memo: dict[str, bytes] = {}  # ids as 32-bit numbers
        self.older: dict[str, bytes] = {}
        self.beside: dict[int, bool] = {}

    @classmethod
    def from_file(cls, path: str) -> BytePairModel:
        """The model of a tokenizer file; settings that would give other ids than those computed here are refused."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        refuse_unknown(spec)
        byte, model = byte_alphabet(), spec["model"]

        def raw(token: str) -> bytes:
            return bytes(byte[c] for c in token)

        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return cls({raw(t): i for t, i in model["vocab"].items() if t not in special},
                   [(raw(a), raw(b)) for a, b in pairs], special)

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The tokens that stand at one edge of ``token`` while it is built, each with the rank of the merge that ends it."""
        edge, ends, parts = [], _NEVER, self.parts
        while True:
            edge.append((token, ends))
            if token not in parts:
                return edge
            made = parts[token]
            ends, token = made[0], made[side]

    def _crossed(self, left: bytes, right: bytes, before: int = _NEVER) -> bool:
        """Whether some merge of rank below ``before`` joins the two across their border.

        Among equal ranks the leftmost merge goes first, hence < on the left and <= on the right.
        """
        rank = self.rank
        firsts = self._edge(right, 1)
        for x, x_ends in self._edge(left, 2):
            for y, y_ends in firsts:
                r = rank.get((x, y), _NEVER)
                if r < before and r < x_ends and r <= y_ends:
                    return True
        return False

    def chain(self, data: bytes, before: int = -1) -> list[int]:
        """The encoding of ``data`` right of the token ``before``.

        Takes the longest token that fits; where none does, the position is dead and the token before it shrinks.
        Each position dies at most once, so the steps are linear in the bytes.
        """
        trie, beside, text = self.trie, self.beside, self.text
        ids, dead, at, end, limit = [], set(), 0, len(data), _NEVER
        while at < end:
            found, stop = [], at + 1
            while stop <= end:
                right = trie.get(data[at:stop])
                if right is None:
                    break
                if right >= 0:
                    found.append((right, stop))
                stop += 1
            left = ids[-1] if ids else before
            for right, stop in reversed(found):
                if dead and (stop >= limit or stop in dead):
                    continue
                if left >= 0:
                    fits = beside.get(left << 20 | right)
                    if fits is None:
                        if len(beside) >= PAIRS:
                            beside.clear()
                        fits = beside[left << 20 | right] = not self._crossed(text[left], text[right])
                    if not fits:
                        continue
                ids.append(right)
                at, limit = stop, _NEVER
                break
            else:
                if not ids:
                    raise ValueError(f"the vocabulary cannot encode {data[at:at + 8]!r}")
                dead.add(at)
                limit = at
                at -= len(text[ids.pop()])
        return ids

    def lookahead(self) -> int:
        """Bytes after which a token can no longer change: the longest chain of border-crossing merges.

        The merge (x, y) moves the border of change left by len(x). Merge (x2, y2) can follow it only with a
        higher rank and with x at the left edge of y2. One pass in rank order finds the longest chain.
        """
        longest: dict[bytes, int] = {}
        most = 1
        for whole, (_, x, y) in self.parts.items():  # in rank order
            reach = len(x) + max((longest.get(t, 0) for t, _ in self._edge(y, 1)), default=0)
            if reach > longest.get(x, 0):
                longest[x] = reach
            most = max(most, reach)
        return most


@functools.lru_cache(maxsize=4)
def load_model(path: str) -> BytePairModel:
    return BytePairModel.from_file(path)


class Transducer:
    """Encodes the bytes of one pretoken as they come; ``push`` and ``close`` return the ids that became stable."""

    def __init__(self, model: BytePairModel):
        self.model = model
        self.before = -1  # the last token emitted
        self.held = b""

    def push(self, data: bytes) -> list[int]:
        self.held += data
        return self._emit(len(self.held) - self.model.window)

    def close(self) -> list[int]:
        ids = self._emit(len(self.held))
        self.before = -1
        return ids

    def _emit(self, stable: int) -> list[int]:
        if stable <= 0:
            return []
        ids, done = [], 0
        for token in self.model.chain(self.held, self.before):
            size = len(self.model.text[token])
            if done + size > stable:
                break
            done += size
            ids.append(token)
        self.before = ids[-1] if ids else self.before
        self.held = self.held[done:]
        return ids


class Encoder:
    """Text to ids: special tokens first, then pretokens, each through the transducer."""

    def __init__(self, model: BytePairModel):
        self.model = model
        self.pretoken = regex.compile(PRETOKEN)
        names = sorted(model.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def stream(self, text: str) -> Iterator[bytes]:
        """The ids of ``text`` as 32-bit numbers, in blocks, each as soon as its tokens are stable."""
        at = 0
        if self.special is not None:
            for m in self.special.finditer(text):
                yield from self._plain(text[at:m.start()])
                yield struct.pack("<i", self.model.special[m.group()])
                at = m.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[bytes]:
        known, new = self.model.memo.get, self._pretoken
        if len(text) <= WHOLE:
            yield b"".join([known(word) or new(word) for word in self.pretoken.findall(text)])
            return
        for m in self.pretoken.finditer(text):
            word = m.group()
            yield known(word) or new(word)

    def _pretoken(self, word: str) -> bytes:
        model = self.model
        if len(word) <= MEMO_BYTES:
            ids = model.older.get(word)
            if ids is None:
                ids = np.array(model.chain(word.encode()), "<i4").tobytes()
            if len(model.memo) >= MEMO_SIZE:
                model.older = dict(model.memo)
                model.memo.clear()
            model.memo[word] = ids
            return ids
        transducer, blocks = Transducer(model), []
        for at in range(0, len(word), CHUNK):
            blocks.append(np.array(transducer.push(word[at:at + CHUNK].encode()), "<i4").tobytes())
        blocks.append(np.array(transducer.close(), "<i4").tobytes())
        return b"".join(blocks)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(self.stream(text)) if text else b"", "<i4")


class Decoder:
    """Ids to text as they come; an unfinished character waits, broken bytes become U+FFFD."""

    def __init__(self, model: BytePairModel | SimpleNamespace):
        self.bytes_of = model.text
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join([self.bytes_of[i] for i in ids]))

    def close(self) -> str:
        return self.state.decode(b"", final=True)

    def decode(self, ids: np.ndarray) -> str:
        self.state.reset()
        pieces = [self.push(ids[at:at + CHUNK].tolist()) for at in range(0, len(ids), CHUNK)]
        return "".join([*pieces, self.close()])


def encode(df: DataFrame, tokenizer: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``token_ids`` (array<int>) and ``n_tokens`` (long) of each text; null is the empty text.

    ``tokenizer`` is the path of a byte-level BPE ``tokenizer.json`` on the driver. Columns of those two
    names give way to the results. No shuffle; rows keep their partitions; repeated rows stay repeated.
    """
    model = df.sparkSession.sparkContext.broadcast(load_model(tokenizer))

    def compute(texts):
        encoder = Encoder(model.value)
        return _id_columns([encoder.encode(t) for t in texts])

    return with_columns(df, [text_col], carry, "token_ids array<int>, n_tokens long", compute)


def _id_columns(ids: list[np.ndarray]) -> dict[str, object]:
    sizes = np.array([len(x) for x in ids], np.int64)
    flat = np.concatenate(ids) if ids else np.zeros(0, "<i4")
    offsets = np.concatenate([[0], sizes.cumsum()]).astype(np.int32)
    return {"token_ids": pa.ListArray.from_arrays(offsets, flat), "n_tokens": sizes}


def round_trip(df: DataFrame, tokenizer: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """:func:`encode`, then :func:`decode` of the ids, in the same tasks: one Python worker a core instead of two."""
    model = df.sparkSession.sparkContext.broadcast(load_model(tokenizer))

    def compute(texts):
        encoder, decoder = Encoder(model.value), Decoder(model.value)
        ids = [encoder.encode(t) for t in texts]
        return _id_columns(ids) | {"decoded_text": [decoder.decode(x) for x in ids]}

    return with_columns(df, [text_col], carry, "token_ids array<int>, n_tokens long, decoded_text string", compute)


def decode(df: DataFrame, tokenizer: str, ids_col: str = "token_ids", carry: list[str] | None = None) -> DataFrame:
    """Add ``decoded_text`` of each array of ids, special tokens kept; null ids give null, no ids the empty text."""
    model = df.sparkSession.sparkContext.broadcast(SimpleNamespace(text=load_model(tokenizer).text))  # decoding needs no merges

    def compute(rows):
        decoder = Decoder(model.value)
        return {"decoded_text": [decoder.decode(row.values.to_numpy()) if row.is_valid else None for row in rows]}

    return with_columns(df, [ids_col], carry, "decoded_text string", compute, as_lists=False)


def ids_digest(ids_col: str):
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), ","), 256)


def round_trip_digest(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded text."""
    return round_trip(df.select(id_col, text_col), tokenizer, text_col, [id_col]).select(
        id_col, "n_tokens",
        ids_digest("token_ids").alias("ids_sha256"),
        F.sha2("decoded_text", 256).alias("decoded_sha256"))
