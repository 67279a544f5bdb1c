import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerflow.llm import bpe


@pytest.fixture(scope="module")
def tokenizer(tokenizer_path):
    return pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path)


@pytest.fixture(scope="module")
def model(tokenizer_path):
    return bpe.load_model(tokenizer_path)


CASES = ["", " ", "a", "don't stop'll", "x" * 70_000, "-" * 9001, " " * 5000 + "end", "ab" * 4000, "日本語 テスト 😀é",
         "<|endoftext|>", "a<|endoftext|> b  <|endoftext|><|endof", "tab\t\tnew\n\n\nline   \u0085x", "1234567 ½²"]


@pytest.mark.parametrize("text", CASES)
def test_ids_and_text_equal_the_library(model, tokenizer, text):
    ids = bpe.Encoder(model).encode(text)
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert bpe.Decoder(model).decode(ids) == text


@given(st.text(alphabet=st.sampled_from(list("abthein '-=sl \n1é日 ")), max_size=80))
@settings(max_examples=300, deadline=None)
def test_random_texts_equal_the_library(model, tokenizer, text):
    assert bpe.Encoder(model).encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_stream_of_single_bytes_emits_stable_tokens_and_holds_little(model, rng):
    word = "".join(rng.choice("thein") for _ in range(5000))
    stream, ids, held = bpe.Transducer(model), [], 0
    for byte in word.encode():
        ids += stream.push(bytes([byte]))
        held = max(held, len(stream.held))
    ids += stream.close()
    assert ids == model.chain(word.encode())
    assert held <= model.window + max(map(len, model.trie))


def test_lookahead_is_the_longest_chain():
    letters = {b"a": 0, b"b": 1, b"c": 2, b"ab": 3, b"bc": 4, b"abab": 5}
    model = bpe.BytePairModel(letters, [(b"b", b"c"), (b"a", b"b"), (b"ab", b"ab")], {})
    # (b, c) takes b from ab, then (ab, ab) loses its right part: 1 + 0, or 2 by itself
    assert model.lookahead() >= 2
    assert model.chain(b"ababc") == [3, 0, 4]


def test_improper_merges_are_refused():
    with pytest.raises(ValueError):
        bpe.BytePairModel({b"a": 0, b"b": 1, b"ab": 2, b"aba": 3}, [(b"ab", b"a"), (b"a", b"b")], {})


def test_broken_bytes_decode_as_the_library(model, tokenizer):
    ids = np.array([model.trie[b"\xc3"], model.trie[b"a"], model.trie[b"\xe6"], model.trie[b"\x97"]])
    assert bpe.Decoder(model).decode(ids) == tokenizer.decode(ids.tolist(), skip_special_tokens=False)


def test_query_digests(make_docs, tokenizer_path, tokenizer):
    texts = ["a b", None, "", "a b", "<|endoftext|>z", "w" * 20_000]
    docs = make_docs([*enumerate(texts), (None, "no id")])
    got = {r["doc_id"]: r for r in bpe.round_trip_digest(docs, tokenizer_path).collect()}
    assert len(got) == 7
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_clashing_columns_and_empty_table(spark, make_docs, tokenizer_path):
    docs = make_docs(["a"]).selectExpr("doc_id", "text", "'x' AS N_TOKENS", "source")
    out = bpe.encode(docs, tokenizer_path)
    assert out.columns == ["doc_id", "text", "source", "token_ids", "n_tokens"] and out.first()["n_tokens"] == 1
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, token_ids array<int>"), tokenizer_path).first()["decoded_text"] is None
    assert bpe.round_trip_digest(make_docs([]), tokenizer_path).count() == 0


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}},
    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}}, {"pre_tokenizer": None},
    {"decoder": None}, {"model": {"dropout": 0.1}}, {"model": {"ignore_merges": True}}, {"added": {"lstrip": True}}, {"added": {"single_word": True}}])
def test_settings_that_are_not_implemented_are_refused(tokenizer_path, tmp_path, change):
    import json

    with open(tokenizer_path, encoding="utf-8") as f:
        spec = json.load(f)
    bpe.refuse_unknown(spec)
    if "model" in change:
        spec["model"].update(change["model"])
    elif "added" in change:
        spec["added_tokens"][0].update(change["added"])
    else:
        spec.update(change)
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match="not implemented"):
        bpe.BytePairModel.from_file(str(path))
