import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rng():
    return random.Random(7)


@pytest.fixture()
def make_docs(spark):
    """A documents table from texts or (id, text) pairs."""
    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def tokenizer_path():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")
