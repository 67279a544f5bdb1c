"""The training-data pipeline: quality rules, near-duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of ``documents``. Columns that no stage knows come through as they
are, whatever their names: while an operator works, they lie in one struct.

For every stage: an empty table gives an empty table; texts are read whole,
however long; repeated rows are judged like any other (the near-duplicate stage
keeps one of them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import bpe, decontaminate, quality, simhash
from ledgerflow.llm.inputs import read_table, tokenizer_file
from ledgerflow.llm.storage import materialise


def _apart(docs: DataFrame) -> DataFrame:
    """(rest, text): the documents' texts, with all other columns in a struct that clashes with no result."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != "text"]).alias("rest"), docs["text"])


def _together(apart: DataFrame, columns: list[str], **new) -> DataFrame:
    """The documents' ``columns`` back from (rest, text), ``new`` ones in place of their own."""
    return apart.select(*[new[c].alias(c) if c in new else F.col("text") if c == "text" else F.col("rest").getField(c).alias(c)
                          for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the boosted trees keep. Null and empty texts have no words and go; a document
    whose probability is just the bound stays. Null ids and labels are not trained on."""
    forest = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return _together(quality.judge(_apart(docs), forest).where("kept"), docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id, null ids last; among rows of one id the one
    whose text has the least hash. Null and empty texts are one text."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows, ``n_chars`` anew; documents that lose all their words go.
    Null texts and texts without hits stay as they are; null benchmark texts have no windows."""
    cleaned = decontaminate.clean(_apart(docs), read_table(spark, sf_dir, "benchmark")).where("not emptied")
    return _together(cleaned, docs.columns, n_chars=F.char_length("text").cast("long"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and of their decoding. A null text has none, as an empty
    one; further columns are not read."""
    return bpe.round_trip(docs.select("doc_id", "text"), tokenizer_file(), "text", ["doc_id"]).select(
        "doc_id", "n_tokens", "token_ids", bpe.ids_digest("token_ids").alias("ids_sha256"),
        F.sha2("decoded_text", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding", bpe_encoding),
]

#: The boosted trees, fingerprints and tokenizer are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
