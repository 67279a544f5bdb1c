"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import (bpe, chat, collocations, decontaminate, html_text, lbl, licenses, quality, repair,
                            sharding, simhash, url_filter, warc)
from ledgerflow.llm.inputs import read_table, tokenizer_file

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and their decoding, as digests."""
    return bpe.round_trip_digest(read_table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return url_filter.judge(read_table(spark, sf_dir, "pages"), carry=["page_id"])


@query
def op3_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as quoting mail, linked back and put in reply order without quotes."""
    return chat.format_chats(chat.as_mail(read_table(spark, sf_dir, "conversations")))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.place(read_table(spark, sf_dir, "documents"), carry=["doc_id"])


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark found in every document."""
    found = decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                 carry=["doc_id"])
    return found.drop("spans")


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every document."""
    return licenses.scan(read_table(spark, sf_dir, "documents"), carry=["doc_id"])


@query
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and log-bilinear scores of every document."""
    return lbl.score(read_table(spark, sf_dir, "documents"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back from the bundles."""
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document, by trees fitted on the labels."""
    docs = read_table(spark, sf_dir, "documents")
    forest = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.judge(docs, forest, carry=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return simhash.group(read_table(spark, sf_dir, "documents"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage."""
    return repair.repair_damaged(read_table(spark, sf_dir, "conversations"))


@query
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(read_table(spark, sf_dir, "pages"), carry=["page_id", "url"])


LLM_QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

LLM_ORACLE_SQL["op2_url_filter"] = url_filter.judge_sql()
LLM_ORACLE_SQL["op5_decontamination"] = decontaminate.report_sql()
LLM_ORACLE_SQL["op8_warc"] = warc.round_trip_sql()
LLM_ORACLE_SQL["op3_chat_quotes"] = chat.format_chats_sql()
LLM_ORACLE_SQL["op11_collocations"] = collocations.collocations_sql()
LLM_ORACLE_SQL["op4_sharding"] = sharding.place_sql()
