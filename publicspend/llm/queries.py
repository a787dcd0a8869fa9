"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from publicspend.llm import (
    fill_middle,
    line_cleaning,
    main_text,
    mixing,
    ngram_join,
    oracles,
    packing,
    pieces,
    prefix_trie,
    run_index,
    sanitise,
    url_reputation,
    vector_search,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """A page's own text is its outcome: whether it is full of signs that prose seldom has."""
    pages = table(spark, folder, "pages")
    return url_reputation.judge_urls(pages.withColumn("bad", url_reputation.junk(F.col("html"))))


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op3_run_index(spark: SparkSession, folder: str) -> DataFrame:
    return run_index.remove_repeats(table(spark, folder, "documents"), with_kept=False)


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(table(spark, folder, "documents"))


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return sanitise.digest(sanitise.find_spans(table(spark, folder, "documents")))


def op7_kd_trees(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


def op9_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = line_cleaning.clean_lines(table(spark, folder, "documents"), with_text=False)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(table(spark, folder, "pages"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.turn_sequences(table(spark, folder, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.branched(turns))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, folder, "documents")))


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digest(fill_middle.fill_in_middle(table(spark, folder, "documents")))


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express; tests hold the others against brute force."""
    return oracles.oracle_sql()


def queries() -> dict[str, Query]:
    return {
        "op1_url_reputation": op1_url_reputation,
        "op2_source_mix": op2_source_mix,
        "op3_run_index": op3_run_index,
        "op4_warc": op4_warc,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_personal_data": op6_personal_data,
        "op7_kd_trees": op7_kd_trees,
        "op8_ngram_jaccard": op8_ngram_jaccard,
        "op9_line_quality": op9_line_quality,
        "op10_main_text": op10_main_text,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_packing": op12_packing,
        "op13_fill_middle": op13_fill_middle,
    }
