"""The registered queries of the text operators: (spark, directory) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.llm.common import reach_workers
from marketloom.llm.conversations import conversation_trie, with_heads
from marketloom.llm.decontaminate import decontaminate
from marketloom.llm.html import main_text
from marketloom.llm.jaccard import jaccard_classes
from marketloom.llm.langid import identify
from marketloom.llm.packing import pack_documents
from marketloom.llm.quality import judge
from marketloom.llm.search import rank_documents
from marketloom.llm.sharding import shard_by_bytes
from marketloom.llm.sql import SQL  # noqa: F401
from marketloom.llm.substrings import remove_repeats
from marketloom.llm.token_counts import section_tokens
from marketloom.llm.urls import Rule, judge_urls
from marketloom.llm.warc import archive_and_read

SHARDS = 24
URL_RULES = [
    Rule("org/", True), Rule("example.org/es/", False), Rule("example.org/en/1", False),
    Rule("com/fr/", True), Rule("com/de/", False),
]


def table(spark, sf_dir: str, name: str):
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark, sf_dir):
    kept = remove_repeats(table(spark, sf_dir, "documents"), window=35, with_text=False)
    return kept.drop("spans", "text")


def op2_jaccard_join(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents"), k=5, percent=80)


def op3_token_counts(spark, sf_dir):
    return section_tokens(table(spark, sf_dir, "documents"), rule="start")


def op4_url_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op9_quality(spark, sf_dir):
    failed = (F.col("n_words") < 50) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words")
    )
    judged = judge(table(spark, sf_dir, "documents"), fitted=~failed)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "posterior",
    )


def op5_warc(spark, sf_dir):
    return archive_and_read(table(spark, sf_dir, "pages"))


def op8_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


def op6_decontamination(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate(docs, items, window=10).drop("spans")


def op7_sharding(spark, sf_dir):
    placed = shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"), with_heads)


def op12_ranked_search(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return rank_documents(docs, items, k=10)


def op13_html_extraction(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_token_counts": op3_token_counts,
    "op4_url_filter": op4_url_filter,
    "op5_warc": op5_warc,
    "op8_language_id": op8_language_id,
    "op9_quality": op9_quality,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op10_packing": op10_packing,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_ranked_search": op12_ranked_search,
    "op13_html_extraction": op13_html_extraction,
}
