"""Corpus pipeline: from the documents table to packed token sequences.

Each stage is a function of (spark, docs, directory) and works on all that its
predecessor kept; results between stages are written as Parquet in the shared
folder and read again.  All stages but the last return the columns of
documents.  Nulls, empty texts, repeated rows and extra columns are treated as the
stage's operator states."""

from __future__ import annotations

from marketloom.llm.common import reach_workers
from marketloom.llm.decontaminate import keep_clean
from marketloom.llm.jaccard import keep_one
from marketloom.llm.langid import keep_known
from marketloom.llm.packing import pack_documents
from marketloom.llm.substrings import drop_repeats
from marketloom.sources.tables import write_scratch


def known_language(spark, docs, sf_dir):
    """Documents without letters or with an ambiguous language go."""
    reach_workers(spark)
    return keep_known(docs)


def one_of_each_group(spark, docs, sf_dir):
    """Of near duplicates (five words, similarity 0.8) one stays."""
    reach_workers(spark)
    return keep_one(docs, k=5, percent=80)


def without_repeats(spark, docs, sf_dir):
    """Passages of 35 words or more that repeat are cut out of every text."""
    reach_workers(spark)
    return drop_repeats(docs, window=35)


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold ten words in a row of a benchmark item go."""
    reach_workers(spark)
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def packed(spark, docs, sf_dir):
    """Pieces of token sequences of 4096."""
    reach_workers(spark)
    return pack_documents(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("substrings", without_repeats),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: The tokenizer, the classifiers and the component search have no SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents table; the rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
