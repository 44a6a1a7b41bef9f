"""Every registered text query on a small directory: columns, types, one row where one is
due; and none without SQL or a test of its own."""

import random

import corpus
import corpus_pipeline
import pytest

import __spark_entry__ as contract
from marketloom.llm.queries import QUERIES
from marketloom.llm.sql import SQL

COLUMNS = {
    "op1": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op2": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op4": "page_id bigint, host string, path string, rule string, verdict string",
    "op5": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op6": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op7": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op8": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
           " n_repeat_words bigint, base_failed boolean, kept boolean",
    "op10": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint,"
            " offset bigint",
    "op11": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint,"
            " saved_tokens bigint, ends_sha256 string",
    "op12": "item_id bigint, rank int, doc_id bigint, score bigint",
    "op13": "page_id bigint, url string, text string, n_chars bigint",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(1)
    text = corpus.prose(rng, 60)
    docs = [(1, text, "en", "s", 0), (2, text + " more", "en", "s", 0), (3, None, None, None, None), (4, "", "fr", "s", 0),
            (5, corpus.prose(rng, 80), "fr", "s", 0)]
    frames = {
        "documents": spark.createDataFrame(docs, corpus.SCHEMA),
        "benchmark": spark.createDataFrame([(1, text[:200]), (2, None)], "item_id long, text string"),
        "pages": spark.createDataFrame(
            [(1, "https://a.org/fr/1", "<p>x</p>"), (2, "http://b.com/de/", "<p>x</p>"), (3, None, None)],
            "page_id long, url string, html string"),
        "conversations": spark.createDataFrame(
            [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, None, None)],
            "conv_id long, turn long, role string, text string"),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{root}/{name}.parquet")
    return root


def test_sql_is_registered():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "substrings", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, tables, name):
    got = QUERIES[name](spark, tables)
    want = COLUMNS.get(name.split("_")[0])
    if want:
        want = [c.strip() for c in want.split(",")]
        assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema][: len(want)] == want
    rows = got.collect()
    if name.split("_")[0] in ("op1", "op2", "op6", "op7", "op8", "op9"):
        assert sorted(r["doc_id"] for r in rows) == [1, 2, 3, 4, 5]
    if name.split("_")[0] in ("op4", "op5", "op13"):
        assert sorted(r["page_id"] for r in rows) == [1, 2, 3]
