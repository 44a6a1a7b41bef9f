"""The SQL of the text queries against the queries, on the awkward corpus."""

from collections import Counter

import corpus
import pytest

from marketloom.llm.queries import QUERIES
from marketloom.llm.sql import SQL


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("awkward"))
    data = corpus.rows()
    texts = [r[1] for r in data]
    items = [(i, " ".join(t.split()[2:40])) for i, t in enumerate(texts) if t and i % 3 == 0]
    items += [(100, None), (101, ""), (102, "two words"), (103, "..."), (0, texts[9])]
    pages = [(i, f"http://a.org/{i}", t) for i, t in enumerate(texts)]
    turns = [(i // 3 + 98, i % 3 or None, "user", t) for i, t in enumerate(texts[:60])]
    frames = {
        "documents": corpus.frame(spark, data),
        "benchmark": spark.createDataFrame(items, "item_id long, text string"),
        "pages": spark.createDataFrame(pages, "page_id long, url string, html string"),
        "conversations": spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    duck = pytest.importorskip("duckdb").connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        duck.execute(f"create view {table} as select * from read_parquet('{tables}/{table}.parquet/*.parquet')")
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    got = QUERIES[name](spark, tables)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(found.fetchall())
