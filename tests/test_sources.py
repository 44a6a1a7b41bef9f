import random

import pytest

from marketloom.sources.files import conform, load_all, load_csv_to_table, read_csv
from marketloom.sources.landing import land_raw_text, land_status
from marketloom.sources.schemas import SOURCES
from shop import shop


def test_csv_with_bom_odd_header_and_zip(spark, tmp_path):
    f = tmp_path / "c.csv"
    f.write_bytes(
        "﻿Customer ID,customer_unique_id,Customer Zip Code Prefix,customer_city,customer_state\n"
        "a,u,01001,são paulo,SP\n".encode())
    row = read_csv(spark, str(f), SOURCES["customers"]).first()
    assert (row["customer_id"], row["customer_zip_code_prefix"]) == ("a", "01001")


def test_csv_free_text_keeps_line_breaks(spark, tmp_path):
    f = tmp_path / "r.csv"
    cols = [x.name for x in SOURCES["order_reviews"].schema.fields]
    f.write_text(",".join(cols) + '\nr,o,5,,"said ""good""\nagain",2017-01-01 00:00:00,2017-01-02\n')
    row = read_csv(spark, str(f), SOURCES["order_reviews"]).first()
    assert row["review_comment_message"] == 'said "good"\nagain' and row["review_comment_title"] is None


def test_replace_append_and_missing_file(spark, tmp_path):
    f = tmp_path / SOURCES["product_categories"].file
    f.write_text("product_category_name,product_category_name_english\ncama,bed\n")
    out = str(tmp_path / "out")
    for mode, rows in (("replace", 1), ("append", 2), ("replace", 1)):
        assert load_csv_to_table(spark, str(f), "product_categories", out, mode).count() == rows
    with pytest.raises(ValueError):
        load_csv_to_table(spark, str(f), "product_categories", out, "merge")
    outcome = load_all(spark, str(tmp_path), str(tmp_path / "all"))
    assert outcome.pop("product_categories") == "loaded" and set(outcome.values()) == {"skipped"}


def test_landing_goes_on_after_a_failure(spark, tmp_path):
    data = shop(spark)
    data["sellers"] = data["sellers"].limit(0)
    del data["products"]
    summary = land_raw_text(spark, data.__getitem__, str(tmp_path))
    got = {r["table"]: (r["status"], r["rows"]) for r in summary.collect()}
    assert got["orders"] == ("ok", 4) and got["products"] == ("failed", 0)
    assert got["sellers"] == ("skipped", 0)
    status = land_status(summary).first()
    assert (status["status"], status["tables_failed"]) == ("partial_failure", 1)
    landed = spark.read.parquet(f"{tmp_path}/olist_order_items")
    assert {t for _, t in landed.dtypes} == {"string"}


REVIEW = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
          "review_creation_date", "review_answer_timestamp"]


def write_reviews(path, rng, rows, end="\n"):
    """Quoted, bare, empty and many-line comments, with blank lines between records."""
    bits = ["a", "bc", "\n", "\r\n", '"', '""', ",", "", " ", "\n\n", "é", '",\n"', "x" * 150]
    quote = lambda v: '"' + v.replace('"', '""') + '"'
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(",".join(REVIEW) + end)
        for i in range(rows):
            words = ["".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(2)]
            words = [quote(w) if set(w) & set('\r\n",') or rng.random() < 0.5 else w for w in words]
            cells = [f"r{i}", quote(f"o{i}") if i % 2 else f"o{i}", str(i % 5 + 1), *words, "2018-01-01 00:00:00", ""]
            f.write(",".join(cells) + end + (end if i % 7 == 0 else ""))


@pytest.mark.parametrize("block", [40, 300, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_records_equal_one_task_reader(spark, tmp_path, block, end):
    folder = tmp_path / "reviews"
    folder.mkdir()
    rng = random.Random(block)
    for i, rows in enumerate((25, 1, 0)):
        write_reviews(folder / f"{i}.csv", rng, rows, end)
    source = SOURCES["order_reviews"]
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "lineSep": end}
    whole = conform(spark.read.options(**options).csv(str(folder)), source)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = sorted(map(repr, read_csv(spark, str(folder), source).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 26
    assert got == sorted(map(repr, whole.collect()))


def test_odd_quotes_are_an_error(spark, tmp_path):
    f = tmp_path / "r.csv"
    f.write_text(",".join(REVIEW) + '\nr1,o1,5,"open,x,,\nr2,o2,5,t,m,,\n')
    with pytest.raises(Exception, match="odd number of quotes"):
        read_csv(spark, str(f), SOURCES["order_reviews"]).collect()
