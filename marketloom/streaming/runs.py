"""Registered runs of the incremental tables and of the sources and sinks.

The given tables are cut into arrivals (early, corrected, late), written to a
landing folder and streamed in; what comes out must equal a full refresh."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.sources import files, landing
from marketloom.sources.schemas import SOURCES
from marketloom.sources.tables import save_table, save_view, shared_dir
from marketloom.streaming.incremental import (
    KEYS,
    IncrementalModels,
    monthly_orders,
    order_stream,
    run_available,
    run_changes,
)
from marketloom.streaming.keyed_table import KeyedTable, newer_than

BUCKETS = 8
_done: dict[tuple[str, str], IncrementalModels] = {}
_exported: dict[tuple[str, str], str] = {}


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def arrivals(m) -> list[dict[str, DataFrame]]:
    """Three arrivals that together deliver every order, payment and review.

    1. orders before 2000, the youngest of them in an unfinished state, with the
       payments and reviews of most orders;
    2. the young ones in their final state, the orders since 2000 in two versions each,
       and the canceled orders;
    3. the other payments and reviews, without their orders."""
    orders, payments, reviews = m["orders"], m["order_payments"], m["order_reviews"]
    ts = F.col("order_purchase_timestamp")
    canceled = F.col("order_status") == "canceled"
    old = ts < F.lit("2000-01-01").cast("timestamp_ntz")
    young = old & (ts >= F.lit("1999-10-01").cast("timestamp_ntz"))
    nothing = F.lit(None).cast("timestamp_ntz")
    draft = {
        "order_status": F.lit("created"), "order_delivered_carrier_date": nothing,
        "order_delivered_customer_date": nothing,
    }
    early = orders.filter(old & ~canceled)
    late = F.pmod(F.xxhash64("order_id"), F.lit(5)) == 0
    return [
        {
            "orders": early.filter(~young).union(early.filter(young).withColumns(draft)),
            "order_payments": payments.filter(~late), "order_reviews": reviews.filter(~late),
        },
        {"orders": orders.filter(young | ~old | canceled).union(orders.filter(~old).withColumns(draft))},
        {"order_payments": payments.filter(late), "order_reviews": reviews.filter(late)},
    ]


def incremental(spark: SparkSession, m, sf_dir: str) -> IncrementalModels:
    """Run the arrivals through one stream per source, once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _done:
        root = _folder(spark, "incremental")
        models = IncrementalModels(spark, f"{root}/tables", m, m.as_of, BUCKETS)
        for arrival in arrivals(m):
            for source, rows in arrival.items():
                # versions of one order come in one file: they arrive together
                save_table(rows.repartition("order_id"), f"{root}/landing/{source}", "append")
            run_changes(models, f"{root}/landing", f"{root}/progress")
        _done[key] = models
    return _done[key]


def _incremental_table(name: str):
    return lambda spark, m, sf_dir: incremental(spark, m, sf_dir)[name]


def inc_schema_sync(spark, m, sf_dir) -> DataFrame:
    """A batch with one more and one fewer column re-shapes the table."""
    table = KeyedTable(spark, _folder(spark, "schema-sync"), "customer_id", BUCKETS)
    c = m["stg_customers"]
    table.upsert(c.select("customer_id", "city", "state"))
    table.upsert(
        c.filter("state = 'SP'").select("customer_id", "city", "city_normalized")
    )
    return table.read()


def sink_incremental(spark, m, sf_dir) -> DataFrame:
    """Rows newer than the table's high watermark are upserted."""
    orders = m["stg_orders"].select("order_id", "order_status", "purchased_at")
    table = KeyedTable(spark, _folder(spark, "sink-incremental"), "order_id", BUCKETS)
    table.upsert(orders.filter("purchased_at < timestamp_ntz'2001-01-01 00:00:00'"))
    table.upsert(newer_than(orders, table.read(), "purchased_at"))
    return table.read()


def stream_monthly_orders(spark, m, sf_dir) -> DataFrame:
    """Running monthly counts, emitted in update mode and upserted by month."""
    root = _folder(spark, "monthly")
    table = KeyedTable(spark, f"{root}/table", "month", 1)
    orders = m["orders"]
    split = F.col("order_purchase_timestamp") < F.lit("1999-06-15").cast("timestamp_ntz")
    for part in (orders.filter(split), orders.filter(~split)):
        save_table(part, f"{root}/landing", "append")
        run_available(
            monthly_orders(order_stream(spark, f"{root}/landing")),
            lambda df, _: table.upsert(df),
            f"{root}/progress",
            "update",
        )
    return table.read()


# ------------------------------------------------------- sources and sinks


def _csv_folder(spark, m, sf_dir) -> str:
    """The nine source tables as header CSV files, names in odd spelling."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _exported:
        root = _folder(spark, "csv")
        for name, source in SOURCES.items():
            df = landing.as_text(m[name])
            shown = [c.upper().replace("_", " ") for c in df.columns]
            df.toDF(*shown).write.option("header", True).option("escape", '"').option(
                "ignoreLeadingWhiteSpace", False
            ).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/{source.file}")
        _exported[key] = root
    return _exported[key]


def src_csv(spark, m, sf_dir) -> DataFrame:
    """Orders through the CSV loader."""
    path = f"{_csv_folder(spark, m, sf_dir)}/{SOURCES['orders'].file}"
    return files.load_csv_to_table(spark, path, "orders", _folder(spark, "load"))


def src_registry(spark, m, sf_dir) -> DataFrame:
    """All declared files loaded; rows per table."""
    out_dir = _folder(spark, "load-all")
    outcome = files.load_all(spark, _csv_folder(spark, m, sf_dir), out_dir)
    parts = [
        spark.read.parquet(f"{out_dir}/{t}")
        .agg(F.count("*").alias("rows"))
        .select(F.lit(t).alias("table"), F.lit(state).alias("status"), "rows")
        for t, state in outcome.items()
        if state == "loaded"
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def chunked_append(spark, m, sf_dir) -> DataFrame:
    """Reviews loaded in two parts: replace first, then append."""
    root, name = _folder(spark, "chunks"), "order_reviews"
    cut = F.col("review_score") >= 3
    text = landing.as_text(m[name])
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}
    for i, part in enumerate((text.filter(cut), text.filter(~cut))):
        part.write.options(**options).csv(f"{root}/part{i}")
    files.load_csv_to_table(spark, f"{root}/part0", name, f"{root}/out", "replace")
    files.load_csv_to_table(spark, f"{root}/part1", name, f"{root}/out", "append")
    return spark.read.schema(SOURCES[name].schema).parquet(f"{root}/out/{name}")


def land_raw_text(spark, m, sf_dir) -> DataFrame:
    """Landing copy of the six tables; status and rows of each."""
    return landing.land_raw_text(spark, m.__getitem__, _folder(spark, "raw"))


def land_status(spark, m, sf_dir) -> DataFrame:
    """Overall status when one declared table is missing at the source."""
    tables = [*landing.LANDED, "reviews"]
    return landing.land_status(
        landing.land_raw_text(spark, m.__getitem__, _folder(spark, "raw"), tables)
    )


def seed_translation(spark, m, sf_dir) -> DataFrame:
    """The category translation file."""
    source = SOURCES["product_categories"]
    return files.read_csv(spark, f"{_csv_folder(spark, m, sf_dir)}/{source.file}", source)


def sink_view(spark, m, sf_dir) -> DataFrame:
    return save_view(m["stg_customers"], f"stg_customers_{uuid.uuid4().hex[:8]}")


def sink_table(spark, m, sf_dir) -> DataFrame:
    return save_table(m["stg_sellers"], f"{_folder(spark, 'tables')}/stg_sellers")


RUNS = {
    **{
        f"inc_{name.removeprefix('int_')}": _incremental_table(name)
        for name in KEYS if name.startswith("int_")
    },
    "inc_mart_orders": _incremental_table("mart_orders"),
    "inc_mart_customers": _incremental_table("mart_customers"),
    "inc_mart_sellers": _incremental_table("mart_sellers"),
    "inc_mart_products": _incremental_table("mart_products"),
    "inc_mart_categories": _incremental_table("mart_product_categories"),
    **{
        f.__name__: f
        for f in [
            inc_schema_sync, sink_incremental, stream_monthly_orders, src_csv,
            src_registry, chunked_append, land_raw_text, land_status, seed_translation,
            sink_view, sink_table,
        ]
    },
}
