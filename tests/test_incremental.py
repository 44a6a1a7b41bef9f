import threading

import pytest
from pyspark.sql import functions as F

from marketloom.plans.warehouse import Warehouse
from marketloom.sources.files import conform
from marketloom.sources.folder import Folder
from marketloom.sources.schemas import SOURCES
from marketloom.sources.tables import write_scratch
from marketloom.streaming import incremental, versioned
from marketloom.streaming.incremental import KEYS, IncrementalModels, Run, last_versions, run_changes
from marketloom.streaming.keyed_table import KeyedTable, newer_than
from marketloom.streaming.versioned import Conflict
from shop import ROWS, order, shop


def rows(df):
    return sorted(str(r) for r in df.select(sorted(df.columns)).collect())


def typed(df):
    return conform(df, SOURCES["orders"])


def test_keyed_table_upsert_replay_null_key_and_schema(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), "k", 4)
    assert not t.exists()
    t.upsert(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int"))
    batch = spark.createDataFrame([("b", 20), (None, 30), ("c", 4)], "k string, v int")
    t.upsert(batch)
    t.upsert(batch)  # replayed
    want = [("a", 1), ("b", 20), ("c", 4), (None, 30)]
    assert sorted(map(tuple, t.read().collect()), key=str) == sorted(want, key=str)
    t.upsert(spark.createDataFrame([("a", "x")], "k string, w string"))
    again = KeyedTable(spark, str(tmp_path / "t"), "k", 4)
    assert again.read().columns == ["k", "w"] and again.read().count() == 4
    t.upsert(spark.createDataFrame([], "k string, w string"))
    assert t.read().count() == 4


def test_watermark_and_lookback(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 6)], "d int").select(
        F.expr("cast(date_add(date'2017-01-01', d) as timestamp_ntz)").alias("t"))
    seen = df.filter("t <= timestamp_ntz'2017-01-04 00:00:00'")
    assert newer_than(df, seen, "t").count() == 2
    assert newer_than(df, seen, "t", "2 days").count() == 4
    assert newer_than(df, seen.limit(0), "t").count() == 5  # empty table: all


def landed(spark, folder, **tables):
    """Files of some sources arrive."""
    data = shop(spark, **tables)
    for name in tables:
        conform(data[name], SOURCES[name]).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def assert_full_refresh(spark, inc, data):
    full = Warehouse(spark, data, "2018-01-01", tables=())
    for name in KEYS:
        assert rows(inc[name]) == rows(full[name]), name


def test_changes_of_every_source_arrive_by_themselves(spark, tmp_path):
    """Early, changed and late orders; then reviews, payments, a customer, coordinates
    and a translation alone: each time a full refresh, without a manual call."""
    final = ROWS["orders"] + [
        order("o5", "c3", "delivered", "2017-12-01 00:00:00", "2017-12-03 00:00:00", "2017-12-09 00:00:00")]
    items = ROWS["order_items"] + [("o5", 1, "p3", "s2", None, "70.00", "7.00")]
    late_pay = [r for r in ROWS["order_payments"] if r[0] == "o1"]
    late_review = [r for r in ROWS["order_reviews"] if r[1] == "o1"]
    folder, progress = str(tmp_path / "landing"), str(tmp_path / "progress")
    inc = IncrementalModels(spark, str(tmp_path / "inc"), shop(spark), "2018-01-01", buckets=2)

    made = order("o2", "c3", "created", "2017-02-01 10:00:00", None, "2017-02-10 00:00:00")
    landed(spark, folder, **{**ROWS, "orders": [made, ROWS["orders"][0], ROWS["orders"][3]],
           "order_items": items, "order_payments": [r for r in ROWS["order_payments"] if r not in late_pay],
           "order_reviews": [r for r in ROWS["order_reviews"] if r not in late_review]})
    assert run_changes(inc, folder, progress)
    # o2 changes hands and state; two orders are new; two versions of one in one arrival
    landed(spark, folder, orders=[order("o5", "c3", "created", "2017-12-01 00:00:00"), final[4], final[1], final[2]])
    assert run_changes(inc, folder, progress)
    months = {t: set(inc.tables["int_orders_with_items"].version().parts) for t in "a"}["a"]
    assert months == {"2017-01", "2017-02", "2017-03", "2017-11", "2017-12"}
    before = inc.tables["int_orders_with_items"].version().parts
    # nothing of the orders themselves
    customers = [("c2", "u2", "20000", "embu-guacu", "sp")]
    places = [("99999", -1.0, -2.0, "nowhere", "XX")]
    words = [("cama", "bedding")]
    landed(spark, folder, order_payments=late_pay, order_reviews=late_review, customers=customers,
           geolocation=places, product_categories=words)
    assert run_changes(inc, folder, progress)
    after = inc.tables["int_orders_with_items"].version().parts
    assert {m for m in after if after[m] != before.get(m)} == {"2017-01"}  # one month rewritten
    data = shop(
        spark, orders=final, order_items=items, geolocation=ROWS["geolocation"] + places, product_categories=words,
        customers=[r for r in ROWS["customers"] if r[0] != "c2"] + customers)
    assert_full_refresh(spark, inc, data)
    assert not run_changes(inc, folder, progress)


def test_killed_runs_are_finished(spark, tmp_path, monkeypatch):
    """An order changes hands while its payments come late in a source without a log;
    whichever table fails, running again ends right."""
    late = [r for r in ROWS["order_payments"] if r[0] != "o2"]
    moved = next(o for o in ROWS["orders"] if o[0] == "o2")
    moved = ("o2", "c3", *moved[2:])
    inc = IncrementalModels(spark, str(tmp_path / "inc"), shop(spark, order_payments=late), "2018-01-01", buckets=2)
    inc.process(typed(shop(spark)["orders"]), 0)
    inc.sources = shop(spark)
    usual = Run.put
    batch = typed(shop(spark, orders=[moved])["orders"])
    for fail in ("order_sellers", "products_months", "int_product_performance"):
        def broken(self, table, *args, fail=fail):
            done = usual(self, table, *args)
            if table.path.endswith(fail):
                raise RuntimeError(fail)
            return done

        monkeypatch.setattr(Run, "put", broken)
        with pytest.raises(RuntimeError, match=fail):
            inc.process(batch, 1)
    monkeypatch.setattr(Run, "put", usual)
    with pytest.raises(Conflict):  # another batch under the same name
        inc.capture("orders", typed(shop(spark)["orders"]), "orders", 1)
    inc.process(batch, 1)
    orders = [o for o in ROWS["orders"] if o[0] != "o2"] + [moved]
    assert_full_refresh(spark, inc, shop(spark, orders=orders))
    assert not inc.propagate()


def test_last_arrival_wins(spark, tmp_path):
    """Whatever the order in which versions are captured."""
    day = lambda df, n: df.withColumn("_arrived", F.lit(f"2020-01-0{n}").cast("timestamp"))
    version = lambda state: typed(shop(spark, orders=[
        order("o2", "c1", state, "2017-02-01 10:00:00", None, "2017-02-10 00:00:00")])["orders"])
    batches = [day(version("shipped"), 1), day(version("canceled"), 3), day(version("approved"), 2)]
    for n, turn in enumerate(([0, 1, 2], [2, 1, 0], [1, 0, 2])):
        inc = IncrementalModels(spark, str(tmp_path / str(n)), shop(spark), "2018-01-01", buckets=2)
        for i, at in enumerate(turn):
            inc.capture("orders", batches[at], "q", i)
        log = inc.logs["orders"]
        assert [r["order_status"] for r in last_versions(log.read(), "orders").collect()] == ["canceled"]
        inc.capture("orders", version("created"))  # it does not say when: the latest
        assert [r["order_status"] for r in last_versions(log.read(), "orders").collect()] == ["created"]
    together = version("created").union(version("delivered")).union(version("approved"))
    inc = IncrementalModels(spark, str(tmp_path / "one"), shop(spark), "2018-01-01", buckets=2)
    inc.capture("orders", together)
    assert [r["order_status"] for r in last_versions(inc.logs["orders"].read(), "orders").collect()] == ["delivered"]


def test_batch_names(spark, tmp_path):
    inc = IncrementalModels(spark, str(tmp_path / "inc"), shop(spark), "2018-01-01", buckets=2)
    orders = typed(shop(spark)["orders"])
    first, second = orders.filter("order_id <> 'o2'"), orders.filter("order_id = 'o2'")
    inc.capture("orders", first, "q", 0)
    inc.capture("orders", first, "q", 0)  # again
    with pytest.raises(Conflict):
        inc.capture("orders", second, "q", 0)
    inc.capture("orders", second, "another", 0)
    assert inc.logs["orders"].read().count() == 4


def test_versions(spark, tmp_path, monkeypatch):
    """A killed change leaves the old version; readers keep theirs; writers collide."""
    make = lambda: KeyedTable(spark, str(tmp_path / "t"), "k", month_of="t")
    frame = lambda *rows: spark.createDataFrame(rows, "k string, t string, v int").withColumn(
        "t", F.col("t").cast("timestamp_ntz"))
    table = make()
    table.upsert(frame(("a", "2017-01-05", 1), ("b", "2017-02-05", 2), ("c", None, 3)))
    pinned, first = table.read(), table.version()
    create = Folder.create
    monkeypatch.setattr(Folder, "create", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        table.upsert(frame(("a", "2017-01-06", 10)))
    monkeypatch.setattr(Folder, "create", create)
    assert make().version() == first and rows(make().read()) == rows(pinned)
    cut = lambda self, name, text: create(self, name, text[:20])
    monkeypatch.setattr(Folder, "create", cut)
    table.upsert(frame(("a", "2017-01-06", 10)))
    monkeypatch.setattr(Folder, "create", create)
    assert make().version() == first
    # one day of one month: one folder is new; a key may move to another month
    table.upsert(frame(("a", "2017-01-07", 11)), at=first)
    now = table.version()
    assert {p for p in now.parts if now.parts[p] != first.parts[p]} == {"2017-01"}
    with pytest.raises(Conflict):
        table.upsert(frame(("a", "2017-01-08", 12)), at=first)
    table.upsert(frame(("a", "2017-03-01", 13)))
    assert set(table.version().parts) == {"2017-02", "2017-03", "none"}
    assert sorted(r["v"] for r in table.read().collect()) == [2, 3, 13]
    assert sorted(r["v"] for r in pinned.collect()) == [1, 2, 3]
    table.replace(frame(), frame(("b", None, 0), ("c", None, 0)))
    assert [r["v"] for r in table.read().collect()] == [13]
    table.vacuum(1)
    assert [r["v"] for r in table.read().collect()] == [13]
    assert len(Folder(spark, f"{table.path}/data").names()) == 1
    assert len([n for n in Folder(spark, f"{table.path}/versions").names() if n.endswith("json")]) == 1
    # other columns: the whole table, again as a version
    old = table.version()
    table.upsert(spark.createDataFrame([("d", "2017-05-01", "x")], "k string, t string, w string").withColumn(
        "t", F.col("t").cast("timestamp_ntz")))
    assert table.read().columns == ["k", "t", "w"] and table.read().count() == 2
    assert table.read(old).columns == ["k", "t", "v"] and table.read(old).count() == 1


def test_compacted_arrivals(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "COMPACT", 1)
    monkeypatch.setattr(Run, "all", lambda self: None)
    inc = IncrementalModels(spark, str(tmp_path / "inc"), shop(spark), "2018-01-01", buckets=2)
    orders = typed(shop(spark)["orders"])
    inc.capture("orders", orders)
    inc.capture("orders", orders.withColumn("order_status", F.lit("canceled")))
    assert inc.propagate() and not inc.propagate()
    log = inc.logs["orders"]
    assert len(log.version().parts) == 1 and log.read().count() == 4
    assert {r[0] for r in last_versions(log.read(), "orders").select("order_status").collect()} == {"canceled"}
    inc.capture("orders", orders.limit(1))
    assert inc._open_run()["new"]["orders"] == [p for p in log.version().parts if not p.startswith("base")]


def test_first_version_is_written_once_with_the_schema_of_files(spark, tmp_path, monkeypatch):
    """No copy of the rows beside the table, and the next run finds the same types."""
    copies = []
    usual = Run.keep
    monkeypatch.setattr(Run, "keep", lambda self, df, label: copies.append(label) or usual(self, df, label))
    resync = []
    monkeypatch.setattr(
        versioned, "write_scratch", lambda df, label, *args: resync.append(label) or write_scratch(df, label, *args))
    inc = IncrementalModels(spark, str(tmp_path / "inc"), shop(spark), "2018-01-01", buckets=2)
    inc.process(typed(shop(spark)["orders"]), 0)
    assert "rows" not in copies
    before = {n: t.version().schema for n, t in inc._versioned().items()}
    inc.process(typed(shop(spark, orders=[ROWS["orders"][1]])["orders"]), 1)
    assert not resync
    assert before == {n: t.version().schema for n, t in inc._versioned().items()}
    assert_full_refresh(spark, inc, shop(spark))


def test_customers_do_not_wait_for_sellers_and_products(spark, tmp_path, monkeypatch):
    begun, facts, customers, waited = threading.Event(), Run.facts, Run.customers, []

    def late(self, *args):
        waited.append(begun.wait(60))
        return facts(self, *args)

    def first(self, *args):
        begun.set()
        return customers(self, *args)

    monkeypatch.setattr(Run, "facts", late)
    monkeypatch.setattr(Run, "customers", first)
    data = shop(spark)
    inc = IncrementalModels(spark, str(tmp_path / "inc"), data, "2018-01-01", buckets=2)
    inc.process(typed(data["orders"]))
    assert waited == [True, True]
    assert_full_refresh(spark, inc, data)


def test_later_runs_write_changed_rows_once(spark, tmp_path, monkeypatch):
    """No copy of the rows beside the table in any run; a part may lie in two folders."""
    copies = []
    usual = Run.keep
    monkeypatch.setattr(Run, "keep", lambda self, df, label: copies.append(label) or usual(self, df, label))
    inc = IncrementalModels(spark, str(tmp_path / "inc"), shop(spark), "2018-01-01", buckets=1)
    inc.process(typed(shop(spark)["orders"]), 0)
    inc.process(typed(shop(spark, orders=[ROWS["orders"][1]])["orders"]), 1)
    assert "rows" not in copies
    assert max(w.count(",") for w in inc.tables["int_customer_orders"].version().parts.values()) == 1
    assert_full_refresh(spark, inc, shop(spark))
    for table in inc._versioned().values():
        table.vacuum(1)
    assert_full_refresh(spark, inc, shop(spark))


def test_extremes_are_looked_up_only_where_one_may_be_lost(spark, tmp_path, monkeypatch):
    """An order comes again in another state; then one moves within its month, past
    the first of its seller."""
    looked = []
    usual = versioned.VersionedTable.read
    monkeypatch.setattr(
        versioned.VersionedTable, "read",
        lambda self, at=None, parts=None: looked.append((self.path, parts)) or usual(self, at, parts))
    facts = lambda: [parts for path, parts in looked if parts and "/order_" in path]
    inc = IncrementalModels(spark, str(tmp_path / "inc"), shop(spark), "2018-01-01", buckets=2)
    inc.process(typed(shop(spark)["orders"]))
    again = order("o1", "c1", "shipped", "2017-01-01 10:00:00", None, "2017-01-06 22:00:00")
    inc.process(typed(shop(spark, orders=[again])["orders"]))
    assert not facts()
    later = order("o1", "c1", "shipped", "2017-01-09 10:00:00", None, "2017-01-16 22:00:00")
    inc.process(typed(shop(spark, orders=[later])["orders"]))
    assert {p for parts in facts() for p in parts} == {"2017-01"}
    assert_full_refresh(spark, inc, shop(spark, orders=[later, *ROWS["orders"][1:]]))


def test_cells_are_read_and_written_once_and_orders_joined_once(spark, tmp_path, monkeypatch):
    """An order without a date and items of an order that does not exist count as in a full refresh."""
    copies, kept, scopes = [], [], []
    keep, stay, models = Run.keep, versioned.VersionedTable._kept, Run.models
    monkeypatch.setattr(Run, "keep", lambda self, df, label: copies.append(label) or keep(self, df, label))
    monkeypatch.setattr(
        versioned.VersionedTable, "_kept", lambda self, *args: kept.append(self.path) or stay(self, *args))
    monkeypatch.setattr(Run, "models", lambda self, **given: scopes.append(set(given)) or models(self, **given))
    undated = ("o6", "c3", "created", *[None] * 5)
    data = shop(
        spark, orders=[*ROWS["orders"], undated],
        order_items=[*ROWS["order_items"], ("o6", 1, "p3", "s2", None, "5.00", "1.00"), ("o9", 1, "p2", "s2", None, "9.00", "1.00")])
    inc = IncrementalModels(spark, str(tmp_path / "inc"), data, "2018-01-01", buckets=1)
    inc.process(typed(data["orders"]), 0)
    assert not [c for c in copies if c.endswith("-change")]
    inc.process(typed(shop(spark, orders=[ROWS["orders"][1], undated])["orders"]), 1)
    assert not [path for path in kept if path.endswith("_months")]
    assert not [s for s in scopes if {"stg_sellers", "int_orders_with_items"} <= s or {"mart_products", "int_order_products"} <= s]
    assert spark.conf.get(incremental.HASHED[0]) == "0b"
    assert_full_refresh(spark, inc, data)
