"""Incremental refresh of the model tables from arriving changes.

Every source table may have a log of arrivals (``capture``): orders, but also
items, payments and reviews that come after their order, changed customers, sellers,
products and translations, and new coordinates.  A run (``propagate``) takes what
came since the last one along the model graph:

* orders, items, payments, reviews -> orders;
* orders, by what they were and by what they are -> customers, sellers, products;
* customers, sellers (also by zip prefix), products (also by category) -> themselves;
* products -> categories.

Order-level tables lie in months of purchase, and a run rewrites the months it touches.
Source rows are read for the touched orders only.  Sums per (seller, month) and (product,
month) take back what an order was and add what it is; entity rows are
put together from these cells.  Least and greatest values cannot be taken back:
a cell that lost a row gets them from its own month.

A run is written down before it starts: the arrivals it takes and the versions of all
tables then.  It reads old state from these versions only, so a run that was
killed at any point is run again with the same result.  Of several versions of a
source row the one that arrived last counts, in whatever order they are captured."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import month_start
from marketloom.plans.intermediate import (
    PRODUCT_EXTREMES,
    SELLER_EXTREMES,
    month_span,
    order_product_facts,
    order_product_sums,
    order_seller_facts,
    product_measures,
    product_terms,
    seller_measures,
    seller_terms,
)
from marketloom.plans.marts import category_mart, delivery_terms, seller_mart
from marketloom.plans.staging import STAGING
from marketloom.plans.warehouse import Warehouse
from marketloom.sources.folder import Folder
from marketloom.sources.schemas import SOURCES
from marketloom.sources.tables import shared_dir, write_scratch
from marketloom.streaming.keyed_table import KeyedTable
from marketloom.streaming.versioned import VersionedTable, buckets, months

KEYS = {
    "int_orders_with_items": "order_id",
    "int_customer_orders": "customer_id",
    "int_product_performance": "product_id",
    "int_seller_performance": "seller_id",
    "mart_orders": "order_id",
    "mart_customers": "customer_id",
    "mart_sellers": "seller_id",
    "mart_products": "product_id",
    "mart_product_categories": "category_name",
}

SAME_AS = {"mart_orders": "int_orders_with_items", "mart_products": "int_product_performance"}

#: What identifies a row of each source; the whole row, if nothing is listed.
SOURCE_KEYS = {
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "product_categories": ["product_category_name"],
    "geolocation": [],
}
OF_ORDERS = ("orders", "order_items", "order_payments", "order_reviews")
#: Arrivals of a source that are kept apart before they are put together.
COMPACT = 50
#: Versions of every table that stay readable.
KEEP = 3


#: Bytes of every partition of a join's smaller side up to which it is hashed instead of
#: sorting both sides; not below the size that Spark puts small partitions together to.
HASHED = ("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")


@contextmanager
def hash_joins(spark: SparkSession):
    """Keys of a run are many rows but few bytes, and what is joined to them is wide: not sorted
    where the keys of a partition fit a hash table.  A setting of the session stands."""
    name, most = HASHED
    before = spark.conf.get(name)
    if before != "0b":
        yield
        return
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.unset(name)


class IncrementalModels:
    """Nine keyed tables under ``root``, kept up to date run by run.

    ``sources`` gives the source tables that have no log of arrivals."""

    def __init__(self, spark: SparkSession, root: str, sources, as_of=None, buckets: int = 64):
        self.spark, self.root, self.sources, self.as_of, self.buckets = spark, root, sources, as_of, buckets
        keyed = lambda name, key, month=None: KeyedTable(
            spark, f"{root}/{name}", key, buckets, month_of=month)
        self.orders = keyed("orders", "order_id", "order_purchase_timestamp")
        self.tables = {
            name: keyed(name, key, "purchased_at" if name == "int_orders_with_items" else None)
            for name, key in KEYS.items() if name not in SAME_AS
        }
        # pass-through marts are the same rows: no second copy is kept
        self.tables |= {name: self.tables[of] for name, of in SAME_AS.items()}
        self.facts = {
            entity: VersionedTable(
                spark, f"{root}/order_{entity}", "order_id", months("purchased_at"), fixed=False)
            for entity in ("sellers", "products")
        }
        self.cells = {
            entity: KeyedTable(spark, f"{root}/{entity}_months", [f"{entity[:-1]}_id", "month"], buckets)
            for entity in ("sellers", "products")
        }
        self.logs = {
            name: VersionedTable(spark, f"{root}/arrivals/{name}", "_batch", lambda: F.col("_batch"))
            for name in SOURCES
        }
        self._runs = Folder(spark, f"{root}/runs")

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name].read()

    # ------------------------------------------------------------- arrivals

    def capture(self, source: str, batch: DataFrame, query: str = "", batch_id: int | None = None) -> None:
        """Keep a batch of arrived rows of a source until the next run.

        ``query`` and ``batch_id`` name the batch: again with the same rows it
        changes nothing, with other rows it is refused (``Conflict``).  Rows tell
        when they arrived (``_arrived``); without it they count as the latest."""
        log = self.logs[source]
        now = log.version()
        if "_arrived" in batch.columns:
            arrived = F.col("_arrived").cast("timestamp")
        else:
            newest = log.read(now).agg(F.max("_arrived")).first()[0] if now.schema else None
            arrived = F.lit(newest).cast("timestamp")
        label = re.sub("[^0-9A-Za-z]", "-", f"{query}-{batch_id}" if batch_id is not None else uuid.uuid4().hex[:12])
        scratch = f"{shared_dir(self.spark)}/scratch/capture-{uuid.uuid4().hex[:12]}"
        rows = write_scratch(batch.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCES[source].schema],
            arrived.alias("_arrived"), F.lit(now.number + 1).alias("_seq"), F.lit(label).alias("_batch"),
        ), source, scratch)
        if batch_id is None and rows.isEmpty():
            return
        told = [x for f in SOURCES[source].schema for x in (F.col(f.name).isNull(), F.col(f.name))]
        seen = rows.agg(F.count("*"), F.bit_xor(F.xxhash64(*told))).first()
        log.replace(rows, name=label if batch_id is not None else "", made_of=f"{seen[0]}/{seen[1]}")
        Folder(self.spark, scratch).delete()

    def _latest(self, source: str, at: dict, only: DataFrame | None = None, on: str = "") -> DataFrame:
        """The rows of a source as they are now, of some keys or all."""
        version = at[source]
        if version.schema is None:
            rows = self.sources[source]
            return rows if only is None else rows.join(only, on, "left_semi")
        rows = self.logs[source].read(version)
        rows = rows if only is None else rows.join(only, on, "left_semi")
        return last_versions(rows, source)

    # ------------------------------------------------------------------ runs

    def process(self, batch: DataFrame, batch_id: int | None = None, query: str = "orders") -> None:
        """Capture a batch of orders and propagate it."""
        self.capture("orders", batch, query, batch_id)
        self.propagate()

    def refresh_orders(self, changed: DataFrame, batch_id: int | None = None) -> None:
        """Recompute known orders whose items, payments or reviews changed in a source
        without a log of arrivals.  ``changed`` has a column ``order_id``."""
        ids = changed.select("order_id").distinct()
        self.process(self.orders.read().join(ids, "order_id", "left_semi"), batch_id, "refresh")

    def _versioned(self) -> dict[str, VersionedTable]:
        unique = {n: t for n, t in self.tables.items() if n not in SAME_AS}
        return {
            "orders": self.orders, **unique, **{f"facts_{k}": t for k, t in self.facts.items()},
            **{f"cells_{k}": t for k, t in self.cells.items()},
        }

    def propagate(self) -> bool:
        """Bring all tables up to date with what has been captured; whether there was
        anything to do.  A run that was interrupted is finished first."""
        done, again = False, True
        while again:
            run = self._open_run()
            again = run is not None and run.pop("resumed")
            if run is not None:
                self._run(run)
                done = True
        return done

    def _open_run(self) -> dict | None:
        numbers = sorted({int(n.split(".")[0]) for n in self._runs.names() if n[:1].isdigit()})
        processed: dict = {}
        first = True
        for n in reversed(numbers):
            if self._runs.exists(f"{n:09d}.done"):
                processed, first = json.loads(self._runs.read(f"{n:09d}.done")), False
                break
            try:
                return json.loads(self._runs.read(f"{n:09d}.json")) | {"resumed": True}
            except json.JSONDecodeError:
                continue  # cut off while it was written: it never started
        logs = {name: log.version() for name, log in self.logs.items()}
        new = {
            name: sorted(set(v.parts) - set(processed.get(name, []))) for name, v in logs.items() if v.schema
        }
        if not any(new.values()):
            return None
        run = {
            "run": (numbers[-1] + 1) if numbers else 1, "first": first, "new": new,
            "logs": {name: v.number for name, v in logs.items()},
            "before": {name: t.version().number for name, t in self._versioned().items()},
        }
        self._runs.create(f"{run['run']:09d}.json", json.dumps(run))
        return run | {"resumed": False}

    def _close_run(self, run: dict) -> None:
        processed = {name: sorted(self.logs[name].version(n).parts) for name, n in run["logs"].items() if n}
        for name, parts in processed.items():
            log = self.logs[name]
            now = log.version()
            if len(parts) > COMPACT and set(now.parts) == set(parts):
                base = f"base-{run['run']}"
                scratch = f"{shared_dir(self.spark)}/scratch/compact-{uuid.uuid4().hex[:12]}"
                whole = last_versions(log.read(now), name, keep=True).withColumn("_batch", F.lit(base))
                batches = self.spark.createDataFrame([(p,) for p in parts], "_batch string")
                log.replace(write_scratch(whole, name, scratch), batches, at=now)
                Folder(self.spark, scratch).delete()
                processed[name] = [base]
        for table in [*self._versioned().values(), *self.logs.values()]:
            table.vacuum(KEEP)
        self._runs.create(f"{run['run']:09d}.done", json.dumps(processed))
        for n in self._runs.names():  # two runs back, nothing asks for them
            if n[:1].isdigit() and int(n.split(".")[0]) < run["run"] - 1:
                self._runs.delete(n)

    def _run(self, run: dict) -> None:
        scratch = f"{shared_dir(self.spark)}/scratch/run-{uuid.uuid4().hex[:12]}"
        try:
            with hash_joins(self.spark):
                Run(self, run, scratch).all()
        finally:
            Folder(self.spark, scratch).delete()
        self._close_run(run)


class Run:
    """One pass of changes through the tables."""

    def __init__(self, models: IncrementalModels, run: dict, scratch: str):
        self.m, self.record, self.scratch = models, run, scratch
        self.spark, self.name = models.spark, f"run-{run['run']}"
        self.logs = {n: models.logs[n].version(v) for n, v in run["logs"].items()}
        self.before = {n: t.version(run["before"][n]) for n, t in models._versioned().items()}

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        return write_scratch(df, label, self.scratch)

    def put(self, table: VersionedTable, rows: DataFrame, keys: DataFrame | None = None) -> DataFrame:
        if table.version().schema is None:  # nothing is kept: the rows are read once and are the table
            table.replace(rows, name=self.name, made_of=self.name)
            return table.read(table.version())
        written = None if keys is None else table.amend(rows, keys, self.name, self.name)
        if written is not None:
            return written
        rows = self.keep(rows, "rows")
        table.replace(rows, keys, name=self.name, made_of=self.name, scratch=self.scratch)
        return rows

    def old(self, name: str) -> DataFrame | None:
        """A table as it was before the run."""
        version = self.before[name]
        return self.m._versioned()[name].read(version) if version.schema is not None else None

    def arrived(self, source: str, *columns: str) -> DataFrame | None:
        """What is new of a source; all of it, on the first run."""
        version = self.logs[source]
        if version.schema is None:
            return self.m.sources[source].select(*columns) if self.record["first"] else None
        new = self.record["new"].get(source)
        return self.m.logs[source].read(version, set(new)).select(*columns) if new else None

    def latest(self, source: str, only: DataFrame | None = None, on: str = "") -> DataFrame:
        return self.m._latest(source, self.logs, only, on)

    def staged(self, source: str, **scope) -> DataFrame:
        return STAGING[f"stg_{source.removeprefix('order_') if source == 'orders' else source}"](
            {source: self.latest(source, **scope)})

    def models(self, **given: DataFrame) -> Warehouse:
        w = Warehouse(self.spark, self.m.sources, self.m.as_of, tables=())
        for source in SOURCES:
            w.put(source, self.latest(source))
        for name, df in given.items():
            w.put(name, df)
        return w

    def all(self) -> None:
        ids = self.keep(_union([self.arrived(s, "order_id") for s in OF_ORDERS], "order_id string", self.spark), "ids")
        fresh = self.orders(ids)
        base = self.models()
        sums = {
            "sellers": (seller_terms, SELLER_EXTREMES), "products": (product_terms, PRODUCT_EXTREMES),
        }
        # every step starts when what it reads is there: a thread for each, since steps wait in theirs
        with ThreadPoolExecutor(12) as pool:
            moved = {entity: pool.submit(self.facts, entity, ids, fresh) for entity in sums}
            cells = {
                entity: pool.submit(lambda e=entity: self.update_cells(
                    e, ids, moved[e].result(), sums[e][0](), sums[e][1])) for entity in sums
            }
            keys = {
                "customers": pool.submit(self.entities, "customers", base, ids, fresh["int_orders_with_items"]),
                **{entity: pool.submit(lambda e=entity: self.entities(e, base, ids, moved[e].result()))
                   for entity in sums},
            }

            def after(step: Callable, entity: str, *steps: Future) -> Future:
                def run() -> None:
                    for s in steps:
                        s.result()
                    step(base, keys[entity].result())
                return pool.submit(run)

            jobs = [
                after(self.customers, "customers"),
                after(self.mart_customers, "customers"),
                after(self.sellers, "sellers", cells["sellers"]),
                after(self.mart_sellers, "sellers", *moved.values()),
                after(self.products, "products", cells["products"]),
            ]
            for job in [*jobs, *cells.values()]:
                job.result()

    # ---------------------------------------------------------- order level

    def orders(self, ids: DataFrame) -> Warehouse:
        """The touched orders and all that belongs to them."""
        rows = self.latest("orders", ids, "order_id")
        rows = self.keep(rows.select(*[f.name for f in SOURCES["orders"].schema]), "orders")
        self.put(self.m.orders, rows, ids)
        fresh = self.models(
            orders=rows, **{s: self.latest(s, ids, "order_id") for s in OF_ORDERS[1:]}
        )
        # read by the orders and by the facts
        products = lambda: fresh["stg_order_items"].groupBy("order_id", "product_id").agg(
            *order_product_sums(), F.sort_array(F.collect_set("seller_id")).alias("sellers"))  # of one order
        with ThreadPoolExecutor(2) as pool:
            rollups = {
                "int_order_sellers": pool.submit(lambda: self.keep(fresh["int_order_sellers"], "order-sellers")),
                "int_order_products": pool.submit(lambda: self.keep(products(), "order-products")),
            }
        for name, rollup in rollups.items():
            fresh.put(name, rollup.result())
        wide = self.put(self.m.tables["int_orders_with_items"], fresh["int_orders_with_items"], ids)
        fresh.put("int_orders_with_items", wide)
        return fresh

    def facts(self, entity: str, ids: DataFrame, fresh: Warehouse) -> DataFrame:
        """(order, seller) or (order, product) of the touched orders."""
        rows = order_seller_facts(fresh) if entity == "sellers" else order_product_facts(fresh)
        return self.put(self.m.facts[entity], rows, ids)

    # --------------------------------------------------------- what to redo

    def entities(self, entity: str, base: Warehouse, ids: DataFrame, now: DataFrame) -> DataFrame:
        """Customers, sellers or products to redo: those of the touched orders, as they
        were and as they are (``now``), those that changed themselves, and those not seen yet."""
        was, table = {
            "customers": ("int_orders_with_items", "int_customer_orders"),
            "sellers": ("facts_sellers", "int_seller_performance"),
            "products": ("facts_products", "int_product_performance"),
        }[entity]
        key, staged = f"{entity[:-1]}_id", base[f"stg_{entity}"]
        found = [now.select(key), self.arrived(entity, key)]
        was = self.old(was)
        if was is not None:
            found.append(was.join(ids, "order_id", "left_semi").select(key))
        known = self.old(table)
        if known is None:
            found.append(staged.select(key))
        else:
            found.append(staged.select(key).join(known.select(key), key, "left_anti"))
            zips = self.arrived("geolocation", "geolocation_zip_code_prefix")
            if entity != "products" and zips is not None:
                places = STAGING["stg_geolocation"]({"geolocation": self.latest("geolocation", zips, "geolocation_zip_code_prefix")})
                found.append(staged.join(places, "zip_code_prefix", "left_semi").select(key))
            categories = self.arrived("product_categories", "product_category_name")
            if entity == "products" and categories is not None:
                changed = categories.select(F.col("product_category_name").alias("category_id"))
                found.append(staged.join(changed, "category_id", "left_semi").select(key))
        found = _union(found, f"{key} string", self.spark).filter(F.col(key).isNotNull())
        return self.keep(found, entity)

    # ------------------------------------------------------- months of sums

    def update_cells(self, entity: str, ids: DataFrame, added: DataFrame, terms: dict, extremes: dict) -> None:
        """Take what the touched orders were out of the sums of (entity, month), and
        add what they are."""
        table, key = self.m.cells[entity], f"{entity[:-1]}_id"
        month = month_start("purchased_at").alias("month")
        row = lambda df, sign: df.filter(F.col(key).isNotNull()).select(
            key, month, F.lit(sign).alias("_sign"), *[e.alias(n) for n, e in terms.items()],
            *[F.col(c).alias(f"_{n}") for n, (_, c) in extremes.items()],
        )
        signed = row(added, 1)
        was = self.old(f"facts_{entity}")
        cells = self.old(f"cells_{entity}")
        if was is not None:
            signed = signed.union(row(was.join(ids, "order_id", "left_semi"), -1))
        elif cells is None:  # only added: the table itself, without what tells whether a value was lost
            signed = signed.drop("_sign")
            keys = [key, "month"]
            self.put(table, signed.groupBy(*keys).agg(
                F.count("*").alias("n"),
                *[F.sum(n).cast(_sum_type(signed, n)).alias(n) for n in terms],
                *[getattr(F, how)(f"_{n}").alias(n) for n, (how, _) in extremes.items()],
            ))
            return
        plus = F.col("_sign") == 1
        # taken back, and nothing added that is as low or as high: the cell may have lost it
        gone = lambda n, how: F.coalesce(
            {"min": Column.__gt__, "max": Column.__lt__}[how](
                getattr(F, how)(F.when(plus, F.col(f"_{n}"))), getattr(F, how)(F.when(~plus, F.col(f"_{n}")))),
            F.count(F.when(~plus, F.col(f"_{n}"))) > 0)
        change = self.keep(signed.groupBy(key, "month").agg(
            F.sum("_sign").alias("n"),
            reduce(Column.__or__, [gone(n, how) for n, (how, _) in extremes.items()]).alias("_lost"),
            *[F.sum(F.col("_sign") * F.col(n)).cast(_sum_type(signed, n)).alias(n) for n in terms],
            *[getattr(F, how)(F.when(plus, F.col(f"_{n}"))).alias(n) for n, (how, _) in extremes.items()],
        ), f"{entity}-change")
        keys = [key, "month"]
        if cells is None:
            self.put(table, change.drop("_lost"), change.select(keys))
            return
        # changed cells and those beside them in one pass: all of their parts is written anew
        parts = table.parts_of(change)
        cells = table.read(self.before[f"cells_{entity}"], parts).withColumn("_old", F.lit(True))
        change = change.withColumn("_new", F.lit(True))
        same = F.col(f"c.{key}").eqNullSafe(F.col(f"o.{key}")) & F.col("c.month").eqNullSafe(F.col("o.month"))
        is_new, is_old = F.col("c._new").isNotNull(), F.col("o._old").isNotNull()
        merged = change.alias("c").join(cells.alias("o"), same, "full").select(
            *[F.when(is_new, F.col(f"c.{k}")).otherwise(F.col(f"o.{k}")).alias(k) for k in keys],
            is_new.alias("_new"), F.coalesce("c._lost", F.lit(False)).alias("_lost"),
            *[
                F.when(is_new & is_old, F.col(f"c.{n}") + F.col(f"o.{n}")).otherwise(F.coalesce(f"c.{n}", f"o.{n}"))
                .cast(change.schema[n].dataType).alias(n) for n in ("n", *terms)
            ],
            *[
                getattr(F, {"min": "least", "max": "greatest"}[how])(f"c.{n}", f"o.{n}").alias(n)
                for n, (how, _) in extremes.items()
            ],
        ).filter("n > 0")
        # months of cells that lost such a row: their least and greatest values anew
        lost = change.filter("_lost").select(*keys)
        touched = {
            r[0] for r in lost.select(
                F.coalesce(F.date_format("month", "yyyy-MM"), F.lit("none"))).distinct().collect()
        }
        if touched:
            again = self.m.facts[entity].read(parts=touched).withColumn("month", month).alias("f").join(
                lost.alias("l"), F.col(f"f.{key}").eqNullSafe(F.col(f"l.{key}"))
                & F.col("f.month").eqNullSafe(F.col("l.month")), "left_semi",
            ).groupBy(*keys).agg(*[getattr(F, how)(c).alias(f"_{n}") for n, (how, c) in extremes.items()])
            again = again.alias("a")
            same = F.col(f"m.{key}").eqNullSafe(F.col(f"a.{key}")) & F.col("m.month").eqNullSafe(F.col("a.month"))
            merged = merged.alias("m").join(again, same, "left").select(
                *[F.col(f"m.{c}") for c in (*keys, "_new", "_lost", "n", *terms)],
                *[F.when(F.col("m._lost"), F.col(f"a._{n}")).otherwise(F.col(f"m.{n}")).alias(n) for n in extremes],
            )
        if not table.rewrite(merged.drop("_new", "_lost"), parts, self.name, self.name):
            self.put(table, merged.filter("_new").drop("_new", "_lost"), change.select(*keys))

    def sums(self, entity: str, keys: DataFrame, terms: dict, extremes: dict) -> DataFrame:
        """Sums per entity from its months."""
        key = f"{entity[:-1]}_id"
        cells = self.m.cells[entity].read().join(keys, key, "left_semi")
        merged = cells.groupBy(key).agg(
            *[F.sum(n).cast(cells.schema[n].dataType).alias(n) for n in terms],
            *[getattr(F, how)(n).alias(n) for n, (how, _) in extremes.items()],
            F.count("month").alias("active_months"),
        )
        customers = self.m.facts[entity].read().select(key, "customer_id").join(keys, key, "left_semi").groupBy(
            key).agg(F.count_distinct("customer_id").alias("unique_customers"))
        return merged.join(customers, key)

    # --------------------------------------------------------- entity level

    def _customers(self, base: Warehouse, keys: DataFrame) -> Warehouse:
        return self.models(
            stg_customers=base["stg_customers"].join(keys, "customer_id", "left_semi"),
            int_orders_with_items=self.m["int_orders_with_items"].join(keys, "customer_id", "left_semi"),
        )

    def customers(self, base: Warehouse, keys: DataFrame) -> None:
        self.put(self.m.tables["int_customer_orders"], self._customers(base, keys)["int_customer_orders"], keys)

    def mart_customers(self, base: Warehouse, keys: DataFrame) -> None:
        self.put(self.m.tables["mart_customers"], self._customers(base, keys)["mart_customers"], keys)

    def sellers(self, base: Warehouse, keys: DataFrame) -> None:
        who = base["stg_sellers"].join(keys, "seller_id", "left_semi")
        sums = self.sums("sellers", keys, seller_terms(), SELLER_EXTREMES)
        self.put(
            self.m.tables["int_seller_performance"],
            seller_measures(self.models(stg_sellers=who), sums), keys,
        )

    def _known(self) -> DataFrame:
        """(order, product) of orders that exist: those with a month, and of the rest, which lie in
        one part, what the orders have.  So the orders are not joined again."""
        table = self.m.facts["products"]
        now = table.version()
        dated = table.read(now).filter(F.col("purchased_at").isNotNull())
        rest = table.undated(now).filter(F.col("purchased_at").isNull())
        return dated.union(rest.join(self.m["int_orders_with_items"].select("order_id"), "order_id", "left_semi"))

    def mart_sellers(self, base: Warehouse, keys: DataFrame) -> None:
        orders = STAGING["stg_orders"]({"orders": self.m.orders.read()})
        sold = self.m.facts["sellers"].read().filter("is_found").join(keys, "seller_id", "left_semi").join(
            orders.select("order_id", *delivery_terms()), "order_id")
        items = self._known().select(F.explode("sellers").alias("seller_id"), "product_id").join(
            keys, "seller_id", "left_semi")
        scope = self.models(stg_sellers=base["stg_sellers"].join(keys, "seller_id", "left_semi"))
        span = month_span(orders, "purchased_at")
        self.put(self.m.tables["mart_sellers"], seller_mart(scope, scope.as_of, sold, items, span), keys)

    def products(self, base: Warehouse, keys: DataFrame) -> None:
        facts = self.m.facts["products"].read()
        sellers = facts.join(keys, "product_id", "left_semi").select(
            "product_id", F.explode("sellers").alias("seller_id")
        ).distinct().groupBy("product_id").agg(F.count("seller_id").alias("unique_sellers"))
        scope = self.models(stg_products=base["stg_products"].join(keys, "product_id", "left_semi"))
        rows = self.put(self.m.tables["int_product_performance"], product_measures(
            scope, scope.as_of, self.sums("products", keys, product_terms(), PRODUCT_EXTREMES), sellers), keys)

        # also the categories that products have left
        touched = rows.select(F.col("category_name_english").alias("category_name"))
        was = self.old("int_product_performance")
        if was is not None:
            touched = touched.union(
                was.join(keys, "product_id", "left_semi").select("category_name_english"))
        touched = self.keep(touched.distinct(), "categories")
        same = F.col("category_name_english").eqNullSafe(F.col("category_name"))
        members = self.m["mart_products"].join(touched, same, "left_semi")
        ordered = self._known().select("order_id", "product_id", "customer_id")
        self.put(
            self.m.tables["mart_product_categories"],
            category_mart(self.models(mart_products=members), scope.as_of, ordered), touched)


def _union(parts: list[DataFrame | None], schema: str, spark: SparkSession) -> DataFrame:
    found = [p for p in parts if p is not None] or [spark.createDataFrame([], schema)]
    return reduce(DataFrame.union, found).distinct()


def _sum_type(df: DataFrame, name: str) -> str:
    kind = df.schema[name].dataType.simpleString()
    return kind if kind.startswith("decimal") else "bigint"


#: Order states from first to last.
PROGRESS = (
    "created", "approved", "invoiced", "processing", "shipped", "delivered",
    "unavailable", "canceled",
)


def last_versions(log: DataFrame, source: str, keep: bool = False) -> DataFrame:
    """One row per key of a source: the version that arrived last, of those the one
    captured last, of those, for orders, the one further on (an unknown date sorts
    lowest).  A mergeable ``max``, so that a row repeated a billion times is
    reduced before the shuffle.  ``keep`` keeps the columns of the log."""
    columns = [f.name for f in SOURCES[source].schema]
    key = SOURCE_KEYS[source] or columns
    first = ["_arrived", "_seq"]
    if source == "orders":
        state = F.array_position(F.array(*map(F.lit, PROGRESS)), F.col("order_status"))
        log = log.withColumn("_state", F.coalesce(state, F.lit(0)))
        first += [
            "_state", "order_delivered_customer_date", "order_delivered_carrier_date", "order_approved_at",
            "order_status",
        ]
    rest = [c for c in columns if c not in first and c not in key]
    last = log.groupBy(*key).agg(F.max(F.struct(*first, *rest)).alias("_r"))
    value = lambda c: F.col(c) if c in key else F.col(f"_r.{c}").alias(c)
    return last.select(*map(value, columns), *map(value, first[:2] if keep else []))


def order_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming reader over a folder of arriving order files."""
    return source_stream(spark, "orders", landing, files_per_batch)


def source_stream(
    spark: SparkSession, source: str, landing: str, files_per_batch: int | None = None
) -> DataFrame:
    """Streaming reader over a folder of arriving files of one source; ``_arrived``
    is the time at which a row's file came."""
    reader = spark.readStream.schema(SOURCES[source].schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(landing)
    return stream.select("*", F.col("_metadata.file_modification_time").alias("_arrived"))


def run_available(
    stream: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> None:
    """Process everything that has arrived since the last run, then stop."""
    query = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_changes(models: IncrementalModels, landing: str, progress: str) -> bool:
    """Capture what has arrived of every source (one folder and one stream each),
    then propagate it; whether there was anything.

    The name of a stream's checkpoint is part of a batch's name, so a new stream,
    whose batches start again at 0, is not taken for the old one."""
    for source in SOURCES:
        if not Folder(models.spark, f"{landing}/{source}").names():
            continue
        stream = source_stream(models.spark, source, f"{landing}/{source}")
        run_available(
            stream,
            lambda df, batch_id, source=source: models.capture(source, df, progress, batch_id),
            f"{progress}/{source}",
        )
    return models.propagate()


def monthly_orders(stream: DataFrame) -> DataFrame:
    """Running count of orders per purchase month (state: one row per month)."""
    return stream.groupBy(month_start("order_purchase_timestamp").alias("month")).agg(
        F.count("*").alias("orders")
    )
