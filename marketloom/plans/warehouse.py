"""The model graph: every model by name, built lazily or written once."""

from __future__ import annotations

from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.plans.intermediate import INTERMEDIATE
from marketloom.plans.marts import MARTS
from marketloom.plans.staging import STAGING
from marketloom.sources.schemas import SOURCES
from marketloom.sources.tables import write_scratch

# Edges of the model graph: model -> the models and source tables it reads.
DEPENDS = {
    "stg_customers": ["customers"],
    "stg_sellers": ["sellers"],
    "stg_geolocation": ["geolocation"],
    "stg_orders": ["orders"],
    "stg_order_items": ["order_items"],
    "stg_order_payments": ["order_payments"],
    "stg_order_reviews": ["order_reviews"],
    "stg_product_categories": ["product_categories"],
    "stg_products": ["products"],
    "int_order_sellers": ["stg_order_items"],
    "int_order_products": ["stg_order_items"],
    "int_order_items_agg": ["stg_order_items", "int_order_sellers", "int_order_products"],
    "int_order_financials": ["stg_order_payments"],
    "int_order_reviews_agg": ["stg_order_reviews"],
    "int_orders_with_items": [
        "stg_orders", "int_order_items_agg", "int_order_financials",
        "int_order_reviews_agg",
    ],
    "int_customer_payments": ["int_orders_with_items"],
    "int_customer_orders": [
        "stg_customers", "int_orders_with_items", "int_customer_payments",
    ],
    "int_product_performance": [
        "stg_products", "stg_product_categories", "stg_order_items",
        "int_order_products", "int_orders_with_items",
    ],
    "int_seller_performance": [
        "stg_sellers", "int_order_sellers", "int_orders_with_items",
    ],
    "mart_orders": ["int_orders_with_items"],
    "mart_products": ["int_product_performance"],
    "mart_customers": ["stg_customers", "stg_geolocation", "int_orders_with_items"],
    "mart_sellers": [
        "stg_sellers", "stg_geolocation", "stg_orders", "stg_order_items",
        "int_order_sellers", "int_orders_with_items",
    ],
    "mart_product_categories": [
        "mart_products", "int_order_products", "int_orders_with_items",
    ],
    "mart_customer_analytics": ["int_customer_orders"],
    "mart_seller_analytics": ["int_seller_performance"],
    "mart_product_analytics": ["int_product_performance"],
    "seller_order_history": ["int_order_sellers", "int_orders_with_items"],
    "seller_category_history": ["stg_order_items", "int_product_performance"],
}

MODELS = {**STAGING, **INTERMEDIATE, **MARTS}

# Written once and read by several models or dashboards.  The rest stay views.
TABLES = [
    "int_order_sellers",
    "int_order_products",
    "int_orders_with_items",
    "int_customer_orders",
    "int_product_performance",
    "int_seller_performance",
    "mart_customers",
    "mart_sellers",
    "mart_product_categories",
    "mart_customer_analytics",
    "mart_seller_analytics",
    "mart_product_analytics",
]

# Of these, and of the items, what holds rows of orders: dealt by order when written.
BY_ORDER = ["order_items", "int_order_sellers", "int_order_products", "int_orders_with_items"]


def layer(model: str) -> str:
    if model in STAGING:
        return "staging"
    return "intermediate" if model in INTERMEDIATE else "marts"


def as_timestamp(value=None) -> Column:
    """The reference time of recency columns; now, unless one is given."""
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


class Warehouse:
    """``Warehouse(spark, sources)[model]`` is the model as a DataFrame.

    ``sources`` is anything that maps a source table name to a DataFrame.
    Models named in ``tables`` are written to shared storage on first use and
    read back afterwards, like tables of a daily refresh; with ``tables=()``
    every model is a lazy composition of the ones below it."""

    def __init__(
        self, spark: SparkSession, sources, as_of=None, tables=TABLES, save=write_scratch
    ):
        self.spark, self.sources, self.save = spark, sources, save
        self.as_of = as_timestamp(as_of)
        self.tables = set(tables)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name in SOURCES:
            df = self.sources[name]
        elif name in STAGING:
            df = STAGING[name](self)
        elif name in MODELS:
            df = MODELS[name](self, self.as_of)
        else:
            raise KeyError(name)
        return self.save(df, name) if name in self.tables else df

    def build_all(self, threads: int = 4) -> None:
        """Build every table; models whose inputs are ready run side by side,
        so that the tail of one leaves no executor idle."""
        graph = TopologicalSorter(
            {name: [d for d in deps if d in MODELS] for name, deps in DEPENDS.items()}
        )
        graph.prepare()
        with ThreadPoolExecutor(threads) as pool:
            running: dict = {}
            while graph.is_active():
                for name in graph.get_ready():
                    running[pool.submit(self.__getitem__, name)] = name
                done, _ = wait(running, return_when=FIRST_COMPLETED)
                for job in done:
                    job.result()
                    graph.done(running.pop(job))

    def put(self, name: str, df: DataFrame) -> None:
        """Use ``df`` for ``name`` instead of building it."""
        self._built[name] = df

    def refresh(self) -> None:
        """Forget everything built, so that the next use sees new input."""
        self._built.clear()
