"""All registered queries: name -> callable on a directory of test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from marketloom.plans.customer_dashboard import CUSTOMER_QUERIES
from marketloom.plans.declared import DECLARED_QUERIES
from marketloom.plans.operator_queries import OPERATOR_QUERIES
from marketloom.plans.product_dashboard import PRODUCT_QUERIES
from marketloom.plans.quality import (
    counted_models,
    dq_order_dates,
    dq_revenue_integrity,
    evaluate,
    one_pass,
)
from marketloom.plans.rules import all_rules
from marketloom.plans.segments import SEGMENT_QUERIES
from marketloom.plans.seller_dashboard import SELLER_QUERIES
from marketloom.plans.warehouse import BY_ORDER, MODELS, TABLES, Warehouse
from marketloom.present import present
from marketloom.session import configure
from marketloom.sources.fixture import FixtureSources
from marketloom.sources.schemas import SOURCES
from marketloom.sources.tables import deal_by_size, write_buckets, write_scratch
from marketloom.streaming.runs import RUNS

AS_OF = "2002-01-01 00:00:00"
REPORT_MONTH = "1995-03-01"

_warehouses: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark, sf_dir: str) -> Warehouse:
    """The models over one directory.  Tables are written on first use and
    shared by the queries of the session, as dashboards share the marts."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        configure(spark)
        sources = FixtureSources(spark, sf_dir)
        deal_by_size(spark, sources.most_rows())

        def save(df, name):
            if name in BY_ORDER and sources.hot_orders().isEmpty():
                return write_buckets(df, name, "order_id")
            return write_scratch(df, name)

        _warehouses[key] = Warehouse(
            spark, sources, AS_OF, tables=["order_items", *TABLES], save=save
        )
    return _warehouses[key]


def _model(name):
    return lambda spark, sf_dir: present(warehouse(spark, sf_dir)[name])


def _query(f, **options):
    def run(spark, sf_dir):
        m = warehouse(spark, sf_dir)
        return present(f(m, m.as_of, **options))

    return run


class _Checked:
    """Models and documented columns under one name space, for the rules.  Documented
    columns and the counts of a model are written once."""

    def __init__(self, m):
        self.m = m
        self._written: dict = {}
        self._counts: dict = {}

    def __getitem__(self, name):
        if name not in DECLARED_QUERIES:
            return self.m[name]
        if name not in self._written:
            self._written[name] = write_scratch(DECLARED_QUERIES[name](self.m, self.m.as_of), name)
        return self._written[name]

    def counts(self, rules):
        """Counts of the models that ``rules`` are about, and of no others: a report on some
        models builds only these.  Each is counted once, for all rules."""
        models = counted_models(rules)
        new = [x for x in models if x not in self._counts]
        if new:
            counts = write_scratch(one_pass(self, all_rules(), NOW_SQL, new), "rule-counts")
            self._counts |= dict.fromkeys(new, counts)
        parts = list({id(self._counts[x]): self._counts[x] for x in models}.values())
        return reduce(DataFrame.unionByName, parts)


_checked: dict[int, _Checked] = {}


def checked(m) -> _Checked:
    if id(m) not in _checked or _checked[id(m)].m is not m:
        _checked[id(m)] = _Checked(m)
    return _checked[id(m)]


def _run(f):
    return lambda spark, sf_dir: present(f(spark, warehouse(spark, sf_dir), sf_dir))


NOW_SQL = f"timestamp_ntz'{AS_OF}'"


def _quality(select):
    def run(spark, sf_dir):
        rules = [r for r in all_rules() if select(r)]
        report = checked(warehouse(spark, sf_dir))
        counted = counted_models(rules)
        return present(evaluate(report, rules, NOW_SQL, report.counts(rules) if counted else None))

    return run


def _quality_queries() -> dict:
    kinds = dict.fromkeys(r.kind for r in all_rules())
    out = {f"dq_{k}": _quality(lambda r, k=k: r.kind == k) for k in kinds}
    out["source_decl"] = _quality(lambda r: r.model in SOURCES)
    out["dq_order_dates"] = _query(dq_order_dates)
    out["dq_revenue_integrity"] = _query(dq_revenue_integrity)
    out["dq_revenue_integrity_with_freight"] = _query(
        dq_revenue_integrity, with_freight=True
    )
    return out


def registered() -> dict:
    out = {name: _model(name) for name in MODELS}
    for group in (
        CUSTOMER_QUERIES, PRODUCT_QUERIES, SELLER_QUERIES, SEGMENT_QUERIES,
        OPERATOR_QUERIES, DECLARED_QUERIES,
    ):
        for name, f in group.items():
            options = {"month": REPORT_MONTH} if name.startswith("q_nov_") else {}
            out[name] = _query(f, **options)
    out |= _quality_queries()
    out |= {name: _run(f) for name, f in RUNS.items()}
    return out
