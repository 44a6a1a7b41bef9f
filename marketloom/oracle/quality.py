"""SQL of the data-quality queries: one SELECT per rule."""

from __future__ import annotations

from marketloom.oracle.base import AS_OF, dbl
from marketloom.oracle.declared import DECLARED_SQL
from marketloom.plans.rules import Rule, all_rules
from marketloom.sources.schemas import SOURCES

KINDS = [
    "unique", "not_null", "relationships", "accepted_values", "expression_row",
    "non_empty_table", "equal_rowcount", "unique_combination", "not_empty_string",
    "positive", "between",
]


def _from(model: str) -> str:
    if model in SOURCES:
        return f"raw_{model}"
    return f"({DECLARED_SQL[model]})" if model.startswith("decl_") else model


def _failing(r: Rule) -> str:
    t, c = _from(r.model), r.column
    if r.kind == "unique":
        return (f"SELECT COUNT(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL"
                f" GROUP BY {c} HAVING COUNT(*)>1) d")
    if r.kind == "unique_combination":
        return f"SELECT COUNT(*) FROM (SELECT {c} FROM {t} GROUP BY {c} HAVING COUNT(*)>1) d"
    if r.kind == "relationships":
        p, f = _from(r.args[0]), r.args[1]
        return (f"SELECT COUNT(*) FROM {t} c LEFT JOIN (SELECT DISTINCT {f} AS k FROM {p}) p"
                f" ON c.{c}=p.k WHERE c.{c} IS NOT NULL AND p.k IS NULL")
    if r.kind == "equal_rowcount":
        return f"SELECT abs((SELECT COUNT(*) FROM {t})-(SELECT COUNT(*) FROM {_from(r.args[0])}))"
    if r.kind == "non_empty_table":
        return f"SELECT CASE WHEN COUNT(*)=0 THEN 1 ELSE 0 END FROM {t}"
    bad = {
        "not_null": lambda: f"{c} IS NULL",
        "accepted_values": lambda: f"{c} NOT IN ({', '.join(repr(v) for v in r.args[0])})",
        "not_empty_string": lambda: f"trim({c})=''",
        "positive": lambda: f"{c}<=0",
        "between": lambda: f"{c} NOT BETWEEN {r.args[0]} AND {r.args[1]}",
        "expression_row": lambda: f"NOT ({r.args[0].format(now=AS_OF)})",
    }[r.kind]()
    return f"SELECT COUNT(*) FROM {t} x WHERE {bad}"


def _report(rules: list[Rule]) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return "\nUNION ALL ".join(
        f"SELECT {quote(r.name)} AS test, {quote(r.model)} AS model,"
        f" {quote(r.column)} AS \"column\", {quote(r.severity)} AS severity,"
        f" CAST(({_failing(r)}) AS BIGINT) AS failing_rows"
        for r in rules
    )


def _revenue(amount: str) -> str:
    return f"""SELECT i.order_id, {dbl("i.t")} AS calculated_total_price,
 {dbl("p.t")} AS payment_total, {dbl("abs(i.t - p.t)")} AS discrepancy
FROM (SELECT order_id, SUM({amount}) AS t FROM raw_order_items GROUP BY 1) i
JOIN (SELECT order_id, SUM(payment_value) AS t FROM raw_order_payments GROUP BY 1) p
 ON i.order_id=p.order_id WHERE abs(i.t - p.t) > 1.0 OR i.t < 0 OR p.t < 0"""


QUALITY_SQL = {
    **{f"dq_{k}": _report([r for r in all_rules() if r.kind == k]) for k in KINDS},
    "source_decl": _report([r for r in all_rules() if r.model in SOURCES]),
    "dq_order_dates": f"""SELECT order_id, order_purchase_timestamp, order_approved_at,
 order_delivered_customer_date FROM raw_orders
WHERE (order_delivered_customer_date IS NOT NULL
  AND order_purchase_timestamp > order_delivered_customer_date)
 OR (order_approved_at IS NOT NULL AND order_purchase_timestamp > order_approved_at)
 OR order_purchase_timestamp > {AS_OF}""",
    "dq_revenue_integrity": _revenue("price"),
    "dq_revenue_integrity_with_freight": _revenue("price + freight_value"),
}
