"""Data-quality evaluation: every rule yields its number of failing rows.

All row-level rules of a model share one scan and one aggregate, which also gives its
number of rows (``one_pass``); key rules aggregate per key with map-side combine;
relationships compare distinct keys.
The results are small relations of their own: (test, model, column, variant,
severity, failing_rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import money, total
from marketloom.operators.keyed import missing_parents
from marketloom.plans.rules import Rule, all_rules

ROW_KINDS = {
    "not_null", "accepted_values", "expression_row", "not_empty_string", "positive",
    "between",
}


def _fails(rule: Rule, now: str) -> Column:
    """True for a row that breaks a row-level rule."""
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "accepted_values":
        return ~c.isin(*rule.args[0])
    if rule.kind == "not_empty_string":
        return F.trim(c) == ""
    if rule.kind == "positive":
        return c <= 0
    if rule.kind == "between":
        return ~c.between(*rule.args)
    return ~F.expr(rule.args[0].format(now=now))


def _result(df: DataFrame, rule: Rule) -> DataFrame:
    """Label a one-row relation ``failing_rows``."""
    return df.select(
        F.lit(rule.name).alias("test"),
        F.lit(rule.model).alias("model"),
        F.lit(rule.column).alias("column"),
        F.lit(rule.severity).alias("severity"),
        F.coalesce(F.col("failing_rows"), F.lit(0)).cast("bigint").alias("failing_rows"),
    )


#: The name under which a model's number of rows stands among the counts.
ROWS = "rows"
COUNT_KINDS = {"equal_rowcount", "non_empty_table"}


def _counted(df: DataFrame, model: str, rules: list[Rule], now: str) -> DataFrame:
    """The failing rows of all row-level rules of a model, and its number of rows."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(_fails(r, now)).alias(f"r{i}") for i, r in enumerate(rules)],
    )
    rows = [
        F.struct(
            F.lit(r.name).alias("test"),
            F.lit(r.model).alias("model"),
            F.lit(r.column).alias("column"),
            F.lit(r.severity).alias("severity"),
            F.col(f"r{i}").alias("failing_rows"),
        )
        for i, r in enumerate(rules)
    ]
    text = lambda v, name: F.lit(v).cast("string").alias(name)
    rows.append(F.struct(
        text(ROWS, "test"), text(model, "model"), text(None, "column"), text(None, "severity"),
        F.col("rows").alias("failing_rows"),
    ))
    return counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def _together(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def counted_models(rules: list[Rule]) -> list[str]:
    """The models whose rows the row-level rules and row counts of ``rules`` look at."""
    counted = [r for r in rules if r.kind in ROW_KINDS | COUNT_KINDS]
    models = dict.fromkeys(r.model for r in counted)
    models |= dict.fromkeys(r.args[0] for r in counted if r.kind == "equal_rowcount")
    return list(models)


def one_pass(m, rules: list[Rule], now: str, models: list[str] | None = None) -> DataFrame:
    """Counts of all row-level rules and of rows: one scan and one aggregate for each
    model that a rule of these kinds is about, or for each of ``models``."""
    return _together([
        _counted(m[model], model, [r for r in rules if r.model == model and r.kind in ROW_KINDS], now)
        for model in (counted_models(rules) if models is None else models)
    ])


def _rows_of(counts: DataFrame, model: str) -> Column:
    return counts.filter((F.col("test") == ROWS) & (F.col("model") == model)).select("failing_rows").scalar()


def _count_rule(counts: DataFrame, rule: Rule) -> DataFrame:
    own = counts.filter((F.col("test") == ROWS) & (F.col("model") == rule.model))
    n = F.col("failing_rows")
    if rule.kind == "non_empty_table":
        return own.select((n == 0).cast("int").alias("failing_rows"))
    return own.select(F.abs(n - _rows_of(counts, rule.args[0])).alias("failing_rows"))


def _key_rule(m, rule: Rule) -> DataFrame:
    df = m[rule.model]
    if rule.kind in ("unique", "unique_combination"):
        keys = [k.strip() for k in rule.column.split(",")]
        known = df if rule.kind == "unique_combination" else df.filter(
            F.col(rule.column).isNotNull()
        )
        twice = known.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
        return twice.agg(F.count("*").alias("failing_rows"))
    if rule.kind == "relationships":
        orphans = missing_parents(df, rule.column, m[rule.args[0]], rule.args[1])
        return orphans.agg(F.sum("rows").alias("failing_rows"))
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def failing_rows(m, rule: Rule, now: str) -> DataFrame:
    """The rows of the rule's model that break it, for a look at the cause."""
    df = m[rule.model]
    if rule.kind in ROW_KINDS:
        return df.filter(_fails(rule, now))
    if rule.kind == "relationships":
        orphans = missing_parents(df, rule.column, m[rule.args[0]], rule.args[1])
        return df.join(orphans, df[rule.column] == orphans["_k"], "left_semi")
    if rule.kind in ("unique", "unique_combination"):
        keys = [k.strip() for k in rule.column.split(",")]
        twice = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("_n"))
        twice = twice.filter("_n > 1")
        if rule.kind == "unique":
            twice = twice.filter(F.col(f"_{keys[0]}").isNotNull())
        return df.join(twice, [df[k].eqNullSafe(twice[f"_{k}"]) for k in keys], "left_semi")
    raise ValueError(f"a {rule.kind} rule is about the table, not about rows")


def evaluate(m, rules: list[Rule], now: str, counts: DataFrame | None = None) -> DataFrame:
    """One row per rule.  ``now`` is the reference time as SQL text; ``counts`` is a
    written ``one_pass`` over these and other rules, if there is one."""
    if counts is None and any(r.kind in ROW_KINDS | COUNT_KINDS for r in rules):
        counts = one_pass(m, rules, now)
    parts = []
    row = ["\n".join((r.name, r.model, r.column)) for r in rules if r.kind in ROW_KINDS]
    if row:
        parts.append(counts.filter(F.concat_ws("\n", "test", "model", "column").isin(row)))
    for rule in rules:
        if rule.kind in COUNT_KINDS:
            parts.append(_result(_count_rule(counts, rule), rule))
        elif rule.kind not in ROW_KINDS:
            parts.append(_result(_key_rule(m, rule), rule))
    return _together(parts)


def rules_of(kind: str) -> list[Rule]:
    return [r for r in all_rules() if r.kind == kind]


def dq_order_dates(m, as_of: Column) -> DataFrame:
    """Raw orders whose dates contradict each other or lie in the future."""
    dates = ["order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date"]
    orders = m["orders"].select(
        "order_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in dates]
    )
    bought, approved, delivered = (F.col(c) for c in dates)
    today = as_of.cast("date").cast("timestamp_ntz")
    return orders.filter(
        (delivered.isNotNull() & (bought > delivered))
        | (approved.isNotNull() & (bought > approved))
        | (bought > today)
    )


def dq_revenue_integrity(m, as_of=None, with_freight: bool = False) -> DataFrame:
    """Orders whose item total and payments differ by more than 1.

    As declared, items count without freight, which flags most freighted
    orders; ``with_freight`` compares what was really charged."""
    charged = money("price")
    if with_freight:
        charged = charged + money("freight_value")
    items = m["order_items"].groupBy("order_id").agg(
        total(charged).alias("calculated_total_price")
    )
    paid = m["order_payments"].groupBy("order_id").agg(
        total(money("payment_value")).alias("payment_total")
    )
    gap = F.abs(F.col("calculated_total_price") - F.col("payment_total"))
    return (
        items.join(paid, "order_id")
        .withColumn("discrepancy", gap)
        .filter("discrepancy > 1.0 or calculated_total_price < 0 or payment_total < 0")
    )
