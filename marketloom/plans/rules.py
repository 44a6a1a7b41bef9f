"""The declared data tests, as data.

Each entry is ``model: {column: [tests]}``.  A test is a name, or a name with
arguments.  Expressions are SQL that is true (or unknown) for a good row;
``{now}`` stands for the reference time.  Two lists exist for some mart
columns: the values the documentation declares and those the models produce."""

from __future__ import annotations

from dataclasses import dataclass, field

from marketloom.functions.buckets import BRAZIL_STATES


@dataclass(frozen=True)
class Rule:
    kind: str
    model: str
    column: str
    args: tuple = field(default=())
    variant: str = "declared"  # or 'produced'
    severity: str = "warn"  # 'error' stops publishing

    @property
    def name(self) -> str:
        """Readable name, unique within model and column."""
        text = self.kind if not self.args else f"{self.kind}({_text(self.args)})"
        return text if self.variant == "declared" else f"{text} [{self.variant}]"


def _text(args: tuple) -> str:
    return ", ".join("|".join(a) if isinstance(a, tuple) else str(a) for a in args)


U, NN, NE, POS = ("unique",), ("not_null",), ("not_empty_string",), ("positive",)


def expr(*conditions: str) -> list[tuple]:
    return [("expression_row", c) for c in conditions]


def values(*allowed: str) -> tuple:
    return ("accepted_values", allowed)


def parent(model: str, column: str) -> tuple:
    return ("relationships", model, column)


# The accepted values of the declared tests.
STATES = values(*BRAZIL_STATES)
STATUSES = values(
    "delivered", "shipped", "canceled", "unavailable", "invoiced", "processing",
    "approved", "created",
)
LEVELS = values("High", "Medium", "Low")
VOLUMES = values("high_volume", "medium_volume", "low_volume")
WORTHS = values("high_value", "medium_value", "low_value")
GRADES = values("excellent", "good", "average", "poor")
FREQUENCIES = values("high_frequency", "medium_frequency", "low_frequency")
NPS = values("promoter", "passive", "detractor")

# The declared tests by model and column.
COLUMN_TESTS = {
    # source declarations
    "customers": {"customer_id": [U, NN]},
    "order_items": {"order_id": [NN, parent("orders", "order_id")]},
    "orders": {"order_id": [U, NN]},
    "products": {"product_id": [U, NN]},
    "sellers": {"seller_id": [U, NN]},
    # staging
    "stg_product_categories": {
        "category_id": [U, NN, parent("stg_products", "category_id")],
        "category_name_english": [NN, NE],
        "category_name_portuguese": [NN, NE],
    },
    "stg_geolocation": {
        "zip_code_prefix": [U, NN, *expr("length(zip_code_prefix) = 5")],
        "latitude": [NN, *expr("latitude between -33.75 and 5.27")],
        "longitude": [NN, *expr("longitude between -73.99 and -34.79")],
        "city": [NN, NE],
        "state": [NN, STATES],
        "city_normalized": [NN, NE],
        "state_normalized": [NN, NE],
    },
    "stg_orders": {
        "order_id": [U, NN, NE, parent("stg_order_items", "order_id")],
        "customer_id": [NN, parent("stg_customers", "customer_id")],
        "order_status": [NN, STATUSES],
        "purchased_at": [
            NN, *expr("purchased_at >= '2016-01-01' and purchased_at <= {now}")
        ],
        "approved_at": [NN, *expr("approved_at >= purchased_at")],
        "shipped_at": expr("shipped_at is null or shipped_at >= approved_at"),
        "delivered_at": expr("delivered_at is null or delivered_at >= shipped_at"),
        "estimated_delivery_at": [NN, *expr("estimated_delivery_at > purchased_at")],
        "delivery_time_days": expr("delivery_time_days is null or delivery_time_days >= 0"),
        "delivery_variance_days": expr(
            "delivery_variance_days is null or abs(delivery_variance_days) <= 365"
        ),
        "is_delivered_on_time": [NN],
        "is_delivered": [NN],
    },
    "stg_order_items": {
        "order_item_sk": [U, NN],
        "order_id": [NN, parent("stg_orders", "order_id")],
        "order_item_id": [NN, POS, *expr("order_item_id <= 100")],
        "product_id": [NN, parent("stg_products", "product_id")],
        "seller_id": [NN, parent("stg_sellers", "seller_id")],
        "shipping_limit_at": [NN, *expr("shipping_limit_at > {now} - interval '5' year")],
        "price_amount": [NN, *expr("price_amount >= 0", "price_amount < 10000")],
        "shipping_amount": [NN, *expr("shipping_amount >= 0", "shipping_amount < 1000")],
        "total_amount": [
            NN, *expr("total_amount >= 0", "total_amount = price_amount + shipping_amount")
        ],
        "is_free_item": [NN],
        "is_free_shipping": [NN],
    },
    "stg_order_payments": {
        "order_payment_sk": [U, NN],
        "order_id": [NN, parent("stg_orders", "order_id")],
        "payment_sequential": [NN, POS, *expr("payment_sequential <= 10")],
        "payment_type": [NN, values("credit_card", "debit_card", "voucher", "boleto")],
        "payment_installments": [
            NN, *expr("payment_installments >= 1", "payment_installments <= 24")
        ],
        "payment_amount": [NN, *expr("payment_amount > 0", "payment_amount < 10000")],
        "is_installment_payment": [NN],
        "is_credit_card": [NN],
        "is_debit_card": [NN],
        "is_voucher": [NN],
        "is_boleto": [NN],
        "installment_amount": expr(
            "installment_amount > 0",
            "installment_amount = round(payment_amount / payment_installments, 6)",
        ),
    },
    "stg_order_reviews": {
        "review_id": [U, NN, NE],
        "order_id": [NN, parent("stg_orders", "order_id")],
        "review_score": [NN, *expr("review_score between 1 and 5")],
        "review_comment_title": expr(
            "review_comment_title is null or length(review_comment_title) <= 100"
        ),
        "review_comment_message": expr(
            "review_comment_message is null or length(review_comment_message) <= 1000"
        ),
        "created_at": [NN, *expr("created_at >= '2016-01-01' and created_at <= {now}")],
        "answered_at": [NN, *expr("answered_at >= created_at")],
        "is_positive_review": [NN, *expr("is_positive_review = (review_score >= 4)")],
        "is_negative_review": [NN, *expr("is_negative_review = (review_score <= 2)")],
        "has_review_comment": [NN],
        "response_time_hours": expr("response_time_hours >= 0", "response_time_hours < 8760"),
    },
    # intermediate
    "int_orders_with_items": {
        "order_id": [U, NN, parent("stg_orders", "order_id")],
        "customer_id": [NN, parent("stg_customers", "customer_id")],
        "order_status": [NN, STATUSES],
        "purchased_at": [NN],
        "number_of_items": [NN, *expr("number_of_items >= 1")],
        "number_of_sellers": [NN, *expr("number_of_sellers >= 1")],
        "total_items_amount": [NN, *expr("total_items_amount >= 0")],
        "total_shipping_amount": [NN, *expr("total_shipping_amount >= 0")],
        "total_order_amount": [
            NN, *expr("total_order_amount = total_items_amount + total_shipping_amount")
        ],
        "total_payment_amount": [NN, *expr("total_payment_amount > 0")],
        "has_payment_discrepancy": [NN],
    },
    "int_customer_orders": {
        "customer_id": [U, NN, parent("stg_customers", "customer_id")],
        "total_orders": [NN, *expr("total_orders >= 0")],
        "total_spent": [NN, *expr("total_spent >= 0")],
        "avg_order_amount": expr("avg_order_amount >= 0"),
        "avg_review_score": expr(
            "avg_review_score is null or (avg_review_score between 1 and 5)"
        ),
        "frequency_segment": [NN, FREQUENCIES],
        "value_segment": [NN, WORTHS],
        "nps_segment": [NN, NPS],
    },
    "int_seller_performance": {
        "seller_id": [U, NN, parent("stg_sellers", "seller_id")],
        "total_orders": [NN, *expr("total_orders >= 0")],
        "total_gmv": [NN, *expr("total_gmv >= 0")],
        "avg_review_score": expr(
            "avg_review_score is null or (avg_review_score between 1 and 5)"
        ),
        "on_time_delivery_rate": expr(
            "on_time_delivery_rate is null or (on_time_delivery_rate between 0 and 100)"
        ),
        "volume_segment": [NN, VOLUMES],
        "value_segment": [NN, WORTHS],
        "performance_segment": [NN, GRADES],
        "delivery_segment": [NN, GRADES],
    },
    "int_product_performance": {
        "product_id": [U, NN, parent("stg_products", "product_id")],
        "category_id": [NN, parent("stg_product_categories", "category_id")],
        "total_orders": [NN, *expr("total_orders >= 0")],
        "total_gmv": [NN, *expr("total_gmv >= 0")],
        "avg_price": [NN, *expr("avg_price > 0")],
        "avg_review_score": expr(
            "avg_review_score is null or (avg_review_score between 1 and 5)"
        ),
        "volume_segment": [NN, VOLUMES],
        "price_segment": [NN, values("premium", "mid_range", "budget")],
        "rating_segment": [NN, GRADES],
        "weight_segment": [NN, values("heavy", "medium", "light")],
        "size_segment": [NN, values("large", "medium", "small")],
    },
    # marts
    "mart_customer_analytics": {
        "customer_id": [U, NN],
        "frequency_segment": [LEVELS],
        "value_segment": [LEVELS],
        "nps_segment": [values("Promoter", "Passive", "Detractor")],
        "customer_tier": [values("VIP", "Loyal", "Growing", "Big Spender", "Standard")],
        "total_spent": [NN, POS],
        "avg_order_value": [NN, POS],
        "avg_review_score": [NN, ("between", 1, 5)],
        "customer_lifetime_days": [NN, POS],
        "daily_customer_value": [NN],
    },
    "mart_seller_analytics": {
        "seller_id": [U, NN],
        "volume_segment": [LEVELS],
        "value_segment": [LEVELS],
        "performance_segment": [values("Excellent", "Good", "Fair", "Poor")],
        "total_gmv": [NN, POS],
        "on_time_delivery_rate": [NN, ("between", 0, 1)],
    },
    "decl_seller_tier": {
        "seller_tier": [values("Elite", "Premium", "Standard", "At Risk")]
    },
    "decl_mom_growth": {"mom_growth_rate": [NN]},
    "mart_product_analytics": {
        "product_id": [U, NN],
        "gmv": [NN, POS],
        "avg_review_score": [NN, ("between", 1, 5)],
    },
    "mart_products": {
        "volume_segment": [LEVELS],
        "price_segment": [values("Premium", "Standard", "Budget")],
    },
    "decl_product_tier": {
        "product_tier": [values("Premium", "Popular", "Standard", "At Risk")]
    },
    "decl_logistics_complexity": {"logistics_complexity": [LEVELS]},
    "decl_category_relative_gmv": {"category_relative_gmv": [NN]},
}

# What the models produce where the documentation says otherwise.
PRODUCED = {
    "mart_customer_analytics": {
        "frequency_segment": [FREQUENCIES],
        "value_segment": [WORTHS],
        "nps_segment": [NPS],
    },
    "mart_seller_analytics": {
        "volume_segment": [VOLUMES],
        "value_segment": [WORTHS],
        "performance_segment": [GRADES],
        "on_time_delivery_rate": [("between", 0, 100)],
    },
    "mart_products": {
        "volume_segment": [VOLUMES],
        "price_segment": [values("premium", "mid_range", "budget")],
    },
}

SAME_ROWS = {
    "stg_product_categories": "product_categories",
    "stg_orders": "orders",
    "stg_order_items": "order_items",
    "stg_order_payments": "order_payments",
    "stg_order_reviews": "order_reviews",
    "int_orders_with_items": "stg_orders",
    "int_customer_orders": "stg_customers",
    "int_seller_performance": "stg_sellers",
    "int_product_performance": "stg_products",
}
NON_EMPTY = [
    "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews",
    "int_orders_with_items",
]


def _severity(kind: str, variant: str, beside: list[str]) -> str:
    """Broken keys (repeated or missing) stop publishing; everything else is
    reported, relationships too: some are declared from parent to child, or miss
    categories that the source itself misses.  ``beside``: all kinds of tests on the
    column."""
    key = kind == "unique" or kind == "not_null" and "unique" in beside
    return "error" if key and variant == "declared" else "warn"


def all_rules() -> list[Rule]:
    out = []
    for variant, tests in (("declared", COLUMN_TESTS), ("produced", PRODUCED)):
        for model, columns in tests.items():
            for column, checks in columns.items():
                for kind, *args in checks:
                    out.append(
                        Rule(kind, model, column, tuple(args), variant,
                             _severity(kind, variant, [k for k, *_ in checks]))
                    )
    out += [Rule("equal_rowcount", a, "*", (b,)) for a, b in SAME_ROWS.items()]
    out += [Rule("non_empty_table", a, "*") for a in NON_EMPTY]
    out.append(
        Rule("unique_combination", "stg_geolocation",
             "zip_code_prefix, city_normalized, state_normalized")
    )
    return out
