"""The nine source tables derived from the star-schema test tables.

Only test data needs this module; production reads the sources themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.buckets import BRAZIL_STATES
from marketloom.operators.ranking import heavy_keys, number_within

_CODES = ", ".join(f"'{code}'" for code in BRAZIL_STATES)
_STATE = f"element_at(array({_CODES}), cast({{k}} as int) + 1)"
_ZIP = "lpad(cast(1000+{k} as string), 5, '0')"
_CITY = "concat(lower(r_name), ' ', replace(lower(n_name), '_', '-'))"
_CENTS = "cast(round(l_extendedprice*100) as bigint) div 100"
_TAX = "cast(round(l_tax*100) as bigint)"


def _shift(days: str, hours: str) -> str:
    return f"o_orderdate + make_dt_interval(cast({days} as int), cast({hours} as int))"


def _money(cents: str) -> str:
    return (
        f"cast(cast({cents} as decimal(12,0)) * cast(0.01 as decimal(3,2))"
        " as decimal(10,2))"
    )


class FixtureSources:
    """Mapping-like access: ``FixtureSources(spark, dir)["orders"]``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._hot: DataFrame | None = None

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def _located(self, table: str, nation_key: str) -> DataFrame:
        nation = self._read("nation").join(
            self._read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return self._read(table).join(nation, F.col(nation_key) == F.col("n_nationkey"))

    def customers(self) -> DataFrame:
        return self._located("customer", "c_nationkey").selectExpr(
            "cast(c_custkey as string) as customer_id",
            "md5(c_name) as customer_unique_id",
            _ZIP.format(k="c_nationkey") + " as customer_zip_code_prefix",
            _CITY + " as customer_city",
            _STATE.format(k="c_nationkey") + " as customer_state",
        )

    def sellers(self) -> DataFrame:
        return self._located("supplier", "s_nationkey").selectExpr(
            "cast(s_suppkey as string) as seller_id",
            _ZIP.format(k="s_nationkey") + " as seller_zip_code_prefix",
            _CITY + " as seller_city",
            _STATE.format(k="s_nationkey") + " as seller_state",
        )

    def geolocation(self) -> DataFrame:
        return self._located("customer", "c_nationkey").selectExpr(
            _ZIP.format(k="c_nationkey") + " as geolocation_zip_code_prefix",
            "cast(-33+(c_custkey%38) as double) as geolocation_lat",
            "cast(-73+(c_custkey%37) as double) as geolocation_lng",
            _CITY + " as geolocation_city",
            _STATE.format(k="c_nationkey") + " as geolocation_state",
        )

    def orders(self) -> DataFrame:
        done = "o_orderstatus in ('F','P')"
        return self._read("orders").selectExpr(
            "cast(o_orderkey as string) as order_id",
            "cast(o_custkey as string) as customer_id",
            f"case when {done} then 'delivered' else element_at(array('canceled',"
            "'unavailable','invoiced','processing','created','approved','shipped'),"
            " cast(o_orderkey%7 as int)+1) end as order_status",
            _shift("0", "o_orderkey%24") + " as order_purchase_timestamp",
            _shift("0", "o_orderkey%24+1") + " as order_approved_at",
            f"case when {done} then {_shift('2', 'o_orderkey%24')} end"
            " as order_delivered_carrier_date",
            f"case when {done} and o_orderkey%50<>0 then "
            + _shift("3+o_orderkey%30", "o_orderkey%24+o_orderkey%17")
            + " end as order_delivered_customer_date",
            _shift("24", "0") + " as order_estimated_delivery_date",
        )

    def most_rows(self) -> int:
        """Rows of the largest table."""
        return max(self._read(name).count() for name in ("lineitem", "orders", "customer"))

    def hot_orders(self) -> DataFrame:
        """Orders of so many items that no single task should have them."""
        if self._hot is None:
            self._hot = heavy_keys(
                self._read("lineitem").selectExpr("cast(l_orderkey as string) as order_id"), "order_id")
        return self._hot

    def order_items(self) -> DataFrame:
        # numbered by the key that the table is dealt by: one shuffle for both
        lines = self._read("lineitem").selectExpr(
            "cast(l_orderkey as string) as order_id", "l_linenumber", "l_partkey", "l_suppkey",
            "l_shipdate", "l_extendedprice", "l_tax",
        )
        numbered = number_within(
            lines,
            "order_id",
            ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"],
            "rn",
            self.hot_orders(),
        )
        return (
            numbered.withColumn("cents", F.expr(_CENTS))
            .withColumn("taxpct", F.expr(_TAX))
            .selectExpr(
                "order_id",
                "cast(rn as int) as order_item_id",
                "cast(l_partkey as string) as product_id",
                "cast(l_suppkey as string) as seller_id",
                "l_shipdate as shipping_limit_date",
                _money("cents") + " as price",
                _money("cents*taxpct div 100") + " as freight_value",
            )
        )

    def order_payments(self) -> DataFrame:
        paid = (
            self._read("lineitem")
            .selectExpr("l_orderkey", f"{_CENTS} as cents", f"{_TAX} as taxpct")
            .groupBy("l_orderkey")
            .agg(F.expr("sum(cents + cents*taxpct div 100)").alias("tot"))
        )
        return (
            self._read("orders")
            .join(paid, F.col("o_orderkey") == F.col("l_orderkey"))
            .selectExpr(
                "*",
                "explode(if(o_orderkey%11=0, array(1,2), array(1))) as seq",
            )
            .selectExpr(
                "cast(o_orderkey as string) as order_id",
                "cast(seq as int) as payment_sequential",
                "case when seq=2 or o_orderpriority='4-NOT SPECIFIED' then 'voucher'"
                " when o_orderpriority in ('1-URGENT','2-HIGH') then 'credit_card'"
                " when o_orderpriority='3-MEDIUM' then 'boleto' else 'debit_card' end"
                " as payment_type",
                "cast(case when seq=1 and o_orderpriority in ('1-URGENT','2-HIGH')"
                " then 1+o_orderkey%10 else 1 end as int) as payment_installments",
                _money(
                    "cast(case when seq=2 then 500 when o_orderkey%11=0 then tot-500"
                    " when o_orderkey%97=0 then tot+250 else tot end as bigint)"
                )
                + " as payment_value",
            )
        )

    def order_reviews(self) -> DataFrame:
        return (
            self._read("orders")
            .selectExpr(
                "*",
                "explode(filter(array(0,1), d -> (d=0 and o_orderkey%10<>0)"
                " or (d=1 and o_orderkey%40=1))) as dup",
            )
            .selectExpr(
                "md5(concat(cast(o_orderkey as string),'-',cast(dup as string)))"
                " as review_id",
                "cast(o_orderkey as string) as order_id",
                "cast(1+(o_orderkey*7+o_custkey+dup*3)%5 as int) as review_score",
                "case when o_orderkey%4=0 then 'titulo' end as review_comment_title",
                "case when o_orderkey%3=0 then"
                " concat('comentario ',cast(o_orderkey as string))"
                " when o_orderkey%3=1 then '  ' end as review_comment_message",
                _shift("35+dup", "0") + " as review_creation_date",
                _shift("36+dup", "o_orderkey%72") + " as review_answer_timestamp",
            )
        )

    def products(self) -> DataFrame:
        return self._read("part").selectExpr(
            "cast(p_partkey as string) as product_id",
            "case when p_partkey%61<>0 then"
            " concat(lower(p_type),'_',lower(replace(p_brand,'#','_'))) end"
            " as product_category_name",
            "cast(length(p_name) as int) as product_name_lenght",
            "cast(100+p_partkey%900 as int) as product_description_lenght",
            "cast(1+p_size%6 as int) as product_photos_qty",
            "case when p_partkey%53<>0 then cast(p_size*250 as double) end"
            " as product_weight_g",
            "cast(10+p_size as double) as product_length_cm",
            "cast(2+p_size%40 as double) as product_height_cm",
            "cast(8+p_partkey%45 as double) as product_width_cm",
        )

    def product_categories(self) -> DataFrame:
        return (
            self._read("part")
            .filter("p_type <> 'PROMO'")
            .selectExpr("concat(lower(p_type),'_',lower(replace(p_brand,'#','_'))) as cat")
            .distinct()
            .selectExpr(
                "cat as product_category_name",
                "concat('en_',cat) as product_category_name_english",
            )
        )
