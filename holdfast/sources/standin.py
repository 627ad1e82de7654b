"""Binds the retail test tables to the canonical columns.

The test tables hold orders, lines, parts and suppliers. They stand in for the
customer-retention tables; the mapping has no business meaning. Money is built
from whole cents, so it is exact on every engine.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_VALID_DATE = datetime(2001, 8, 1)
SPLITS = {
    datetime(1995, 7, 1): "train",
    datetime(1995, 8, 1): "train",
    datetime(1995, 9, 1): "train",
    datetime(1995, 10, 1): "train",
    datetime(1995, 11, 1): "train",
    datetime(1995, 12, 1): "train",
    datetime(1996, 1, 1): "validation",
    datetime(1996, 2, 1): "validation",
    datetime(1996, 3, 1): "test",
}
SNAPSHOTS = sorted(SPLITS)
TRANSLATION = {"STANDARD": "standard", "ECONOMY": "economy", "LARGE": "large", "SMALL": "small"}
OVERRIDES = {"PROMO": "promotion"}


SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table under its declared schema, which saves a job to look it up."""
    declared = " ".join(SCHEMAS[table].split())
    return spark.read.schema(declared).parquet(f"{folder}/{table}.parquet")


def _whole(column: Column) -> Column:
    """A double with two decimals as whole hundredths."""
    return F.floor(column * 100 + F.lit(0.5))


def _share_of_cents(percent: Column) -> Column:
    """Percent of the extended price, rounded half up to whole cents."""
    tenths = _whole(F.col("l_extendedprice")) * percent + 50
    return F.floor(tenths / 100)


def _money(whole_cents: Column) -> Column:
    return whole_cents / F.lit(100.0)


class Tables(Mapping):
    """The canonical tables of a folder, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder, self._built = spark, folder, {}

    def __getitem__(self, name: str):
        if name == "overrides":
            return OVERRIDES
        if name not in self._built:
            self._built[name] = _BUILDERS[name](self)
        return self._built[name]

    def __iter__(self):
        return iter([*_BUILDERS, "overrides"])

    def __len__(self):
        return len(_BUILDERS) + 1

    def file(self, table: str) -> DataFrame:
        key = ("file", table)
        if key not in self._built:
            self._built[key] = read(self._spark, self._folder, table)
        return self._built[key]

    def lines_with_buyer(self) -> DataFrame:
        buyers = self.file("orders").select("o_orderkey", "o_custkey")
        return self.file("lineitem").join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))


def tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder)


def _customers(t: Tables) -> DataFrame:
    nations = t.file("nation").select("n_nationkey", "n_name")
    buyers = t.file("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.file("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("customer_id"),
        F.col("o_custkey").alias("customer_unique_id"),
        F.col("n_name").alias("customer_state"),
        F.col("o_orderpriority").alias("customer_city"),
    )


def _orders(t: Tables) -> DataFrame:
    shipped = t.file("lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("delivered"))
    return (
        t.file("orders")
        .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.col("delivered").alias("order_delivered_customer_date"),
            (F.col("o_orderdate") + F.expr("INTERVAL '30' DAY")).alias(
                "order_estimated_delivery_date"
            ),
        )
    )


def _items(t: Tables) -> DataFrame:
    return t.file("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        _money(_share_of_cents(100 - _whole(F.col("l_discount")))).alias("price"),
        _money(_share_of_cents(_whole(F.col("l_tax")))).alias("freight_value"),
    )


def _payments(t: Tables) -> DataFrame:
    return t.file("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        _money(_whole(F.col("l_extendedprice"))).alias("payment_value"),
    )


def _reviews(t: Tables) -> DataFrame:
    return (
        t.file("lineitem")
        .where(F.col("l_linestatus") == "F")
        .select(
            F.col("l_linenumber").alias("review_id"),
            F.col("l_orderkey").alias("order_id"),
            (F.col("l_linenumber") % 5 + 1).alias("review_score"),
        )
    )


def _products(t: Tables) -> DataFrame:
    return t.file("part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")
    )


def _sellers(t: Tables) -> DataFrame:
    return t.file("supplier").select(
        F.col("s_suppkey").alias("seller_id"), F.col("s_nationkey").alias("seller_state")
    )


def _tickets(t: Tables) -> DataFrame:
    escalated = (F.col("l_linestatus") != "F") & (F.col("l_discount") > 0.07)
    return (
        t.lines_with_buyer()
        .where(F.col("l_returnflag") == "R")
        .select(
            F.col("o_custkey").alias("customer_unique_id"),
            F.col("l_shipdate").alias("created_at"),
            (F.col("l_linestatus") == "F").alias("resolved"),
            escalated.alias("escalated"),
            F.col("l_quantity").alias("resolution_hours"),
            (F.col("l_linenumber") % 5 + 1).alias("customer_satisfaction"),
        )
    )


def _campaigns(t: Tables) -> DataFrame:
    opened = F.col("l_linestatus") == "O"
    clicked = opened & (F.col("l_discount") > 0.05)
    return (
        t.lines_with_buyer()
        .where(F.col("l_returnflag") == "A")
        .select(
            F.col("o_custkey").alias("customer_unique_id"),
            F.col("l_shipdate").alias("campaign_date"),
            F.expr("element_at(array('email', 'sms', 'push'), l_linenumber % 3 + 1)").alias("channel"),
            opened.alias("opened"),
            clicked.alias("clicked"),
            (clicked & (F.col("l_tax") > 0.04)).alias("converted"),
        )
    )


def _interventions(t: Tables) -> DataFrame:
    kinds = "'discount_offer', 'personal_outreach', 'free_shipping', 'loyalty_points'"
    return (
        t.lines_with_buyer()
        .where((F.col("l_returnflag") == "N") & (F.col("l_quantity") > 45))
        .select(
            F.col("o_custkey").alias("customer_unique_id"),
            F.col("l_shipdate").alias("created_at"),
            F.expr(f"element_at(array({kinds}), l_linenumber % 4 + 1)").alias("intervention_type"),
        )
    )


def _translation(t: Tables) -> DataFrame:
    """A lookup that leaves two types out; one of them has an agreed name."""
    known = F.create_map(*[F.lit(x) for pair in TRANSLATION.items() for x in pair])
    return (
        _products(t)
        .select("product_category_name")
        .distinct()
        .withColumn("product_category_name_english", F.try_element_at(known, "product_category_name"))
        .where(F.col("product_category_name_english").isNotNull())
    )


_BUILDERS = {
    "customers": _customers,
    "orders": _orders,
    "items": _items,
    "payments": _payments,
    "reviews": _reviews,
    "products": _products,
    "sellers": _sellers,
    "translation": _translation,
    "tickets": _tickets,
    "campaigns": _campaigns,
    "interventions": _interventions,
}


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    """The event log as purchase moments with sub-day times."""
    return read(spark, folder, "events").select(
        F.col("user_id").alias("customer_unique_id"), F.col("ts").alias("order_purchase_timestamp")
    )
