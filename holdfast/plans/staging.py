"""Raw tables to clean ones, at fixed grains.

Column names are canonical throughout: ``customer_unique_id`` is the person,
``customer_id`` only names one order's customer record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.functions.amounts import cents
from holdfast.functions.dates import floored_days, truncated_days
from holdfast.operators.modes import modes_by


def stage_orders(orders: DataFrame, late_days: int = fixed.LATE_DELIVERY_DAYS) -> DataFrame:
    """Adds delivery status, whole delivery days and the late-delivery flag."""
    delivered = F.col("order_delivered_customer_date")
    days = truncated_days(F.col("order_purchase_timestamp"), delivered)
    return (
        orders.withColumn(
            "delivery_status",
            F.when(delivered.isNotNull(), "delivered")
            .when(F.col("order_status") == "canceled", "canceled")
            .otherwise("in_progress_or_undelivered"),
        )
        .withColumn("delivery_days", days)
        .withColumn("late_delivery_outlier", F.col("delivery_days") > late_days)
    )


def stage_products(
    products: DataFrame,
    translation: DataFrame,
    overrides: dict[str, str] = fixed.CATEGORY_OVERRIDES,
) -> DataFrame:
    """Adds the English category: translated, else agreed by hand, else ``unknown``."""
    name = F.col("product_category_name")
    by_hand = F.lit(None).cast("string")
    for source, english in overrides.items():
        by_hand = F.when(name == source, english).otherwise(by_hand)
    return products.join(
        translation.select("product_category_name", "product_category_name_english"),
        "product_category_name",
        "left",
    ).select(
        *[c for c in products.columns if c != "product_category_name"],
        F.coalesce("product_category_name_english", by_hand, F.lit("unknown")).alias(
            "product_category_english"
        ),
    )


def pass_through(table: DataFrame) -> DataFrame:
    """Customers, items, payments, reviews and sellers need no cleaning."""
    return table.select(*table.columns)


def resolved_orders(staged_orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the person behind them; orders of unknown customers are dropped."""
    identity = customers.select("customer_id", "customer_unique_id")
    return staged_orders.join(identity, "customer_id")


def purchase_events(resolved: DataFrame) -> DataFrame:
    """What counts as one purchase: a person and a moment, however many orders it was split into."""
    return resolved.groupBy("customer_unique_id", "order_purchase_timestamp").agg(
        F.min("order_id").alias("representative_order_id")
    )


def order_values(items: DataFrame) -> DataFrame:
    """Order total in cents, one row per order."""
    return items.groupBy("order_id").agg(
        (
            F.coalesce(F.sum(cents(F.col("price"))), F.lit(0))
            + F.coalesce(F.sum(cents(F.col("freight_value"))), F.lit(0))
        ).alias("order_total_cents")
    )


def order_payments(payments: DataFrame) -> DataFrame:
    """Amount paid in cents, mean instalments and most frequent type, one row per order."""
    per_type = payments.groupBy("order_id", "payment_type").agg(
        F.count("payment_type").alias("_n"),
        F.sum(cents(F.col("payment_value"))).alias("_paid"),
        F.sum(F.col("payment_installments").cast("bigint")).alias("_parts"),
        F.count("payment_installments").alias("_parts_n"),
    )
    # dealt by order at once: rows of an order lie in several partitions, so nothing would combine before
    return per_type.repartition("order_id").groupBy("order_id").agg(
        F.coalesce(F.sum("_paid"), F.lit(0)).alias("payment_cents"),
        F.try_divide(F.sum("_parts").cast("double"), F.sum("_parts_n")).alias("installments_mean"),
        F.min(F.struct((-F.col("_n")).alias("r"), "payment_type"))["payment_type"].alias(
            "payment_type_mode"
        ),
    )


def order_reviews(reviews: DataFrame) -> DataFrame:
    """Mean review score, one row per order."""
    score = F.col("review_score").cast("bigint")
    return reviews.groupBy("order_id").agg(
        F.try_divide(F.sum(score).cast("double"), F.count(score)).alias("review_score")
    )


def order_children(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """``order_values`` and ``order_reviews`` of each order that has either, from one exchange."""
    priced = items.select(
        "order_id", cents(F.col("price")).alias("_price"), cents(F.col("freight_value")).alias("_freight"), F.lit(1).alias("_item")
    )
    rows = priced.unionByName(
        reviews.select("order_id", F.col("review_score").cast("bigint").alias("_score")), allowMissingColumns=True
    )
    total = F.coalesce(F.sum("_price"), F.lit(0)) + F.coalesce(F.sum("_freight"), F.lit(0))
    return rows.groupBy("order_id").agg(
        F.when(F.count("_item") > 0, total).alias("order_total_cents"),
        F.try_divide(F.sum("_score").cast("double"), F.count("_score")).alias("review_score"),
    )


def order_summary(
    resolved: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """One row per order. Every child is brought to order grain before it is joined,
    so three items and two payments stay one order."""
    delay = floored_days(F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date"))
    joined = (
        resolved.withColumn("delivery_delay_days", delay)
        .join(order_children(items, reviews), "order_id", "left")
        .join(order_payments(payments), "order_id", "left")
    )
    return joined.select(*[c for c in joined.columns if c != "review_score"], "review_score")


def item_summary(items: DataFrame, staged_products: DataFrame, resolved: DataFrame) -> DataFrame:
    """Items with price in cents, product category, seller, buyer and time.

    One exchange, for the orders; a best-seller or a giant order is split by the
    adaptive skew join, and what follows groups by other keys anyway.
    """
    priced = items.select(
        "order_id",
        "product_id",
        "seller_id",
        F.coalesce(cents(F.col("price")), F.lit(0)).alias("price_cents"),
    )
    owners = resolved.select("order_id", "customer_unique_id", "order_purchase_timestamp")
    categories = staged_products.select("product_id", "product_category_english")
    return priced.join(owners, "order_id").join(categories, "product_id", "left")


def customer_geography(customers: DataFrame) -> DataFrame:
    """One state and one city per person: the most frequent of each on its own, ties to the smallest."""
    return modes_by(customers, ["customer_unique_id"], ["customer_state", "customer_city"])
