"""Business exploration: who buys, where the money comes from, when."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.amounts import cents, from_cents, percent, ratio
from holdfast.operators.ordered import leading_sums, quantiles
from holdfast.operators.profile import grand_total
from holdfast.plans.staging import order_values


def customer_revenue(resolved: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue in cents and purchase events per person with at least one item.

    Orders carry their item total before persons are formed; a person's events
    never multiply the revenue.
    """
    valued = resolved.join(order_values(items), "order_id")
    moments = valued.groupBy("customer_unique_id", "order_purchase_timestamp").agg(
        F.sum("order_total_cents").alias("revenue_cents")
    )
    spent = moments.groupBy("customer_unique_id").agg(F.sum("revenue_cents").alias("revenue_cents"))
    events = (
        resolved.groupBy("customer_unique_id", "order_purchase_timestamp")
        .agg(F.count(F.lit(1)).alias("r"))
        .groupBy("customer_unique_id")
        .agg(F.count(F.lit(1)).alias("purchase_events"))
    )
    return spent.join(events, "customer_unique_id")


def repeat_vs_onetime(revenue: DataFrame) -> DataFrame:
    """Customers and revenue of repeat and one-time buyers, with shares."""
    grouped = revenue.groupBy((F.col("purchase_events") > 1).alias("is_repeat")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("revenue_cents").alias("cents")
    )
    return grouped.select(
        "is_repeat",
        "customers",
        from_cents(F.col("cents")).alias("total_revenue"),
        ratio(from_cents(F.col("cents")), F.col("customers")).alias("avg_revenue_per_customer"),
        percent(F.col("customers"), grand_total("customers")).alias("pct_of_customers"),
        percent(F.col("cents"), grand_total("cents")).alias("pct_of_revenue"),
    )


def pareto(revenue: DataFrame, percents: Sequence[int], value: str = "revenue_cents") -> DataFrame:
    """Share of revenue held by the top n percent, whole rows only."""
    takes = {str(p): F.floor(F.col("total_n") * p / 100) for p in percents}
    sums = leading_sums(revenue, value, takes, name="top_pct")
    return sums.select(
        F.col("top_pct").cast("int").alias("top_pct"),
        F.col("take").alias("cutoff"),
        "total_n",
        F.coalesce(ratio(F.col("taken_sum"), F.col("total_sum")) * 100, F.lit(0.0)).alias(
            "cum_revenue_pct"
        ),
    )


def seller_revenue(items: DataFrame) -> DataFrame:
    return items.groupBy("seller_id").agg(
        F.sum(cents(F.col("price")) + cents(F.col("freight_value"))).alias("revenue_cents"),
        F.count(F.lit(1)).alias("items_sold"),
    )


def value_quantiles(revenue: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    return quantiles(revenue, "revenue_cents", probabilities).select(
        "probability", from_cents(F.col("quantile")).alias("revenue")
    )


def revenue_by_state(resolved: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Customers, revenue, share and revenue per customer of each state."""
    states = customers.select("customer_id", "customer_state")
    per_person = (
        resolved.join(order_values(items), "order_id")
        .join(states, "customer_id")
        .groupBy("customer_state", "customer_unique_id")
        .agg(F.sum("order_total_cents").alias("cents"))
    )
    grouped = per_person.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("cents").alias("cents")
    )
    return grouped.select(
        "customer_state",
        "customers",
        from_cents(F.col("cents")).alias("total_revenue"),
        percent(F.col("cents"), grand_total("cents")).alias("pct_of_revenue"),
        F.round(ratio(from_cents(F.col("cents")), F.col("customers")), 2).alias(
            "avg_revenue_per_customer"
        ),
    ).orderBy(F.col("total_revenue").desc(), "customer_state")


def revenue_by_category(items: DataFrame, staged_products: DataFrame, top: int = 15) -> DataFrame:
    """The ``top`` categories by product revenue and their share of all product revenue.

    Items shrink to one row per product before the join, so a best-seller is one row.
    """
    per_product = items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("price"))).alias("cents")
    )
    total = per_product.groupBy().agg(F.sum("cents")).scalar()
    return (
        per_product.join(
            staged_products.select("product_id", "product_category_english"), "product_id"
        )
        .groupBy("product_category_english")
        .agg(F.sum("n").alias("items_sold"), F.sum("cents").alias("cents"))
        .orderBy(F.col("cents").desc(), "product_category_english")
        .limit(top)
        .select(
            "product_category_english",
            "items_sold",
            from_cents(F.col("cents")).alias("total_product_revenue"),
            percent(F.col("cents"), total).alias("pct_of_revenue"),
        )
    )


def payment_behavior(payments: DataFrame) -> DataFrame:
    """Payments, value, mean instalments and share of each payment type."""
    grouped = payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(cents(F.col("payment_value"))).alias("cents"),
        F.sum(F.col("payment_installments").cast("bigint")).alias("parts"),
        F.count("payment_installments").alias("parts_n"),
    )
    return grouped.select(
        "payment_type",
        "n",
        from_cents(F.col("cents")).alias("total_value"),
        ratio(F.col("parts"), F.col("parts_n")).alias("avg_installments"),
        percent(F.col("n"), grand_total("n")).alias("pct_of_payments"),
    ).orderBy(F.col("total_value").desc(), "payment_type")


def late_vs_review(staged_orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean review score and reviews of late and other deliveries.

    Reviews shrink to sums per order before the join.
    """
    per_order = reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("review_score").cast("bigint")).alias("score"),
        F.count("review_score").alias("scored"),
    )
    delivered = staged_orders.where(F.col("delivery_status") == "delivered")
    return (
        delivered.select("order_id", "late_delivery_outlier", "delivery_status")
        .join(per_order, "order_id")
        .groupBy("late_delivery_outlier", "delivery_status")
        .agg(
            ratio(F.sum("score"), F.sum("scored")).alias("avg_review_score"),
            F.sum("n").alias("n_orders"),
        )
    )


def monthly_revenue(staged_orders: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue and orders with items per calendar month, in order."""
    bought = F.col("order_purchase_timestamp")
    month = F.date_trunc("month", bought).cast("timestamp_ntz")
    return (
        staged_orders.select("order_id", month.alias("month"))
        .join(order_values(items), "order_id")
        .groupBy("month")
        .agg(
            from_cents(F.sum("order_total_cents")).alias("revenue"),
            F.count(F.lit(1)).alias("orders"),
        )
        .orderBy("month")
    )
