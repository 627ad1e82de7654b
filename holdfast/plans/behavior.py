"""Rules derived from what customers did: tiers, costs, propensities, eligibility."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.functions.amounts import cents, from_cents, ratio
from holdfast.functions.dates import floored_days, moment
from holdfast.operators.ordered import percentile_rank, quantile_list
from holdfast.plans.staging import order_reviews, order_values
from holdfast.session import settle


def behavior_summary(
    resolved: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    voucher: str = "voucher",
) -> DataFrame:
    """One row per person: purchase span, orders, delivery, reviews, revenue, vouchers.

    A missing mean review takes the median over all persons who have one.
    """
    vouchers = payments.groupBy("order_id").agg(
        F.max((F.col("payment_type") == voucher).cast("int")).alias("has_voucher")
    )
    score = F.col("review_score")
    per_person = (
        resolved.join(order_values(items), "order_id", "left")
        .join(order_reviews(reviews), "order_id", "left")
        .join(vouchers, "order_id", "left")
        .groupBy("customer_unique_id")
        .agg(
            F.min("order_purchase_timestamp").alias("first_purchase"),
            F.max("order_purchase_timestamp").alias("last_purchase"),
            F.count(F.lit(1)).alias("n_orders"),
            ratio(F.sum(F.col("delivery_days").cast("bigint")), F.count("delivery_days")).alias(
                "avg_delivery_days"
            ),
            F.count_if("late_delivery_outlier").alias("n_late_deliveries"),
            # rounded, so the mean does not depend on the order of summation
            F.round(F.avg(score), 9).alias("avg_review_score"),
            F.sum(F.coalesce("order_total_cents", F.lit(0))).alias("revenue_cents"),
            F.sum(F.coalesce("has_voucher", F.lit(0)).cast("bigint")).alias("n_voucher_payments"),
        )
    )
    # one row per person: written once, then read for the median and by all callers
    per_person = settle(per_person)
    typical = quantile_list(per_person, "avg_review_score", [0.5])[0]
    filled = F.coalesce("avg_review_score", F.lit(typical).cast("double"))
    return per_person.withColumn("avg_review_score", filled).withColumn(
        "total_revenue", from_cents(F.col("revenue_cents"))
    )


def revenue_summary(resolved: DataFrame, items: DataFrame) -> DataFrame:
    """One row per person with the revenue of ``behavior_summary`` alone, which tiers and costs
    ask for: no reviews, payments or medians. Written once."""
    return settle(
        resolved.select("order_id", "customer_unique_id")
        .join(order_values(items), "order_id", "left")
        .groupBy("customer_unique_id")
        .agg(F.sum(F.coalesce("order_total_cents", F.lit(0))).alias("revenue_cents"))
    )


def revenue_percentile(behavior: DataFrame) -> DataFrame:
    """Adds the average percentile rank of revenue."""
    return percentile_rank(behavior, "revenue_cents", "revenue_percentile")


def support_propensity(behavior: DataFrame) -> DataFrame:
    """Ticket probability: a base rate, raised by late deliveries and poor reviews."""
    late = F.least(F.col("n_late_deliveries") * 0.15, F.lit(0.5))
    unhappy = F.greatest((F.lit(3.5) - F.col("avg_review_score")) * 0.08, F.lit(0.0))
    return behavior.withColumn(
        "ticket_probability", F.least(F.lit(0.08) + late + unhappy, F.lit(0.85))
    )


def campaign_intensity(ranked: DataFrame) -> DataFrame:
    """Expected number of campaign touches, rising with the revenue percentile."""
    return ranked.withColumn("expected_campaigns", F.lit(2.0) + F.col("revenue_percentile") * 4)


def value_tiers(ranked: DataFrame) -> DataFrame:
    """Customer tier, segment and strategic flag from the revenue percentile."""
    tier, segment = None, None
    for name, floor in fixed.TIER_FLOORS.items():
        at_least = F.col("revenue_percentile") >= floor
        tier = F.when(at_least, name) if tier is None else tier.when(at_least, name)
    for name, of_tier in fixed.TIER_SEGMENT.items():
        match = F.col("customer_tier") == name
        segment = F.when(match, of_tier) if segment is None else segment.when(match, of_tier)
    return (
        ranked.withColumn("customer_tier", tier)
        .withColumn("segment", segment)
        .withColumn("strategic_account", F.col("customer_tier") == "platinum")
    )


def customer_costs(behavior: DataFrame, tickets: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Support, service and processing cost per person, beside the columns to ``keep``."""
    hours = tickets.groupBy("customer_unique_id").agg(
        F.sum(F.col("resolution_hours").cast("double")).alias("hours")
    )
    # whole cents, halves rounded up
    support = cents(F.coalesce(F.col("hours") * 1.5, F.lit(0.0)))
    service = F.floor((F.col("revenue_cents") * 3 + F.col("_support") * 50 + 50) / 100)
    processing = F.floor((F.col("revenue_cents") * 15 + 500) / 1000)
    return (
        behavior.join(hours, "customer_unique_id", "left")
        .withColumn("_support", support)
        .select(
            "customer_unique_id",
            *keep,
            from_cents(F.col("_support")).alias("support_cost"),
            from_cents(service).alias("annual_service_cost"),
            from_cents(processing).alias("estimated_processing_cost"),
        )
    )


def lapsed_customers(
    behavior: DataFrame, as_of: datetime, quiet_days: int = fixed.LAPSED_DAYS
) -> DataFrame:
    """Persons without a purchase for at least ``quiet_days`` at ``as_of``."""
    quiet = floored_days(F.col("last_purchase"), moment(as_of))
    return behavior.select("customer_unique_id", "last_purchase", quiet.alias("days_quiet")).where(
        F.col("days_quiet") >= quiet_days
    )


def event_window(
    behavior: DataFrame, max_valid: datetime, horizon_days: int = fixed.EVENT_HORIZON_DAYS
) -> DataFrame:
    """Where a person's support and campaign events may lie.

    Reaches from the first purchase over a fixed horizon, never past the data. It
    must not depend on the last purchase, which would tell about the future.
    """
    end = F.least(
        F.col("first_purchase") + F.make_dt_interval(days=F.lit(horizon_days)),
        moment(max_valid),
    )
    return behavior.select("customer_unique_id", "first_purchase", end.alias("window_end")).withColumn(
        "window_days",
        F.greatest(floored_days(F.col("first_purchase"), F.col("window_end")), F.lit(1)),
    )


def cascade_violations(campaigns: DataFrame) -> DataFrame:
    """Clicks without an open and conversions without a click."""
    return campaigns.groupBy().agg(
        F.count_if(F.col("clicked") & ~F.col("opened")).alias("clicked_unopened"),
        F.count_if(F.col("converted") & ~F.col("clicked")).alias("converted_unclicked"),
    )


def intervention_timing(
    interventions: DataFrame, behavior: DataFrame, as_of: datetime, quiet_days: int = fixed.LAPSED_DAYS
) -> DataFrame:
    """Interventions too soon after the last purchase, or after ``as_of``.

    Counted per person and moment first, so a person's many touches join as few rows.
    """
    touches = interventions.groupBy("customer_unique_id", "created_at").agg(
        F.count(F.lit(1)).alias("n")
    )
    joined = touches.join(behavior.select("customer_unique_id", "last_purchase"), "customer_unique_id")
    early = floored_days(F.col("last_purchase"), F.col("created_at")) < quiet_days
    late = F.col("created_at") > moment(as_of)
    return joined.groupBy().agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_interventions"),
        F.coalesce(F.sum(F.when(early, F.col("n"))), F.lit(0)).alias("too_early"),
        F.coalesce(F.sum(F.when(late, F.col("n"))), F.lit(0)).alias("after_as_of"),
    )


def unit_costs(events: DataFrame, kind: str, costs: dict[str, float]) -> DataFrame:
    """Number and total cost of events per channel or intervention type."""
    price = F.lit(None).cast("double")
    for name, cost in costs.items():
        price = F.when(F.col(kind) == name, F.lit(float(cost))).otherwise(price)
    return (
        events.groupBy(kind)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(kind, "n", F.round(F.col("n") * price, 2).alias("total_cost"))
    )
