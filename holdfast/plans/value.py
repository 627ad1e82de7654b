"""Customer value: scoring snapshot, revenue at risk, tiers, listing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.functions.dates import floored_days, moment
from holdfast.operators.ordered import fixed_buckets, page, prefix, quantile_buckets, quantile_list
from holdfast.plans.features import feature_table, require_unique
from holdfast.session import settle

ID, PROBABILITY, RISK = "customer_unique_id", "predicted_churn_probability", "revenue_at_risk"


def scoring_snapshot(raw: Mapping, day: datetime, **options) -> DataFrame:
    """Features of every customer at the end of the data.

    Labels are dropped: with no future to look at, everybody would seem churned.
    """
    return feature_table(raw, [day], **options).drop("churned", "days_to_next_purchase")


def revenue_at_risk(
    scored: DataFrame, segments: DataFrame | None = None, costs: DataFrame | None = None
) -> DataFrame:
    """Value times churn probability per customer, with segment, costs and the caveat."""
    result = scored.select(
        ID,
        F.col("lifetime_revenue").alias("customer_value"),
        PROBABILITY,
        (F.col("lifetime_revenue") * F.col(PROBABILITY)).alias(RISK),
    )
    for extra in (segments, costs):
        if extra is not None:
            # checked and joined from the written table: computed once
            result = result.join(require_unique(settle(extra), [ID]), ID, "left")
    return result.withColumn("caveat", F.lit(fixed.MODEL_CAVEAT))


def check_scores(result: DataFrame) -> DataFrame:
    """``result``, or an error if a risk is missing, a probability is off or an id repeats."""
    bad = result.groupBy().agg(
        F.count_if(F.col(RISK).isNull()).alias("nulls"),
        F.count_if(~F.coalesce(F.col(PROBABILITY).between(0, 1), F.lit(False))).alias("range"),
        (F.count(F.lit(1)) - F.count_distinct(ID)).alias("repeats"),
    ).first()
    if bad["nulls"]:
        raise ValueError(f"Null values in {RISK}: {bad['nulls']}")
    if bad["range"]:
        raise ValueError(f"{PROBABILITY} out of [0,1]: {bad['range']}")
    if bad["repeats"]:
        raise ValueError(f"Duplicate {ID}: {bad['repeats']}")
    return result


def risk_tiers(
    result: DataFrame,
    cutoffs: Sequence[float] = tuple(fixed.RISK_EDGES),
    labels: Sequence[str] = tuple(fixed.RISK_LABELS),
) -> DataFrame:
    """Adds ``risk_tier``, cut at exact quantiles of the churn probability."""
    return quantile_buckets(result, PROBABILITY, cutoffs, labels, "risk_tier")


def score_customers(
    scored: DataFrame, segments: DataFrame | None = None, costs: DataFrame | None = None
) -> DataFrame:
    """The scored table: revenue at risk, checked and tiered.

    Written once before the checks and quantiles, each of which is a job of its own.
    """
    return risk_tiers(check_scores(settle(revenue_at_risk(scored, segments, costs))))


def tenure_skew(scored: DataFrame, events: DataFrame, as_of: datetime, quarters: int = 4) -> DataFrame:
    """Churn probability by quartile of time since the first purchase, newest first.

    Quartiles with equal edges fall together.
    """
    first = events.groupBy(ID).agg(F.min("order_purchase_timestamp").alias("first_purchase"))
    days = floored_days(F.col("first_purchase"), moment(as_of))
    rows = settle(
        scored.select(ID, PROBABILITY)
        .join(first, ID, "left")
        .select(ID, PROBABILITY, days.alias("days_since_first_purchase"))
    )
    steps = [i / quarters for i in range(quarters + 1)]
    edges = sorted(set(quantile_list(rows, "days_since_first_purchase", steps)))
    labels = [f"q{i + 1}" for i in range(len(edges) - 1)]
    bucket = fixed_buckets(F.col("days_since_first_purchase"), edges, labels)
    bucketed = rows.withColumn("tenure_bucket", bucket).where(F.col("tenure_bucket").isNotNull())
    spread = bucketed.groupBy("tenure_bucket").agg(
        F.avg(PROBABILITY).alias("mean"),
        F.stddev_samp(PROBABILITY).alias("std"),
        F.count(PROBABILITY).alias("n"),
    )
    middle = _median_by(bucketed, "tenure_bucket")
    return spread.join(middle, "tenure_bucket").orderBy("tenure_bucket")


def _median_by(rows: DataFrame, group: str) -> DataFrame:
    ranked = prefix(rows, PROBABILITY, [group])
    # the two middle ranks coincide for an odd count
    low, high = F.floor((F.col("total_n") - 1) / 2), F.ceil((F.col("total_n") - 1) / 2)

    def holds(rank):
        return (F.col("before_n") <= rank) & (rank < F.col("before_n") + F.col("n"))

    return (
        ranked.where(holds(low) | holds(high))
        .groupBy(group)
        .agg(((F.min(PROBABILITY) + F.max(PROBABILITY)) / 2).alias("median"))
    )


def list_customers(
    scored: DataFrame,
    risk_tier: str | None = None,
    segment: str | None = None,
    min_revenue_at_risk: float | None = None,
    limit: int = 50,
    offset: int = 0,
) -> tuple[int, DataFrame]:
    """The number of matching customers and one page of them, by id."""
    matching = scored
    if risk_tier is not None:
        matching = matching.where(F.col("risk_tier") == risk_tier)
    if segment is not None:
        matching = matching.where(F.col("segment") == segment)
    if min_revenue_at_risk is not None:
        matching = matching.where(F.col(RISK) >= min_revenue_at_risk)
    return matching.count(), page(matching, ID, limit, offset)


def get_customer(scored: DataFrame, customer_id) -> DataFrame:
    """One customer's row; an unknown id is a ``LookupError``."""
    row = scored.where(F.col(ID) == F.lit(customer_id)).limit(1)
    if row.isEmpty():
        raise LookupError(f"No customer {customer_id!r}")
    return row


def get_customers(scored: DataFrame, ids: DataFrame) -> DataFrame:
    """All customers on a list of ids."""
    return scored.join(ids.select(ID), ID, "left_semi")

