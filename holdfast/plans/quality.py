"""The data-quality checks and the gate in front of staging.

Checks over one table share one aggregate; only orphans, identities, cart splits
and category coverage need a plan of their own.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.functions.dates import moment, truncated_days
from holdfast.operators.profile import orphans, unpivot_row
from holdfast.plans.staging import resolved_orders

CRITICAL, WARNING = "critical", "warning"

# Check names, severities and descriptions.
CHECKS = {
    "duplicate_pk_orders": (CRITICAL, "Duplicate order_id in orders"),
    "duplicate_pk_products": (CRITICAL, "Duplicate product_id in products"),
    "duplicate_pk_sellers": (CRITICAL, "Duplicate seller_id in sellers"),
    "orphan_fk_order_items": (CRITICAL, "order_items rows whose order_id has no matching order"),
    "orphan_fk_payments": (CRITICAL, "payments rows whose order_id has no matching order"),
    "orphan_fk_reviews": (CRITICAL, "reviews rows whose order_id has no matching order"),
    "negative_price": (CRITICAL, "order_items.price < 0"),
    "negative_freight_value": (CRITICAL, "order_items.freight_value < 0"),
    "negative_payment_value": (CRITICAL, "payments.payment_value < 0"),
    "delivered_before_purchased": (CRITICAL, "delivery date earlier than purchase timestamp"),
    "future_purchase_timestamp": (CRITICAL, "purchase timestamp later than the as-of time"),
    "review_score_out_of_range": (CRITICAL, "review_score outside 1-5"),
    "customer_identity_consistency": (
        CRITICAL,
        "customer_id mapping to more than one customer_unique_id",
    ),
    "late_delivery_outliers": (WARNING, "deliveries past the 99th-percentile threshold"),
    "same_timestamp_order_pairs": (
        WARNING,
        "same person with several orders at the exact same purchase timestamp",
    ),
    "uncategorized_products": (WARNING, "product categories with no match in the translation table"),
}


class QualityGateError(RuntimeError):
    """A critical check failed."""


def _repeats(key: str) -> Column:
    return F.count(F.lit(1)) - F.count_distinct(key)


def _counts(df: DataFrame, **checks: Column) -> DataFrame:
    wide = df.groupBy().agg(*[c.alias(name) for name, c in checks.items()])
    return unpivot_row(wide, [], {n: {"violation_count": F.col(n)} for n in checks}, "name")


def _named(name: str, one_row: DataFrame) -> DataFrame:
    return one_row.toDF("violation_count").select(F.lit(name).alias("name"), "violation_count")


def run_checks(tables: dict[str, DataFrame], as_of: datetime | None = None) -> DataFrame:
    """One row per check: name, severity, description, violations, passed.

    ``as_of`` is the time after which a purchase is in the future, now by default.
    """
    t = tables
    now = F.localtimestamp() if as_of is None else moment(as_of)
    bought = F.col("order_purchase_timestamp")
    arrived = F.col("order_delivered_customer_date")
    orders, items, payments, reviews = t["orders"], t["items"], t["payments"], t["reviews"]

    identities = t["customers"].groupBy("customer_id").agg(
        F.min("customer_unique_id").alias("low"), F.max("customer_unique_id").alias("high")
    )
    moments = (
        resolved_orders(orders, t["customers"])
        .groupBy("customer_unique_id", "order_purchase_timestamp")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = t["products"].where(F.col("product_category_name").isNotNull())
    categories = named.groupBy("product_category_name").agg(F.count(F.lit(1)).alias("n"))
    uncovered = categories.join(t["translation"], "product_category_name", "left_anti")

    parts = [
        _counts(
            orders,
            duplicate_pk_orders=_repeats("order_id"),
            delivered_before_purchased=F.count_if(arrived < bought),
            future_purchase_timestamp=F.count_if(bought > now),
            late_delivery_outliers=F.count_if(
                truncated_days(bought, arrived) > fixed.LATE_DELIVERY_DAYS
            ),
        ),
        _counts(t["products"], duplicate_pk_products=_repeats("product_id")),
        _counts(t["sellers"], duplicate_pk_sellers=_repeats("seller_id")),
        _counts(
            items,
            negative_price=F.count_if(F.col("price") < 0),
            negative_freight_value=F.count_if(F.col("freight_value") < 0),
        ),
        _counts(payments, negative_payment_value=F.count_if(F.col("payment_value") < 0)),
        _counts(
            reviews, review_score_out_of_range=F.count_if(~F.col("review_score").between(1, 5))
        ),
        _named("orphan_fk_order_items", orphans(items, orders, "order_id")),
        _named("orphan_fk_payments", orphans(payments, orders, "order_id")),
        _named("orphan_fk_reviews", orphans(reviews, orders, "order_id")),
        _counts(
            identities, customer_identity_consistency=F.count_if(F.col("low") != F.col("high"))
        ),
        _counts(moments, same_timestamp_order_pairs=F.count_if(F.col("n") > 1)),
        _counts(uncovered, uncategorized_products=F.coalesce(F.sum("n"), F.lit(0))),
    ]
    counts = reduce(DataFrame.unionByName, parts)
    severity, description = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (level, text) in CHECKS.items():
        severity = F.when(F.col("name") == name, level).otherwise(severity)
        description = F.when(F.col("name") == name, text).otherwise(description)
    return counts.select(
        "name",
        severity.alias("severity"),
        description.alias("description"),
        F.col("violation_count").cast("bigint").alias("violation_count"),
        (F.col("violation_count") == 0).alias("passed"),
    )


def gate_failures(results: DataFrame) -> DataFrame:
    return results.where((F.col("severity") == CRITICAL) & ~F.col("passed"))


def any_critical_failed(results: DataFrame) -> bool:
    return not gate_failures(results).isEmpty()


def gate(results: DataFrame) -> None:
    """Raise unless every critical check passed."""
    failed = [f"{r['name']} ({r['violation_count']})" for r in gate_failures(results).collect()]
    if failed:
        raise QualityGateError("Critical checks failed, staging must not go on: " + ", ".join(sorted(failed)))


def report(results: DataFrame, run_at: datetime) -> str:
    """The results (one row per check) as a Markdown report."""
    rows = {r["name"]: r for r in results.collect()}
    out = ["# Data quality", "", f"Run at: {run_at.isoformat(timespec='seconds')}"]
    failed = False
    for level, good in ((CRITICAL, "PASS"), (WARNING, "clean")):
        out += ["", f"## {level.capitalize()} checks", "", "| Check | Violations | Status |", "|---|---|---|"]
        for name in CHECKS:
            row = rows[name]
            if row["severity"] != level:
                continue
            n = row["violation_count"]
            bad = "**FAIL**" if level == CRITICAL else f"{n} flagged"
            failed = failed or (level == CRITICAL and n > 0)
            out.append(f"| {name}: {row['description']} | {n} | {good if n == 0 else bad} |")
    out += ["", "## Overall: " + ("FAIL, a critical check failed" if failed else "PASS"), ""]
    return "\n".join(out)
