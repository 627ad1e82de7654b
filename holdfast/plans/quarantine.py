"""Splits raw rows by the row-level checks: what may go on to staging, and the rest with reasons.

Every row gets the list of all checks it violates, in one pass over its table. Checks that
look beyond the row (repeated keys, missing parents, broken identities) first shrink to a
row per key; keys that repeat are few, and a hot one crosses the join as one row that
adaptive execution spreads over the copies.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.functions.dates import moment, truncated_days
from holdfast.plans.quality import CHECKS
from holdfast.session import settle

REASONS = "violations"


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    """``rows``, written with a number, and ``_again``: whether a row before it has its key.

    Rows without a key have none of their own, so each of them counts as repeated.
    """
    numbered = settle(rows.withColumn("_number", F.monotonically_increasing_id()))
    first = numbered.groupBy(F.col(key).alias("_first_key")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_number").alias("_first")
    )
    several = first.where((F.col("_n") > 1) & F.col("_first_key").isNotNull())
    again = F.col(key).isNull() | F.coalesce(F.col("_number") > F.col("_first"), F.lit(False))
    joined = numbered.join(several, F.col(key) == F.col("_first_key"), "left")
    return joined.select(*rows.columns, again.alias("_again"))


def _without_parent(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_orphan``; a row without a key has no parent."""
    known = parents.where(F.col(key).isNotNull()).select(F.col(key).alias("_parent")).distinct()
    return rows.join(known, F.col(key) == F.col("_parent"), "left").select(
        *rows.columns, F.col("_parent").isNull().alias("_orphan")
    )


def _broken(rows: DataFrame, key: str, person: str) -> DataFrame:
    """``rows`` with ``_broken``: whether their key belongs to several persons."""
    people = rows.groupBy(F.col(key).alias("_id")).agg(F.min(person).alias("_a"), F.max(person).alias("_b"))
    bad = people.where(F.col("_a") != F.col("_b")).select("_id")
    return rows.join(bad, F.col(key) == F.col("_id"), "left").select(*rows.columns, F.col("_id").isNotNull().alias("_broken"))


def _judged(tables: Mapping[str, DataFrame], name: str, as_of: datetime | None) -> tuple[DataFrame, dict[str, Column]]:
    """The rows of a table with what their checks need, and the checks."""
    rows = tables[name]
    now = F.localtimestamp() if as_of is None else moment(as_of)
    if name == "orders":
        bought, arrived = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
        return _repeated(rows, "order_id"), {
            "duplicate_pk_orders": F.col("_again"),
            "delivered_before_purchased": arrived < bought,
            "future_purchase_timestamp": bought > now,
            "late_delivery_outliers": truncated_days(bought, arrived) > fixed.LATE_DELIVERY_DAYS,
        }
    if name in ("products", "sellers"):
        return _repeated(rows, f"{name[:-1]}_id"), {f"duplicate_pk_{name}": F.col("_again")}
    if name == "customers":
        return _broken(rows, "customer_id", "customer_unique_id"), {"customer_identity_consistency": F.col("_broken")}
    own = {
        "items": {"orphan_fk_order_items": F.col("_orphan"), "negative_price": F.col("price") < 0, "negative_freight_value": F.col("freight_value") < 0},
        "payments": {"orphan_fk_payments": F.col("_orphan"), "negative_payment_value": F.col("payment_value") < 0},
        "reviews": {"orphan_fk_reviews": F.col("_orphan"), "review_score_out_of_range": ~F.col("review_score").between(1, 5)},
    }
    if name not in own:
        raise ValueError(f"no checks on rows of {name!r}; there are some on orders, products, sellers, customers, {', '.join(own)}")
    return _without_parent(rows, tables["orders"], "order_id"), own[name]


def judge(tables: Mapping[str, DataFrame], name: str, as_of: datetime | None = None) -> DataFrame:
    """All rows of table ``name`` with ``violations``, the names of the checks that each violates.

    A check on a missing value is not violated. Of rows with one key the first counts as the
    original. ``as_of`` is the time after which a purchase is in the future, now by default.
    """
    rows, checks = _judged(tables, name, as_of)
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    return rows.withColumn(REASONS, reasons).select(*tables[name].columns, REASONS)


def quarantine(
    tables: Mapping[str, DataFrame], name: str, as_of: datetime | None = None, severities: tuple[str, ...] = ("critical",)
) -> tuple[DataFrame, DataFrame]:
    """Rows that may go on, without reasons, and rows held back by a check of a given severity, with all reasons."""
    judged = settle(judge(tables, name, as_of))
    grave = [n for n, (severity, _) in CHECKS.items() if severity in severities]
    held = F.arrays_overlap(REASONS, F.array(*[F.lit(n) for n in grave]))
    return judged.where(~held).drop(REASONS), judged.where(held)


def counts(judged: DataFrame) -> DataFrame:
    """Violating rows per check."""
    return judged.select(F.explode(REASONS).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("violation_count"))

