"""Audit of the raw tables: dates, delivery times, identities, gaps, cart splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.functions.amounts import percent, ratio, sample_std
from holdfast.functions.dates import floored_days, moment
from holdfast.operators.neighbours import with_previous
from holdfast.operators.profile import counted_days, day_quantiles


def date_audit(orders: DataFrame, as_of) -> DataFrame:
    """Purchase date range, impossible deliveries and purchases after ``as_of``."""
    bought, arrived = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    return orders.groupBy().agg(
        F.min(bought).alias("first_purchase"),
        F.max(bought).alias("last_purchase"),
        F.count_if(arrived < bought).alias("delivered_before_purchase"),
        F.count_if(bought > moment(as_of)).alias("future_purchases"),
    )


def delivery_days(orders: DataFrame) -> DataFrame:
    days = floored_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
    return orders.select(days.alias("days")).where(F.col("days").isNotNull())


def day_distribution(days: DataFrame, value: str, probabilities: Sequence[float]) -> DataFrame:
    """One row: count, mean, deviation, extremes, negatives and exact quantiles of whole days."""
    counted = counted_days(days.where(F.col(value).isNotNull()), value)
    day, n = F.col(value).cast("bigint"), F.col("n")
    sums = counted.groupBy().agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n"),
        F.sum(day * n).alias("_sum"),
        F.sum(day * day * n).alias("_squares"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.coalesce(F.sum(F.when(day < 0, n)), F.lit(0)).alias("negative"),
        day_quantiles(value, probabilities).alias("_q"),
    )
    return sums.select(
        "n",
        ratio(F.col("_sum"), n).alias("mean"),
        sample_std(n, F.col("_sum"), F.col("_squares")).alias("std"),
        "min",
        "max",
        "negative",
        *[F.col("_q")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probabilities)],
    )


def iqr_outliers(days: DataFrame, value: str, reach: float = 1.5) -> DataFrame:
    """Threshold Q3 + reach * IQR and the rows beyond it, their share over all of ``days``.

    Works on the counted days: a short table, so a window over all of it is fine.
    """
    everything = Window.partitionBy(F.lit(0))
    counted = counted_days(days, value).withColumn(
        "_q", day_quantiles(value, [0.25, 0.75]).over(everything)
    )
    q1, q3 = F.col("_q")[0], F.col("_q")[1]
    limit = q3 + (q3 - q1) * reach
    return (
        counted.groupBy(q1.alias("q1"), q3.alias("q3"), limit.alias("threshold"))
        .agg(
            F.coalesce(F.sum(F.when(F.col(value) > limit, F.col("n"))), F.lit(0)).alias("n_over"),
            F.sum("n").alias("_rows"),
        )
        .select(
            "q1", "q3", "threshold", "n_over", percent(F.col("n_over"), F.col("_rows")).alias("pct_over")
        )
    )


def money_audit(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Negative and zero amounts, one row."""
    prices = items.groupBy().agg(
        F.count_if(F.col("price") < 0).alias("negative_price"),
        F.count_if(F.col("freight_value") < 0).alias("negative_freight"),
    )
    paid = payments.groupBy().agg(
        F.count_if(F.col("payment_value") < 0).alias("negative_payment"),
        F.count_if(F.col("payment_value") == 0).alias("zero_payment"),
    )
    return prices.select(
        "*",
        paid.select("negative_payment").scalar().alias("negative_payment"),
        paid.select("zero_payment").scalar().alias("zero_payment"),
    )


def identity_audit(customers: DataFrame) -> DataFrame:
    """Distinct order-customers and persons, their ratio, and repeat buyers."""
    pairs = customers.groupBy("customer_unique_id", "customer_id").agg(F.count(F.lit(1)).alias("r"))
    per_person = pairs.groupBy("customer_unique_id").agg(F.count("customer_id").alias("n"))
    people = per_person.groupBy().agg(
        F.count("customer_unique_id").alias("n_persons"),
        F.avg("n").alias("mean_ids"),
        F.max("n").alias("max_ids"),
        F.count_if(F.col("n") > 1).alias("repeat_persons"),
    )
    # an id may belong to two persons only if identity is broken, so count ids on their own
    ids = customers.groupBy().agg(F.count_distinct("customer_id")).scalar()
    return people.select(
        ids.alias("n_customer_ids"),
        "n_persons",
        ratio(ids, F.col("n_persons")).alias("ids_per_person"),
        "mean_ids",
        "max_ids",
        "repeat_persons",
        percent(F.col("repeat_persons"), F.col("n_persons")).alias("repeat_pct"),
    )


def gaps(rows: DataFrame, key: str, time: str, order: Sequence[str] = ()):
    """Whole days since the previous row of the same key; first rows have none."""
    linked = with_previous(rows.select(key, time, *order), key, time, order)
    days = floored_days(F.col("previous")[time], F.col(time))
    return linked.where(F.col("previous").isNotNull()).select("*", days.alias("gap_days"))


def order_gaps(resolved: DataFrame) -> DataFrame:
    """Gaps between consecutive orders of a person, cart splits included."""
    return gaps(resolved, "customer_unique_id", "order_purchase_timestamp", ["order_id"])


def event_gaps(events: DataFrame) -> DataFrame:
    """Gaps between consecutive purchase events of a person."""
    return gaps(events, "customer_unique_id", "order_purchase_timestamp", ())


def window_coverage(
    gap_rows: DataFrame, windows: Sequence[int] = tuple(fixed.COVERAGE_WINDOWS)
) -> DataFrame:
    """Share of gaps within each window and the number of gaps beyond it."""
    wide = gap_rows.groupBy().agg(
        F.count("gap_days").alias("n_gaps"),
        *[F.count_if(F.col("gap_days") <= w).alias(f"w{w}") for w in windows],
    )
    rows = F.explode(
        F.array(
            *[F.struct(F.lit(w).alias("window_days"), F.col(f"w{w}").alias("covered")) for w in windows]
        )
    ).alias("r")
    return wide.select("n_gaps", rows).select(
        "r.window_days",
        "n_gaps",
        percent(F.col("r.covered"), F.col("n_gaps")).alias("covered_pct"),
        (F.col("n_gaps") - F.col("r.covered")).alias("excluded"),
    )


def purchase_event_counts(events: DataFrame) -> DataFrame:
    """Events per person, and how many persons have more than one."""
    per_person = events.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("n"))
    summary = per_person.groupBy().agg(
        F.count(F.lit(1)).alias("n_persons"),
        F.sum("n").alias("n_events"),
        F.avg("n").alias("mean_events"),
        F.max("n").alias("max_events"),
        F.count_if(F.col("n") > 1).alias("repeat_persons"),
    )
    return summary.withColumn("repeat_pct", percent(F.col("repeat_persons"), F.col("n_persons")))


def repeat_customer_rows(resolved: DataFrame) -> DataFrame:
    """All orders of persons with more than one order."""
    repeat = (
        resolved.groupBy("customer_unique_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    return resolved.join(repeat.select("customer_unique_id"), "customer_unique_id", "left_semi")


def same_day_pairs(resolved: DataFrame) -> DataFrame:
    """Neighbouring orders of a person less than a day apart."""
    close = order_gaps(resolved).where(F.col("gap_days") == 0)
    return close.select(
        "customer_unique_id",
        F.col("previous.order_id").alias("first_order_id"),
        F.col("order_id").alias("second_order_id"),
        F.col("previous.order_purchase_timestamp").alias("first_at"),
        F.col("order_purchase_timestamp").alias("second_at"),
        (F.col("previous.order_purchase_timestamp") == F.col("order_purchase_timestamp")).alias(
            "same_timestamp"
        ),
    )


def same_day_summary(pairs: DataFrame) -> DataFrame:
    same = pairs.groupBy().agg(
        F.count(F.lit(1)).alias("n_pairs"), F.count_if("same_timestamp").alias("n_same_timestamp")
    )
    return same.withColumn(
        "same_timestamp_pct", percent(F.col("n_same_timestamp"), F.col("n_pairs"))
    )


def seller_disjointness(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Share of same-day pairs whose two orders have no seller in common.

    A seller shared by a pair shows up twice when the pair's two orders are
    looked up in the distinct order-seller list, so nothing is gathered into sets.
    """
    sellers = items.groupBy("order_id", "seller_id").agg(F.count(F.lit(1)).alias("r")).drop("r")
    sides = pairs.select(
        "first_order_id",
        "second_order_id",
        F.explode(F.array("first_order_id", "second_order_id")).alias("order_id"),
    )
    shared = (
        sides.join(sellers, "order_id")
        .groupBy("first_order_id", "second_order_id", "seller_id")
        .agg(F.count(F.lit(1)).alias("sides"))
        .where(F.col("sides") > 1)
        .groupBy("first_order_id", "second_order_id")
        .agg(F.count(F.lit(1)).alias("r"))
    )
    sharing = shared.groupBy().agg(F.count(F.lit(1))).scalar()
    return (
        pairs.groupBy()
        .agg(F.count(F.lit(1)).alias("n_pairs"))
        .select("n_pairs", (F.col("n_pairs") - sharing).alias("n_disjoint"))
        .withColumn("disjoint_pct", percent(F.col("n_disjoint"), F.col("n_pairs")))
    )


def untranslated_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Category names without an English counterpart."""
    names = products.select("product_category_name").where(
        F.col("product_category_name").isNotNull()
    )
    return names.distinct().join(translation, "product_category_name", "left_anti")


def near_identical_orders(
    orders: DataFrame, seconds: int = fixed.NEAR_SECONDS, cents: int = fixed.NEAR_CENTS
) -> DataFrame:
    """Orders of one person that lie at most ``seconds`` and ``cents`` apart.

    Orders alike in person, moment and amount are one class, named by its smallest id; a
    row tells of two classes, or of one with several orders (its largest id comes second),
    and ``n_pairs`` how many pairs of orders that makes. Moments and amounts fall into bins
    as wide as the tolerances. A class stands in its own bins and the next ones, and two
    classes meet in the higher of their bins, so each pair comes up once, and a person with
    a third of all orders is spread over all bins. Orders without person, moment or amount
    are compared with nothing.
    """
    if seconds < 1 or cents < 1:
        raise ValueError(f"tolerances are whole numbers of 1 or more: {seconds}, {cents}")
    who, at, much = "customer_unique_id", "order_purchase_timestamp", "order_total_cents"
    classes = (
        orders.where(F.col(who).isNotNull() & F.col(at).isNotNull() & F.col(much).isNotNull())
        .groupBy(who, at, much)
        .agg(F.min("order_id").alias("id"), F.max("order_id").alias("last_id"), F.count(F.lit(1)).alias("n"))
        .withColumn("micros", F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01', {at})"))
    )
    width = seconds * 1_000_000
    bins = [
        F.struct(
            (F.floor(F.col("micros") / width) + i).alias("t"), (F.floor(F.col(much) / cents) + j).alias("c"),
            F.lit(i).alias("t_next"), F.lit(j).alias("c_next"),
        )
        for i in (0, 1)
        for j in (0, 1)
    ]
    binned = classes.select(who, "micros", F.col(much).alias("amount"), "id", "n", F.explode(F.array(*bins)).alias("b"))
    a, b = binned.alias("a"), binned.alias("b")
    meet = (
        (F.col(f"a.{who}") == F.col(f"b.{who}"))
        & (F.col("a.b.t") == F.col("b.b.t"))
        & (F.col("a.b.c") == F.col("b.b.c"))
        & (F.col("a.b.t_next") + F.col("b.b.t_next") < 2)
        & (F.col("a.b.c_next") + F.col("b.b.c_next") < 2)
    )
    apart, differ = F.col("b.micros") - F.col("a.micros"), F.abs(F.col("b.amount") - F.col("a.amount"))
    first = (apart > 0) | ((apart == 0) & (F.col("a.amount") < F.col("b.amount")))
    pairs = a.join(b, meet & first & (apart <= width) & (differ <= cents)).select(
        F.col(f"a.{who}").alias(who),
        F.col("a.id").alias("first_order_id"),
        F.col("b.id").alias("second_order_id"),
        F.col("a.n").alias("n_first"),
        F.col("b.n").alias("n_second"),
        (apart / 1_000_000).alias("seconds_apart"),
        differ.alias("cents_apart"),
        (F.col("a.n") * F.col("b.n")).alias("n_pairs"),
    )
    alike = classes.where("n > 1").select(
        who,
        F.col("id").alias("first_order_id"),
        F.col("last_id").alias("second_order_id"),
        F.col("n").alias("n_first"),
        F.col("n").alias("n_second"),
        F.lit(0.0).alias("seconds_apart"),
        F.lit(0).cast("bigint").alias("cents_apart"),
        F.expr("n * (n - 1) DIV 2").alias("n_pairs"),
    )
    return pairs.unionByName(alike)
