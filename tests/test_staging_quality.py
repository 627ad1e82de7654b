from datetime import datetime

import pytest
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.functions.dates import floored_days, parse_or_null, truncated_days
from holdfast.operators import profile
from holdfast.plans import audit, explore, quality, staging
from holdfast.sources.schemas import schema


def day(text):
    return datetime.fromisoformat(text)


def test_whole_days_floor_and_truncate(spark):
    rows = [("2020-01-02", "2020-01-01 12:00:00"), ("2020-01-01", "2020-01-02 23:59:59"),
            ("2020-01-03", "2020-01-01"), ("2020-01-03 00:00:01", "2020-01-01")]
    df = spark.createDataFrame([(day(a), day(b)) for a, b in rows], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    got = df.select(floored_days(F.col("a"), F.col("b")), truncated_days(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(-1, 0), (1, 1), (-2, -2), (-3, -2)]


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2020-02-01 10:00:00",), ("soon",)], "t STRING")
    assert [r[0] for r in df.select(parse_or_null(F.col("t"))).collect()] == [day("2020-02-01 10:00:00"), None]


@pytest.fixture(scope="module")
def raw(spark):
    def table(name, rows, columns):
        full = schema(name)
        keep = [f for f in full if f.name in columns]
        return spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep))

    from decimal import Decimal as D

    return {
        "customers": table("customers", [("k1", "p1", "SP", "x"), ("k2", "p1", "SP", "y"), ("k3", "p2", "RJ", "z")],
                           ["customer_id", "customer_unique_id", "customer_city", "customer_state"]),
        "orders": table("orders", [
            ("o1", "k1", "delivered", day("2020-01-01"), day("2020-03-01"), day("2020-02-01")),
            ("o2", "k2", "canceled", day("2020-01-01"), None, day("2020-02-01")),
            ("o3", "k3", "canceled", day("2020-01-05"), day("2020-01-04 12:00:00"), day("2020-01-05")),
            ("o4", "k3", "shipped", day("2030-01-05"), None, None)],
            ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
             "order_delivered_customer_date", "order_estimated_delivery_date"]),
        "items": table("order_items", [("o1", 1, "a", "s1", D("30.00"), D("0.00")), ("o1", 2, "a", "s1", D("30.00"), D("0.00")),
                                       ("o1", 3, "b", "s2", D("40.00"), D("0.00")), ("zz", 1, "b", "s2", D("-1.00"), D("0.50"))],
                       ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]),
        "payments": table("order_payments", [("o1", 1, "voucher", 1, D("60.00")), ("o1", 2, "card", 3, D("40.00"))],
                          ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]),
        "reviews": table("order_reviews", [("r1", "o1", 4), ("r2", "o1", 1), ("r3", "o3", 7), ("r4", "o3", None)],
                         ["review_id", "order_id", "review_score"]),
        "products": table("products", [("a", "brinquedos"), ("b", "pc_gamer"), ("c", None), ("a", "outros")],
                          ["product_id", "product_category_name"]),
        "sellers": table("sellers", [("s1",), ("s2",)], ["seller_id"]),
        "translation": table("product_category_name_translation", [("brinquedos", "toys")],
                             ["product_category_name", "product_category_name_english"]),
    }


def test_delivered_wins_over_canceled(raw):
    rows = {r["order_id"]: r for r in staging.stage_orders(raw["orders"]).collect()}
    assert [rows[o]["delivery_status"] for o in ("o1", "o2", "o3", "o4")] == [
        "delivered", "canceled", "delivered", "in_progress_or_undelivered",
    ]
    assert (rows["o1"]["delivery_days"], rows["o1"]["late_delivery_outlier"]) == (60, True)
    assert rows["o3"]["delivery_days"] == 0 and rows["o2"]["late_delivery_outlier"] is None


def test_categories(raw):
    rows = staging.stage_products(raw["products"], raw["translation"]).collect()
    assert sorted((r[0], r[1]) for r in rows) == [
        ("a", "toys"), ("a", "unknown"), ("b", "pc_gamer"), ("c", "unknown"),
    ]


def test_order_summary_does_not_fan_out(raw):
    resolved = staging.resolved_orders(staging.stage_orders(raw["orders"]), raw["customers"])
    rows = {r["order_id"]: r for r in staging.order_summary(resolved, raw["items"], raw["payments"], raw["reviews"]).collect()}
    assert len(rows) == 4
    one = rows["o1"]
    assert one["order_total_cents"] == 10_000 and one["payment_cents"] == 10_000
    assert (one["installments_mean"], one["payment_type_mode"], one["review_score"]) == (2.0, "card", 2.5)
    assert one["delivery_delay_days"] == 29 and rows["o3"]["delivery_delay_days"] == -1


def test_checks_and_gate(raw):
    results = quality.run_checks(raw, as_of=day("2025-01-01"))
    found = {r["name"]: r["violation_count"] for r in results.collect()}
    assert list(sorted(found)) == sorted(quality.CHECKS)
    flagged = {n: c for n, c in found.items() if c}
    assert flagged == {
        "duplicate_pk_products": 1,
        "orphan_fk_order_items": 1,
        "negative_price": 1,
        "delivered_before_purchased": 1,
        "future_purchase_timestamp": 1,
        "review_score_out_of_range": 1,
        "late_delivery_outliers": 1,
        "same_timestamp_order_pairs": 1,
        "uncategorized_products": 2,
    }
    assert quality.any_critical_failed(results)
    with pytest.raises(quality.QualityGateError, match="negative_price"):
        quality.gate(results)
    text = quality.report(results, day("2025-01-01"))
    assert "**FAIL**" in text and "2 flagged" in text and "clean" not in text


def test_gate_lets_warnings_pass(raw):
    results = quality.run_checks(raw, as_of=day("2025-01-01"))
    quality.gate(results.where(F.col("severity") == "warning"))


def test_identity_inconsistency_is_found(spark, raw):
    two = raw["customers"].union(spark.createDataFrame([("k1", "p9", "a", "b")], raw["customers"].schema))
    results = quality.run_checks({**raw, "customers": two}, as_of=day("2025-01-01"))
    assert results.where("name = 'customer_identity_consistency'").first()["violation_count"] == 1


def test_duplicates_and_orphans(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (3, "c")], "k INT, v STRING")
    report = profile.duplicate_report(df, ["k", "v"], "k").first()
    assert (report["duplicate_rows"], report["affected"]) == (4, 2)
    assert profile.duplicate_sample(df, ["k", "v"]).count() == 2
    child = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k INT")
    assert profile.orphans(child, df.select("k").distinct(), "k").first()[0] == 2


def test_null_rates_only_where_any(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (3, 1, None)], "a INT, b INT, c STRING")
    assert [tuple(r) for r in profile.null_rates(df).collect()] == [("b", 66.67), ("c", 33.33)]


def test_customer_revenue_is_not_multiplied(raw):
    resolved = staging.resolved_orders(staging.stage_orders(raw["orders"]), raw["customers"])
    rows = {r["customer_unique_id"]: r for r in explore.customer_revenue(resolved, raw["items"]).collect()}
    assert set(rows) == {"p1"} and rows["p1"]["revenue_cents"] == 10_000 and rows["p1"]["purchase_events"] == 1


def test_same_day_pairs_and_sellers(raw, spark):
    resolved = staging.resolved_orders(staging.stage_orders(raw["orders"]), raw["customers"])
    pairs = audit.same_day_pairs(resolved)
    assert [(r["first_order_id"], r["second_order_id"], r["same_timestamp"]) for r in pairs.collect()] == [("o1", "o2", True)]
    # an order without items shares no seller
    assert audit.seller_disjointness(pairs, raw["items"]).first()["n_disjoint"] == 1
    shared = raw["items"].union(spark.createDataFrame([("o2", 1, "q", "s2", None, None)], raw["items"].schema))
    assert audit.seller_disjointness(pairs, shared).first()["n_disjoint"] == 0


def test_coverage_windows(spark):
    gaps = spark.createDataFrame([(30,), (90,), (91,), (400,)], "gap_days INT")
    rows = {r["window_days"]: (r["covered_pct"], r["excluded"]) for r in audit.window_coverage(gaps).collect()}
    assert rows == {90: (50.0, 2), 120: (75.0, 1), 180: (75.0, 1), 270: (75.0, 1)}
    assert set(rows) == set(fixed.COVERAGE_WINDOWS)


def test_items_and_reviews_reach_their_order_together(spark):
    items = spark.createDataFrame([("a", 1.5, 0.25), ("a", None, 0.25), ("b", None, None)], "order_id STRING, price DOUBLE, freight_value DOUBLE")
    reviews = spark.createDataFrame([("a", 4), ("a", 1), ("c", 5), ("b", None)], "order_id STRING, review_score INT")
    got = {r["order_id"]: (r["order_total_cents"], r["review_score"]) for r in staging.order_children(items, reviews).collect()}
    assert got == {"a": (200, 2.5), "b": (0, None), "c": (None, 5.0)}
