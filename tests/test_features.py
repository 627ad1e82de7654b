import random
from datetime import datetime, timedelta
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.plans import features

ORDERS = """order_id STRING, customer_unique_id STRING, order_purchase_timestamp TIMESTAMP_NTZ,
    delivery_status STRING, delivery_days INT, delivery_delay_days INT, order_total_cents BIGINT,
    payment_cents BIGINT, installments_mean DOUBLE, payment_type_mode STRING, review_score DOUBLE"""
ITEMS = """order_id STRING, customer_unique_id STRING, order_purchase_timestamp TIMESTAMP_NTZ,
    product_category_english STRING, seller_id STRING, price_cents BIGINT"""
TICKETS = """customer_unique_id STRING, created_at TIMESTAMP_NTZ, resolved BOOLEAN, escalated BOOLEAN,
    resolution_hours DOUBLE, customer_satisfaction INT"""
CAMPAIGNS = "customer_unique_id STRING, campaign_date TIMESTAMP_NTZ, opened BOOLEAN, clicked BOOLEAN, converted BOOLEAN"
TOUCHES = "customer_unique_id STRING, created_at TIMESTAMP_NTZ"
SNAP = datetime(2017, 7, 1)


def d(text):
    return datetime.fromisoformat(text)


def order(i, who, at, total=10_000, status="delivered", days=5, delay=-3, kind="card", score=4.0):
    return (i, who, at, status, days, delay, total, total, 1.0, kind, score)


@pytest.fixture(scope="module")
def small(spark):
    orders = [
        order("o1", "c1", d("2017-01-10"), 15_000, score=5.0),
        order("o2", "c1", d("2017-03-15"), 20_000, score=2.0, kind="boleto"),
        order("o3", "c1", d("2017-06-20"), 9_000, score=None, kind="boleto"),
        order("o4", "c2", d("2017-02-01"), 30_000, delay=4),
        order("o5", "c3", d("2017-05-01"), 6_000),
        order("o6", "c3", d("2018-01-15 08:00:00"), 12_000),
        order("o7", "c4", d("2017-04-01 10:00:00"), 8_000, status="canceled", days=None, delay=None),
        order("o8", "c4", d("2017-04-01 10:00:00"), 4_500),
    ]
    items = [
        ("o1", "c1", d("2017-01-10"), "toys", "s1", 14_000),
        ("o2", "c1", d("2017-03-15"), "toys", "s2", 19_000),
        ("o3", "c1", d("2017-06-20"), "electronics", "s1", 8_500),
        ("o4", "c2", d("2017-02-01"), None, "s3", 29_000),
        ("o6", "c3", d("2018-01-15 08:00:00"), "beauty", "s4", 11_000),
    ]
    return {
        "order_summary": spark.createDataFrame(orders, ORDERS),
        "item_summary": spark.createDataFrame(items, ITEMS),
        "geography": spark.createDataFrame([("c1", "SP", "a"), ("c2", "RJ", "b")], "customer_unique_id STRING, customer_state STRING, customer_city STRING"),
        "tickets": spark.createDataFrame([("c1", d("2017-02-01"), True, False, 5.0, 4), ("c1", d("2017-09-01"), True, False, 3.0, 5)], TICKETS),
        "campaigns": spark.createDataFrame([("c2", d("2017-03-15 12:00:00"), True, False, False)], CAMPAIGNS),
        "interventions": spark.createDataFrame([("c3", d("2017-01-15"))], TOUCHES),
    }


@pytest.fixture(scope="module")
def rows(small):
    return {r["customer_unique_id"]: r for r in features.snapshot_features([SNAP], **small).collect()}


def test_membership_and_label(rows):
    assert set(rows) == {"c1", "c2", "c3", "c4"}
    assert rows["c2"]["churned"] == 1 and rows["c2"]["days_to_next_purchase"] is None
    assert rows["c3"]["days_to_next_purchase"] == 198 and rows["c3"]["churned"] == 1


def test_label_boundary_uses_whole_days(spark, small):
    at = SNAP + timedelta(days=180, hours=23)
    late = spark.createDataFrame([order("x", "c2", at)], ORDERS)
    got = features.snapshot_features([SNAP], small["order_summary"].union(late)).where("customer_unique_id = 'c2'").first()
    assert (got["days_to_next_purchase"], got["churned"]) == (180, 0)


def test_cart_split_is_one_purchase(rows):
    c4 = rows["c4"]
    assert c4["lifetime_orders"] == 1 and c4["lifetime_revenue"] == 125.0
    assert c4["average_order_value"] == 62.5 and c4["purchase_gap_mean"] is None


def test_order_features(rows):
    c1 = rows["c1"]
    assert (c1["lifetime_orders"], c1["orders_last_30_days"], c1["orders_last_90_days"], c1["orders_last_180_days"]) == (3, 1, 1, 3)
    assert c1["days_since_last_purchase"] == 11 and c1["purchase_gap_mean"] == 80.5
    assert c1["purchase_gap_std"] == pytest.approx(stdev([64, 97]))
    assert c1["purchase_frequency"] == pytest.approx(3 / 172)
    assert c1["spend_trend_90d"] == 90.0 - 350.0 and c1["review_trend_90d"] is None
    assert c1["average_review_score"] == 3.5 and c1["negative_review_rate"] == pytest.approx(1 / 3)
    assert c1["preferred_payment_method"] == "boleto"
    assert rows["c2"]["late_delivery_rate"] == 1.0 and rows["c4"]["late_delivery_rate"] == 0.0


def test_event_tables_respect_the_snapshot(rows):
    assert rows["c1"]["n_support_tickets"] == 1 and rows["c2"]["n_campaigns_received"] == 1
    assert rows["c2"]["days_since_last_campaign"] == 107
    assert rows["c3"]["has_been_targeted_for_retention"] == 1
    assert rows["c1"]["has_been_targeted_for_retention"] == 0
    assert rows["c4"]["n_support_tickets"] == 0 and rows["c4"]["pct_tickets_resolved"] is None


def test_item_features(rows):
    c1 = rows["c1"]
    assert (c1["unique_categories"], c1["unique_sellers"]) == (2, 2)
    total = 14_000 + 19_000 + 8_500
    assert c1["category_concentration"] == pytest.approx((33_000**2 + 8_500**2) / total**2)
    assert rows["c2"]["unique_categories"] == 0 and rows["c2"]["category_concentration"] is None
    assert rows["c2"]["seller_concentration"] == 1.0 and rows["c3"]["unique_sellers"] is None


def test_later_rows_change_nothing_but_the_label(spark, small):
    later = spark.createDataFrame([order(f"n{i}", f"c{i % 4 + 1}", d("2017-08-01") + timedelta(days=i)) for i in range(20)], ORDERS)
    label = ["churned", "days_to_next_purchase"]
    before = features.snapshot_features([SNAP], **small).drop(*label)
    after = features.snapshot_features([SNAP], **{**small, "order_summary": small["order_summary"].union(later)}).drop(*label)
    assert sorted(map(str, before.collect())) == sorted(map(str, after.collect()))


def test_many_snapshots_agree_with_single_ones_and_brute_force(spark):
    rng = random.Random(11)
    orders = []
    for i in range(400):
        who = "big" if i % 3 == 0 else f"c{rng.randrange(25)}"
        at = d("2017-01-01") + timedelta(hours=rng.randrange(24 * 500))
        orders.append(order(f"o{i:04}", who, at, rng.randrange(100, 9_999), score=rng.choice([1.0, 3.0, 5.0, None])))
    df = spark.createDataFrame(orders, ORDERS).repartition(6)
    snaps = list(fixed.SNAPSHOTS)
    many = features.snapshot_features(snaps, df).collect()
    plain = features.snapshot_features(snaps, df).collect()
    assert sorted(map(str, many)) == sorted(map(str, plain))
    for r in many:
        snap, who = r["snapshot_date"], r["customer_unique_id"]
        past = [o for o in orders if o[1] == who and o[2] <= snap]
        times = sorted({o[2] for o in past})
        gaps = [(b - a).days for a, b in zip(times, times[1:])]
        later = [o[2] for o in orders if o[1] == who and o[2] > snap]
        assert r["lifetime_orders"] == len(times)
        assert r["orders_last_90_days"] == sum(t > snap - timedelta(days=90) for t in times)
        assert r["lifetime_revenue"] == pytest.approx(sum(o[6] for o in past) / 100)
        prev = [o for o in past if snap - timedelta(days=180) < o[2] <= snap - timedelta(days=90)]
        assert r["previous_90d_revenue"] == pytest.approx(sum(o[6] for o in prev) / 100)
        assert r["purchase_gap_mean"] == (pytest.approx(mean(gaps)) if gaps else None)
        assert r["purchase_gap_std"] == (pytest.approx(stdev(gaps)) if len(gaps) > 1 else None)
        assert r["days_to_next_purchase"] == ((min(later) - snap).days if later else None)
    assert {(r["snapshot_date"], r["customer_unique_id"]) for r in many} == {
        (s, o[1]) for s in snaps for o in orders if o[2] <= s
    }


def test_each_person_is_in_one_split(spark, small):
    panel = features.snapshot_features(list(fixed.SNAPSHOTS), small["order_summary"], splits=fixed.SNAPSHOTS)
    splits = panel.groupBy("customer_unique_id").agg(F.count_distinct("split").alias("n"))
    assert {r["n"] for r in splits.collect()} == {1}
    assert panel.where("split = 'train'").count() == 4 * 6


def test_calendar_guard():
    features.check_calendar(list(fixed.SNAPSHOTS), fixed.MAX_VALID_DATE)
    with pytest.raises(ValueError, match="it ends on"):
        features.check_calendar([d("2018-04-01")], fixed.MAX_VALID_DATE)


def test_missing_indicators(small):
    panel = features.snapshot_features([SNAP], **small)
    got = {r["customer_unique_id"]: r for r in features.add_missing_indicators(panel).collect()}
    assert got["c1"]["has_repeat_purchase"] == 1 and got["c2"]["has_repeat_purchase"] == 0
    assert got["c1"]["has_support_history"] == 1 and got["c2"]["has_campaign_history"] == 1
    assert got["c2"]["review_trend_90d"] == 0.0


def test_unique_guard(spark):
    twice = spark.createDataFrame([(1,), (1,)], "k INT")
    with pytest.raises(ValueError, match="Duplicate"):
        features.require_unique(twice, ["k"])


def test_strict_features_ignore_what_became_known_later(spark, small):
    when = F.col("order_purchase_timestamp") + F.expr("INTERVAL '40' DAY")
    orders = small["order_summary"].withColumn("order_delivered_customer_date", when)
    late = F.col("order_delivered_customer_date") > F.lit(SNAP)
    changed = orders.withColumns(
        {
            "delivery_delay_days": F.when(late, F.lit(99)).otherwise(F.col("delivery_delay_days")),
            "delivery_days": F.when(late, F.lit(99)).otherwise(F.col("delivery_days")),
            "review_score": F.when(late, F.lit(1.0)).otherwise(F.col("review_score")),
        }
    )
    tickets = spark.createDataFrame([("c1", d("2017-06-30 20:00:00"), False, True, 50.0, 1)], TICKETS)
    opened = small["tickets"].union(tickets)

    def features_of(summary, strict):
        panel = features.snapshot_features([SNAP], summary, tickets=opened, strict_as_of=strict)
        return {r["customer_unique_id"]: r.asDict() for r in panel.collect()}

    assert features_of(orders, True) == features_of(changed, True)
    loose, strict = features_of(orders, False), features_of(orders, True)
    assert loose != features_of(changed, False)
    c1 = strict["c1"]
    assert c1["n_support_tickets"] == 2 and c1["pct_tickets_resolved"] == 1.0 and c1["avg_resolution_hours"] == 5.0
    assert loose["c1"]["pct_tickets_resolved"] == 0.5
    money = ["lifetime_revenue", "lifetime_orders", "orders_last_90_days", "days_since_last_purchase", "churned"]
    assert all(strict[c][m] == loose[c][m] for c in strict for m in money)


def test_only_moments_are_ordered_and_entries_come_by_person(small, monkeypatch):
    asked, find = [], features.with_previous
    monkeypatch.setattr(features, "with_previous", lambda df, *a: asked.append(df.columns) or find(df, *a))
    days = list(fixed.SNAPSHOTS)
    features.snapshot_features(days, small["order_summary"])
    assert asked == [[features.PERSON, "order_purchase_timestamp"]]
    payments = features._preferred_payment(small["order_summary"], features.Periods(days))
    persons = [r[features.PERSON] for r in payments.collect()]
    assert persons and len(persons) == len(set(persons))
    assert all(len(r["_entries"]) == len(days) for r in payments.collect())
