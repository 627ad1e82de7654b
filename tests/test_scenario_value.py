from datetime import datetime

import pytest
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.plans import scenario, value


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        ("ada", 500.0, 0.60, 300.0, "gold", "high"),
        ("ben", 400.0, 0.50, 200.0, "gold", "medium"),
        ("cai", 900.0, 0.20, 180.0, "iron", "low"),
        ("dee", 250.0, 0.80, 200.0, "iron", "high"),
        ("eli", 100.0, 0.10, 10.0, "iron", "low"),
        ("fay", 640.0, 0.25, 160.0, "gold", "low"),
        ("gus", 50.0, 0.90, 45.0, "tin", "high"),
    ]
    return spark.createDataFrame(
        rows,
        """customer_unique_id STRING, customer_value DOUBLE, predicted_churn_probability DOUBLE,
        revenue_at_risk DOUBLE, segment STRING, risk_tier STRING""",
    ).cache()


def ids(df):
    return {r["customer_unique_id"] for r in df.collect()}


def test_effects():
    assert scenario.resolve_effect("moderate") == 0.20
    assert scenario.resolve_effect("0.27") == 0.27
    for bad in ("huge", "0", "1.5", "-0.1"):
        with pytest.raises(ValueError):
            scenario.resolve_effect(bad)


def test_targets(scored):
    assert ids(scenario.select_targets(scored, "top_n", n=2)) == {"ada", "ben"}  # ben and dee tie
    assert ids(scenario.select_targets(scored, "top_n", n=4)) == {"ada", "ben", "dee", "cai"}
    assert ids(scenario.select_targets(scored, "risk_tier", tier="low")) == {"cai", "eli", "fay"}
    assert ids(scenario.select_targets(scored, "segment", segment="iron")) == {"cai", "dee", "eli"}
    with pytest.raises(ValueError, match="high, low, medium"):
        scenario.select_targets(scored, "risk_tier", tier="huge")
    with pytest.raises(ValueError, match="gold, iron, tin"):
        scenario.select_targets(scored, "segment", segment="wood")
    with pytest.raises(ValueError, match="no segment"):
        scenario.select_targets(scored.drop("segment"), "segment", segment="gold")
    with pytest.raises(ValueError, match="everyone"):
        scenario.select_targets(scored, "everyone")
    with pytest.raises(ValueError, match="top_n needs"):
        scenario.select_targets(scored, "top_n")


def test_campaign_known_value(scored):
    summary, targeted = scenario.campaign_roi(scored, "top_n", 12, 0.5, n=1)
    row = summary.first()
    # 500 at 60 percent, half of it kept, for 12
    assert row["total_expected_revenue_saved"] == 150.0 and row["net_expected_benefit"] == 138.0
    assert row["roi_pct"] == 11.5 and row["n_targeted"] == 1 and targeted.count() == 1
    assert row["model_caveat"] == fixed.MODEL_CAVEAT
    assert row["retention_effect_caveat"] == fixed.EFFECT_CAVEAT
    empty = scenario.campaign_roi(scored, "top_n", 12, 0.5, n=0)[0].first()
    assert (empty["n_targeted"], empty["total_expected_revenue_saved"], empty["roi_pct"]) == (0, 0.0, None)
    for cost in (0, -5):
        with pytest.raises(ValueError, match="cost"):
            scenario.campaign_roi(scored, "top_n", cost, 0.5, n=1)


def test_budget(scored):
    summary, selected, curve = scenario.budget_allocation(scored, 50, 20, 0.1)
    row = summary.first()
    assert row["n_targeted"] == 2 and row["total_spent"] == 40.0
    assert row["total_expected_revenue_saved"] == 50.0 and row["net_expected_benefit"] == 10.0
    assert ids(selected) == {"ada", "ben"}
    rows = curve.collect()
    assert [r["budget"] for r in rows] == [25.0, 37.5, 50.0, 62.5, 75.0, 100.0]
    assert [r["n_targeted"] for r in rows] == [1, 1, 2, 3, 3, 5]
    assert [r["total_revenue_saved"] for r in rows] == [30.0, 30.0, 50.0, 70.0, 70.0, 104.0]
    assert scenario.budget_allocation(scored, 10, 20, 0.1)[0].first()["n_targeted"] == 0
    everyone = scenario.budget_allocation(scored, 10_000, 20, 0.1)
    assert everyone[0].first()["n_targeted"] == 7
    assert {r["n_targeted"] for r in everyone[2].collect()} == {7}


def test_whatif(scored):
    labels = ["low", "medium", "high"]
    out, summary, movement = scenario.tier_whatif(scored, [0, 0.4, 0.7, 1.0], labels, "absolute")
    counts = {r["risk_tier_scenario"]: r["n_customers"] for r in summary.collect()}
    assert counts == {"low": 3, "medium": 2, "high": 2}
    cells = {(r["risk_tier"], r["risk_tier_scenario"]): r["n_customers"] for r in movement.collect()}
    assert cells["All", "All"] == 7 and cells["high", "medium"] == 1 and cells["high", "All"] == 3
    matrix = {r["risk_tier"]: r for r in scenario.movement_matrix(movement, labels).collect()}
    assert matrix["low"]["high"] == 0 and matrix["All"]["medium"] == 2
    quantile = scenario.tier_whatif(scored, [0, 0.5, 1.0], ["a", "b"])[0]
    assert quantile.where("risk_tier_scenario = 'a'").count() == 4
    assert scenario.tier_whatif(scored.drop("risk_tier"), [0, 0.5, 1.0], ["a", "b"])[2] is None
    with pytest.raises(ValueError, match="labels"):
        scenario.tier_whatif(scored, [0, 1.0], labels, "absolute")
    with pytest.raises(ValueError, match="guess"):
        scenario.tier_whatif(scored, [0, 0.5, 1.0], ["a", "b"], "guess")


def test_collapsing_quantiles_are_an_error(spark):
    rows = [(f"c{i}", 1.0, p, p) for i, p in enumerate([0.5] * 5 + [0.9])]
    df = spark.createDataFrame(rows, "customer_unique_id STRING, customer_value DOUBLE, predicted_churn_probability DOUBLE, revenue_at_risk DOUBLE")
    with pytest.raises(ValueError, match="coincide"):
        scenario.tier_whatif(df, [0, 0.25, 0.5, 0.75, 1.0], list("abcd"))


def test_summary_guard(spark):
    bad = spark.createDataFrame([(3, 40.0, 35.0, 10.0, 1.0)], "n_targeted INT, total_spent DOUBLE, total_budget DOUBLE, cost_per_customer DOUBLE, total_expected_revenue_saved DOUBLE")
    with pytest.raises(ValueError, match="more than the budget"):
        scenario.check_summary(bad, 10)
    with pytest.raises(ValueError, match="only 2 scored"):
        scenario.check_summary(bad, 2)


@pytest.fixture(scope="module")
def features_scored(spark):
    rows = [(f"c{i}", 10.0 * i, i / 20) for i in range(20)]
    return spark.createDataFrame(rows, "customer_unique_id STRING, lifetime_revenue DOUBLE, predicted_churn_probability DOUBLE")


def test_revenue_at_risk_tiers(spark, features_scored):
    segments = spark.createDataFrame([("c1", "high_value")], "customer_unique_id STRING, segment STRING")
    got = {r["customer_unique_id"]: r for r in value.score_customers(features_scored, segments).collect()}
    assert got["c10"]["revenue_at_risk"] == 50.0 and got["c10"]["caveat"] == fixed.MODEL_CAVEAT
    assert got["c1"]["segment"] == "high_value" and got["c2"]["segment"] is None
    tiers = [got[f"c{i}"]["risk_tier"] for i in range(20)]
    assert tiers == ["low"] * 10 + ["medium"] * 6 + ["high"] * 4
    twice = segments.union(segments)
    with pytest.raises(ValueError, match="Duplicate"):
        value.revenue_at_risk(features_scored, twice)


@pytest.mark.parametrize("column,bad,message", [
    ("lifetime_revenue", "NULL", "Null"), ("predicted_churn_probability", "1.5D", "out of"),
    ("customer_unique_id", "'c1'", "Duplicate"),
])
def test_score_guards(features_scored, column, bad, message):
    broken = features_scored.withColumn(column, F.expr(f"IF(customer_unique_id = 'c3', {bad}, {column})"))
    with pytest.raises(ValueError, match=message):
        value.check_scores(value.revenue_at_risk(broken))


def test_listing_and_lookup(scored):
    total, page = value.list_customers(scored, limit=5)
    assert total == 7 and page.count() == 5
    total, page = value.list_customers(scored, risk_tier="high", segment="iron")
    assert total == 1 and ids(page) == {"dee"}
    total, page = value.list_customers(scored, min_revenue_at_risk=180, limit=2, offset=1)
    assert total == 4 and [r["customer_unique_id"] for r in page.collect()] == ["ben", "cai"]
    assert value.get_customer(scored, "eli").first()["customer_value"] == 100.0
    with pytest.raises(LookupError):
        value.get_customer(scored, "nobody")
    assert ids(value.get_customers(scored, scored.where("segment = 'gold'"))) == {"ada", "ben", "fay"}


def test_tenure_skew(spark, features_scored):
    start = datetime(2018, 1, 1)
    events = spark.createDataFrame([(f"c{i}", datetime(2018, 1 + i % 4, 1)) for i in range(20)], "customer_unique_id STRING, order_purchase_timestamp TIMESTAMP_NTZ")
    rows = value.tenure_skew(features_scored, events, datetime(2018, 8, 31)).collect()
    assert sum(r["n"] for r in rows) == 20 and [r["tenure_bucket"] for r in rows] == sorted(r["tenure_bucket"] for r in rows)
    newest = [i / 20 for i in range(20) if i % 4 == 3]
    assert rows[0]["mean"] == pytest.approx(sum(newest) / 5) and rows[0]["median"] == sorted(newest)[2]
    assert start < datetime(2018, 8, 31)
