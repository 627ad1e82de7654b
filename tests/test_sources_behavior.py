from datetime import datetime

import pytest
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.plans import behavior
from holdfast.session import fresh_path, settle, shared_dir
from holdfast.sources import tables
from holdfast.sources.schemas import CANONICAL, schema


def test_csv_loading(spark, tmp_path, caplog):
    (tmp_path / "shop_customers_dataset.csv").write_text(
        'customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"k1",p1,01409,"são paulo",SP\n'
    )
    (tmp_path / "order_reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"two\nlines, ""quoted""",2018-01-01 00:00:00,2018-01-02 03:04:05\n'
    )
    with caplog.at_level("WARNING"):
        raw = tables.load_raw(spark, str(tmp_path))
    assert set(raw) == {"customers", "reviews"}
    assert "orders.csv" in caplog.text
    # zip prefixes keep their leading zero
    assert raw["customers"].first()["customer_zip_code_prefix"] == "01409"
    review = raw["reviews"].first()
    assert review["review_comment_message"] == 'two\nlines, "quoted"'
    assert review["review_answer_timestamp"] == datetime(2018, 1, 2, 3, 4, 5)
    assert raw["reviews"].schema == schema("order_reviews")


def test_every_table_has_a_schema(spark):
    assert len(CANONICAL) == 14
    for name in CANONICAL:
        assert tables.empty(spark, name).count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("k1", "p1", None, "a", "SP"), ("k2", "p1", "01", "b", "RJ")], schema("customers"))
    path = str(tmp_path / "t")
    tables.truncate_and_load(df.withColumn("extra", F.lit(1)), path, "customers")
    assert spark.read.parquet(path).schema.names == schema("customers").names
    tables.append(df, path)
    assert spark.read.parquet(path).count() == 4
    tables.replace(df, path)
    assert spark.read.parquet(path).count() == 2
    tables.write_json(df, str(tmp_path / "j"))
    assert "customer_zip_code_prefix" in spark.read.json(str(tmp_path / "j")).columns
    tables.write_csv(df, str(tmp_path / "c"))
    assert tables.read_csv(spark, str(tmp_path / "c"), "customers").count() == 2
    tables.write_text(spark, "# Report", str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r")).first()[0] == "# Report"
    with pytest.raises(FileNotFoundError):
        tables.read_parquet(spark, str(tmp_path / "nothing"))


def test_stored_features_are_read_by_partition(spark, tmp_path):
    days = [datetime(2018, 1, 1), datetime(2018, 2, 1)]
    df = spark.createDataFrame([("a", days[0]), ("b", days[1])], "customer_unique_id STRING, snapshot_date TIMESTAMP_NTZ")
    path = str(tmp_path / "f")
    tables.replace(df, path, ["snapshot_date"])
    one = tables.read_snapshot(spark, path, days[1])
    assert [r["customer_unique_id"] for r in one.collect()] == ["b"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_catalog_table(spark):
    tables.save_as_table(spark.range(3), "holdfast_events")
    assert spark.table("holdfast_events").count() == 3


def test_scenario_record(spark, tmp_path):
    summary = spark.createDataFrame([("campaign_roi", None)], "scenario STRING, roi_pct DOUBLE")
    paths = tables.save_scenario("roi", "r1", summary, str(tmp_path), spark.range(2), {"n": 5})
    row = spark.read.json(paths["summary"]).first()
    assert (row["run_id"], row["parameters"], row["roi_pct"]) == ("r1", '{"n": 5}', None)
    assert spark.read.parquet(paths["detail"]).count() == 2


def test_settled_rows_have_no_lineage(spark):
    df = settle(spark.range(5).withColumn("x", F.col("id") * 2))
    assert df.orderBy("id").collect()[4]["x"] == 8
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()
    assert fresh_path(spark, "x") != fresh_path(spark, "x") and shared_dir(spark) in fresh_path(spark, "x")


@pytest.fixture(scope="module")
def people(spark):
    rows = []
    for i in range(100):
        rows.append((f"c{i}", datetime(2017, 1, 1), datetime(2018, 1 + i % 8, 1), i % 4, 1.0 + i % 5, 100 * i, float(i)))
    return spark.createDataFrame(
        rows,
        """customer_unique_id STRING, first_purchase TIMESTAMP_NTZ, last_purchase TIMESTAMP_NTZ,
        n_late_deliveries INT, avg_review_score DOUBLE, revenue_cents BIGINT, total_revenue DOUBLE""",
    )


def test_tiers(people):
    rows = behavior.value_tiers(behavior.revenue_percentile(people)).collect()
    tiers = {r["customer_unique_id"]: (r["customer_tier"], r["segment"], r["strategic_account"]) for r in rows}
    assert tiers["c99"] == ("platinum", "high_value", True) and tiers["c98"] == ("platinum", "high_value", True)
    assert tiers["c90"] == ("gold", "high_value", False) and tiers["c59"] == ("silver", "standard", False)
    assert tiers["c58"] == ("bronze", "low_value", False)


def test_propensity_is_capped(people):
    rows = {r["customer_unique_id"]: r["ticket_probability"] for r in behavior.support_propensity(people).collect()}
    assert rows["c0"] == pytest.approx(0.08 + 0.2) and rows["c4"] == pytest.approx(0.08)
    assert rows["c3"] == pytest.approx(0.08 + 0.45) and max(rows.values()) <= 0.85


def test_event_window_ignores_the_last_purchase(people):
    moved = people.withColumn("last_purchase", F.lit(datetime(2018, 8, 1)).cast("timestamp_ntz"))
    a = behavior.event_window(people, fixed.MAX_VALID_DATE).collect()
    b = behavior.event_window(moved, fixed.MAX_VALID_DATE).collect()
    assert a == b and {r["window_days"] for r in a} == {607}


def test_revenue_alone_equals_the_behaviour_summary_and_costs_keep_columns(spark):
    stamp = datetime(2018, 1, 1)
    resolved = spark.createDataFrame(
        [("o1", "a", stamp, 3, False), ("o2", "a", stamp, None, None), ("o3", "b", stamp, 4, True)],
        "order_id STRING, customer_unique_id STRING, order_purchase_timestamp TIMESTAMP_NTZ, delivery_days INT, late_delivery_outlier BOOLEAN",
    )
    items = spark.createDataFrame(
        [("o1", 10.25, 1.0), ("o1", 5.0, None), ("o3", None, 2.5), ("o9", 7.0, 0.0)], "order_id STRING, price DOUBLE, freight_value DOUBLE"
    )
    got = behavior.revenue_summary(resolved, items)
    rows = {r["customer_unique_id"]: r["revenue_cents"] for r in got.collect()}
    assert rows == {"a": 1625, "b": 250}
    none = spark.createDataFrame([], "customer_unique_id STRING, resolution_hours DOUBLE")
    kept = behavior.customer_costs(got.withColumn("segment", F.lit("s")), none, keep=["segment"]).collect()
    assert {(r["customer_unique_id"], r["segment"], r["support_cost"]) for r in kept} == {("a", "s", 0.0), ("b", "s", 0.0)}
    assert behavior.revenue_summary(resolved.limit(0), items).count() == 0


def test_costs_and_lapsed(spark, people):
    tickets = spark.createDataFrame([("c2", 4.0), ("c2", 6.0)], "customer_unique_id STRING, resolution_hours DOUBLE")
    rows = {r["customer_unique_id"]: r for r in behavior.customer_costs(people, tickets).collect()}
    assert rows["c2"]["support_cost"] == 15.0 and rows["c2"]["annual_service_cost"] == 7.56
    assert rows["c3"]["support_cost"] == 0.0 and rows["c3"]["estimated_processing_cost"] == 0.05
    lapsed = behavior.lapsed_customers(people, fixed.MAX_VALID_DATE).collect()
    assert {r["last_purchase"].month for r in lapsed} == {1, 2, 3, 4} and min(r["days_quiet"] for r in lapsed) >= 150


def test_cascade_and_timing(spark, people):
    campaigns = spark.createDataFrame([(True, True, True), (False, True, False), (True, False, True)], "opened BOOLEAN, clicked BOOLEAN, converted BOOLEAN")
    assert tuple(behavior.cascade_violations(campaigns).first()) == (1, 1)
    touches = spark.createDataFrame([("c0", datetime(2018, 2, 1)), ("c0", datetime(2018, 8, 1)), ("c0", datetime(2019, 1, 1))], "customer_unique_id STRING, created_at TIMESTAMP_NTZ")
    row = behavior.intervention_timing(touches, people, fixed.MAX_VALID_DATE).first()
    assert tuple(row) == (3, 1, 1)


def test_unit_costs(spark):
    df = spark.createDataFrame([("email",), ("email",), ("push",), ("fax",)], "channel STRING")
    rows = {r["channel"]: r["total_cost"] for r in behavior.unit_costs(df, "channel", fixed.CHANNEL_COST).collect()}
    assert rows == {"email": 0.1, "push": 0.02, "fax": None}
