"""A cross-section of the named queries against SQL; ``tools/compare.py`` runs them all."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

from holdfast.registry.oracle import oracle_sql  # noqa: E402
from holdfast.registry.queries import queries  # noqa: E402
from tools.compare import TABLES, rows_of  # noqa: E402

SAMPLE = [
    "stage_orders", "order_summary", "dq_checks", "iqr_outliers", "event_log_gaps", "cart_split_sellers",
    "pareto_customers", "revenue_by_category", "snapshot_features_full", "split_summary",
    "value_tiers", "roc_auc", "explanations", "tenure_skew", "marginal_curve", "tier_movement",
    "customers_page", "feature_store_snapshot", "csv_roundtrip",
]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_only_fitted_and_sampled_queries_lack_sql():
    assert set(queries()) - set(oracle_sql()) == {"lr_train_score", "gbt_train_score", "model_comparison"}
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, db, name):
    df = queries()[name](spark, FOLDER)
    cursor = db.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize(
    "name",
    ["fitted_attributions", "fitted_importance", "fitted_explanations", "prepared_inputs_all", "reference_medians_all"],
)
def test_explanations_of_the_fitted_model_over_all_inputs(spark, db, name):
    test_query_matches_sql(spark, db, name)


def test_trees_are_fitted_anew_in_each_query(monkeypatch):
    from types import SimpleNamespace

    from holdfast.registry import queries as named

    fits = []
    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="one"))
    monkeypatch.setattr(named, "_modelling", lambda s, f: ({"train": 1, "validation": 2}, "panel"))
    monkeypatch.setattr(named.model, "fit_trees", lambda *rows: fits.append(rows) or len(fits))
    assert named._fitted_trees(spark, "f") == ("panel", 1) and named._fitted_trees(spark, "f") == ("panel", 2)


def test_comparison_prepares_the_inputs_of_both_models_once(spark, monkeypatch):
    from holdfast.registry import queries as named

    panel = spark.range(40).selectExpr("id", "IF(id % 4 = 0, 'validation', 'train') AS split", "CAST(id % 2 AS INT) AS churned")
    given, learned = [], []
    rows = {s: panel.where(f"split = '{s}'") for s in ("train", "validation", "test")}
    monkeypatch.setattr(named, "_modelling", lambda s, f: (rows, panel))
    monkeypatch.setattr(named.model, "prepare", lambda train: learned.append(train) or ["terms"])
    monkeypatch.setattr(named.model, "fit_trees", lambda train, seen, terms=None: given.append(terms or named.model.prepare(train)) or ("a", []))
    monkeypatch.setattr(named.model, "fit_logistic", lambda train, terms=None: given.append(terms or named.model.prepare(train)) or ("b", []))
    monkeypatch.setattr(named.model, "score", lambda m, df: df.selectExpr("*", f"id / 40D AS {named.SCORE}"))
    assert named.queries()["model_comparison"](spark, "f").count() == 4
    assert len(learned) == 1 and given == [["terms"], ["terms"]]
