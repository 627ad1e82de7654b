import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.functions.wording import measured, plain_label, yes_no
from holdfast.operators import metrics
from holdfast.operators.profile import drift
from holdfast.plans import explain, model

NUMBERS = ["recency", "spend", "gap"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(400):
        recency, spend = rng.uniform(0, 300), rng.uniform(0, 1000)
        gap = rng.uniform(1, 90) if rng.random() < 0.6 else None
        state = rng.choice(["SP", "SP", "RJ", None])
        churned = int(rng.random() < 1 / (1 + np.exp(-(recency - 120) / 60)))
        split = ("train", "train", "validation", "test")[i % 4]
        data.append((i, recency, spend, gap, state, int(gap is not None), churned, split, 1 + i % 3))
    return spark.createDataFrame(
        data,
        "id INT, recency DOUBLE, spend DOUBLE, gap DOUBLE, state STRING, has_gap INT, churned INT, split STRING, lifetime_orders INT",
    ).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    train = rows.where("split = 'train'")
    terms = model.prepare(train, NUMBERS, ["state"], ["has_gap"])
    return model.fit_logistic(train, terms)


def test_preparation(rows, fitted):
    terms = fitted[1]
    assert [t.name for t in terms] == [*NUMBERS, "state_RJ", "state_SP", "has_gap"]
    train = rows.where("split = 'train'").select(*[F.expr(t.value).alias(f"x{i}") for i, t in enumerate(terms)]).toPandas()
    assert np.allclose(train[["x0", "x1", "x2"]].mean(), 0, atol=1e-9)
    assert np.allclose(train[["x0", "x1", "x2"]].std(ddof=0), 1)
    # a missing state counts as the most frequent one, an unknown one as none
    unseen = rows.limit(1).withColumn("state", F.lit("ZZ")).select(F.expr(terms[3].value), F.expr(terms[4].value)).first()
    assert tuple(unseen) == (0.0, 0.0)
    missing = rows.limit(1).withColumn("state", F.lit(None).cast("string")).select(F.expr(terms[4].value)).first()
    assert missing[0] == 1.0


def test_logistic_solution_zeroes_the_gradient(rows, fitted):
    """Of the usual objective: half the squared weights plus the sum of weighted losses."""
    pipeline, terms = fitted
    train = rows.where("split = 'train'")
    x = train.select(*[F.expr(t.value).alias(f"x{i}") for i, t in enumerate(terms)], "churned").toPandas().to_numpy(float)
    x, y = x[:, :-1], x[:, -1]
    w = np.array([t.coefficient for t in terms])
    b = pipeline.stages[-1].intercept
    weight = len(y) / (2 * np.where(y == 1, y.sum(), len(y) - y.sum()))
    residual = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    assert np.abs(w + x.T @ residual).max() < 1e-2 and abs(residual.sum()) < 1e-2


def test_scores_agree_with_term_arithmetic(rows, fitted):
    pipeline, terms = fitted
    a = model.score(pipeline, rows).select("id", model.SCORE)
    b = model.linear_score(rows, terms, float(pipeline.stages[-1].intercept)).select("id", F.col(model.SCORE).alias("p"))
    worst = a.join(b, "id").agg(F.max(F.abs(F.col(model.SCORE) - F.col("p")))).first()[0]
    assert worst < 1e-9


def test_save_and_load(spark, rows, fitted, tmp_path):
    pipeline, terms = fitted
    model.save(pipeline, str(tmp_path / "m"), terms)
    loaded = model.load(str(tmp_path / "m"))
    assert model.load_terms(spark, str(tmp_path / "m")) == terms
    before = [r[0] for r in model.score(pipeline, rows).orderBy("id").select(model.SCORE).collect()]
    after = [r[0] for r in model.score(loaded, rows).orderBy("id").select(model.SCORE).collect()]
    assert before == after


def test_trees_stop_early_and_compare(rows, fitted):
    pipeline, terms = fitted
    train, validation = rows.where("split = 'train'"), rows.where("split = 'validation'")
    trees, grown = model.fit_trees(train, validation, terms)
    assert 1 < len(grown) < fixed.TREE_SETTINGS["rounds"]
    scored = {n: model.score(m, rows) for n, m in (("lr", pipeline), ("gbt", trees))}
    assert scored["gbt"].columns == [*rows.columns, model.SCORE]
    table = model.compare(scored).collect()
    assert len(table) == 6 and all(0.5 < r["roc_auc"] <= 1 for r in table if r["split"] == "train")
    assert all(r["gap_to_train"] == 0 for r in table if r["split"] == "train")
    cold = model.cold_start(scored["lr"]).collect()
    assert {r["history"] for r in cold} == {"lifetime_orders = 1", "lifetime_orders >= 2"}


def test_exact_metrics_with_ties(spark):
    rng = np.random.default_rng(0)
    p, y = rng.integers(0, 8, 200) / 8, rng.integers(0, 2, 200)
    df = spark.createDataFrame([(float(a), int(b), "s") for a, b in zip(p, y)] + [(0.5, 1, "one")], "p DOUBLE, y INT, g STRING")
    auc = {r["g"]: r["roc_auc"] for r in metrics.roc_auc(df, "y", "p", ["g"]).collect()}
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert auc["s"] == pytest.approx(wins / (len(pos) * len(neg))) and auc["one"] is None
    ap = {r["g"]: r["pr_auc_retained"] for r in metrics.average_precision_retained(df, "y", "p", ["g"]).collect()}
    want, last = 0.0, 0.0
    for t in sorted(set(1 - p), reverse=True):
        chosen = 1 - p >= t
        recall = (y[chosen] == 0).sum() / (y == 0).sum()
        want += (recall - last) * (y[chosen] == 0).mean()
        last = recall
    assert ap["s"] == pytest.approx(want) and ap["one"] is None
    report = {r["class"]: r for r in metrics.classification_report(df.where("g = 'one'"), "y", "p").collect()}
    assert report["1"]["precision"] == 0.0 and report["0"]["recall"] == 0.0 and report["accuracy"]["support"] == 1


def test_attribution_and_importance(rows, fitted):
    _, terms = fitted
    train = rows.where("split = 'train'")
    means = explain.background_means(train, terms)
    long = explain.attributions(train, terms, means, ["id"])
    totals = {r["feature"]: r["s"] for r in long.groupBy("feature").agg(F.avg("attribution").alias("s")).collect()}
    assert len(totals) == len(terms) and all(abs(v) < 1e-9 for v in totals.values())
    top = explain.global_importance(train, terms, means, top=3).collect()
    assert top[0]["feature"] == "recency" and len(top) == 3
    assert explain.background_sample(train, "id", 50).count() == 50


def test_explanations_suppress_and_backfill(rows, fitted):
    _, terms = fitted
    renamed = "has_been_targeted_for_retention"
    data = rows.withColumnRenamed("has_gap", renamed)
    forced = [model.Term(renamed, renamed, "flag", f"CAST({renamed} AS DOUBLE)", 999.0) if t.name == "has_gap" else t for t in terms]
    means = explain.background_means(data, forced)
    texts = [r["top_factors"] for r in explain.explanations(data, forced, means, {"recency": 40.24}, ["id"], top=5).collect()]
    assert all(len(t.split("\n")) == 5 and "retention offer" not in t for t in texts)
    assert any("Recency: " in t and "(typical for returning customers: 40.2)" in t for t in texts)
    assert all("increases churn risk" in t or "decreases churn risk" in t for t in texts)
    assert explain.global_importance(data, forced, means, 1).first()["plain_label"] == "Has previously received a retention offer"


def test_labels():
    for name in [f"numeric__{c}" for c in fixed.NUMERIC_FEATURES] + [f"indicators__{c}" for c in fixed.INDICATORS]:
        assert plain_label(name) == fixed.FEATURE_LABELS[name.split("__")[1]]
    assert plain_label("categorical__preferred_payment_method_credit_card") == "Usually pays by credit card"
    assert plain_label("categorical__customer_state_SP") == "Located in SP"
    assert plain_label("some_other_thing") == "Some other thing"


def test_wording(spark):
    df = spark.createDataFrame([(1234.56, 40.25), (12.34, None), (None, 3.0)], "v DOUBLE, t DOUBLE")
    got = [r[0] for r in df.select(measured(F.lit("L"), F.col("v"), F.col("t"))).collect()]
    assert got == ["L: 1,235 (typical for returning customers: 40.2)", "L: 12.3", "L: not available"]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "f BOOLEAN")
    assert [r[0] for r in flags.select(yes_no(F.lit("L"), F.col("f"))).collect()] == ["L: Yes", "L: No", "L: not available"]


def test_drift_flags_jumps(spark):
    left = spark.createDataFrame([(1.0, None), (2.0, None)], "a DOUBLE, b DOUBLE")
    right = spark.createDataFrame([(1.0, 1.0), (5.0, None)], "a DOUBLE, b DOUBLE")
    got = {r["feature"]: r for r in drift(left, right, ["a", "b"]).collect()}
    assert (got["b"]["null_pct_jump"], got["b"]["flagged"], got["a"]["flagged"]) == (50.0, True, False)
    assert got["a"]["training_max"] == 5.0


def test_moments_are_taken_a_few_at_a_time(spark, monkeypatch):
    df = spark.range(5)
    asked, agg = [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *a: asked.append(len(a)) or agg(self, *a))
    found = model.sums_of(df, [F.sum(F.col("id") + i).alias(f"s{i}") for i in range(40)])
    assert found == {f"s{i}": 10 + 5 * i for i in range(40)} and max(asked) <= model.TOGETHER


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_preparation_and_attributions_are_not_fused(rows, fitted):
    """A fused projection of many inputs is too long for the JVM to compile."""
    pipeline, terms = fitted
    means = [0.0] * len(terms)
    for df in (model.score(pipeline, rows), explain.attributions(rows, terms, means, ["id"])):
        made = [line for line in _plan(df) if "transform(" in line]
        assert made and not any("*(" in line for line in made)


def test_importance_takes_a_few_inputs_in_a_pass(spark, monkeypatch):
    df = spark.createDataFrame([(float(i), i) for i in range(4)], "x DOUBLE, n INT")
    terms = [model.Term(f"t{i:02d}", "x", "number", "x", float(i)) for i in range(40)]
    grouped = type(df.groupBy())
    asked, agg = [], grouped.agg
    monkeypatch.setattr(grouped, "agg", lambda self, *a: asked.append(len(a)) or agg(self, *a))
    top = explain.global_importance(df, terms, [1.5] * 40, 3).collect()
    assert [(r["feature"], r["mean_abs_attribution"]) for r in top] == [("t39", 39.0), ("t38", 38.0), ("t37", 37.0)]
    assert sum(asked) == 40 and max(asked) <= model.TOGETHER


def test_a_loaded_model_prepares_unfused_too(rows, fitted, tmp_path):
    model.save(fitted[0], str(tmp_path / "m"))
    made = [line for line in _plan(model.score(model.load(str(tmp_path / "m")), rows)) if "transform(" in line]
    assert made and not any("*(" in line for line in made)


def test_roundtrip_compares_scores_in_the_row(rows, fitted, monkeypatch):
    """No join deals the panel twice, and a model that comes back otherwise is told."""
    from holdfast.registry import queries as named

    pipeline, terms = fitted
    panel = rows.withColumn("customer_unique_id", F.col("id")).withColumn("snapshot_date", F.lit("2017-07-01"))
    monkeypatch.setattr(named, "_fitted_logistic", lambda s, f: (None, panel, pipeline, terms))
    found = named.queries()["model_roundtrip"](rows.sparkSession, "")
    assert found.columns == ["customer_unique_id", "snapshot_date", "same_score"]
    assert not any("Join" in line for line in _plan(found))
    assert sorted(tuple(r) for r in found.collect()) == [(i, "2017-07-01", True) for i in range(400)]
    train = rows.where("split = 'train'")
    other, _ = model.fit_logistic(train.withColumn("churned", 1 - F.col("churned")), terms)
    monkeypatch.setattr(named.model, "load", lambda path: other)
    assert found.columns == (changed := named.queries()["model_roundtrip"](rows.sparkSession, "")).columns
    assert changed.where("same_score").count() < 400
