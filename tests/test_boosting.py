import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.plans import boosting, model
from holdfast.plans.boosting import Input, Settings, Tree

RELAXED = Settings(rounds=4, patience=30, rows=1.0, columns=1.0, child_weight=2.0)


def plain_split(rows, g, h, inputs, s):
    """Best split by trying each one on the rows themselves."""
    best = (boosting.LEAST_GAIN, None)

    def worth(take):
        gs, hs = g[take].sum(), h[take].sum()
        return max(abs(gs) - s.l1, 0) ** 2 / (hs + s.l2)

    everything = np.ones(len(rows), bool)
    for i, own in enumerate(inputs):
        for b in range(own.values or len(own.edges)):
            left = rows[:, i] == b if own.values else rows[:, i] <= b
            if h[left].sum() < s.child_weight or h[~left].sum() < s.child_weight:
                continue
            gain = (worth(left) + worth(~left) - worth(everything)) / 2
            if gain > best[0] + 1e-12:
                best = (gain, (i, b))
    return best


def test_best_split_equals_trying_all():
    rng = np.random.default_rng(3)
    inputs = [Input("a", tuple(range(7))), Input("b", values=5), Input("c", (0.0,)), Input("none")]
    s = Settings(child_weight=3.0)
    for _ in range(20):
        rows = np.stack([rng.integers(0, i.bins, 200) for i in inputs], axis=1)
        g, h = rng.normal(size=200) + (rows[:, 1] == 2), rng.uniform(0.05, 0.25, 200)
        sums = {
            i: np.stack([np.bincount(rows[:, i], w, own.bins) for w in (g, h)]) for i, own in enumerate(inputs)
        }
        masks = {i: np.ones(own.values or len(own.edges), bool) for i, own in enumerate(inputs)}
        found = boosting.best_split(sums, inputs, masks, s)
        gain, where = plain_split(rows, g, h, inputs, s)
        assert (found is None) == (where is None)
        if found:
            assert found[0] == pytest.approx(gain) and found[1:3] == where


def test_leaf_shrinks():
    s = Settings(step=0.1, l1=0.5, l2=2.0)
    assert boosting.leaf(3.0, 8.0, s) == pytest.approx(-0.1 * 2.5 / 10)
    assert boosting.leaf(-3.0, 8.0, s) == pytest.approx(0.1 * 2.5 / 10)
    assert boosting.leaf(0.4, 8.0, s) == 0.0


def test_average_precision_by_steps():
    rng = np.random.default_rng(1)
    score, label = rng.integers(0, 9, 300), rng.integers(0, 2, 300)
    seen = np.zeros((10, 2), np.int64)
    np.add.at(seen, (score, label), 1)
    want, last = 0.0, 0.0
    for t in range(9, -1, -1):
        chosen = score >= t
        if chosen.any():
            recall = label[chosen].sum() / label.sum()
            want += (recall - last) * label[chosen].mean()
            last = recall
    assert boosting.average_precision(seen) == pytest.approx(want)
    assert boosting.average_precision(np.zeros((4, 2), np.int64)) == 0.0


def test_samples_differ_by_tree_and_repeat():
    keys = np.arange(20000, dtype=np.int64)
    first, second = (boosting.sampled(keys, 42, n, 0.8) for n in (0, 1))
    assert abs(first.mean() - 0.8) < 0.01 and abs((first & second).mean() - 0.64) < 0.02
    assert (first == boosting.sampled(keys, 42, 0, 0.8)).all()


def test_unsplit_nodes_send_rows_left():
    tree = Tree([[0], [-1, 1]], [[1], [0, 2]], [[False], [False, True]], [1.0, 0.0, 2.0, 3.0])
    codes = np.array([[0, 2], [1, 0], [2, 2], [2, 1]], np.int32)
    assert tree.margins(codes).tolist() == [1.0, 1.0, 2.0, 3.0]


@pytest.fixture(scope="module")
def shopping(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        spend, city = round(rng.uniform(0, 50), 1), f"c{rng.randint(0, 299)}"
        state = rng.choice(["N", "S", None])
        bad = int(city[1:]) % 3 == 0 or spend > 40
        rows.append((i, spend if i % 9 else None, state, city if i % 11 else None, int(i % 2), int(bad != (rng.random() < 0.1))))
    return spark.createDataFrame(rows, "id INT, spend DOUBLE, state STRING, city STRING, flag INT, churned INT").cache()


def trained(shopping, wide, settings=RELAXED):
    train, validation = shopping.where("id % 4 <> 0"), shopping.where("id % 4 = 0")
    terms = model.prepare(train, ["spend"], ["state", "city"], ["flag"], wide=wide)
    return train, validation, terms, model.fit_trees(train, validation, terms, settings)


def test_first_tree_equals_plain_growth(shopping):
    """Bins, sums, splits and leaves of one tree against rows in memory."""
    train, validation, terms, (_, trees) = trained(shopping, 1000, Settings(rounds=1, rows=1.0, columns=1.0, child_weight=2.0))
    data = train.withColumn("w", model.balanced_weight(train)).select(
        *[F.expr(t.value).alias(f"x{i}") for i, t in enumerate(terms)], "w", "churned"
    ).toPandas().to_numpy(float)
    x, w, y = data[:, :-2], data[:, -2], data[:, -1]
    (tree,) = trees
    g, h = w * (0.5 - y), w * 0.25
    s = Settings(child_weight=2.0)

    def worth(take):
        return max(abs(g[take].sum()) - s.l1, 0) ** 2 / (h[take].sum() + s.l2)

    everything = np.ones(len(x), bool)
    best = max(
        (worth(left) + worth(~left) - worth(everything)) / 2
        for i in range(x.shape[1])
        for v in np.unique(x[:, i])
        for left in [x[:, i] <= v]
        if h[left].sum() >= 2 and h[~left].sum() >= 2
    )
    # the split that the tree took is as good as the best of all
    name = [t.name for t in terms if t.kind in ("number", "flag")]
    i, b, single = tree.inputs[0][0], tree.bins[0][0], tree.single[0][0]
    assert single or name[i] in ("spend", "flag")
    if single:
        column = ("state", "city")[i - 2]
        own = [j for j, t in enumerate(terms) if t.column == column][b]
        left = x[:, own] == 1
    else:
        j = [k for k, t in enumerate(terms) if t.name == name[i]][0]
        values = np.unique(x[:, j])
        left = min((x[:, j] <= v for v in values), key=lambda m: abs((worth(m) + worth(~m) - worth(everything)) / 2 - best))
    assert (worth(left) + worth(~left) - worth(everything)) / 2 == pytest.approx(best, rel=1e-6)


def test_wide_categories_give_the_same_trees_and_scores(shopping):
    narrow = trained(shopping, 1000)
    wide = trained(shopping, 100)
    assert [t.kind for t in wide[2]].count("wide") == 1
    scores = [
        {r["id"]: r[model.SCORE] for r in model.score(fit[3][0], shopping).select("id", model.SCORE).collect()}
        for fit in (narrow, wide)
    ]
    assert len(scores[0]) == 600 and scores[0] == pytest.approx(scores[1], abs=1e-12)
    assert all(a.leaves == pytest.approx(b.leaves) for a, b in zip(narrow[3][1], wide[3][1], strict=True))


def test_trees_learn_and_repeat(shopping, tmp_path):
    train, validation, terms, (pipeline, trees) = trained(shopping, 100, Settings(patience=5, step=0.3))
    again = model.fit_trees(train, validation, terms, Settings(patience=5, step=0.3))[1]
    assert [(t.inputs, t.bins, t.leaves) for t in trees] == [(t.inputs, t.bins, t.leaves) for t in again]
    auc = model.evaluate(model.score(pipeline, shopping.withColumn("split", F.lit("all"))), "churned", model.SCORE).first()
    assert auc["roc_auc"] > 0.65
    model.save(pipeline, str(tmp_path / "m"))
    loaded = model.load(str(tmp_path / "m"))
    before, after = ([r[0] for r in model.score(m, shopping).orderBy("id").select(model.SCORE).collect()] for m in (pipeline, loaded))
    assert before == after


def test_margins_are_stored_on_the_way(shopping, monkeypatch):
    plain = trained(shopping, 100, Settings(rounds=7, patience=30))[3][1]
    monkeypatch.setattr(boosting, "STORED", 3)
    stored = trained(shopping, 100, Settings(rounds=7, patience=30))[3][1]
    assert all(a.leaves == pytest.approx(b.leaves) for a, b in zip(plain, stored, strict=True))


def test_empty_and_one_class_training(shopping):
    empty = shopping.limit(0)
    terms = model.prepare(empty, ["spend"], ["state"], ["flag"])
    pipeline, trees = model.fit_trees(empty, shopping, terms)
    assert trees == [] and {r[0] for r in model.score(pipeline, shopping).select(model.SCORE).collect()} == {0.5}
    alike = shopping.withColumn("churned", F.lit(1))
    pipeline, trees = model.fit_trees(alike, alike, terms, Settings(rounds=3))
    assert all(p > 0.5 for (p,) in model.score(pipeline, shopping).select(model.SCORE).collect()) or not trees


def test_wide_logistic_equals_one_column_per_value(spark, shopping):
    train = shopping.where("id % 4 <> 0")
    fits = {}
    for wide in (1000, 100):
        terms = model.prepare(train, ["spend"], ["state", "city"], ["flag"], wide=wide)
        fits[wide] = (*model.fit_logistic(train, terms), terms)
    a, b = ({r["id"]: r[model.SCORE] for r in model.score(fits[w][0], shopping).select("id", model.SCORE).collect()} for w in (1000, 100))
    assert a == pytest.approx(b, abs=1e-4)
    by_value = {r["value"]: r["coefficient"] for r in model.wide_coefficients(fits[100][0], fits[100][1]).collect()}
    listed = {t.name.removeprefix("city_"): t.coefficient for t in fits[1000][1] if t.column == "city"}
    assert by_value.keys() == listed.keys() and by_value == pytest.approx(listed, abs=1e-3)
    unseen = spark.createDataFrame([(1, 2.0, "X", "elsewhere", 1, 0)], shopping.schema)
    assert 0 < model.score(fits[100][0], unseen).first()[model.SCORE] < 1


def test_rows_lie_in_blocks_and_only_the_lighter_sibling_is_summed(shopping, monkeypatch):
    asked, tables = [], []
    scan, boost = boosting._scan, boosting.boost
    monkeypatch.setattr(boosting, "_scan", lambda *a: asked.append((len(a[3].inputs), len(a[7]))) or scan(*a))
    monkeypatch.setattr(boosting, "boost", lambda rows, *a: tables.append(rows.count()) or boost(rows, *a))
    trees = trained(shopping, 100, Settings(rounds=2, child_weight=2.0))[3][1]
    assert trees and tables[0] < 100  # blocks of 600 rows
    assert all(n <= max(1, 1 << level - 1) if level else n == 1 for level, n in asked)


def test_a_pass_is_one_job_over_kept_blocks(spark, shopping, monkeypatch):
    context, calls = spark.sparkContext, []
    scan, kept = boosting._scan, lambda: len(context._jsc.getPersistentRDDs())

    def watched(rows, *a):
        context.setJobGroup(f"pass {len(calls)}", "")
        found = scan(rows, *a)
        calls.append((len(context.statusTracker().getJobIdsForGroup(f"pass {len(calls)}")), kept() - before))
        context.setJobGroup("other", "")
        return found

    monkeypatch.setattr(boosting, "_scan", watched)
    before = kept()
    trees = trained(shopping, 100, Settings(rounds=2, child_weight=2.0))[3][1]
    assert trees and len(calls) >= 4 and calls == [(1, 1)] * len(calls)
    assert kept() == before


def test_sums_of_many_tasks_meet_in_spark(shopping, monkeypatch):
    plain = trained(shopping, 100, Settings(rounds=2))[3][1]
    monkeypatch.setattr(boosting, "MANY", 1)
    many = trained(shopping, 100, Settings(rounds=2))[3][1]
    assert [(t.inputs, t.bins, t.leaves) for t in plain] == [(t.inputs, t.bins, t.leaves) for t in many]


def test_sums_of_two_tasks_add_up():
    a = np.array([[1, 2], [3, 4]]), np.array([0, 5]), np.array([2, 1])
    b = np.array([[10, 0], [0, 10]]), np.array([3, 5]), np.array([1, 4])
    sums, used, times = boosting._added(a, b)
    assert sums.tolist() == [[11, 2], [3, 14]] and used.tolist() == [0, 3, 5] and times.tolist() == [2, 1, 5]
    assert [x.tolist() for x in boosting._added(a, (b[0], b[1][:0], b[2][:0]))[1:]] == [[0, 5], [2, 1]]


def test_edges_of_more_numbers_than_one_pass_takes(spark, monkeypatch):
    rows = spark.range(500).selectExpr(*[f"IF(id % 7 = 0, NULL, CAST(id * {k} % 101 AS DOUBLE)) AS c{k}" for k in range(1, 6)])
    numbers = {f"n{k}": f"coalesce(c{k}, {k}D) / 2" for k in range(1, 6)}
    whole, jobs = boosting.edges_of(rows, numbers), []
    first = type(rows).first
    monkeypatch.setattr(boosting, "TOGETHER", 2)
    monkeypatch.setattr(type(rows), "first", lambda df: jobs.append(df.columns) or first(df))
    assert boosting.edges_of(rows, numbers) == whole and len(jobs) == 3
    assert all(len(e) > 50 and e == tuple(sorted(set(e))) for e in whole.values()) and boosting.edges_of(rows, {}) == {}


def test_bins_are_made_outside_whole_stage_code(shopping, monkeypatch, capsys):
    monkeypatch.setattr(boosting, "settle", lambda df: df.explain() or df)
    inputs, numbers = [Input("spend", (10.0, 20.0)), Input("flag", (0.0,))], {"spend": "coalesce(spend, 0D)", "flag": "CAST(flag AS DOUBLE)"}
    table = boosting.binned(shopping, inputs, numbers, {}, F.xxhash64("id"), "churned", F.lit(1.0), F.col("id") >= 0)
    made = [line for line in capsys.readouterr().out.splitlines() if "AS numbers" in line]
    assert made and not any("*(" in line for line in made)
    block = table.first()
    codes = np.frombuffer(block["codes"], np.uint8).reshape(2, -1)
    keys = dict(zip(np.frombuffer(block["key"], np.int64).tolist(), codes.T.tolist()))
    for r in shopping.select(F.xxhash64("id").alias("k"), F.coalesce("spend", F.lit(0.0)).alias("spend"), "flag").collect():
        assert r["k"] not in keys or keys[r["k"]] == [(r["spend"] > 10) + (r["spend"] > 20), r["flag"]]
    assert keys
