import hashlib
import random
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import ordered


@pytest.fixture(scope="module")
def values():
    rng = random.Random(7)
    # a third of all rows share one value
    rows = [0.0 if i % 3 == 0 else round(rng.uniform(-50, 50), 1) for i in range(400)]
    return pd.DataFrame({"id": range(400), "v": rows, "g": [("a", "b")[i % 2] for i in range(400)]})


@pytest.fixture(scope="module")
def df(spark, values):
    return spark.createDataFrame(values).repartition(5).cache()


def test_slice_of_counts_points_below(spark):
    rows = spark.range(10).select("id", ordered.slice_of("id", [2, 5, 7]).alias("s")).collect()
    assert {r["id"]: r["s"] for r in rows} == {i: sum(p < i for p in (2, 5, 7)) for i in range(10)}


@pytest.mark.parametrize("slices", ["1", "4", "300"])
def test_prefix_running_counts(spark, df, values, slices):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    try:
        ranked = ordered.prefix(df, "v", sums={"s": F.sum("v")})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = ranked.toPandas().sort_values("v")
    counts = values.groupby("v").agg(n=("v", "size"), s=("v", "sum"))
    assert got["n"].tolist() == counts["n"].tolist()
    assert got["before_n"].tolist() == (counts["n"].cumsum() - counts["n"]).tolist()
    assert np.allclose(got["before_s"], counts["s"].cumsum() - counts["s"])
    assert set(got["total_n"]) == {len(values)}


def test_prefix_descending_by_group(df, values):
    got = ordered.prefix(df, "v", ["g"], descending=True).toPandas()
    for g, part in values.groupby("g"):
        mine = got[got["g"] == g].sort_values("v", ascending=False)
        counts = part.groupby("v").size().sort_index(ascending=False)
        assert mine["before_n"].tolist() == (counts.cumsum() - counts).tolist()


def test_quantiles_interpolate(df, values):
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = ordered.quantile_list(df, "v", probabilities)
    assert np.allclose(got, values["v"].quantile(probabilities).tolist())


def test_medians_of_several_columns_skip_nulls(spark):
    rows = [("x", 1.0, None), ("x", 4.0, 2.0), ("y", 10.0, None), ("y", 12.0, None)]
    df = spark.createDataFrame(rows, "g STRING, a DOUBLE, b DOUBLE")
    got = {r["feature"]: r["median"] for r in ordered.medians(df, ["a", "b"]).collect()}
    assert got == {"a": 7.0, "b": 2.0}
    grouped = {(r["g"], r["feature"]): r["median"] for r in ordered.medians(df, ["a", "b"], ["g"]).collect()}
    assert grouped == {("x", "a"): 2.5, ("x", "b"): 2.0, ("y", "a"): 11.0}


def test_prefix_of_moments(spark):
    days = [datetime(2020, 1, 1 + i % 7) for i in range(50)]
    df = spark.createDataFrame([(d,) for d in days], "at TIMESTAMP_NTZ")
    got = {r["at"]: r["before_n"] for r in ordered.prefix(df, "at").collect()}
    assert got == {d: sum(x < d for x in days) for d in set(days)}


def test_percentile_rank_is_average_rank(df, values):
    got = ordered.percentile_rank(df, "v", "p").toPandas().sort_values("id")
    assert len(got) == len(values)
    assert np.allclose(got["p"], values["v"].rank(pct=True))


def test_leading_sums(df, values):
    takes = {"none": 0, "five": 5, "half": F.floor(F.col("total_n") / 2), "more": 1_000}
    got = {r["ask"]: r for r in ordered.leading_sums(df, "v", takes).collect()}
    down = sorted(values["v"], reverse=True)
    assert got["none"]["taken_sum"] == 0 and got["none"]["taken"] == 0
    assert got["five"]["taken_sum"] == pytest.approx(sum(down[:5]))
    assert got["half"]["taken_sum"] == pytest.approx(sum(down[:200]))
    assert got["more"]["taken"] == 400
    assert got["more"]["taken_sum"] == pytest.approx(sum(down))


@pytest.mark.parametrize("k", [0, 1, 37, 150, 200, 399, 400, 500])
def test_top_k_in_order(df, values, k):
    got = [r["id"] for r in ordered.top_k(df, "v", "id", k).collect()]
    assert got == values.sort_values(["v", "id"], ascending=[False, True]).head(k)["id"].tolist()


@pytest.mark.parametrize("k", [1, 37, 400, 500])
def test_one_table_of_sums_serves_both(df, k):
    ranked = ordered.descending_sums(df, "v", "v")
    rows = lambda x: [tuple(r) for r in x.collect()]
    assert rows(ordered.top_k(df, "v", "id", k, ranked)) == rows(ordered.top_k(df, "v", "id", k))
    takes = {"some": k, "all": 1_000}
    given = ordered.leading_sums(df, "v", takes, ranked=ranked)
    for a, b in zip(sorted(rows(given)), sorted(rows(ordered.leading_sums(df, "v", takes))), strict=True):
        assert a == pytest.approx(b)


def test_top_k_takes_missing_values_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None), (4, 7.0)], "id INT, v DOUBLE")
    assert [r["id"] for r in ordered.top_k(df, "v", "id", 3).collect()] == [4, 2, 1]
    assert [r["id"] for r in ordered.top_k(df.where("v IS NULL"), "v", "id", 1).collect()] == [1]


def test_large_pages_and_samples_keep_their_order(spark):
    df = spark.range(150_000).withColumn("k", F.md5(F.col("id").cast("string")))
    got = [r["k"] for r in ordered.page(df, "k", 120_000, 10).collect()]
    assert got == sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(150_000))[10:120_010]


@pytest.mark.parametrize("limit,offset", [(10, 0), (10, 25), (0, 5), (50, 380), (5, 400)])
def test_page_by_text_id(spark, values, limit, offset):
    text = spark.createDataFrame(values.assign(key=[f"cust_{i}" for i in values["id"]]))
    got = [r["key"] for r in ordered.page(text, "key", limit, offset).collect()]
    assert got == sorted(f"cust_{i}" for i in range(400))[offset : offset + limit]


def test_page_rejects_negative(df):
    with pytest.raises(ValueError):
        ordered.page(df, "id", -1)


def test_buckets_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.4,), (0.41,), (0.7,), (1.0,), (1.1,), (None,)], "p DOUBLE")
    bucket = ordered.fixed_buckets(F.col("p"), [0.0, 0.4, 0.7, 1.0], ["low", "medium", "high"])
    assert [r[0] for r in df.select(bucket).collect()] == [
        "low", "low", "medium", "medium", "high", None, None,
    ]


def test_quantile_buckets_match_qcut(df, values):
    got = ordered.quantile_buckets(df, "id", [0, 0.5, 0.8, 1.0], ["l", "m", "h"], "t").toPandas()
    want = pd.qcut(values["id"], [0, 0.5, 0.8, 1.0], labels=["l", "m", "h"])
    assert got.sort_values("id")["t"].tolist() == want.astype(str).tolist()


def test_equal_edges_are_an_error(df):
    with pytest.raises(ValueError, match="coincide"):
        ordered.quantile_buckets(df, "v", [0, 0.45, 0.5, 0.55, 0.56, 1.0], list("abcde"), "t")
    with pytest.raises(ValueError, match="labels"):
        ordered.quantile_buckets(df, "v", [0, 1.0], ["a", "b"], "t")


def test_seeded_sample_repeats(df):
    first = [r["id"] for r in ordered.seeded_sample(df, "id", 20).collect()]
    again = [r["id"] for r in ordered.seeded_sample(df.repartition(3), "id", 20).collect()]
    assert first == again and len(first) == 20


def test_medians_rank_only_values_near_the_middle(spark, monkeypatch):
    from holdfast.operators import ordered

    ranked, prefix = [], ordered.prefix
    monkeypatch.setattr(ordered, "prefix", lambda df, *a, **k: ranked.append(df.count()) or prefix(df, *a, **k))
    df = spark.range(40001).selectExpr(
        "CAST(id * 7919 % 40001 AS DOUBLE) AS a", "IF(id % 3 = 0, NULL, id) AS b", "id % 2 AS c", "CAST(NULL AS DOUBLE) AS d",
        "IF(id < 20001, -1.5D, id) AS e", "IF(id < 2, id, NULL) AS f",
    ).cache()
    got = {r["feature"]: r["median"] for r in ordered.medians(df, list("abcdef")).collect()}
    assert got == {"a": 20000.0, "b": 20000.0, "c": 0.0, "e": -1.5, "f": 0.5}
    # c and e have few values and bring all rows of those in the middle; nothing else but its middle
    assert sum(ranked) < 3 * 20001 + 400


def test_medians_without_groups_move_no_values(spark, monkeypatch):
    monkeypatch.setattr(ordered, "prefix", lambda *a, **k: pytest.fail("values were ranked"))
    inf, nan = float("inf"), float("nan")
    rows = [(-3.5, -0.0, 1.0, None), (2.25, 0.0, inf, None), (-1e300, 0.0, nan, 7.0), (1e-300, -5.0, 2.0, None)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    got = {r["feature"]: r["median"] for r in ordered.medians(df.repartition(3), list("abcd")).collect()}
    assert got == {"a": -3.5 + (1e-300 + 3.5) * 0.5, "b": 0.0, "c": inf, "d": 7.0}
    assert ordered.medians(df.limit(0), ["a"]).count() == 0
