import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import columns, sketches


def made(spark, n=500):
    rng = np.random.default_rng(4)
    a, b = rng.normal(1e6, 1.0, n), rng.normal(size=n)
    data = []
    for i in range(n):
        hole = None if i % 7 == 0 else float(b[i])
        data.append((i, float(a[i]), float(a[i]), hole, hole, float(a[i] + b[i]), 5.0, None))
    schema = "id INT, a DOUBLE, same DOUBLE, hole DOUBLE, hole2 DOUBLE, mixed DOUBLE, flat DOUBLE, empty DOUBLE"
    return spark.createDataFrame(data, schema).repartition(3)


NAMES = ["a", "same", "hole", "hole2", "mixed", "flat", "empty"]


def test_equal_pairs_with_missing_values(spark):
    df = made(spark)
    found = {(r["column_a"], r["column_b"]) for r in columns.equal_pairs(df, NAMES, ["id"]).collect()}
    assert found == {("a", "same"), ("hole", "hole2")}
    near = df.withColumn("same", F.when(F.col("id") == 77, 0.0).otherwise(F.col("same")))
    assert ("a", "same") not in {tuple(r) for r in columns.equal_pairs(near, NAMES, ["id"]).collect()}
    assert columns.equal_pairs(df.limit(0), NAMES, ["id"]).count() == 0


def test_correlations_equal_pairwise_ones(spark):
    df = made(spark)
    got = {(r["column_a"], r["column_b"]): (r["n"], r["correlation"]) for r in columns.correlations(df, NAMES).collect()}
    frame = df.toPandas()[NAMES].astype(float)
    want = frame.corr()
    assert len(got) == len(NAMES) * (len(NAMES) - 1) // 2
    for (x, y), (n, r) in got.items():
        assert n == (frame[x].notna() & frame[y].notna()).sum()
        if "flat" in (x, y) or "empty" in (x, y):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[x, y], abs=1e-9)
    assert all(r["correlation"] is None for r in columns.correlations(df.limit(0), NAMES).collect())


def test_merged_sketches_keep_the_bound(spark):
    rows = spark.range(60_000).select((F.col("id") % 9).alias("month"), F.sqrt("id").alias("v"))
    rows = rows.unionByName(spark.range(50).select(F.lit(1).cast("bigint").alias("month"), F.lit(None).cast("double").alias("v")))
    stored = sketches.sketches(rows, "v", ["month"])
    assert stored.count() == 9
    for r in sketches.sketch_quantiles(stored, [0.01, 0.5, 0.9]).collect():
        assert r["n"] == 60_000 and abs(r["quantile"] ** 2 / 60_000 - r["probability"]) <= sketches.RANK_ERROR
    by_month = sketches.sketch_quantiles(stored, [0.5], ["month"]).collect()
    assert len(by_month) == 9 and sketches.sketch_quantiles(stored.limit(0), [0.5]).count() == 0
