"""Audit of all column pairs of a table in one pass: equal columns and correlations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.session import ship


def _fingerprint(key: Sequence[str], column: str, seed: int) -> Column:
    """A hash of all (row, value) pairs of a column; NULL is a value of its own."""
    value = F.col(column).cast("double")
    # adding zero turns -0.0 into 0.0
    return F.bit_xor(F.xxhash64(F.lit(seed), *key, value.isNull(), F.coalesce(value, F.lit(0.0)) + 0.0))


def equal_pairs(df: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Pairs ``column_a, column_b`` of numeric columns that agree in every row, NULLs included.

    ``key`` names a row: its values must be unique, as rows alike in all respects cancel out.
    One aggregate takes 128 bits of fingerprint per column, whatever the number of pairs.
    The pairs are found in the one row it returns; an empty table has no pairs.
    """
    sums = [_fingerprint(key, c, s).alias(f"f{i}_{s}") for i, c in enumerate(columns) for s in (0, 1)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    marks = [(row[f"f{i}_0"], row[f"f{i}_1"]) for i in range(len(columns))]
    found = [
        (a, b)
        for i, a in enumerate(columns)
        for j, b in enumerate(columns[i + 1 :], i + 1)
        if row["n"] and marks[i] == marks[j]
    ]
    return df.sparkSession.createDataFrame([tuple(sorted(p)) for p in found], "column_a STRING, column_b STRING")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_a, column_b, n, correlation`` of all pairs of numeric columns.

    A pair counts the rows in which both have a value; it has no correlation with fewer than
    two of them or where one does not vary. Each task adds up four products of matrices (its
    values, their squares and which are there), shifted by the column means so that large
    values do not cancel; Spark sums them by pair.
    """
    names = list(columns)
    wide = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    middle = wide.agg(*[F.avg(c).alias(c) for c in wide.columns]).first()
    shift = np.array([middle[c] or 0.0 for c in wide.columns])
    k = len(names)
    upper = np.triu_indices(k, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, k))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(np.float64) - shift
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(np.float64)
            s, q = x.T @ m, (x * x).T @ m
            total += np.stack([m.T @ m, s, s.T, q, q.T, x.T @ x])
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), *[pa.array(t[upper]) for t in total]],
            ["a", "b", *SUMS],
        )

    ship(df.sparkSession)
    schema = "a int, b int, " + ", ".join(f"{s} double" for s in SUMS)
    sums = wide.mapInArrow(run, schema).groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in SUMS])
    n, sx, sy, xx, yy, xy = (F.col(s) for s in SUMS)
    both = (n * xx - sx * sx) * (n * yy - sy * sy)
    r = F.when((n > 1) & (both > 0), (n * xy - sx * sy) / F.sqrt(both))
    name = F.array(*[F.lit(c) for c in names])
    return sums.select(
        F.least(name[F.col("a")], name[F.col("b")]).alias("column_a"),
        F.greatest(name[F.col("a")], name[F.col("b")]).alias("column_b"),
        n.cast("bigint").alias("n"),
        r.alias("correlation"),
    )


SUMS = ("n", "sx", "sy", "xx", "yy", "xy")


def apart(text: str) -> str:
    """SQL of the expression ``text`` by way of a lambda, with the same value.

    Spark leaves a projection with a lambda out of whole-stage code and splits its code into short methods.
    The JVM compiles methods of up to 8,000 bytes; a fused projection of many columns is longer and interpreted.
    """
    return f"transform(array({text}), x -> x)[0]"
