"""Approximate quantiles by mergeable KLL sketches, where exact ones are not asked for.

A sketch of a group is a few kilobytes whatever the group holds, so sketches are stored per
period and merged for any span of periods without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: size of a sketch; ranks are off by at most RANK_ERROR with a confidence of 99 %
K, RANK_ERROR = 400, 0.01


def sketches(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """One row per group: its keys and ``sketch``; NULL values are skipped."""
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(K)).alias("sketch")
    )


def merged(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored sketches brought together by fewer keys."""
    return stored.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(stored: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by, probability, n, quantile`` from sketches: quantiles are values that occur."""
    rows = merged(stored, by).where(F.kll_sketch_get_n_double("sketch") > 0)
    # a sketch is asked for fixed ranks only
    asked = [
        F.struct(
            F.lit(float(p)).alias("probability"),
            F.kll_sketch_get_n_double("sketch").alias("n"),
            F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile"),
        )
        for p in probabilities
    ]
    return rows.select(*by, F.explode(F.array(*asked)).alias("q")).select(*by, "q.*")
