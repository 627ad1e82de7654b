"""Most frequent value per key, ties to the smallest value, NULLs ignored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mode_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """``keys`` and the mode of ``value``; NULL where a key has no value at all.

    Counting per value first lets the map side shrink a hot key to its distinct
    values before anything moves.
    """
    counted = df.groupBy(*keys, value).agg(F.count(value).alias("_n"))
    return counted.groupBy(*keys).agg(
        F.min(F.struct((-F.col("_n")).alias("_rank"), F.col(value).alias("_v")))["_v"].alias(name)
    )


def modes_by(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The mode of each column on its own, all columns in one pass."""
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in values]
        )
    ).alias("p")
    counted = (
        df.select(*keys, pairs)
        .groupBy(*keys, F.col("p.c").alias("_c"), F.col("p.v").alias("_v"))
        .agg(F.count("p.v").alias("_n"))
    )
    best = [
        F.min(F.when(F.col("_c") == c, F.struct((-F.col("_n")).alias("r"), F.col("_v"))))["_v"].alias(c)
        for c in values
    ]
    return counted.groupBy(*keys).agg(*best)
