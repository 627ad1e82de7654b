"""Table profiles: shapes, null rates, duplicates, distributions, drift."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.amounts import percent, ratio
from holdfast.operators.ordered import quantiles
from holdfast.session import settle


def unpivot_row(df: DataFrame, keys: Sequence[str], cells: dict[str, dict[str, Column]], name: str) -> DataFrame:
    """Turn a short wide result into one row per entry of ``cells``."""
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(label).alias(name), *[c.alias(k) for k, c in parts.items()])
                for label, parts in cells.items()
            ]
        )
    ).alias("_r")
    return df.select(*keys, rows).select(*keys, "_r.*")


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    parts = [
        df.groupBy()
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_rates(df: DataFrame, by: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """Percent of NULLs per column, in one pass, only columns that have any."""
    columns = [c for c in df.columns if c not in by]
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    cells = {c: {"null_pct": percent(F.col(c), F.col("_rows"), digits)} for c in columns}
    rates = unpivot_row(wide, by, cells, "column_name").where(F.col("null_pct") > 0)
    return rates.orderBy(*by, F.col("null_pct").desc(), "column_name")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def duplicate_report(df: DataFrame, keys: Sequence[str], owner: str) -> DataFrame:
    """One row: rows that share a key with another row, and the owners affected."""
    repeated = duplicate_keys(df, keys)
    owners = repeated.groupBy(owner).agg(F.sum("n_rows").alias("n_rows"))
    return owners.groupBy().agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("duplicate_rows"),
        F.count(owner).alias("affected"),
    )


def duplicate_sample(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the smallest repeated key."""
    first = duplicate_keys(df, keys).orderBy(*keys).limit(1).select(*keys)
    return df.join(first, list(keys), "left_semi")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: number of child rows whose key (NULL included) has no parent.

    The child is counted per key first, so a hot key crosses the join as one row.
    """
    counted = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.join(parent.select(key), key, "left_anti")
        .groupBy()
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))
    )


def describe(df: DataFrame, value: str, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quantiles: statistic and value rows."""
    df = settle(df.select(value))
    wide = df.groupBy().agg(
        F.count(value).cast("double").alias("count"),
        F.avg(F.col(value).cast("double")).alias("mean"),
        F.stddev_samp(F.col(value).cast("double")).alias("std"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
    )
    names = ["count", "mean", "std", "min", "max"]
    basic = unpivot_row(wide, [], {n: {"value": F.col(n)} for n in names}, "statistic")
    cuts = quantiles(df, value, probabilities).select(
        F.concat(F.lit("p"), F.round(F.col("probability") * 100).cast("int")).alias("statistic"),
        F.col("quantile").alias("value"),
    )
    return basic.unionByName(cuts)


def counted_days(days: DataFrame, value: str) -> DataFrame:
    """Rows per whole-day value: as many rows as the calendar has days, at most."""
    return days.groupBy(value).agg(F.count(F.lit(1)).alias("n"))


def day_quantiles(value: str, probabilities: Sequence[float]) -> Column:
    """Exact quantiles over ``counted_days``, as one array aggregate."""
    return F.percentile(value, F.array(*[F.lit(float(p)) for p in probabilities]), F.col("n"))


def drift(left: DataFrame, right: DataFrame, columns: Sequence[str], jump: float = 5.0) -> DataFrame:
    """Null rate, minimum and maximum of each column on both sides; flags jumps in points."""

    def side(df: DataFrame, prefix: str) -> DataFrame:
        wide = df.groupBy().agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
            *[F.min(F.col(c).cast("double")).alias(f"{c}_min") for c in columns],
            *[F.max(F.col(c).cast("double")).alias(f"{c}_max") for c in columns],
        )
        cells = {
            c: {
                f"{prefix}_null_pct": percent(F.col(f"{c}_nulls"), F.col("_rows")),
                f"{prefix}_min": F.col(f"{c}_min"),
                f"{prefix}_max": F.col(f"{c}_max"),
            }
            for c in columns
        }
        return unpivot_row(wide, [], cells, "feature")

    report = side(left, "scoring").join(side(right, "training"), "feature")
    shift = F.round(F.abs(F.col("scoring_null_pct") - F.col("training_null_pct")), 2)
    return report.withColumn("null_pct_jump", shift).withColumn(
        "flagged", F.coalesce(F.col("null_pct_jump") > jump, F.lit(False))
    )


def equal_columns(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Whether two columns agree in every row, and their correlation, for each pair."""
    named = {f"{a} = {b}": (a, b) for a, b in pairs.items()}
    aggregates = []
    for i, (a, b) in enumerate(named.values()):
        aggregates.append(F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"_d{i}"))
        aggregates.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}"))
    wide = df.groupBy().agg(*aggregates)
    cells = {
        label: {
            "column_a": F.lit(a),
            "column_b": F.lit(b),
            "rows_differing": F.col(f"_d{i}"),
            "identical": F.col(f"_d{i}") == 0,
            "correlation": F.col(f"_c{i}"),
        }
        for i, (label, (a, b)) in enumerate(named.items())
    }
    return unpivot_row(wide, [], cells, "pair").drop("pair")


def value_shares(df: DataFrame, value: str, digits: int = 3) -> DataFrame:
    """Share of each value among the non-null ones, sorted by value."""
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    share = ratio(F.col("n"), grand_total("n"))
    return counted.select(value, "n", F.round(share, digits).alias("share")).orderBy(value)


def grand_total(column: str) -> Column:
    """Total over a result of few rows, one per status, state, type or the like."""
    return F.sum(column).over(Window.partitionBy(F.lit(0)))
