"""What drives a linear churn score, overall and per customer.

Attribution of an input is its coefficient times its distance from the
background mean, in log-odds. A row carries all of its attributions in one short
array, so the strongest factors of every customer need no exchange at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.functions.wording import measured, plain_label, yes_no
from holdfast.operators.ordered import medians, seeded_sample
from holdfast.operators.profile import unpivot_row
from holdfast.plans.model import LABEL, TOGETHER, Term, sums_of


def background_means(background: DataFrame, terms: Sequence[Term]) -> list[float]:
    found = sums_of(background, [F.expr(f"avg(CAST({t.value} AS DOUBLE)) AS m{i}") for i, t in enumerate(terms)])
    return [found[f"m{i}"] for i in range(len(terms))]


def background_sample(train: DataFrame, key: str, n: int = 500, seed: int = 42) -> DataFrame:
    return seeded_sample(train, key, n, seed)


def attribution(term: Term, mean: float) -> Column:
    return F.expr(f"{term.coefficient!r}D * (({term.value}) - {mean!r}D)")


def attributions(
    rows: DataFrame, terms: Sequence[Term], means: Sequence[float], keys: Sequence[str]
) -> DataFrame:
    """Long form: one row per key and input."""
    pairs = F.array(
        *[
            F.struct(F.lit(t.name).alias("feature"), attribution(t, m).alias("attribution"))
            for t, m in zip(terms, means)
        ]
    )
    # made in a projection with a lambda, which Spark leaves out of whole-stage code (see ``columns.apart``)
    made = rows.select(*keys, F.transform(pairs, lambda p: p).alias("_pairs"))
    return made.select(*keys, F.explode("_pairs").alias("_p")).select(*keys, "_p.*")


def global_importance(
    rows: DataFrame, terms: Sequence[Term], means: Sequence[float], top: int = 15
) -> DataFrame:
    """Mean absolute attribution of each input, the ``top`` strongest first, with its label."""
    pairs = [*zip(terms, means)]

    def some(pairs: Sequence[tuple[Term, float]]) -> DataFrame:
        wide = rows.groupBy().agg(*[F.avg(F.abs(attribution(t, m))).alias(f"a{i}") for i, (t, m) in enumerate(pairs)])
        cells = {
            t.name: {"plain_label": F.lit(plain_label(t.name)), "mean_abs_attribution": F.col(f"a{i}")}
            for i, (t, _) in enumerate(pairs)
        }
        return unpivot_row(wide, [], cells, "feature")

    # a few in one pass, as in ``sums_of``
    parts = [some(pairs[i : i + TOGETHER]) for i in range(0, len(pairs), TOGETHER)]
    return (
        reduce(DataFrame.unionByName, parts)
        .orderBy(F.col("mean_abs_attribution").desc(), "feature")
        .limit(top)
    )


def reference_medians(
    train: DataFrame, columns: Sequence[str] = tuple(fixed.NUMERIC_FEATURES)
) -> DataFrame:
    """Median of each feature over training customers who came back."""
    return medians(train.where(F.col(LABEL) == 0), columns)


def describe(term: Term, typical: Mapping[str, float]) -> Column:
    """The customer's own value of an input in words."""
    label = F.lit(plain_label(term.name))
    if term.kind == "category":
        return yes_no(label, F.col(term.column) == F.lit(term.name[len(term.column) + 1 :]))
    if term.kind == "flag" or term.name.startswith("has_"):
        return yes_no(label, F.col(term.column) != 0)
    usual = typical.get(term.column)
    return measured(label, F.col(term.column).cast("double"), None if usual is None else F.lit(usual))


def explanations(
    rows: DataFrame,
    terms: Sequence[Term],
    means: Sequence[float],
    typical: Mapping[str, float],
    keys: Sequence[str],
    top: int = 5,
    suppressed: Sequence[str] = tuple(fixed.SUPPRESSED_FACTORS),
) -> DataFrame:
    """The ``top`` factors of each row as text, strongest first.

    Suppressed inputs are left out before ranking, so the list is still ``top`` long.
    """
    factors = []
    for i, (term, mean) in enumerate(zip(terms, means)):
        if term.name in suppressed:
            continue
        weight = attribution(term, mean)
        direction = F.when(weight > 0, "increases").otherwise("decreases")
        line = F.concat(
            F.lit("  - "), describe(term, typical), F.lit("  ["), direction, F.lit(" churn risk]")
        )
        factors.append(
            F.struct((-F.abs(weight)).alias("rank"), F.lit(i).alias("position"), line.alias("line"))
        )
    best = F.slice(F.array_sort(F.array(*factors)), 1, top)
    lines = F.array_join(F.transform(best, lambda f: f["line"]), "\n")
    return rows.select(*keys, lines.alias("top_factors"))
