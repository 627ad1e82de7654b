"""Churn models on the feature table: preparation, logistic regression, boosted trees.

Preparation is learned from training rows only and ends up as plain SQL inside
the saved pipeline: median or mode for missing values, standard scaling, one
column per known category (an unknown one is all zeros). A category with more than
``WIDE`` values stays one term: its values get numbers in a written table, rows meet the
table by a join whose strategy Spark picks by size, and the inputs are one sparse vector,
so neither the driver nor the plan grows with the number of values.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.operators.columns import apart
from holdfast.operators.metrics import evaluate, roc_auc
from holdfast.operators.modes import mode_by
from holdfast.operators.ordered import medians, prefix, sql_literal
from holdfast.plans import boosting
from holdfast.session import fresh_path
from holdfast.sources.tables import write_json

SCORE, LABEL = "predicted_churn_probability", "churned"
#: values up to which a category gets an input column each
WIDE = 200


@dataclass(frozen=True)
class Term:
    """One model input: the column it comes from and the SQL that prepares it.

    A wide category stands for ``size`` inputs: ``value`` is then the filled column and
    ``table`` the written table of its values and their numbers, ``code`` from 0.
    """

    name: str
    column: str
    kind: str  # number, flag, category or wide
    value: str
    coefficient: float = 0.0
    table: str = ""
    size: int = 1


def prepare(
    train: DataFrame,
    numeric: Sequence[str] = tuple(fixed.NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(fixed.CATEGORICAL_FEATURES),
    flags: Sequence[str] = tuple(fixed.INDICATORS),
    wide: int = WIDE,
) -> list[Term]:
    """Learn the preparation of every input from ``train``."""
    middle = {r["feature"]: r["median"] for r in medians(train, numeric).collect()}
    filled = {c: f"coalesce(CAST(`{c}` AS DOUBLE), {middle.get(c, 0.0)!r}D)" for c in numeric}
    pairs = ((f"avg({e}) AS `{c}_mean`", f"stddev_pop({e}) AS `{c}_std`") for c, e in filled.items())
    moments = sums_of(train, [F.expr(e) for pair in pairs for e in pair])
    terms = []
    for c, e in filled.items():
        mean, std = moments[f"{c}_mean"] or 0.0, moments[f"{c}_std"]
        terms.append(Term(c, c, "number", f"({e} - {mean!r}D) / {(std or 1.0)!r}D"))
    for c in categorical:
        values = train.where(F.col(c).isNotNull()).select(F.col(c).cast("string").alias("value")).distinct()
        known = [r[0] for r in values.limit(wide + 1).collect()]
        usual = mode_by(train.select(c), [], c, c).first()[0]
        fill = f"`{c}`" if usual is None else f"coalesce(`{c}`, {sql_literal(usual)})"
        if len(known) > wide:
            terms.append(encode(values, c, fill))
            continue
        for v in sorted(known):
            text = f"CAST(coalesce({fill} = {sql_literal(v)}, false) AS DOUBLE)"
            terms.append(Term(f"{c}_{v}", c, "category", text))
    terms += [Term(c, c, "flag", f"CAST(`{c}` AS DOUBLE)") for c in flags]
    return terms


#: aggregates of one pass: with many more, the method generated for them is too long for the JVM to compile
TOGETHER = 16


def sums_of(df: DataFrame, aggregates: Sequence[Column]) -> dict:
    """Aggregates over all rows of a stored table by name, each pass reading the columns of a few."""
    out: dict = {}
    for i in range(0, len(aggregates), TOGETHER):
        out |= df.agg(*aggregates[i : i + TOGETHER]).first().asDict()
    return out


def encode(values: DataFrame, column: str, fill: str) -> Term:
    """A wide category: its distinct ``value`` rows numbered in their order and written."""
    table = fresh_path(values.sparkSession, "encoding")
    numbered = prefix(values, "value").select("value", F.col("before_n").cast("int").alias("code"))
    numbered.write.parquet(table)
    size = values.sparkSession.read.parquet(table).count()
    return Term(column, column, "wide", f"CAST({fill} AS STRING)", table=table, size=size)


def numbered(term: Term, name: str) -> SQLTransformer:
    """Adds ``name``, the number of the row's value of a wide category; unknown ones get ``size``."""
    return SQLTransformer(
        statement=f"SELECT t.*, coalesce(e.code, {term.size}) AS {name} "
        f"FROM __THIS__ t LEFT JOIN parquet.`{term.table}` e ON e.value = t.{name}_value"
    )


def input_stages(terms: Sequence[Term]) -> list:
    """Pipeline stages that turn feature rows into ``features`` vectors.

    Wide categories follow behind all other inputs, as sparse parts of the vector.
    """
    plain = [t for t in terms if t.kind != "wide"]
    wide = [t for t in terms if t.kind == "wide"]
    names = [f"_x{i}" for i in range(len(plain))]
    columns = [f"{t.value if i else apart(t.value)} AS {n}" for i, (t, n) in enumerate(zip(plain, names))]
    columns += [f"{t.value} AS _w{i}_value" for i, t in enumerate(wide)]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")]
    for i, t in enumerate(wide):
        # the encoder learns its width alone, from the greatest number; one beyond it is all zeros
        top = SparkSession.active().createDataFrame([(float(t.size - 1),)], f"_w{i} DOUBLE")
        hot = OneHotEncoder(inputCol=f"_w{i}", outputCol=f"_h{i}", handleInvalid="keep").fit(top)
        stages += [numbered(t, f"_w{i}"), hot]
    return [*stages, VectorAssembler(inputCols=[*names, *[f"_h{i}" for i in range(len(wide))]], outputCol="features")]


def balanced_weight(train: DataFrame, label: str = LABEL) -> Column:
    """``n / (2 * n_class)`` for each row's class, counted in ``train``."""
    counts = {r[0]: r[1] for r in train.groupBy(label).count().collect()}
    total = sum(counts.values())
    weight = F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, F.lit(total / (len(counts) * n))).otherwise(weight)
    return weight


def logistic_model(n_rows: int, max_iter: int = 2000) -> LogisticRegression:
    """Balanced, ridge-penalised logistic regression with unit penalty strength.

    The penalty is divided by the total weight because the loss is a weighted
    mean; balanced weights add up to the number of rows.
    """
    return LogisticRegression(
        featuresCol="features",
        labelCol=LABEL,
        weightCol="weight",
        maxIter=max_iter,
        tol=1e-8,
        regParam=1.0 / n_rows,
        elasticNetParam=0.0,
        standardization=False,
    )


def tree_settings(**changes) -> boosting.Settings:
    s = fixed.TREE_SETTINGS
    given = boosting.Settings(
        s["rounds"], s["patience"], s["max_depth"], s["step_size"], s["subsample"], s["features"], s["l1"], s["l2"],
        s["min_child_weight"],
    )
    return replace(given, **changes)


def fit_logistic(
    train: DataFrame, terms: Sequence[Term] | None = None, max_iter: int = 2000
) -> tuple[PipelineModel, list[Term]]:
    """Fitted pipeline and its terms with coefficients.

    Reads ``train`` several times: pass a stored feature table, not a plan.
    """
    terms = list(terms or prepare(train))
    rows = train.withColumn("weight", balanced_weight(train))
    stages = [*input_stages(terms), logistic_model(train.count(), max_iter)]
    model = Pipeline(stages=stages).fit(rows)
    weights = iter(model.stages[-1].coefficients.toArray().tolist())
    # those of a wide category stay in the model, see wide_coefficients
    named = [t if t.kind == "wide" else replace(t, coefficient=next(weights)) for t in terms]
    return model, named


def wide_coefficients(model: PipelineModel, terms: Sequence[Term]) -> DataFrame:
    """``column, value, coefficient`` of the values of wide categories in a logistic model."""
    spark = SparkSession.active()
    weights = model.stages[-1].coefficients.toArray()
    at = sum(t.kind != "wide" for t in terms)
    parts = []
    for t in terms:
        if t.kind == "wide":
            own = spark.createDataFrame(list(enumerate(weights[at : at + t.size].tolist())), "code INT, coefficient DOUBLE")
            known = spark.read.parquet(t.table).join(own, "code")
            parts.append(known.select(F.lit(t.column).alias("column"), "value", "coefficient"))
            at += t.size
    return reduce(DataFrame.unionByName, parts)


def fit_trees(
    train: DataFrame,
    validation: DataFrame,
    terms: Sequence[Term] | None = None,
    settings: boosting.Settings | None = None,
) -> tuple[PipelineModel, list[boosting.Tree]]:
    """Boosted trees on the same inputs, up to the round of the best average precision on
    ``validation``, and the pipeline that scores with them.

    Boosting ends once ``patience`` rounds in a row bring no gain, at ``rounds`` at the latest.
    """
    terms = list(terms or prepare(train))
    settings = settings or tree_settings()
    numbers = {t.name: t.value for t in terms if t.kind in ("number", "flag")}
    listed: dict[str, list[Term]] = {}
    for t in terms:
        if t.kind == "category":
            listed.setdefault(t.column, []).append(t)
    wide = {t.column: t for t in terms if t.kind == "wide"}
    edges = boosting.edges_of(train, numbers)
    inputs = [boosting.Input(n, edges[n]) for n in numbers]
    inputs += [boosting.Input(c, values=len(ts)) for c, ts in listed.items()]
    inputs += [boosting.Input(c, values=t.size) for c, t in wide.items()]
    codes = {c: _code(ts) for c, ts in listed.items()} | {c: F.col(f"_w{i}") for i, c in enumerate(wide)}
    training = train.withColumn("_weight", balanced_weight(train)).withColumn("_training", F.lit(True))
    unseen = validation.withColumn("_weight", F.lit(1.0)).withColumn("_training", F.lit(False))
    rows = training.unionByName(unseen)
    rows = rows.withColumn("_key", F.xxhash64(*[F.col(c) for c in sorted(train.columns)]))
    for i, t in enumerate(wide.values()):
        rows = numbered(t, f"_w{i}").transform(rows.withColumn(f"_w{i}_value", F.expr(t.value)))
    table = boosting.binned(
        rows, inputs, numbers, codes, F.col("_key"), LABEL, F.col("_weight"), F.col("_training")
    )
    trees, _ = boosting.boost(table, inputs, settings)
    return _tree_pipeline(trees, inputs, numbers, listed, wide), trees


def _code(terms: Sequence[Term]) -> Column:
    """Place of the category's term that holds, behind the last one if none does."""
    cases = " ".join(f"WHEN {t.value} = 1 THEN {i}" for i, t in enumerate(terms))
    return F.expr(f"CASE {cases} ELSE {len(terms)} END")


def _tree_pipeline(trees, inputs, numbers, listed, wide) -> PipelineModel:
    """The trees as SQL: inputs that are split at become columns, conditions name values."""
    at = boosting.used(trees)
    used = [n for n in numbers if any(inputs[i].name == n for i, _ in at)]
    columns = {n: f"_x{i}" for i, n in enumerate(used)}
    test = {}
    for i, b in at:
        name = inputs[i].name
        if name in listed:
            test[name, b] = f"({listed[name][b].value}) = 1"
        elif name in wide:
            t = wide[name]
            found = SparkSession.active().read.parquet(t.table).where(F.col("code") == b).first()["value"]
            test[name, b] = f"coalesce({t.value} = {sql_literal(found)}, false)"
    chosen = "".join(f", {numbers[n]} AS {c}" for n, c in columns.items())
    stages = [
        SQLTransformer(statement=f"SELECT *{chosen} FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, {boosting.as_sql(trees, inputs, columns, test)} AS {SCORE} FROM __THIS__"),
    ]
    return PipelineModel(stages=stages)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` plus the churn probability."""
    scored = model.transform(rows)
    if SCORE not in scored.columns:
        scored = scored.withColumn(SCORE, vector_to_array("probability")[1])
    return scored.select(*rows.columns, SCORE)


def linear_score(rows: DataFrame, terms: Sequence[Term], intercept: float) -> DataFrame:
    """The same probability from terms alone, as column arithmetic."""
    total = " + ".join([f"{intercept!r}D"] + [f"{t.coefficient!r}D * ({t.value})" for t in terms])
    return rows.withColumn(SCORE, F.lit(1.0) / (F.lit(1.0) + F.exp(-F.expr(total))))


def save(model: PipelineModel, path: str, terms: Sequence[Term] = ()) -> None:
    model.write().overwrite().save(f"{path}/model")
    if terms:
        spark = SparkSession.active()
        rows = spark.createDataFrame([(i, json.dumps(asdict(t))) for i, t in enumerate(terms)], "i INT, term STRING")
        write_json(rows, f"{path}/terms")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def load_terms(spark: SparkSession, path: str) -> list[Term]:
    rows = spark.read.schema("i INT, term STRING").json(f"{path}/terms").orderBy("i").collect()
    return [Term(**json.loads(r["term"])) for r in rows]


def cold_start(scored: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """ROC-AUC of customers with one lifetime order against those with more."""
    depth = F.when(F.col("lifetime_orders") == 1, "lifetime_orders = 1").otherwise(
        "lifetime_orders >= 2"
    )
    return roc_auc(scored.withColumn("history", depth), LABEL, SCORE, [*by, "history"])


def compare(models: dict[str, DataFrame], gap_from: str = "train") -> DataFrame:
    """Metrics of each scored table per split, with the ROC-AUC lost against training."""
    parts = [evaluate(df, LABEL, SCORE).withColumn("model", F.lit(name)) for name, df in models.items()]
    rows = reduce(DataFrame.unionByName, parts)
    base = rows.where(F.col("split") == gap_from).select("model", F.col("roc_auc").alias("_base"))
    return rows.join(base, "model", "left").select(
        "model",
        *[c for c in rows.columns if c != "model"],
        (F.col("_base") - F.col("roc_auc")).alias("gap_to_train"),
    )
