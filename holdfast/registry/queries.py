"""Named queries over the stand-in tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import fixed
from holdfast.functions.amounts import from_cents
from holdfast.functions.dates import moment, parse_or_null
from holdfast.operators import columns, metrics, neighbours, ordered, profile, sketches
from holdfast.plans import (
    audit,
    behavior,
    explain,
    explore,
    features,
    model,
    quality,
    quarantine,
    scenario,
    staging,
    store,
    value,
)
from holdfast.registry.oracle import (
    AUDITED,
    CITIES,
    DRIFT,
    DRIFT_DAYS,
    GROUPS,
    INTERCEPT,
    MEDIANS,
    NEAR,
    NULL_COLUMNS,
    TERMS,
)
from holdfast.session import fresh_path, fresh_table, settle
from holdfast.sources import standin, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
FUTURE = datetime(2001, 1, 1)
KEYS = ["customer_unique_id", "snapshot_date"]
LABEL, SCORE = "churned", "predicted_churn_probability"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, folder: tidy(function(spark, folder))
    return function


#: a product of two exact inputs: the same double everywhere, best left unrounded
EXACT = {"revenue_at_risk"}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as BIGINT and doubles rounded, so that results compare across engines."""
    out = []
    for field in df.schema:
        kind, name = field.dataType, f"`{field.name}`"
        whole = isinstance(kind, T.DecimalType) and kind.scale == 0
        if whole or isinstance(kind, (T.IntegerType, T.ShortType)):
            name = f"CAST({name} AS BIGINT) AS {name}"
        elif field.name not in EXACT and isinstance(kind, (T.DoubleType, T.DecimalType)):
            # adding zero turns -0.0 into 0.0
            name = f"round(CAST({name} AS DOUBLE), {digits}) + 0D AS {name}"
        out.append(name)
    return df.selectExpr(*out)


def _raw(spark, folder):
    return standin.tables(spark, folder)


def _base(spark, folder) -> features.Base:
    return features.Base(_raw(spark, folder))


def _resolved(spark, folder):
    return _base(spark, folder).resolved


def _panel(spark, folder, *parts: str, splits=standin.SPLITS):
    return features.feature_table(
        _raw(spark, folder), standin.SNAPSHOTS, splits, parts, last_valid=standin.MAX_VALID_DATE
    )


# staging


@query
def stage_orders(spark, folder):
    staged = staging.stage_orders(_raw(spark, folder)["orders"])
    return staged.select(
        "order_id", "order_status", "delivery_status", "delivery_days", "late_delivery_outlier"
    )


@query
def stage_products(spark, folder):
    raw = _raw(spark, folder)
    return staging.stage_products(raw["products"], raw["translation"], raw["overrides"])


@query
def staged_items(spark, folder):
    items = staging.pass_through(_raw(spark, folder)["items"])
    return items.select("order_id", "product_id", "seller_id", "price", "freight_value")


@query
def resolved_orders(spark, folder):
    raw = _raw(spark, folder)
    staged = staging.stage_orders(raw["orders"])
    return staging.resolved_orders(staged, raw["customers"]).select(
        "order_id", "customer_unique_id", "order_purchase_timestamp"
    )


@query
def purchase_events(spark, folder):
    return staging.purchase_events(_resolved(spark, folder))


@query
def order_summary(spark, folder):
    return _base(spark, folder).order_summary().select(
        "order_id",
        "customer_unique_id",
        from_cents(F.col("order_total_cents")).alias("order_total"),
        from_cents(F.col("payment_cents")).alias("payment_value"),
        "installments_mean",
        "payment_type_mode",
        "review_score",
        "delivery_delay_days",
    )


@query
def item_summary(spark, folder):
    return _base(spark, folder).item_summary().drop("order_purchase_timestamp")


@query
def geo_mode(spark, folder):
    return _base(spark, folder).geography()


# quality and profiles


def _checks(spark, folder):
    return quality.run_checks(_raw(spark, folder), as_of=FUTURE)


@query
def dq_checks(spark, folder):
    return _checks(spark, folder).drop("description")


@query
def dq_gate_failures(spark, folder):
    return quality.gate_failures(_checks(spark, folder)).select("name", "violation_count")


@query
def quarantine_orders(spark, folder):
    """Every order with the checks it violates, and whether it may go on to staging."""
    passing, held = quarantine.quarantine(_raw(spark, folder), "orders", FUTURE)
    nothing = passing.withColumn(quarantine.REASONS, F.array().cast("array<string>")).withColumn("passes", F.lit(True))
    both = nothing.unionByName(held.withColumn("passes", F.lit(False)))
    return both.select("order_id", F.size(quarantine.REASONS).alias("n_reasons"), "passes")


@query
def quarantine_counts(spark, folder):
    """Violating rows per check and table, items judged against a parent table with holes."""
    raw = _raw(spark, folder)
    holes = dict(raw) | {"orders": raw["orders"].where(F.col("order_status") == "F")}
    parts = [
        quarantine.counts(quarantine.judge(given, name, FUTURE)).withColumn("table_name", F.lit(name))
        for given, name in ((raw, "orders"), (holes, "items"), (holes, "payments"), (raw, "reviews"), (raw, "products"))
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def null_profile(spark, folder):
    staged = staging.stage_orders(_raw(spark, folder)["orders"])
    return profile.null_rates(
        staged.select(
            F.col("order_delivered_customer_date").alias("delivered_customer_date"),
            "delivery_days",
            "delivery_status",
        )
    )


@query
def feature_nulls(spark, folder):
    panel = _panel(spark, folder, *features.PARTS)
    return profile.null_rates(panel.select("split", *NULL_COLUMNS), ["split"])


@query
def table_shapes(spark, folder):
    names = ["customer", "orders", "lineitem", "part", "supplier", "nation", "region", "events"]
    return profile.table_shapes({n: standin.read(spark, folder, n) for n in names})


@query
def orphan_items(spark, folder):
    finished = standin.read(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    lines = standin.read(spark, folder, "lineitem")
    return profile.orphans(
        lines.select(F.col("l_orderkey").alias("order_id")),
        finished.select(F.col("o_orderkey").alias("order_id")),
        "order_id",
    )


@query
def duplicate_keys(spark, folder):
    lines = standin.read(spark, folder, "lineitem")
    return profile.duplicate_report(lines, ["l_orderkey", "l_linenumber"], "l_orderkey")


@query
def duplicate_sample(spark, folder):
    lines = standin.read(spark, folder, "lineitem")
    rows = profile.duplicate_sample(lines, ["l_orderkey", "l_linenumber"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query
def duplicated_features(spark, folder):
    pairs = {**fixed.DUPLICATED_FEATURES, **fixed.COLLINEAR_FEATURES}
    return profile.equal_columns(_panel(spark, folder), pairs)


@query
def collinear_single_order(spark, folder):
    single = _panel(spark, folder).where(F.col("lifetime_orders") == 1)
    return profile.equal_columns(single, fixed.COLLINEAR_FEATURES)


@query
def equal_features(spark, folder):
    """All pairs of numeric features that agree in every row, over all rows and over single-order customers."""
    panel = settle(_panel(spark, folder, *features.PARTS).select(*KEYS, *AUDITED))
    sides = {"all": panel, "single_order": panel.where(F.col("lifetime_orders") == 1)}
    parts = [columns.equal_pairs(df, AUDITED, KEYS).withColumn("rows", F.lit(n)) for n, df in sides.items()]
    return parts[0].unionByName(parts[1])


@query
def collinear_features(spark, folder):
    """Correlation of every pair of the model's numeric inputs that have one."""
    panel = _panel(spark, folder, *features.PARTS).select(*fixed.NUMERIC_FEATURES)
    found = columns.correlations(settle(panel), fixed.NUMERIC_FEATURES)
    return found.where(F.abs("correlation") >= 0.5).withColumn("correlation", F.round("correlation", 4))


@query
def sketched_order_values(spark, folder):
    """Quantiles of order values by month and over all months, from one stored sketch per month:
    how many values each holds, and whether the exact rank of the quantile lies within the bound."""
    orders = settle(_base(spark, folder).order_summary().select(
        F.date_trunc("month", "order_purchase_timestamp").cast("timestamp_ntz").alias("month"),
        F.col("order_total_cents").cast("double").alias("value"),
    ))
    stored = settle(sketches.sketches(orders, "value", ["month"]))
    wanted = sketches.sketch_quantiles(stored, [0.05, 0.25, 0.5, 0.75, 0.95])
    below = orders.join(F.broadcast(wanted), F.lit(True)).groupBy("probability", "n").agg(
        (F.count_if(F.col("value") < F.col("quantile")) / F.max("n")).alias("low"),
        (F.count_if(F.col("value") <= F.col("quantile")) / F.max("n")).alias("high"),
    )
    p, e = F.col("probability"), sketches.RANK_ERROR
    return below.select("probability", "n", ((F.col("low") <= p + e) & (F.col("high") >= p - e)).alias("within"))


@query
def single_order_invariant(spark, folder):
    return features.single_order_invariant(_panel(spark, folder))


# audit


@query
def date_audit(spark, folder):
    return audit.date_audit(_raw(spark, folder)["orders"], FUTURE)


@query
def date_parse(spark, folder):
    orders = standin.read(spark, folder, "orders")
    words = parse_or_null(F.col("o_orderpriority"))
    dates = parse_or_null(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return orders.groupBy().agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(words).alias("parsed_words"),
        F.count(dates).alias("parsed_dates"),
    )


CUTS = [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


@query
def delivery_distribution(spark, folder):
    days = audit.delivery_days(_raw(spark, folder)["orders"])
    return audit.day_distribution(days, "days", CUTS)


@query
def iqr_outliers(spark, folder):
    return audit.iqr_outliers(staging.stage_orders(_raw(spark, folder)["orders"]), "delivery_days")


@query
def money_audit(spark, folder):
    raw = _raw(spark, folder)
    return audit.money_audit(raw["items"], raw["payments"])


@query
def identity_audit(spark, folder):
    return audit.identity_audit(_raw(spark, folder)["customers"])


@query
def gap_distribution(spark, folder):
    return audit.day_distribution(audit.order_gaps(_resolved(spark, folder)), "gap_days", CUTS)


@query
def event_gap_distribution(spark, folder):
    events = staging.purchase_events(_resolved(spark, folder))
    return audit.day_distribution(audit.event_gaps(events), "gap_days", CUTS)


@query
def gap_coverage(spark, folder):
    events = staging.purchase_events(_resolved(spark, folder))
    return audit.window_coverage(audit.event_gaps(events))


def _log(spark, folder):
    return audit.event_gaps(standin.user_events(spark, folder).distinct())


@query
def event_log_coverage(spark, folder):
    return audit.window_coverage(_log(spark, folder))


@query
def event_log_gaps(spark, folder):
    return audit.day_distribution(_log(spark, folder), "gap_days", CUTS)


@query
def purchase_event_counts(spark, folder):
    return audit.purchase_event_counts(staging.purchase_events(_resolved(spark, folder)))


@query
def repeat_customer_orders(spark, folder):
    rows = audit.repeat_customer_rows(_resolved(spark, folder))
    return rows.select("order_id", "customer_unique_id")


@query
def same_day_pairs(spark, folder):
    return audit.same_day_pairs(_resolved(spark, folder))


@query
def same_day_summary(spark, folder):
    return audit.same_day_summary(audit.same_day_pairs(_resolved(spark, folder)))


@query
def near_identical_orders(spark, folder):
    """Order dates of the tables are whole days, so a day is the least step."""
    orders = _base(spark, folder).order_summary()
    return audit.near_identical_orders(orders, NEAR["seconds"], NEAR["cents"])


@query
def events_as_of(spark, folder):
    """Each log entry with its user's latest view before it and earliest order placed after it."""
    log = standin.read(spark, folder, "events").select("event_id", "user_id", "ts")
    bought = standin.read(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("at")
    )
    before = neighbours.as_of(log, bought, "user_id", "ts", "at", ["order_id"], "before")
    both = neighbours.as_of(before, bought, "user_id", "ts", "at", ["order_id"], "after", "forward", equal=False)
    return both.select("event_id", "user_id", *[F.col(f"{m}.{c}").alias(f"{m}_{c}") for m in ("before", "after") for c in ("order_id", "at")])


@query
def tickets_as_of(spark, folder):
    """Each ticket with the latest order of its customer up to then."""
    base = _base(spark, folder)
    tickets = base.raw["tickets"].select("customer_unique_id", "created_at", "resolution_hours")
    orders = base.resolved.select("customer_unique_id", "order_id", "order_purchase_timestamp")
    found = neighbours.as_of(tickets, orders, "customer_unique_id", "created_at", "order_purchase_timestamp", ["order_id"])
    return found.select("customer_unique_id", "created_at", "resolution_hours", F.col("match.order_id").alias("order_id"))


@query
def bucketed_person_join(spark, folder):
    """Orders and tickets of each person from staged tables in buckets of the person: neither side is shuffled again."""
    base = _base(spark, folder)
    sides = {
        "orders": base.resolved.select("customer_unique_id", "order_id", "order_purchase_timestamp"),
        "tickets": base.raw["tickets"].select("customer_unique_id", "created_at"),
    }
    stored = {
        n: tables.save_bucketed(df, fresh_table(spark, n), fresh_path(spark, n), "customer_unique_id", 16)
        for n, df in sides.items()
    }
    bought = stored["orders"].groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("order_purchase_timestamp").alias("last_order")
    )
    asked = stored["tickets"].groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("n_tickets"))
    return bought.join(asked, "customer_unique_id", "left").na.fill(0, ["n_tickets"])


@query
def cart_split_sellers(spark, folder):
    base = _base(spark, folder)
    return audit.seller_disjointness(audit.same_day_pairs(base.resolved), base.raw["items"])


@query
def untranslated_categories(spark, folder):
    raw = _raw(spark, folder)
    return audit.untranslated_categories(raw["products"], raw["translation"])


@query
def review_distribution(spark, folder):
    return profile.value_shares(_raw(spark, folder)["reviews"], "review_score")


# exploration


def _revenue(spark, folder):
    base = _base(spark, folder)
    return explore.customer_revenue(base.resolved, base.raw["items"])


@query
def repeat_vs_onetime(spark, folder):
    return explore.repeat_vs_onetime(_revenue(spark, folder))


@query
def pareto_customers(spark, folder):
    return explore.pareto(_revenue(spark, folder), [1, 5, 10, 20, 50])


@query
def pareto_sellers(spark, folder):
    return explore.pareto(explore.seller_revenue(_raw(spark, folder)["items"]), [1, 5, 10, 20])


@query
def seller_revenue(spark, folder):
    return explore.seller_revenue(_raw(spark, folder)["items"])


@query
def value_quantiles(spark, folder):
    return explore.value_quantiles(_revenue(spark, folder), [0.5, 0.75, 0.9, 0.95, 0.99])


@query
def value_distribution(spark, folder):
    rows = profile.describe(_revenue(spark, folder), "revenue_cents")
    return rows.select("statistic", F.round("value", 4).alias("value"))


@query
def revenue_by_state(spark, folder):
    base = _base(spark, folder)
    return explore.revenue_by_state(base.resolved, base.raw["customers"], base.raw["items"])


@query
def revenue_by_category(spark, folder):
    raw = _raw(spark, folder)
    products = staging.stage_products(raw["products"], raw["translation"], raw["overrides"])
    return explore.revenue_by_category(raw["items"], products, top=15)


@query
def payment_behavior(spark, folder):
    return explore.payment_behavior(_raw(spark, folder)["payments"])


@query
def late_vs_review(spark, folder):
    raw = _raw(spark, folder)
    return explore.late_vs_review(staging.stage_orders(raw["orders"]), raw["reviews"])


@query
def monthly_revenue(spark, folder):
    raw = _raw(spark, folder)
    return explore.monthly_revenue(staging.stage_orders(raw["orders"]), raw["items"])


# snapshot features

PARTS = {
    "snapshot_rfm": (),
    "snapshot_delivery": (),
    "snapshot_reviews_payments": ("payments",),
    "snapshot_support": ("support",),
    "snapshot_campaigns": ("campaigns", "interventions"),
    "snapshot_items_hhi": ("items",),
    "snapshot_label": (),
    "snapshot_features_full": features.PARTS,
}


def _snapshot_query(name: str) -> Query:
    def run(spark, folder):
        panel = _panel(spark, folder, *PARTS[name])
        return panel.select(*KEYS, "split", *GROUPS[name])

    run.__name__ = name
    return run


for _name in PARTS:
    query(_snapshot_query(_name))


@query
def snapshot_strict(spark, folder):
    """Delivery, review and ticket features as they could be known on the day."""
    panel = features.feature_table(
        _raw(spark, folder),
        standin.SNAPSHOTS,
        standin.SPLITS,
        ("support",),
        last_valid=standin.MAX_VALID_DATE,
        strict_as_of=True,
    )
    reviews = ["average_review_score", "negative_review_rate", "review_trend_90d"]
    return panel.select(
        *KEYS, "split", *GROUPS["snapshot_delivery"], *reviews, *GROUPS["snapshot_support"], "lifetime_orders"
    )


@query
def incremental_features(spark, folder):
    """All features from a store that got its rows in three batches, the last one late."""
    base = _base(spark, folder)
    # each is read by several batches
    orders = settle(base.order_summary())
    items, tickets = settle(base.item_summary(orders)), settle(base.raw["tickets"])
    late = F.col("order_id") % 10 == 3
    early = F.col("order_purchase_timestamp") < moment(standin.SNAPSHOTS[1])
    kept = store.FeatureStore(spark, fresh_path(spark, "store"))
    opened = F.col("created_at") < moment(standin.SNAPSHOTS[1])
    kept.add(
        "early", orders.where(early & ~late), items.where(early & ~late), tickets.where(opened), base.raw["campaigns"]
    )
    kept.add(
        "next", orders.where(~early & ~late), items.where(~early & ~late), tickets.where(~opened),
        interventions=base.raw["interventions"],
    )
    kept.add("late", orders.where(late), items.where(late))
    panel = kept.features(standin.SNAPSHOTS, standin.SPLITS, base.geography())
    return panel.select(*KEYS, "split", *GROUPS["snapshot_features_full"])


@query
def split_assignment(spark, folder):
    return _panel(spark, folder).select(*KEYS, "split")


@query
def split_summary(spark, folder):
    return features.split_summary(_panel(spark, folder))


@query
def missing_indicators(spark, folder):
    panel = features.add_missing_indicators(_panel(spark, folder, "support", "campaigns"))
    return panel.select(*KEYS, "review_trend_90d", *fixed.INDICATORS)


@query
def feature_store_snapshot(spark, folder):
    path = fresh_path(spark, "features")
    tables.replace(_panel(spark, folder), path, ["snapshot_date"])
    stored = tables.read_snapshot(spark, path, standin.SNAPSHOTS[5])
    return stored.select("customer_unique_id", "lifetime_orders", "lifetime_revenue", "churned")


# behaviour rules


def _behavior(spark, folder):
    base = _base(spark, folder)
    raw = base.raw
    return behavior.behavior_summary(
        base.resolved, raw["items"], raw["payments"], raw["reviews"], voucher="A"
    )


def _ranked(spark, folder):
    return behavior.revenue_percentile(_behavior(spark, folder))


@query
def behavior_summary(spark, folder):
    return _behavior(spark, folder).drop("revenue_cents")


@query
def revenue_percentile(spark, folder):
    return _ranked(spark, folder).select("customer_unique_id", "revenue_percentile")


@query
def value_tiers(spark, folder):
    tiers = behavior.value_tiers(_ranked(spark, folder))
    return tiers.select("customer_unique_id", "customer_tier", "segment", "strategic_account")


@query
def support_propensity(spark, folder):
    rows = behavior.support_propensity(_behavior(spark, folder))
    return rows.select("customer_unique_id", "ticket_probability")


@query
def campaign_intensity(spark, folder):
    rows = behavior.campaign_intensity(_ranked(spark, folder))
    return rows.select("customer_unique_id", "expected_campaigns")


@query
def customer_costs(spark, folder):
    return behavior.customer_costs(_behavior(spark, folder), _raw(spark, folder)["tickets"])


@query
def lapsed_customers(spark, folder):
    return behavior.lapsed_customers(_behavior(spark, folder), standin.MAX_VALID_DATE)


@query
def event_windows(spark, folder):
    return behavior.event_window(_behavior(spark, folder), standin.MAX_VALID_DATE)


@query
def cascade_violations(spark, folder):
    return behavior.cascade_violations(_raw(spark, folder)["campaigns"])


@query
def intervention_timing(spark, folder):
    return behavior.intervention_timing(
        _raw(spark, folder)["interventions"], _behavior(spark, folder), standin.MAX_VALID_DATE
    )


@query
def campaign_unit_costs(spark, folder):
    return behavior.unit_costs(_raw(spark, folder)["campaigns"], "channel", fixed.CHANNEL_COST)


@query
def intervention_unit_costs(spark, folder):
    rows = _raw(spark, folder)["interventions"]
    return behavior.unit_costs(rows, "intervention_type", fixed.INTERVENTION_COST)


# models


def _terms() -> list[model.Term]:
    """The fixed linear model of the attribution queries."""
    out = []
    for name, (kind, text, weight) in TERMS.items():
        column = "customer_state" if kind == "category" else name
        out.append(model.Term(name, column, kind, text, weight))
    return out


def _flagged(spark, folder):
    panel = _panel(spark, folder, "interventions", "geography")
    flags = {"has_repeat_purchase": fixed.INDICATORS["has_repeat_purchase"]}
    return features.add_missing_indicators(panel, flags)


def _with_score(rows: DataFrame) -> DataFrame:
    """Recency against 30 days per purchase, a stand-in for a model's probability."""
    days = F.col("days_since_last_purchase")
    return rows.withColumn(SCORE, days / (days + F.col("lifetime_orders") * 30.0))


def _scored(spark, folder):
    panel = _with_score(_panel(spark, folder))
    return panel.select(*KEYS, "split", LABEL, SCORE, "lifetime_orders")


@query
def linear_score(spark, folder):
    return model.linear_score(_flagged(spark, folder), _terms(), INTERCEPT).select(*KEYS, SCORE)


@query
def class_weights(spark, folder):
    train = settle(_panel(spark, folder).where(F.col("split") == "train").select(LABEL))
    weighted = train.withColumn("weight", model.balanced_weight(train))
    return weighted.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("weight").alias("weight")
    )


@query
def prepared_inputs(spark, folder):
    numeric = ["purchase_gap_mean", "lifetime_orders"]
    panel = settle(_panel(spark, folder, "geography").select(*KEYS, "split", *numeric, "customer_city"))
    train = panel.where(F.col("split") == "train")
    terms = model.prepare(train, numeric, ["customer_city"], [])
    names = {t.name: t for t in terms}
    wanted = [*numeric, *[f"customer_city_{c}" for c in CITIES]]
    values = [F.expr(f"{names[n].value} AS x{i}") for i, n in enumerate(wanted)]
    return panel.select(*KEYS, *values)


@query
def roc_auc(spark, folder):
    return metrics.roc_auc(_scored(spark, folder), LABEL, SCORE, ["split"])


@query
def average_precision(spark, folder):
    return metrics.average_precision_retained(_scored(spark, folder), LABEL, SCORE, ["split"])


@query
def split_metrics(spark, folder):
    return metrics.evaluate(_with_score(_panel(spark, folder)), LABEL, SCORE, ["split"])


@query
def confusion(spark, folder):
    return metrics.confusion(_with_score(_panel(spark, folder)), LABEL, SCORE, ["split"])


@query
def classification_report(spark, folder):
    return metrics.classification_report(_with_score(_panel(spark, folder)), LABEL, SCORE, ["split"])


@query
def cold_start_auc(spark, folder):
    return model.cold_start(_scored(spark, folder))


def _explained(spark, folder):
    rows = settle(
        _flagged(spark, folder).select(
            *KEYS, "split", LABEL, *[t.column for t in _terms()]
        )
    )
    terms = _terms()
    means = explain.background_means(rows.where(F.col("split") == "train"), terms)
    return rows, terms, means


@query
def linear_attribution(spark, folder):
    rows, terms, means = _explained(spark, folder)
    return explain.attributions(rows, terms, means, KEYS)


@query
def global_importance(spark, folder):
    rows, terms, means = _explained(spark, folder)
    return explain.global_importance(rows.where(F.col("split") == "train"), terms, means, top=15)


@query
def explanations(spark, folder):
    rows, terms, means = _explained(spark, folder)
    numbers = [t.column for t in terms if t.kind == "number"]
    train = rows.where(F.col("split") == "train")
    usual = {r["feature"]: r["median"] for r in explain.reference_medians(train, numbers).collect()}
    # the risk stands next to what drives it
    scored = model.linear_score(rows, terms, INTERCEPT)
    return explain.explanations(scored, terms, means, usual, [*KEYS, SCORE], top=5)


@query
def reference_medians(spark, folder):
    panel = settle(_panel(spark, folder).select("split", LABEL, *MEDIANS))
    return explain.reference_medians(panel.where(F.col("split") == "train"), MEDIANS)


@query
def feature_drift(spark, folder):
    raw = _raw(spark, folder)
    both = settle(
        features.feature_table(raw, list(DRIFT_DAYS)).select("snapshot_date", *DRIFT)
    )
    sides = [both.where(F.col("snapshot_date") == moment(d)) for d in DRIFT_DAYS]
    return profile.drift(sides[0], sides[1], DRIFT)


@query
def wide_category_inputs(spark, folder):
    """Rows per input of a category with a value per product, as the sparse inputs of all items add up."""
    items = settle(_raw(spark, folder)["items"].select("order_id", "product_id", "price"))
    terms = model.prepare(items.where("order_id % 5 <> 0"), ["price"], ["product_id"], [], wide=20)
    ready = Pipeline(stages=model.input_stages(terms)).fit(items).transform(items)
    sums = ready.select(Summarizer.sum(F.col("features")).alias("s")).select(F.posexplode(vector_to_array("s")).alias("at", "n"))
    wide = next(t for t in terms if t.kind == "wide")
    plain = len(terms) - 1
    known = spark.read.parquet(wide.table).withColumn("at", F.col("code") + plain)
    return known.join(sums, "at").select(F.col("value").alias("product_id"), F.col("n").cast("bigint").alias("n_rows"))


# value and scenarios


def _risk(spark, folder, tiers: bool = True) -> DataFrame:
    base = _base(spark, folder)
    raw = base.raw
    scored = _with_score(value.scoring_snapshot(raw, standin.MAX_VALID_DATE, parts=()))
    people = behavior.revenue_summary(base.resolved, raw["items"])
    placed = behavior.value_tiers(behavior.revenue_percentile(people))
    # one table per person: it is written, checked and joined once
    extra = behavior.customer_costs(placed, raw["tickets"], keep=["segment"]).select(
        "customer_unique_id", "segment", "support_cost"
    )
    if not tiers:
        return value.revenue_at_risk(scored, extra)
    return value.score_customers(scored, extra)


@query
def tenure_skew(spark, folder):
    scored = _with_score(value.scoring_snapshot(_raw(spark, folder), standin.MAX_VALID_DATE, parts=()))
    events = staging.purchase_events(_resolved(spark, folder))
    return value.tenure_skew(scored, events, standin.MAX_VALID_DATE)


@query
def revenue_at_risk(spark, folder):
    return _risk(spark, folder, tiers=False).drop("caveat")


@query
def risk_tiers(spark, folder):
    return _risk(spark, folder).select("customer_unique_id", SCORE, "risk_tier")


ROI = [
    "n_targeted",
    "total_campaign_cost",
    "total_expected_revenue_saved",
    "net_expected_benefit",
    "roi_pct",
]


@query
def campaign_roi_topn(spark, folder):
    effect = scenario.resolve_effect("moderate")
    return scenario.campaign_roi(_risk(spark, folder), "top_n", 15, effect, n=100)[0].select(*ROI)


@query
def campaign_roi_tier(spark, folder):
    effect = scenario.resolve_effect("0.2")
    return scenario.campaign_roi(_risk(spark, folder), "risk_tier", 15, effect, tier="high")[0].select(*ROI)


@query
def campaign_roi_segment(spark, folder):
    effect = scenario.resolve_effect("optimistic")
    chosen = scenario.campaign_roi(_risk(spark, folder), "segment", 15, effect, segment="high_value")
    return chosen[0].select(*ROI)


def _budget(spark, folder):
    effect = scenario.resolve_effect("conservative")
    return scenario.budget_allocation(_risk(spark, folder), 5000, 15, effect)


@query
def budget_allocation(spark, folder):
    return _budget(spark, folder)[0].select(
        "n_targeted", "total_spent", "total_expected_revenue_saved", "net_expected_benefit"
    )


@query
def budget_selection(spark, folder):
    return _budget(spark, folder)[1].select("customer_unique_id", "expected_revenue_saved_per_dollar")


@query
def marginal_curve(spark, folder):
    return _budget(spark, folder)[2]


def _whatif(spark, folder, method: str = "absolute"):
    cutoffs = [0.0, 0.4, 0.7, 1.0] if method == "absolute" else [0.0, 0.3, 0.9, 1.0]
    return scenario.tier_whatif(_risk(spark, folder), cutoffs, fixed.RISK_LABELS, method)


@query
def tier_whatif_absolute(spark, folder):
    return _whatif(spark, folder)[0].select("customer_unique_id", "risk_tier", "risk_tier_scenario")


@query
def tier_whatif_quantile(spark, folder):
    out = _whatif(spark, folder, "quantile")[0]
    return out.select("customer_unique_id", "risk_tier", "risk_tier_scenario")


@query
def tier_summary(spark, folder):
    summary = _whatif(spark, folder)[1]
    return summary.withColumn("total_revenue_at_risk", F.round("total_revenue_at_risk", 2))


@query
def tier_movement(spark, folder):
    return _whatif(spark, folder)[2]


@query
def customers_page(spark, folder):
    total, page = value.list_customers(
        _risk(spark, folder), risk_tier="high", min_revenue_at_risk=1000, limit=20, offset=10
    )
    return page.select(
        "customer_unique_id", "revenue_at_risk", "risk_tier", F.lit(total).cast("bigint").alias("total")
    )


@query
def customer_lookup(spark, folder):
    scored = _risk(spark, folder)
    first = scored.agg(F.min("customer_unique_id")).first()[0]
    row = value.get_customer(scored, first)
    return row.select("customer_unique_id", "revenue_at_risk", "segment", "risk_tier")


@query
def customer_batch_lookup(spark, folder):
    scored = _risk(spark, folder)
    rows = value.get_customers(scored, _raw(spark, folder)["interventions"])
    return rows.select("customer_unique_id", "risk_tier")


@query
def scenario_record(spark, folder):
    effect = scenario.resolve_effect("conservative")
    summary, targeted = scenario.campaign_roi(
        _risk(spark, folder), "risk_tier", 15, effect, tier="medium"
    )
    paths = tables.save_scenario(
        "campaign_roi", "run", summary, fresh_path(spark, "scenario"), targeted, {"tier": "medium"}
    )
    written = spark.read.schema(summary.schema).json(paths["summary"])
    return written.select(*ROI)


@query
def csv_roundtrip(spark, folder):
    path = fresh_path(spark, "items")
    items = _raw(spark, folder)["items"]
    tables.write_csv(items.withColumn("shipping_limit_date", F.lit(None).cast("string")).select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"
    ), path)
    back = tables.read_csv(spark, path, "order_items")
    return back.select("order_id", "seller_id", "price", "freight_value")


@query
def tier_distribution(spark, folder):
    rows = _risk(spark, folder).groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.round(F.sum("revenue_at_risk"), 2).alias("total_revenue_at_risk"),
        F.first("caveat").alias("caveat"),
    )
    return rows


@query
def campaign_caveats(spark, folder):
    effect = scenario.resolve_effect("moderate")
    summary = scenario.campaign_roi(_risk(spark, folder), "risk_tier", 15, effect, tier="low")[0]
    return summary.select("n_targeted", "model_caveat", "retention_effect_caveat")


@query
def movement_matrix(spark, folder):
    return scenario.movement_matrix(_whatif(spark, folder)[2], fixed.RISK_LABELS)


@query
def append_roundtrip(spark, folder):
    path = fresh_path(spark, "events")
    rows = standin.read(spark, folder, "events").select("event_id", "user_id", "event_type")
    tables.append(rows.where("event_id % 2 = 0"), path)
    tables.append(rows.where("event_id % 2 <> 0"), path)
    return spark.read.schema(rows.schema).parquet(path)


@query
def truncate_roundtrip(spark, folder):
    path = fresh_path(spark, "sellers")
    unknown = {c: F.lit(None) for c in ("seller_zip_code_prefix", "seller_city")}
    sellers = _raw(spark, folder)["sellers"].withColumns({**unknown, "extra": F.lit(1)})
    for _ in range(2):  # the second load replaces the first and drops what is not declared
        tables.truncate_and_load(sellers, path, "sellers")
    return spark.read.parquet(path).select("seller_id")


@query
def catalog_roundtrip(spark, folder):
    name = fresh_table(spark, "purchase_events")
    tables.save_as_table(staging.purchase_events(_resolved(spark, folder)), name)
    return spark.table(name).select("customer_unique_id", "order_purchase_timestamp", "representative_order_id")


# fitted models


def _fitted_logistic(spark, folder):
    rows, panel = _modelling(spark, folder)
    fitted, terms = model.fit_logistic(rows["train"])
    return rows["train"], panel, fitted, terms


def _fitted_trees(spark, folder):
    """Modelling rows, and the pipeline and trees fitted anew by each query."""
    rows, panel = _modelling(spark, folder)
    return panel, model.fit_trees(rows["train"], rows["validation"])


def _fitted_explained(spark, folder):
    """Modelling rows (inputs, label and split) with the fitted score, its terms over all inputs, their background means
    and the log-odds there."""
    train, panel, fitted, terms = _fitted_logistic(spark, folder)
    means = explain.background_means(train, terms)
    usual = float(fitted.stages[-1].intercept) + sum(t.coefficient * m for t, m in zip(terms, means, strict=True))
    columns = dict.fromkeys([*KEYS, "split", LABEL, *[t.column for t in terms]])
    return model.score(fitted, panel.select(*columns)), terms, means, usual


@query
def fitted_attributions(spark, folder):
    """Attributions of the fitted model over all inputs add up to each row's log-odds."""
    rows, terms, means, usual = _fitted_explained(spark, folder)
    sums = explain.attributions(rows, terms, means, [*KEYS, SCORE]).groupBy(*KEYS, SCORE).agg(
        F.sum("attribution").alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    p = F.col(SCORE)
    odds = F.log(p / (1 - p))
    return sums.select(
        *KEYS, "_n", ((F.abs(F.col("_sum") + F.lit(usual) - odds) < 1e-6) & (F.col("_n") == len(terms))).alias("adds_up")
    ).drop("_n")


@query
def fitted_importance(spark, folder):
    """The 15 strongest of all inputs of the fitted model: how many, and whether all are strong and named."""
    rows, terms, means, _ = _fitted_explained(spark, folder)
    rows = settle(rows)
    best = explain.global_importance(rows.where(F.col("split") == "train"), terms, means, top=15)
    return best.agg(
        F.count(F.lit(1)).alias("n_inputs"),
        F.every(F.col("mean_abs_attribution") > 0).alias("strong"),
        F.every(F.length("plain_label") > 0).alias("named"),
    )


@query
def fitted_explanations(spark, folder):
    """Five factors in words for every row, from all inputs of the fitted model."""
    rows, terms, means, _ = _fitted_explained(spark, folder)
    rows = settle(rows)
    came_back = explain.reference_medians(rows.where(F.col("split") == "train")).collect()
    usual = {r["feature"]: r["median"] for r in came_back}
    lines = explain.explanations(rows, terms, means, usual, [*KEYS, SCORE], top=5)
    return lines.select(*KEYS, F.size(F.split("top_factors", "\n")).cast("bigint").alias("n_factors"))


@query
def prepared_inputs_all(spark, folder):
    """All inputs as the model's default preparation makes them; of a category's inputs the name of the one that is set."""
    rows, panel = _modelling(spark, folder)
    terms = model.prepare(rows["train"])
    chosen = [
        F.concat_ws(",", *[F.when(F.expr(t.value) == 1, t.name) for t in terms if t.kind == "category" and t.column == c]).alias(f"x_{c}")
        for c in fixed.CATEGORICAL_FEATURES
    ]
    return panel.select(*KEYS, *[F.expr(t.value).alias(f"x_{t.name}") for t in terms if t.kind != "category"], *chosen)


@query
def reference_medians_all(spark, folder):
    panel = settle(_panel(spark, folder, *features.PARTS).select("split", LABEL, *fixed.NUMERIC_FEATURES))
    return explain.reference_medians(panel.where(F.col("split") == "train"))


@query
def lr_gradient(spark, folder):
    """The objective's gradient at the fitted coefficients, per input: zero where it is least."""
    train, _, fitted, terms = _fitted_logistic(spark, folder)
    scored = model.score(fitted, train).withColumn("_w", model.balanced_weight(train))
    pull = F.col("_w") * (F.col(SCORE) - F.col(LABEL))
    n = F.count(F.lit(1))
    sums = scored.agg(*[(F.sum(pull * F.expr(t.value)) / n).alias(f"g{i}") for i, t in enumerate(terms)], n.alias("n"))
    cells = F.array(
        *[
            F.struct(
                F.lit(t.name).alias("term"),
                F.round(F.col(f"g{i}") + F.lit(t.coefficient) / F.col("n"), 4).alias("gradient"),
            )
            for i, t in enumerate(terms)
        ]
    )
    return sums.select(F.explode(cells).alias("c")).select("c.*")


@query
def model_roundtrip(spark, folder):
    """Scores of a stored and reloaded model equal those of the fitted one."""
    _, panel, fitted, terms = _fitted_logistic(spark, folder)
    path = fresh_path(spark, "model")
    model.save(fitted, path, terms)
    # both scores of a row meet in the row itself, its keys need not be dealt for a join
    before = model.score(fitted, panel).withColumnRenamed(SCORE, "_before")
    after = model.score(model.load(path), before)
    same = model.load_terms(spark, path) == terms
    return after.select(*KEYS, ((F.col(SCORE) == F.col("_before")) & F.lit(same)).alias("same_score"))


@query
def gbt_summary(spark, folder):
    """Facts that hold for boosted trees stopped by patience, with the rows of each split."""
    panel, (fitted, trees) = _fitted_trees(spark, folder)
    scored = model.score(fitted, panel)
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.every(F.col(SCORE).between(0, 1)).alias("probabilities"),
        F.lit(len(trees) > 1).alias("several_trees"),
        F.lit(len(trees) < fixed.TREE_SETTINGS["rounds"]).alias("below_bound"),
    )


# without a SQL counterpart: scores of fitted models


def _modelling(spark, folder):
    panel = features.add_missing_indicators(_panel(spark, folder, *features.PARTS))
    panel = settle(panel)
    return {s: panel.where(F.col("split") == s) for s in ("train", "validation", "test")}, panel


@query
def lr_train_score(spark, folder):
    rows, panel = _modelling(spark, folder)
    fitted, _ = model.fit_logistic(rows["train"])
    return model.score(fitted, panel).select(*KEYS, "split", SCORE)


@query
def gbt_train_score(spark, folder):
    panel, (fitted, _) = _fitted_trees(spark, folder)
    return model.score(fitted, panel).select(*KEYS, "split", SCORE)


@query
def model_comparison(spark, folder):
    rows, panel = _modelling(spark, folder)
    terms = model.prepare(rows["train"])
    trees, _ = model.fit_trees(rows["train"], rows["validation"], terms)
    linear, _ = model.fit_logistic(rows["train"], terms)
    slim = panel.columns
    scored = {
        name: settle(model.score(m, panel.select(*slim)).select("split", LABEL, SCORE))
        for name, m in (("logistic_regression", linear), ("boosted_trees", trees))
    }
    return model.compare(scored)


@query
def seeded_sample(spark, folder):
    customers = standin.read(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return ordered.seeded_sample(customers, "c_custkey", 500)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


