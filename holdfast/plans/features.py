"""Point-in-time features: one row per person and snapshot date.

How the work is laid out
------------------------
Every window of every snapshot ends and starts at a known date. Those dates cut
the time axis into *periods*, so that each window is a run of whole periods.

1. Each source shrinks to one row per person and period. The map side combines,
   so a person with a third of all orders still arrives as a few dozen rows.
2. The rows of all sources are stacked and exchanged once, by person.
3. In place, each row meets every snapshot (an array literal, no join), and one
   aggregate adds up the periods each window covers: past ones for features,
   later ones for the label. Nothing else is exchanged.

Only counts, whole-day sums, cents, minima and maxima travel, all mergeable and
exact. Categories, sellers and payment types are not additive over time: they add up
by person and value first (see ``_holdings``) and then shrink to one row per person
with an entry per snapshot, which meets the features where they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.functions.amounts import ratio, sample_std
from holdfast.functions.dates import floored_days
from holdfast.operators.neighbours import with_previous
from holdfast.operators.ordered import slice_of, sql_literal
from holdfast.operators.profile import duplicate_keys
from holdfast.plans import staging
from holdfast.session import settle

PERSON, SNAPSHOT = "customer_unique_id", "snapshot_date"
PARTS = ("orders", "payments", "support", "campaigns", "interventions", "items", "geography")

TICKET_COLUMNS = [
    PERSON, "created_at", "resolved", "escalated", "resolution_hours", "customer_satisfaction",
]
ORDER_COLUMNS = [
    "order_id", PERSON, "order_purchase_timestamp", "order_delivered_customer_date", "delivery_status", "delivery_days",
    "delivery_delay_days", "order_total_cents", "payment_cents", "installments_mean", "payment_type_mode", "review_score",
]
CAMPAIGN_COLUMNS = [PERSON, "campaign_date", "opened", "clicked", "converted"]
INTERVENTION_COLUMNS = [PERSON, "created_at"]


def check_calendar(
    snapshots: Sequence[datetime], max_valid: datetime, churn_days: int = fixed.CHURN_DAYS
) -> None:
    """Each snapshot's label window must lie within the data, or labels are censored."""
    for day in snapshots:
        if day + timedelta(days=churn_days) > max_valid:
            raise ValueError(f"the label of {day} needs data to {day + timedelta(days=churn_days)}, but it ends on {max_valid}")


class Periods:
    """The cut dates of a snapshot calendar and where each window begins and ends."""

    def __init__(self, snapshots: Sequence[datetime]):
        self.snapshots = sorted(set(snapshots))
        self.cuts = sorted(
            {day - timedelta(days=back) for day in self.snapshots for back in (0, 30, 90, 180)}
        )

    def period(self, time: str) -> Column:
        """Number of cuts before ``time``: ``time <= cuts[i]`` exactly if the period is <= i."""
        return slice_of(time, self.cuts)

    def expanded(self) -> Column:
        """One row per snapshot with the periods at which its windows begin and end."""
        rows = [
            f"named_struct('{SNAPSHOT}', {sql_literal(day)}, "
            + ", ".join(
                f"'{name}', {self.cuts.index(day - timedelta(days=back))}"
                for name, back in (("_now", 0), ("_d30", 30), ("_d90", 90), ("_d180", 180))
            )
            + ")"
            for day in self.snapshots
        ]
        return F.expr(f"explode(array({', '.join(rows)})) AS _s")

    def place(self, snapshot: str) -> Column:
        """Place of the snapshot in the calendar, from 0."""
        cases = " ".join(f"WHEN {sql_literal(day)} THEN {i}" for i, day in enumerate(self.snapshots))
        return F.expr(f"CASE {snapshot} {cases} END")


def _per_period(
    df: DataFrame, time: str, periods: Periods, known: str | None = None, **measures: Column
) -> DataFrame:
    """``measures`` by person and period of ``time``, and by the period of ``known``, the time
    from which they can be seen, where that is given."""
    rows = df.where(F.col(time).isNotNull()).withColumn("_period", periods.period(time))
    keys = [PERSON, "_period"]
    if known is not None:
        rows = rows.withColumn("_known", periods.period(known))
        keys.append("_known")
    return (
        rows.groupBy(*keys)
        .agg(*[m.alias(name) for name, m in measures.items()])
    )


def _yes(flag: str) -> Column:
    return F.count_if(F.col(flag))


def order_measures() -> tuple[dict[str, Column], dict[str, Column]]:
    """What orders add up to by themselves: at purchase, and by their outcome."""
    time = "order_purchase_timestamp"
    delivered = F.col("delivery_status") == "delivered"
    delay = F.when(delivered, F.col("delivery_delay_days")).cast("bigint")
    days = F.when(delivered, F.col("delivery_days")).cast("bigint")
    purchase = {
        "orders": F.count(F.lit(1)),
        "first_at": F.min(time),
        "last_at": F.max(time),
        "valued": F.count("order_total_cents"),
        "revenue": F.sum("order_total_cents"),
        "largest": F.max("order_total_cents"),
        "paid": F.sum("payment_cents"),
        "instalments_n": F.count("installments_mean"),
        "instalments_sum": F.sum("installments_mean"),
    }
    outcome = {
        "delivered": F.count_if(delivered),
        "delayed_n": F.count(delay),
        "delay_sum": F.sum(delay),
        "late": F.count_if(delay > 0),
        "days_n": F.count(days),
        "days_sum": F.sum(days),
        "reviewed": F.count("review_score"),
        "review_sum": F.sum("review_score"),
        "negative": F.count_if(F.col("review_score") <= 2),
    }
    return purchase, outcome


def event_measures() -> dict[str, Column]:
    """Purchase events and the days between them, of purchase moments with ``previous``.

    The previous moment tells both at once: one at the same time is a cart split and no
    new event; otherwise the distance is the gap between events.
    """
    time = F.col("order_purchase_timestamp")
    before = F.col("previous.order_purchase_timestamp")
    gap = F.when(before < time, floored_days(before, time)).cast("bigint")
    return {
        "events": F.count_if(before.isNull() | (before < time)),
        "gaps": F.count(gap),
        "gap_sum": F.sum(gap),
        "gap_squares": F.sum(gap * gap),
    }


def _order_periods(orders: DataFrame, periods: Periods, strict: bool) -> list[DataFrame]:
    """Orders and purchase events of each person and period.

    Only the different moments of a person are put in order, not the orders themselves.
    """
    time = "order_purchase_timestamp"
    rows = orders.where(F.col(PERSON).isNotNull())
    moments = with_previous(rows.select(PERSON, time).distinct(), PERSON, time)
    events = _per_period(moments, time, periods, **event_measures())
    purchase, outcome = order_measures()
    if not strict:
        return [_per_period(rows, time, periods, **purchase, **outcome), events]
    # a delivery can be seen from its date on, a review not before the delivery
    seen = F.greatest(time, F.coalesce("order_delivered_customer_date", time))
    return [
        events,
        _per_period(rows, time, periods, **purchase),
        _per_period(rows.withColumn("_seen_at", seen), time, periods, known="_seen_at", **outcome),
    ]


def _ticket_periods(tickets: DataFrame, periods: Periods, strict: bool) -> list[DataFrame]:
    hours = F.col("resolution_hours").cast("double")
    happy = F.col("customer_satisfaction").cast("bigint")
    opened = {"tickets": F.count(F.lit(1))}
    outcome = {
        "resolved_n": F.count("resolved"),
        "resolved": _yes("resolved"),
        "escalated_n": F.count("escalated"),
        "escalated": _yes("escalated"),
        "hours_n": F.count(hours),
        "hours_sum": F.sum(hours),
        "happy_n": F.count(happy),
        "happy_sum": F.sum(happy),
    }
    rows = tickets.select(*TICKET_COLUMNS)
    if not strict:
        return [_per_period(rows, "created_at", periods, **opened, **outcome)]
    # how a ticket ends can be seen once it has taken its time
    minutes = F.make_dt_interval(mins=F.round(F.coalesce(hours, F.lit(0.0)) * 60).cast("int"))
    closed = rows.withColumn("_seen_at", F.col("created_at") + minutes)
    return [
        _per_period(rows, "created_at", periods, **opened),
        _per_period(closed, "created_at", periods, known="_seen_at", **outcome),
    ]


def _campaign_periods(campaigns: DataFrame, periods: Periods, strict: bool) -> list[DataFrame]:
    """Opening, clicking and converting carry no dates of their own."""
    counted = _per_period(
        campaigns.select(*CAMPAIGN_COLUMNS),
        "campaign_date",
        periods,
        touches=F.count(F.lit(1)),
        opened_n=F.count("opened"),
        opened=_yes("opened"),
        clicked_n=F.count("clicked"),
        clicked=_yes("clicked"),
        converted_n=F.count("converted"),
        converted=_yes("converted"),
        touched_at=F.max("campaign_date"),
    )
    return [counted]


def _intervention_periods(interventions: DataFrame, periods: Periods, strict: bool) -> list[DataFrame]:
    rows = interventions.select(*INTERVENTION_COLUMNS)
    return [_per_period(rows, "created_at", periods, interventions=F.count(F.lit(1)))]


# Windows over periods, relative to the snapshot of the current row.
_WINDOWS = {
    "past": "_period <= _now",
    "d30": "_period > _d30 AND _period <= _now",
    "d90": "_period > _d90 AND _period <= _now",
    "d180": "_period > _d180 AND _period <= _now",
    "earlier": "_period > _d180 AND _period <= _d90",
    "future": "_period > _now",
}
# Which measures each window adds up; the rest are minima and maxima.
_SUMS = {
    "orders": {
        "past": [
            "orders",
            "events",
            "gaps",
            "gap_sum",
            "gap_squares",
            "valued",
            "revenue",
            "delivered",
            "delayed_n",
            "delay_sum",
            "late",
            "days_n",
            "days_sum",
            "reviewed",
            "review_sum",
            "negative",
            "paid",
            "instalments_n",
            "instalments_sum",
        ],
        "d30": [
            "events",
        ],
        "d90": [
            "events",
            "revenue",
            "reviewed",
            "review_sum",
            "delayed_n",
            "delay_sum",
        ],
        "d180": [
            "events",
        ],
        "earlier": [
            "events",
            "revenue",
            "reviewed",
            "review_sum",
        ],
    },
    "support": {
        "past": [
            "tickets",
            "resolved_n",
            "resolved",
            "escalated_n",
            "escalated",
            "hours_n",
            "hours_sum",
            "happy_n",
            "happy_sum",
        ],
        "d90": [
            "tickets",
        ],
    },
    "campaigns": {
        "past": [
            "touches",
            "opened_n",
            "opened",
            "clicked_n",
            "clicked",
            "converted_n",
            "converted",
        ],
    },
    "interventions": {
        "past": [
            "interventions",
        ],
    },
}
_EXTREMES = {
    "orders": [
        ("min", "past", "first_at"),
        ("max", "past", "last_at"),
        ("max", "past", "largest"),
        ("min", "future", "first_at"),
    ],
    "campaigns": [
        ("max", "past", "touched_at"),
    ],
}


def _window_aggregates(parts: set[str], strict: bool) -> list[Column]:
    """One aggregate per window and measure, named like ``past_revenue``."""
    out = []
    seen = " AND coalesce(_known, _period) <= _now" if strict else ""
    for part in sorted(parts):
        for window, names in _SUMS[part].items():
            for name in names:
                out.append(
                    f"coalesce(sum({name}) FILTER (WHERE {_WINDOWS[window]}{seen}), 0) AS {window}_{name}"
                )
        for how, window, name in _EXTREMES.get(part, []):
            out.append(f"{how}({name}) FILTER (WHERE {_WINDOWS[window]}) AS {window}_{name}")
    return [F.expr(text) for text in out]


def _features(churn_days: int, parts: set[str]) -> list[Column]:
    """The feature columns from the windowed sums."""
    at = F.col(SNAPSHOT)

    def mean(of: str, over: str) -> str:
        return f"try_divide(CAST({of} AS DOUBLE), {over})"

    recency = floored_days(F.col("past_last_at"), at)
    until_next = floored_days(at, F.col("future_first_at"))
    spread = sample_std(F.col("past_gaps"), F.col("past_gap_sum"), F.col("past_gap_squares"))
    delay = mean("past_delay_sum", "past_delayed_n")
    review = {w: mean(f"{w}_review_sum", f"{w}_reviewed") for w in ("past", "d90", "earlier")}
    frequency = "CAST(past_events AS DOUBLE) / _tenure"
    text = {
        "orders_last_30_days": "d30_events",
        "orders_last_90_days": "d90_events",
        "orders_last_180_days": "d180_events",
        "lifetime_orders": "past_events",
        "lifetime_revenue": "past_revenue / 100D",
        "revenue_last_90_days": "d90_revenue / 100D",
        "average_order_value": mean("past_revenue / 100D", "past_valued"),
        "max_order_value": "past_largest / 100D",
        "purchase_frequency": frequency,
        "purchase_gap_mean": mean("past_gap_sum", "past_gaps"),
        "average_delivery_delay": delay,
        "late_delivery_rate": mean("past_late", "past_delivered"),
        "average_delivery_days": mean("past_days_sum", "past_days_n"),
        "average_review_score": review["past"],
        # over all orders, not only reviewed ones; NULL without any review
        "negative_review_rate": f"IF(past_reviewed > 0, {mean('past_negative', 'past_orders')}, NULL)",
        "installment_frequency": mean("past_instalments_sum", "past_instalments_n"),
        "payment_value": "past_paid / 100D",
        "spend_trend_90d": "(d90_revenue - earlier_revenue) / 100D",
        "purchase_frequency_trend_90d": "d90_events - earlier_events",
        "review_trend_90d": f"{review['d90']} - {review['earlier']}",
        "recent_90d_revenue": "d90_revenue / 100D",
        "previous_90d_revenue": "earlier_revenue / 100D",
        "recent_90d_order_count": "d90_events",
        "lifetime_purchase_frequency": frequency,
        "recent_delivery_delay": mean("d90_delay_sum", "d90_delayed_n"),
        "historical_delivery_delay": delay,
    }
    dated = {
        "days_since_last_purchase": recency,
        "days_since_previous_order": recency,
        "purchase_gap_std": spread,
        "days_to_next_purchase": until_next,
        "churned": F.when(until_next <= churn_days, 0).otherwise(1),
    }
    if "support" in parts:
        text |= {
            "n_support_tickets": "past_tickets",
            "n_tickets_last_90_days": "d90_tickets",
            "pct_tickets_resolved": mean("past_resolved", "past_resolved_n"),
            "pct_tickets_escalated": mean("past_escalated", "past_escalated_n"),
            "avg_resolution_hours": mean("past_hours_sum", "past_hours_n"),
            "avg_ticket_satisfaction": mean("past_happy_sum", "past_happy_n"),
        }
    if "campaigns" in parts:
        text |= {
            "n_campaigns_received": "past_touches",
            "pct_campaigns_opened": mean("past_opened", "past_opened_n"),
            "pct_campaigns_clicked": mean("past_clicked", "past_clicked_n"),
            "pct_campaigns_converted": mean("past_converted", "past_converted_n"),
        }
        dated["days_since_last_campaign"] = floored_days(F.col("past_touched_at"), at)
    if "interventions" in parts:
        text["has_been_targeted_for_retention"] = "CAST(past_interventions > 0 AS INT)"
    return [F.expr(f"{e} AS {name}") for name, e in text.items()] + [
        c.alias(name) for name, c in dated.items()
    ]


def _stack(sources: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def _holdings(
    rows: DataFrame, time: str, keys: Sequence[str], amount: Column, periods: Periods
) -> DataFrame:
    """Amount held per person and key value: ``_h0``, ``_h1`` and so on by snapshot, NULL while not held.

    Grouped by person *and* value, so even a person who bought from every seller
    is spread over many tasks. Rows behind the last snapshot never count.
    """
    days = [sql_literal(day) for day in periods.snapshots]
    sums = [
        F.expr(f"sum(_amount) FILTER (WHERE {time} <= {day}) AS _h{i}") for i, day in enumerate(days)
    ]
    return (
        rows.where(F.expr(f"{time} <= {days[-1]}"))
        .select(PERSON, *keys, time, amount.alias("_amount"))
        .groupBy(PERSON, *keys)
        .agg(*sums)
    )


def _per_person(held: DataFrame, periods: Periods, entry) -> DataFrame:
    """One row per person, ``_entries`` with what ``entry`` makes of the holdings at each snapshot.

    ``held`` has a row per person and value, so what one person brings is bounded by the
    number of values; nothing is left to combine before the exchange.
    """
    found = [entry(f"_h{i}") for i in range(len(periods.snapshots))]
    aggregates = [c.alias(f"_e{i}_{n}") for i, (parts, _) in enumerate(found) for n, c in parts.items()]
    made = [
        finish(lambda n, i=i: F.col(f"_e{i}_{n}")) for i, (_, finish) in enumerate(found)
    ]
    return held.repartition(PERSON).groupBy(PERSON).agg(*aggregates).select(PERSON, F.array(*made).alias("_entries"))


def _item_features(items: DataFrame, periods: Periods) -> DataFrame:
    """Distinct categories and sellers, and how concentrated the spending on them is, by person."""
    kinds = F.explode(
        F.array(
            F.struct(F.lit("c").alias("kind"), F.col("product_category_english").cast("string").alias("id")),
            F.struct(F.lit("s").alias("kind"), F.col("seller_id").cast("string").alias("id")),
        )
    ).alias("_k")
    rows = items.select(PERSON, "order_purchase_timestamp", "price_cents", kinds).select(
        PERSON, "order_purchase_timestamp", "price_cents", "_k.*"
    )
    held = _holdings(
        rows, "order_purchase_timestamp", ["kind", "id"], F.col("price_cents"), periods
    )
    named = held.withColumn("kind", F.when(F.col("id").isNotNull(), F.col("kind"))).drop("id")

    def entry(h: str):
        parts = {"any": F.count(h)}
        for kind in ("c", "s"):
            mine = (F.col("kind") == kind) & F.col(h).isNotNull()
            spent = F.when(mine, F.col(h).cast("double"))
            parts |= {f"{kind}_n": F.count_if(mine), f"{kind}_sum": F.sum(spent), f"{kind}_squares": F.sum(spent * spent)}

        def finish(of) -> Column:
            def focus(kind: str) -> Column:
                return ratio(of(f"{kind}_squares"), of(f"{kind}_sum") * of(f"{kind}_sum"))

            return F.when(
                of("any") > 0,
                F.struct(
                    of("c_n").alias("unique_categories"),
                    focus("c").alias("category_concentration"),
                    of("s_n").alias("unique_sellers"),
                    focus("s").alias("seller_concentration"),
                ),
            )

        return parts, finish

    return _per_person(named, periods, entry)


def _preferred_payment(orders: DataFrame, periods: Periods, amount: Column | None = None) -> DataFrame:
    """Mode over orders of each order's own most frequent payment type, ties to the smallest, by person."""
    typed = orders.where(F.col("payment_type_mode").isNotNull())
    held = _holdings(
        typed, "order_purchase_timestamp", ["payment_type_mode"], F.lit(1) if amount is None else amount, periods
    )

    def entry(h: str):
        mine = F.struct((-F.col(h)).alias("r"), F.col("payment_type_mode").alias("v"))
        best = F.min(F.when(F.col(h).isNotNull(), mine))
        return {"best": best}, lambda of: F.struct(of("best")["v"].alias("preferred_payment_method"))

    return _per_person(held, periods, entry)


def with_entries(panel: DataFrame, extra: DataFrame, periods: Periods) -> DataFrame:
    """``panel`` plus the columns of each person's entry at the row's snapshot.

    Both sides lie by person, so neither moves for the join.
    """
    at = F.get("_entries", periods.place(SNAPSHOT))
    rows = panel.join(extra, PERSON, "left").withColumn("_entry", at)
    return rows.select(*panel.columns, "_entry.*")


def assign_splits(panel: DataFrame, splits: Mapping[datetime, str]) -> DataFrame:
    """Adds ``split`` by snapshot and keeps each person only in the split of their first one.

    Without this the same person would appear in training and in test.
    """
    first = F.min(SNAPSHOT).over(Window.partitionBy(PERSON))  # one row per snapshot in a partition
    return (
        panel.withColumn("_first", first)
        .withColumn("split", _split_of(SNAPSHOT, splits))
        .where(F.col("split") == _split_of("_first", splits))
        .drop("_first")
    )


def _split_of(day: str, splits: Mapping[datetime, str]) -> Column:
    cases = " ".join(f"WHEN {sql_literal(d)} THEN {sql_literal(s)}" for d, s in splits.items())
    return F.expr(f"CASE {day} {cases} END")


def panel_of(
    sources: Sequence[DataFrame], parts: set[str], periods: Periods, churn_days: int, strict: bool = False
) -> DataFrame:
    """Features and label of each person and snapshot from rows by person and period."""
    stacked = _stack(sources)
    tenure = floored_days(F.col("past_first_at"), F.col(SNAPSHOT))
    return (
        stacked.repartition(PERSON)
        .select("*", periods.expanded())
        .select(*stacked.columns, "_s.*")
        # of what comes after a snapshot only the next purchase counts
        .where("_period <= _now OR first_at IS NOT NULL")
        .groupBy(PERSON, SNAPSHOT)
        .agg(*_window_aggregates(parts, strict))
        .where("past_orders > 0")
        .withColumn("_tenure", F.greatest(tenure, F.lit(1)))
        .select(PERSON, SNAPSHOT, *_features(churn_days, parts))
    )


def snapshot_features(
    snapshots: Sequence[datetime],
    order_summary: DataFrame,
    item_summary: DataFrame | None = None,
    geography: DataFrame | None = None,
    tickets: DataFrame | None = None,
    campaigns: DataFrame | None = None,
    interventions: DataFrame | None = None,
    churn_days: int = fixed.CHURN_DAYS,
    splits: Mapping[datetime, str] | None = None,
    payment_method: bool = True,
    strict_as_of: bool = False,
) -> DataFrame:
    """All features and the label for each person with an order at or before a snapshot.

    Sources left out leave their columns out. With ``splits``, persons are kept to
    one split (see ``assign_splits``). Cost and segment tables are derived from a
    person's whole history and have no place here: they would leak the future.

    Rows are chosen by the time of purchase or opening. With ``strict_as_of``, what became
    known only after a snapshot is left out too: deliveries and reviews of orders still under
    way, outcomes of tickets still open.

    Reads ``order_summary`` several times: pass a stored table, not a plan.
    """
    periods = Periods(snapshots)
    sources = _order_periods(order_summary, periods, strict_as_of)
    parts = {"orders"}
    for name, table, build in (
        ("support", tickets, _ticket_periods),
        ("campaigns", campaigns, _campaign_periods),
        ("interventions", interventions, _intervention_periods),
    ):
        if table is not None:
            parts.add(name)
            sources += build(table, periods, strict_as_of)
    panel = panel_of(sources, parts, periods, churn_days, strict_as_of)
    if splits is not None:
        panel = assign_splits(panel, splits)
    if geography is not None:
        panel = panel.join(geography, PERSON, "left")
    for extra in (
        _item_features(item_summary, periods) if item_summary is not None else None,
        _preferred_payment(order_summary, periods) if payment_method else None,
    ):
        if extra is not None:
            panel = with_entries(panel, extra, periods)
    return panel


class Base:
    """Order summary, item summary and geography over the raw tables."""

    def __init__(self, raw: Mapping[str, DataFrame]):
        self.raw = raw
        staged = staging.stage_orders(raw["orders"])
        self.resolved = staging.resolved_orders(staged, raw["customers"])

    def order_summary(self) -> DataFrame:
        raw = self.raw
        return staging.order_summary(self.resolved, raw["items"], raw["payments"], raw["reviews"])

    def item_summary(self, orders: DataFrame | None = None) -> DataFrame:
        """Items with their buyers, those from ``orders`` where they are stored already."""
        raw = self.raw
        overrides = raw.get("overrides", fixed.CATEGORY_OVERRIDES)
        products = staging.stage_products(raw["products"], raw["translation"], overrides)
        return staging.item_summary(raw["items"], products, self.resolved if orders is None else orders)

    def geography(self) -> DataFrame:
        return staging.customer_geography(self.raw["customers"])


def feature_table(
    raw: Mapping[str, DataFrame],
    snapshots: Sequence[datetime],
    splits: Mapping[datetime, str] | None = None,
    parts: Sequence[str] = PARTS,
    last_valid: datetime | None = None,
    **options,
) -> DataFrame:
    """``snapshot_features`` straight from the raw tables, limited to ``parts``.

    With ``last_valid``, the last day of complete data, snapshots whose label would need
    later data are an error.
    """
    if last_valid is not None:
        check_calendar(snapshots, last_valid, options.get("churn_days", fixed.CHURN_DAYS))
    base = Base(raw)
    owned = F.col(PERSON).isNotNull() & F.col("order_purchase_timestamp").isNotNull()
    columns = [c for c in ORDER_COLUMNS if "payments" in parts or c != "payment_type_mode"]
    orders = settle(base.order_summary().where(owned).select(*columns))
    return snapshot_features(
        snapshots,
        orders,
        base.item_summary(orders) if "items" in parts else None,
        base.geography() if "geography" in parts else None,
        raw["tickets"] if "support" in parts else None,
        raw["campaigns"] if "campaigns" in parts else None,
        raw["interventions"] if "interventions" in parts else None,
        splits=splits,
        payment_method="payments" in parts,
        **options,
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, after checking that ``keys`` identify its rows."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"Duplicate rows for {list(keys)}.")
    return df


def split_summary(panel: DataFrame) -> DataFrame:
    """Rows, persons and churn rate per split."""
    persons = panel.groupBy("split", PERSON).agg(
        F.count(F.lit(1)).alias("n"), F.sum("churned").alias("churned")
    )
    return persons.groupBy("split").agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("unique_customers"),
        ratio(F.sum("churned"), F.sum("n")).alias("churn_rate"),
    )


def add_missing_indicators(
    panel: DataFrame, indicators: Mapping[str, Sequence[str]] = fixed.INDICATORS
) -> DataFrame:
    """1 where any column of a group has a value; a missing review trend becomes 0."""
    flags = {
        name: F.coalesce(*[F.col(c).cast("double") for c in columns]).isNotNull().cast("int")
        for name, columns in indicators.items()
    }
    return panel.withColumns(
        {**flags, "review_trend_90d": F.coalesce(F.col("review_trend_90d"), F.lit(0.0))}
    )


def single_order_invariant(panel: DataFrame) -> DataFrame:
    """Rows with one lifetime order against rows without a mean gap: the shares should agree."""
    rows = F.count(F.lit(1))
    single = ratio(F.count_if(F.col("lifetime_orders") == 1), rows) * 100
    no_gap = ratio(F.count_if(F.col("purchase_gap_mean").isNull()), rows) * 100
    return panel.groupBy().agg(
        F.round(single, 2).alias("single_order_pct"),
        F.round(no_gap, 2).alias("null_gap_pct"),
        F.round(single - no_gap, 2).alias("difference"),
    )
