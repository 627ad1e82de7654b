"""A feature store of partial sums, to which new and late rows are added.

What is stored
--------------
* ``orders``, ``support``, ``campaigns``, ``interventions``: one row per person and day with the
  measures of the feature plan: counts, sums, minima and maxima, all of which merge.
* ``items``, ``payments``: spending by person, day, category and seller, orders by person, day and
  payment type.
* ``moments``: the different purchase moments of a person. Gaps between purchases do not merge
  when a late order falls between two others, so they are taken from here.

The day of a row is the midnight at or after it. Snapshots are midnights and so are the edges
of their windows, so a day lies on one side of each edge as a whole. A new snapshot, or late
rows of any age, need no raw row again: features come from the stored tables alone.

Rows arrive in named batches. A batch is written table by table and counts once its name is in
the log, which is written last: what a lost driver leaves behind is ignored and overwritten
by the next try. Each order belongs to one batch, with all its items, payments and reviews.
``compact`` merges all batches into one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import fixed
from holdfast.operators.neighbours import with_previous
from holdfast.plans import features
from holdfast.plans.features import PERSON, Periods
from holdfast.session import settle

TIME, DAY = "order_purchase_timestamp", "_until"
#: measures that merge as minimum or maximum; all others are sums
EXTREMES = {"first_at": F.min, "last_at": F.max, "largest": F.max, "touched_at": F.max}
#: what identifies a stored row, besides which it has measures only
TABLE_KEYS = {
    "orders": [PERSON, DAY],
    "support": [PERSON, DAY],
    "campaigns": [PERSON, DAY],
    "interventions": [PERSON, DAY],
    "items": [PERSON, DAY, "product_category_english", "seller_id"],
    "payments": [PERSON, DAY, "payment_type_mode"],
    "moments": [PERSON, TIME],
}
LOG = "batch string, tables array<string>, replaces array<string>"


class Days:
    """The calendar of the stored rows: the period of a time is the midnight at or after it."""

    def period(self, time: str) -> Column:
        midnight = F.col(time).cast("date").cast("timestamp_ntz")
        return F.when(F.col(time) == midnight, midnight).otherwise(midnight + F.expr("INTERVAL 1 DAY"))


def merged(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per ``keys``; all other columns are measures."""
    measures = [EXTREMES.get(c, F.sum)(c).alias(c) for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*measures) if measures else rows.select(*keys).distinct()


class FeatureStore:
    """The store below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        # an empty addition makes a new log and leaves an old one as it is
        spark.createDataFrame([], LOG).write.mode("append").parquet(f"{self.path}/log")

    def batches(self) -> dict[str, list[str]]:
        """The batches that count and the tables of each: a row per batch, however large."""
        rows = self.spark.read.schema(LOG).parquet(f"{self.path}/log").collect()
        gone = {b for r in rows for b in r["replaces"]}
        return {r["batch"]: r["tables"] for r in rows if r["batch"] not in gone}

    def _read(self, table: str) -> DataFrame | None:
        paths = [f"{self.path}/{table}/{b}" for b, tables in sorted(self.batches().items()) if table in tables]
        return self.spark.read.parquet(*paths) if paths else None

    def _write(self, batch: str, tables: Mapping[str, DataFrame], replaces: Sequence[str] = ()) -> None:
        known = {r["batch"] for r in self.spark.read.schema(LOG).parquet(f"{self.path}/log").collect()}
        if batch in known:
            raise ValueError(f"batch {batch!r} is in the store already")
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{self.path}/{name}/{batch}")
        entry = self.spark.createDataFrame([(batch, list(tables), list(replaces))], LOG)
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def add(
        self,
        batch: str,
        order_summary: DataFrame | None = None,
        item_summary: DataFrame | None = None,
        tickets: DataFrame | None = None,
        campaigns: DataFrame | None = None,
        interventions: DataFrame | None = None,
    ) -> None:
        """Adds the partial sums of some rows, new ones or late ones. Orders without
        person belong to nobody, rows without time to no day."""
        days, out = Days(), {}
        for name, table, build in (
            ("support", tickets, features._ticket_periods),
            ("campaigns", campaigns, features._campaign_periods),
            ("interventions", interventions, features._intervention_periods),
        ):
            if table is not None:
                out[name] = build(table, days, False)[0].withColumnRenamed("_period", DAY)
        if order_summary is not None:
            dated = settle(order_summary.where(F.col(TIME).isNotNull() & F.col(PERSON).isNotNull()))
            purchase, outcome = features.order_measures()
            measured = features._per_period(dated, TIME, days, **purchase, **outcome)
            out["orders"] = measured.withColumnRenamed("_period", DAY)
            out["moments"] = dated.select(*TABLE_KEYS["moments"]).distinct()
            typed = dated.where(F.col("payment_type_mode").isNotNull()).withColumn(DAY, days.period(TIME))
            out["payments"] = typed.groupBy(*TABLE_KEYS["payments"]).agg(F.count(F.lit(1)).alias("n"))
        if item_summary is not None:
            dated = item_summary.where(F.col(TIME).isNotNull()).withColumn(DAY, days.period(TIME))
            out["items"] = dated.groupBy(*TABLE_KEYS["items"]).agg(F.sum("price_cents").alias("price_cents"))
        self._write(batch, out)

    def compact(self, batch: str) -> None:
        """Merges all batches into one named ``batch``. Readers under way keep the old files."""
        old = self.batches()
        names = sorted({t for tables in old.values() for t in tables})
        self._write(batch, {t: merged(self._read(t), TABLE_KEYS[t]) for t in names}, sorted(old))

    def features(
        self,
        snapshots: Sequence[datetime],
        splits: Mapping[datetime, str] | None = None,
        geography: DataFrame | None = None,
        churn_days: int = fixed.CHURN_DAYS,
    ) -> DataFrame:
        """The feature table of ``features.snapshot_features`` from the stored rows.

        Tables that no batch brought leave their columns out. A store without orders is a
        ``LookupError``, a snapshot inside a day a ``ValueError``.
        """
        for day in snapshots:
            if (day.hour, day.minute, day.second, day.microsecond) != (0, 0, 0, 0):
                raise ValueError(f"stored sums are by day, and {day} is no midnight")
        periods, sources, parts = Periods(snapshots), [], set()
        for part in ("orders", "support", "campaigns", "interventions"):
            rows = self._read(part)
            if rows is not None:
                parts.add(part)
                rows = rows.withColumn("_period", periods.period(DAY)).drop(DAY)
                sources.append(merged(rows, [PERSON, "_period"]))
        if "orders" not in parts:
            raise LookupError("the store holds no orders")
        moments = with_previous(self._read("moments").distinct(), PERSON, TIME)
        sources.append(features._per_period(moments, TIME, periods, **features.event_measures()))
        panel = features.panel_of(sources, parts, periods, churn_days)
        if splits is not None:
            panel = features.assign_splits(panel, splits)
        if geography is not None:
            panel = panel.join(geography, PERSON, "left")
        items, payments = (self._read(t) for t in ("items", "payments"))
        if items is not None:
            extra = features._item_features(items.withColumnRenamed(DAY, TIME), periods)
            panel = features.with_entries(panel, extra, periods)
        if payments is not None:
            extra = features._preferred_payment(payments.withColumnRenamed(DAY, TIME), periods, F.col("n"))
            panel = features.with_entries(panel, extra, periods)
        return panel
