"""The incremental feature store and near-identical orders."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from holdfast.plans import audit, features, store
from tests.test_features import CAMPAIGNS, ITEMS, ORDERS, TICKETS, TOUCHES

SNAPS = [datetime(2017, 7, 1), datetime(2017, 10, 1)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)

    def when():
        # midnights and repeated moments are frequent
        day = datetime(2016, 6, 1) + timedelta(days=rng.randrange(700))
        return day + timedelta(hours=rng.choice([0, 0, 9, 23]))

    who = ["hot"] * 200 + [f"p{i % 40}" for i in range(300)]
    orders = [
        (str(i), None if i % 97 == 5 else w, None if i % 89 == 7 else when(), rng.choice(["delivered", "canceled"]), rng.randrange(40),
         rng.randrange(-9, 9), rng.randrange(100, 9000), rng.randrange(100, 9000), float(rng.randrange(1, 9)),
         rng.choice(["card", "boleto", None]), rng.choice([None, 1.0, 4.0, 5.0]))
        for i, w in enumerate(who)
    ]
    items = [(o[0], o[1], o[2], rng.choice(["toys", "garden", None]), f"s{rng.randrange(5)}", rng.randrange(9000)) for o in orders * 2]
    tickets = [(w, when(), rng.choice([True, False, None]), False, 2.5, rng.choice([1, 5, None])) for w in who]
    touches = [(w, when(), True, rng.choice([True, False]), False) for w in who]
    return {
        "order_summary": spark.createDataFrame(orders, ORDERS),
        "item_summary": spark.createDataFrame(items, ITEMS),
        "tickets": spark.createDataFrame(tickets, TICKETS),
        "campaigns": spark.createDataFrame(touches, CAMPAIGNS),
        "interventions": spark.createDataFrame([(w, when()) for w in who], TOUCHES),
    }


def values(panel):
    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    return {(r["customer_unique_id"], r["snapshot_date"]): {k: plain(v) for k, v in r.asDict().items()} for r in panel.collect()}


def parts(tables, n):
    """The tables in ``n`` batches that cut days and persons apart."""
    at = {"order_summary": "order_id", "item_summary": "order_id"}
    for i in range(n):
        yield {k: t.where(F.crc32(F.col(at[k])) % n == i) if k in at else t.where(F.crc32(F.col(t.columns[1]).cast("string")) % n == i)
               for k, t in tables.items()}


def test_batches_in_any_order_equal_the_full_rebuild(spark, tables, tmp_path):
    want = values(features.snapshot_features(SNAPS, tables["order_summary"], tables["item_summary"], None,
                                             *(tables[t] for t in ("tickets", "campaigns", "interventions"))))
    kept = store.FeatureStore(spark, str(tmp_path / "s"))
    for i, batch in enumerate(parts(tables, 3)):
        kept.add(f"b{i}", **batch)
    assert values(kept.features(SNAPS)) == want and len(want) > 60
    kept.compact("all")
    again = store.FeatureStore(spark, str(tmp_path / "s"))
    assert list(again.batches()) == ["all"] and values(again.features(SNAPS)) == want
    # one more snapshot later on
    more = [*SNAPS, datetime(2017, 12, 1)]
    full = features.snapshot_features(more, tables["order_summary"], payment_method=False)
    some = again.features(more).select(*full.columns)
    assert values(some) == values(full)


def test_a_late_order_changes_the_gaps_around_it(spark, tables, tmp_path):
    kept = store.FeatureStore(spark, str(tmp_path / "s"))
    row = tables["order_summary"].where("order_id = '1'").first().asDict()

    def orders(*days):
        rows = [tuple({**row, "order_id": d, "customer_unique_id": "p", "order_purchase_timestamp": datetime.fromisoformat(d)}.values()) for d in days]
        return spark.createDataFrame(rows, ORDERS)

    kept.add("a", orders("2017-01-01 08:00:00", "2017-03-02 08:00:00"))
    assert kept.features(SNAPS[:1]).first()["purchase_gap_mean"] == 60
    kept.add("late", orders("2017-01-31 08:00:00", "2017-01-01 08:00:00"))
    r = kept.features(SNAPS[:1]).first()
    assert r["purchase_gap_mean"] == 30 and r["lifetime_orders"] == 3


def test_unfinished_batches_do_not_count_and_names_are_used_once(spark, tables, tmp_path):
    kept = store.FeatureStore(spark, str(tmp_path / "s"))
    with pytest.raises(LookupError):
        kept.features(SNAPS)
    # a table of a batch whose log entry was never written
    kept.add("x", tables["order_summary"])
    spark.read.parquet(str(tmp_path / "s" / "orders" / "x")).write.parquet(str(tmp_path / "s" / "orders" / "lost"))
    once = values(kept.features(SNAPS))
    kept.add("lost", tables["order_summary"].where("order_id = 'none'"))
    assert values(kept.features(SNAPS)) == once
    with pytest.raises(ValueError, match="already"):
        kept.add("x", tables["order_summary"])
    with pytest.raises(ValueError, match="midnight"):
        kept.features([datetime(2017, 7, 1, 12)])


def by_comparison(rows, seconds, cents):
    out = 0
    for i, (_, who, at, much) in enumerate(rows):
        for _, other, then, amount in rows[:i]:
            if None not in (who, at, much, amount, then) and who == other:
                out += abs((at - then).total_seconds()) <= seconds and abs(much - amount) <= cents
    return out


def test_near_identical_orders_equal_all_comparisons(spark):
    rng = random.Random(9)
    start = datetime(1969, 12, 31, 23)
    rows = [
        (i, rng.choice(["hot", "hot", "a", "b", None]), start + timedelta(seconds=rng.randrange(9000)), rng.choice([None, rng.randrange(-300, 900)]))
        for i in range(400)
    ] + [(1000 + i, "copies", start, 5) for i in range(300)]
    schema = "order_id bigint, customer_unique_id string, order_purchase_timestamp timestamp_ntz, order_total_cents bigint"
    df = spark.createDataFrame(rows, schema)
    for seconds, cents in ((60, 50), (3600, 1), (1, 1000)):
        found = audit.near_identical_orders(df, seconds, cents).collect()
        assert sum(r["n_pairs"] for r in found) == by_comparison(rows, seconds, cents)
        keys = [(r["first_order_id"], r["second_order_id"]) for r in found]
        assert len(keys) == len(set(keys))
    # three hundred copies are one row
    assert [r["n_pairs"] for r in found if r["customer_unique_id"] == "copies"] == [300 * 299 // 2]
    assert audit.near_identical_orders(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        audit.near_identical_orders(df, 0, 1)
