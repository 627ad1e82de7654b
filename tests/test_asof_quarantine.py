import random
import subprocess
import sys
import textwrap
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from holdfast.operators.neighbours import as_of
from holdfast.plans import quality, quarantine
from holdfast.session import fresh_path, fresh_table, release
from holdfast.sources import tables

START = datetime(2020, 1, 1)


def sides(n=260, seed=3):
    rng = random.Random(seed)

    def who(i):
        return None if i % 17 == 0 else "hot" if i % 3 == 0 else f"c{rng.randrange(25)}"

    def at(i):
        return None if i % 23 == 0 else START + timedelta(hours=rng.randrange(150))

    left = [(i, who(i), at(i)) for i in range(n)]
    right = [(who(i), at(i), rng.randrange(4)) for i in range(n)]
    return left, right


def plain(left, right, forward, equal):
    out = {}
    for i, k, t in left:
        best = None
        for rk, rt, v in right:
            if None in (k, t, rk, rt) or rk != k:
                continue
            if (rt == t and equal) or (rt > t if forward else rt < t):
                if best is None or ((rt, v) < best if forward else (rt, v) > best):
                    best = (rt, v)
        out[i] = best
    return out


@pytest.mark.parametrize("parts", ["1", "4", "90"])
@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("equal", [True, False])
def test_as_of_equals_looking_at_all_rows(spark, parts, direction, equal):
    left, right = sides()
    a = spark.createDataFrame(left, "id INT, who STRING, at TIMESTAMP_NTZ").repartition(3)
    b = spark.createDataFrame(right, "who STRING, since TIMESTAMP_NTZ, v INT").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = as_of(a, b, "who", "at", "since", ["v"], direction=direction, equal=equal).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = {r["id"]: None if r["match"] is None else (r["match"]["since"], r["match"]["v"]) for r in rows}
    assert len(rows) == len(left) and got == plain(left, right, direction == "forward", equal)


def test_as_of_with_an_empty_side(spark):
    left, right = sides(12)
    a = spark.createDataFrame(left, "id INT, who STRING, at TIMESTAMP_NTZ")
    b = spark.createDataFrame(right, "who STRING, since TIMESTAMP_NTZ, v INT")
    assert as_of(a.limit(0), b, "who", "at", "since", ["v"]).count() == 0
    assert [r["match"] for r in as_of(a, b.limit(0), "who", "at", "since", ["v"]).collect()] == [None] * 12
    with pytest.raises(ValueError, match="nearest"):
        as_of(a, b, "who", "at", "since", ["v"], direction="nearest")


def raw(spark):
    """Orders with a hot repeated key and rows without one, items with and without parents."""
    day = timedelta(days=1)
    orders = [(1, "a", START, START + day)] * 40 + [(2, "b", START, START - day), (3, "c", START + 900 * day, None)]
    orders += [(4, "d", START, START + 60 * day), (None, "e", START, None), (None, "f", START, None), (5, "g", None, START)]
    schema = "order_id INT, customer_id STRING, order_purchase_timestamp TIMESTAMP_NTZ, order_delivered_customer_date TIMESTAMP_NTZ"
    items = [(1, 1, 5.0, 1.0)] * 3 + [(9, 1, -1.0, 0.0), (None, 1, 2.0, -3.0), (2, 1, None, None)]
    pays = [(1, -5.0), (7, 2.0), (2, None)]
    reviews = [(1, 5), (1, 9), (8, 0), (2, None)]
    people = [("a", "p"), ("a", "q"), ("b", "p"), ("c", "r"), ("d", "s"), ("e", "s"), ("f", "t"), ("g", "u")]
    frame = spark.createDataFrame
    return {
        "orders": frame(orders, schema).repartition(3),
        "items": frame(items, "order_id INT, order_item_id INT, price DOUBLE, freight_value DOUBLE"),
        "payments": frame(pays, "order_id INT, payment_value DOUBLE"),
        "reviews": frame(reviews, "order_id INT, review_score INT"),
        "customers": frame(people, "customer_id STRING, customer_unique_id STRING"),
        "products": frame([(1, "x"), (1, "y"), (2, None)], "product_id INT, product_category_name STRING"),
        "sellers": frame([(1,), (None,)], "seller_id INT"),
        "translation": frame([("x", "X")], "product_category_name STRING, product_category_name_english STRING"),
    }


def test_quarantine_keeps_all_rows_and_counts_like_the_checks(spark):
    t = raw(spark)
    as_of_day = datetime(2021, 1, 1)
    counted = {r["name"]: r["violation_count"] for r in quality.run_checks(t, as_of_day).collect()}
    for name in ("orders", "items", "payments", "reviews", "products", "sellers"):
        judged = quarantine.judge(t, name, as_of_day)
        own = {r["name"]: r["violation_count"] for r in quarantine.counts(judged).collect()}
        checks = quarantine._judged(t, name, as_of_day)[1]
        assert own == {c: counted[c] for c in checks if counted[c]}, name
        passing, held = quarantine.quarantine(t, name, as_of_day)
        assert passing.columns == t[name].columns
        both = passing.unionByName(held.drop(quarantine.REASONS))
        assert sorted(map(str, both.collect())) == sorted(map(str, t[name].collect()))
    broken = quarantine.judge(t, "customers").where(F.size(quarantine.REASONS) > 0).collect()
    assert sorted(r["customer_unique_id"] for r in broken) == ["p", "q"]
    with pytest.raises(ValueError, match="translation"):
        quarantine.judge(t, "translation")


def test_quarantine_of_one_original_per_key(spark):
    t = raw(spark)
    passing, held = quarantine.quarantine(t, "orders", datetime(2021, 1, 1))
    assert passing.where("order_id = 1").count() == 1 and held.where("order_id = 1").count() == 39
    late = quarantine.judge(t, "orders", datetime(2021, 1, 1)).where("order_id = 4").first()
    # a warning is a reason, but does not hold a row back
    assert late[quarantine.REASONS] == ["late_delivery_outliers"] and passing.where("order_id = 4").count() == 1


def test_bucketed_tables_join_without_a_shuffle(spark):
    left = spark.range(2000).select((F.col("id") % 97).alias("who"), "id")
    right = spark.range(300).select((F.col("id") % 97).alias("who"), (F.col("id") * 2).alias("v"))
    names = [fresh_table(spark, n) for n in ("a", "b")]
    a, b = (
        tables.save_bucketed(df, n, fresh_path(spark, n), "who", 6)
        for df, n in zip((left, right), names, strict=True)
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.groupBy("who").agg(F.sum("id").alias("s")).join(b.groupBy("who").agg(F.sum("v").alias("t")), "who")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        want = left.groupBy("who").agg(F.sum("id").alias("s")).join(right.groupBy("who").agg(F.sum("v").alias("t")), "who")
        assert sorted(joined.collect()) == sorted(want.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    release(spark)
    assert not any(t.name in names for t in spark.catalog.listTables())


def test_damaged_records_are_told_apart(spark, tmp_path):
    head = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    (tmp_path / "one.csv").write_text(
        head + "o1,1,p,s,2018-01-01 00:00:00,1.5,0.5\no2,x,p,s,2018-01-01 00:00:00,1.5,0.5\no3,1,p\no4,1,p,s,,2.0,0.1\n"
    )
    (tmp_path / "two.csv").write_text(head + 'o5,1,"p,q",s,2018-01-01 00:00:00,abc,0.5\n')
    good, bad = tables.read_csv_split(spark, str(tmp_path), "order_items")
    assert sorted(r["order_id"] for r in good.collect()) == ["o1", "o4"]
    counted = {r["file"].rsplit("/", 1)[1]: r["n_damaged"] for r in tables.damage_counts(bad).collect()}
    assert counted == {"one.csv": 2, "two.csv": 1}
    assert any("o5" in r["record"] for r in bad.collect())


def test_written_tables_go_when_python_ends_after_stop(tmp_path):
    code = f"""
        from holdfast.session import session, settle
        spark = session("ending", spark__master="local[1]", spark__ui__enabled="false",
                        spark__checkpoint__dir={str(tmp_path)!r})
        assert settle(spark.range(3)).count() == 3
        import os
        assert any(f.startswith("settled-") for f in os.listdir({str(tmp_path)!r}))
        spark.stop()
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, cwd=".", timeout=200, capture_output=True)
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("settled-")]
