import random
from datetime import datetime, timedelta

import pytest

from holdfast.operators.modes import mode_by, modes_by
from holdfast.operators.neighbours import with_previous


@pytest.mark.parametrize("parts", ["1", "4", "60"])
def test_previous_row_of_keys_over_several_parts(spark, parts):
    rng = random.Random(3)
    start = datetime(2020, 1, 1)
    rows = []
    for i in range(300):
        who = "big" if i % 3 == 0 else f"c{rng.randrange(20)}"
        rows.append((who, start + timedelta(minutes=rng.randrange(60 * 40)), i))
    df = spark.createDataFrame(rows, "who STRING, at TIMESTAMP_NTZ, id INT").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = with_previous(df, "who", "at", ["id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(rows)
    by_id = {r["id"]: r["previous"] for r in got}
    ordered = {}
    for who, at, i in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        before = ordered.get(who)
        found = by_id[i]
        assert (found and (found["at"], found["id"])) == before
        ordered[who] = (at, i)


def test_rows_without_key_are_nobodys_and_a_burst_stays_in_order(spark):
    day = datetime(2020, 5, 1)
    rows = [(None, day, i) for i in range(5)] + [("a", day, i) for i in range(200)] + [("a", None, 900)]
    df = spark.createDataFrame(rows, "who STRING, at TIMESTAMP_NTZ, id INT").repartition(6)
    got = {r["id"]: r["previous"] for r in with_previous(df, "who", "at", ["id"]).collect()}
    assert {i: p and p["id"] for i, p in got.items()} == {i: i - 1 if i else None for i in range(200)}


def test_mode_ties_and_nulls(spark):
    rows = [(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None), (2, "z"), (3, None)]
    df = spark.createDataFrame(rows, "k INT, v STRING")
    got = {r["k"]: r["m"] for r in mode_by(df, ["k"], "v", "m").collect()}
    assert got == {1: "a", 2: "z", 3: None}


def test_modes_are_per_column(spark):
    rows = [(1, "x", "p"), (1, "x", "q"), (1, "y", "q")]
    df = spark.createDataFrame(rows, "k INT, s STRING, c STRING")
    row = modes_by(df, ["k"], ["s", "c"]).first()
    # the pair (x, q) is the mode of each column on its own
    assert (row["s"], row["c"]) == ("x", "q")
