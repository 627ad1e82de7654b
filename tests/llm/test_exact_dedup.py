import random

import pytest
from pyspark.sql import functions as F

from holdfast.llm import exact_dedup
from tests.llm import brute

ROWS = [
    (5, "a b", "s"),
    (3, "ab", "s"),
    (4, "a\tb", "t"),
    (9, None, "s"),
    (8, "", None),
    (7, " \n", "s"),
    (1, "A b", "s"),
    (2, "x" * 50_000, "s"),
    (6, "x " * 50_000, "s"),
    (10, "nb sp", "s"),
    (11, "nbsp", "s"),
]


def result(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()}


def test_matches_brute_force(docs):
    assert result(exact_dedup.decide(docs(ROWS))) == brute.exact(ROWS)


def test_longest_then_smallest_id(docs):
    got = result(exact_dedup.decide(docs(ROWS)))
    assert got[3][0] == 4 and got[5][0] == 4  # three code points each, the smallest id
    assert got[9][0] == 7 and got[7][1] == 3  # empty, null and blank texts are one group


def test_colliding_hashes_are_told_apart_by_their_bytes(docs):
    rng = random.Random(1)
    rows = [(i, rng.choice("abcdef") * rng.randint(1, 3), "s") for i in range(200)]
    weak = lambda form: F.unhex(F.substring(F.md5(form), 1, 1).substr(1, 1))
    assert result(exact_dedup.decide(docs(rows), weak)) == brute.exact(rows)
    kept = {r["doc_id"] for r in exact_dedup.keep(docs(rows), weak).collect()}
    assert kept == {d for d, x in brute.exact(rows).items() if x[2]}


def test_keep_returns_one_whole_row_of_each_group(docs):
    df = docs(ROWS + [(4, "a\tb", "t")]).withColumn("_hash", F.lit(1)).withColumn("kept", F.lit("mine"))
    kept = exact_dedup.keep(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d for d, x in brute.exact(ROWS).items() if x[2])
    assert all(r["kept"] == "mine" for r in rows)


def test_null_ids_and_repeated_rows(docs):
    rows = [(None, "q", "s"), (2, "q", "s"), (2, "q", "s"), (None, "zz", None)]
    got = sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in exact_dedup.decide(docs(rows)).collect())
    assert got == [(0, 0, 1, True), (0, 2, 3, False), (2, 2, 3, True), (2, 2, 3, True)]
    assert exact_dedup.keep(docs(rows)).count() == 2


@pytest.mark.parametrize("f", [exact_dedup.decide, exact_dedup.keep])
def test_empty_table(docs, f):
    assert f(docs([])).count() == 0


def test_plan_has_no_python(docs):
    plan = exact_dedup.decide(docs(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
