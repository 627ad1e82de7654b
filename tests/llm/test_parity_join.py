import random

import numpy as np
import pytest

from holdfast.llm import parity_join
from holdfast.llm.components import components
from tests.llm import brute


def near_copies(rng, n, words, edits):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n\t ", "one", "One", "one two", "two one", "a b c", "A B C", "a b c d"]
    texts += near_copies(rng, 60, 40, 3) + near_copies(rng, 40, 160, 12) + near_copies(rng, 25, 900, 30)
    for k in range(30):  # cut-off copies at the edge of the threshold
        w = [f"v{i}" for i in range(100 + k)]
        texts.append(" ".join(w))
    shared = " ".join(f"p{i}" for i in range(60))  # a passage in many different texts
    texts += [shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 25))) for _ in range(60)]
    texts += [" ".join(f"r{rng.randrange(10**6)}" for _ in range(n)) for n in (5, 50, 500, 4000)]
    texts += rng.choices(texts, k=30)  # exact copies
    ids = rng.sample(range(10_000), len(texts))
    return [(i, t, "s") for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize("words,per_cent", [(3, 90), (5, 80)])
def test_components_match_comparing_all_pairs(docs, words, per_cent):
    rows = corpus(words)
    got = {
        r["doc_id"]: (r["n_shingles"], r["component_id"])
        for r in parity_join.near_duplicates(docs(rows), words, per_cent).collect()
    }
    assert got == brute.components(rows, words, per_cent)


def test_large_groups_take_several_tiles(docs, monkeypatch):
    monkeypatch.setattr(parity_join, "TILE", 8)
    monkeypatch.setattr(parity_join, "TILE_SHINGLES", 3000)
    rows = corpus(11)
    got = {r["doc_id"]: r["component_id"] for r in parity_join.near_duplicates(docs(rows), 3, 90).collect()}
    assert got == {d: c for d, (_, c) in brute.components(rows, 3, 90).items()}


def test_dense_groups_make_no_pair_rows(spark):
    """Members just below the threshold, each a component of its own: every pair is allowed
    by the sketches, none links, and nothing is written; joined ones write links of a forest."""
    rng = np.random.default_rng(6)
    bands = parity_join.Bands(90)
    base = rng.integers(0, 2**62, 180)
    alike = [np.sort(np.concatenate([base, rng.integers(0, 2**62, 12)])) for _ in range(120)]
    copies = [np.sort(np.concatenate([base[3:], rng.integers(0, 2**62, 3)])) for _ in range(60)]

    def members(sets):
        level = bands.level(len(sets[0]))
        rows = [
            (1, v, len(s), v, s.tolist(), level, parity_join.sketch(s.view(np.uint64), bands.blocks(level)).view(np.int64).tolist(), len(sets), sum(map(len, sets)))
            for v, s in enumerate(sets)
        ]
        schema = "g bigint, v bigint, n bigint, c bigint, shingles array<bigint>, level int, blocks array<bigint>, members bigint, shingled bigint"
        return spark.createDataFrame(rows, schema)

    assert parity_join.foreign_links(members(alike), 90).count() == 0
    links = parity_join.foreign_links(members(copies), 90)
    assert 0 < links.count() <= len(copies) - 1
    assert {r["c"] for r in components(links).collect()} == {0}


def test_very_long_texts(docs):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long, "s"), (2, long + " end", "s"), (3, long[: len(long) // 2], "s"), (4, "short one here", "s")]
    got = {r["doc_id"]: r["component_id"] for r in parity_join.near_duplicates(docs(rows), 5, 80).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_keep_one_keeps_the_smallest_id_and_empty_texts(docs):
    rows = corpus(5)
    want = {d for d, (n, c) in brute.components(rows, 5, 80).items() if not n or c == d}
    kept = parity_join.keep_one(docs(rows).withColumnRenamed("lang", "component"))
    assert kept.columns[2] == "component"
    assert {r["doc_id"] for r in kept.collect()} == want


def test_rows_without_id_and_repeated_rows(docs):
    rows = [(None, "a b c d e", "s"), (4, "a b c d e", "s"), (4, "a b c d e", "s"), (None, "z", None), (None, None, None)]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in parity_join.join_query(docs(rows)).collect()]
    key = lambda r: [(x is None, x or 0) for x in r]
    assert sorted(got, key=key) == sorted(
        [(None, 3, 4), (4, 3, 4), (4, 3, 4), (None, 1, None), (None, 0, None)], key=key
    )
    assert parity_join.keep_one(docs(rows)).count() == 4


def test_empty_table(docs):
    assert parity_join.join_query(docs([])).count() == 0
    assert parity_join.keep_one(docs([])).count() == 0


def test_sketches_bound_the_symmetric_difference():
    rng = np.random.default_rng(2)
    for n in (1, 5, 40, 3000):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[n // 8 :], rng.integers(0, 2**63, n // 9).astype(np.uint64)])
        for blocks in (1, 7, 64):
            bits = np.bitwise_count(parity_join.sketch(a, blocks) ^ parity_join.sketch(b, blocks)).sum()
            assert bits <= parity_join.FLIPS * len(np.setxor1d(a, b))


def test_linked_sizes_share_a_band():
    for per_cent in (80, 90, 95):
        bands = parity_join.Bands(per_cent)
        for n in range(1, 3000):
            low = bands.levels(n)
            for m in {n, n + 1, n * 100 // per_cent}:
                if 100 * n >= per_cent * m:
                    assert set(low) & set(bands.levels(m)), (n, m)
                    level = max(set(low) & set(bands.levels(m)))
                    for size in (n, m):
                        assert bands.blocks(level) >= bands.emitted(level, size) > bands.differing(n + m)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (2, 1)], "a bigint, b bigint")
    got = {r["v"]: r["c"] for r in components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(50)}}
