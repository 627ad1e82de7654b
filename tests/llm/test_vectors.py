import hashlib
import math

import numpy as np
import pytest

from holdfast.llm import bitplane_kmeans, hilbert_negatives

VECTORS = "vec_id bigint, embedding array<float>, label int"


def made(spark, rows, schema=VECTORS):
    return spark.createDataFrame(rows, schema)


def drawn(n, seed=5, dims=64):
    """Rows with repeated vectors, some of them in a tight group."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims)) / 8
    base[::5] = base[0]
    base[1::7] = base[1] + rng.normal(size=base[1::7].shape) / 100
    return [(i, [float(x) for x in np.float32(v)], int(rng.integers(0, 4))) for i, v in enumerate(base)]


ODD = [
    (9001, None, 1),
    (9002, [0.1] * 63, 1),
    (9003, [0.1] * 63 + [None], 1),
    (9004, [0.1] * 63 + [float("nan")], 1),
    (9005, [0.1] * 63 + [float("inf")], 1),
]


def kmeans(rows, k=16, rounds=3):
    kept = [
        (i, [math.floor(64 * x) for x in v])
        for i, v, _ in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[0], r[1]))[:k]
    centres = [list(v) for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if mine:
                centres[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    last = [(i, *near(v)) for i, v in kept]
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        (i, j, d, sum(x for _, x, y in last if y == j), sum(x for _, x, _ in last), name[j]) for i, d, j in last
    )


def test_planes_hold_the_integers():
    rng = np.random.default_rng(1)
    for low, high in ((-1, 1), (0, 1), (-64, 64), (-1000, 7), (-(2**26), 2**26)):
        a, b = rng.integers(low, high, (9, 64)), rng.integers(low, high, (4, 64))
        p, q = bitplane_kmeans.planes_of(a), bitplane_kmeans.planes_of(b)
        assert (bitplane_kmeans.values_of(p) == a).all()
        assert (bitplane_kmeans.dots(p, q) == a @ b.T).all()
        assert (bitplane_kmeans.norms(p) == (a * a).sum(axis=1)).all()
        far = ((a[:, None] - b) ** 2).sum(axis=2)
        chosen, least = bitplane_kmeans.nearest(p, q)
        assert (chosen == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()


def test_kmeans_equals_plain_rounds(spark):
    rows = drawn(120) + ODD + [(3, [9.5] * 64, 0), (3, [9.5] * 64, 0)]
    df = made(spark, [(*r, 7) for r in rows], VECTORS + ", cluster int").repartition(3)
    got = bitplane_kmeans.kmeans_query(df)
    assert sorted(map(tuple, got.collect())) == kmeans(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_kmeans_of_few_vectors(spark, n):
    rows = drawn(9)[:n]
    assert sorted(map(tuple, bitplane_kmeans.kmeans_query(made(spark, rows + ODD)).collect())) == kmeans(rows)


def test_kmeans_without_ids_and_with_large_components(spark):
    rows = [(None, [float(i)] * 64, None) for i in range(3)] + [(1, [-5000.0] * 64, 0)]
    got = bitplane_kmeans.kmeans_query(made(spark, rows)).collect()
    assert len(got) == 4 and sum(r["vec_id"] is None for r in got) == 3 and {r["inertia"] for r in got} == {0}
    with pytest.raises(Exception, match="BIGINT"):
        bitplane_kmeans.kmeans_query(made(spark, [(1, [1e9] * 64, 0)])).collect()


def mined(rows, every=100, positives=5, negatives=10):
    known = sorted(
        {
            (i, lab, tuple(math.floor(256 * x) for x in v))
            for i, v, lab in rows
            if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)
        }
    )
    out = []
    for i, lab, v in known:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, m) for j, m, w in known if j != i)
        own = [(-s, j) for s, j, m in scored if m == lab][:positives]
        for ps, p in own:
            fit = [(-s, j) for s, j, m in scored if m != lab and 30 * ps <= -100 * s <= 90 * ps]
            out += [(i, p, rank + 1, j, ps, s) for rank, (s, j) in enumerate(fit[:negatives])]
    return sorted(out)


def test_negatives_equal_plain_search(spark, monkeypatch):
    monkeypatch.setattr(hilbert_negatives, "BLOCK", 16)
    monkeypatch.setattr(hilbert_negatives, "GROUP", 8)
    monkeypatch.setattr(hilbert_negatives, "PACK", 3)
    monkeypatch.setattr(hilbert_negatives, "PER_SLOT", 2)
    rows = drawn(300) + ODD + [(None, [0.1] * 64, 1), (17, [0.1] * 64, None), (40, [0.2] * 3, 2), (41, [], 3)]
    rows += rows[:20] + [(10, [0.125] * 64, 2), (50, [0.125] * 64, 2)]
    df = made(spark, [(*r, 7) for r in rows], VECTORS + ", block int").repartition(3)
    for every in (10, 1):
        got = hilbert_negatives.mine(df, every=every)
        assert sorted(map(tuple, got.collect())) == mined(rows, every)


def test_negatives_shift_labels_of_every_seventh_row(spark):
    rows = [(i, v, lab) for i, v, lab in drawn(220)]
    shifted = [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows]
    got = hilbert_negatives.negatives_query(made(spark, rows))
    assert sorted(map(tuple, got.collect())) == mined(shifted)


@pytest.mark.parametrize("rows", [[], ODD, [(0, [1.0, 2.0], 1)], [(0, [1.0], 1), (1, [1.0], 2)], [(0, [], 1), (1, [], 1), (2, [], 2)]])
def test_negatives_of_few_rows(spark, rows):
    got = hilbert_negatives.negatives_query(made(spark, rows))
    assert sorted(map(tuple, got.collect())) == mined([(i, v, 2 if i == 0 else lab) for i, v, lab in rows])


def test_hilbert_places_are_one_walk_through_the_grid():
    for dims, digits in ((2, 3), (3, 2), (5, 1)):
        side = 1 << digits
        cells = np.array(np.meshgrid(*[range(side)] * dims)).reshape(dims, -1).T
        keys = hilbert_negatives.hilbert_keys(cells, digits)
        walk = cells[np.argsort(np.array(keys, dtype=object))]
        assert len(set(keys)) == len(cells)
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_exclude():
    rng = np.random.default_rng(2)
    box, asked = rng.integers(-50, 50, (30, 8)), rng.integers(-50, 50, (6, 8))
    low, high = hilbert_negatives.bounds(asked, box.min(axis=0)[None], box.max(axis=0)[None])
    scores = asked @ box.T
    assert (low[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= high[:, 0]).all()
    one = hilbert_negatives.bounds(asked, box[:1], box[:1])
    assert (one[0] == one[1]).all() and (one[0][:, 0] == scores[:, 0]).all()


def test_clustered_rows_are_read_in_part_only(spark, monkeypatch):
    """Two far groups of one label each: no block of the other group can hold a positive."""
    monkeypatch.setattr(hilbert_negatives, "BLOCK", 32)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in (1 if i % 2 else -1) + rng.normal(size=8) / 50], i % 3) for i in range(600)]
    seen = []
    chosen = hilbert_negatives._chosen

    def counted(groups, packs):
        out = chosen(groups, packs)
        seen.append(out.count())
        return out

    monkeypatch.setattr(hilbert_negatives, "_chosen", counted)
    got = hilbert_negatives.mine(made(spark, rows), every=50)
    assert sorted(map(tuple, got.collect())) == mined(rows, 50)
    groups_times_blocks = 2 * 20
    assert seen[0] < groups_times_blocks
