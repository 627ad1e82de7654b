"""Hard-negative mining over Hilbert-ordered candidate blocks with zone maps.

Candidates are sorted along a Hilbert curve through all components and written as Parquet
blocks of up to 1,024 rows, each with the least and greatest value of every component (its
zone map) and its labels. An anchor looks for rows whose score (integer inner product) lies
in a window: any score and its own label for positives, a share of a positive's score and
another label for negatives. Interval arithmetic on a zone map bounds the scores that a
block can hold for an anchor; the anchor reads the block only if that interval meets one of
its windows above what it has found so far.

Each search first reads the anchor's own block, its neighbours on the curve, which gives a
first threshold, and then all blocks that the bounds cannot exclude, so results are exact
however little can be excluded. Anchors travel in groups, zone maps in packs; every group
meets every pack as an equi-join on a slot (a stated query set against all rows, in
blocks), and only requested (anchors, block) pairs meet rows. Tasks merge what they find by
group before sending it, and the last merge streams over the parts of one group, so nothing
grows with the number of copies of a vector or the rows of a label.

Rows with a null id, label or vector, or with a null or non-finite component take no part.
Rows alike in id, label and vector count once; rows that share an id are never each other's
partners. Vectors of different lengths meet over the components both have. Equal scores go
to the smaller id. An anchor with no other row of its label has no positives and yields
nothing; a window may hold fewer than asked for, then all it holds are returned. An empty
table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_arrow, stored
from holdfast.llm.vectors import integers, rows_of

#: rows of a block, anchors of a group (a block's anchors stay together), zone maps of a pack
BLOCK, GROUP, PACK = 1024, 512, 1024
#: digits per component on the curve
DIGITS = 4
#: groups per slot, and bytes of unmerged findings that a task holds
PER_SLOT, HELD = 64, 64 << 20
FAR = np.int64(1) << 62

ROWS = "vec_id bigint, label bigint, vector binary"
BLOCKS = "block bigint, ids array<bigint>, labels array<bigint>, vectors array<int>, lo array<int>, hi array<int>"
REQUESTS = "block bigint, grp bigint, anchors binary"
GROUPS = "grp bigint, state binary"


def hilbert_keys(cells: np.ndarray, digits: int = DIGITS) -> list[bytes]:
    """Position of each row of an n x d matrix of cells below ``2**digits`` on the Hilbert
    curve, as bytes that sort like it (Skilling's transposed form)."""
    x = cells.astype(np.uint32).T.copy()
    for digit in range(digits - 1, 0, -1):
        q = np.uint32(1 << digit)
        low = np.uint32(q - 1)
        for row in x:
            inside = (row & q) != 0
            swap = np.where(inside, np.uint32(0), (x[0] ^ row) & low)
            x[0] ^= np.where(inside, low, swap)
            row ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros(x.shape[1], np.uint32)
    for digit in range(digits - 1, 0, -1):
        turn ^= np.where(x[-1] >> np.uint32(digit) & 1, np.uint32((1 << digit) - 1), np.uint32(0))
    x ^= turn
    bits = np.concatenate([(x >> np.uint32(d) & 1).astype(np.uint8) for d in range(digits - 1, -1, -1)])
    return [k.tobytes() for k in np.packbits(bits, axis=0).T]


def cells_of(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, digits: int = DIGITS) -> np.ndarray:
    """Grid cells of integer components between ``lo`` and ``hi``."""
    return np.clip((values - lo << digits) // (hi - lo + 1), 0, (1 << digits) - 1)


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in kinds.items()}
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])


def _extent(rows: DataFrame, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer value of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            values = integers(rows_of(batch.column("embedding"))[1], scale)
            if len(values):
                more = max(0, values.shape[1] - len(lo))
                lo, hi = np.pad(lo, (0, more)), np.pad(hi, (0, more))
                n = values.shape[1]
                lo[:n], hi[:n] = np.minimum(lo[:n], values.min(axis=0)), np.maximum(hi[:n], values.max(axis=0))
        yield _batch("i int, lo bigint, hi bigint", [range(len(lo)), lo, hi])

    parts = map_arrow(rows.select("embedding"), run, "i int, lo bigint, hi bigint")
    found = parts.groupBy("i").agg(F.min("lo"), F.max("hi")).collect()
    ends = np.array(sorted(tuple(r) for r in found), np.int64).reshape(-1, 3)
    return ends[:, 1], ends[:, 2]


def _ordered(rows: DataFrame, scale: int) -> DataFrame:
    """Distinct rows with integer vectors, dealt and sorted along the curve."""
    lo, hi = _extent(rows, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = rows_of(batch.column("embedding"))
            values = np.pad(integers(found, scale), ((0, 0), (0, len(lo) - found.shape[1])))
            keys = hilbert_keys(cells_of(values, lo, hi)) if len(lo) else [b""] * len(values)
            taken = [batch.column(c).take(pa.array(at)) for c in ("vec_id", "label")]
            yield _batch(f"{ROWS}, place binary", [*taken, [v.tobytes() for v in values.astype("<i4")], keys])

    keyed = map_arrow(rows, run, f"{ROWS}, place binary").dropDuplicates(["vec_id", "label", "vector"])
    order = ["place", "vec_id", "label", "vector"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "label", "vector")


def blocked(rows: DataFrame, scale: int) -> DataFrame:
    """The written blocks: rows by ascending id, flat vectors and zone maps.

    A block's number is its task's number and its place there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def block(part: pa.Table) -> pa.RecordBatch:
            nonlocal number
            ids = part.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            vectors = np.stack([np.frombuffer(v, "<i4") for v in part.column("vector").to_pylist()])[order]
            labels = part.column("label").to_numpy()[order]
            number += 1
            ends = (vectors.min(axis=0), vectors.max(axis=0))
            return _batch(BLOCKS, [[number - 1], [ids[order]], [labels], [vectors.reshape(-1)], *[[e] for e in ends]])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            whole = table.num_rows // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                yield block(table.slice(at, BLOCK))
            held = table.slice(whole).to_batches()
        if held and (rest := pa.Table.from_batches(held)).num_rows:
            yield block(rest)

    return stored(map_arrow(_ordered(rows, scale), run, BLOCKS), "blocks")


class Anchors:
    """Anchors of one group and the best rows found for their windows so far.

    Each anchor has the same number of windows, given by least and greatest score; a window
    keeps ``k`` rows by falling score, then rising id, padded by score ``-FAR``.
    """

    def __init__(self, ids, labels, vectors, home, lo, hi, same: bool, k: int, kept=None):
        self.ids, self.labels, self.vectors, self.home = ids, labels, vectors, home
        self.lo, self.hi, self.same, self.k = lo, hi, same, k
        shape = (*lo.shape, k)
        #: positives that the windows of negatives come from, as (ids, scores)
        self.kept = kept
        self.best_ids, self.best = np.zeros(shape, np.int64), np.full(shape, -FAR)

    def floor(self) -> np.ndarray:
        """Least score that may still enter each window."""
        return np.maximum(self.lo, self.best[:, :, -1])

    def merge(self, at, window, ids, scores) -> None:
        """Take in rows found for window ``window`` of anchor ``at``."""
        a, w, k = self.best.shape
        old = np.repeat(np.arange(a * w), k)
        key = np.concatenate([old, at * w + window])
        ids = np.concatenate([self.best_ids.reshape(-1), ids])
        scores = np.concatenate([self.best.reshape(-1), scores])
        order = np.lexsort((ids, -scores, key))
        key = key[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        order = order[rank < k]
        self.best_ids, self.best = ids[order].reshape(a, w, k), scores[order].reshape(a, w, k)

    def request(self, chosen: np.ndarray) -> bytes:
        """What a block needs to know of the chosen anchors."""
        parts = (self.ids, self.labels, self.vectors, self.floor(), self.hi)
        return pickle.dumps((chosen, *[p[chosen] for p in parts], self.same, self.k))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products; in doubles as long as their sums are exact there."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def bounds(vectors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible score of each vector with any row between ``lo`` and ``hi``."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


def _groups(blocks: DataFrame, anchors_of: Callable[[np.ndarray], np.ndarray], k: int) -> DataFrame:
    """Anchors of neighbouring blocks, together, with one open window for their own label."""

    def pack(parts: list[tuple]) -> pa.RecordBatch:
        ids, labels, vectors, home = (np.concatenate(p) for p in zip(*parts, strict=True))
        lo = np.full((len(ids), 1), 1 - FAR)
        return _batch(GROUPS, [[int(home[0])], [pickle.dumps(Anchors(ids, labels, vectors, home, lo, -lo, True, k))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for block, ids, labels, vectors in _each(batches):
            chosen = anchors_of(ids)
            if chosen.any():
                held.append((ids[chosen], labels[chosen], vectors[chosen], np.full(int(chosen.sum()), block)))
            if sum(len(h[0]) for h in held) >= GROUP:
                yield pack(held)
                held = []
        if held:
            yield pack(held)

    columns = blocks.select("block", "ids", "labels", "vectors")
    return stored(map_arrow(columns, run, GROUPS), "anchors")


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, labels, flat = (batch.column(c)[i].values.to_numpy() for c in ("ids", "labels", "vectors"))
            yield batch.column("block")[i].as_py(), ids, labels, flat.reshape(len(ids), -1)


def _packs(blocks: DataFrame) -> DataFrame:
    """Zone maps and labels of up to ``PACK`` blocks as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                lo, hi, labels = (batch.column(c)[i].values.to_numpy() for c in ("lo", "hi", "labels"))
                held.append((batch.column("block")[i].as_py(), lo, hi, np.unique(labels)))
                if len(held) == PACK:
                    yield _batch("pack binary", [[pickle.dumps(held)]])
                    held = []
        if held:
            yield _batch("pack binary", [[pickle.dumps(held)]])

    return stored(map_arrow(blocks.select("block", "lo", "hi", "labels"), run, "pack binary"), "zones")


def _at_home(groups: DataFrame) -> DataFrame:
    """Requests of all anchors for the blocks they lie in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, state in zip(batch.column("grp").to_pylist(), batch.column("state"), strict=True):
                a = pickle.loads(state.as_py())
                blocks = np.unique(a.home)
                asked = [a.request(np.flatnonzero(a.home == b)) for b in blocks]
                yield _batch(REQUESTS, [blocks, [grp] * len(blocks), asked])

    return map_arrow(groups, run, REQUESTS)


def wanted(a: Anchors, pack: list[tuple]) -> np.ndarray:
    """Which anchors must read which blocks of a pack, beyond their own."""
    numbers = np.array([p[0] for p in pack])
    low, high = bounds(a.vectors, np.stack([p[1] for p in pack]), np.stack([p[2] for p in pack]))
    floor, hi = a.floor(), a.hi
    meets = np.zeros(low.shape, bool)
    for w in range(hi.shape[1]):
        meets |= (high >= floor[:, w, None]) & (low <= hi[:, w, None])
    values = np.unique(a.labels)
    for i, (_, _, _, labels) in enumerate(pack):
        # positives need their own label in the block, negatives any other
        fits = np.isin(values, labels) if a.same else (np.isin(values, labels, invert=True) | (len(labels) > 1))
        meets[:, i] &= fits[np.searchsorted(values, a.labels)]
    return meets & (a.home[:, None] != numbers)


def _chosen(groups: DataFrame, packs: DataFrame) -> DataFrame:
    """Requests of all anchors for the blocks that the bounds cannot exclude."""
    slots = max(1, -(-groups.count() // PER_SLOT))
    left = groups.withColumn("slot", F.pmod(F.xxhash64("grp"), F.lit(slots)))
    right = packs.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)).cast("array<bigint>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, state, zones in zip(*(batch.column(c).to_pylist() for c in ("grp", "state", "pack")), strict=True):
                a, pack = pickle.loads(state), pickle.loads(zones)
                meets = wanted(a, pack)
                for i in np.flatnonzero(meets.any(axis=0)):
                    yield _batch(REQUESTS, [[pack[i][0]], [grp], [a.request(np.flatnonzero(meets[:, i]))]])

    return map_arrow(left.join(right, "slot").select("grp", "state", "pack"), run, REQUESTS)


def hits(request: tuple, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> list[np.ndarray]:
    """Best rows of a block for each window: anchor, window, id, score. Rows come by rising id."""
    chosen, own, own_labels, own_vectors, floor, hi, same, k = request
    scores = products(own_vectors, vectors)
    fits = (own_labels[:, None] == labels) == same
    fits &= (own[:, None] != ids) & (scores >= floor.min(axis=1)[:, None]) & (scores <= hi.max(axis=1)[:, None])
    out: list[list] = [[], [], [], []]
    for i in np.flatnonzero(fits.any(axis=1)):
        at = np.flatnonzero(fits[i])
        order = at[np.argsort(-scores[i, at], kind="stable")]
        falling = -scores[i, order]
        first = np.searchsorted(falling, -hi[i], side="left")
        last = np.minimum(first + k, np.searchsorted(falling, -floor[i], side="right"))
        for w in np.flatnonzero(last > first):
            part = order[first[w] : last[w]]
            for column, values in zip(
                out, (np.full(len(part), chosen[i]), np.full(len(part), w), ids[part], scores[i, part]), strict=True
            ):
                column.append(values)
    return [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]


FOUND = "grp bigint, found binary"


def _read(requests: DataFrame, blocks: DataFrame) -> DataFrame:
    """What the requested blocks hold for the anchors, merged by group within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for grp, parts in held.items():
                columns = [np.concatenate(p) for p in zip(*(p for p, _, _ in parts), strict=True)]
                k, w = parts[0][1], parts[0][2]
                order = np.lexsort((columns[2], -columns[3], columns[0] * w + columns[1]))
                key = (columns[0] * w + columns[1])[order]
                order = order[np.arange(len(key)) - np.searchsorted(key, key) < k]
                yield _batch(FOUND, [[grp], [pickle.dumps([c[order] for c in columns])]])

        for batch in batches:
            asked = zip(batch.column("grp").to_pylist(), batch.column("anchors"), _each(batch_of(batch)), strict=True)
            for grp, request, (_, ids, labels, vectors) in asked:
                r = pickle.loads(request.as_py())
                found = hits(r, ids, labels, vectors)
                if len(found[0]):
                    held.setdefault(grp, []).append((found, r[-1], r[-3].shape[1]))
                    size += 4 * found[0].nbytes
                if size > HELD:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    def batch_of(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        return [batch]

    rows = requests.join(blocks.select("block", "ids", "labels", "vectors"), "block")
    return map_arrow(rows.select("grp", "anchors", "block", "ids", "labels", "vectors"), run, FOUND)


def _merged(groups: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Groups with what was found taken in, one part after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            for grp, own, more in zip(*(batch.column(c).to_pylist() for c in ("grp", "state", "found")), strict=True):
                if own is not None:  # the group itself comes before what was found for it
                    if state is not None:
                        yield _batch(GROUPS, [[at], [pickle.dumps(state)]])
                    at, state = grp, pickle.loads(own)
                else:
                    state.merge(*pickle.loads(more))
        if state is not None:
            yield _batch(GROUPS, [[at], [pickle.dumps(state)]])

    empty = F.lit(None).cast("binary")
    rows = groups.withColumn("found", empty).unionByName(found.withColumn("state", empty))
    dealt = rows.repartition("grp").sortWithinPartitions("grp", F.col("found").isNotNull())
    return stored(map_arrow(dealt.select("grp", "state", "found"), run, GROUPS), name)


def search(groups: DataFrame, blocks: DataFrame, packs: DataFrame, name: str) -> DataFrame:
    """Groups with the best rows of all blocks for their windows."""
    near = _merged(groups, _read(_at_home(groups), blocks), f"{name}-near")
    return _merged(near, _read(_chosen(near, packs), blocks), name)


def _windows(groups: DataFrame, low: int, high: int, k: int) -> DataFrame:
    """Turn found positives into windows of ``low`` to ``high`` per cent of their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, state in zip(batch.column("grp").to_pylist(), batch.column("state"), strict=True):
                p = pickle.loads(state.as_py())
                ids, scores = p.best_ids[:, 0], p.best[:, 0]
                there = scores > -FAR
                known = np.where(there, scores, 0)
                lo = np.where(there, -(-low * known // 100), FAR)
                hi = np.where(there, high * known // 100, -FAR)
                a = Anchors(p.ids, p.labels, p.vectors, p.home, lo, hi, False, k, (ids, scores))
                yield _batch(GROUPS, [[grp], [pickle.dumps(a)]])

    return stored(map_arrow(groups, run, GROUPS), "windows")


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _results(groups: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for state in batch.column("state"):
                a = pickle.loads(state.as_py())
                i, w, rank = np.nonzero(a.best > -FAR)
                ids, scores = a.kept
                yield _batch(
                    RESULT, [a.ids[i], ids[i, w], rank + 1, a.best_ids[i, w, rank], scores[i, w], a.best[i, w, rank]]
                )

    return map_arrow(groups, run, RESULT)


def mine(
    vectors: DataFrame,
    label: Column | None = None,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """Negatives of ``vectors`` (``vec_id, embedding, label``) for the anchors and their positives.

    Anchors are the rows whose id is divisible by ``every``. ``label`` replaces the column
    of that name.
    """
    label = F.col("label") if label is None else label
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    blocks = blocked(rows, scale)
    packs = _packs(blocks)
    groups = _groups(blocks, lambda ids: ids % every == 0, positives)
    found = search(groups, blocks, packs, "positives")
    return _results(search(_windows(found, low, high, negatives), blocks, packs, "negatives"))


def negatives_query(vectors: DataFrame) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, shifted)


#: the same by comparing every anchor with every row
ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda y: floor(256 * y::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y::DOUBLE))) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 100 * s.score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""
