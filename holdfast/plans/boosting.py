"""Boosted trees with penalised leaves, stopped by average precision.

Inputs are cut into bins once (up to ``BINS`` quantile bins of a number, one bin per value
of a category) and stored in blocks of rows, input by input in as few bytes as the bins need.
Executors keep the blocks, a share for each core, in memory or on disk while trees grow;
what is lost is read again from the written table.
A level of a tree takes one pass over the blocks: each task sums gradients and hessians of
its rows by node, input and bin, the sums are added up, by Spark first where there are many
tasks, and the driver picks the best split of each node from them. What reaches the driver is
bounded by the model (nodes x inputs x bins), not by the rows. Gradients are whole numbers of 2**-24, so the sums and hence
the trees do not depend on the order of rows or tasks, and of two sibling nodes only the
lighter one is summed: the other has what is left of their parent.

The first pass of a round also counts the validation rows by class and score, which gives
the average precision of the rounds so far; boosting ends when ``patience`` rounds brought
no gain. Margins are stored with the rows every ``STORED`` rounds; in between the few newest
trees are applied on the fly. No round is ever fitted twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.columns import apart
from holdfast.session import settle, ship

BINS, STORED = 256, 25
#: sums of more tasks than that are added up by Spark before they reach the driver
MANY = 64
#: numbers whose bin edges are looked for in one pass
TOGETHER = 16
#: gradients count in whole units of 1 / UNIT, scores are told apart in STEPS steps
UNIT, STEPS = 1 << 24, 1 << 16
#: least gain of a split
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Input:
    """One binned input: a number with its bin edges, or a category with so many values.

    A category's last bin holds rows with none of its values.
    """

    name: str
    edges: tuple[float, ...] = ()
    values: int = 0

    @property
    def bins(self) -> int:
        return (self.values or len(self.edges)) + 1


@dataclass(frozen=True)
class Settings:
    rounds: int = 1000
    patience: int = 30
    depth: int = 3
    step: float = 0.03
    rows: float = 0.8
    columns: float = 0.8
    l1: float = 0.5
    l2: float = 2.0
    child_weight: float = 10.0
    seed: int = 42


@dataclass
class Tree:
    """A full binary tree: per level the input, bin and kind of each node's split.

    Rows go left at a bin up to ``bin`` (a number) or at ``bin`` itself (a category). A node
    that is not split has input -1 and sends all rows left.
    """

    inputs: list[list[int]] = field(default_factory=list)
    bins: list[list[int]] = field(default_factory=list)
    single: list[list[bool]] = field(default_factory=list)
    leaves: list[float] = field(default_factory=list)

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """Node of each row below the levels that are there; codes has a column per input."""
        at = np.zeros(len(codes), np.uint8 if len(self.inputs) < 9 else np.int64)
        for inputs, bins, single in zip(self.inputs, self.bins, self.single, strict=True):
            right = np.zeros(len(codes), bool)
            for node, (i, b, s) in enumerate(zip(inputs, bins, single, strict=True)):
                if i >= 0:
                    own = codes[:, i]
                    right |= (at == node) & (own != b if s else own > b)
            at = 2 * at + right
        return at

    def margins(self, codes: np.ndarray) -> np.ndarray:
        return np.array(self.leaves)[self.nodes(codes)]


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def _worth(g, h, s: Settings):
    return _shrunk(g, s.l1) ** 2 / (h + s.l2)


def leaf(g: float, h: float, s: Settings) -> float:
    """Step of a leaf with gradient sum ``g`` and hessian sum ``h``."""
    return float(-s.step * _shrunk(np.float64(g), s.l1) / (h + s.l2))


def best_split(sums: dict[int, np.ndarray], inputs: Sequence[Input], allowed: dict[int, np.ndarray], s: Settings):
    """Best split of one node: gain, input, bin, single and the sums of both sides.

    ``sums`` has per input a (2, bins) array of gradient and hessian sums; ``allowed`` masks
    the splits of this tree's share of the inputs. Equal gains go to the first input and bin.
    """
    best = None
    for i, gh in sums.items():
        total = gh.sum(axis=1)
        single = bool(inputs[i].values)
        left = gh[:, : inputs[i].values] if single else np.cumsum(gh, axis=1)[:, :-1]
        right = total[:, None] - left
        ok = allowed[i] & (left[1] >= s.child_weight) & (right[1] >= s.child_weight)
        if not ok.any():
            continue
        gain = (_worth(*left, s) + _worth(*right, s) - _worth(*total, s)) / 2
        gain = np.where(ok, gain, -np.inf)
        b = int(gain.argmax())
        if gain[b] > LEAST_GAIN and (best is None or gain[b] > best[0]):
            best = (float(gain[b]), i, b, single, left[:, b], right[:, b])
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def sampled(keys: np.ndarray, seed: int, number: int, share: float) -> np.ndarray:
    """The same share of the rows at each run, another one for each tree."""
    turn = _mixed(np.array([seed << 32 | number], np.uint64))
    return (_mixed(keys.view(np.uint64) ^ turn) >> np.uint64(11)).astype(np.float64) < share * 2.0**53


#: what is known of each row of a block besides its codes
ROW = {"key": np.int64, "label": np.int8, "weight": np.float64, "margin": np.float64}
BLOCK = "training boolean, codes binary, " + ", ".join(f"{c} binary" for c in ROW)


def _narrow(inputs: Sequence[Input]) -> np.dtype:
    """The smallest whole number that holds a bin of any input."""
    return np.min_scalar_type(max([i.bins for i in inputs], default=1) - 1)


def _blocks(rows: Iterable[tuple], shape: tuple[int, np.dtype]) -> Iterator[dict]:
    """Blocks with arrays for bytes, ``codes`` with a column per input.

    ``shape`` is the number of inputs and the kind of their codes.
    """
    wide, kind = shape
    for training, codes, *values in rows:
        block = {c: np.frombuffer(v, k) for (c, k), v in zip(ROW.items(), values, strict=True)}
        yield block | {"training": training, "codes": np.frombuffer(codes, kind).reshape(wide, -1).T}


def _raised(margin: np.ndarray, codes: np.ndarray, newest: Sequence[Tree]) -> np.ndarray:
    """Margins that take in the newest trees."""
    for t in newest:
        margin = margin + t.margins(codes)
    return margin


def _kept(rows: DataFrame) -> RDD:
    """Blocks of a written table, dealt evenly and kept by the executors until they are unpersisted."""
    ship(rows.sparkSession)
    shares = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    return shares.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)


def _batch(blocks: Sequence[dict]) -> pa.RecordBatch:
    """Blocks of arrays as rows of a table."""
    arrays = [pa.array([b["training"] for b in blocks], pa.bool_())]
    arrays.append(pa.array([np.ascontiguousarray(b["codes"].T).tobytes() for b in blocks], pa.binary()))
    arrays += [pa.array([b[c].astype(kind).tobytes() for b in blocks], pa.binary()) for c, kind in ROW.items()]
    return pa.RecordBatch.from_arrays(arrays, ["training", "codes", *ROW])


def _scan(
    rows: RDD, inputs: Sequence[Input], newest: Sequence[Tree], tree: Tree, number: int, reach: float, s: Settings,
    nodes: Sequence[int], live: Sequence[int],
) -> tuple[dict[int, dict[int, np.ndarray]], np.ndarray | None]:
    """Sums by node, input and bin for the next level of ``tree``; validation rows by score step and class.

    Of ``nodes`` and ``live`` inputs only. Scores are only counted on the first level.
    ``reach`` bounds the margins.
    """
    widths = [inputs[i].bins for i in live]
    offsets = len(nodes) * np.cumsum([0, *widths])
    size, count, shape = int(offsets[-1]), not tree.inputs, (len(inputs), _narrow(inputs))
    # rows of other nodes fall behind the last place
    place = np.full(1 << len(tree.inputs), len(nodes), np.int64)
    place[list(nodes)] = np.arange(len(nodes))

    def run(blocks: Iterator[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        sums = np.zeros((2, size))
        seen = np.zeros(2 * (STEPS + 1) if count else 0, np.int64)
        wanted = blocks if count else (b for b in blocks if b[0])
        for block in _blocks(wanted, shape):
            codes, label, margin = block["codes"], block["label"], block["margin"]
            if not block["training"]:
                margin = _raised(margin, codes, newest)
                step = np.floor((margin / (2 * reach) + 0.5) * STEPS).astype(np.int64) if reach else np.zeros(len(label), np.int64)
                seen += np.bincount(2 * np.clip(step, 0, STEPS) + label, minlength=len(seen))
                continue
            at = place[tree.nodes(codes)]
            chosen = np.flatnonzero(sampled(block["key"], s.seed, number, s.rows) & (at < len(nodes)))
            # the newest trees are only applied to rows that count
            codes = codes.T[:, chosen].T
            at, label, weight = at[chosen], label[chosen], block["weight"][chosen]
            margin = _raised(margin[chosen], codes, newest)
            p = 1 / (1 + np.exp(-margin))
            g, h = np.rint(weight * (p - label) * UNIT), np.rint(weight * p * (1 - p) * UNIT)
            ahead = {width: at * width for width in set(widths)}
            for i, width, start in zip(live, widths, offsets):
                bin_of = ahead[width] + codes[:, i]
                here = slice(start, start + len(nodes) * width)
                sums[0, here] += np.bincount(bin_of, g, len(nodes) * width)
                sums[1, here] += np.bincount(bin_of, h, len(nodes) * width)
        used = np.flatnonzero(seen)
        yield sums.astype(np.int64), used, seen[used]

    many = rows.getNumPartitions() > MANY
    whole, used, times = rows.mapPartitions(run).treeReduce(_added, 2 if many else 1)
    sums = whole / UNIT
    by_node = {
        n: {i: sums[:, start + j * width : start + (j + 1) * width] for i, width, start in zip(live, widths, offsets)}
        for j, n in enumerate(nodes)
    }
    if not count:
        return by_node, None
    seen = np.zeros(2 * (STEPS + 1), np.int64)
    seen[used] = times
    return by_node, seen.reshape(-1, 2)


def _added(a: tuple, b: tuple) -> tuple:
    """Two tasks' sums and counts of scores as one task's."""
    used, at = np.unique(np.concatenate([a[1], b[1]]), return_inverse=True)
    times = np.bincount(at, np.concatenate([a[2], b[2]]), len(used)).astype(np.int64)
    return a[0] + b[0], used, times


def average_precision(seen: np.ndarray) -> float:
    """Of class 1, from counts by rising score and class; 0 without such rows."""
    falling = np.cumsum(seen[::-1], axis=0)
    hits = np.diff(falling[:, 1], prepend=0)
    every = falling.sum(axis=1)
    return float((hits * falling[:, 1] / np.maximum(every, 1)).sum() / max(falling[-1, 1], 1))


def _masks(inputs: Sequence[Input], number: int, s: Settings) -> dict[int, np.ndarray]:
    """Splits that tree ``number`` may use: its share of numbers and of category values."""
    rng = np.random.default_rng([s.seed, number])
    single = [i.values or 1 for i in inputs]
    n = sum(single)
    chosen = np.zeros(n, bool)
    chosen[rng.permutation(n)[: max(1, int(s.columns * n))]] = True
    out, at = {}, 0
    for j, (i, k) in enumerate(zip(inputs, single, strict=True)):
        mask = chosen[at : at + k]
        out[j] = mask if i.values else np.full(i.bins - 1, mask[0])
        at += k
    return out


def grow(rows: RDD, inputs: Sequence[Input], newest, number: int, reach: float, s: Settings):
    """One more tree, and the validation counts of the rounds before it."""
    tree, masks = Tree(), _masks(inputs, number, s)
    # an input without a split that this tree may use need not be summed
    live = [i for i in range(len(inputs)) if masks[i].any()] or [0]
    sums, seen = _scan(rows, inputs, newest, tree, number, reach, s, [0], live)
    ends: list[tuple[float, float]] = []
    for level in range(s.depth):
        picked, ends = [], []
        for n in range(1 << level):
            total = sums[n][live[0]].sum(axis=1)
            split = best_split(sums[n], inputs, masks, s)
            picked.append(split)
            ends += [tuple(x) for x in split[4:]] if split else [tuple(total), (0.0, 0.0)]
        tree.inputs.append([p[1] if p else -1 for p in picked])
        tree.bins.append([p[2] if p else 0 for p in picked])
        tree.single.append([p[3] if p else False for p in picked])
        if not any(picked):
            break
        if level + 1 < s.depth:
            # of two children the lighter one; a node without split hands all it has to the left
            light = {n: 2 * n + int(p[5][1] < p[4][1]) for n, p in enumerate(picked) if p}
            found, _ = _scan(rows, inputs, newest, tree, number, reach, s, sorted(light.values()), live)
            below = {}
            for n, parent in sums.items():
                own = found[light[n]] if n in light else {i: np.zeros_like(x) for i, x in parent.items()}
                child = light.get(n, 2 * n + 1)
                below |= {child: own, child ^ 1: {i: x - own[i] for i, x in parent.items()}}
            sums = below
    tree.leaves = [leaf(g, h, s) for g, h in ends]
    return tree, seen


def _moved(rows: DataFrame, inputs: Sequence[Input], newest: Sequence[Tree]) -> DataFrame:
    """Blocks with the newest trees added to their margins, written anew."""

    shape = len(inputs), _narrow(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(zip(*(c.to_pylist() for c in batch.columns)), shape):
                yield _batch([block | {"margin": _raised(block["margin"], block["codes"], newest)}])

    return settle(rows.mapInArrow(run, rows.schema))


def boost(rows: DataFrame, inputs: Sequence[Input], s: Settings) -> tuple[list[Tree], list[float]]:
    """Trees up to the best round and the validation's average precision after each round.

    ``rows`` is a written table of blocks, see ``binned``.
    """
    trees: list[Tree] = []
    scores: list[float] = []
    stored, reach, blocks = 0, 0.0, _kept(rows)
    try:
        while True:
            tree, seen = grow(blocks, inputs, trees[stored:], len(trees), reach, s)
            if trees:
                scores.append(average_precision(seen))
            best = int(np.argmax(scores)) + 1 if scores else 0
            if len(trees) >= s.rounds or (scores and len(trees) - best >= s.patience):
                return trees[:best], scores
            trees.append(tree)
            reach += max(map(abs, tree.leaves))
            if not reach:  # nothing to split from the start
                return [], scores
            if len(trees) - stored >= STORED:
                rows, stored = _moved(rows, inputs, trees[stored:]), len(trees)
                blocks.unpersist()
                blocks = _kept(rows)
    finally:
        blocks.unpersist()


def edges_of(train: DataFrame, numbers: dict[str, str]) -> dict[str, tuple[float, ...]]:
    """Bin edges of numbers given as SQL, from mergeable quantile sketches: values of the data."""
    if not numbers:
        return {}
    shares, out = [i / BINS for i in range(1, BINS)], {}
    for at in range(0, len(numbers), TOGETHER):
        names = [*numbers][at : at + TOGETHER]
        # values are made ahead of the sketches, which would else interpret the SQL row by row
        values = train.select(*[F.expr(numbers[n]).alias(f"x{i}") for i, n in enumerate(names)])
        found = values.agg(
            *[F.percentile_approx(c, shares, 20 * BINS).alias(f"q{c}") for c in values.columns],
            *[F.max(c).alias(f"m{c}") for c in values.columns],
        ).first()
        # an edge at the greatest value would split nothing off
        for n, c in zip(names, values.columns, strict=True):
            out[n] = tuple(sorted({v for v in found[f"q{c}"] or () if v < found[f"m{c}"]}))
    return out


def binned(
    rows: DataFrame, inputs: Sequence[Input], numbers: dict[str, str], codes: dict[str, Column], key: Column, label: str,
    weight: Column, training: Column,
) -> DataFrame:
    """The written table that ``boost`` reads, a row per block of rows of training or of
    validation; category codes come as columns, numbers as SQL."""
    # the first one takes the projection out of whole-stage code, see ``apart``
    texts = [numbers[i.name] for i in inputs if not i.values] + ["0D"]
    texts[0] = apart(texts[0])
    raw = rows.select(
        key.alias("key"), F.col(label).cast("int").alias("label"), weight.cast("double").alias("weight"),
        training.alias("training"), F.lit(0.0).alias("margin"),
        F.array(*[F.expr(e) for e in texts]).alias("numbers"),
        F.array(*[codes[i.name] for i in inputs if i.values], F.lit(0)).cast("array<int>").alias("categories"),
    )
    plain = [n for n, i in enumerate(inputs) if not i.values]
    listed = [n for n, i in enumerate(inputs) if i.values]
    kind = _narrow(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, len(inputs)), np.int32)
            values = batch.column("numbers").values.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for at, n in enumerate(plain):
                out[:, n] = np.searchsorted(np.array(inputs[n].edges), values[:, at], side="left")
            values = batch.column("categories").values.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for at, n in enumerate(listed):
                out[:, n] = values[:, at]
            whole = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("training", *ROW)}
            blocks = [
                {"training": part, "codes": out[take].astype(kind), **{c: whole[c][take] for c in ROW}}
                for part in (True, False)
                if (take := whole["training"] == part).any()
            ]
            if blocks:
                yield _batch(blocks)

    ship(rows.sparkSession)
    return settle(raw.mapInArrow(run, BLOCK))


def used(trees: Sequence[Tree]) -> set[tuple[int, int]]:
    """Inputs and bins that the trees split at."""
    levels = [level for t in trees for level in zip(t.inputs, t.bins, strict=True)]
    return {(i, b) for inputs, bins in levels for i, b in zip(inputs, bins, strict=True) if i >= 0}


def as_sql(trees: Sequence[Tree], inputs: Sequence[Input], column: dict[str, str], test: dict[tuple[str, int], str]) -> str:
    """The probability as one SQL expression.

    ``column`` has the SQL of each used number, ``test`` the SQL condition of each used
    category and bin.
    """

    def node(t: Tree, level: int, at: int) -> str:
        if level == len(t.inputs):
            return f"{t.leaves[at]!r}D"
        i = t.inputs[level][at]
        left = node(t, level + 1, 2 * at)
        if i < 0:
            return left
        own, b = inputs[i], t.bins[level][at]
        if own.values:
            condition = test[own.name, b]
        else:
            condition = f"{column[own.name]} <= {own.edges[b]!r}D"
        return f"CASE WHEN {condition} THEN {left} ELSE {node(t, level + 1, 2 * at + 1)} END"

    margins = ", ".join(node(t, 0, 0) for t in trees) or "0D"
    return f"1D / (1D + exp(-aggregate(array({margins}), 0D, (a, b) -> a + b)))"
