"""Quality classifier: a byte-level convolutional network in numpy.

Each text is cut into overlapping chunks that cover all of its bytes. Learned filters over
byte embeddings slide over every chunk byte by byte, their strongest response per chunk is kept
(max pooling), and a small dense layer combines the largest and the mean response over all
chunks, and the length (a short text fires few filters), into one probability. Work per text
is linear in its bytes, memory is bounded by a block of chunks, however long a text is.

Null texts count as empty; an empty text is one chunk of padding and gets a score too.
Rows with equal texts get equal scores; no other column is an input, and the other columns
of the input pass through untouched (``score`` and ``predicted`` are replaced). Empty
documents give an empty result; without labels the score is one half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import fitted, held_out, labelled_sample, map_arrow, text_of, utf8

CHUNK = 512
OVERLAP = 64
WIDTH = 8
DEPTH = 8
PADDING = np.int16(256)
FILTERS = 48
HIDDEN = 24
#: chunks per block: bounds the memory of a task
BLOCK = 16
#: labelled texts of each class that training sees at the most
PER_CLASS = 4000
EPOCHS = 6
#: a small sample is gone through more often, up to this many steps
LEAST_STEPS = 900


@dataclass
class Network:
    embedding: np.ndarray  # 256 bytes and the padding symbol
    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray  # pooled responses and length, to the units that combine them
    shift: np.ndarray
    weights: np.ndarray
    offset: float


def chunks(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text of each chunk; chunks overlap and cover every byte."""
    sizes = np.diff(offsets)
    step = CHUNK - OVERLAP
    count = 1 + np.maximum(0, -(-(sizes - CHUNK) // step))
    text = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = nth * step
    return offsets[text] + start, np.minimum(CHUNK, sizes[text] - start), text


def symbols_of(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Bytes of some chunks, one chunk a row; what a chunk lacks is padding."""
    at = np.arange(CHUNK)
    inside = at < length[:, None]
    if not len(raw):
        return np.full(inside.shape, PADDING)
    # PADDING has a wider type than a byte, so the symbols have it too
    return np.where(inside, raw[np.minimum(start[:, None] + at, len(raw) - 1)], PADDING)


def responses(net: Network, symbols: np.ndarray) -> np.ndarray:
    """Response of each filter at each byte position of each chunk: filter, chunk, position."""
    flat = net.embedding[symbols].reshape(len(symbols), CHUNK * DEPTH)
    view = np.lib.stride_tricks.sliding_window_view(flat, WIDTH * DEPTH, axis=1)[:, ::DEPTH]
    # positions lie side by side, so that the pooling reads memory in order
    return (net.filters.T @ view.reshape(-1, WIDTH * DEPTH).T).reshape(FILTERS, len(symbols), -1)


def pooled(net: Network, symbols: np.ndarray) -> np.ndarray:
    """Strongest response of each filter in each chunk."""
    return np.maximum(responses(net, symbols).max(axis=2).T + net.bias, 0)


def winners(net: Network, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strongest response of each filter in each chunk, and the bytes it answers to."""
    h = responses(net, symbols)
    best = h.argmax(axis=2)
    top = np.take_along_axis(h, best[:, :, None], axis=2)[:, :, 0]
    seen = np.take_along_axis(symbols[:, None], best.T[:, :, None] + np.arange(WIDTH), axis=2)
    return np.maximum(top.T + net.bias, 0), seen


def features(net: Network, offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Largest and mean chunk response of each text, and its extent."""
    start, length, text = chunks(offsets)
    tops = np.empty((len(start), FILTERS), np.float32)
    for at in range(0, len(start), BLOCK):
        part = slice(at, at + BLOCK)
        tops[part] = pooled(net, symbols_of(raw, start[part], length[part]))
    first = np.flatnonzero(np.diff(text, prepend=-1))
    count = np.diff(np.append(first, len(text)))
    return np.hstack(
        [np.maximum.reduceat(tops, first), np.add.reduceat(tops, first) / count[:, None], extent(offsets)]
    )


def extent(offsets: np.ndarray) -> np.ndarray:
    """Length of each text on two bounded scales."""
    size = np.diff(offsets)[:, None]
    return np.hstack([np.minimum(np.log1p(size) / 6, 1.0), np.minimum(size / CHUNK, 1.0)]).astype(np.float32)


def probability(net: Network, offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if len(offsets) < 2:
        return np.zeros(0)
    units = np.maximum(features(net, offsets, raw) @ net.hidden + net.shift, 0)
    z = units.astype(np.float64) @ net.weights + net.offset
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(sample: list[tuple[str, int]], seed: int = 7, epochs: int = EPOCHS) -> Network:
    """Train on whole texts by Adam. Classes weigh alike. Without examples of both classes
    the network answers with the share of ones (one half without any example)."""
    rng = np.random.default_rng(seed)
    shapes = {
        "e": rng.normal(0, 0.5, (257, DEPTH)),
        "w": rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)),
        "b": np.zeros(FILTERS),
        "u": rng.normal(0, (2 * FILTERS) ** -0.5, (2 * FILTERS + 2, HIDDEN)),
        "a": np.zeros(HIDDEN),
        "v": rng.normal(0, 0.2, HIDDEN),
        "c": np.zeros(1),
    }
    p = {k: v.astype(np.float32) for k, v in shapes.items()}
    ys = np.array([y for _, y in sample], np.float32)
    if len(set(ys.tolist())) < 2:
        share = float(ys.mean()) if len(ys) else 0.5
        odds = np.clip(share, 0.01, 0.99)
        return Network(p["e"], p["w"], p["b"], p["u"], p["a"], np.zeros(HIDDEN), float(np.log(odds / (1 - odds))))
    weight = np.where(ys == 1, 0.5 / ys.mean(), 0.5 / (1 - ys.mean())).astype(np.float32)
    data = [t.encode() for t, _ in sample]
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    per = 16
    epochs = max(epochs, -(-LEAST_STEPS * per // len(data)))
    for epoch in range(epochs):
        rate = 0.004 * (1 - epoch / epochs) + 0.0003
        order = rng.permutation(len(data))
        for at in range(0, len(order), per):
            pick = order[at : at + per]
            offsets = np.concatenate([[0], np.cumsum([len(data[i]) for i in pick])])
            raw = np.frombuffer(b"".join(data[i] for i in pick), np.uint8)
            grads = _gradients(p, offsets, raw, ys[pick], weight[pick])
            step += 1
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-7)
    return Network(p["e"], p["w"], p["b"], p["u"], p["a"], p["v"].astype(np.float64), float(p["c"][0]))


def _gradients(p: dict, offsets: np.ndarray, raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Gradients of the weighted log loss; only the window that won the pooling gets one."""
    net = Network(p["e"], p["w"], p["b"], p["u"], p["a"], p["v"], 0.0)
    start, length, text = chunks(offsets)
    tops = np.empty((len(start), FILTERS), np.float32)
    won = np.empty((len(start), FILTERS, WIDTH), np.int16)
    for at in range(0, len(start), BLOCK):
        part = slice(at, at + BLOCK)
        tops[part], won[part] = winners(net, symbols_of(raw, start[part], length[part]))
    first = np.flatnonzero(np.diff(text, prepend=-1))
    count = np.diff(np.append(first, len(text))).astype(np.float32)
    high = np.maximum.reduceat(tops, first)
    mean = np.add.reduceat(tops, first) / count[:, None]
    f = np.hstack([high, mean, extent(offsets)])
    units = np.maximum(f @ p["u"] + p["a"], 0)
    z = units @ p["v"] + p["c"][0]
    d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / len(y)
    g = {"v": d @ units + 1e-4 * p["v"], "c": np.array([d.sum()], np.float32)}
    du = np.where(units > 0, np.outer(d, p["v"]), 0)
    g["u"], g["a"] = f.T @ du + 1e-4 * p["u"], du.sum(axis=0)
    df = du @ p["u"].T
    down = df[text, FILTERS : 2 * FILTERS] / count[text][:, None]
    down = down + np.where(tops >= high[text], df[text, :FILTERS], 0)
    down = np.where(tops > 0, down, 0).astype(np.float32)
    x = p["e"][won].reshape(len(start), FILTERS, WIDTH * DEPTH)
    g["w"] = np.einsum("cf,cfk->kf", down, x)
    g["b"] = down.sum(axis=0)
    dx = (down[:, :, None] * p["w"].T[None]).reshape(-1, DEPTH)
    symbol = won.reshape(-1)
    g["e"] = np.stack(
        [np.bincount(symbol, dx[:, k], minlength=257) for k in range(DEPTH)], axis=1
    ).astype(np.float32)
    return g


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Network:
    """Fit on at most ``per_class`` labelled texts of each class that are not held out."""
    return fitted(labelled_sample(docs, labels, label, per_class), fit)


def score(docs: DataFrame, net: Network, threshold: float = 0.7) -> DataFrame:
    """All columns of ``docs`` plus ``score`` and ``predicted``; one narrow pass, no shuffle."""
    docs = docs.drop("score", "predicted")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = probability(shared.value, *utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    return map_arrow(docs, run, schema)


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    net = train(docs, labels)
    slim = docs.select("doc_id", held_out().alias("held_out"), text_of("text").alias("text"))
    return score(slim, net).select("doc_id", "held_out", "score", "predicted")
