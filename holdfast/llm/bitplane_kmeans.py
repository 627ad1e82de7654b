"""Centroid clustering on bit planes: exact integer k-means by popcounts.

Each vector of 64 integer components becomes one 64-bit word per binary digit, in two's
complement: bit c of word i is digit i of component c. The inner product of two vectors is
the sum over all pairs of words of popcount(a AND b) times the weights of the two digits,
so dot products, norms and squared distances are exact and need no multiplication of
components. A vector takes as many words as its batch needs; the last word holds the signs
and may be repeated, so batches of different widths compare.

The planes are written once; each round reads them in place, and every task sends one row
of counts and sums per centroid. The driver holds the centroids alone, so neither a hot
cluster nor one vector with a third of all rows meets anywhere.

Vectors that are null, have another number of components or a null or non-finite one take
no part. Rows without id are clustered, but start no centroid while others can. Repeated
rows are vectors of their own, equal distances go to the smaller centroid, equal start
hashes are ordered by id and planes. With fewer vectors than centroids there are as many
centroids as vectors; an empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_arrow, stored
from holdfast.llm.vectors import integers, rows_of

DIMS = 64
#: vectors whose distances are held at once
BLOCK = 8192


@dataclass(frozen=True)
class Clusters:
    """Final centroids (k x 64), the rows of each and the squared distances summed over them."""

    centroids: np.ndarray
    sizes: list[int]
    inertias: list[int]


def planes_of(values: np.ndarray) -> np.ndarray:
    """Digits of an n x 64 integer matrix as n x digits words, least digit first, signs last."""
    top = max(int(values.max(initial=0)), int(~values.min(initial=0)))
    digits = top.bit_length() + 1
    bits = [np.packbits((values >> i & 1).astype(np.uint8), axis=1, bitorder="little") for i in range(digits)]
    return np.stack([b.view("<u8")[:, 0] for b in bits], axis=1) if len(values) else np.zeros((0, digits), np.uint64)


def weights_of(digits: int) -> np.ndarray:
    """What each word counts for: powers of two, the signs negative."""
    weights = np.left_shift(np.int64(1), np.arange(digits, dtype=np.int64))
    weights[-1] = -weights[-1]
    return weights


def values_of(planes: np.ndarray) -> np.ndarray:
    """The integer matrix again."""
    out = np.zeros((len(planes), DIMS), np.int64)
    for word, weight in zip(planes.T, weights_of(planes.shape[1]), strict=True):
        bits = np.unpackbits(np.ascontiguousarray(word).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += bits * weight
    return out


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of all vectors of ``left`` with all of ``right``, by popcounts."""
    out = np.zeros((len(left), len(right)), np.int64)
    for a, x in zip(left.T, weights_of(left.shape[1]), strict=True):
        for b, y in zip(right.T, weights_of(right.shape[1]), strict=True):
            out += np.bitwise_count(a[:, None] & b) * (x * y)
    return out


def norms(planes: np.ndarray) -> np.ndarray:
    """Inner product of each vector with itself."""
    weights = weights_of(planes.shape[1])
    out = np.zeros(len(planes), np.int64)
    for i, x in enumerate(weights):
        for j, y in enumerate(weights):
            out += np.bitwise_count(planes[:, i] & planes[:, j]) * (x * y)
    return out


def nearest(planes: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid; the smaller number at ties."""
    far = norms(planes)[:, None] + norms(centres) - 2 * dots(planes, centres)
    chosen = far.argmin(axis=1)
    return chosen, far[np.arange(len(far)), chosen]


def _matrix(column: pa.Array) -> np.ndarray:
    """Words of a batch; a vector with fewer than the widest repeats its signs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    words = column.values.to_numpy().view(np.uint64)
    lengths = np.diff(offsets)
    at = np.minimum(np.arange(int(lengths.max(initial=1))), lengths[:, None] - 1)
    return words[offsets[:-1, None] + at]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, _matrix(part.column("planes"))


def packed(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """``vec_id, planes`` of the rows that are vectors, components times ``scale`` rounded down."""
    kind = dict(vectors.dtypes)["vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = rows_of(batch.column("embedding"), DIMS)
            words = planes_of(integers(found, scale))
            ends = np.arange(len(rows) + 1, dtype=np.int32) * words.shape[1]
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(words.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), listed], ["vec_id", "planes"])

    return map_arrow(vectors.select("vec_id", "embedding"), run, f"vec_id {kind}, planes array<bigint>")


def start(planes: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of seed and id, in the order of the hashes."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    order = [key.asc_nulls_last(), F.col("vec_id"), F.col("planes")]
    first = planes.orderBy(*order).limit(k).select("planes").collect()
    rows = [values_of(np.array([r["planes"]], np.int64).view(np.uint64)) for r in first]
    return np.concatenate(rows) if rows else np.zeros((0, DIMS), np.int64)


def _sums(planes: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """By centroid: its vectors, their summed distance and their summed components."""
    k, centres = len(centroids), planes_of(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, spread, sums = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, DIMS), np.int64)
        for _, words in _blocks(batches):
            chosen, far = nearest(words, centres)
            values = values_of(words)
            np.add.at(sizes, chosen, 1)
            np.add.at(spread, chosen, far)
            for c in np.unique(chosen):
                sums[c] += values[chosen == c].sum(axis=0)
        used = np.flatnonzero(sizes)
        columns = [pa.array(used.astype(np.int32)), pa.array(sizes[used]), pa.array(spread[used])]
        names = ["cluster", "n", "spread", *[f"s{i}" for i in range(DIMS)]]
        yield pa.RecordBatch.from_arrays([*columns, *[pa.array(sums[used, i]) for i in range(DIMS)]], names)

    kinds = ", ".join(f"s{i} bigint" for i in range(DIMS))
    parts = map_arrow(planes, run, f"cluster int, n bigint, spread bigint, {kinds}")
    whole = parts.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in parts.columns[1:]])
    return {r["cluster"]: (r["n"], r["spread"], [r[f"s{i}"] for i in range(DIMS)]) for r in whole.collect()}


def fit(planes: DataFrame, centroids: np.ndarray, rounds: int) -> Clusters:
    """``rounds`` rounds of assigning and of replacing centroids by the rounded-down means."""
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.copy()
        for c, (n, _, total) in _sums(planes, centroids).items():
            moved[c] = [s // n for s in total]
        centroids = moved
    last = _sums(planes, centroids) if len(centroids) else {}
    none = (0, 0, [])
    return Clusters(centroids, *[[last.get(c, none)[i] for c in range(len(centroids))] for i in (0, 1)])


def assign(planes: DataFrame, clusters: Clusters) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each vector."""
    kind = dict(planes.dtypes)["vec_id"]
    centres, spread, total = planes_of(clusters.centroids), np.array(clusters.inertias, np.int64), sum(clusters.inertias)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in clusters.centroids.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words in _blocks(batches):
            chosen, far = nearest(words, centres)
            columns = [
                part.column("vec_id"),
                pa.array(chosen.astype(np.int32)),
                pa.array(far),
                pa.array(spread[chosen]),
                pa.array(np.full(len(far), total)),
                pa.array(names, pa.string()).take(pa.array(chosen)),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
            )

    schema = f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return map_arrow(planes, run, schema)


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, seed: int = 1
) -> tuple[DataFrame, Clusters]:
    """The assignment of ``assign`` and the clusters of the vectors of ``vectors``."""
    planes = stored(packed(vectors, scale), "planes")
    found = fit(planes, start(planes, k, seed), rounds)
    return assign(planes, found), found


def kmeans_query(vectors: DataFrame) -> DataFrame:
    return cluster(vectors)[0]


_ROUND = """
a{n} AS (
  SELECT v.vec_id, v.x, arg_min(c.cluster, (list_dot_product(v.x, v.x) + list_dot_product(c.x, c.x)
           - 2 * list_dot_product(v.x, c.x), c.cluster)) AS cluster
  FROM v, c{n} c GROUP BY v.vec_id, v.x),
m{n} AS (
  SELECT cluster, i, floor(sum(x[i]) / count(*)) AS m FROM a{n}, range(1, 65) r(i) GROUP BY cluster, i),
c{next} AS (
  SELECT c.cluster, coalesce(m.x, c.x) AS x
  FROM c{n} c LEFT JOIN (SELECT cluster, list(m ORDER BY i) AS x FROM m{n} GROUP BY cluster) m USING (cluster))"""

#: the same rounds with plain arithmetic on the components
ORACLE = (
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda y: floor(64 * y::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y::DOUBLE))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, x
  FROM v ORDER BY sha256('1:' || vec_id) LIMIT 16),"""
    + ",".join(_ROUND.format(n=n, next=n + 1) for n in range(3))
    + """,
d AS (
  SELECT v.vec_id, c.cluster, c.x, list_dot_product(v.x, v.x) + list_dot_product(c.x, c.x)
           - 2 * list_dot_product(v.x, c.x) AS far
  FROM v, c3 c
  QUALIFY row_number() OVER (PARTITION BY v.vec_id ORDER BY far, c.cluster) = 1)
SELECT vec_id, cluster::INT AS cluster, far::BIGINT AS distance,
       (sum(far) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(far) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(x, lambda y: y::BIGINT), ',')) AS centroid_sha256
FROM d
"""
)
