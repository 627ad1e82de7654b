"""Shared helpers of the text operators: shipping, Arrow buffers, word patterns."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.session import fresh_path, ship

#: white space as all contracts of this subpackage mean it
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with the package shipped first."""
    ship(df.sparkSession)
    # a batch of very long texts must not grow with the number of its rows
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """A text column, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the quarter of the documents that no model may learn labels from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, from 0) and bytes of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if large else np.int32
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return ends - ends[0], raw[ends[0] : ends[-1]]


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all given spans, one behind the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose ``column`` holds about ``most`` bytes at the most."""
    offsets, _ = utf8(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, so that later jobs do not compute it again."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``doc_id, y, text`` of at most ``per_class`` labelled texts of each class, the same ones
    at each run.

    Takes the documents with the smallest hashes among those that are not held out.
    Rows without id or label are no examples; a document with several labels counts once.
    The ids are chosen first, so the sort sees no text; at most ``2 * per_class`` ids reach
    the driver, which is the bound of the broadcast as well.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [
        r
        for y in (0, 1)
        for r in known.where(F.col("y") == y).orderBy(*order).limit(per_class).collect()
    ]
    ids = docs.sparkSession.createDataFrame(chosen, known.schema)
    return (
        docs.select("doc_id", text_of("text").alias("text"))
        .join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min("text").alias("text"))
    )


def fitted(sample: DataFrame, fit: Callable[[list[tuple[str, int]]], object]):
    """The model that ``fit`` makes of a bounded sample, fitted in one task.

    The texts stay on the executors; a lost one fits again. The driver gets the model alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (y, i, t)
            for b in batches
            for y, i, t in zip(*(b.column(c).to_pylist() for c in ("y", "doc_id", "text")), strict=True)
        ]
        model = fit([(t, y) for y, _, t in sorted(rows)])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    made = map_arrow(sample.repartition(1), run, "model binary").first()
    # without examples there is no task
    return pickle.loads(made["model"]) if made else fit([])
