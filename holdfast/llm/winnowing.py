"""Document fingerprints by winnowing.

A text loses white space and capitals (A-Z), which leaves its positions; every run of
``gram`` characters has a rolling hash, and each window of ``window`` successive hashes
gives its least one, the rightmost at ties. Two texts that share a run of ``window + gram -
1`` characters then share a fingerprint, wherever the run stands; none of less than ``gram``
characters counts. The position of each chosen run in the original text is kept.

Rolling hashes are differences of one running sum of character times power (modulo 2**64),
scaled back to the run's own beginning, then mixed, so equal runs have equal hashes in all
texts. A text with fewer hashes than a window has one window of them all; one shorter than
a run is one run. Empty and white-space texts have an empty fingerprint.

``neighbours`` puts texts in the order of their ids: the keys alone are sorted first, which
gives the first key of each of as many ranges as there are shuffle partitions; the texts
then go once to their range, and the first text of a range also to the one before it, so a
task meets each text's successor. The driver holds one key per range.

Null texts count as empty; rows without id come last; rows alike in id are ordered by a
hash of their text, so copies of one row follow each other. A single row is its own
successor, an empty table gives an empty result, further columns are not read. Very long
texts are read whole, one at a time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_arrow, text_of

#: characters of a run, runs of a window (255 at most)
GRAM, WINDOW = 12, 10
#: an odd number has an inverse modulo 2**64
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)


@cache
def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2**64, kept in steps of doubled length."""
    return _powers(base, 1 << max(12, n - 1).bit_length())[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that makes close values differ everywhere."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points without white space and capitals, and their positions."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.flatnonzero((codes != 32) & ((codes < 9) | (codes > 13)))
    codes = codes[at]
    return codes + np.uint32(32) * ((codes >= 65) & (codes <= 90)), at


def rolling(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of 56 bits of all runs of ``gram`` characters (of the whole, if it is shorter)."""
    n, gram = len(codes), min(gram, len(codes))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    return mixed((sums[gram:] - sums[:-gram]) * powers(BACK, n - gram + 1)) >> np.uint64(8)


def least(hashes: np.ndarray, window: int) -> np.ndarray:
    """Index of the least hash of each window, the rightmost at ties, each index once."""
    window = min(window, len(hashes))
    best, width = np.arange(len(hashes)), 1
    while width < window:
        step = min(width, window - width)
        left, right = best[:-step], best[step:]
        best = np.where(hashes[right] <= hashes[left], right, left)
        width += step
    return best[np.flatnonzero(np.diff(best, prepend=-1))]


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places among the kept characters, positions in ``text`` and hashes of its fingerprint."""
    codes, at = folded(text)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = rolling(codes, gram)
    chosen = least(hashes, window)
    return chosen, at[chosen], hashes[chosen]


def encoded(places: np.ndarray, hashes: np.ndarray) -> str:
    """A fingerprint as text: base64 of eight bytes per entry, the step from the place before
    (never more than a window, so one byte holds it) and seven of hash."""
    steps = np.diff(places, prepend=0).astype(np.uint64)
    return base64.b64encode((steps << np.uint64(56) | hashes).astype(">u8").tobytes()).decode()


def decoded(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of an encoded fingerprint."""
    entries = np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(np.uint64)
    return np.cumsum((entries >> np.uint64(56)).astype(np.int64)), entries & np.uint64((1 << 56) - 1)


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Shared hashes over all different hashes; two empty fingerprints are alike."""
    left, right = np.unique(left), np.unique(right)
    shared = len(np.intersect1d(left, right, assume_unique=True))
    every = len(left) + len(right) - shared
    return shared / every if every else 1.0


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id, positions, hashes`` of each row of ``docs``: the fingerprint as lists."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(t.as_py(), gram, window) for t in batch.column("text")]
            columns = [
                batch.column("doc_id"),
                pa.array([p for _, p, _ in found], pa.list_(pa.int64())),
                pa.array([h.view(np.int64) for _, _, h in found], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "positions", "hashes"])

    rows = docs.select("doc_id", text_of("text").alias("text"))
    return map_arrow(rows, run, f"doc_id {kind}, positions array<bigint>, hashes array<bigint>")


def neighbours(docs: DataFrame) -> DataFrame:
    """``part, guest, doc_id, text``: rows dealt by ranges of their place and sorted in them.

    The last row of each range is a guest: the first row of the next range (of the first, at
    the end), there to be the successor of the row before it.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_of("text").alias("text")).withColumn(
        "place", F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("place").repartitionByRange(parts, "place")
    first = dealt.groupBy(F.spark_partition_id()).agg(F.min("place").alias("place")).select("place")
    starts = [r["place"] for r in first.orderBy("place").collect()]
    n = len(starts)
    kind = rows.schema["place"].dataType.simpleString()
    begin = F.lit([]) if not n else F.array(*[_place(s, kind) for s in starts])
    # ranges that begin at the row's place or before it; the first key begins the first range
    part = (F.size(F.filter(begin, lambda s: s <= F.col("place"))) - 1).cast("int") if n else F.lit(0)
    ranged = rows.withColumn("part", part)
    heads = F.element_at(begin, F.col("part") + 1) == F.col("place") if n else F.lit(False)
    before = F.pmod(F.col("part") - 1, F.lit(max(n, 1))).cast("int")
    copies = F.when(heads, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    sent = ranged.withColumn("guest", F.explode(copies)).withColumn("part", F.when(F.col("guest"), before).otherwise(F.col("part")))
    out = sent.select("part", "guest", "place", "doc_id", "text")
    return out.repartitionById(max(n, 1), F.col("part")).sortWithinPartitions("part", "guest", "place").drop("place")


def _place(key, kind: str):
    values = [F.lit(key["none"]).alias("none"), F.lit(key["id"]).alias("id"), F.lit(key["h"]).alias("h")]
    return F.struct(*values).cast(kind)


def edited(text: str, following: str) -> str:
    """``text`` whose last quarter of code points is replaced by the first ones of ``following``."""
    last = len(text) // 4
    return text[: len(text) - last] + following[:last]


RESULT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each row's fingerprint, that of its edited text and their likeness, and the likeness to the next row's."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, {RESULT}"
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def row(doc_id, text: str, own: tuple, following: str, after: tuple) -> list:
        changed = edited(text, following)
        new = winnow(changed, gram, window)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        marks = [encoded(f[0], f[2]) for f in (own, new)]
        return [doc_id, len(text), digest, *marks, likeness(own[2], new[2]), likeness(own[2], after[2])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        last = None  # part, guest, id, text, fingerprint
        for batch in batches:
            kinds = [batch.schema.field("doc_id").type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            out: list[list] = []
            for part, guest, doc_id, text in zip(*(batch.column(c) for c in ("part", "guest", "doc_id", "text")), strict=True):
                part, guest, text = part.as_py(), guest.as_py(), text.as_py()
                found = winnow(text, gram, window)
                if last is not None and last[0] == part and not last[1]:
                    out.append(row(*last[2:], text, found))
                last = (part, guest, doc_id.as_py(), text, found)
            if out:
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return map_arrow(neighbours(docs), run, schema)


def fingerprint_query(docs: DataFrame) -> DataFrame:
    return compared(docs)
