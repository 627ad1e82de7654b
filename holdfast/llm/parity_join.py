"""N-gram Jaccard join by parity sketches: near-duplicate components, exactly.

A document is the set of its word shingles. Each shingle flips a few bits of one block of a
sketch, so a bit tells whether an odd number of shingles fell on it, and two sketches differ
in at most ``FLIPS`` times as many bits as the symmetric difference of the sets has members.
Two sets that link differ in at most ``(1 - s) / (1 + s)`` of their joint size. The sketch
is cut into more blocks of 64 bits than that, so linked sets have equal blocks (pigeonhole).
Sizes fall into bands, a band fixes the number of blocks; a set that may link with larger
ones of the next band is sketched for that band too.

1. Equal sets are one vertex. A set whose links differ in at most ``d`` members emits its
   ``d + 1`` fullest blocks: linked sets share more equal blocks than either leaves out, and
   both leave out by the same order.
2. Equal blocks are brought together by one exchange of packed arrays. Inside each input
   batch they are combined first, so a block that a third of all documents share sends one
   entry per batch.
3. Each group of equal blocks compares its members with its first one. Pairs whose sketches
   differ little enough are verified on the shingles of the texts; the links give
   components.
4. What equal blocks hold together is a cluster. Clusters that still hold several components
   compare members of different components in tiles of bounded size. Pairs that the
   sketches allow are verified on their shingles inside the tile, closest first, as long as
   the tile has not yet joined the two; the tile returns the links that join components, fewer
   than it has members. After that no link between different texts can be missing, and no
   pair was ever a row.

Null and wordless texts are empty sets and link with nothing. With fewer words than a
shingle has, the whole sequence is the one shingle. Rows with equal ids count as one
document for ``component_id``; rows without an id take part but give no component its
number. Whole texts are read. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_arrow, stored, text_of
from holdfast.llm.components import components

WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: ratio of neighbouring size bands
BAND = 1.6
#: bits that a shingle flips in its block
FLIPS = 3
#: members of a tile and shingles of them all: bound the memory of a comparison, larger
#: groups take several tiles
TILE, TILE_SHINGLES = 1024, 1024 * 1024
#: buckets of block keys for each shuffle partition: bounds the memory of gathering them
BUCKETS = 8
#: words whose hashes a task remembers
REMEMBERED = 500_000

SCANNED = (
    "doc_id bigint, mark bigint, n bigint, v bigint, check bigint, r bigint, "
    "bucket int, keys binary, key bigint, p bigint, q bigint"
)
KNOWN = "v bigint, n bigint, sketches array<struct<level:int,blocks:array<bigint>>>, shingles array<bigint>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text."""

    def __init__(self, words: int):
        import xxhash

        self.words, self.digest, self.seen = words, xxhash.xxh3_64_intdigest, {}

    def __call__(self, text: str) -> np.ndarray:
        words = WORD_BYTES.findall(text.encode().translate(LOWER))
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        seen = self.seen
        for w in words:
            if w not in seen:
                seen[w] = self.digest(w)
        h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(h))
        with np.errstate(over="ignore"):
            out = np.full(len(h) - size + 1, size, np.uint64)
            for k in range(size):
                out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k])
        return np.unique(out)


@dataclass(frozen=True)
class Bands:
    """Size bands and sketch shapes for linking at ``per_cent`` similarity."""

    per_cent: int

    def low(self, level: int) -> int:
        """Smallest size of a band."""
        return math.ceil(self._ratio() ** level - 1e-9)

    def _ratio(self) -> float:
        return max(BAND, 1.05 * 100 / self.per_cent)

    def level(self, n: int) -> int:
        level = int(math.log(n) / math.log(self._ratio()))
        while self.low(level + 1) <= n:
            level += 1
        while self.low(level) > n:
            level -= 1
        return level

    def differing(self, joint: int) -> int:
        """Most members that the symmetric difference of linked sets of this joint size has."""
        return joint * (100 - self.per_cent) // (100 + self.per_cent)

    def blocks(self, level: int) -> int:
        """Blocks of a band's sketches: one more than its sets may differ in, and some to spare."""
        most = self.differing(2 * (self.low(level + 1) - 1))
        return most + 1 + most // 8

    def emitted(self, level: int, n: int) -> int:
        """Blocks that a set of ``n`` emits in a band: one more than it may differ in there."""
        largest = min(self.low(level + 1) - 1, n * 100 // self.per_cent)
        return self.differing(n + largest) + 1

    def levels(self, n: int) -> range:
        """Bands in which a set of ``n`` may meet sets at least as large."""
        return range(self.level(n), self.level(n * 100 // self.per_cent) + 1)


def sketch(shingles: np.ndarray, blocks: int) -> np.ndarray:
    """Parity of the flips on each bit of each block."""
    block = ((shingles >> np.uint64(24)) % np.uint64(blocks) * np.uint64(64)).astype(np.int64)
    bits = [block + ((shingles >> np.uint64(6 * k)) & np.uint64(63)).astype(np.int64) for k in range(FLIPS)]
    parity = np.bincount(np.concatenate(bits), minlength=blocks * 64) & 1
    return np.packbits(parity.astype(np.uint8).reshape(blocks, 64), axis=1).view(np.uint64).ravel()


def block_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys that a set emits: band, place and value of its fullest blocks."""
    out = []
    for level in bands.levels(len(shingles)):
        blocks = sketch(shingles, bands.blocks(level))
        order = np.lexsort((np.arange(len(blocks)), blocks, np.bitwise_count(blocks)))
        order = order[-bands.emitted(level, len(shingles)) :]
        place = order.astype(np.uint64) + np.uint64(level << 32)
        with np.errstate(over="ignore"):
            out.append(_mix(_mix(place) ^ blocks[order] * np.uint64(0x9E3779B97F4A7C15)))
    return np.concatenate(out)


def _nested(rows: list[list[tuple[int, np.ndarray]]]) -> pa.Array:
    """Levels and blocks of each row as an Arrow column."""
    flat = [b for row in rows for _, b in row]
    blocks = pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *map(len, flat)]), pa.int32()),
        pa.array(np.concatenate(flat).view(np.int64) if flat else np.zeros(0, np.int64)),
    )
    levels = pa.array([k for row in rows for k, _ in row], pa.int32())
    return pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()),
        pa.StructArray.from_arrays([levels, blocks], names=["level", "blocks"]),
    )


def _set_name(shingles: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit names of a set."""
    import xxhash

    digest = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return (digest & (2**64 - 1)) - 2**63, (digest >> 64) - 2**63


def _rows(count: int, /, **columns) -> pa.RecordBatch:
    """A batch of ``SCANNED`` with the given columns, others null."""
    kinds = dict(f.split() for f in SCANNED.split(", "))
    types = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[c], types[k]) if c in columns else pa.nulls(count, types[k])
            for c, k in kinds.items()
        ],
        names=list(kinds),
    )


def scan(docs: DataFrame, words: int, per_cent: int) -> DataFrame:
    """One pass over the texts. Rows with ``r`` are the documents: size, set name ``v`` and a
    row number. Rows with ``key`` are groups of equal blocks with several members, as
    (``p``, ``q``) row numbers: the members of a group are all its ``p`` and ``q``."""
    bands = Bands(per_cent)
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS * count

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shingle, base = Shingler(words), (context.partitionId() if context else 0) << 40
        for whole in batches:
            for at in range(0, whole.num_rows, 50_000):  # row numbers in a bucket have 16 bits
                batch = whole.slice(at, 50_000)
                sets = [shingle(t or "") for t in batch.column("text").to_pylist()]
                names = [_set_name(s) if len(s) else (None, None) for s in sets]
                number = base + np.arange(batch.num_rows)
                yield _rows(
                    batch.num_rows,
                    doc_id=batch.column("doc_id"),
                    mark=batch.column("mark"),
                    n=[len(s) for s in sets],
                    v=[v for v, _ in names],
                    check=[c for _, c in names],
                    r=number,
                    bucket=number % buckets,
                )
                # copies emit once in a batch
                once = {v: i for i, (v, _) in reversed(list(enumerate(names))) if v is not None}
                emitted = {i: block_keys(sets[i], bands) for i in sorted(once.values())}
                if emitted:
                    yield from pack(emitted, base)
                base += batch.num_rows

    def pack(emitted: dict[int, np.ndarray], base: int) -> Iterator[pa.RecordBatch]:
        key = np.concatenate(list(emitted.values()))
        owner = np.repeat(np.fromiter(emitted, np.int64), [len(k) for k in emitted.values()])
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        first = np.append(True, key[1:] != key[:-1])
        head = owner[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        fellow = head != owner
        if fellow.any():  # done here; only the first of a key goes on to meet other batches
            yield _rows(
                int(fellow.sum()),
                key=key[fellow].view(np.int64),
                p=base + head[fellow],
                q=base + owner[fellow],
                bucket=(base + owner[fellow]) % buckets,
            )
        key, owner = key[first], owner[first]
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        key, owner, bucket = key[order], owner[order], bucket[order]
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        ends = np.append(starts[1:], len(key))
        packed = [
            base.to_bytes(8, "little") + key[a:b].tobytes() + owner[a:b].astype("<u2").tobytes()
            for a, b in zip(starts, ends, strict=True)
        ]
        yield _rows(len(starts), bucket=bucket[starts], keys=packed)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def meet() -> Iterator[pa.RecordBatch]:
            sizes = [(len(x) - 8) // 10 for x in held]
            key = np.concatenate([np.frombuffer(x, "<u8", n, 8) for x, n in zip(held, sizes, strict=True)])
            row = np.concatenate(
                [
                    int.from_bytes(x[:8], "little") + np.frombuffer(x, "<u2", n, 8 + 8 * n).astype(np.int64)
                    for x, n in zip(held, sizes, strict=True)
                ]
            )
            order = np.lexsort((row, key))
            key, row = key[order], row[order]
            first = np.append(True, key[1:] != key[:-1])
            head = row[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
            if not first.all():
                yield _rows(
                    int((~first).sum()), key=key[~first].view(np.int64), p=head[~first], q=row[~first]
                )

        for batch in batches:
            packed = batch.column("keys").is_valid()
            yield batch.filter(batch.column("keys").is_null())
            part = batch.filter(packed)
            for bucket, keys in zip(part.column("bucket").to_pylist(), part.column("keys").to_pylist(), strict=True):
                if bucket != now:
                    if held:
                        yield from meet()
                    now, held = bucket, []
                held.append(keys)
        if held:
            yield from meet()

    text = text_of("text")
    emitted = map_arrow(
        docs.select("doc_id", F.xxhash64(text).alias("mark"), text.alias("text")), emit, SCANNED
    )
    return map_arrow(
        emitted.repartition(count, "bucket").sortWithinPartitions("bucket"), gather, SCANNED
    )


def vertices(documents: DataFrame) -> DataFrame:
    """Distinct sets: ``v``, its smallest id and the row that has its text. Two sets under one
    ``v`` raise."""
    clash = F.min("check") != F.max("check")
    return (
        documents.where("n > 0")
        .groupBy("v")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("mark"))).alias("row"),
            F.when(clash, F.raise_error(F.lit("two shingle sets share a 64-bit name"))).alias("_clash"),
        )
        .where(F.col("_clash").isNull())
        .drop("_clash")
    )


def hamming(left: Column, right: Column) -> Column:
    """Bits in which the sketches of two vertices differ on a common band; null without one."""

    def on_common(mine: Column, other: Column) -> Column:
        common = F.filter(mine, lambda x: F.exists(other, lambda y: y["level"] == x["level"]))
        return F.get(common, F.lit(0))["blocks"]

    bits = F.zip_with(
        on_common(left, right), on_common(right, left), lambda a, b: F.bit_count(a.bitwiseXOR(b))
    )
    return F.aggregate(bits, F.lit(0), lambda total, x: total + x)


def near(pairs: DataFrame, known: DataFrame, per_cent: int) -> DataFrame:
    """The pairs ``a, b`` that sizes and sketches allow to link."""
    one = known.select(F.col("v").alias("a"), F.col("n").alias("na"), F.col("sketches").alias("sa"))
    two = known.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("sketches").alias("sb"))
    most = F.floor((F.col("na") + F.col("nb")) * (100 - per_cent) / (100 + per_cent))
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .where(100 * F.least("na", "nb") >= per_cent * F.greatest("na", "nb"))
        .where(hamming(F.col("sa"), F.col("sb")) <= FLIPS * most)
        .select("a", "b")
    )


def linked(x: np.ndarray, y: np.ndarray, per_cent: int) -> bool:
    """Whether two sorted shingle sets are similar enough."""
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= per_cent * (len(x) + len(y) - shared)


def verified(pairs: DataFrame, known: DataFrame, per_cent: int) -> DataFrame:
    """The pairs whose shingle sets are similar enough, by the sets themselves."""
    both = pairs.join(known.select(F.col("v").alias("a"), F.col("shingles").alias("sa")), "a").join(
        known.select(F.col("v").alias("b"), F.col("shingles").alias("sb")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(_lists(batch.column("sa")), _lists(batch.column("sb")), strict=True)
            mask = pa.array([linked(x, y, per_cent) for x, y in sets], pa.bool_())
            yield batch.select(["a", "b"]).filter(mask)

    return map_arrow(both, run, "a bigint, b bigint")


def _lists(column: pa.Array) -> list[np.ndarray]:
    """Lists of a column as slices of its values."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _tiles(members: DataFrame) -> DataFrame:
    """Members of each cluster and band once per pair of tiles in which they are compared."""
    k = F.ceil(F.greatest(F.col("members") / TILE, F.col("shingled") / TILE_SHINGLES)).cast("int")
    tile = F.pmod(F.xxhash64("v", F.lit(3)), k).cast("int")
    every = F.transform(
        F.sequence(F.lit(0), k - 1), lambda j: F.struct(F.least(tile, j).alias("i"), F.greatest(tile, j).alias("j"))
    )
    return members.withColumn("own", tile).withColumn("t", F.explode(every))


def foreign_links(members: DataFrame, per_cent: int) -> DataFrame:
    """Links that join components of one cluster: of each pair of tiles, enough of them to
    join all that any link between their members joins."""
    count = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["g", "level", "i", "j"]
    tiles = _tiles(members).select("g", "level", "t.i", "t.j", "own", "v", "n", "c", "blocks", "shingles")
    dealt = tiles.repartition(count, *keys).sortWithinPartitions(*keys)

    def compare(parts: list[pa.RecordBatch]) -> np.ndarray:
        """Joining links of one tile pair, whose rows come in one or more batches."""
        n, c, v, own = (np.concatenate([np.array(p.column(x)) for p in parts]) for x in ("n", "c", "v", "own"))
        bits = np.concatenate([np.array(p.column("blocks").flatten()) for p in parts])
        bits = bits.view(np.uint64).reshape(len(v), -1)
        sets = [s for p in parts for s in _lists(p.column("shingles"))]
        apart = parts[0].column("i")[0].as_py() != parts[0].column("j")[0].as_py()
        values, joined, counts = np.unique(c, return_inverse=True, return_counts=True)
        outer = joined != counts.argmax()
        outside, every = np.flatnonzero(outer), np.arange(len(v))
        found: list[tuple[int, int]] = []

        def join(one: np.ndarray, two: np.ndarray) -> None:
            """Verify pairs, closest first, that are not joined yet."""
            nonlocal joined
            at, step = 0, 64
            while at < len(one):
                for a, b in zip(one[at : at + step], two[at : at + step], strict=True):
                    if joined[a] != joined[b] and linked(sets[a], sets[b], per_cent):
                        found.append((v[a], v[b]))
                        joined = np.where(joined == joined[b], joined[a], joined)
                open_pairs = joined[one[at + step :]] != joined[two[at + step :]]
                one, two = one[at + step :][open_pairs], two[at + step :][open_pairs]
                step *= 2

        wide = max(1, 2_000_000 // bits.size)
        for at in range(0, len(outside), wide):
            x = outside[at : at + wide]
            differing = np.bitwise_count(bits[x, None] ^ bits[None]).sum(axis=2, dtype=np.int64)
            joint = n[x, None] + n[None]
            fits = differing <= FLIPS * (joint * (100 - per_cent) // (100 + per_cent))
            fits &= 100 * np.minimum(n[x, None], n[None]) >= per_cent * np.maximum(n[x, None], n[None])
            fits &= joined[x, None] != joined[None]
            fits &= ~outer[None] | (every[None] > x[:, None])
            if apart:
                fits &= own[x, None] != own[None]
            one, two = np.nonzero(fits)
            order = np.argsort(differing[one, two], kind="stable")
            join(x[one[order]], two[order])
        return np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush() -> pa.RecordBatch:
            pairs = compare(held)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([np.array(batch.column(x)).astype(np.int64) for x in keys], axis=1)
            starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
            for at, to in zip(starts, np.append(starts[1:], len(key)), strict=True):
                own = tuple(key[at])
                if own != now and held:
                    yield flush()
                    held = []
                now = own
                held.append(batch.slice(at, to - at))
        if held:
            yield flush()

    return map_arrow(dealt, run, "a bigint, b bigint").distinct()


def _members(known: DataFrame, clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the clusters that hold several components and untested pairs, by band.

    A cluster is what equal blocks hold together, so every pair with an equal block lies in
    one, and each set is carried once, however many blocks it shares.
    """
    rows = (
        known.join(clusters.select(F.col("v").alias("kv"), F.col("c").alias("g")), F.col("v") == F.col("kv"))
        .join(labels.select(F.col("v").alias("lv"), F.col("c").alias("l")), F.col("v") == F.col("lv"), "left")
        .select("g", "v", "n", F.coalesce("l", "v").alias("c"), "shingles", F.explode("sketches").alias("s"))
        .select("g", "v", "n", "c", "shingles", "s.level", "s.blocks")
    )
    open_clusters = (
        rows.groupBy("g", "level")
        .agg(
            F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingled"), F.min("c").alias("c0"), F.max("c").alias("c1")
        )
        .where("members > 1 and c0 <> c1")
        .select(F.col("g").alias("og"), F.col("level").alias("ol"), "members", "shingled")
    )
    same = (F.col("g") == F.col("og")) & (F.col("level") == F.col("ol"))
    return rows.join(open_clusters, same).drop("og", "ol")


def near_duplicates(docs: DataFrame, words: int = 5, per_cent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``; also ``mark``, a hash of
    its text, and ``component``, the name of its component (null for an empty set)."""
    scanned = stored(scan(docs, words, per_cent), "scanned")
    documents = scanned.where("r IS NOT NULL").select("doc_id", "mark", "n", "v", "check", "r")
    sets = vertices(documents)
    groups = stored(_named_groups(scanned, documents), "groups")

    # from here on only vertices that share a block with another one matter
    involved = groups.select("v").union(groups.select(F.col("p").alias("v"))).distinct()
    known = stored(_known(docs, sets.join(involved, "v", "left_semi"), words, per_cent), "known")

    star = groups.select(F.least("p", "v").alias("a"), F.greatest("p", "v").alias("b")).distinct()
    links = stored(verified(near(star, known, per_cent), known, per_cent), "links")
    labels = components(links)
    more = stored(foreign_links(_members(known, components(star), labels), per_cent), "links")
    if not more.isEmpty():
        labels = components(links.union(more))
    joined = sets.join(labels.withColumnRenamed("v", "lv"), F.col("v") == F.col("lv"), "left").select(
        "v", "least_id", F.coalesce("c", "v").alias("c")
    )
    least = joined.groupBy("c").agg(F.min("least_id").alias("component_id")).withColumnRenamed("c", "cc")
    named_sets = joined.join(least, F.col("c") == F.col("cc")).select(F.col("v").alias("sv"), "c", "component_id")
    return (
        documents.select("doc_id", "mark", "n", "v")
        .join(named_sets, F.col("v") == F.col("sv"), "left")
        .select(
            "doc_id",
            "mark",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.col("c").alias("component"),
        )
    )


def keep_one(docs: DataFrame, words: int = 5, per_cent: int = 80) -> DataFrame:
    """The rows of ``docs`` of one document per component: the smallest id, then, where
    none has an id, the smallest text hash. Empty texts stay. Rows alike in id and text
    stay together."""
    found = near_duplicates(docs, words, per_cent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("mark"))).alias("r")
    linked = found.where("component is not null").groupBy("component").agg(first).select("r.doc_id", "r.mark")
    stay = linked.union(found.where("component is null").select("doc_id", "mark"))
    stay = stay.select(F.col("doc_id").alias("_keep_id"), F.col("mark").alias("_keep_mark"))
    same = F.col("doc_id").eqNullSafe(F.col("_keep_id")) & (F.xxhash64(text_of("text")) == F.col("_keep_mark"))
    return docs.join(stay, same, "left_semi")


def _named_groups(scanned: DataFrame, documents: DataFrame) -> DataFrame:
    """Groups of equal blocks with the names of the sets in place of row numbers."""
    one = documents.select(F.col("r").alias("p"), F.col("v").alias("pv"))
    two = documents.select(F.col("r").alias("q"), F.col("v").alias("qv"))
    found = scanned.where("key IS NOT NULL").select("key", "p", "q")
    return (
        found.join(one, "p")
        .join(two, "q")
        .where("pv <> qv")
        .select("key", F.col("pv").alias("p"), F.col("qv").alias("v"))
        .distinct()
    )


def _known(docs: DataFrame, sets: DataFrame, words: int, per_cent: int) -> DataFrame:
    """Size, sketches and shingles of each vertex, from a text met by id and hash of its row."""
    bands = Bands(per_cent)
    text = text_of("text")
    own = docs.select(F.col("doc_id").alias("own"), F.xxhash64(text).alias("own_mark"), text.alias("text"))
    wanted = sets.select("v", F.col("row.doc_id").alias("id"), F.col("row.mark").alias("mark"))
    same = F.col("own").eqNullSafe(F.col("id")) & (F.col("own_mark") == F.col("mark"))
    found = own.join(wanted, same).dropDuplicates(["v"]).select("v", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            sets = [shingle(t) for t in batch.column("text").to_pylist()]
            own = [[(k, sketch(s, bands.blocks(k))) for k in bands.levels(len(s))] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("v"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _nested(own),
                    pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()),
                        pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)),
                    ),
                ],
                names=["v", "n", "sketches", "shingles"],
            )

    return map_arrow(found, run, KNOWN)


def join_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=3, per_cent=90).select("doc_id", "n_shingles", "component_id")
