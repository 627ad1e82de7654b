"""Order-based operators without a single global sort: prefix sums, exact
quantiles, percentile ranks, cumulative shares, top-k and paging.

A window without partition keys moves every row into one task. Here equal values collapse
first, so a value shared by a third of the rows is one row. The collapsed rows are dealt by
ranges of the value into as many slices as the session has shuffle partitions and written
once. Rows of one slice sort together, and one row of totals per slice carries the running
sums from slice to slice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.session import settle, ship


def sql_literal(value) -> str:
    """SQL text of a number, a text or a timestamp without zone."""
    if isinstance(value, datetime):
        return f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def slice_of(value: str, points: Sequence) -> Column:
    """Number of points below the expression ``value``: a binary search as one CASE."""
    texts = [sql_literal(p) for p in points]

    def search(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return (
            f"CASE WHEN {value} <= {texts[middle]} THEN {search(low, middle)}"
            f" ELSE {search(middle + 1, high)} END"
        )

    return F.expr(search(0, len(texts)))


def prefix(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    sums: dict[str, Column] | None = None,
    descending: bool = False,
) -> DataFrame:
    """One row per distinct value with counts and running sums in value order.

    Runs ``df`` once, to write the collapsed table. Any sortable type will do. Returns
    ``by``, ``value``, ``n`` and each of ``sums`` for the value itself, ``before_*`` for
    everything ranked ahead of it and ``total_*`` for the whole group. ``by`` must have few
    groups (splits, features, strata). NULL values are left out.
    """
    by = list(by)
    measures = {"n": F.count(F.lit(1)), **(sums or {})}
    grouped = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(*[m.alias(name) for name, m in measures.items()])
    )
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the slice is written with the row: all branches below must see the same cut
    grouped = settle(
        grouped.repartitionByRange(slices, value).withColumn("_slice", F.spark_partition_id())
    )

    def direction(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    # one row per group and slice: a small table, whatever the input size
    totals = grouped.groupBy(*by, "_slice").agg(*[F.sum(m).alias(m) for m in measures])
    across = Window.partitionBy(*(by or [F.lit(0)]))
    ahead = across.orderBy(direction("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *by,
        "_slice",
        *[F.coalesce(F.sum(m).over(ahead), F.lit(0)).alias(f"_carry_{m}") for m in measures],
        *[F.sum(m).over(across).alias(f"total_{m}") for m in measures],
    )
    inside = (
        Window.partitionBy(*by, "_slice")
        .orderBy(direction(value))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    running = grouped.select(
        *by,
        value,
        "_slice",
        *measures,
        *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_run_{m}") for m in measures],
    )
    return running.join(carried, [*by, "_slice"]).select(
        *by,
        value,
        *measures,
        *[(F.col(f"_carry_{m}") + F.col(f"_run_{m}")).alias(f"before_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Exact, linearly interpolated quantiles: ``by``, ``probability``, ``quantile``."""
    return _picked(prefix(df, value, by), value, probabilities, by)


def _picked(ranked: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles from distinct values with ``n``, ``before_n`` and ``total_n``."""
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    position = (F.col("total_n") - 1) * F.col("probability")
    low, high = F.floor(position), F.ceil(position)

    def holds(rank: Column) -> Column:
        return (F.col("before_n") <= rank) & (rank < F.col("before_n") + F.col("n"))

    def near(p: float) -> Column:
        at = (F.col("total_n") - 1) * F.lit(float(p))
        return holds(F.floor(at)) | holds(F.ceil(at))

    keep = F.lit(False)
    for p in probabilities:
        keep = keep | near(p)
    hits = (
        ranked.where(keep)
        .select("*", wanted)
        .where(holds(low) | holds(high))
        .groupBy(*by, "probability")
        .agg(
            F.max(F.when(holds(low), F.col(value).cast("double"))).alias("_low"),
            F.max(F.when(holds(high), F.col(value).cast("double"))).alias("_high"),
            F.max(position - low).alias("_part"),
        )
    )
    return hits.select(
        *by,
        "probability",
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("quantile"),
    )


def quantile_list(df: DataFrame, value: str, probabilities: Sequence[float]) -> list[float | None]:
    """The same quantiles as driver numbers, in the order asked for."""
    found = {r["probability"]: r["quantile"] for r in quantiles(df, value, probabilities).collect()}
    return [found.get(float(p)) for p in probabilities]


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``by, feature, value``: a row per column."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*by, F.explode(cells).alias("p")).select(*by, "p.feature", "p.value")


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact median of each column in long form: ``by``, ``feature``, ``median``.

    All columns share one pass. NULLs are skipped; a column without values has no row.
    Without ``by`` no value moves: doubles as whole numbers in the same order have four digits
    of 16 bits, and four passes find the middle digit by digit. In each, tasks count the values
    that begin like the middle by their next digit, and Spark adds up the counts. ``df`` is then
    read four times: pass a stored table, not a plan.
    """
    columns = list(columns)
    if by:
        return _medians_of(quantiles(_long(df, columns, by), "value", [0.5], [*by, "feature"]), by)
    wide = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    # by column and end of the middle: its first digits, and its rank among the values that begin so
    found: dict[tuple[int, int], tuple[int | None, int | None]] = {
        (i, end): (None, None) for i in range(len(columns)) for end in (0, 1)
    }
    even: dict[int, bool] = {}
    for shift in (48, 32, 16, 0):
        found = _next_digit(wide, found, shift, even)
    values = {k: _double(head) for k, (head, _) in found.items()}
    rows = [
        (c, values[i, 0] + (values[i, 1] - values[i, 0]) * (0.5 if even[i] else 0.0))
        for i, c in enumerate(columns)
        if i in even
    ]
    return df.sparkSession.createDataFrame(rows, "feature STRING, median DOUBLE")


def _next_digit(wide: DataFrame, found: dict, shift: int, even: dict[int, bool]) -> dict:
    """``found`` with one digit more; the first pass also tells which columns have an even number of values."""
    first = shift == 48
    heads: dict[int, list] = {}
    for (i, _), (head, _) in found.items():
        heads.setdefault(i, [])
        if head not in heads[i]:
            heads[i].append(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {(i, h): np.zeros(65536, np.int64) for i, hs in heads.items() for h in hs}
        for batch in batches:
            for i, hs in heads.items():
                key = _sortable(batch.column(i).drop_null().to_numpy(zero_copy_only=False))
                digit = key >> shift
                for h in hs:
                    mine = digit + 32768 if first else digit[digit >> 16 == h] & 65535
                    counts[i, h] += np.bincount(mine, minlength=65536)
        for (i, h), n in counts.items():
            at = np.flatnonzero(n)
            head = at - 32768 if first else at + (h << 16)
            of = np.zeros(len(at), np.int64) if first else np.full(len(at), h, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(of), pa.array(head), pa.array(n[at])], ["i", "of", "head", "n"]
            )

    ship(wide.sparkSession)
    counted = wide.mapInArrow(run, "i int, of bigint, head bigint, n bigint").groupBy("i", "of", "head").agg(F.sum("n").alias("n"))
    # at most 65,536 rows of counts in a group, whatever the input size
    inside = Window.partitionBy("i", "of")
    ahead = inside.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.select(
        "*", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"), F.sum("n").over(inside).alias("total")
    )

    def holds(rank: Column) -> Column:
        return (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))

    if first:
        wanted = holds(F.floor((F.col("total") - 1) / 2)) | holds(F.floor(F.col("total") / 2))
    else:
        wanted = F.lit(False)
        for (i, _), (head, rank) in found.items():
            wanted = wanted | ((F.col("i") == i) & (F.col("of") == head) & holds(F.lit(rank)))
    out = {}
    for r in ranked.where(wanted).collect():
        for end in (0, 1):
            if first:
                head, rank = 0, (r["total"] - 1 + end) // 2
                even[r["i"]] = r["total"] % 2 == 0
            else:
                head, rank = found[r["i"], end]
            if head == r["of"] and r["before"] <= rank < r["before"] + r["n"]:
                out[r["i"], end] = r["head"], rank - r["before"]
    return out


def _sortable(values: np.ndarray) -> np.ndarray:
    """Doubles as whole numbers in the same order; zeros are equal, and so are NaNs, behind all others."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & 0x7FFFFFFFFFFFFFFF)


def _double(key: int) -> float:
    bits = np.array([key], np.int64)
    return float((bits ^ ((bits >> 63) & 0x7FFFFFFFFFFFFFFF)).view(np.float64)[0])


def _medians_of(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return found.select(*by, "feature", F.col("quantile").alias("median"))


def percentile_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` plus ``name``: the average rank of the value divided by the number of values.

    Ranks come back by an equi-join on the value; adaptive execution splits the rows of a
    value that many rows share.
    """
    ranked = prefix(df, value).select(
        F.col(value).alias("_value"),
        ((F.col("before_n") + (F.col("n") + 1) / F.lit(2.0)) / F.col("total_n")).alias("_rank"),
    )
    return df.join(ranked, F.col(value) == F.col("_value"), "left").select(
        *df.columns, F.col("_rank").alias(name)
    )


def descending_sums(df: DataFrame, value: str, amount: str) -> DataFrame:
    """Counts and sums of ``amount`` along ``value``, largest first: serves ``top_k`` and ``leading_sums``."""
    return prefix(df, value, sums={"amount": F.sum(amount)}, descending=True)


def leading_sums(
    df: DataFrame,
    value: str,
    takes: dict[str, Column | int],
    amount: str | None = None,
    name: str = "ask",
    ranked: DataFrame | None = None,
) -> DataFrame:
    """Sum over the largest values for each entry of ``takes``, a label and a row count.

    A count may be an expression of ``total_n``, the number of values. Returns the
    label as ``name``, ``take``, ``taken`` (never more than there are rows),
    ``taken_sum``, ``total_n`` and ``total_sum``. ``amount`` must be a function of ``value``:
    rows tied at a cut are then interchangeable in the sum, so no tiebreak is needed.
    ``ranked`` is ``descending_sums`` of the same rows, where the caller has it already.
    """
    amount = amount or value
    counts = {k: t if isinstance(t, Column) else F.lit(int(t)) for k, t in takes.items()}
    asks = F.explode(
        F.array(
            *[F.struct(F.lit(k).alias(name), t.cast("bigint").alias("take")) for k, t in counts.items()]
        )
    ).alias("_a")
    if ranked is None:
        ranked = descending_sums(df, value, amount)

    def cuts(take: Column) -> Column:
        return (F.col("before_n") < take) & (take <= F.col("before_n") + F.col("n"))

    at_any_cut = F.lit(False)
    for take in counts.values():
        at_any_cut = at_any_cut | cuts(take)
    part = (F.col("take") - F.col("before_n")) / F.col("n")
    hits = (
        ranked.where(at_any_cut)
        .select("n", "amount", "before_n", "before_amount", asks)
        .select("*", "_a.*")
        .where(cuts(F.col("take")))
        .select(name, (F.col("before_amount") + F.col("amount") * part).alias("_sum"))
    )
    whole = ranked.groupBy().agg(
        F.coalesce(F.max("total_n"), F.lit(0)).alias("total_n"),
        F.coalesce(F.max("total_amount"), F.lit(0)).alias("total_sum"),
    )
    everything = F.when(F.col("take") > F.col("total_n"), F.col("total_sum")).otherwise(F.lit(0))
    return (
        whole.select("*", asks)
        .select("total_n", "total_sum", "_a.*")
        .join(hits, name, "left")
        .select(
            name,
            "take",
            F.greatest(F.least("take", "total_n"), F.lit(0)).alias("taken"),
            F.coalesce("_sum", everything).alias("taken_sum"),
            "total_n",
            "total_sum",
        )
    )


def top_k(df: DataFrame, value: str, key: str, k: int, ranked: DataFrame | None = None) -> DataFrame:
    """The ``k`` rows with the largest ``value``, ties to the smallest unique ``key``, in that order.

    The cut is found by rank and the rows above it are a plain filter, so no number of rows
    gathers in one task or on the driver. Rows without a value come last. ``ranked`` is a
    descending ``prefix`` of the same rows, where the caller has it already.
    """
    if k <= 0:
        return df.where(F.lit(False))
    rank = prefix(df, value, descending=True) if ranked is None else ranked
    cut = rank.where((F.col("before_n") < k) & (k <= F.col("before_n") + F.col("n"))).first()
    if cut is None:
        missing = df.where(F.col(value).isNull())
        chosen = df.where(F.col(value).isNotNull())
        left = k - (rank.agg(F.max("total_n")).first()[0] or 0)
        if left > 0:
            chosen = chosen.unionByName(_first_by_key(missing, key, left))
    else:
        border = df.where(F.col(value) == F.lit(cut[value]))
        above = df.where(F.col(value) > F.lit(cut[value]))
        chosen = above.unionByName(_first_by_key(border, key, k - cut["before_n"]))
    return chosen.orderBy(F.col(value).desc_nulls_last(), F.col(key))


def _first_by_key(df: DataFrame, key: str, k: int) -> DataFrame:
    last = _key_at(df, key, k)
    return df if last is None else df.where(F.col(key) <= F.lit(last))


def _key_at(df: DataFrame, key: str, rank: int):
    """The unique key at 1-based ``rank``, or None past the end."""
    row = prefix(df.select(key), key).where(F.col("before_n") == rank - 1).first()
    return None if row is None else row[key]


def page(df: DataFrame, key: str, limit: int, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the order of the unique ``key``."""
    if limit < 0 or offset < 0:
        raise ValueError(f"a page needs a limit and an offset of 0 or more: {limit}, {offset}")
    if not limit:
        return df.where(F.lit(False))
    rank = prefix(df.select(key), key)
    edges = rank.where(F.col("before_n").isin(offset - 1, offset + limit - 1)).collect()
    found = {r["before_n"]: r[key] for r in edges}
    if offset and offset - 1 not in found:
        return df.where(F.lit(False))
    if offset:
        df = df.where(F.col(key) > F.lit(found[offset - 1]))
    if offset + limit - 1 in found:
        df = df.where(F.col(key) <= F.lit(found[offset + limit - 1]))
    return df.orderBy(key)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash of the key: the same rows on every run."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}")))
    return top_k(df.withColumn("_order", order), "_order", key, n).drop("_order")


def check_edges(edges: Sequence[float], labels: Sequence[str]) -> None:
    if len(labels) != len(edges) - 1:
        raise ValueError(
            f"{len(edges)} cutoffs make {len(edges) - 1} buckets, but there are {len(labels)} labels"
        )


def fixed_buckets(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed buckets, the lowest edge included; outside all edges is NULL."""
    check_edges(edges, labels)
    bucket = F.when((value >= F.lit(edges[0])) & (value <= F.lit(edges[1])), F.lit(labels[0]))
    for low, high, label in zip(edges[1:-1], edges[2:], labels[1:]):
        bucket = bucket.when((value > F.lit(low)) & (value <= F.lit(high)), F.lit(label))
    return bucket


def quantile_edges(df: DataFrame, value: str, cutoffs: Sequence[float]) -> list[float]:
    """Exact bucket edges at the given fractions; equal edges are an error."""
    edges = quantile_list(df, value, cutoffs)
    if None in edges:
        raise ValueError(f"No values in {value!r} to cut into buckets.")
    if len(set(edges)) < len(edges):
        raise ValueError(f"quantiles {list(cutoffs)} of {value!r} coincide: {edges}; equal edges make empty buckets")
    return edges


def quantile_buckets(
    df: DataFrame, value: str, cutoffs: Sequence[float], labels: Sequence[str], name: str
) -> DataFrame:
    """``df`` plus ``name``, the bucket between exact quantiles of ``value``."""
    check_edges(cutoffs, labels)
    edges = quantile_edges(df, value, cutoffs)
    return df.withColumn(name, fixed_buckets(F.col(value), edges, labels))
