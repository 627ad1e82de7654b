"""Previous row within a key and as-of joins, safe for a key that holds much of the table.

Rows are dealt by ranges of (key, time) and written once with the number of their part, so
a key with a third of all rows lies in as many parts as its size asks for. Within a part a
window links the rows of each key. Only the first and the last key of a part can lie in
others too, so one row per part carries what crosses its border.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.session import settle


def _dealt(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))


def _carried(dealt: DataFrame, key: str, gift: Column, over: Column, forward: bool = False) -> DataFrame:
    """``_carry_part, _carry_key, _carried``: what each part's first key gets from parts before it.

    ``gift`` is what a row hands on (NULL for nothing), ``over`` orders rows. A part hands
    on the gift of its last row with one, if that row has the part's last key; parts
    without one pass on what they were given. With ``forward`` all is mirrored.
    """
    low, high = F.min(key), F.max(key)
    last = F.struct(F.col(key).alias("k"), over.alias("o"), gift.alias("g"))
    given = F.when(gift.isNotNull(), last)
    edges = dealt.groupBy("_part").agg(
        (high if forward else low).alias("_asks"),
        (low if forward else high).alias("_gives"),
        (F.min(given) if forward else F.max(given)).alias("_last"),
    )
    ask = F.struct(F.col("_asks").alias("k"), F.lit(0).alias("kind"), F.lit(None).cast(dealt.select(gift.alias("g")).schema["g"].dataType).alias("g"))
    give = F.struct(
        F.col("_gives").alias("k"), F.lit(1).alias("kind"), F.when(F.col("_last.k") == F.col("_gives"), F.col("_last.g")).alias("g")
    )
    # two rows per part: a table as short as the number of parts
    signs = edges.select("_part", F.explode(F.array(ask, give)).alias("s")).select("_part", "s.*")
    part = F.col("_part").desc() if forward else F.col("_part").asc()
    before = Window.partitionBy("k").orderBy(part, "kind").rowsBetween(Window.unboundedPreceding, -1)
    got = signs.withColumn("_carried", F.last("g", ignorenulls=True).over(before))
    return got.where((F.col("kind") == 0) & F.col("_carried").isNotNull()).select(
        F.col("_part").alias("_carry_part"), F.col("k").alias("_carry_key"), "_carried"
    )


def _with_carried(linked: DataFrame, carried: DataFrame, key: str) -> DataFrame:
    # the carried table has at most one row per part, whatever the input size
    same = (F.col("_part") == F.col("_carry_part")) & (F.col(key) == F.col("_carry_key"))
    return linked.join(F.broadcast(carried), same, "left")


def with_previous(df: DataFrame, key: str, time: str, order: Sequence[str] = ()) -> DataFrame:
    """Adds ``previous``, a struct of ``time`` and ``order`` of the row before.

    Rows of a key are ordered by ``time``, then ``order``. Rows without key or time belong
    to nobody and are dropped.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    dealt = _dealt(rows, [key, time, *order])
    position = F.struct(time, *order)
    linked = dealt.withColumn("_before", F.lag(position).over(Window.partitionBy("_part", key).orderBy(time, *order)))
    carried = _carried(dealt, key, position, position)
    return _with_carried(linked, carried, key).select(
        *df.columns, F.coalesce("_before", "_carried").alias("previous")
    )


def as_of(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    name: str = "match",
    direction: str = "backward",
    equal: bool = True,
) -> DataFrame:
    """Each row of ``left`` with ``name``: ``right_time`` and ``columns`` of the row of
    ``right`` with the same key that is latest at or before it (``backward``), or earliest
    at or after it (``forward``).

    ``equal=False`` leaves out rows at the very same time. Of rows of ``right`` at one time
    the one with the greatest ``columns`` counts (the smallest, forward). Rows of ``left``
    without key, time or match get NULL; rows of ``right`` without key or time match none.
    Both sides are stacked and dealt by ranges of key and time in one exchange.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction is backward or forward, not {direction!r}")
    forward = direction == "forward"
    found = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(right_time).alias("_time"), F.struct(right_time, *columns).alias("_found")
    )
    asked = left.select(F.col(key).alias("_key"), F.col(left_time).alias("_time"), F.struct(*left.columns).alias("_row"))
    there = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    # at equal times a match stands on the side of its seeker from which that looks
    first = equal != forward
    stacked = found.withColumn("_side", F.lit(0 if first else 1)).unionByName(
        asked.where(there).withColumn("_side", F.lit(1 if first else 0)), allowMissingColumns=True
    )
    dealt = _dealt(stacked, ["_key", "_time", "_side", "_found"])
    place = ["_time", "_side", "_found"]
    order = [F.col(c).desc() for c in place] if forward else [F.col(c) for c in place]
    inside = Window.partitionBy("_part", "_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    linked = dealt.withColumn("_inside", F.last("_found", ignorenulls=True).over(inside))
    carried = _carried(dealt, "_key", F.col("_found"), F.struct(*place), forward)
    matched = _with_carried(linked.where(F.col("_row").isNotNull()), carried, "_key").select(
        "_row", F.coalesce("_inside", "_carried").alias(name)
    )
    nothing = F.lit(None).cast(matched.schema[name].dataType)
    lost = asked.where(~there).select("_row", nothing.alias(name))
    return matched.unionByName(lost).select("_row.*", name)
