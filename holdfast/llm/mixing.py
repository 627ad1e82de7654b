"""Mixing sources to target weights by weighted sampling with exponential keys.

Each document draws a key ``-ln(u) / weight`` from a hash of its id; in ascending order of
the keys this is a sample without replacement by weight (Efraimidis and Spirakis). A source
whose target is several times its size takes whole epochs first; the rest of its target is
filled from the front of that order, cut at the exact word.

Targets share ``ratio`` times all words by the weights of the sources; none exceeds ``cap``
times its source, the excess goes to the others by weight (the water level). The order is
never sorted as a whole: rows are dealt by ranges of (source, key, id, size, hash of the row) into
as many slices as the session has shuffle partitions, the totals of the slices give every
slice its start, and only a slice is sorted. Ranges are cut by a sample of the rows, so
slices are even for any weights; a source with a third of all rows is spread over a third of
them, and so are a third of all rows without id. DataFrame operations only.

The weight of a document (``quality_weight``) is the product of the share of its lines that
are no repeats, the share of its characters that are no digits or symbols, and its words up
to 20; unusual word lengths count a quarter. A caller with a better score, such as that of a
classifier, names its column.

Null texts have no words, a source without words has target 0. A null source is a source
of its own, ranked last. Equal keys follow id, size and the hash of the whole row. Repeated rows
are documents of their own: they lie next to each other in the order, and each takes its own
share. Very long texts are whole: the mix cuts one text per source, at a word. An empty
table gives an empty mix. All draws are functions of id and seed, so reruns agree. Columns
of ``docs`` pass through ``mix``; helper columns start with ``_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import SPACE, stored, text_of

#: characters that are no prose
SYMBOLS = "0123456789#*$%&|<>{}[]^~=_@+/\\"
#: weight of the worst document
LEAST_WEIGHT = 0.05
#: extra copies of one row that one row of the plan stands for
COPIES = 1000
#: weights of the sources by rank, repeated
WEIGHTS = (3, 1, 2)
BLANKS = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of words, as split by white space."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE + "+"))).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Weight of a document, from ``LEAST_WEIGHT`` to 1 (see above); ``size`` is its number of words."""
    chars, lines = F.length(text), F.split(text, "\n")
    prose = F.length(F.translate(text, SYMBOLS, ""))
    usual = F.when(F.try_divide(chars, size).between(3.0, 10.0), F.lit(1.0)).otherwise(F.lit(0.25))
    score = (
        F.coalesce(F.try_divide(prose, chars), F.lit(0.0))
        * (F.size(F.array_distinct(lines)) / F.size(lines))
        * (F.least(size, F.lit(20)) / F.lit(20.0))
        * usual
    )
    return F.greatest(score, F.lit(LEAST_WEIGHT))


def exponential_key(doc_id: Column, weight: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f"/{seed}")))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, ratio: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Target words of each source from ``_mix_source, source_size``.

    One row per source; their number is a matter of configuration, so they may be ordered
    in one task.
    """
    ranked = sizes.withColumn(
        "_mix_rank", F.row_number().over(Window.orderBy(F.col("_mix_source").asc_nulls_last()))
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((F.col("_mix_rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    most = F.lit(cap) * F.col("source_size")
    level = ranked.withColumns({"_mix_w": weight, "_mix_cap": most})
    order = Window.orderBy(F.col("_mix_cap") / F.col("_mix_w"), "_mix_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = level.withColumns(
        {
            "_mix_level": (
                F.lit(ratio) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_mix_cap").over(before), F.lit(0.0))
            )
            / F.sum("_mix_w").over(after),
            "_mix_k": F.row_number().over(order),
        }
    )
    fits = F.when(F.col("_mix_level") <= F.col("_mix_cap") / F.col("_mix_w"), F.col("_mix_k"))
    level = level.withColumn("_mix_first", F.min(fits).over(everything))
    water = F.max(F.when(F.col("_mix_k") == F.col("_mix_first"), F.col("_mix_level"))).over(everything)
    level = level.withColumn("_mix_water", water)
    return level.select(
        "_mix_source",
        "source_size",
        F.when(F.col("_mix_k") < F.col("_mix_first"), F.col("_mix_cap"))
        .otherwise(F.col("_mix_water") * F.col("_mix_w"))
        .alias("target"),
    )


def _row_hash(docs: DataFrame) -> Column:
    """Hash of all columns: rows of one hash are interchangeable."""
    fields = [c for name in docs.columns for c in (F.col(name), F.col(name).isNull())]
    return F.concat(F.hex(F.xxhash64(*fields)), F.md5(text_of("text")))


def _placed(docs: DataFrame, seed: int, ratio: float, cap: float, weight: str | None) -> DataFrame:
    """Id, source, size, hash and share of each row of ``docs``, without its text."""
    text = text_of("text")
    sized = docs.select(
        "doc_id", F.col("source").alias("_mix_source"), word_count(text).alias("size"), text.alias("_mix_text"),
        _row_hash(docs).alias("_mix_row"),
        (F.lit(None).cast("double") if weight is None else F.col(weight).cast("double")).alias("_mix_given"),
    )
    heavy = quality_weight(F.col("_mix_text"), F.col("size"))
    if weight is not None:
        heavy = F.greatest(F.coalesce(F.nanvl("_mix_given", F.lit(0.0)), F.lit(0.0)), F.lit(LEAST_WEIGHT))
    key = exponential_key(F.col("doc_id"), heavy, seed)
    # written before the ranges are cut: the sample must not read the texts once more
    keyed = stored(sized.select("doc_id", "_mix_source", "size", "_mix_row", key.alias("_mix_key")), "mix-keys")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["_mix_key", "doc_id", "size", "_mix_row"]
    # alike rows differ in nothing, so it is all the same which of them gets which number
    dealt = keyed.withColumn("_mix_nth", F.monotonically_increasing_id()).repartitionByRange(
        parts, "_mix_source", *order, "_mix_nth"
    )
    rows = stored(dealt.withColumn("_mix_slice", F.spark_partition_id()), "mix-slices")

    by = ["_mix_source", "_mix_slice"]
    slices = rows.groupBy(*by).agg(F.sum("size").alias("_mix_total"))
    targets = source_targets(
        slices.groupBy("_mix_source").agg(F.sum("_mix_total").alias("source_size")), ratio, cap
    ).withColumnRenamed("_mix_source", "_mix_of")
    running = Window.partitionBy("_mix_source").orderBy("_mix_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("_mix_before", F.coalesce(F.sum("_mix_total").over(running), F.lit(0)))
    starts = starts.join(targets, F.col("_mix_source").eqNullSafe(F.col("_mix_of"))).select(
        F.col("_mix_source").alias("_mix_s"), F.col("_mix_slice").alias("_mix_p"), "_mix_before", "source_size", "target"
    )
    placed = rows.join(
        starts, F.col("_mix_source").eqNullSafe(F.col("_mix_s")) & (F.col("_mix_slice") == F.col("_mix_p"))
    )
    inside = Window.partitionBy(*by).orderBy(*order, "_mix_nth").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("_mix_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    placed = placed.withColumns({"_mix_at": at, "epochs": epochs.cast("long")})
    budget = F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    extra = F.least(F.greatest(budget - F.col("_mix_at"), F.lit(0)), F.col("size"))
    return placed.withColumn("extra", extra)


def draw(
    docs: DataFrame, seed: int = 13, ratio: float = 1.5, cap: float = 2.0, weight: str | None = None
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` and how ``taken`` comes about:
    ``epochs`` whole copies and ``extra`` words of one more. ``weight`` names a column of
    ``docs`` to use in place of ``quality_weight``."""
    return _placed(docs, seed, ratio, cap, weight).select(
        "doc_id",
        F.col("_mix_source").alias("source"),
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"),
        "epochs",
        "extra",
    )


def mix(docs: DataFrame, seed: int = 13, weight: str | None = None) -> DataFrame:
    """The mixed documents with the columns of ``docs``: whole copies, and for the one
    document per source where the target ends its first words, joined by spaces."""
    partial = (F.col("extra") > 0) & (F.col("extra") < F.col("size"))
    choice = (
        _placed(docs, seed, 1.5, 2.0, weight)
        .groupBy("_mix_row")
        .agg(
            F.max("epochs").alias("_mix_epochs"),
            F.count(F.lit(1)).alias("_mix_n"),
            F.count_if((F.col("extra") > 0) & ~partial).alias("_mix_whole"),
            F.max(F.when(partial, F.col("extra"))).alias("_mix_cut"),
        )
        .withColumnRenamed("_mix_row", "_mix_of")
    )
    # met twice below
    choice = stored(choice, "mix-choice")
    rows = docs.withColumn("_mix_row", _row_hash(docs)).join(choice, F.col("_mix_row") == F.col("_mix_of"))
    # alike rows share what they take; all or none get an extra copy but where a target ends
    some = F.col("_mix_cut").isNotNull() | ((F.col("_mix_whole") > 0) & (F.col("_mix_whole") < F.col("_mix_n")))
    each = F.col("_mix_epochs") + F.when(~some & (F.col("_mix_whole") > 0), 1).otherwise(0)
    full = rows.select(*docs.columns, F.explode(F.array_repeat(F.lit(-1).cast("long"), each.cast("int"))).alias("_mix_cut"))
    # one row for each kind of row at a border, its extra copies in blocks
    border = (
        rows.where(some)
        .groupBy("_mix_row")
        .agg(
            F.first(F.struct(*docs.columns)).alias("_mix_doc"),
            F.first("_mix_whole").alias("_mix_whole"),
            F.first("_mix_cut").alias("_mix_cut"),
        )
        .select("_mix_doc.*", "_mix_whole", "_mix_cut")
    )
    blocks = F.expr(f"explode(sequence(0L, _mix_whole DIV {COPIES}))").alias("_mix_block")
    blocked = border.select("*", blocks).repartition(F.col("_mix_block"))
    left = F.least(F.col("_mix_whole") - F.col("_mix_block") * COPIES, F.lit(COPIES)).cast("int")
    copies = F.concat(
        F.array_repeat(F.lit(-1).cast("long"), left),
        F.when(F.col("_mix_block") == 0, F.array_compact(F.array("_mix_cut"))).otherwise(F.expr("array()").cast("array<bigint>")),
    )
    extra = blocked.select(*docs.columns, F.explode(copies).alias("_mix_cut"))
    out = full.unionByName(extra)
    cut = F.array_join(F.slice(F.split(F.btrim(text_of("text"), F.lit(BLANKS)), SPACE + "+"), F.lit(1), F.col("_mix_cut").cast("int")), " ")
    fields = {"text": F.when(F.col("_mix_cut") < 0, F.col("text")).otherwise(cut)}
    if "n_chars" in docs.columns:
        fields["n_chars"] = F.when(F.col("_mix_cut") < 0, F.col("n_chars")).otherwise(F.length(cut)).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(fields).select(*docs.columns)


def mixing_query(docs: DataFrame) -> DataFrame:
    return draw(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         length(coalesce(text, '')) AS chars, string_split(coalesce(text, ''), chr(10)) AS lines,
         length(translate(coalesce(text, ''), '0123456789#*$%&|<>{}[]^~=_@+/\', '')) AS prose
  FROM documents),
q AS (
  SELECT doc_id, source, size,
         greatest(coalesce(prose / nullif(chars, 0)::DOUBLE, 0) * (len(list_distinct(lines)) / len(lines)::DOUBLE)
                  * (least(size, 20) / 20.0::DOUBLE)
                  * CASE WHEN chars / nullif(size, 0)::DOUBLE BETWEEN 3 AND 10 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END,
                  0.05::DOUBLE) AS weight
  FROM d),
k AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/13'), 1, 12))::BIGINT + 0.5::DOUBLE)
             / 281474976710656::DOUBLE) / weight AS key
  FROM q),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
w AS (SELECT *, (CASE (rk - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::DOUBLE AS weight,
             2.0::DOUBLE * source_size AS most FROM r),
o AS (SELECT *, row_number() OVER (ORDER BY most / weight, rk) AS k,
             (1.5::DOUBLE * sum(source_size) OVER () -
              coalesce(sum(most) OVER (ORDER BY most / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY most / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w),
f AS (SELECT min(k) AS first FROM o WHERE level <= most / weight),
t AS (SELECT source, source_size,
             CASE WHEN k < first THEN most ELSE (SELECT level FROM o, f WHERE k = first) * weight END AS target
      FROM o, f),
p AS (SELECT k.doc_id, k.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
             coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + least(greatest(round(target)::BIGINT - epochs * source_size - pos, 0), size))::BIGINT AS taken
FROM p
"""
