"""Exact deduplication with DataFrame operations only.

Texts are equal when they are identical without white space. Rows are grouped by the
128-bit hash of that normal form. The bytes are compared inside the hash groups: counting
rows by hash *and* form shows every hash that several forms share; should there be one, its
rows are grouped by the form as well. Copies collapse before every exchange, so a group with
a third of all rows is one row per task. The row with the most code points stays, then the
smallest id.

Null texts count as empty; all empty and white-space texts are one group. Null ids sort
behind others. Rows alike in id and text are one document: ``decide`` gives each of them the
same decision, ``keep`` returns one of them. Further columns pass through ``keep``; the
helper columns start with ``_dedup``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import stored, text_of

BLANKS = " \t\n\x0b\x0c\r"
KEY = ["_dedup_hash", "_dedup_form"]


def normal_form(text: Column) -> Column:
    """The text without white space."""
    return F.translate(text, BLANKS, "")


def content_hash(form: Column) -> Column:
    """128 bits of the normal form."""
    return F.unhex(F.md5(form))


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``docs`` with the length in code points, the hash and the form."""
    text = text_of("text")
    form = normal_form(text)
    return docs.withColumns(
        {"_dedup_n": F.length(text), "_dedup_hash": digest(form), "_dedup_form": form}
    )


def shared_hashes(rows: DataFrame) -> DataFrame:
    """The hashes that more than one form has, by comparing the forms themselves."""
    forms = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_dedup_rows"))
    return forms.groupBy("_dedup_hash").agg(F.count(F.lit(1)).alias("_dedup_forms")).where("_dedup_forms > 1")


def _classed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Rows with the key of their class: the hash, and the form only where a hash is shared."""
    rows = _keyed(docs, digest)
    shared = stored(shared_hashes(rows).select("_dedup_hash"), "shared-hashes")
    if shared.isEmpty():
        return rows.withColumn("_dedup_form", F.lit(None).cast("string"))
    return (
        rows.join(shared.withColumn("_dedup_shared", F.lit(True)), "_dedup_hash", "left")
        .withColumn("_dedup_form", F.when(F.col("_dedup_shared"), F.col("_dedup_form")))
        .drop("_dedup_shared")
    )


def _best(rows: DataFrame) -> DataFrame:
    """Size of each class and the row that stays: longest, then smallest id."""
    order = F.struct(
        F.col("_dedup_n").alias("n"), F.col("doc_id").isNotNull().alias("named"), (-F.col("doc_id")).alias("id")
    )
    return rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("group_size"), F.max(order).alias("_dedup_best")
    )


def _same(left: DataFrame, right: DataFrame) -> Column:
    form = left["_dedup_form"].eqNullSafe(right["_dedup_form"])
    return (left["_dedup_hash"] == right["_dedup_hash"]) & form


def decide(docs: DataFrame, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    small = stored(
        _classed(docs.select("doc_id", "text"), digest).select(
            "doc_id", "_dedup_n", *KEY, F.sha2(normal_form(text_of("text")), 256).alias("text_sha256")
        ),
        "dedup-keys",
    )
    best = _best(small)
    rows = small.alias("r").join(best.alias("b"), _same(small.alias("r"), best.alias("b")))
    winner = F.col("_dedup_best")
    return rows.select(
        F.col("doc_id"),
        (-winner["id"]).alias("keep_id"),
        F.col("group_size"),
        ((F.col("_dedup_n") == winner["n"]) & F.col("doc_id").eqNullSafe(-winner["id"])).alias("kept"),
        F.col("text_sha256"),
    )


def keep(docs: DataFrame, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns.

    The texts meet the short list of winners by id, not by hash, so a large class does not
    meet in one task.
    """
    rows = _classed(docs, digest)
    winners = _best(rows.select("doc_id", "_dedup_n", *KEY)).select(
        *[F.col(k).alias(f"{k}_w") for k in KEY],
        (-F.col("_dedup_best.id")).alias("_dedup_id"),
        F.col("_dedup_best.n").alias("_dedup_len"),
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("_dedup_id"))
        & (F.col("_dedup_n") == F.col("_dedup_len"))
        & (F.col("_dedup_hash") == F.col("_dedup_hash_w"))
        & F.col("_dedup_form").eqNullSafe(F.col("_dedup_form_w"))
    )
    return rows.join(winners, same, "left_semi").dropDuplicates(KEY).select(*docs.columns)


#: the same result by a plain grouping of the texts themselves
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS form
  FROM documents),
r AS (
  SELECT doc_id, form,
         first_value(doc_id) OVER (PARTITION BY form ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY form) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(form) AS text_sha256 FROM r
"""
