"""Quality rules with cross-document line frequency, with DataFrame operations only.

Every line is normalised (lower case, single spaces, trimmed) and hashed with 128 bits.
For each host (``source``) the operator counts in how many different documents a line
stands; copies of one text are one document. A line in more than ``least_documents`` documents and
more than ``share`` of the host's documents is boilerplate. A document that loses more than
``depleted`` of the words of its different lines with them is rejected. Base rules reject very short
and self-repeating texts.

Counts collapse per task before they are exchanged; lines are exchanged as hashes. A line
that a third of all documents has is first counted by line and document, then by line.

Null texts have no words; they and all texts below 20 words fail the base rules. A null
source is a host of its own. Copies and repeated rows get equal verdicts. Whole texts are
read. Further columns of ``docs`` pass through ``clean``; helper columns start with ``_rule``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import SPACE, stored, text_of
from holdfast.llm.mixing import BLANKS, word_count

WINDOW = 8
SYMBOLS = "#*$%&|<>"
LEAST_DOCUMENTS = 50
SHARE = 0.005
DEPLETED = 0.8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not again at each use inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that occur at least twice in the text."""

    def covered(positions: Column) -> Column:
        reach = F.transform(
            positions,
            lambda p, j: F.coalesce(F.least(F.get(positions, j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)),
        )
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    def repeated(ordered: Column) -> Column:
        marked = F.transform(
            ordered,
            lambda x, j: F.when(
                (x["k"] == F.get(ordered, j + 1)["k"])
                | F.coalesce((j > 0) & (x["k"] == F.get(ordered, F.greatest(j - 1, F.lit(0)))["k"]), F.lit(False)),
                x["i"],
            ),
        )
        return let(F.array_sort(F.array_compact(marked)), covered)

    def by_windows(windows: Column) -> Column:
        keys = F.transform(windows, lambda x: x["k"])
        return F.when(F.size(F.array_distinct(keys)) == F.size(windows), F.lit(0)).otherwise(
            let(F.array_sort(windows), repeated)
        )

    def by_hashes(h: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW),
            lambda i: F.struct(F.xxhash64(F.slice(h, i + 1, WINDOW)).alias("k"), i.alias("i")),
        )
        return F.when(F.size(h) > WINDOW, let(windows, by_windows)).otherwise(F.lit(0))

    return let(F.transform(words, lambda w: F.xxhash64(w)), by_hashes).cast("long")


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of the base rules and ``base_failed``."""
    text = text_of("text")
    bare = F.btrim(text, F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    counted = docs.withColumns(
        {
            "_rule_counts": let(
                words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))
            ),
            "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        }
    )
    counted = counted.withColumns(
        {"n_words": F.col("_rule_counts.n"), "n_repeat_words": F.col("_rule_counts.r")}
    ).drop("_rule_counts")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def normal_line(line: Column) -> Column:
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(BLANKS)), SPACE + "+", " "))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def document_lines(docs: DataFrame) -> DataFrame:
    """The different lines of each different text: host, hash of line and text, words."""
    text = text_of("text")
    lines = F.array_distinct(F.transform(F.split(text, "\n"), normal_line))
    rows = docs.select(
        F.col("source").alias("_rule_host"), text_key(text).alias("_rule_text"), F.explode(lines).alias("_rule_line")
    ).where("_rule_line <> ''")
    return (
        rows.select(
            "_rule_host",
            "_rule_text",
            text_key(F.col("_rule_line")).alias("_rule_hash"),
            word_count(F.col("_rule_line")).alias("_rule_words"),
        )
        .groupBy("_rule_host", "_rule_hash", "_rule_text")
        .agg(F.max("_rule_words").alias("_rule_words"))
    )


def frequent_lines(lines: DataFrame, docs: DataFrame, least_documents: int, share: float) -> DataFrame:
    """Host and hash of the lines above the limits."""
    hosts = (
        docs.select(F.col("source").alias("_rule_of"), text_key(text_of("text")).alias("_rule_text"))
        .distinct()
        .groupBy("_rule_of")
        .agg(F.count(F.lit(1)).alias("_rule_all"))
    )
    counts = lines.groupBy("_rule_host", "_rule_hash").agg(F.count(F.lit(1)).alias("_rule_documents"))
    above = counts.where(F.col("_rule_documents") > least_documents)
    return above.join(hosts, F.col("_rule_host").eqNullSafe(F.col("_rule_of"))).where(
        F.col("_rule_documents") > share * F.col("_rule_all")
    ).select(F.col("_rule_host").alias("_rule_fhost"), F.col("_rule_hash").alias("_rule_fhash"), "_rule_documents")


def _marked(docs: DataFrame, least_documents: int, share: float) -> DataFrame:
    """Lines of all texts, with the number of documents where they are above the limits."""
    lines = stored(document_lines(docs), "lines")
    frequent = frequent_lines(lines, docs, least_documents, share)
    same = F.col("_rule_host").eqNullSafe(F.col("_rule_fhost")) & (F.col("_rule_hash") == F.col("_rule_fhash"))
    return lines.join(frequent, same, "left")


def judge(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, share: float = SHARE, depleted: float = DEPLETED
) -> DataFrame:
    """``docs`` with the base counts, ``line_words`` and ``removed_words`` (words of the
    different lines, and of those above the limits), ``base_failed`` and ``kept``."""
    texts = (
        _marked(docs, least_documents, share)
        .groupBy("_rule_host", "_rule_text")
        .agg(
            F.sum("_rule_words").alias("_rule_line_words"),
            F.sum(F.when(F.col("_rule_documents").isNotNull(), F.col("_rule_words")).otherwise(0)).alias("_rule_removed"),
        )
        .withColumnsRenamed({"_rule_host": "_rule_h", "_rule_text": "_rule_t"})
    )
    based = base_rules(docs).withColumn("_rule_key", text_key(text_of("text")))
    same = F.col("source").eqNullSafe(F.col("_rule_h")) & (F.col("_rule_key") == F.col("_rule_t"))
    joined = based.join(texts, same, "left")
    joined = joined.withColumns(
        {
            "line_words": F.coalesce(F.col("_rule_line_words"), F.lit(0)),
            "removed_words": F.coalesce(F.col("_rule_removed"), F.lit(0)),
        }
    )
    lost = F.col("removed_words") > F.lit(depleted) * F.col("line_words")
    return joined.withColumn("kept", ~F.col("base_failed") & ~lost).drop(
        "_rule_h", "_rule_t", "_rule_key", "_rule_line_words", "_rule_removed"
    )


def clean(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, share: float = SHARE, depleted: float = DEPLETED
) -> DataFrame:
    """The documents that are kept, without their lines above the limits."""
    lost = (
        _marked(docs, least_documents, share)
        .where(F.col("_rule_documents").isNotNull())
        .groupBy("_rule_host", "_rule_text")
        .agg(F.collect_list("_rule_hash").alias("_rule_lost"))
        .withColumnsRenamed({"_rule_host": "_rule_h", "_rule_text": "_rule_t"})
    )
    judged = judge(docs, least_documents, share, depleted).where("kept")
    judged = judged.withColumn("_rule_key", text_key(text_of("text")))
    same = F.col("source").eqNullSafe(F.col("_rule_h")) & (F.col("_rule_key") == F.col("_rule_t"))
    left = F.filter(
        F.split(text_of("text"), "\n"),
        lambda line: ~F.array_contains(F.col("_rule_lost"), text_key(normal_line(line))),
    )
    joined = judged.join(lost, same, "left")
    return joined.withColumn(
        "text", F.when(F.col("_rule_lost").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    ).select(*docs.columns)


def rules_query(docs: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", "text", "source")
    return judge(slim).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "line_words",
        "removed_words",
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
l AS (
  SELECT DISTINCT source, t, lower(regexp_replace(trim(line, E' \t\n\x0b\x0c\r'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT source, t, unnest(string_split(t, chr(10))) AS line FROM d)),
n AS (SELECT * FROM l WHERE line <> ''),
h AS (SELECT source, count(DISTINCT t) AS docs FROM d GROUP BY source),
f AS (SELECT n.source, line, count(*) AS c FROM n GROUP BY n.source, line HAVING count(*) > 50),
g AS (SELECT f.source, f.line FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source WHERE c > 0.005::DOUBLE * docs),
x AS (SELECT n.source, n.t, sum(len(string_split(n.line, ' '))) AS line_words,
             sum(CASE WHEN g.line IS NULL THEN 0 ELSE len(string_split(n.line, ' ')) END) AS removed_words
      FROM n LEFT JOIN g ON n.source IS NOT DISTINCT FROM g.source AND n.line = g.line GROUP BY n.source, n.t),
p AS (SELECT doc_id, t, source, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) > 8),
q AS (SELECT doc_id, t, source, i, count(*) OVER (PARTITION BY doc_id, t, source, array_to_string(w[i:i+7], ' ')) AS c FROM p),
r AS (SELECT doc_id, t, source, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n
      FROM (SELECT doc_id, t, source, i, lead(i) OVER (PARTITION BY doc_id, t, source ORDER BY i) AS nxt FROM q WHERE c > 1)
      GROUP BY doc_id, t, source),
u AS (SELECT t, count(*) - count(DISTINCT line) AS n
      FROM (SELECT DISTINCT t, i, line FROM
             (SELECT t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i
              FROM (SELECT DISTINCT t FROM d)))
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY t),
b AS (SELECT d.doc_id, len(w)::BIGINT AS n_words,
             length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(u.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             coalesce(line_words, 0)::BIGINT AS line_words, coalesce(removed_words, 0)::BIGINT AS removed_words
      FROM d LEFT JOIN u ON d.t = u.t
             LEFT JOIN r ON d.doc_id = r.doc_id AND d.t = r.t AND d.source IS NOT DISTINCT FROM r.source
             LEFT JOIN x ON d.t = x.t AND d.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND NOT (removed_words > 0.8::DOUBLE * line_words) AS kept,
       line_words, removed_words
FROM b
"""
