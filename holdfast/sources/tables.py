"""Readers and writers: CSV and Parquet in; Parquet, CSV and JSON out."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from holdfast.functions.dates import moment
from holdfast.session import settle
from holdfast.sources.schemas import CANONICAL, schema

log = logging.getLogger(__name__)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (a glob is fine) matches anything, on any file system Spark can read."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A CSV file with header under the declared schema; free text may span lines."""
    return (
        spark.read.schema(schema(table))
        .option("header", True)
        .option("multiLine", table == "order_reviews")
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def read_csv_split(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """Good rows of a CSV file or folder, and its damaged records with the file they lie in.

    A record is damaged if it has too few or too many fields or a value that is not of the
    declared type; such a record would else come back with its bad values as NULL. The
    damaged ones, with what could be read of them, are written as a side table at once.
    """
    declared = schema(table)
    full = StructType([*declared, StructField("_damaged", StringType())])
    rows = (
        spark.read.schema(full)
        .option("header", True)
        .option("multiLine", table == "order_reviews")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_damaged")
        .csv(path)
    )
    good = rows.where(F.col("_damaged").isNull()).select(*declared.fieldNames())
    bad = rows.where(F.col("_damaged").isNotNull()).select(
        "*", F.input_file_name().alias("file")
    ).withColumnRenamed("_damaged", "record")
    return good, settle(bad)


def damage_counts(bad: DataFrame) -> DataFrame:
    """Damaged records per file."""
    return bad.groupBy("file").agg(F.count(F.lit(1)).alias("n_damaged"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, path):
        raise FileNotFoundError(f"{path} not found")
    return spark.read.parquet(path)


def load_raw(
    spark: SparkSession, folder: str, files: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """The raw tables found in ``folder`` by short name; a missing file is skipped with a message.

    ``files`` maps short names to file names. By default ``orders.csv`` and
    ``*_orders_dataset.csv`` are both recognised.
    """
    found = {}
    for name, table in CANONICAL.items():
        given = (files or {}).get(name)
        names = [given] if given else [f"{table}.csv", f"*_{table}_dataset.csv"]
        for candidate in names:
            path = f"{folder.rstrip('/')}/{candidate}"
            if _exists(spark, path):
                found[name] = read_csv(spark, path, table)
                break
        else:
            log.warning("Skipped %s: not found in %s", " or ".join(names), folder)
    return found


def empty(spark: SparkSession, name: str) -> DataFrame:
    """The table under its declared schema, without rows."""
    return spark.createDataFrame([], schema(CANONICAL[name]))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table; the feature table is partitioned by snapshot date."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def truncate_and_load(df: DataFrame, path: str, name: str) -> None:
    """Overwrite a raw table, keeping exactly its declared columns and types."""
    declared = schema(CANONICAL[name])
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in declared]
    df.select(*columns).write.mode("overwrite").parquet(path)


def save_as_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Materialise a derivation in the catalog."""
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(table)


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, order: Sequence[str] = ()) -> DataFrame:
    """Materialise ``df`` at ``path`` as a catalog table in buckets of ``key``, sorted in them.

    Tables with the same number of buckets of one key join and group by it without a shuffle.
    Rows reach their bucket by one exchange, so each bucket is one file per load.
    """
    rows = df.repartition(buckets, key)
    writer = rows.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, *order)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """NULL fields are kept, so every record has the same keys."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_snapshot(spark: SparkSession, path: str, snapshot: datetime) -> DataFrame:
    """One snapshot of a stored feature table; only its partition is read."""
    stored = read_parquet(spark, path).schema
    # a partition value is text on disk and would be read as a time with zone
    fields = [
        StructField(f.name, TimestampNTZType()) if f.name == "snapshot_date" else f for f in stored
    ]
    table = spark.read.schema(StructType(fields)).parquet(path)
    return table.where(F.col("snapshot_date") == moment(snapshot))


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A short report as one text file in ``path``."""
    lines = spark.createDataFrame([(text,)], "value STRING")
    lines.write.mode("overwrite").text(path)


def save_scenario(
    name: str,
    run_id: str,
    summary: DataFrame,
    folder: str,
    detail: DataFrame | None = None,
    parameters: Mapping | None = None,
) -> dict[str, str]:
    """Record a scenario run: its summary as JSON and the customers behind it as Parquet."""
    base = f"{folder.rstrip('/')}/scenario_{name}_{run_id}"
    stamped = summary.withColumn("run_id", F.lit(run_id)).withColumn(
        "parameters", F.lit(json.dumps(dict(parameters or {}), default=str, sort_keys=True))
    )
    write_json(stamped, f"{base}/summary")
    written = {"summary": f"{base}/summary"}
    if detail is not None:
        replace(detail, f"{base}/detail")
        written["detail"] = f"{base}/detail"
    return written
