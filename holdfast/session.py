"""Session settings and durable intermediate results."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "holdfast", **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` overrides any setting."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a hot key is split even where that costs one more exchange
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # call sites per column expression cost more than building the plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Python workers import the functions of this package by name. A worker that was not
    started with the repository on its path gets the package from the driver.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="holdfast-code-"), "holdfast_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(top, "holdfast")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


_written: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, local runs and
    tests get a folder of their own; on a cluster each executor would write to its own disk
    and lose rows, so there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {context.master} share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="holdfast-"))
    return context.getCheckpointDir()


def _of(spark: SparkSession) -> list[str]:
    app = spark.sparkContext.applicationId
    if app not in _written:
        _written[app] = []
        # the JVM and its file systems outlive the session, which most programs stop first
        atexit.register(_remove, _written[app], spark._jvm, spark._jsc.hadoopConfiguration())
    return _written[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder, removed by ``release`` or when Python ends,
    also if the session was stopped before."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _of(spark).append(path)
    return path


def fresh_table(spark: SparkSession, name: str) -> str:
    """An unused name in the catalog, dropped by ``release``; its files lie in ``fresh_path``."""
    table = f"{name}_{uuid.uuid4().hex}"
    _tables.setdefault(spark.sparkContext.applicationId, []).append(table)
    return table


def release(spark: SparkSession) -> int:
    """Remove what this application has written to the shared folder and the catalog; how many tables."""
    for table in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return _remove(_of(spark), spark._jvm, spark._jsc.hadoopConfiguration())


def _remove(paths: list[str], jvm, conf) -> int:
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    done = len(paths)
    paths.clear()
    return done


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where several jobs follow on one expensive result. The table lies in
    shared storage, so losing an executor never means computing it again, and
    being columnar it gives each later job just the columns it needs.
    """
    path = fresh_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
