import os

import pytest
from pyspark.sql import functions as F

from holdfast import session
from holdfast.functions.amounts import sample_std


def test_sample_std_of_a_billion_rows(spark):
    # half of 2 * 10**9 rows at 100 and half at 500: mean 300, spread 200
    n = 2 * 10**9
    row = spark.range(1).select(
        sample_std(F.lit(n), F.lit(300 * n), F.lit((100**2 + 500**2) // 2 * n)).alias("s"),
        sample_std(F.lit(2**62), F.lit(2**62), F.lit(2**62)).alias("zero"),
        sample_std(F.lit(1), F.lit(7), F.lit(49)).alias("one"),
    ).first()
    assert row["s"] == pytest.approx(200.0) and row["zero"] == 0.0 and row["one"] is None


def test_settled_tables_are_removed(spark):
    before = session.settle(spark.range(5))
    folder = session.fresh_path(spark, "x").rsplit("/", 1)[0]
    assert before.count() == 5 and any(f.startswith("settled-") for f in os.listdir(folder.removeprefix("file:")))
    assert session.release(spark) >= 1
    assert not any(f.startswith("settled-") for f in os.listdir(folder.removeprefix("file:")))


class Elsewhere:
    """A session on a cluster that names no shared folder."""

    class sparkContext:
        master = "spark://somewhere:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:
        @staticmethod
        def get(key, default):
            return default


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere)
