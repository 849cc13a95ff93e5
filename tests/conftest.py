import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("foldloom-tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def make_rows(spark):
    """``(row_id, text, label)`` rows with their order key."""
    from foldloom.operators.dedup import with_order_key

    def make(rows, partitions=None):
        df = spark.createDataFrame(rows, "row_id bigint, text string, label string")
        return with_order_key(df.repartition(partitions) if partitions else df)

    return make
