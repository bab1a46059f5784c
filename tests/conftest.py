import pytest
from pyspark.sql import SparkSession

from firnlake import Lake


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "catalog.db"), str(tmp_path / "da ta+é"))


@pytest.fixture
def names(lake):
    """A table of 20 rows (i, "name_i", 10 i) in two files of ten."""

    def rows(a, b):
        return lake.spark.createDataFrame([(i, f"name_{i}", i * 10.0) for i in range(a, b)], "id int, name string, value double")

    lake.create_table("t", "id int, name string, value double")
    lake.append(rows(1, 11), "t", files=1)
    lake.append(rows(11, 21), "t", files=1)
    return lake
