"""The lake's tables as a data source that Spark knows by name."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from firnlake.sources.format import FORMAT, _Reader, register, table_of


@pytest.fixture
def known(names):
    register(names.spark)
    return names


def options(lake, **more):
    return {"catalog": lake.store.path, "table": "t", **more}


def test_reads_what_the_lake_reads(known):
    known.delete("t", "id IN (3, 15)")
    known.ddl.rename_column("t", "name", "called")
    known.ddl.add_column("t", "more", "INTEGER", 7)
    df = known.spark.read.format(FORMAT).options(**options(known)).load()
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, known.read("t").collect())) and df.columns == ["id", "called", "value", "more"]
    assert df.filter("id > 12 AND called LIKE 'name_1%'").count() == 6
    old = known.spark.read.format(FORMAT).options(**options(known, snapshot_version="2")).load()
    assert old.count() == 10 and old.columns == ["id", "name", "value"]


def test_pushed_filters_choose_files(known, monkeypatch):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, Not, StringContains

    store, t = table_of(options(known))
    for filters, n in (([EqualTo(("id",), 3)], 1), ([GreaterThan(("id",), 5)], 2), ([GreaterThan(("id",), 15)], 1), ([In(("id",), (1, 20))], 2), ([IsNull(("name",))], 0), ([Not(IsNull(("name",)))], 2), ([StringContains(("name",), "9"), EqualTo(("id",), 99)], 0), ([StringContains(("name",), "9")], 2)):
        reader = _Reader(store, t, None)
        assert list(reader.pushFilters(filters)) == filters and len(reader.partitions()) == n, filters


def test_appends_and_overwrites(known):
    df = known.spark.range(100, 110, numPartitions=3).select(F.col("id").cast("int"), F.lit("x").alias("NAME"))
    df.write.format(FORMAT).options(**options(known)).mode("append").save()
    assert known.count("t") == 30 and known.read("t").filter("id >= 100 AND name = 'x' AND value IS NULL").count() == 10
    assert len(known.read("t").filter("id = 105").inputFiles()) == 1
    df.limit(2).write.format(FORMAT).options(**options(known)).mode("overwrite").save()
    assert sorted(r.id for r in known.read("t").collect()) == [100, 101]
    with pytest.raises(PySparkException):
        df.withColumn("unknown", F.lit(1)).write.format(FORMAT).options(**options(known)).mode("append").save()
