import pytest

from firnlake.errors import LakeError, TableNotFoundError
from firnlake.streaming.sink import commit_batch


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_statements(lake):
    lake.sql("CREATE SCHEMA IF NOT EXISTS lake.s")
    lake.sql("CREATE TABLE lake.s.t (id INT NOT NULL, `a name` STRING, v DECIMAL(6,2)) USING parquet PARTITIONED BY (id)")
    lake.sql("INSERT INTO lake.s.t VALUES (1, 'from x, y', 1.5), (2, 'it''s', 2.5)")
    lake.sql("INSERT INTO s.t (v, id) SELECT 9.25, 3")
    assert rows(lake.sql("SELECT id, `a name`, v FROM lake.s.t")) == [(1, "from x, y", pytest.approx(1.5)), (2, "it's", pytest.approx(2.5)), (3, None, pytest.approx(9.25))]
    lake.sql("ALTER TABLE s.t ADD COLUMNS (x BIGINT DEFAULT 7, y STRING)")
    lake.sql("ALTER TABLE s.t RENAME COLUMN x TO z")
    lake.sql("ALTER TABLE s.t DROP COLUMN y")
    lake.sql("ALTER TABLE s.t ALTER COLUMN id TYPE BIGINT")
    lake.sql("ALTER TABLE s.t SET TBLPROPERTIES ('owner' = 'me')")
    assert lake.ddl.tags(lake.table("s.t")) == {"owner": "me"}
    lake.sql("ALTER TABLE s.t UNSET TBLPROPERTIES ('owner')")
    lake.sql("UPDATE s.t SET z = z + id, `a name` = 'q' WHERE id >= 2")
    assert rows(lake.sql("SELECT id, z FROM s.t ORDER BY id")) == [(1, 7), (2, 9), (3, 10)]
    lake.sql("DELETE FROM s.t WHERE `a name` = 'q' AND id = 3")
    assert lake.sql("SELECT COUNT(*) FROM s.t").first()[0] == 2
    lake.sql("INSERT OVERWRITE s.t SELECT 8 AS id, 'w', 1, 2")
    assert rows(lake.sql("SELECT id, z FROM s.t")) == [(8, 2)]
    assert rows(lake.sql("SHOW TABLES IN lake.s")) == [("t",)]
    assert rows(lake.sql("SHOW NAMESPACES")) == [("main",), ("s",)]
    assert [r.col_name for r in lake.sql("DESCRIBE s.t").collect()] == ["id", "a name", "v", "z"]
    lake.sql("CREATE TABLE c AS SELECT id FROM s.t")
    lake.sql("DROP TABLE s.t")
    lake.sql("DROP TABLE IF EXISTS s.t")
    with pytest.raises(TableNotFoundError):
        lake.sql("DROP TABLE s.t")
    lake.sql("DROP SCHEMA s CASCADE")
    with pytest.raises(LakeError):
        lake.sql("GRANT ALL")


def test_queries(names):
    names.create_from(names.spark.sql("SELECT 1 AS id, 'one' AS word UNION ALL SELECT 25, 'more'"), "w")
    assert rows(names.sql("SELECT t.id, w.word FROM lake.main.t AS t LEFT JOIN main.w ON t.id = w.id WHERE t.id < 3")) == [(1, "one"), (2, None)]
    assert names.sql("SELECT COUNT(*) AS n FROM (SELECT id FROM t UNION SELECT id FROM w) u").first().n == 21
    assert names.sql("SELECT id FROM t VERSION AS OF 2 WHERE id > 5").count() == 5
    when = names.snapshot(2).snapshot_time
    assert names.sql(f"SELECT max(id) AS m FROM t TIMESTAMP AS OF '{when}'").first().m == 10
    assert names.sql("SELECT id FROM t WHERE id IN (SELECT id FROM w)").count() == 1
    assert names.sql("SELECT name FROM t x WHERE x.id = 4").first().name == "name_4"
    names.sql("CREATE OR REPLACE VIEW v AS SELECT id % 2 AS odd, count(*) AS n FROM t GROUP BY 1")
    assert rows(names.sql("SELECT * FROM v")) == [(0, 10), (1, 10)]
    assert rows(names.sql("WITH a AS (SELECT id FROM t WHERE id < 3) SELECT a.id FROM a JOIN t b ON a.id = b.id")) == [(1,), (2,)]


def test_merge_statement(names):
    names.spark.sql("SELECT 1 AS k, 'a' AS nm UNION ALL SELECT 99, 'b'").createOrReplaceTempView("news")
    names.sql("MERGE INTO main.t USING news AS s ON t.id = s.k WHEN MATCHED THEN UPDATE SET t.name = s.nm WHEN NOT MATCHED THEN INSERT (id, name) VALUES (s.k, s.nm)")
    got = {r.id: r.name for r in names.read("t").collect()}
    assert got[1] == "a" and got[99] == "b" and len(got) == 21


def test_a_replayed_batch_commits_once(names):
    df = names.spark.sql("SELECT 500 AS id")
    assert commit_batch(names, df, "t", "q", 7) is not None
    assert commit_batch(names, df, "t", "q", 7) is None
    assert commit_batch(names, df.limit(0), "t", "q", 8) is None
    assert names.read("t").count() == 21
    assert names.snapshots().orderBy("snapshot_id").tail(1)[0].commit_message == "Streaming write epoch 7"


def test_stream_out_resumes_and_leaves_out_compaction(names, tmp_path):
    out, point = str(tmp_path / "out"), str(tmp_path / "cp")

    def drain():
        names.read_stream("t").writeStream.format("parquet").option("path", out).option("checkpointLocation", point).trigger(availableNow=True).start().awaitTermination()
        return names.spark.read.parquet(out).count()

    assert drain() == 20
    names.rewrite_data_files("t")
    names.append(names.spark.sql("SELECT 77 AS id, 'n' AS name"), "t")
    assert drain() == 21


def test_small_files_of_a_stream_share_tasks(lake, tmp_path, monkeypatch):
    lake.create_table("s", "a long")
    for i in range(6):
        lake.append(lake.spark.range(i, i + 1).toDF("a"), "s")
    seen = []

    def batch(df, n):
        seen.append((df.rdd.getNumPartitions(), sorted(r.a for r in df.collect())))

    q = lake.read_stream("s").writeStream.foreachBatch(batch).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert seen == [(1, [0, 1, 2, 3, 4, 5])]
