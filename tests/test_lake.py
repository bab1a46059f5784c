import threading

import pytest
from pyspark.sql import functions as F

from firnlake import Lake, LakeReader, LakeWriter
from firnlake.errors import AlreadyExistsError, ConcurrentModificationError, ConstraintError, LakeError, MergeError, SchemaMismatchError, SchemaNotFoundError, SnapshotNotFoundError, TableNotFoundError, ViewNotFoundError


def ids(df):
    return sorted(r.id for r in df.collect())


def one(lake, i, name="x", value=0.0):
    return lake.spark.createDataFrame([(i, name, value)], "id int, name string, value double")


# ---- writes and their metadata


def test_append_commits_once_and_records_statistics(names):
    stats = {(r.data_file_id, r.column_name): r for r in names.column_stats("t").collect()}
    assert (stats[0, "id"].min_value, stats[0, "id"].max_value, stats[0, "id"].value_count, stats[0, "id"].null_count) == ("1", "10", 10, 0)
    row = names.store.rows("SELECT * FROM {table_stats}")[0]
    assert (row["record_count"], row["next_row_id"]) == (20, 20)
    assert [r.changes_made for r in names.snapshots().collect()][-1] == "inserted_into_table:1"
    assert names.snapshot().schema_version == 1 and names.snapshot().next_file_id == 2


def test_empty_append_commits_nothing_and_empty_overwrite_empties(names):
    before = names.version
    assert names.append(one(names, 1).limit(0), "t") is None and names.version == before
    names.overwrite(one(names, 1).limit(0), "t")
    assert names.read("t").count() == names.count("t") == 0 and names.version == before + 1


def test_columns_match_by_name_and_unknown_ones_fail(names):
    names.append(names.spark.sql("SELECT 1.5D AS VALUE, 77 AS Id"), "t")
    assert names.read("t", where="id = 77").first() == (77, None, 1.5)
    with pytest.raises(SchemaMismatchError):
        names.append(names.spark.sql("SELECT 1 AS other"), "t")


def test_overwrite_after_delete_counts_right(names):
    names.delete("t", "id <= 5")
    names.overwrite(one(names, 1), "t")
    assert names.count("t") == names.read("t").count() == 1


def test_a_failed_commit_leaves_no_files(names, tmp_path, monkeypatch):
    def files():
        return sorted(p for p in tmp_path.rglob("*.parquet"))

    before = files()
    monkeypatch.setattr(names.writer, "register", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        names.append(one(names, 1), "t")
    assert files() == before and names.read("t").count() == 20


def test_partitions_have_values_and_nulls(lake):
    df = lake.spark.createDataFrame([(1, "a/b"), (2, None), (3, "c"), (4, "a/b")], "id int, k string")
    lake.create_from(df, "p", ["k"])
    assert sorted(r.partition_value for r in lake.partition_values("p").collect()) == ["__NULL__", "a/b", "c"]
    assert lake.skipped_files("p", "k = 'c'") == 2
    assert ids(lake.read("p", where="k = 'a/b'")) == [1, 4] and ids(lake.read("p", where="k IS NULL")) == [2]


def test_nested_and_special_values_round_trip(lake):
    df = lake.spark.sql("SELECT array(1, null) AS a, named_struct('x', 1, 'Y', 'z') AS s, map('k', 2) AS m, X'00FF' AS b, CAST('NaN' AS DOUBLE) AS d, -0.0D AS z, '' AS e, CAST(null AS STRING) AS n, TIMESTAMP '2020-01-01 00:00:00' AS ts")
    lake.create_from(df, "n")
    assert str(lake.read("n").collect()) == str(df.collect())


# ---- time travel


def test_time_travel_and_its_errors(names):
    assert names.read("t", version=2).count() == 10
    assert names.read("t", timestamp=names.snapshot(2).snapshot_time).count() == 10
    for bad in ({"version": 999}, {"version": "x"}, {"timestamp": "1999-01-01"}, {"timestamp": "when"}, {"version": 1, "timestamp": "2099-01-01"}):
        with pytest.raises(SnapshotNotFoundError):
            names.read("t", **bad)
    with pytest.raises(TableNotFoundError):
        names.read("t", version=0)
    with pytest.raises(SchemaNotFoundError):
        names.read("nosuch.t")


# ---- row operations


def test_delete_is_three_valued_and_settles_positions(names):
    names.append(one(names, 99, None), "t")
    assert names.delete("t", "id = 12345") is None
    names.delete("t", "NOT (name = 'name_1')")  # a null name is not deleted
    assert ids(names.read("t")) == [1, 99]
    names.delete("t", "id >= 1")
    names.delete("t", "id >= 1")
    assert names.read("t").count() == names.count("t") == 0
    gone = names.store.rows("SELECT delete_count FROM {delete_file}")
    assert sum(r["delete_count"] for r in gone) == 21


def test_update_by_literal_and_expression(names):
    before = names.version
    names.update("t", {"value": F.col("value") + F.col("id"), "name": None}, "id = 3")
    assert names.version == before + 1 and names.read("t", where="id = 3").first() == (3, None, 33.0)
    assert names.update("t", {"name": "q"}, "id = 1000") is None
    assert names.count("t") == 20


def test_merge_clauses_in_order(names):
    source = names.spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (30, "c", 3.0), (None, "d", 4.0), (31, "e", -1.0)], "id int, name string, value double")
    m = names.merge("t").using(source).on("target.id = source.id")
    m.when_matched("source.id = 1").delete().when_matched("source.value > 5").update_all().when_not_matched("source.value > 0").insert_all().execute()
    rows = {r.id: r for r in names.read("t").collect()}
    assert 1 not in rows and rows[2].name == "name_2"  # matched, but no clause took it; nor is it inserted
    assert rows[30].name == "c" and rows[None].name == "d" and 31 not in rows


def test_merge_is_checked(names):
    twice = one(names, 1).union(one(names, 1))
    with pytest.raises(MergeError):
        names.merge("t").using(twice).on("target.id = source.id").when_matched().update_all().execute()
    with pytest.raises(MergeError):
        names.merge("t").using(twice).on("target.id > source.id")
    with pytest.raises(MergeError):
        names.merge("t").using(twice).execute()
    before = names.version
    assert names.merge("t").using(twice.limit(0)).on("target.id = source.id").when_matched().delete().execute() is None
    assert names.version == before


# ---- changes


def test_changes_in_order_without_compaction(names):
    start = names.version
    names.update("t", {"name": "z"}, "id = 2")
    names.rewrite_data_files("t")
    names.overwrite(one(names, 5), "t")
    got = [(r._change_type, r.id) for r in names.changes("t", start).collect()]
    assert got[:2] == [("delete", 2), ("insert", 2)]
    assert sorted(got[2:]) == sorted([("delete", i) for i in range(1, 21)] + [("insert", 5)])
    assert names.changes("t", names.version).count() == 0


def test_changes_see_inlined_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "c.db"), inline_limit=10)
    lake.create_table("t", "id int")
    lake.append(spark.range(3).selectExpr("CAST(id AS INT) AS id"), "t")
    lake.delete("t", "id = 1")
    assert [(r.id, r._change_type) for r in lake.changes("t", 1).orderBy("_snapshot_id", "id").collect()] == [(0, "insert"), (1, "insert"), (2, "insert"), (1, "delete")]
    assert lake.files("t").count() == 0 and lake.count("t") == 2


# ---- schema


def test_columns_evolve_by_id(names):
    names.ddl.add_column("t", "extra", "VARCHAR", "old")
    names.ddl.rename_column("t", "name", "label")
    names.append(names.spark.sql("SELECT 50 AS id, 'fresh' AS extra"), "t")
    rows = {r.id: r for r in names.read("t").collect()}
    assert (rows[1].label, rows[1].extra) == ("name_1", "old") and rows[50].extra == "fresh"
    assert names.read("t", version=3).columns == ["id", "name", "value"]
    names.ddl.drop_column("t", "label")
    names.ddl.add_column("t", "label", "BIGINT")
    assert names.read("t", where="id = 1").first().label is None
    with pytest.raises(LookupError):
        names.ddl.drop_column("t", "nosuch")
    with pytest.raises(AlreadyExistsError):
        names.ddl.add_column("t", "ID", "INT")


def test_types_widen_only(names):
    names.ddl.alter_column_type("t", "id", "BIGINT")
    names.append(names.spark.sql("SELECT 5000000000L AS id"), "t")
    assert names.read("t", where="id > 19").count() == 2
    with pytest.raises(SchemaMismatchError):
        names.ddl.alter_column_type("t", "id", "VARCHAR")


def test_constraints_and_defaults(lake):
    lake.sql("CREATE TABLE t (id INT NOT NULL, name STRING DEFAULT 'none')")
    lake.append(lake.spark.sql("SELECT 1 AS id"), "t")
    assert lake.read("t").first() == (1, "none")
    with pytest.raises(ConstraintError):
        lake.append(lake.spark.sql("SELECT 'x' AS name"), "t")
    lake.ddl.add_constraint("t", "c", "not null", ["name"])
    assert [c["constraint_type"] for c in lake.ddl.constraints(lake.table("t"))] == ["NOT NULL"]
    with pytest.raises(ConstraintError):
        lake.update("t", {"name": None}, "id = 1")
    lake.ddl.drop_constraint("t", "c")
    lake.update("t", {"name": None}, "id = 1")
    with pytest.raises(ConstraintError):
        lake.ddl.drop_constraint("t", "c")


def test_schemas_tables_tags_and_views(names):
    names.ddl.create_schema("s")
    names.create_table("s.u", "a int")
    with pytest.raises(AlreadyExistsError):
        names.create_table("s.U", "a int")
    with pytest.raises(LakeError):
        names.ddl.drop_schema("s")
    names.ddl.set_tag("t", "comment", "first")
    names.ddl.set_tag("t", "comment", "second")
    names.ddl.set_tag("t", "unit", "cm", "value")
    assert names.ddl.tags(names.table("t")) == {"comment": "second"} and names.ddl.tags(names.table("t"), "value") == {"unit": "cm"}
    names.ddl.set_tag("t", "comment", None)
    with pytest.raises(LakeError):
        names.ddl.set_tag("t", "comment", None)
    names.ddl.create_view("v", "SELECT id FROM t WHERE id < 3")
    with pytest.raises(AlreadyExistsError):
        names.ddl.create_view("v", "SELECT 1")
    assert ids(names.view("v")) == [1, 2]
    names.ddl.drop_view("v")
    with pytest.raises(ViewNotFoundError):
        names.ddl.drop_view("v")
    names.ddl.drop_schema("s", cascade=True)
    assert names.ddl.schemas(names.version) == ["main"] and not names.table_exists("s.u")
    names.ddl.rename_table("t", "t2")
    names.append(one(names, 70), "t2")
    assert names.read("t2").count() == 21 and not names.table_exists("t")


# ---- files that are there, maintenance


def test_add_files_by_name_in_place(names, tmp_path):
    out = str(tmp_path / "ext")
    names.spark.sql("SELECT 'x' AS NAME, 100 AS Id, 2.0D AS value").coalesce(1).write.parquet(out)
    files = [str(p) for p in (tmp_path / "ext").glob("*.parquet")]
    names.add_files("t", files)
    names.ddl.rename_column("t", "name", "n2")
    names.ddl.add_column("t", "more", "INTEGER", 9)
    assert names.read("t", where="id = 100").first() == (100, "x", 2.0, 9)
    with pytest.raises(AlreadyExistsError):
        names.ddl.rename_column("t", "n2", "name") and names.ddl.drop_column("t", "more") and names.add_files("t", files)
    names.spark.range(1).coalesce(1).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(SchemaMismatchError):
        names.add_files("t", [str(p) for p in (tmp_path / "bad").glob("*.parquet")])


def test_compact_expire_vacuum(names, tmp_path):
    names.delete("t", "id > 15")
    names.rewrite_data_files("t")
    assert names.files("t").count() == 1 and names.rewrite_data_files("t") is None
    assert names.read("t", version=3).count() == 20
    assert names.expire_snapshots(1) == 0
    assert names.expire_snapshots(-1) == names.version  # all but the latest
    assert names.vacuum() == 3
    assert ids(names.read("t")) == list(range(1, 16))
    assert len(list(tmp_path.rglob("part-*.parquet"))) == 1


def test_row_changes_conflict_and_appends_do_not(names):
    info = names.table("t")
    names.append(one(names, 21), "t")
    with pytest.raises(ConcurrentModificationError):
        names.rows.delete(info, "id = 1")
    names.writer.append(one(names, 22), info)
    names.ddl.rename_column("t", "name", "n")
    with pytest.raises(ConcurrentModificationError):
        names.writer.append(one(names, 23), info)


def test_appends_of_many_threads_all_commit(names):
    errors = []

    def work(i):
        try:
            names.append(one(names, 100 + i), "t")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and names.read("t").count() == names.count("t") == 26


# ---- options, other databases, errors


def test_options_api(names):
    catalog = names.store.path
    LakeWriter(one(names, 40)).option("catalog", catalog).option("table", "t").mode("append").save()
    read = LakeReader(names.spark).option("catalog", catalog).option("table", "t")
    assert read.load().count() == 21 and read.option("snapshot_version", "2").load().count() == 10
    with pytest.raises(LakeError):
        LakeReader(names.spark).option("table", "t").load()


def test_duckdb_catalog(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "c.duckdb"))
    lake.create_from(spark.range(10).selectExpr("CAST(id AS INT) AS id"), "t")
    lake.delete("t", "id < 3")
    assert ids(lake.read("t", where="id < 5")) == [3, 4] and lake.count("t") == 7


def test_a_catalog_keeps_its_own_prefix(spark, tmp_path):
    path = str(tmp_path / "c.db")
    Lake(spark, path, prefix="other_").create_table("t", "id int")
    assert Lake(spark, path, create=False).table("t").name == "t"
    with pytest.raises(LakeError):
        Lake(spark, str(tmp_path / "none.db"), create=False)


def test_small_frames_are_written_by_the_driver(lake, monkeypatch):
    import firnlake.operators.write as write
    from firnlake.plans.sqlfront import _parts

    lake.create_table("s", "a long, b double, c string, d decimal(10,2), e date, f timestamp, g boolean, h binary, i float, j timestamp_ntz")
    sql = "id AS a, CASE WHEN id = 3 THEN double('NaN') ELSE id / 2 END AS b, concat('é', id) AS c, CAST(id AS decimal(10,2)) AS d, date_add(date'2020-01-01', CAST(id AS int)) AS e, timestamp_seconds(id) AS f, id = 2 AS g, CAST('x' AS binary) AS h, CAST(id + 1 AS float) AS i, timestamp_ntz'2020-01-01 00:00:00' AS j"
    df = lake.spark.range(0, 10).selectExpr(*_parts(sql))
    lake.append(df, "s")
    small = lake.files("s").collect()
    assert len(small) == 1 and small[0].path.endswith("part-0.parquet") and small[0].record_count == 10
    monkeypatch.setattr(write, "DIRECT_ROWS", 0)
    lake.create_table("u", "a long, b double, c string, d decimal(10,2), e date, f timestamp, g boolean, h binary, i float, j timestamp_ntz")
    lake.append(df.coalesce(1), "u")
    assert sorted(map(str, lake.read("s").collect())) == sorted(map(str, lake.read("u").collect()))
    stats = [{r.column_name: (r.value_count, r.null_count, r.min_value, r.max_value, r.contains_nan) for r in lake.column_stats(n).collect()} for n in ("s", "u")]
    assert stats[0] == stats[1] and stats[0]["b"][2:] == (None, None, True) and stats[0]["a"] == (10, 0, "0", "9", False)
    assert lake.read("s").filter("b > 100").count() == 1  # NaN is the largest


def test_row_ids_go_on_after_an_overwrite(lake):
    lake.create_table("r", "a long")
    lake.append(lake.spark.range(5).toDF("a"), "r")
    lake.overwrite(lake.spark.range(3).toDF("a"), "r")
    assert [r["row_id_start"] for r in lake.store.rows("SELECT row_id_start FROM {data_file} ORDER BY data_file_id")] == [0, 5]


def test_null_is_refused_in_the_written_plan(lake):
    from pyspark.sql import functions as F

    lake.create_table("n", "a long not null, b string")
    big = lake.spark.range(0, 300_000).select(F.when(F.col("id") != 250_000, F.col("id")).alias("a"))
    for df in (big, big.filter("a IS NULL")):
        with pytest.raises(ConstraintError, match="a$"):
            lake.append(df, "n")
    assert lake.count("n") == 0 and not lake.files("n").collect()


def test_merge_opens_only_files_that_may_match(lake, monkeypatch):
    import firnlake.operators.rowops as rowops

    lake.create_table("m", "k int, v string")
    for i in range(4):
        lake.append(lake.spark.range(10 * i, 10 * i + 10).selectExpr("CAST(id AS int) AS k", "'old' AS v"), "m")
    source = lake.spark.createDataFrame([(12, "a and b"), (13, "x > y"), (500, "new")], "k long, v string")
    on = "target.k = source.k AND 'a and b' = 'a and b'"
    for few in (1000, 1):
        monkeypatch.setattr(rowops, "FEW_KEYS", few)
        m = lake.merge("m").using(source).on(on)
        assert len(m._files(source)) == (1 if few > 1 else len(lake.files("m").collect()) - 1)
        m.when_matched().update_all().when_not_matched("source.k < 0").insert_all().execute()
    assert sorted((r.k, r.v) for r in lake.read("m").filter("v <> 'old'").collect()) == [(12, "a and b"), (13, "x > y")] and lake.count("m") == 40
    with pytest.raises(MergeError):
        lake.merge("m").using(source).on("target.k = source.k OR target.v = source.v")


def test_columns_are_added_and_dropped_in_one_commit(lake):
    lake.create_table("c", "a int")
    before = lake.version
    lake.sql("ALTER TABLE c ADD COLUMNS (b INT NOT NULL, d STRING DEFAULT 'x, y' NOT NULL, e INT)")
    assert lake.version == before + 1 and [c.nullable for c in lake.table("c").columns] == [True, False, False, True]
    with pytest.raises(ConstraintError):
        lake.append(lake.spark.range(1).selectExpr("CAST(id AS int) AS a"), "c")
    lake.append(lake.spark.range(1).selectExpr("CAST(id AS int) AS a", "1 AS b"), "c")
    assert [tuple(r) for r in lake.read("c").collect()] == [(0, 1, "x, y", None)]
    with pytest.raises(ConstraintError):
        lake.sql("ALTER TABLE c ADD COLUMN f INT NOT NULL")
    with pytest.raises(LookupError):
        lake.sql("ALTER TABLE c DROP COLUMNS (b, zz)")
    assert [c.name for c in lake.table("c").columns] == ["a", "b", "d", "e"]
    lake.sql("ALTER TABLE c DROP COLUMNS IF EXISTS (b, zz, e)")
    assert [c.name for c in lake.table("c").columns] == ["a", "d"]
    at = lake.version
    lake.sql("ALTER TABLE c DROP COLUMN IF EXISTS zz")
    assert lake.version == at


def test_comments_in_sql_are_left_out(names):
    sql = "-- from nowhere; it's a comment\nSELECT id /* FROM t2, t3 */ FROM t -- where id > 3\nWHERE name <> '-- no comment' AND id < 3;"
    assert sorted(r.id for r in names.sql(sql).collect()) == [1, 2]


def test_a_store_that_only_hadoop_reads(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.only.link./in", f"file://{tmp_path}")
    lake = Lake(spark, str(tmp_path / "far.db"), "viewfs://only/in/data")
    lake.create_table("t", "a long, b string")
    lake.append(spark.range(10).selectExpr("id AS a", "concat('n', id) AS b"), "t")
    lake.append(spark.range(0, 500_000, numPartitions=2).selectExpr("id + 100 AS a", "'big' AS b"), "t")
    assert lake.count("t") == 500_010 and lake.read("t").filter("a < 5").count() == 5
    stats = [(r.min_value, r.max_value) for r in lake.column_stats("t").collect() if r.column_name == "a"]
    assert stats == [("0", "9"), ("100", "250099"), ("250100", "500099")]


def test_changes_of_inlined_rows_by_one_query(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "i.db"), str(tmp_path / "i"), inline_limit=10)
    lake.create_table("t", "a long")
    lake.append(spark.createDataFrame([(1,), (2,)], "a long"), "t")
    start = lake.version
    lake.append(spark.createDataFrame([(3,)], "a long"), "t")
    lake.delete("t", "a = 1")
    got = [(r.a, r._change_type, r._snapshot_id - start) for r in lake.changes("t", start).collect()]
    assert got == [(3, "insert", 1), (1, "delete", 2)]
