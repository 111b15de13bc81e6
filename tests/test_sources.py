import os
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import suite_pipelines
from tablewright.operators import schema
from tablewright.sources import csvio, jdbc, staging, tables
from tablewright.streaming import sync, upsert

from tests.conftest import rows

WANT = T.StructType([T.StructField("c1", T.IntegerType()), T.StructField("c2", T.IntegerType()), schema.optional("c3", T.IntegerType(), "123", False)])


def test_csv_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("c1,c2\n1,\n,1\n")
    (tmp_path / "b.csv").write_text("c2,c1\n,1\n1,\n")
    for name in ("a.csv", "b.csv"):
        assert rows(csvio.read_csv(spark, str(tmp_path / name), WANT)) == [(1, None, 123), (None, 1, 123)]
    (tmp_path / "bad.csv").write_text("c1,c2\n1,2,3\n")
    with pytest.raises(Exception, match="bad row"):
        csvio.read_raw(spark, str(tmp_path / "bad.csv")).collect()
    (tmp_path / "d.csv").write_text('c1|d\n1|02/03/2020\n')
    dated = T.StructType([T.StructField("c1", T.IntegerType()), T.StructField("d", T.DateType())])
    assert str(csvio.read_csv(spark, str(tmp_path / "d.csv"), dated, delimiter="|", date_format="dd/MM/yyyy").first().d) == "2020-03-02"
    assert csvio.headers(spark, str(tmp_path / "d.csv"), "|") == ["c1", "d"]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "k int, v string")
    csvio.export_one_file(df, str(tmp_path / "out.csv"))
    assert (tmp_path / "out.csv").read_text() == 'k,v\n1,"a ""b"", c"\n2,\n'
    csvio.export_one_file(df, str(tmp_path / "out.csv"), header=False)
    assert (tmp_path / "out.csv").read_text().startswith("1,")
    csvio.write_each_row(df, "k", "v", str(tmp_path / "each"))
    assert (tmp_path / "each" / "file=1.txt").is_dir()


def test_swap_survives_a_crash(spark, tmp_path):
    path = str(tmp_path / "t")
    staging.swap_in(spark.range(3), path)
    staging.swap_in(spark.read.parquet(path).union(spark.range(3, 5)), path)
    assert spark.read.parquet(path).count() == 5
    (tmp_path / "t").rename(tmp_path / "t.old")  # a swap died between its renames, the new table complete
    spark.range(7).write.parquet(f"{path}.new")
    assert tables.read(spark, str(tmp_path), "t").count() == 7
    staging.recover(spark, path)  # as the next writer does; readers leave everything where it is
    assert tables.read(spark, str(tmp_path), "t").count() == 7
    assert not (tmp_path / "t.old").exists()
    (tmp_path / "t").rename(tmp_path / "t.old")  # and with an incomplete new table
    (tmp_path / "t.new").mkdir()
    assert tables.read(spark, str(tmp_path), "t").count() == 7


def test_table_management(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_a")
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_b")
    ports = spark.createDataFrame([("NRT", 2.5), ("LHR", 5.0), ("ORD", None)], "code string, runways double")
    tables.save(ports, "tw_a.airports", partitions=2)
    tables.save(spark.table("tw_a.airports").where("runways > 2"), "tw_a.airports")
    tables.save(ports.limit(1), "tw_a.tmp_x")
    assert tables.copy_tables(spark, "tw_a", "tw_b") == ["airports"]
    assert rows(spark.table("tw_b.airports")) == [("LHR", 5.0), ("NRT", 2.5)]
    tables.create_table(spark, "tw_b.made", T.StructType([T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("b", T.DecimalType(38, 18))]))
    assert tables.is_empty(spark, "tw_b.made")
    tables.copy_structure(spark, "tw_a.airports", "tw_b.alike")
    assert tables.is_empty(spark, "tw_b.alike")
    tables.rename(spark, "tw_b.alike", "tw_b.named")
    assert tables.exists(spark, "tw_b", "named") and not tables.exists(spark, "tw_b", "alike")
    assert tables.move(spark, "tw_a.airports", "tw_b") == "`tw_b`.`airports`"
    assert not tables.exists(spark, "tw_a", "airports") and tables.exists(spark, "tw_b", "airports")
    tables.truncate(spark, "tw_b.airports")
    assert tables.is_empty(spark, "tw_b.airports")
    tables.drop(spark, "tw_b.made")
    tables.drop(spark, "tw_b.made")
    assert not tables.exists(spark, "tw_b", "made")
    assert tables.execute(spark, "SELECT ? AS a, ? AS b", [None, datetime(2020, 1, 1)]).first().a is None
    assert "airports" in tables.location(spark, "tw_b.airports")
    assert tables.table_names(spark, "tw_b", keep="^named") == ["named"]


def test_compaction(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("p"))
    df.repartition(5).write.partitionBy("p").parquet(str(tmp_path / "t"))
    assert tables.compact(spark, str(tmp_path), "t", 1, "p = 1")
    assert len(list((tmp_path / "t" / "p=1").glob("*.parquet"))) == 1 and len(list((tmp_path / "t" / "p=2").glob("*.parquet"))) > 1
    assert rows(tables.read(spark, str(tmp_path), "t").agg(F.sum("id"), F.count("*"))) == [(4950, 100)]
    assert not tables.compact(spark, str(tmp_path), "absent", 1)
    registry = spark.createDataFrame([(str(tmp_path), None, "t")], "path_table string, lib_database string, lib_table string")
    assert tables.compact_all(spark, registry, 2) == ["t"]


def test_key_ranges():
    for low, high, parts in ((0, 9, 3), (5, 5, 4), (-3, 100, 7), (0, 2, 10)):
        ranges = jdbc.key_ranges(low, high, parts)
        assert [v for a, b in ranges for v in range(a, b + 1)] == list(range(low, high + 1))
    assert jdbc.range_predicates("k", [(1, 2)]) == ["k >= 1 AND k <= 2", "k IS NULL"]


def test_text_ranges(spark):
    keys = ["pref_abbé", "pref_abc", "pref_0a", "pref_zzz", "p'q", None, "pref_abc", "pref_abcdefghiá"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    predicates = jdbc.text_predicates("k", jdbc.text_boundaries(df, "k", 3))
    assert len(predicates) > 3 and sum(df.where(p).count() for p in predicates) == len(keys)
    numbers = df.select(jdbc.range_number(F.col("k"), ["p", "pref_abc"]).alias("n"))
    assert sorted(r.n for r in numbers.where("n IS NOT NULL").collect()) == [1, 1, 1, 2, 2, 2, 2]


@pytest.fixture
def derby():
    return jdbc.Database("jdbc:derby:memory:tests;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver")


def test_jdbc(spark, derby):
    df = spark.createDataFrame([(i, i * 2) for i in range(50)] + [(None, 1)], "id int, v int")
    jdbc.write_table(df, derby, "tab", "overwrite")
    back = jdbc.read_query(spark, derby, "SELECT * FROM tab", 4, "id", 2)
    assert back.rdd.getNumPartitions() == 9 and rows(back) == rows(df)
    assert jdbc.query_schema(spark, derby, "SELECT * FROM tab").names == ["id", "v"]
    with pytest.raises(ValueError):
        jdbc.read_query(spark, derby, "SELECT * FROM tab", 4)
    jdbc.load_table(spark.createDataFrame([(0, 100), (99, 1)], "id int, v int"), derby, "tab", jdbc.Load("scd1", ("id",)))
    assert (0, 100) in rows(jdbc.read_query(spark, derby, "SELECT * FROM tab")) and jdbc.read_query(spark, derby, "SELECT * FROM tab").count() == 52
    assert not jdbc.table_exists(spark, derby, "nothing")
    for wrong in ({"kind": "x"}, {"kind": "scd1"}, {"kind": "scd2", "keys": ("a",)}):
        with pytest.raises(ValueError):
            jdbc.Load(**wrong)


def test_watermark_and_sync(spark, tmp_path):
    days = ["2016-02-01", "2017-01-01", "2018-01-01", "2019-01-01", "2019-06-01", "2020-01-14"]
    data = spark.createDataFrame([(i + 1, f"k{i}", f"d{i}", datetime.fromisoformat(d)) for i, d in enumerate(days)], "id int, pk2 string, details string, date_update timestamp")
    assert rows(sync.since(data, ["date_update"], "2019-03-01"), "id") == [(5,), (6,)]
    assert sync.since(data, ["date_update"], "").count() == 6
    assert sync.watermark(data.limit(0), ["date_update"]).first().date_max is None
    staging.swap_in(data, f"{tmp_path}/in/t")
    staging.swap_in(data.where("id <= 4").withColumn("details", F.lit("old")), f"{tmp_path}/out/t")
    text = f"source: {{format: parquet, path: '{tmp_path}/in'}}\ntarget: {{format: parquet, path: '{tmp_path}/out', load: scd1}}\ntables:\n- {{source_table: t, target_table: t, keys: [id, pk2], date_fields: [date_update], hash: false}}\n- {{source_table: t, target_table: u, load: full}}\n- {{source_table: absent, target_table: absent, active: false}}\n"
    assert sync.sync(spark, text) == {"t": "loaded", "u": "loaded", "absent": "inactive"}
    assert rows(tables.read(spark, f"{tmp_path}/out", "t"), "id", "details") == [(1, "old"), (2, "old"), (3, "old"), (4, "old"), (5, "d4"), (6, "d5")]
    assert sync.sync(spark, text)["t"] == "nothing new"
    assert "hash" in tables.read(spark, f"{tmp_path}/out", "u").columns
    with pytest.raises(ValueError):
        sync.Place("oracle")
    with pytest.raises(ValueError):
        sync.Place("parquet", load="never")


def test_catalog_sync(spark, tmp_path):
    s = "lib_database string, lib_schema string, lib_table string, lib_column string, order_column int"
    full = [("d", "omop", "a", "a_id", 1), ("d", "omop", "b", "a_id", 2)]
    conf = [{"name": "x", "strategy": "omop", "schemas": "omop"}, {"name": "off", "active": False}]
    for found in (full, full[:1]):
        assert sync.sync_catalog(spark, conf, str(tmp_path), lambda c, found=found: spark.createDataFrame(found, s)) == ["x"]
    assert rows(tables.read(spark, str(tmp_path), "meta_table"), "lib_table", "is_active") == [("a", True), ("b", False)]


def test_streaming_upsert(spark, tmp_path):
    s = "k int, at int, v string"
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (1, 2, "c")], s).write.parquet(f"{tmp_path}/in")
    run = lambda: upsert.upsert_stream(spark.readStream.schema(s).parquet(f"{tmp_path}/in"), str(tmp_path), "t", ["k"], "at", f"{tmp_path}/cp").awaitTermination()
    run()
    assert rows(tables.read(spark, str(tmp_path), "t"), "k", "v") == [(1, "c"), (2, "b")]
    spark.createDataFrame([(2, 5, "z"), (3, 1, "n")], s).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert rows(tables.read(spark, str(tmp_path), "t"), "k", "v") == [(1, "c"), (2, "z"), (3, "n")]


def test_readers_leave_a_write_alone(spark, tmp_path):
    where = str(tmp_path)
    staging.swap_in(spark.range(3), f"{where}/t")
    spark.range(5).write.parquet(f"{where}/t.new")  # another job is at this step
    assert tables.read(spark, where, "t").count() == 3 and os.path.exists(f"{where}/t.new")
    os.rename(f"{where}/t", f"{where}/t.old")  # between the two renames
    assert tables.exists(spark, where, "t") and tables.read(spark, where, "t").count() == 5
    assert sorted(os.listdir(where)) == ["t.new", "t.old"]
    staging.swap_in(spark.range(7), f"{where}/t")  # a writer tidies up
    assert tables.read(spark, where, "t").count() == 7 and os.listdir(where) == ["t"]


def test_a_save_that_died_between_its_renames(spark):
    spark.range(4).write.mode("overwrite").saveAsTable("halfway__old")
    tables.save_table(spark.range(6), "halfway")
    assert spark.table("halfway").count() == 6 and not spark.catalog.tableExists("halfway__old")


def test_compaction_keeps_partitions(spark, tmp_path):
    where = str(tmp_path)
    odd = spark.createDataFrame([(i, ["a:b/c", "x y", None, "50%"][i % 4]) for i in range(40)], "id long, kind string")
    odd.repartition(5).write.partitionBy("kind").parquet(f"{where}/t")
    want = sorted(map(str, odd.collect()))
    assert tables.compact(spark, where, "t", 1, "kind = 'a:b/c' or kind = '50%'")
    files = lambda: Counter(f.parent.name for f in tmp_path.glob("t/*/*.parquet"))
    few, many = sorted(files().values())[:2], sorted(files().values())[2:]
    assert few == [1, 1] and min(many) > 1
    assert sorted(map(str, tables.read(spark, where, "t").collect())) == want
    assert tables.compact(spark, where, "t", 2)
    assert list(files().values()) == [1] * 4
    assert sorted(map(str, tables.read(spark, where, "t").collect())) == want


def test_statements_are_one_transaction(spark):
    db = suite_pipelines.derby("transaction")
    three = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    jdbc.swap_table(three, db, "t")
    with pytest.raises(Exception):
        jdbc.execute(spark, db, ['DELETE FROM t WHERE "k" = 1', "DELETE FROM absent"])
    assert jdbc.read_query(spark, db, "SELECT * FROM t").count() == 3
    assert jdbc.execute(spark, db, [('DELETE FROM t WHERE "k" = ?', [2])]) == [1]
    left = jdbc.read_query(spark, db, "SELECT * FROM t")
    assert jdbc.merge_table(left, three.where("v <> 'c'").withColumn("v", F.upper("v")), db, "t", ["k"]) == [2, 2]
    assert {tuple(r) for r in jdbc.read_query(spark, db, "SELECT * FROM t").collect()} == {(1, "A"), (2, "B")}
    jdbc.write_table(three, db, "t_tw_old")  # left by a load that died
    jdbc.swap_table(three.limit(0), db, "t")
    assert jdbc.read_query(spark, db, "SELECT * FROM t").count() == 0
    assert not jdbc.table_exists(spark, db, "t_tw_old")


def test_files_of_rows_are_written_by_many_tasks(spark, tmp_path):
    """Also where the rows come in one partition."""
    rows = spark.range(40).coalesce(1).selectExpr("'n' || id AS name", "'row ' || id AS body")
    csvio.write_each_row(rows, "name", "body", str(tmp_path / "rows"))
    files = [f for f in (tmp_path / "rows").rglob("part-*")]
    assert len(files) == 40 and len({f.name.split("-")[1] for f in files}) > 4
    back = spark.read.schema("value string, file string").text(str(tmp_path / "rows"))
    assert {(r.file, r.value) for r in back.collect()} == {(f"n{i}.txt", f"row {i}") for i in range(40)}
