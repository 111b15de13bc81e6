import subprocess
import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import suite_pipelines
from tablewright.functions import scalars
from tablewright.operators import catalog
from tablewright.sources import databases, jdbc, reconcile
from tablewright.streaming import sync

from tests.conftest import rows

ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture
def db():
    return suite_pipelines.derby("db")


def made(spark, db):
    """A parent and a child table with keys, defaults and indexes."""
    jdbc.execute(spark, db, [
        "CREATE TABLE place (id INT NOT NULL PRIMARY KEY, label VARCHAR(20))",
        "INSERT INTO place VALUES (1, 'x'), (2, 'y')",
        "CREATE TABLE visit (k BIGINT NOT NULL, part INT NOT NULL, label VARCHAR(30) DEFAULT 'none', paid DECIMAL(9,2), place INT REFERENCES place (id), note CLOB, PRIMARY KEY (k, part))",
        "CREATE INDEX visit_label ON visit (label, paid)",
        "CREATE UNIQUE INDEX visit_paid ON visit (paid)",
        "INSERT INTO visit VALUES (1, 1, 'a', 1.50, 1, 'n'), (1, 2, NULL, 2.50, NULL, 'n'), (2, 1, 'a', NULL, 2, NULL)",
    ])


def test_structure(spark, db):
    made(spark, db)
    found = databases.structure(spark, db, "visit")
    assert [(c.name, c.type, c.nullable) for c in found.columns][:4] == [("K", "BIGINT", False), ("PART", "INTEGER", False), ("LABEL", "VARCHAR(30)", True), ("PAID", "DECIMAL(9,2)", True)]
    assert found.column("LABEL").default == "'none'" and found.primary_key == ("K", "PART")
    assert {(i.name, i.columns, i.unique) for i in found.indexes} == {("VISIT_LABEL", ("LABEL", "PAID"), False), ("VISIT_PAID", ("PAID",), True)}
    assert [(r.columns, r.target.table, r.target_columns) for r in found.references] == [(("PLACE",), "PLACE", ("ID",))]
    assert databases.structure(spark, db, "place").referred_by == ("VISIT",)
    with pytest.raises(ValueError, match="no table"):
        databases.structure(spark, db, "absent")
    assert databases.resolve(spark, db, '"Odd"').table == "Odd" and databases.resolve(spark, db, "other.t") == databases.Name("OTHER", "T")


def test_columns_and_statistics(spark, db):
    made(spark, db)
    found = {(r.lib_table, r.lib_column): r for r in databases.catalog_of(spark, db, "mine").collect()}
    assert len(found) == 8
    r = found["VISIT", "LABEL"]
    assert (r.count_table, r.count_null, round(r.null_ratio), r.count_distinct, r.is_index, r.index_name, r.primarykey) == (3, 1, 33, 1, True, "VISIT_LABEL", False)
    assert found["VISIT", "NOTE"].count_distinct == 1 and found["VISIT", "K"].primarykey and not found["VISIT", "K"].uniquekey
    assert found["PLACE", "ID"].uniquekey and found["VISIT", "PAID"].uniquekey
    assembled = catalog.assemble(databases.catalog_of(spark, db, "mine"), "covidom")
    assert assembled.table.count() == 2 and assembled.column.count() == 8
    empty = suite_pipelines.derby("none")
    assert databases.catalog_of(spark, empty, "mine").count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_aggregates_are_the_databases_work(spark, db):
    made(spark, db)
    visits = databases.table(spark, db, "visit")
    assert "PushedAggregates: [COUNT(*), COUNT(LABEL), MAX(PAID)]" in plan(visits.agg(F.count("*"), F.count("LABEL"), F.max("PAID")))
    jdbc.execute(spark, db, ["CREATE TABLE logged (id INT, a TIMESTAMP, b TIMESTAMP)", "INSERT INTO logged VALUES (1, '2020-01-01 00:00:00', '2020-03-01 12:00:00'), (2, '2020-02-01 00:00:00', NULL)"])
    newest = sync.watermark(databases.table(spark, db, "logged"), ["A", "B"])
    assert "PushedAggregates: [MAX(A), MAX(B)]" in plan(newest) and str(newest.first().date_max) == "2020-03-01 12:00:01"
    place = sync.Place("jdbc", database={"url": db.url, "driver": db.driver})
    assert sync.date_max(spark, place, sync.TableJob("logged", "logged", date_fields=("A", "B"))) == "2020-03-01 12:00:01"


def test_ddl(spark, db):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.VarcharType(40)), T.StructField("amount", T.DecimalType(12, 3)), T.StructField("day", T.DateType()), T.StructField("at", T.TimestampType()), T.StructField("ok", T.BooleanType()), T.StructField("raw", T.BinaryType()), T.StructField("x", T.DoubleType())])
    databases.create_table(spark, db, "t", schema, ["id"])
    databases.create_table(spark, db, "t", schema, ["id"])  # there already
    assert databases.exists(spark, db, "t") and databases.is_empty(spark, db, "t") and databases.table_names(spark, db) == ["T"]
    assert databases.structure(spark, db, "t").primary_key == ("id",)
    assert databases.table(spark, db, "t").schema["amount"].dataType == T.DecimalType(12, 3)
    jdbc.append_once(spark.createDataFrame([(1, "a")], "id long, name string"), db, "t")
    databases.copy_structure(spark, db, "t", "u")
    assert databases.structure(spark, db, "u").primary_key == ("id",) and databases.is_empty(spark, db, "u") and not databases.is_empty(spark, db, "t")
    databases.rename(spark, db, "u", "v")
    assert databases.table_names(spark, db) == ["T", "V"]
    databases.truncate(spark, db, "t")
    assert databases.is_empty(spark, db, "t")
    databases.drop(spark, db, "v")
    databases.drop(spark, db, "v")
    assert not databases.exists(spark, db, "v") and not jdbc.table_exists(spark, db, "v")


def test_swap_keeps_the_structure(spark, db):
    made(spark, db)
    before = databases.structure(spark, db, "visit")
    new = spark.createDataFrame([(5, 1, None, "9.25", 2), (6, 1, "b", "7.00", None)], "K long, PART int, LABEL string, PAID string, PLACE int").withColumn("PAID", F.col("PAID").cast("decimal(9,2)")).withColumn("NOTE", F.lit("n")).withColumn("MORE", F.lit(7))
    for _ in range(2):
        jdbc.swap_table(new, db, "visit")
        after = databases.structure(spark, db, "visit")
        assert after.columns[:6] == before.columns and after.columns[6].name == "MORE"
        assert (after.primary_key, after.indexes, after.references) == (before.primary_key, before.indexes, before.references)
    assert jdbc.read_query(spark, db, "SELECT * FROM visit").count() == 2
    for wrong in ("INSERT INTO visit (k, part) VALUES (5, 1)", "INSERT INTO visit (k, part, paid) VALUES (9, 9, 9.25)", "INSERT INTO visit (k, part, place) VALUES (9, 9, 77)"):
        with pytest.raises(Exception):
            jdbc.execute(spark, db, [wrong])
    jdbc.execute(spark, db, ["INSERT INTO visit (k, part) VALUES (9, 9)"])
    assert jdbc.read_query(spark, db, "SELECT label FROM visit WHERE k = 9").first()[0] == "none"
    with pytest.raises(Exception):  # rows that break the key leave the table as it is
        jdbc.swap_table(new.union(new), db, "visit")
    assert jdbc.read_query(spark, db, "SELECT * FROM visit").count() == 3
    with pytest.raises(ValueError, match="refer"):
        jdbc.swap_table(spark.createDataFrame([(1, "z")], "ID int, LABEL string"), db, "place")
    jdbc.swap_table(new.drop("PART", "PAID"), db, "visit")  # what has lost its columns goes
    left = databases.structure(spark, db, "visit")
    assert left.primary_key == () and left.indexes == () and left.references


def test_full_load_is_one_transaction(spark, db):
    made(spark, db)
    jdbc.execute(spark, db, ["DROP INDEX visit_paid"])  # it takes one null only
    same = spark.createDataFrame([(1, 1, "p"), (2, 1, None)], "K long, PART int, LABEL string")
    jdbc.load_table(same, db, "visit", jdbc.Load("full"))
    read = lambda: rows(jdbc.read_query(spark, db, "SELECT k, part, label FROM visit"))
    assert read() == [(1, 1, "p"), (2, 1, None)]
    with pytest.raises(Exception):  # breaks the key
        jdbc.load_table(same.union(same), db, "visit", jdbc.Load("full"))
    with pytest.raises(ValueError, match="too long"):
        jdbc.load_table(same.withColumn("LABEL", F.repeat(F.lit("x"), 31)), db, "visit", jdbc.Load("full"))
    assert read() == [(1, 1, "p"), (2, 1, None)]


RETRY = """
import tempfile
from pyspark import TaskContext
from pyspark.sql import SparkSession
from tablewright import suite_pipelines
from tablewright.sources import jdbc

scratch = tempfile.mkdtemp(prefix="spark-")
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", scratch).config("spark.sql.warehouse.dir", scratch).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
db = suite_pipelines.derby("retry")
jdbc.BATCH = 10
# each batch is kept as it is written, as after an executor that is lost behind its commit
db = jdbc.Database(db.url, db.driver, more={"isolationLevel": "NONE"})
df = spark.range(0, 1000, 1, 4)

def failing(inner):
    def run(records):
        yield from inner(records)
        if TaskContext.get().partitionId() == 1 and TaskContext.get().attemptNumber() == 0:
            raise OSError("lost after writing")
    return run

jdbc.write_table(df.limit(0), db, "plain")
df.mapInArrow(failing(lambda r: r), "id long").write.format("jdbc").options(**db.options(), dbtable="plain", batchsize="10").mode("append").save()
plain = jdbc.read_query(spark, db, "SELECT * FROM plain").count()
marked = jdbc._marked
jdbc._marked = lambda kinds: failing(marked(kinds))
jdbc.append_once(df, db, "safe")
jdbc.append_once(df, db, "safe", replace=True)
safe = jdbc.read_query(spark, db, "SELECT * FROM safe")
print("COUNTS", plain, safe.count(), safe.distinct().count(), jdbc.table_exists(spark, db, "safe_tw_stage"))
spark.stop()
"""


def test_a_repeated_task_adds_no_row_twice():
    done = subprocess.run([sys.executable, "-c", RETRY], cwd=ROOT, env={**__import__("os").environ, "PYTHONPATH": str(ROOT)}, capture_output=True, text=True, timeout=300)
    counts = [line for line in done.stdout.splitlines() if line.startswith("COUNTS")]
    assert counts, done.stderr[-2000:]
    _, plain, safe, distinct, stage = counts[0].split()
    assert int(plain) > 1000 and (safe, distinct, stage) == ("1000", "1000", "False")


def test_append_of_nothing(spark, db):
    jdbc.append_once(spark.range(0), db, "few")
    assert jdbc.append_once(spark.range(3), db, "few") == 3 and jdbc.append_once(spark.range(0), db, "few", replace=True) == 0
    assert jdbc.read_query(spark, db, "SELECT * FROM few").count() == 0


def test_a_task_without_a_whole_attempt_is_an_error(spark, db, monkeypatch):
    jdbc.append_once(spark.range(3), db, "t")
    marked = jdbc._marked
    monkeypatch.setattr(jdbc, "_marked", lambda kinds: lambda records: (r.slice(0, r.num_rows - 1) for r in marked(kinds)(records) if r.num_rows > 1))
    with pytest.raises(RuntimeError, match="no whole attempt"):
        jdbc.append_once(spark.range(30), db, "t")
    assert jdbc.read_query(spark, db, "SELECT * FROM t").count() == 3


def snapshot(spark, n=20_000, key="id * 3"):
    return spark.range(n).selectExpr(f"{key} AS k", "id % 97 AS a", "CASE WHEN id % 5 = 0 THEN NULL ELSE id * 0.5 END AS b")


def changes(spark, df):
    """One per cent of the rows, close together, changed; one new row, one with a null swapped in."""
    new = df.withColumn("a", F.when(F.col("k").between(30_000, 30_600), F.col("a") + 1000).otherwise(F.col("a")))
    return new.union(spark.createDataFrame([(-5, 1, None), (None, 2, 1.5)], "k long, a long, b double").select(F.col("k"), F.col("a"), F.col("b").cast(new.schema["b"].dataType)))


def test_type_1_by_digests(spark):
    plain, quick = suite_pipelines.derby("plain"), suite_pipelines.derby("quick")
    before = snapshot(spark)
    load = jdbc.Load("scd1", ("k",), digest="digest")
    assert reconcile.load(before, quick, "t", load) == {"fetched": 0, "inserted": 20_000, "updated": 0}
    assert reconcile.load(before, quick, "t", load) == {"fetched": 0, "inserted": 0, "updated": 0}
    jdbc.load_table(before, plain, "t", jdbc.Load("megafull"))
    after = changes(spark, before)
    done = reconcile.load(after, quick, "t", load)
    assert (done["inserted"], done["updated"]) == (2, 201) and 201 <= done["fetched"] < 900
    jdbc.load_table(after, plain, "t", jdbc.Load("scd1", ("k",)))
    same = lambda db: rows(jdbc.read_query(spark, db, 'SELECT "k", "a", "b" FROM t'))
    assert same(quick) == same(plain)
    part = after.where("k BETWEEN 600 AND 660").withColumn("b", F.lit(7).cast(after.schema["b"].dataType))  # an increment
    assert reconcile.load(part, quick, "t", load)["updated"] == 21
    jdbc.load_table(part, plain, "t", jdbc.Load("scd1", ("k",)))
    assert same(quick) == same(plain)


def test_digests_see_every_change(spark):
    """Null against zero, values that change places, sums that cancel out."""
    a = spark.createDataFrame([(1, 1, None), (2, None, 1), (3, 5, 6), (4, 6, 5)], "k long, a long, b long")
    b = spark.createDataFrame([(1, None, 1), (2, 1, None), (3, 6, 5), (4, 5, 6)], "k long, a long, b long")
    db, load = suite_pipelines.derby("see"), jdbc.Load("scd1", ("k",), digest="d")
    reconcile.load(a, db, "t", load)
    done = reconcile.load(b, db, "t", load)
    assert done["updated"] == 4 and rows(jdbc.read_query(spark, db, "SELECT * FROM t"), "k", "a", "b") == rows(b)


def test_text_and_composite_keys(spark):
    db, load = suite_pipelines.derby("text"), jdbc.Load("scd1", ("k", "part"), digest="d")
    jdbc.execute(spark, db, ['CREATE TABLE t ("k" VARCHAR(20), "part" BIGINT, "v" BIGINT, "d" BIGINT, "own" VARCHAR(9) DEFAULT \'mine\')'])
    first = spark.range(50).selectExpr("concat('key ', id % 7) AS k", "id AS part", "id AS v")
    assert reconcile.load(first, db, "t", load) == {"fetched": 0, "inserted": 50, "updated": 0}
    jdbc.execute(spark, db, ["UPDATE t SET \"own\" = 'kept' WHERE \"part\" = 3"])
    second = first.withColumn("v", F.when(F.col("part") == 3, 99).otherwise(F.col("v")))
    assert reconcile.load(second, db, "t", load) == {"fetched": 50, "inserted": 0, "updated": 1}
    assert jdbc.read_query(spark, db, 'SELECT "v", "own" FROM t WHERE "part" = 3').first()[:] == (99, "kept")


def test_type_2_by_digests(spark):
    plain, quick = suite_pipelines.derby("plain2"), suite_pipelines.derby("quick2")
    before = snapshot(spark, 6000).withColumn("id", F.col("k") * 2)
    after = before.withColumn("id", F.col("id") + 1).withColumn("a", F.when(F.col("k").between(3000, 3200), F.lit(None)).otherwise(F.col("a")))
    at = F.lit("2020-01-01").cast("timestamp")
    load = jdbc.Load("scd2", ("k",), "id", "e", digest="d")
    assert reconcile.load(before, quick, "t", load)["inserted"] == 6000
    done = reconcile.load(after, quick, "t", load, at)
    assert done["inserted"] == done["closed"] == 67 and done["fetched"] < 400
    assert reconcile.load(after, quick, "t", load, at) == {"fetched": 0, "inserted": 0, "closed": 0}
    for some in (before, after):
        jdbc.load_table(some, plain, "t", jdbc.Load("scd2", ("k",), "id", "e"), at)
    same = lambda db: rows(jdbc.read_query(spark, db, 'SELECT "k", "id", "a", "b", "e" FROM t'))
    assert same(quick) == same(plain)
    with pytest.raises(ValueError):
        jdbc.Load("full", digest="d")


def test_bound_parameters(spark, db):
    spans = """SELECT '?' AS a, "?" -- ?
    /* ? */ , ? AS b, ? AS c"""
    assert jdbc.bound(spark, db, spans, ["x'?", 3]) == spans.replace(", ? AS b, ? AS c", ", 'x''?' AS b, 3 AS c")
    for wrong in ([], [1, 2, 3]):
        with pytest.raises(ValueError):
            jdbc.bound(spark, db, "SELECT ?, ?", wrong)
    with pytest.raises(ValueError):
        jdbc.literal(spark, db, float("nan"))
    with pytest.raises(TypeError):
        jdbc.literal(spark, db, [1])
    given = [True, -7, 1.5, 2e-9, Decimal("-12.340"), "é'", b"\x00\xff", date(2020, 2, 29), datetime(2020, 1, 2, 3, 4, 5, 678), jdbc.Null("DATE")]
    query = "SELECT " + ", ".join(f"? AS v{i}" for i in range(len(given))) + " FROM sysibm.sysdummy1"
    got = jdbc.read_bound(spark, db, query, given).first()
    assert list(got[:7]) == given[:7] and got[7] == given[7] and got[8] == given[8] and got[9] is None


def test_array_text_is_invertible(spark):
    odd = ["a,b", 'c"d', "", "null", "NULL", "{e}", "f\\\\g", "\\\\", '\\"', None, " h ", "i\nj", "}", '""', "\\n", "plain word"]
    flat = [odd, [], None, [None], [""], ["x" * 20_000 + '\\"' * 9_000]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(flat)], "i int, v array<string>")
    back = df.select("i", scalars.text_array(scalars.array_text(F.col("v")), "string").alias("v"))
    assert {r.i: r.v for r in back.collect()} == dict(enumerate(flat))
    kinds = "b array<binary>, n array<array<int>>, t array<array<string>>, d array<date>, m array<struct<x:int,y:string>>, deep array<array<array<int>>>, p map<string,int>"
    rows_ = [([b"\x00\\", None, b""], [[1, None], [], None, None, [3]], [["a,}", None, "{"], ['"'], None], [date(2020, 1, 1), None], [(1, "q"), None], [[[1], []], []], {"k": 1}), ([], [], [[]], None, [], None, None), (None, [None, None], [None], [], None, [], {})]
    nested = spark.createDataFrame(rows_, kinds)
    flat_text = scalars.to_flat_text(nested)
    assert {f.dataType.simpleString() for f in flat_text.schema} == {"string"}
    assert flat_text.first().n == "{{1,null},{},null,null,{3}}"
    assert scalars.from_flat_text(flat_text, nested.schema).collect() == nested.collect()
    with pytest.raises(ValueError):
        scalars.array_text(F.col("deep"), nested.schema["deep"].dataType)
    foreign = spark.createDataFrame([(r'{ a , "b \" c" ,NULL,"NULL"}',)], "v string")
    assert foreign.select(scalars.text_array(F.col("v"), "string")).first()[0] == ["a", 'b " c', None, "NULL"]


def test_arrays_and_structs_through_a_database(spark, db):
    df = spark.createDataFrame([(1, ["a,b", None], (1, "x"), [[1, 2], []]), (2, None, None, None)], "k long, w array<string>, s struct<a:int,b:string>, n array<array<int>>")
    jdbc.append_once(scalars.to_flat_text(df), db, "nested")
    back = scalars.from_flat_text(jdbc.read_query(spark, db, "SELECT * FROM nested"), df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
