from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import scalars
from tablewright.operators import catalog, profile, quality, schema, versioning
from tablewright.sources import jdbc

from tests.conftest import rows


def test_schema_application(spark):
    want = T.StructType([T.StructField("c1", T.IntegerType(), False), T.StructField("c2", T.IntegerType()), schema.optional("c3", T.IntegerType(), None), schema.optional("c4", T.StringType(), "x")])
    df = spark.createDataFrame([("2", "1", "?"), ("3", "bad", "?")], "c1 string, c2 string, other string")
    out = schema.apply_schema(df, want)
    assert rows(out) == [(2, 1, None, "x"), (3, None, None, "x")]
    assert not out.schema["c1"].nullable
    with pytest.raises(schema.SchemaError, match="c1, c2"):
        schema.apply_schema(df.select("other"), want)
    with pytest.raises(Exception, match="null in column c1"):
        schema.apply_schema(spark.createDataFrame([("x", "1")], "c1 string, c2 string"), want).collect()
    assert schema.mandatory_fields(want).names == ["c1", "c2"] and schema.optional_fields(want).names == ["c3", "c4"]
    dotted = spark.createDataFrame([(1, 2)], "`bob.jim` int, a int")
    assert schema.reorder(dotted, schema.string_schema(["bob.jim"])).columns == ["bob.jim"]


def test_cleaning(spark):
    df = spark.createDataFrame([(" b ", " ", 3), ("a\n", " c", 6)], "a string, b string, d int")
    assert rows(schema.trim_all(df)) == [("a", "c", 6), ("b", None, 3)]
    assert schema.normalize_names(df.toDF("Bob", "Ji mé", "(hi)")).columns == ["bob", "ji_me", "_hi_"]
    with pytest.raises(schema.SchemaError):
        schema.normalize_names(df.toDF("a", "A", "b"))
    assert rows(schema.remove_blank(df, "b"), "b") == [(" c",)]
    dates = spark.createDataFrame([("2020-01-02",), ("a\n",)], "t string")
    assert rows(dates.select(scalars.to_second(F.col("t"), "yyyy-MM-dd"))) == [(datetime(2020, 1, 2),), (None,)]
    assert schema.empty(spark, df.schema).count() == 0


def test_unions_and_pivot(spark):
    a, b = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), spark.createDataFrame([(4, 5, 6)], "a int, b int, d int")
    out = schema.union_missing(a, b)
    assert out.columns == ["a", "b", "c", "d"] and rows(out) == [(1, 2, 3, None), (4, 5, None, 6)]
    assert rows(schema.union_all([a, b.toDF("A", "B", "d")])) == [(1, 2, 3, None), (4, 5, None, 6)]
    p = spark.createDataFrame([(1, "bob", "so"), (2, "jim", "tore"), (2, None, "x")], "g int, k string, v string")
    assert rows(schema.pivot(p, ["g"], "k", F.first("v"), ["bob", "jim"])) == [(1, "so", None), (2, None, "tore")]
    assert schema.pivot(p, ["g"], "k", F.first("v")).columns == ["g", "bob", "jim"]


def test_sequence_and_duplicates(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") % 3).alias("v"))
    out = [tuple(r) for r in schema.with_sequence(df, "n", 10).orderBy("k").select("k", "n").collect()]
    assert out == [(i, 11 + i) for i in range(1000)]
    kept, gone = schema.remove_duplicates(df, "v")
    assert (kept.count(), gone.count()) == (3, 997)
    assert schema.with_sequence(df.limit(0), "n").count() == 0


def test_flat_text(spark):
    df = spark.createDataFrame([([1, None, 3], {"a": 1}, (1, "x"), "a\r\nb\rc"), (None, None, None, None), ([], {}, (None, None), "")], "l array<int>, m map<string,int>, s struct<a:int,b:string>, t string")
    flat = scalars.to_flat_text(df)
    assert [r.l for r in flat.collect()] == ["{1,null,3}", None, "{}"]
    assert flat.first().t == "a\nb\nc" and flat.first().m == '{"a":1}'
    back = scalars.from_flat_text(flat.select("l"), T.StructType([T.StructField("l", T.ArrayType(T.IntegerType()))]))
    assert [r.l for r in back.collect()] == [[1, None, 3], None, []]
    hashes = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    assert hashes.select(scalars.row_hash(F.col("a"), F.col("b"))).distinct().count() == 1
    assert hashes.select(scalars.row_digest(F.col("a"), F.col("b"))).distinct().count() == 2


STOCK = "sku long, shelf long, units long"


def test_scd1(spark):
    stock = spark.createDataFrame([(10, 1, 100), (20, 2, 200), (30, 3, None)], STOCK)
    counted = spark.createDataFrame([(10, 1, 100), (30, 3, 35), (40, 4, 0)], STOCK)
    assert rows(versioning.scd1(stock, counted, ["sku"])) == [(10, 1, 100), (20, 2, 200), (30, 3, 35), (40, 4, 0)]
    assert rows(versioning.scd1(None, counted, ["sku"])) == rows(counted)
    with pytest.raises(versioning.DuplicateKeys):
        versioning.scd1(stock, counted.union(counted), ["sku"])
    keyless = spark.createDataFrame([(None, 9, 9)], STOCK)
    assert versioning.scd1(keyless, keyless, ["sku"]).count() == 2
    assert versioning.scd1(keyless, keyless, ["sku"], null_safe=True).count() == 1
    emptied = spark.createDataFrame([(20, None, 200)], STOCK)  # a null counts as a change
    assert rows(versioning.scd1(stock, emptied, ["sku"]), "sku", "shelf") == [(10, 1), (20, None), (30, 3)]


def test_scd1_soft_delete_and_scope(spark):
    listed = spark.createDataFrame([(1, "lamp", "red", True), (2, "desk", "oak", True), (3, "sofa", "blue", False)], "id long, item string, finish string, listed boolean")
    offer = spark.createDataFrame([(1, "lamp", "green")], "id long, item string, finish string")
    out = versioning.scd1(listed, offer, ["item"], in_scope=F.col("item") != "sofa", set_unmatched={"listed": F.lit(False)})
    assert rows(out) == [(1, "lamp", "green", True), (2, "desk", "oak", False), (3, "sofa", "blue", False)]
    # a key outside the scope counts as absent and comes in again
    assert versioning.scd1(listed, offer, ["item"], in_scope=F.col("item") == "desk").count() == 4


def test_scd2(spark):
    closed_at, at = datetime(2018, 6, 30), datetime(2021, 3, 1)
    history = spark.createDataFrame([(100, "EUR", 1.10, closed_at), (101, "EUR", 1.20, None), (102, "USD", 1.00, None), (103, "GBP", 1.40, None)], "id long, unit string, rate double, until timestamp")
    today = spark.createDataFrame([(201, "EUR", 1.25), (202, "USD", 1.00), (203, "CHF", None)], "id long, unit string, rate double")
    out = versioning.scd2(history, today, ["unit"], "id", "until", F.lit(at))
    want = [(100, "EUR", 1.10, closed_at), (101, "EUR", 1.20, at), (102, "USD", 1.00, None), (103, "GBP", 1.40, None), (201, "EUR", 1.25, None), (203, "CHF", None, None)]
    assert rows(out) == want
    assert rows(versioning.scd2(out, today, ["unit"], "id", "until", F.lit(at))) == want


def test_merge_and_archive(spark):
    may, april, march = (spark.createDataFrame(r, STOCK) for r in ([(10, 1, 50), (20, 1, 60)], [(20, 1, 55), (30, 2, 70)], [(10, 9, 40), (30, 9, 65), (50, 9, 5)]))
    assert rows(versioning.archived(["sku"], may, april, march)) == [(10, 1, 50), (20, 1, 60), (30, 2, 70), (50, 9, 5)]
    sold = versioning.merge(march, april, ["sku"], mode="ud", delete_when=F.col("s.units") > 60)
    assert rows(sold) == [(10, 9, 40), (50, 9, 5)]
    assert rows(versioning.merge(may, april, ["sku"], mode="u")) == [(10, 1, 50), (20, 1, 55)]
    assert rows(versioning.merge(may, april, ["sku"], mode="d")) == [(10, 1, 50)]
    with pytest.raises(ValueError):
        versioning.merge(may, april, ["sku"], mode="x")


CHECKS = [quality.Field("str", required=True, unique=True, pattern="^v|_"), quality.Field("num", minimum=0, maximum=100)]


def failures(df, checks):
    return [r for r in quality.evaluate(df, checks) if not r.passed]


def test_constraints(spark):
    ok = spark.createDataFrame([("value", 42)], "str string, num int")
    assert quality.validate(ok, CHECKS) is ok
    bad = spark.createDataFrame([("value", 42), ("nope", -1), ("_", 42), ("_", 101), (None, 42)], "str string, num int")
    assert len(failures(bad, CHECKS)) == 5
    with pytest.raises(quality.ConstraintError) as e:
        quality.validate(bad, CHECKS)
    assert len(e.value.failed(fatal_only=True)) == 5
    soft = [quality.Field("num", minimum=0, fatal=False)]
    assert quality.validate(bad, soft) is bad
    assert not failures(bad, [quality.Field("num", minimum=0, maximum=100, ratio=0.6)])
    nan = spark.createDataFrame([(42.0,), (float("nan"),)], "num double")
    assert len(failures(nan, [quality.Field("num", noNan=True, maximum=100)])) == 2
    null = spark.createDataFrame([("a",), (None,)], "s string")
    assert not failures(null, [quality.Field("s", allowed=("a",))])
    assert not failures(ok.limit(0), CHECKS)


def test_constraint_yaml(monkeypatch, spark):
    text = "fields:\n- name: s\n  ratio: 0.5\n  allowed: [a, null]\n- name: n\n  minimum: 1\n"
    checks = quality.from_yaml(text)
    assert checks[0].allowed == ("a", "") and checks[1].minimum == 1.0
    assert quality.from_yaml(quality.to_yaml(checks)) == checks
    assert "fatal" not in quality.to_yaml(checks)
    with pytest.raises(ValueError, match="unknown"):
        quality.from_yaml("fields: [{name: a, wrong: 1}]")
    bad = spark.createDataFrame([("b", 0)], "s string, n int")
    with pytest.raises(quality.ConstraintError):
        quality.yaml_validator(text)(bad)
    monkeypatch.setenv(quality.SKIP, "1")
    assert quality.yaml_validator(text)(bad) is bad


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "n int, s string")
    assert rows(profile.profile(df)) == [("n", 3, 0, 0.0, 2, "1", "2"), ("s", 3, 1, pytest.approx(100 / 3), 2, "a", "b")]
    assert profile.profile(df.limit(0)).first().null_percent is None


def test_profile_forms_agree(spark):
    values = [(None, 0.0, "x.y"), (3, -0.0, None), (3, float("nan"), ""), (None, float("nan"), "x.y"), (-1, 2.5, "Z")] * 3
    df = spark.createDataFrame(values, "`a b` int, `v.w` double, n string")
    for some in (df, df.limit(0)):
        assert rows(profile.profile(some)) == rows(profile.profile(some, approximate=True))
    assert [(r.column_name, r.n_rows, r.n_null, r.n_distinct) for r in profile.profile(df).orderBy("column_name").collect()] == [("a b", 15, 6, 2), ("n", 15, 3, 3), ("v.w", 15, 0, 3)]
    assert profile.profile(df, ["n"]).first().max_value == "x.y"


def test_catalog_strategies(spark):
    cols = [("d", "omop", "person", "person_id", 1), ("d", "omop", "visit", "visit_id", 1), ("d", "omop", "visit", "person_id", 2), ("d", "omop", "concept", "concept_id", 1), ("d", "omop", "visit", "visit_concept_id", 3), ("d", "omop", "visit", "type_concept_id_2", 4)]
    df = spark.createDataFrame(cols, "lib_database string, lib_schema string, lib_table string, lib_column string, order_column int")
    c = catalog.assemble(df, "omop")
    assert rows(c.reference, "lib_table_source", "lib_column_source", "lib_table_target") == [("visit", "person_id", "person"), ("visit", "type_concept_id_2", "concept")][:1] + [("visit", "visit_concept_id", "concept")]
    assert c.table.count() == 3 and c.column.count() == 6 and c.database.count() == 1
    catalog.register("own", catalog.Strategy(references=catalog.equal_references))
    assert catalog.assemble(df, "own", "^x").column.count() == 0
    with pytest.raises(ValueError, match="edited"):
        catalog.override(df, df.select("lib_table", "lib_schema"), "lib_table", ["lib_column"])


def test_removed_rows_by_multiplicity(spark):
    many = spark.range(300).selectExpr("1 AS k", "id % 3 AS v", "CASE WHEN id % 2 = 0 THEN 'x' END AS `a b`").union(spark.createDataFrame([(2, 9, None), (None, 1, "q"), (None, 1, "q")], "k int, v long, s string"))
    kept, gone = schema.remove_duplicates(many, "k")
    assert rows(kept) == [(1, 0, None), (2, 9, None), (None, 1, "q")]
    assert sorted(map(str, kept.union(gone).collect())) == sorted(map(str, many.collect())) and gone.count() == 300
    plan = gone._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "exchange range" not in plan.lower()
    all_columns = schema.remove_duplicates(many)
    assert all_columns[0].count() == 8 and all_columns[1].count() == 295


def test_pivot_levels_are_bounded(spark):
    df = spark.range(20).selectExpr("id % 2 AS g", "concat('k', id) AS k", "id AS v")
    assert len(schema.pivot(df, ["g"], "k", F.max("v"), most=20).columns) == 21
    with pytest.raises(schema.SchemaError, match="more than 19"):
        schema.pivot(df, ["g"], "k", F.max("v"), most=19)


def test_missing_fields_and_key_kinds():
    have = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    want = T.StructType([T.StructField("b", T.StringType()), T.StructField("c", T.IntegerType()), schema.optional("d", T.DateType(), None)])
    assert schema.missing_fields(have, want).names == ["c", "d"] and schema.missing_fields(want, want).names == []
    kinds = T.StructType([T.StructField(n, t) for n, t in (("s", T.StringType()), ("l", T.LongType()), ("i", T.IntegerType()), ("h", T.ShortType()), ("d", T.DecimalType(9, 0)), ("x", T.DoubleType()), ("t", T.TimestampType()))])
    assert [jdbc.key_kind(kinds, c) for c in "slihd"] == ["string", "long", "integer", "integer", "long"]
    for wrong in "xt":
        with pytest.raises(ValueError, match="can't split a read"):
            jdbc.key_kind(kinds, wrong)


def test_archive_reads_each_table_once(spark):
    """Null keys stay, repeats within a table too; the plan grows with the tables, not with their square."""
    years = [spark.createDataFrame(rows, "a int, b int, v string") for rows in ([(1, 1, "new"), (1, 1, "twin"), (None, 1, "n0")], [(1, 1, "old"), (2, 1, "x"), (None, 1, "n1")], [(2, 1, "y"), (3, 3, "z"), (2, None, "n2")])]
    kept = versioning.archived(["a", "b"], *years)
    assert sorted(r.v for r in kept.collect()) == ["n0", "n1", "n2", "new", "twin", "x", "z"]
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 3


def test_references_of_a_frequent_name_are_dealt_out(spark, monkeypatch):
    rows_ = [("db", "omop", "concept", "concept_id", True, False)] + [("db", "omop", f"t{i}", "concept_id", False, True) for i in range(400)]
    df = spark.createDataFrame([*rows_, ("db", "omop", "alone", None, False, True)], "lib_database string, lib_schema string, lib_table string, lib_column string, is_pk boolean, is_fk boolean")
    whole = sorted(catalog.equal_references(df).collect())
    monkeypatch.setattr(catalog, "TOGETHER", 20)
    dealt = catalog.equal_references(df)
    assert sorted(dealt.collect()) == whole and len(whole) == 400
    assert "_part" in dealt._jdf.queryExecution().optimizedPlan().toString()


def test_catalog_tables_are_grouped_after_dealing_out(spark):
    df = spark.createDataFrame([("db", "omop", f"t{i % 7}", f"c{i}", 1 + i // 7) for i in range(21)], "lib_database string, lib_schema string, lib_table string, lib_column string, order_column int")
    made = catalog.assemble(df, "omop")
    assert made.table.count() == 7 and made.column.count() == 21
    for part in (made.table, made.column):
        assert "RepartitionByExpression" in part._jdf.queryExecution().optimizedPlan().toString()
