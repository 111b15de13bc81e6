import pytest
from pyspark.sql import functions as F

from tablewright.operators import statistics
from tablewright.operators.profile import profile

from tests.conftest import rows


def data(spark, low, high):
    return spark.range(low, high).selectExpr("id % 4 AS p", "id", "id % 100 AS m", "CASE WHEN id % 5 > 0 THEN concat('t', id % 37) END AS t", "CAST(id % 9 AS double) - 4 AS x", "array(id % 3) AS l", "timestamp_seconds(id) AS at")


def agrees(spark, path):
    df = spark.read.parquet(path)
    got = {r.column_name: r for r in statistics.merged(spark, path).collect()}
    exact = {r.column_name: r for r in profile(df, [c for c in df.columns if c != "l"]).collect()}
    assert set(got) == set(df.columns)
    for c, r in exact.items():
        g = got[c]
        assert (g.n_rows, g.n_null, g.null_percent, g.min_value, g.max_value) == (r.n_rows, r.n_null, r.null_percent, r.min_value, r.max_value), c
        assert g.n_distinct == pytest.approx(r.n_distinct, rel=3 * statistics.ERROR), c
    assert got["l"].n_distinct == df.select("l").distinct().count()


def test_only_changed_partitions_are_read(spark, tmp_path):
    path = f"{tmp_path}/a table"
    data(spark, 0, 20_000).write.partitionBy("p").parquet(path)
    assert statistics.update(spark, path) == ["p=0", "p=1", "p=2", "p=3"]
    agrees(spark, path)
    assert statistics.update(spark, path) == []
    data(spark, 20_000, 30_000).where("p = 2").write.mode("append").partitionBy("p").parquet(path)
    assert statistics.update(spark, path) == ["p=2"]
    agrees(spark, path)
    import shutil

    shutil.rmtree(f"{path}/p=1")  # a partition goes, another is new
    data(spark, 0, 400).where("p = 3").withColumn("p", F.lit(9)).write.mode("append").partitionBy("p").parquet(path)
    assert statistics.update(spark, path) == ["p=9"]
    agrees(spark, path)
    shutil.rmtree(f"{path}/p=9")
    assert statistics.update(spark, path) == []
    agrees(spark, path)
    assert rows(spark.read.parquet(path).select("p").distinct()) == [(0,), (2,), (3,)]  # the statistics are no rows


def test_a_table_without_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    data(spark, 0, 50).drop("p").write.parquet(path)
    assert statistics.update(spark, path) == [""] and statistics.update(spark, path) == []
    agrees(spark, path)
    data(spark, 50, 60).drop("p").write.mode("append").parquet(path)
    assert statistics.update(spark, path) == [""]
    agrees(spark, path)


def test_folders_are_worked_out_by_file(spark, tmp_path, monkeypatch):
    plans, swap_in = [], statistics.swap_in
    monkeypatch.setattr(statistics, "swap_in", lambda df, where: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), swap_in(df, where)))
    path = f"{tmp_path}/a+b %41"
    data(spark, 0, 2000).repartition(3).write.partitionBy("p").parquet(path)  # three files a folder
    assert statistics.update(spark, path) == ["p=0", "p=1", "p=2", "p=3"]
    agrees(spark, path)
    lines = plans[0].splitlines()
    scan = next(i for i, line in enumerate(lines) if line.rstrip().endswith("parquet"))
    first = max(i for i in range(scan) if "Aggregate" in lines[i])  # of rows
    assert not [line for line in lines[first : scan + 1] if "regexp_replace" in line]
