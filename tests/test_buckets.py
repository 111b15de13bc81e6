import json
import os

import pytest
from pyspark.sql import functions as F

from tablewright.operators.versioning import DuplicateKeys, scd1
from tablewright.sources import buckets, staging, tables
from tablewright.streaming import sync

from tests.conftest import rows


def files(path):
    return {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def old(spark):
    return spark.range(2000).selectExpr("id AS k", "CAST(id % 7 AS string) AS v", "CASE WHEN id % 3 = 0 THEN id END AS n")


def test_untouched_files_stay(spark, tmp_path):
    path = f"{tmp_path}/t"
    buckets.lay_out(old(spark), path, ["k"], 32)
    before = files(path)
    source = spark.createDataFrame([(5, "x", None), (77, "y", 1), (99_999, "new", None), (None, "null key", 3)], "k long, v string, n long")
    written = buckets.merge_by_bucket(source, path, ["k"])
    after = files(path)
    touched = {f"{path}/tw_bucket_of_32={b}" for b in written}
    assert 0 < len(written) <= 4 and {d for d, _ in before.keys() ^ after.keys()} <= touched
    assert all(after[f] == t for f, t in before.items() if f[0] not in touched) and len(before.keys() & after.keys()) >= 28
    assert rows(tables.read(spark, str(tmp_path), "t")) == rows(scd1(old(spark), source, ["k"]))
    again = spark.createDataFrame([(5, "x", None), (1, "1", None)], "k long, v string, n long")  # nothing new
    assert buckets.merge_by_bucket(again, path, ["k"]) == [] and files(path) == after
    with pytest.raises(DuplicateKeys):
        buckets.merge_by_bucket(again.union(again), path, ["k"])


def test_a_table_without_buckets_is_laid_out_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    staging.swap_in(old(spark), path)
    source = spark.createDataFrame([(1, "a", 1)], "k long, v string, n long")
    assert len(buckets.merge_by_bucket(source, path, ["k"], 8)) == 8
    assert len(buckets.merge_by_bucket(source.withColumn("v", F.lit("b")), path, ["k"], 99)) == 1
    assert rows(tables.read(spark, str(tmp_path), "t").where("k = 1")) == [(1, "b", 1)] and tables.read(spark, str(tmp_path), "t").count() == 2000
    fresh = f"{tmp_path}/fresh"
    buckets.merge_by_bucket(source, fresh, ["k"], 4)
    assert rows(buckets.read(spark, fresh)) == [(1, "a", 1)]
    assert rows(buckets.read(spark, fresh, with_bucket=True))[0][:3] == (1, "a", 1)


def test_a_merge_that_dies_is_finished(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    buckets.lay_out(old(spark), path, ["k"], 8)
    source = spark.range(0, 2000, 50).selectExpr("id AS k", "'merged' AS v", "id AS n")
    want = rows(scd1(old(spark), source, ["k"]))
    finish = buckets.finish
    calls = []

    def dies(*a):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("killed after the note")
        finish(*a)

    monkeypatch.setattr(buckets, "finish", dies)
    with pytest.raises(OSError):
        buckets.merge_by_bucket(source, path, ["k"])
    monkeypatch.setattr(buckets, "finish", finish)
    assert json.load(open(f"{path}/{buckets.NOTE}"))["buckets"]
    assert rows(tables.read(spark, str(tmp_path), "t")) == want  # readers see the merge already
    import shutil

    shutil.rmtree(f"{path}/tw_bucket_of_8={json.load(open(f'{path}/{buckets.NOTE}'))['buckets'][0]}")  # and if it died among the partitions
    assert rows(tables.read(spark, str(tmp_path), "t")) == want
    assert buckets.merge_by_bucket(source, path, ["k"]) == [] and not os.path.exists(f"{path}/{buckets.NOTE}")
    assert rows(tables.read(spark, str(tmp_path), "t")) == want


def test_sync_and_odd_keys(spark, tmp_path):
    s = "a string, `b c` int, v double"
    staging.swap_in(spark.createDataFrame([("x", 1, 1.0), ("x", None, 2.0), ("", 1, float("nan"))], s), f"{tmp_path}/in/t")
    text = f"source: {{format: parquet, path: '{tmp_path}/in'}}\ntarget: {{format: parquet, path: '{tmp_path}/out', load: scd1, buckets: 4}}\ntables:\n- {{source_table: t, target_table: t, keys: [a, b c], hash: false}}\n"
    for _ in range(2):
        assert sync.sync(spark, text)["t"] == "loaded"
    assert tables.read(spark, f"{tmp_path}/out", "t").count() == 4  # a null key matches nothing


def test_compaction_by_size(spark, tmp_path):
    where = str(tmp_path)
    small = spark.range(600).selectExpr("id", "IF(id % 2 = 1, '1', 'a:b %2F+c') AS p", "repeat('x', 10) AS t").repartition(6)
    small.write.partitionBy("p").parquet(f"{where}/t")
    big = spark.range(20_000).selectExpr("id", "sha2(CAST(id AS string), 256) AS t").withColumn("p", F.lit("1")).select("id", "p", "t")
    big.coalesce(1).write.mode("append").partitionBy("p").parquet(f"{where}/t")
    lone = spark.range(1).selectExpr("id", "'a b%:c' AS t", "'7' AS p").select("id", "p", "t")
    lone.coalesce(1).write.mode("append").partitionBy("p").parquet(f"{where}/t")
    want = sorted(map(str, tables.read(spark, where, "t").select("id", "t", "p").collect()))
    before = files(f"{where}/t")
    large = {f for f in before if os.stat("/".join(f)).st_size > 500_000}
    alone = {f for f in before if f[0].endswith("p=7")}
    assert len(large) == 1 and len(alone) == 1
    assert tables.compact_by_size(spark, where, "t", 1_000_000) == {"rewritten": 12, "written": 2}
    after = files(f"{where}/t")
    assert large | alone <= after.keys() and all(after[f] == before[f] for f in large | alone) and len(after) == 4
    assert sorted(map(str, tables.read(spark, where, "t").select("id", "t", "p").collect())) == want
    assert tables.compact_by_size(spark, where, "t", 1_000_000) == {"rewritten": 0, "written": 0}
    assert tables.compact_by_size(spark, where, "absent") == {"rewritten": 0, "written": 0}


def test_bins_of_a_compaction(spark):
    sizes = spark.createDataFrame([("f", f"{i:02}", 30) for i in range(10)] + [("f", "big", 90), ("g", "one", 5)], "folder string, file string, bytes long")
    plan = {(r.folder, r.bin): (sorted(r.files), r.bytes) for r in tables.compaction_plan(sizes, 100).collect()}
    assert sorted(f for files_, _ in plan.values() for f in files_) == [f"{i:02}" for i in range(10)]
    assert {k[0] for k in plan} == {"f"} and max(b for _, b in plan.values()) <= 130


def test_a_compaction_that_dies(spark, tmp_path, monkeypatch):
    where = str(tmp_path)
    spark.range(100).repartition(5).write.parquet(f"{where}/t")
    finish = tables.finish_compaction
    calls = []
    monkeypatch.setattr(tables, "finish_compaction", lambda *a: calls.append(a) or (finish(*a) if len(calls) != 2 else None))
    tables.compact_by_size(spark, where, "t", 1_000_000)
    assert spark.read.parquet(f"{where}/t").count() == 100  # old files, as long as the note is not carried out
    monkeypatch.undo()
    finish(spark, f"{where}/t")
    assert spark.read.parquet(f"{where}/t").agg(F.count("*"), F.sum("id")).first()[:] == (100, 4950) and len(files(f"{where}/t")) == 1
    spark.range(3).write.parquet(f"{where}/t/{tables.COMPACTION}/0")  # one that died before its note
    finish(spark, f"{where}/t")
    assert spark.read.parquet(f"{where}/t").count() == 100 and not os.path.exists(f"{where}/t/{tables.COMPACTION}")
