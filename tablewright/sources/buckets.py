"""Tables by key bucket: merges that read and write the touched buckets only.

A row lies in the partition of its keys' hash, in a column whose name tells the number of buckets.
A merge looks up which buckets the candidates touch (as many numbers on the driver as there are
buckets, at most), merges those alone, stages the result and overwrites just their partitions. A note beside
the data says where the staged buckets are while they are put in place: readers take them from there,
and the next writer finishes what died. A table has one writer at a time.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.schema import col
from tablewright.operators.versioning import require_unique, scd1
from tablewright.sources.staging import current, file_system, path_exists, read_text, recover, stored, swap_in, write_text

PREFIX = "tw_bucket_of_"
NOTE = "_tw_merge/note.json"  # readers pass over folders whose names begin with an underscore


def bucket(keys: list[str], n: int) -> Column:
    """The bucket of a row: of its keys as text, so that a wider number type changes nothing."""
    return F.pmod(F.xxhash64(*(col(k).cast("string") for k in keys)), F.lit(n)).cast("int")


def buckets_of(df: DataFrame) -> tuple[str, int] | None:
    """The bucket column of a stored table and its number of buckets, if it has one."""
    name = next((c for c in df.columns if re.fullmatch(PREFIX + r"\d+", c)), None)
    return (name, int(name[len(PREFIX) :])) if name else None


def _note(spark: SparkSession, path: str) -> dict | None:
    return json.loads(read_text(spark, f"{path}/{NOTE}")) if path_exists(spark, f"{path}/{NOTE}") else None


def _staged(spark: SparkSession, note: dict) -> DataFrame:
    return spark.read.schema(note["schema"]).parquet(note["staged"])


def read(spark: SparkSession, path: str, fmt: str = "parquet", with_bucket: bool = False) -> DataFrame:
    """The table's rows; of buckets that a merge is putting in place, the new ones."""
    path = current(spark, path)
    df = spark.read.format(fmt).load(path)
    name = buckets_of(df)[0]
    if note := _note(spark, path):
        new = _staged(spark, note)
        df = df.where(~col(name).isin(note["buckets"])).select(*new.columns).unionByName(new)
    return df if with_bucket else df.drop(name)


def finish(spark: SparkSession, path: str, fmt: str = "parquet") -> None:
    """For the one writer: put staged buckets in place that a merge has left behind."""
    recover(spark, path)
    if not path_exists(spark, path) or not (note := _note(spark, path)):
        return
    name = note["column"]
    _staged(spark, note).repartition(F.col(name)).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name).save(path)
    fs, where = file_system(spark, f"{path}/{NOTE}")
    fs.delete(where, False)


def lay_out(df: DataFrame, path: str, keys: list[str], n: int, fmt: str = "parquet") -> None:
    """Write a table in ``n`` buckets, in place of one that may be there."""
    name = f"{PREFIX}{n}"
    dealt = df.withColumn(name, bucket(keys, n)).repartition(F.col(name))
    swap_in(dealt, path, fmt, [name])


def merge_by_bucket(source: DataFrame, path: str, keys: list[str], n: int = 64, fmt: str = "parquet", check_keys: bool = True) -> list[int]:
    """Type 1: new keys go in, changed rows are updated, others stay. The buckets that were written.

    A missing table is made with ``n`` buckets, and one without buckets is laid out anew, once. A
    bucket whose rows don't change is not written, whatever its candidates.
    """
    spark = source.sparkSession
    finish(spark, path, fmt)
    source = stored(require_unique(source, keys) if check_keys else source, "bucket-source")
    if not path_exists(spark, path):
        lay_out(source, path, keys, n, fmt)
        return sorted(r[0] for r in source.select(bucket(keys, n)).distinct().collect())
    found = buckets_of(spark.read.format(fmt).load(path))
    if not found:
        lay_out(scd1(spark.read.format(fmt).load(path), source, keys, check_keys=False), path, keys, n, fmt)
        return list(range(n))
    name, n = found
    touched = sorted(r[0] for r in source.select(bucket(keys, n)).distinct().collect())
    old = spark.read.format(fmt).load(path)
    plain = [c for c in old.columns if c != name]
    merged = scd1(old.where(col(name).isin(touched)).select(*map(col, plain)), source, keys, check_keys=False)
    new = stored(merged.withColumn(name, bucket(keys, n)), "bucket-merge")
    # rows and a sum of their digests tell which buckets are other than before
    sums = lambda df: df.groupBy(name).agg(F.count("*").alias("rows"), F.sum(F.xxhash64(*(F.coalesce(F.to_json(F.struct(col(c))), F.lit("")) for c in plain)).cast("decimal(38,0)")).alias("total"))
    same = sums(old.where(col(name).isin(touched))).join(sums(new), [name, "rows", "total"])
    changed = sorted(set(touched) - {r[0] for r in same.select(name).collect()})
    if not changed:
        return []
    staged = new.where(col(name).isin(changed)).select(*map(col, [*plain, name]))
    where = stored(staged, "bucket-staged")
    note = {"column": name, "buckets": changed, "staged": where.inputFiles()[0].rsplit("/", 1)[0], "schema": staged._jdf.schema().toDDL()}
    write_text(spark, f"{path}/{NOTE}", json.dumps(note))
    finish(spark, path, fmt)
    return changed
