"""Tables written on the way, and swaps of a finished table for an old one."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, on one machine only, a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back: computed once, safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/tablewright/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path for ``path``, whatever store it is in."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all; in place of one that is there."""
    fs, where = file_system(spark, path)
    _, draft = file_system(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(where):
        fs.delete(where, False)
    fs.rename(draft, where)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path).collect())  # of write_text(): small


def _is_table(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the table ``path`` now; between the two renames of a swap, or where one
    died there, the new table if it is complete and the old one otherwise. Readers change nothing."""
    if path_exists(spark, path):
        return path
    if _is_table(spark, f"{path}.new"):
        return f"{path}.new"
    return f"{path}.old" if path_exists(spark, f"{path}.old") else path


def recover(spark: SparkSession, path: str) -> None:
    """For the one writer of a table: finish what a swap that died between its two renames has left.
    ``path`` is the new table if it was complete, and the old one otherwise."""
    fs, where = file_system(spark, path)
    _, new = file_system(spark, f"{path}.new")
    _, old = file_system(spark, f"{path}.old")
    if not fs.exists(where):
        if _is_table(spark, f"{path}.new"):
            fs.rename(new, where)
        elif fs.exists(old):
            fs.rename(old, where)
    for left in (new, old):
        if fs.exists(left) and fs.exists(where):
            fs.delete(left, True)


def swap_in(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, notes: dict[str, str] | None = None) -> None:
    """Write ``df`` beside ``path`` and put it in its place: ``df`` may read ``path`` itself, and
    a reader finds the old table or the new one, never a part. ``notes``: small files that become part
    of the new table's folder, by name."""
    spark = df.sparkSession
    recover(spark, path)
    df.write.format(fmt).mode("overwrite").partitionBy(*(partition_by or [])).save(f"{path}.new")
    for name, text in (notes or {}).items():
        write_text(spark, f"{path}.new/{name}", text)
    fs, where = file_system(spark, path)
    _, new = file_system(spark, f"{path}.new")
    _, old = file_system(spark, f"{path}.old")
    if fs.exists(where):
        fs.rename(where, old)
    if not fs.rename(new, where):
        raise OSError(f"can't put {path}.new in place of {path}")
    if fs.exists(old):
        fs.delete(old, True)
