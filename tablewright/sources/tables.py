"""Tables by name or path: reading, saving, copying, compacting, statements."""

from __future__ import annotations

import json
import logging
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import quality
from tablewright.sources import buckets
from tablewright.sources.staging import current, file_system, path_exists, swap_in

log = logging.getLogger(__name__)


def is_path(where: str) -> bool:
    return "/" in where


def database_exists(spark: SparkSession, name: str) -> bool:
    return not is_path(name) and spark.catalog.databaseExists(name)


def qualified(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def location(spark: SparkSession, table: str) -> str:
    """Where a catalog table keeps its files."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").select("data_type").collect()
    if not rows:
        raise ValueError(f"{table} has no location")
    return rows[0][0]


def exists(spark: SparkSession, where: str, table: str) -> bool:
    """Whether ``table`` is in the database or folder ``where``."""
    if is_path(where):
        return path_exists(spark, current(spark, f"{where}/{table}"))
    return database_exists(spark, where) and spark.catalog.tableExists(qualified(where, table))


def read(spark: SparkSession, where: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table if ``where`` is a database, else the files at ``where/table``."""
    if database_exists(spark, where):
        return spark.table(qualified(where, table))
    df = spark.read.format(fmt).load(current(spark, f"{where}/{table}"))
    return buckets.read(spark, f"{where}/{table}", fmt) if buckets.buckets_of(df) else df


def dealt(df: DataFrame, partitions: int | None, keys: list[str] | None = None) -> DataFrame:
    """``df`` for about ``partitions`` files, each partition of a partitioned table in one; else as AQE sizes them."""
    return df.repartition(partitions, *(F.col(f"`{k}`") for k in keys or [])) if partitions else df.hint("rebalance")


def save_table(df: DataFrame, table: str, fmt: str = "parquet", partitions: int | None = None, partition_by: list[str] | None = None) -> None:
    """Create or overwrite a catalog table. ``partitions``: number of files; else AQE sizes them.

    A plan that reads the table itself is staged under another name (``__new``); the old table is
    renamed (``__old``) and dropped at last, so that one of the three names always holds a whole
    table. The next save puts back the old one where a save died between the renames.
    """
    spark = df.sparkSession
    database, _, name = table.replace("`", "").rpartition(".")
    new, old = (qualified(database, f"{name}__{end}") if database else f"`{name}__{end}`" for end in ("new", "old"))
    if spark.catalog.tableExists(old):
        spark.sql(f"DROP TABLE {old}" if spark.catalog.tableExists(table) else f"ALTER TABLE {old} RENAME TO {table}")
    out = dealt(df, partitions, partition_by).write.format(fmt).mode("overwrite").partitionBy(*(partition_by or []))
    if not spark.catalog.tableExists(table):
        out.saveAsTable(table)
        return
    out.saveAsTable(new)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")


def save_files(df: DataFrame, path: str, fmt: str = "parquet", partitions: int | None = None) -> None:
    swap_in(df.repartition(partitions) if partitions else df.hint("rebalance"), path, fmt)


def save(df: DataFrame, target: str, fmt: str = "parquet", partitions: int | None = None) -> None:
    """To files if the target is a path, else to a catalog table."""
    (save_files if is_path(target) else save_table)(df, target, fmt, partitions)


def target_name(where: str, table: str) -> str:
    return f"{where}/{table}" if is_path(where) else qualified(where, table)


def save_and_validate(df: DataFrame, target: str, checks: list[quality.Field], fmt: str = "parquet") -> DataFrame:
    """Save, then hold the stored table against the constraints."""
    save(df, target, fmt)
    spark = df.sparkSession
    return quality.validate(spark.read.format(fmt).load(target) if is_path(target) else spark.table(target), checks)


def create_table(spark: SparkSession, table: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """An empty table of the schema, if there is none."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' + ' NOT NULL' * (not f.nullable) for f in schema)}) USING {fmt}")


def copy_structure(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> None:
    spark.sql(f"CREATE TABLE {target} LIKE {source} USING {fmt}")


def is_empty(spark: SparkSession, table: str) -> bool:
    return spark.table(table).isEmpty()


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def rename(spark: SparkSession, table: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {table} RENAME TO {new}")


def move(spark: SparkSession, table: str, database: str) -> str:
    """The table in another database, as a copy that replaces the original; its new name."""
    new = qualified(database, table.replace("`", "").rpartition(".")[2])
    save_table(spark.table(table), new)
    drop(spark, table)
    return new


def execute(spark: SparkSession, statement: str, params: list | None = None) -> DataFrame:
    """A statement or query with positional ``?`` parameters of any SQL type; None is null."""
    return spark.sql(statement, args=params or None)


def table_names(spark: SparkSession, database: str, skip: str = "tmp|[0-7]", keep: str | None = None) -> list[str]:
    """Managed tables without a match of ``skip`` in their name and, if given, with one of ``keep``."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if t.tableType == "MANAGED")
    return [n for n in names if not (skip and re.search(skip, n)) and (keep is None or re.search(keep, n))]


def copy_tables(spark: SparkSession, source: str, target: str, names: list[str] | None = None, fmt: str = "parquet") -> list[str]:
    """Copy the named tables, or those of table_names(), to another database."""
    names = table_names(spark, source) if names is None else names
    for n in names:
        save_table(spark.table(qualified(source, n)), qualified(target, n), fmt)
    return names


def compact(spark: SparkSession, where: str, table: str, files: int, predicate: str | None = None, fmt: str = "parquet") -> bool:
    """Rewrite a table to ``files`` files; with a predicate, only the partitions it names. The layout
    in partitions stays.

    A missing table is skipped with a warning. The predicate may name partition columns of a path
    table only: those partitions are rewritten in place, each by a staged copy.
    """
    if not exists(spark, where, table):
        log.warning("%s in %s does not exist and is not compacted", table, where)
        return False
    df = read(spark, where, table, fmt)
    path = current(spark, f"{where}/{table}") if is_path(where) else location(spark, qualified(where, table))
    keys = partition_columns(spark, path, fmt)
    if predicate is None:
        if is_path(where):
            swap_in(dealt(df, files, keys), f"{where}/{table}", fmt, keys)
        else:
            save_table(df, qualified(where, table), fmt, files, keys)
        return True
    chosen = spark.read.format(fmt).load(path).where(predicate)
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    for part in chosen.select(folder.alias("folder")).distinct().collect():  # one row a partition
        own = unquote(part.folder)  # as it is stored, whatever its values are
        swap_in(spark.read.format(fmt).load(own).repartition(files), own, fmt)
    return True


def partition_columns(spark: SparkSession, path: str, fmt: str = "parquet") -> list[str]:
    """The ``key=value`` folders below a path, by its first file."""
    file = spark.read.format(fmt).load(path).select(F.col("_metadata.file_path")).limit(1).collect()
    relative = file[0][0].split(path.split(":", 1)[-1].rstrip("/"), 1)[1] if file else ""
    return re.findall(r"/([^/=]+)=[^/]*(?=/)", relative)


def compact_all(spark: SparkSession, registry: DataFrame, files: int) -> list[str]:
    """compact() for each row (path_table or lib_database, lib_table) of a registry of tables."""
    done = []
    for r in registry.select(F.coalesce("path_table", "lib_database").alias("w"), "lib_table").toLocalIterator():
        if compact(spark, r.w, r.lib_table, files):
            done.append(r.lib_table)
    return done


# compaction by size
def file_sizes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """folder, file and bytes of a table's data files: listed, none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}").load(path).select("path", "length")
    return files.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.regexp_extract("path", "[^/]*$", 0).alias("file"), F.col("length").alias("bytes"))


def compaction_plan(sizes: DataFrame, target_bytes: int, small: float = 0.5) -> DataFrame:
    """folder, bin and files: which small files of a folder to rewrite as one file of about the target
    size. Files of at least ``small`` times the target stay as they are, and so does a small file with
    none to join. Small files fill bins by a running sum of their sizes."""
    few = sizes.where(F.col("bytes") < small * target_bytes)
    before = Window.partitionBy("folder").orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    bins = few.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / F.lit(target_bytes)).cast("int"))
    return bins.groupBy("folder", "bin").agg(F.collect_list("file").alias("files"), F.sum("bytes").alias("bytes")).where(F.size("files") > 1)


def compact_by_size(spark: SparkSession, where: str, table: str, target_bytes: int = 128 << 20, small: float = 0.5, fmt: str = "parquet") -> dict[str, int]:
    """Rewrite the small files of a path table to files of about ``target_bytes``; large files keep
    their names and are not read. How many files were rewritten, and to how many.

    All new files are written first, out of readers' sight, then a note of what replaces what; only then
    old files go and new ones take their place. A job that dies is finished by the next one, by
    the note. Between the first and the last of these renames, readers should wait: files have no
    transactions.
    """
    path = f"{where}/{table}"
    if not path_exists(spark, path):
        log.warning("%s in %s does not exist and is not compacted", table, where)
        return {"rewritten": 0, "written": 0}
    finish_compaction(spark, path)
    plan = compaction_plan(file_sizes(spark, path, fmt), target_bytes, small).orderBy("folder", "bin").toLocalIterator()
    fs, root = file_system(spark, path)
    base = root.toUri().getPath().rstrip("/")
    aside, moves = f"{path}/{COMPACTION}", []
    for i, r in enumerate(plan):  # a job for each new file
        old = [f"{r.folder}/{f}" for f in r.files]
        spark.read.format(fmt).load(old).coalesce(1).write.format(fmt).save(f"{aside}/{i}")
        made = [s.getPath().toString() for s in fs.listStatus(file_system(spark, f"{aside}/{i}")[1]) if s.getPath().getName().startswith("part-")]
        moves.append({"old": old, "new": made, "folder": r.folder})
    if moves:
        spark.createDataFrame([(json.dumps(m),) for m in moves], "value string").coalesce(1).write.text(f"{aside}/note")
    finish_compaction(spark, path)
    log.info("compacted %s: %d bins", base, len(moves))
    return {"rewritten": sum(len(m["old"]) for m in moves), "written": sum(len(m["new"]) for m in moves)}


#: Where a compaction keeps its files; readers pass over names that begin with an underscore.
COMPACTION = "_tw_compaction"


def finish_compaction(spark: SparkSession, path: str) -> None:
    """For the one writer: carry out what the note of a compaction says, or undo one without a note."""
    aside = f"{path}/{COMPACTION}"
    fs, folder = file_system(spark, aside)
    if not fs.exists(folder):
        return
    if path_exists(spark, f"{aside}/note/_SUCCESS"):
        for line in spark.read.text(f"{aside}/note").toLocalIterator():
            move = json.loads(line.value)
            for old in move["old"]:
                fs.delete(file_system(spark, old)[1], False)
            for new in move["new"]:
                _, source = file_system(spark, new)
                if fs.exists(source):
                    fs.rename(source, file_system(spark, f"{move['folder']}/{source.getName()}")[1])
    fs.delete(folder, True)
