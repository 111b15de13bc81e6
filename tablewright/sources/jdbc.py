"""Databases over JDBC: split reads that lose no key, batched writes, load types."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.operators import versioning
from tablewright.runtime import ship_package
from tablewright.sources import databases
from tablewright.sources.databases import execute
from tablewright.sources.staging import stored

FETCH = BATCH = 50_000


@dataclass(frozen=True)
class Database:
    """A connection: everything that Spark's JDBC source takes as options."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = None
    quote: str = '"'
    more: dict = field(default_factory=dict)
    rename: str = "ALTER TABLE {old} RENAME TO {new}"
    rename_index: str = "ALTER INDEX {old} RENAME TO {new}"
    #: how the database divides whole numbers, rounding down
    divide: str = "({a}) / {b}"

    def options(self) -> dict:
        own = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {k: v for k, v in own.items() if v is not None} | self.more

    def name(self, column: str) -> str:
        return self.quote + column + self.quote


def key_ranges(lower: int, upper: int, partitions: int, split_factor: int = 1) -> list[tuple[int, int]]:
    """Contiguous integer ranges, both ends included, that together are lower .. upper."""
    parts = max(1, partitions * split_factor)
    cuts = sorted({lower + i * (upper - lower + 1) // parts for i in range(parts + 1)})
    return [(a, b - 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def range_predicates(column: str, ranges: list[tuple[int, int]]) -> list[str]:
    """One condition per range, and one for the rows without a key."""
    return [f"{column} >= {a} AND {column} <= {b}" for a, b in ranges] + [f"{column} IS NULL"]


def text_boundaries(df: DataFrame, column: str, parts: int) -> list[str]:
    """At most ``parts`` - 1 ascending keys that cut a text column into ranges of about one size.

    A uniform sample by the key's hash, of bounded size, is sorted; every range is half open, so
    whatever the sample holds each key is in exactly one range.
    """
    n = df.count()
    every = max(1, n // max(1, parts * 200))
    picked = df.where(F.col(column).isNotNull() & (F.pmod(F.xxhash64(column), F.lit(every)) == 0)).select(column).distinct().orderBy(column).limit(parts * 1000)
    keys = [r[0] for r in picked.collect()]
    return sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []


def text_predicates(column: str, boundaries: list[str]) -> list[str]:
    quoted = ["'" + b.replace("'", "''") + "'" for b in boundaries]
    if not quoted:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted[:-1], quoted[1:], strict=True)]
    return [f"{column} < {quoted[0]}", *middle, f"{column} >= {quoted[-1]}", f"{column} IS NULL"]


def range_number(column: Column, boundaries: list) -> Column:
    """In which half-open range a value lies, from 0; null for null."""
    out = F.when(column.isNotNull(), 0)
    for i, b in enumerate(boundaries):
        out = F.when(column >= F.lit(b), i + 1).otherwise(out) if i == 0 else F.when(column >= F.lit(b), i + 1).otherwise(out)
    return out.cast("int")


def min_max(df: DataFrame, column: str) -> tuple:
    return tuple(df.agg(F.min(column), F.max(column)).first())


def key_kind(schema: T.StructType, column: str) -> str:
    """string, long or integer: the types that a read can be split on."""
    kind = schema[column].dataType
    names = {T.StringType: "string", T.LongType: "long", T.IntegerType: "integer", T.ShortType: "integer"}
    if type(kind) not in names and not isinstance(kind, T.DecimalType):
        raise ValueError(f"column {column} of type {kind.simpleString()} can't split a read")
    return names.get(type(kind), "long")


def query_schema(spark: SparkSession, db: Database, query: str) -> T.StructType:
    """The columns of a query, without its rows."""
    return spark.read.format("jdbc").options(**db.options(), dbtable=f"({query}) q").load().schema


def read_query(spark: SparkSession, db: Database, query: str, partitions: int = 1, column: str | None = None, split_factor: int = 1) -> DataFrame:
    """A query's rows; with more than one partition, read in ranges of ``column``.

    Filters and column choices on the result reach the database in each range.
    """
    options = db.options() | {"dbtable": f"({query}) q", "fetchsize": str(FETCH)}
    whole = spark.read.format("jdbc").options(**options).load()
    if partitions == 1:
        return whole
    if column is None:
        raise ValueError("several partitions need a column to split on")
    name, parts = db.name(column), partitions * split_factor
    if key_kind(whole.schema, column) == "string":
        predicates = text_predicates(name, text_boundaries(whole, column, parts))
    else:
        low, high = min_max(whole, column)
        predicates = range_predicates(name, key_ranges(int(low), int(high), partitions, split_factor)) if low is not None else [f"{name} IS NULL"]
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(db.url, f"({query}) q", predicates=predicates, properties=rest)


@dataclass(frozen=True)
class Null:
    """A null of a database type, for bound()."""

    type: str


#: What a question mark is not a parameter in: texts, names, comments.
_SPANS = r"""'(?:[^']|'')*'|"(?:[^"]|"")*"|--[^\n]*|/\*[\s\S]*?\*/"""


def literal(spark: SparkSession, db: Database, value) -> str:
    """A value as a literal of its type, in the dialect's notation."""
    jvm = spark._jvm
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(db.url)
    typed = lambda text, kind: f"CAST({text} AS {databases.spark_type_in(spark, db, kind)})"
    if value is None:
        return "NULL"
    if isinstance(value, Null):
        return f"CAST(NULL AS {value.type})"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError(f"{value} has no literal")
        return f"{value!r}" if "e" in repr(value) else f"{value!r}e0"
    if isinstance(value, Decimal):
        digits = value.as_tuple()
        scale = max(0, -digits.exponent)
        return typed(f"{value:f}", T.DecimalType(max(len(digits.digits) + max(0, digits.exponent), scale, 1), scale))
    if isinstance(value, datetime):
        return typed(dialect.compileValue(value.isoformat(" ", "microseconds" if value.microsecond else "seconds")), T.TimestampNTZType())
    if isinstance(value, date):
        return typed(dialect.compileValue(value.isoformat()), T.DateType())
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    if isinstance(value, str):
        return dialect.compileValue(value)
    raise TypeError(f"a parameter can't be a {type(value).__name__}")


def bound(spark: SparkSession, db: Database, query: str, params: list) -> str:
    """The query with a literal for each of its question marks."""
    left = list(params)

    def put(found: re.Match) -> str:
        if found[0] != "?":
            return found[0]
        if not left:
            raise ValueError(f"more question marks than the {len(params)} parameters")
        return literal(spark, db, left.pop(0))

    out = re.sub(_SPANS + r"|\?", put, query)
    if left:
        raise ValueError(f"{len(left)} parameters without a question mark")
    return out


def read_bound(spark: SparkSession, db: Database, query: str, params: list, partitions: int = 1, column: str | None = None, split_factor: int = 1) -> DataFrame:
    """read_query() with parameters of any SQL type: None, Null, bool, int, float, Decimal, str, bytes, date,
    datetime. A query split into several reads has them in each."""
    return read_query(spark, db, bound(spark, db, query, params), partitions, column, split_factor)


def write_table(df: DataFrame, db: Database, table: str, mode: str = "append", partitions: int = 8, truncate: bool = False) -> None:
    """At most ``partitions`` connections write batches of rows."""
    df.coalesce(partitions).write.format("jdbc").options(**db.options(), dbtable=table, batchsize=str(BATCH), truncate=str(truncate).lower()).mode(mode).save()


LOADS = ("full", "megafull", "scd1", "scd2")


@dataclass(frozen=True)
class Load:
    """How candidates enter a table. full appends to a truncated table, megafull recreates it,
    scd1 needs ``keys``, scd2 also ``pk`` and ``end``."""

    kind: str = "full"
    keys: tuple[str, ...] = ()
    pk: str | None = None
    end: str | None = None
    in_scope: str | None = None
    set_unmatched: dict[str, str] | None = None
    #: the column of the rows' digests, for scd1 and scd2 loads that fetch only what differs
    digest: str | None = None

    def __post_init__(self):
        if self.kind not in LOADS:
            raise ValueError(f"load type {self.kind}: one of {', '.join(LOADS)}")
        if self.kind in ("scd1", "scd2") and not self.keys:
            raise ValueError(f"{self.kind} needs keys")
        if self.kind == "scd2" and not (self.pk and self.end):
            raise ValueError("scd2 needs pk and end")
        if self.digest and (self.kind not in ("scd1", "scd2") or self.in_scope or self.set_unmatched):
            raise ValueError("digests are for scd1 and scd2 loads without a scope")


def loaded(target: DataFrame | None, source: DataFrame, load: Load, as_of: Column | None = None) -> DataFrame:
    """The table after a load."""
    if target is None or load.kind in ("full", "megafull"):
        return source.withColumn(load.end, F.lit(None).cast("timestamp")) if load.kind == "scd2" and load.end not in source.columns else source
    if load.kind == "scd1":
        scope = F.expr(load.in_scope) if load.in_scope else None
        sets = {k: F.expr(v) for k, v in (load.set_unmatched or {}).items()} or None
        return versioning.scd1(target, source, list(load.keys), in_scope=scope, set_unmatched=sets)
    return versioning.scd2(target, source, list(load.keys), load.pk, load.end, as_of)


def table_exists(spark: SparkSession, db: Database, table: str) -> bool:
    return databases.exists(spark, db, table)


def drop_table(spark: SparkSession, db: Database, table: str) -> None:
    if table_exists(spark, db, table):
        execute(spark, db, [f"DROP TABLE {table}"])


def beside(db: Database, table: str, suffix: str) -> str:
    """The name of a table that a load keeps beside ``table``."""
    return f"{table[:-1]}{suffix}{db.quote}" if table.endswith(db.quote) else f"{table}{suffix}"


# writes that a task may repeat
MARKS = ("tw_part", "tw_attempt", "tw_rows")


def stage_once(df: DataFrame, db: Database, stage: str, partitions: int = 8) -> None:
    """A new table ``stage`` with each row of ``df`` once, however often a task ran.

    Spark's writer adds a task's rows again when the task is repeated. So each attempt writes under its
    own number, and behind its rows one mark with their count; of the attempts of a task that are
    whole, one stays. ``df`` is stored first, so that all attempts write the same rows. Columns have
    the dialect's types and may be null.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = stored(df, "jdbc-stage").coalesce(partitions)
    tasks, schema = rows.rdd.getNumPartitions(), T.StructType([*(T.StructField(f.name, f.dataType) for f in df.schema), *(T.StructField(m, T.LongType()) for m in MARKS)])
    drop_table(spark, db, stage)
    execute(spark, db, [databases.create_statement(spark, db, None, stage, schema)])
    marked = rows.mapInArrow(_marked(to_arrow_schema(df.schema)), schema)
    marked.write.format("jdbc").options(**db.options(), dbtable=stage, batchsize=str(BATCH)).mode("append").save()
    part, attempt, counted = map(db.name, MARKS)
    query = f"SELECT {part}, {attempt}, COUNT(*) AS n_all, MAX({counted}) AS n_said FROM {stage} GROUP BY {part}, {attempt}"
    won: dict[int, int] = {}
    for r in query_rows(spark, db, query):  # a row for each attempt
        if r[3] is not None and r[2] == r[3] + 1:
            won[r[0]] = min(r[1], won.get(r[0], r[1]))
    if len(won) < tasks:
        raise RuntimeError(f"{tasks - len(won)} of {tasks} tasks left no whole attempt in {stage}")
    kept = " OR ".join(f"({part} = {p} AND {attempt} = {a})" for p, a in sorted(won.items())) or "1 = 0"
    execute(spark, db, [f"DELETE FROM {stage} WHERE {counted} IS NOT NULL OR NOT ({kept})"])


def _marked(kinds: pa.Schema):
    """For mapInArrow: rows with the numbers of their task and attempt, and the mark behind them."""

    def mark(records):
        context = TaskContext.get()
        part, attempt, n = context.partitionId(), context.taskAttemptId(), 0
        for record in records:
            n += record.num_rows
            marks = (np.full(record.num_rows, part), np.full(record.num_rows, attempt), [None] * record.num_rows)
            yield pa.RecordBatch.from_arrays([*record.columns, *(pa.array(m, pa.int64()) for m in marks)], names=[*kinds.names, *MARKS])
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, f.type) for f in kinds), *(pa.array([m], pa.int64()) for m in (part, attempt, n))], names=[*kinds.names, *MARKS])

    return mark


def query_rows(spark: SparkSession, db: Database, query: str) -> list:
    """The few rows of a query."""
    return read_query(spark, db, query).collect()


def append_once(df: DataFrame, db: Database, table: str, partitions: int = 8, replace: bool = False, also: list[str] = ()) -> int:
    """Rows into a table in one transaction, each once; with ``replace`` in place of all its rows.
    A missing table is created. ``also``: statements of the same transaction. The number of rows."""
    spark = df.sparkSession
    if not table_exists(spark, db, table):
        write_table(df.limit(0), db, table, partitions=1)
    stage = beside(db, table, "_tw_stage")
    stage_once(df, db, stage, partitions)
    before = [f"DELETE FROM {table}"] if replace else []
    return execute(spark, db, [*before, insert_statement(df, db, table, stage), f"DROP TABLE {stage}", *also])[len(before)]


def insert_statement(df: DataFrame, db: Database, table: str, stage: str) -> str:
    """From a stage with the columns of ``df`` into a table, in the table's types."""
    like = databases.structure(df.sparkSession, db, table)
    databases.require_room(df.sparkSession, db, like, df.schema, stage)
    values = databases.as_declared(df.sparkSession, db, like, df.schema)
    return f"INSERT INTO {table} ({', '.join(map(db.name, values))}) SELECT {', '.join(values.values())} FROM {stage}"


def swap_table(df: DataFrame, db: Database, table: str, partitions: int = 8, also: list[str] = ()) -> None:
    """Write ``df`` beside ``table`` and take its place in one transaction: readers find the old rows
    or the new ones. Leftovers of a load that died are dropped first.

    The new table has the old one's types, defaults, primary key, references and indexes, as far as
    their columns are still there; they hold before it takes the name. A table that others refer to
    can't be swapped.
    """
    spark, new, old = df.sparkSession, beside(db, table, "_tw_new"), beside(db, table, "_tw_old")
    for left in (new, old):
        drop_table(spark, db, left)
    if not table_exists(spark, db, table):
        append_once(df, db, new, partitions)
        execute(spark, db, [db.rename.format(old=new, new=table), *also])
        return
    like = databases.structure(spark, db, table)
    if like.referred_by:
        raise ValueError(f"{', '.join(like.referred_by)} refer to {table}: load it in place")
    indexes = databases.kept_indexes(like, df.columns)
    execute(spark, db, [databases.create_statement(spark, db, like, new, df.schema)])
    append_once(df, db, new, partitions)
    execute(spark, db, databases.index_statements(db, indexes, new, "_tw_new"))
    execute(spark, db, [db.rename.format(old=table, new=old), db.rename.format(old=new, new=table), f"DROP TABLE {old}", *(db.rename_index.format(old=db.name(f"{i.name}_tw_new"), new=db.name(i.name)) for i in indexes), *also])


def same_keys(staged: DataFrame, db: Database, table: str, stage: str) -> str:
    """A condition: rows of the stage and the table agree in all columns of ``staged``, nulls too."""
    like = databases.structure(staged.sparkSession, db, table)
    values = databases.as_declared(staged.sparkSession, db, like, staged.schema, stage)
    return " AND ".join(f"({v} = {table}.{db.name(k)} OR {v} IS NULL AND {table}.{db.name(k)} IS NULL)" for k, v in values.items())


def merge_table(target: DataFrame, result: DataFrame, db: Database, table: str, keys: list[str], also: list[str] = ()) -> list[int]:
    """Bring a table from the rows ``target`` to ``result``; only rows that differ reach the database.

    They are staged beside the table, and one transaction deletes the keys of rows that are gone or
    changed and inserts the new ones, so a failure leaves the table as it was.
    """
    spark, gone, new = result.sparkSession, beside(db, table, "_tw_gone"), beside(db, table, "_tw_new")
    lost = target.exceptAll(result).select(*(F.col(f"`{k}`") for k in keys)).distinct()
    stage_once(lost, db, gone)
    stage_once(result.exceptAll(target), db, new)
    same = same_keys(lost, db, table, gone)
    return execute(spark, db, [
        f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {gone} WHERE {same})",
        insert_statement(result, db, table, new),
        f"DROP TABLE {gone}",
        f"DROP TABLE {new}",
        *also,
    ])[:2]


def read_whole(spark: SparkSession, db: Database, table: str, column: str, partitions: int = 8) -> DataFrame:
    """A table in ranges of ``column``, where reads can be split on it."""
    query = f"SELECT * FROM {table}"
    try:
        key_kind(query_schema(spark, db, query), column)
    except ValueError:
        return read_query(spark, db, query)
    return read_query(spark, db, query, partitions, column)


def load_table(df: DataFrame, db: Database, table: str, load: Load, as_of: Column | None = None, also: list[str] = ()) -> None:
    """Load candidates into a database table; the result is staged first, as it may read the table.
    With a digest column, see reconcile.load(). ``also``: statements of the transaction that changes the rows."""
    spark = df.sparkSession
    if load.digest:
        from tablewright.sources import reconcile

        reconcile.load(df, db, table, load, as_of, also)
        return
    there = load.kind != "megafull" and table_exists(spark, db, table)
    merges = there and load.kind in ("scd1", "scd2")
    target = stored(read_whole(spark, db, table, load.keys[0]), "jdbc-target") if merges else None
    result = stored(loaded(target, df, load, as_of), "jdbc-load")
    if merges and set(result.columns) == set(target.columns):
        merge_table(target.select(*result.columns), result, db, table, [load.pk] if load.kind == "scd2" else list(load.keys), also)
    elif there:
        append_once(result, db, table, replace=True, also=also)
    else:
        swap_table(result, db, table, also=also)
