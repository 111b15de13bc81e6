"""Bringing tables to a schema: required and optional columns, order, types, names, unions."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.scalars import trimmed


class SchemaError(ValueError):
    """A table doesn't fit a schema."""


def col(name: str):
    """A top-level column, whatever its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def optional(name: str, kind: T.DataType, default: str | None, nullable: bool = True) -> T.StructField:
    """A field that a table may lack; ``default`` is the text its value is read from, or None."""
    return T.StructField(name, kind, nullable, {"default": default})


def mandatory_fields(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if "default" not in f.metadata])


def optional_fields(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if "default" in f.metadata])


def missing_fields(have: T.StructType, want: T.StructType) -> T.StructType:
    return T.StructType([f for f in want if f.name not in have.names])


def require_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df``, if it has every mandatory column; the error names all that it lacks."""
    if lacking := missing_fields(df.schema, mandatory_fields(schema)).names:
        raise SchemaError(f"missing columns: {', '.join(lacking)}")
    return df


def drop_unknown(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*(col(c) for c in df.columns if c in schema.names))


def add_missing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that the schema has and ``df`` lacks, filled with their default or null."""
    new = {f.name: F.lit(f.metadata.get("default")).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in missing_fields(df.schema, schema)}
    return df.withColumns(new) if new else df


def reorder(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*(col(n) for n in schema.names))


def require_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that the schema doesn't let be null become non-nullable; a null fails the job that
    uses the column. null_violations() counts them instead."""

    def checked(f: T.StructField):
        if f.nullable:
            return col(f.name)
        # the last value is never reached; it tells Spark that the column can't be null
        return F.coalesce(col(f.name), F.raise_error(f"null in column {f.name}").cast(f.dataType), _some_value(f.dataType)).alias(f.name)

    return df.select(*(checked(f) for f in schema))


def _some_value(kind: T.DataType):
    if isinstance(kind, T.StructType):
        return F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in kind))
    if isinstance(kind, T.MapType):
        return F.create_map().cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast("date").cast(kind)
    return F.lit("" if isinstance(kind, (T.StringType, T.BinaryType)) else False if isinstance(kind, T.BooleanType) else 0).cast(kind)


def null_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: for each non-nullable field the number of nulls."""
    return df.agg(*(F.count_if(col(f.name).isNull()).alias(f.name) for f in schema if not f.nullable))


def cast_columns(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Each column in its declared type. What can't be read becomes null (``strict``: fails), and a
    null where the schema has none fails."""
    kept = df.select(*((col(f.name).cast(f.dataType) if strict else col(f.name).try_cast(f.dataType)).alias(f.name) for f in schema))
    return require_values(kept, schema)


def apply_schema_soft(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Names and order of the schema: check, drop, fill in, reorder."""
    return reorder(add_missing(drop_unknown(require_columns(df, schema), schema), schema), schema)


def apply_schema(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """apply_schema_soft(), and the types and nullability of the schema."""
    return cast_columns(apply_schema_soft(df, schema), schema, strict)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def normalized_name(name: str) -> str:
    """Lower case, no accents, every run of other characters an underscore."""
    bare = "".join(c for c in unicodedata.normalize("NFD", name) if not unicodedata.combining(c))
    return re.sub(r"[^A-Za-z0-9_]+", "_", bare).lower()


def normalize_names(df: DataFrame) -> DataFrame:
    names = [normalized_name(c) for c in df.columns]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise SchemaError(f"several columns would be called {', '.join(twice)}")
    return df.toDF(*names)


def trim_all(df: DataFrame) -> DataFrame:
    """String columns without white space at the ends; empty ones become null."""
    texts = {f.name: trimmed(col(f.name)) for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns(texts) if texts else df


def remove_blank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is neither null nor blank."""
    return df.where(col(column).isNotNull() & (F.trim(col(column).cast("string")) != ""))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def pivot(df: DataFrame, by: list[str], key: str, value, levels: list | None = None, most: int = 10_000) -> DataFrame:
    """A column per level of ``key`` with the aggregate ``value``; levels that a group lacks are null.

    Without ``levels`` the distinct non-null keys are looked up first; more than ``most`` are an error.
    """
    if levels is None:
        levels = sorted(r[0] for r in df.where(col(key).isNotNull()).select(col(key).cast("string").alias("k")).distinct().limit(most + 1).collect())
        if len(levels) > most:
            raise SchemaError(f"column {key} has more than {most} levels")
    return df.groupBy(*(col(c) for c in by)).pivot(key, levels).agg(value)


def with_sequence(df: DataFrame, name: str, start: int = 0, by: str | None = None) -> DataFrame:
    """Numbers start + 1, start + 2, ... in the order of ``by`` (default: the first column); ties by
    the other columns.

    Rows are dealt out by ranges of the order and numbered in each range; only the ranges' counts
    meet in one place. The ranges are stored in between, so they are cut once.
    """
    from tablewright.sources.staging import stored

    order = [col(by or df.columns[0]), *(col(c) for c in df.columns if c != (by or df.columns[0]))]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    ranged = stored(ranged, "sequence")
    sums = ranged.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(offsets, "_part").withColumn(name, F.lit(start) + F.col("_before") + local).drop("_part", "_before")


def remove_duplicates(df: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """One row per key, the smallest in the order of all columns; and the rows removed, each as often
    as it was removed.

    The kept rows are minima, partly taken before the shuffle, and the others are the rows less
    those by multiplicity: equal rows are counted, so no task gets all the rows of a key.
    """
    keys = keys or tuple(df.columns)
    least = df.groupBy(*(col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.min(F.struct(*(col(c) for c in df.columns))).alias("_row"))
    kept = least.select(*(F.col("_row").getField(c).alias(c) for c in df.columns))
    return kept, df.exceptAll(kept)


def union_missing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both; a column that one side lacks has the other side's default or null there."""
    return add_missing(a, b.schema).unionByName(add_missing(b, a.schema))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all; columns whose names differ only in case are one column, named by the first."""
    names: dict[str, str] = {}
    for df in frames:
        for c in df.columns:
            names.setdefault(c.lower(), c)
    same = [df.withColumnsRenamed({c: names[c.lower()] for c in df.columns}) for df in frames]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), same)
