"""CSV with declared schemas, single-file exports, and JSON-lines documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.scalars import to_second
from tablewright.operators.schema import apply_schema_soft, cast_columns, col, remove_blank, string_schema
from tablewright.sources.staging import file_system

CORRUPT = "_corrupt_record"


def headers(spark: SparkSession, path: str, delimiter: str = ",") -> list[str]:
    return spark.read.options(header=True, sep=delimiter, quote='"', escape='"').csv(path).columns


def read_raw(spark: SparkSession, path: str, delimiter: str = ",", escape: str = '"', multiline: bool = False) -> DataFrame:
    """All columns as text; a row with more or fewer columns than the header fails the job."""
    names = headers(spark, path, delimiter)
    schema = string_schema([*names, CORRUPT])
    rows = spark.read.options(header=True, sep=delimiter, quote='"', escape=escape, multiLine=multiline, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=True).schema(schema).csv(path)
    bad = F.raise_error(F.concat(F.lit("bad row: "), F.col(CORRUPT))).cast("string")
    first = F.when(F.col(CORRUPT).isNotNull(), bad).otherwise(col(names[0])).alias(names[0])
    return rows.select(first, *(col(n) for n in names[1:]))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    delimiter: str = ",",
    escape: str = '"',
    multiline: bool = False,
    date_format: str | None = None,
    timestamp_format: str | None = None,
    not_blank: str | None = None,
    cast: bool = True,
) -> DataFrame:
    """A file with a header in the schema's columns, order and types, by name.

    Columns with a ``default`` in their metadata may be absent. ``not_blank`` names a column whose
    blank rows go. Values that don't fit their type are null, and nulls must be allowed.
    """
    rows = apply_schema_soft(read_raw(spark, path, delimiter, escape, multiline), schema)
    if not_blank:
        rows = remove_blank(rows, not_blank)
    if not cast:
        return rows
    for f in schema:
        pattern = date_format if isinstance(f.dataType, T.DateType) else timestamp_format if isinstance(f.dataType, T.TimestampType) else None
        if pattern and isinstance(rows.schema[f.name].dataType, T.StringType):
            rows = rows.withColumn(f.name, to_second(col(f.name), pattern))
    return cast_columns(rows, schema)


#: How files are written: an empty text is "", null is nothing, white space stays.
WRITE = {"quote": '"', "escape": '"', "emptyValue": '""', "nullValue": None, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False, delimiter: str = ",") -> None:
    df.write.options(**{k: v for k, v in WRITE.items() if v is not None}, header=header, sep=delimiter).mode(mode).csv(path)


def export_one_file(df: DataFrame, path: str, fmt: str = "csv", header: bool = True, delimiter: str = ",") -> None:
    """One file at ``path``, there complete or not at all. Written by one task: for exports that a
    person will open. ``fmt``: csv, or text for a single text column."""
    if fmt not in ("csv", "text"):
        raise ValueError(f"format {fmt}: csv or text")
    spark, beside = df.sparkSession, f"{path}.{uuid.uuid4().hex}"
    if fmt == "csv":
        write_csv(df.coalesce(1), beside, header=header, delimiter=delimiter)
    else:
        df.coalesce(1).write.text(beside)
    fs, target = file_system(spark, path)
    _, folder = file_system(spark, beside)
    part = next(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(part, target)
    fs.delete(folder, True)


def write_each_row(df: DataFrame, name: str, content: str, path: str) -> None:
    """A file ``{name}.txt`` per row, in a folder per name: ``path/{name}.txt/part-...``.

    Spark's writer deals rows out to the folders, so nothing passes through the driver and the
    files may be in any store. Rows are dealt out over all tasks first: a small input is one task's, and
    files are what costs here.
    """
    out = df.select(col(content).cast("string").alias("value"), F.concat(col(name).cast("string"), F.lit(".txt")).alias("file"))
    cores = df.sparkSession.sparkContext.defaultParallelism
    out.repartition(4 * cores, "file").write.partitionBy("file").mode("overwrite").text(path)


def load_csv_folder(spark: SparkSession, path: str, pattern: str, schema: T.StructType, delimiter: str = ",") -> DataFrame:
    """The files of a folder that match a glob pattern, without headers, in the schema's columns."""
    text = spark.read.options(sep=delimiter, quote='"', escape='"', pathGlobFilter=pattern).schema(string_schema(schema.names)).csv(path)
    return cast_columns(text, schema)


def read_documents(spark: SparkSession, path: str, schema: T.StructType, since: str | None = None, date_field: str | None = None) -> DataFrame:
    """A collection of JSON documents, from a date on; what doesn't fit a type is null."""
    rows = spark.read.schema(schema).json(path)
    return rows.where(col(date_field) >= F.lit(since).cast(schema[date_field].dataType)) if since and date_field else rows
