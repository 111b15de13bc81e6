"""A catalog of databases, schemas, tables, columns and references, with inferred keys."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.profile import null_percent
from tablewright.operators.versioning import merge
from tablewright.sources.staging import stored

#: Names of the catalog's columns, and the source systems known by table prefix.
TABLE_KEY = ("lib_database", "lib_schema", "lib_table")
SOURCES = ("orbis", "hegp", "mediweb", "phedra", "glims", "general", "arem", "ems")


# extraction
def scan_catalog(spark: SparkSession, database: str) -> DataFrame:
    """One row per column of a database's tables and views, from Spark's catalog."""
    rows = []
    for table in spark.catalog.listTables(database):
        for i, c in enumerate(spark.catalog.listColumns(f"`{database}`.`{table.name}`")):
            rows.append((database, database, table.name, "view" if table.tableType in ("VIEW", "TEMPORARY") else "table", c.name, c.dataType, i + 1, not c.nullable, c.description))
    return spark.createDataFrame(rows, "lib_database string, lib_schema string, lib_table string, typ_table string, lib_column string, typ_column string, order_column int, is_mandatory boolean, comment_fonctionnel string")


FIELDS = "struct<type: string, fields: array<struct<name: string, type: string, nullable: boolean>>>"


def columns_of_json(tables: DataFrame, schema_column: str = "schema") -> DataFrame:
    """Tables with a stored JSON schema as one row per column: order_column, lib_column, typ_column,
    is_mandatory. Nested types come as ``struct``-like JSON text."""
    parsed = tables.withColumn("_f", F.from_json(schema_column, FIELDS))
    opened = parsed.select(*(c for c in tables.columns if c != schema_column), F.posexplode("_f.fields").alias("_pos", "_c"))
    return opened.select(*(c for c in tables.columns if c != schema_column), (F.col("_pos") + 1).alias("order_column"), F.col("_c.name").alias("lib_column"), F.col("_c.type").alias("typ_column"), (~F.col("_c.nullable")).alias("is_mandatory"))


def with_statistics(columns: DataFrame, nulls: DataFrame, distincts: DataFrame) -> DataFrame:
    """Columns with count_null and null_ratio (of count_table), and count_distinct, where known."""
    keys = [*TABLE_KEY, "lib_column"]
    out = columns.join(nulls, keys, "left").join(distincts, keys, "left")
    return out.withColumn("null_ratio", null_percent(F.col("count_null"), F.col("count_table")))


def with_last_change(tables: DataFrame, changes: DataFrame, at: str) -> DataFrame:
    """Tables with last_change: the newest ``at`` of their rows in a log of changes."""
    newest = changes.groupBy(*TABLE_KEY).agg(F.max(at).alias("last_change"))
    return tables.join(newest, list(TABLE_KEY), "left")


def in_order(df: DataFrame) -> DataFrame:
    """By schema, table and, for columns, position."""
    return df.orderBy(*(c for c in ("lib_schema", "lib_table", "order_column") if c in df.columns))


# features
def source_by_prefix(df: DataFrame, known: tuple[str, ...] = SOURCES, default: str = "orbis") -> DataFrame:
    prefix = F.regexp_extract("lib_table", "^([^_]+)_.*$", 1)
    return df.withColumn("outil_source", F.when(prefix.isin(*known), prefix).otherwise(default))


def constant_source(name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn("outil_source", F.lit(name))


def keys_by_name(primary: str | Callable[[], Column], foreign: str | Callable[[], Column] | None = None) -> Callable[[DataFrame], DataFrame]:
    """Columns that look like keys, by a pattern of their name or a condition: the first of a table
    is its primary key, others are foreign (by ``foreign``, if that differs)."""
    condition = lambda p: F.col("lib_column").rlike(p) if isinstance(p, str) else p()

    def add(df: DataFrame) -> DataFrame:
        first = F.col("order_column") == 1
        own, other = condition(primary), condition(foreign or primary)
        return df.withColumns({"is_pk": F.coalesce(own & first, F.lit(False)), "is_fk": F.coalesce(other & ~first, F.lit(False))})

    return add


#: How many columns of one name a task joins.
TOGETHER = 100_000
REFERENCE = ("lib_database", "lib_schema", "lib_table", "lib_column")


def inferred(df: DataFrame, normal: Callable[[Column], Column], target: Callable[[Column], Column] | None = None, same: tuple[str, ...] = ("lib_schema",), sources: Column | None = None) -> DataFrame:
    """References from foreign to primary keys whose normalised names are equal, between different
    tables that agree in the columns ``same``. An equi-join: the catalog may be large, and so may the
    number of columns of one name, which are dealt out by ``TOGETHER``, each part with the keys it meets."""
    s = df.where(F.col("is_fk")) if sources is None else df.where(F.col("is_fk") & sources)
    s = s.withColumn("_k", normal(F.col("lib_column")))
    t = df.where(F.col("is_pk")).withColumn("_k", (target or normal)(F.col("lib_column")))
    # at most a row for every TOGETHER columns
    parts = s.groupBy("_k", *same).count().where(F.col("count") > TOGETHER).select("_k", *same, F.expr(f"1 + count div {TOGETHER}").alias("_parts"))
    n_parts = F.coalesce("_parts", F.lit(1))
    s = s.join(F.broadcast(parts), ["_k", *same], "left").withColumn("_part", F.pmod(F.xxhash64(*REFERENCE), n_parts)).alias("s")
    t = t.join(F.broadcast(parts), ["_k", *same], "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), n_parts - 1))).alias("t")
    on = (F.col("s._k") == F.col("t._k")) & (F.col("s._part") == F.col("t._part")) & (F.col("s.lib_table") != F.col("t.lib_table"))
    for c in same:
        on = on & (F.col(f"s.{c}") == F.col(f"t.{c}"))
    return s.join(t, on).select(*(F.col(f"s.{c}").alias(f"{c}_source") for c in REFERENCE), *(F.col(f"t.{c}").alias(f"{c}_target") for c in REFERENCE), F.lit("FK").alias("lib_reference"))


def _without_ref(c: Column) -> Column:
    return F.regexp_replace(c, "_ref_", "")


def _concept(c: Column) -> Column:
    return F.regexp_replace(c, r".*_concept_id$|concept_id_\d$", "concept_id")


def _same(c: Column) -> Column:
    return c


def default_references(df: DataFrame) -> DataFrame:
    """Equal names but for ``_ref_``, within a source and schema; concept columns in omop schemas."""
    plain = inferred(df, _without_ref, same=("lib_schema", "outil_source"), sources=~F.col("lib_column").rlike("^ids_eds"))
    return plain.union(inferred(df, _concept, _same, sources=F.col("lib_schema").rlike("omop")))


#: The one table of categories and its key.
CATEGORY = ("orbis_ref_cat", "ids_ref_cat")


def category_references(df: DataFrame) -> DataFrame:
    """Equal names but for ``_ref_``, or a category column to the one table of categories: two
    equi-joins, as a join on either condition would compare every pair."""
    usual = ~F.col("lib_column").rlike("^ids_eds")
    plain = inferred(df, _without_ref, same=("lib_schema", "outil_source"), sources=usual)
    target = (F.col("lib_table") == CATEGORY[0]) & (F.col("lib_column") == CATEGORY[1])
    marked = inferred(df.withColumn("is_pk", target), lambda c: F.lit(1), same=("lib_schema", "outil_source"), sources=usual & F.col("lib_column").rlike("_cat_"))
    return plain.union(marked).distinct()


def concept_references(df: DataFrame) -> DataFrame:
    return inferred(df, _concept, _same)


def equal_references(df: DataFrame) -> DataFrame:
    return inferred(df, _same)


def equal_references_in_source(df: DataFrame) -> DataFrame:
    return inferred(df, _same, same=("lib_schema", "outil_source"))


@dataclass(frozen=True)
class Strategy:
    """How a source's catalog gets its features; each part is a function of the column table."""

    source: Callable[[DataFrame], DataFrame] = source_by_prefix
    keys: Callable[[DataFrame], DataFrame] = keys_by_name(lambda: F.col("lib_column").rlike("^ids_") | (F.col("lib_schema").rlike("omop") & F.col("lib_column").rlike("_id$")))
    references: Callable[[DataFrame], DataFrame] = default_references


#: The strategies by name; the key patterns are fixed values.
STRATEGIES: dict[str, Strategy] = {
    "default": Strategy(),
    "eds": Strategy(keys=keys_by_name("^ids_"), references=category_references),
    "omop": Strategy(constant_source("omop"), keys_by_name("_id$", "_id$|_id_[0-9]$"), concept_references),
    "i2b2": Strategy(constant_source("i2b2"), keys_by_name("_num$|concept_cd$"), equal_references),
    "covidom": Strategy(constant_source("covidom"), keys_by_name("_id$"), equal_references_in_source),
}


def register(name: str, strategy: Strategy) -> None:
    """Make a strategy of one's own available by name, as configurations name it."""
    STRATEGIES[name] = strategy


# assembly
@dataclass(frozen=True)
class Catalog:
    database: DataFrame
    schema: DataFrame
    table: DataFrame
    column: DataFrame
    reference: DataFrame = field(repr=False)


def assemble(columns: DataFrame, strategy: Strategy | str = "default", schemas: str | None = None) -> Catalog:
    """The five tables of a column catalog; ``schemas``: a pattern of schemas to take."""
    strategy = STRATEGIES[strategy] if isinstance(strategy, str) else strategy
    chosen = columns.where(F.col("lib_schema").rlike(schemas)) if schemas else columns
    full = stored(strategy.keys(strategy.source(chosen)), "catalog-columns")
    # grouping texts sorts them, so a task gets a part of the rows first, however dense the files are
    dealt = full.repartition(*TABLE_KEY)
    return Catalog(databases(full), schemas_of(full), tables_of(dealt), columns_of(dealt), strategy.references(full))


def databases(df: DataFrame) -> DataFrame:
    return df.select("lib_database").distinct()


def schemas_of(df: DataFrame) -> DataFrame:
    return df.select("lib_database", "lib_schema").distinct()


def tables_of(df: DataFrame) -> DataFrame:
    own = [c for c in ("typ_table", "count_table", "outil_source", "last_analyze") if c in df.columns]
    return df.groupBy(*TABLE_KEY).agg(*(F.max(c).alias(c) for c in own)) if own else df.select(*TABLE_KEY).distinct()


def columns_of(df: DataFrame) -> DataFrame:
    keys = [*TABLE_KEY, "lib_column"]
    return df.groupBy(*keys).agg(*(F.max(c).alias(c) for c in df.columns if c not in keys))


# loading
def looked_up(df: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the surrogate ids of its parents, null where there is none."""
    return df.join(lookup, keys, "left")


def load_level(stored_rows: DataFrame | None, found: DataFrame, keys: list[str], parents: list[tuple[DataFrame, list[str]]] = (), schemas: str | None = None) -> DataFrame:
    """A catalog table after a load: rows found are active, rows of the same schemas that are no
    longer found turn inactive, others stay."""
    for lookup, on in parents:
        found = looked_up(found, lookup, on)
    found = found.withColumn("is_active", F.lit(True))
    if stored_rows is None:
        return found
    scope = F.col("lib_schema").rlike(schemas) if schemas and "lib_schema" in stored_rows.columns else None
    return merge(stored_rows, found, keys, in_scope=scope, set_unmatched={"is_active": F.lit(False)})


# views on the catalog
def active_view(df: DataFrame, overridable: list[str], suffix: str = "_m") -> DataFrame:
    """Active rows, with manual values in place of extracted ones where there are any; whether a
    row is active may itself be overridden."""
    active = F.coalesce(f"is_active{suffix}", "is_active") if f"is_active{suffix}" in df.columns else F.col("is_active")
    return df.where(active).select(*(F.coalesce(f"{c}{suffix}", c).alias(c) if c in overridable else F.col(c) for c in df.columns if not (c.endswith(suffix) and c[: -len(suffix)] in overridable)))


def override(df: DataFrame, edits: DataFrame, key: str, allowed: list[str], suffix: str = "_m") -> DataFrame:
    """Manual values from ``edits`` (key and columns of ``allowed``) in the override columns."""
    columns = [c for c in edits.columns if c != key]
    if unknown := sorted(set(columns) - set(allowed)):
        raise ValueError(f"columns that can't be edited: {', '.join(unknown)}")
    named = edits.withColumnsRenamed({c: f"{c}{suffix}" for c in columns})
    return merge(df, named, [key], columns=[f"{c}{suffix}" for c in columns], mode="u")


def distinct_references(refs: DataFrame) -> DataFrame:
    """One row for each source and target column."""
    return refs.dropDuplicates([f"{c}_{side}" for c in REFERENCE for side in ("source", "target")])


def table_links(refs: DataFrame) -> DataFrame:
    """Linked tables a, b: each pair once, whichever way its references point."""
    pairs = refs.where("lib_table_source <> lib_table_target").select(F.least("lib_table_source", "lib_table_target").alias("a"), F.greatest("lib_table_source", "lib_table_target").alias("b"))
    return pairs.distinct()


def table_summary(columns: DataFrame, refs: DataFrame) -> DataFrame:
    """Per table: n_columns, n_parents (tables it refers to) and n_children (that refer to it)."""
    size = columns.groupBy("lib_table").agg(F.count("*").alias("n_columns"))
    up = refs.groupBy(F.col("lib_table_source").alias("lib_table")).agg(F.count_distinct("lib_table_target").alias("n_parents"))
    down = refs.groupBy(F.col("lib_table_target").alias("lib_table")).agg(F.count_distinct("lib_table_source").alias("n_children"))
    return size.join(up, "lib_table", "left").join(down, "lib_table", "left").na.fill(0, ["n_parents", "n_children"])
