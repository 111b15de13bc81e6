"""A database as one of Spark's catalogs: its tables, columns, keys and indexes, DDL, statistics.

Listing, types, CREATE, RENAME and DROP go through Spark's JDBC catalog, and so do scans, whose
filters and aggregates the database answers. Keys, indexes and defaults come from the driver's
metadata, a few rows a column.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.profile import null_percent
from tablewright.operators.schema import SchemaError, col

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"
#: Types whose values databases neither compare nor count by value.
LARGE = ("CLOB", "BLOB", "LONG", "TEXT", "XML", "JSON")


@contextmanager
def connection(spark: SparkSession, db):
    """A connection of the driver's, closed at the end."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    login = jvm.java.util.Properties()
    for key, value in (("user", db.user), ("password", db.password)):
        if value is not None:
            login.setProperty(key, value)
    kind = jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(db.driver)
    driver = kind.getDeclaredConstructor(gateway.new_array(jvm.java.lang.Class, 0)).newInstance(gateway.new_array(jvm.java.lang.Object, 0))
    opened = driver.connect(db.url, login)
    try:
        yield opened
    finally:
        opened.close()


def execute(spark: SparkSession, db, statements: list[str | tuple]) -> list[int]:
    """Run statements, each a text or (text, values for its question marks), in one transaction on the
    driver; how many rows each changed. None of them holds if one fails."""
    with connection(spark, db) as c:
        c.setAutoCommit(False)
        changed = []
        try:
            for statement in statements:
                text, values = (statement, ()) if isinstance(statement, str) else statement
                prepared = c.prepareStatement(text)
                for i, value in enumerate(values):
                    prepared.setObject(i + 1, value)
                changed.append(prepared.executeUpdate())
                prepared.close()
            c.commit()
        except Exception:
            c.rollback()
            raise
        return changed


def _rows(found, *names: str) -> list[dict]:
    out = []
    while found.next():
        out.append({n: found.getString(n) for n in names})
    found.close()
    return out


# the catalog
def attach(spark: SparkSession, db) -> str:
    """Make the database a catalog of this session; its name, one for each URL and user."""
    name = "tw_" + hashlib.sha256(f"{db.url} {db.user}".encode()).hexdigest()[:16]
    base = f"spark.sql.catalog.{name}"
    if spark.conf.get(base, None) is None:
        own = db.options() | {"pushDownAggregate": "true", "pushDownLimit": "true", "preferTimestampNTZ": "true"}
        for key, value in own.items():
            spark.conf.set(f"{base}.{key}", value)
        spark.conf.set(base, JDBC_CATALOG)
    return name


@dataclass(frozen=True)
class Name:
    """A table as the database spells it."""

    schema: str
    table: str

    def quoted(self, db) -> str:
        return f"{db.name(self.schema)}.{db.name(self.table)}"


def resolve(spark: SparkSession, db, table: str) -> Name:
    """``table`` or ``schema.table``, in quotes or not, as SQL of this database would find it."""
    with connection(spark, db) as c:
        return _resolve(c, db, table)


def _resolve(c, db, table: str) -> Name:
    meta = c.getMetaData()
    fold = str.upper if meta.storesUpperCaseIdentifiers() else str.lower if meta.storesLowerCaseIdentifiers() else str
    spelt = [p.strip(db.quote) if p.startswith(db.quote) else fold(p) for p in table.split(".")]
    return Name(spelt[0] if len(spelt) > 1 else c.getSchema(), spelt[-1])


def table(spark: SparkSession, db, name: str) -> DataFrame:
    """A table of the database; filters, limits and aggregates on it are the database's work."""
    n = resolve(spark, db, name)
    return spark.table(f"{attach(spark, db)}.`{n.schema}`.`{n.table}`")


def table_names(spark: SparkSession, db, schema: str | None = None) -> list[str]:
    with connection(spark, db) as c:
        schema = schema or c.getSchema()
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {attach(spark, db)}.`{schema}`").collect())


# structure
@dataclass(frozen=True)
class ColumnInfo:
    name: str
    type: str
    nullable: bool
    default: str | None
    position: int
    comment: str | None


@dataclass(frozen=True)
class Index:
    name: str
    columns: tuple[str, ...]
    unique: bool


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    target: Name
    target_columns: tuple[str, ...]


@dataclass(frozen=True)
class Structure:
    """What a table is besides its rows. Check constraints, triggers and grants are not in it, as
    drivers don't tell them."""

    name: Name
    columns: tuple[ColumnInfo, ...]
    primary_key: tuple[str, ...] = ()
    indexes: tuple[Index, ...] = ()
    references: tuple[Reference, ...] = ()
    referred_by: tuple[str, ...] = ()

    def column(self, name: str) -> ColumnInfo | None:
        return next((c for c in self.columns if c.name == name), None)


#: Type names that take a length, and those that take precision and scale.
SIZED, SCALED = ("CHAR", "VARCHAR", "CHARACTER VARYING", "NVARCHAR", "BPCHAR"), ("DECIMAL", "NUMERIC")


def _declared(kind: str, size: str | None, digits: str | None) -> str:
    if kind.upper() in SCALED:
        return f"{kind}({size},{digits or 0})"
    return f"{kind}({size})" if kind.upper() in SIZED and size and int(size) < 1 << 24 else kind


def structure(spark: SparkSession, db, table: str) -> Structure:
    """The columns, primary key and indexes of a table, by the driver's metadata."""
    with connection(spark, db) as c:
        name = _resolve(c, db, table)
        return _structure(c, name)


def _structure(c, name: Name) -> Structure:
    meta = c.getMetaData()
    where = (c.getCatalog(), name.schema, name.table)
    found = _rows(meta.getColumns(*where, "%"), "COLUMN_NAME", "TYPE_NAME", "COLUMN_SIZE", "DECIMAL_DIGITS", "IS_NULLABLE", "COLUMN_DEF", "ORDINAL_POSITION", "REMARKS")
    if not found:
        raise SchemaError(f"no table {name.schema}.{name.table}")
    columns = sorted((ColumnInfo(r["COLUMN_NAME"], _declared(r["TYPE_NAME"], r["COLUMN_SIZE"], r["DECIMAL_DIGITS"]), r["IS_NULLABLE"] != "NO", r["COLUMN_DEF"], int(r["ORDINAL_POSITION"]), r["REMARKS"] or None) for r in found), key=lambda x: x.position)
    key = sorted(_rows(meta.getPrimaryKeys(*where), "COLUMN_NAME", "KEY_SEQ", "PK_NAME"), key=lambda r: int(r["KEY_SEQ"]))
    primary = tuple(r["COLUMN_NAME"] for r in key)
    grouped: dict[str, list[dict]] = {}
    for r in _rows(meta.getIndexInfo(*where, False, True), "INDEX_NAME", "COLUMN_NAME", "NON_UNIQUE", "ORDINAL_POSITION"):
        if r["INDEX_NAME"]:
            grouped.setdefault(r["INDEX_NAME"], []).append(r)
    indexes = []
    for index, rows in sorted(grouped.items()):
        names = tuple(r["COLUMN_NAME"] for r in sorted(rows, key=lambda r: int(r["ORDINAL_POSITION"])))
        unique = rows[0]["NON_UNIQUE"].lower() in ("0", "f", "false")
        if not (unique and names == primary):  # the index of the primary key itself
            indexes.append(Index(index, names, unique))
    links: dict[str, list[dict]] = {}
    for r in _rows(meta.getImportedKeys(*where), "FK_NAME", "FKCOLUMN_NAME", "PKTABLE_SCHEM", "PKTABLE_NAME", "PKCOLUMN_NAME", "KEY_SEQ"):
        links.setdefault(r["FK_NAME"], []).append(r)
    references = []
    for rows in links.values():
        rows.sort(key=lambda r: int(r["KEY_SEQ"]))
        references.append(Reference(tuple(r["FKCOLUMN_NAME"] for r in rows), Name(rows[0]["PKTABLE_SCHEM"], rows[0]["PKTABLE_NAME"]), tuple(r["PKCOLUMN_NAME"] for r in rows)))
    owned = {tuple(r.columns) for r in references}
    indexes = [i for i in indexes if i.unique or i.columns not in owned]  # the index of a reference itself
    others = {r["FKTABLE_NAME"] for r in _rows(meta.getExportedKeys(*where), "FKTABLE_NAME")} - {name.table}
    return Structure(name, tuple(columns), primary, tuple(indexes), tuple(references), tuple(sorted(others)))


def spark_type_in(spark: SparkSession, db, kind: T.DataType) -> str:
    """The database's type for one of Spark's, by its dialect."""
    jvm = spark._jvm
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(db.url)
    return jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.getJdbcType(jvm.org.apache.spark.sql.types.DataType.fromJson(kind.json()), dialect).databaseTypeDefinition()


def create_statement(spark: SparkSession, db, like: Structure | None, name: str, schema: T.StructType) -> str:
    """CREATE TABLE for rows of ``schema``: columns that ``like`` has keep their type, default and
    nullability; others get the dialect's type. The primary key and references come along where all
    their columns do."""
    like, parts = like or Structure(Name("", name), ()), []
    for f in schema:
        old = like.column(f.name)
        if old is None:
            parts.append(f"{db.name(f.name)} {spark_type_in(spark, db, f.dataType)}")
            continue
        default = f" DEFAULT {old.default}" if old.default is not None and not old.default.upper().startswith("AUTOINCREMENT") else ""
        parts.append(f"{db.name(f.name)} {old.type}{default}{'' if old.nullable else ' NOT NULL'}")
    if like.primary_key and set(like.primary_key) <= set(schema.names):
        parts.append(f"PRIMARY KEY ({', '.join(map(db.name, like.primary_key))})")
    for r in like.references:
        if set(r.columns) <= set(schema.names):
            parts.append(f"FOREIGN KEY ({', '.join(map(db.name, r.columns))}) REFERENCES {r.target.quoted(db)} ({', '.join(map(db.name, r.target_columns))})")
    return f"CREATE TABLE {name} ({', '.join(parts)})"


def as_declared(spark: SparkSession, db, like: Structure, schema: T.StructType, table: str = "") -> dict[str, str]:
    """For columns that Spark's writer has put down in the dialect's types: expressions of the types
    that ``like`` has."""
    out = {}
    for f in schema:
        name, old = (f"{table}." if table else "") + db.name(f.name), like.column(f.name)
        same = old is None or old.type.upper() == spark_type_in(spark, db, f.dataType).upper()
        out[f.name] = name if same else f"CAST({name} AS {old.type})"
    return out


def require_room(spark: SparkSession, db, like: Structure, schema: T.StructType, stage: str) -> None:
    """An error where a text is longer than its column, as a cast would cut it."""
    from tablewright.sources.jdbc import read_query

    sizes = {f.name: int(old.type.split("(")[1].rstrip(")")) for f in schema if isinstance(f.dataType, T.StringType) and (old := like.column(f.name)) and "(" in old.type and old.type.split("(")[0].upper() in SIZED}
    if not sizes:
        return
    counts = ", ".join(f"SUM(CASE WHEN LENGTH({db.name(c)}) > {n} THEN 1 ELSE 0 END) AS c{i}" for i, (c, n) in enumerate(sizes.items()))
    found = read_query(spark, db, f"SELECT {counts} FROM {stage}").first()
    if long := [c for c, n in zip(sizes, found, strict=True) if n]:
        raise ValueError(f"texts too long for {', '.join(long)}")


def kept_indexes(like: Structure, columns: list[str]) -> list[Index]:
    return [i for i in like.indexes if set(i.columns) <= set(columns)]


def index_statements(db, indexes: list[Index], table: str, suffix: str = "") -> list[str]:
    return [f"CREATE {'UNIQUE ' * i.unique}INDEX {db.name(i.name + suffix)} ON {table} ({', '.join(map(db.name, i.columns))})" for i in indexes]


# tables by Spark's DDL
def _qualified(spark: SparkSession, db, name: str) -> str:
    n = resolve(spark, db, name)
    return f"{attach(spark, db)}.`{n.schema}`.`{n.table}`"


def create_table(spark: SparkSession, db, name: str, schema: T.StructType, primary_key: list[str] = ()) -> None:
    """An empty table of Spark's types (VarcharType for short texts), if there is none."""
    full = _qualified(spark, db, name)
    if spark.catalog.tableExists(full):
        return
    spark.sql(f"CREATE TABLE {full} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' + ' NOT NULL' * (not f.nullable or f.name in primary_key) for f in schema)})")
    if primary_key:
        execute(spark, db, [f"ALTER TABLE {resolve(spark, db, name).quoted(db)} ADD PRIMARY KEY ({', '.join(map(db.name, primary_key))})"])


def copy_structure(spark: SparkSession, db, source: str, target: str) -> None:
    """An empty table with the columns, key, defaults and indexes of ``source``; the indexes get the
    target's name in front of theirs."""
    like = structure(spark, db, source)
    n = resolve(spark, db, target)
    schema = T.StructType([T.StructField(c.name, T.StringType()) for c in like.columns])
    renamed = Structure(n, like.columns, like.primary_key, tuple(Index(f"{n.table}_{i.name}", i.columns, i.unique) for i in like.indexes), like.references)
    execute(spark, db, [create_statement(spark, db, renamed, n.quoted(db), schema), *index_statements(db, list(renamed.indexes), n.quoted(db))])


def exists(spark: SparkSession, db, name: str) -> bool:
    return spark.catalog.tableExists(_qualified(spark, db, name))


def is_empty(spark: SparkSession, db, name: str) -> bool:
    return table(spark, db, name).limit(1).count() == 0


def truncate(spark: SparkSession, db, name: str) -> None:
    execute(spark, db, [f"TRUNCATE TABLE {resolve(spark, db, name).quoted(db)}"])


def drop(spark: SparkSession, db, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_qualified(spark, db, name)}")


def rename(spark: SparkSession, db, name: str, new: str) -> None:
    """In its schema; both names as resolve() spells them."""
    a, b = resolve(spark, db, name), resolve(spark, db, new)
    execute(spark, db, [db.rename.format(old=a.quoted(db), new=db.name(b.table))])


# what a catalog says of columns
COLUMNS = "lib_database string, lib_schema string, lib_table string, typ_table string, lib_column string, typ_column string, order_column int, is_mandatory boolean, comment_fonctionnel string, is_index boolean, index_name string, primarykey boolean, uniquekey boolean"


def scan_columns(spark: SparkSession, db, database: str, schema: str | None = None, names: list[str] | None = None) -> DataFrame:
    """One row for each column of a schema's tables and views, with its key and indexes; from
    metadata, so as many rows on the driver as there are columns."""
    rows = []
    with connection(spark, db) as c:
        schema = schema or c.getSchema()
        kinds = {r["TABLE_NAME"]: r["TABLE_TYPE"] for r in _rows(c.getMetaData().getTables(c.getCatalog(), schema, "%", None), "TABLE_NAME", "TABLE_TYPE")}
        for name in sorted(kinds if names is None else set(names) & set(kinds)):
            found = _structure(c, Name(schema, name))
            for x in found.columns:
                own = [i for i in found.indexes if x.name in i.columns]
                alone = any(i.unique and i.columns == (x.name,) for i in own)
                rows.append((database, schema, name, "view" if "VIEW" in kinds[name] else "table", x.name, x.type, x.position, not x.nullable, x.comment, bool(own) or x.name in found.primary_key, ", ".join(i.name for i in own) or None, x.name in found.primary_key, alone or found.primary_key == (x.name,)))
    return spark.createDataFrame(rows, COLUMNS)


def column_statistics(spark: SparkSession, db, names: list[str], distinct: bool = True) -> DataFrame:
    """lib_schema, lib_table, lib_column, count_table, count_null, null_ratio and count_distinct.

    The database counts: rows and values of a table in one query, distinct values in one for each
    column. Large objects, which it doesn't compare, are counted by Spark from their digests.
    """
    parts = []
    for name in names:
        df, made = table(spark, db, name), structure(spark, db, name)
        counts = df.agg(F.count("*").alias("n"), *(F.count(col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)))
        own = [F.struct(F.lit(c).alias("lib_column"), F.col("n").alias("count_table"), (F.col("n") - F.col(f"c{i}")).alias("count_null")) for i, c in enumerate(df.columns)]
        rows = counts.select(F.inline(F.array(*own)))
        if distinct:
            value = lambda c: F.sha2(col(c).cast("string"), 256) if made.column(c).type.upper().startswith(LARGE) else col(c)  # noqa: E731, B023
            each = (df.agg(F.count_distinct(value(c)).alias("count_distinct")).select(F.lit(c).alias("lib_column"), "count_distinct") for c in df.columns)
            rows = rows.join(F.broadcast(reduce(DataFrame.union, each)), "lib_column")  # a row for each column of one table
        parts.append(rows.withColumns({"lib_schema": F.lit(made.name.schema), "lib_table": F.lit(made.name.table), "null_ratio": null_percent(F.col("count_null"), F.col("count_table"))}))
    return reduce(DataFrame.unionByName, parts)


def catalog_of(spark: SparkSession, db, database: str, schema: str | None = None) -> DataFrame:
    """scan_columns() with column_statistics() of every table: the input of catalog.assemble()."""
    columns = scan_columns(spark, db, database, schema)
    names = sorted({(r.lib_schema, r.lib_table) for r in columns.select("lib_schema", "lib_table").distinct().collect()})
    if not names:
        return columns
    stats = column_statistics(spark, db, [f"{db.name(s)}.{db.name(t)}" for s, t in names])
    return columns.join(stats, ["lib_schema", "lib_table", "lib_column"], "left")
