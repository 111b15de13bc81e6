"""Queries that write and read back: tables, files, databases, sync jobs, streams.

Each derives what it writes from the benchmark tables and returns what is read back.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import scalars
from tablewright.operators import profile, quality, schema, statistics
from tablewright.sources import buckets, csvio, databases, documents, jdbc, reconcile, tables
from tablewright.sources.staging import shared_dir, swap_in
from tablewright.streaming import ledger, sync, upsert
from tablewright.suite import query, table


def folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/tablewright/{name}-{uuid.uuid4().hex}"


def database(spark, name: str) -> str:
    """A new catalog database in the warehouse."""
    db = f"tw_{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db}")
    return db


CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType(), False),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    schema.optional("c_note", T.StringType(), "none"),
    schema.optional("c_rank", T.IntegerType(), "123", False),
])


@query("SELECT c_custkey, c_name, c_nationkey, 'none' AS c_note, 123 AS c_rank FROM customer")
def csv_typed_read(spark, sf):
    path = folder(spark, "csv")
    csvio.write_csv(table(spark, sf, "customer").select("c_nationkey", "c_name", "c_custkey"), path, header=True)
    return csvio.read_csv(spark, path, CUSTOMER)


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def csv_raw_read(spark, sf):
    path = folder(spark, "csv")
    csvio.write_csv(table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), path, header=True, delimiter="|")
    return csvio.read_raw(spark, path, delimiter="|")


@query("SELECT c_custkey, ' \"x\", ' || c_name AS quoted, CASE WHEN c_custkey % 2 = 0 THEN '' END AS blank FROM customer")
def csv_round_trip(spark, sf):
    path = folder(spark, "csv")
    odd = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit(' "x", '), "c_name").alias("quoted"), F.when(F.col("c_custkey") % 2 == 0, "").alias("blank"))
    csvio.write_csv(odd, path)
    back = spark.read.options(quote='"', escape='"', emptyValue="<empty>").schema(odd.schema).csv(path)
    return back.replace("<empty>", "", ["blank"])


@query("SELECT c_custkey, c_name FROM customer")
def csv_single_file(spark, sf):
    path = folder(spark, "export") + ".csv"
    csvio.export_one_file(table(spark, sf, "customer").select("c_custkey", "c_name"), path)
    return spark.read.options(header=True).schema("c_custkey long, c_name string").csv(path)


@query("SELECT s_name || '.txt' AS file, 'supplier ' || s_suppkey AS value FROM supplier")
def file_per_row(spark, sf):
    path = folder(spark, "rows")
    csvio.write_each_row(table(spark, sf, "supplier").select("s_name", F.concat(F.lit("supplier "), "s_suppkey").alias("body")), "s_name", "body", path)
    return spark.read.schema("value string, file string").text(path).select("file", "value")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_folder_load(spark, sf):
    path = folder(spark, "csv")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    csvio.write_csv(c, path)
    return csvio.load_csv_folder(spark, path, "part-*.csv", c.schema)


@query("SELECT o_orderkey, o_totalprice FROM orders")
def table_save_and_read(spark, sf):
    db = database(spark, "save")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    tables.save(o.limit(0), tables.qualified(db, "orders"))
    tables.save(o, tables.qualified(db, "orders"), partitions=4)
    return tables.read(spark, db, "orders")


@query("SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders")
def path_save_over_itself(spark, sf):
    path = folder(spark, "swap")
    tables.save(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), f"{path}/orders", "orc")
    again = tables.read(spark, path, "orders", "orc").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    tables.save(again, f"{path}/orders", "orc")
    return tables.read(spark, path, "orders", "orc")


@query("SELECT c_custkey, c_name FROM customer")
def save_and_validate(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return tables.save_and_validate(c, f"{folder(spark, 'valid')}/customer", [quality.Field("c_custkey", required=True, unique=True), quality.Field("c_name", pattern="^Customer")])


@query("SELECT 'customer' AS tab, c_custkey AS k, c_name AS v FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier")
def copy_all_tables(spark, sf):
    a, b = database(spark, "from"), database(spark, "to")
    for name in ("customer", "supplier"):
        tables.save(table(spark, sf, name), tables.qualified(a, name))
    tables.save(table(spark, sf, "supplier"), tables.qualified(a, "tmp_supplier"))
    tables.copy_tables(spark, a, b)
    parts = [tables.read(spark, b, n).select(F.lit(n).alias("tab"), F.col({"c": "c_custkey", "s": "s_suppkey"}[n[0]]).alias("k"), F.col(f"{n[0]}_name").alias("v")) for n in tables.table_names(spark, b)]
    return parts[0].union(parts[1])


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def compaction(spark, sf):
    path = folder(spark, "compact")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").repartition(6).write.partitionBy("o_orderstatus").parquet(f"{path}/orders")
    tables.compact(spark, path, "orders", 1, "o_orderstatus = 'F'")
    return tables.read(spark, path, "orders")


@query("SELECT 3 AS n_files, count(*) AS n_rows FROM orders")
def compaction_whole(spark, sf):
    path = folder(spark, "compact")
    table(spark, sf, "orders").select("o_orderkey").repartition(9).write.parquet(f"{path}/orders")
    tables.compact(spark, path, "orders", 3)
    return tables.read(spark, path, "orders").agg(F.count_distinct("_metadata.file_name").cast("int").alias("n_files"), F.count("*").alias("n_rows"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 100 AND o_orderstatus = 'F' AND o_totalprice > 1000.5")
def parametrised_query(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("tw_orders")
    return tables.execute(spark, "SELECT o_orderkey, o_totalprice FROM tw_orders WHERE o_orderkey > ? AND o_orderstatus = ? AND o_totalprice > ?", [100, "F", 1000.5])


@query("SELECT 'analyzed' AS state, count(*) AS n_rows FROM customer")
def catalog_analyze(spark, sf):
    db = database(spark, "stats")
    tables.save(table(spark, sf, "customer"), tables.qualified(db, "customer"))
    profile.analyze_database(spark, db)
    stats = spark.sql(f"DESCRIBE EXTENDED {db}.customer").where("col_name = 'Statistics'").select("data_type")
    return stats.select(F.lit("analyzed").alias("state"), F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("n_rows"))


# splits
@query("""SELECT ((o_orderkey - lo) * 8 + 7) // (hi - lo + 1) AS part, count(*) AS n FROM orders, (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders) GROUP BY 1""")
def key_range_split(spark, sf):
    o = table(spark, sf, "orders")
    low, high = jdbc.min_max(o, "o_orderkey")
    ranges = jdbc.key_ranges(low, high, 4, 2)
    # every row is in exactly one range
    number = sum((F.when((F.col("o_orderkey") >= a) & (F.col("o_orderkey") <= b), i).otherwise(0) for i, (a, b) in enumerate(ranges)), F.lit(0))
    return o.groupBy(number.cast("long").alias("part")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (c_custkey % 50 = 0) AS n_null, 0 AS n_lost FROM customer")
def text_range_split(spark, sf):
    c = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 50 != 0, F.col("c_name")).alias("k"))
    predicates = jdbc.text_predicates("k", jdbc.text_boundaries(c, "k", 8))
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    return c.select("k", hits.alias("hits")).agg(F.count("*").alias("n_rows"), F.count_if(F.col("k").isNull()).alias("n_null"), F.count_if(F.col("hits") != 1).cast("int").alias("n_lost"))


@query("SELECT min(c_name) AS low, max(c_name) AS high FROM customer")
def text_min_max(spark, sf):
    return spark.createDataFrame([jdbc.min_max(table(spark, sf, "customer"), "c_name")], "low string, high string")


def derby(name: str) -> jdbc.Database:
    return jdbc.Database(f"jdbc:derby:memory:{name}_{uuid.uuid4().hex[:12]};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver", rename="RENAME TABLE {old} TO {new}", rename_index="RENAME INDEX {old} TO {new}")


@query("SELECT o_orderkey, o_custkey FROM orders")
def jdbc_round_trip(spark, sf):
    db = derby("trip")
    jdbc.write_table(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), db, "orders", partitions=2)
    return jdbc.read_query(spark, db, "SELECT * FROM orders", 3, "o_orderkey", 2)


@query("SELECT c_custkey, c_name FROM customer")
def jdbc_text_split(spark, sf):
    db = derby("text")
    jdbc.write_table(table(spark, sf, "customer").select("c_custkey", F.col("c_name").cast("varchar(64)").alias("c_name")), db, "customer", partitions=2)
    return jdbc.read_query(spark, db, 'SELECT "c_custkey", CAST("c_name" AS VARCHAR(64)) AS "c_name" FROM customer', 3, "c_name")


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS v FROM customer")
def jdbc_scd1_load(spark, sf):
    db = derby("scd1")
    c = table(spark, sf, "customer").selectExpr("c_custkey AS k", "c_nationkey AS v")
    jdbc.load_table(c.where("k % 3 <> 0"), db, "t", jdbc.Load("megafull"))
    jdbc.load_table(c.where("k % 3 = 0 OR k % 2 = 0").withColumn("v", F.when(F.col("k") % 2 == 0, F.col("v") + 100).otherwise(F.col("v"))), db, "t", jdbc.Load("scd1", ("k",)))
    return jdbc.read_query(spark, db, "SELECT * FROM t")


# increments
@query("SELECT max(ts) + INTERVAL 1 SECOND AS date_max FROM events")
def watermark(spark, sf):
    return sync.watermark(table(spark, sf, "events"), ["ts"])


@query("SELECT greatest(max(o_orderdate), max(l_shipdate)) + INTERVAL 1 SECOND AS date_max FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def watermark_fields(spark, sf):
    o, line = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return sync.watermark(o.join(line, o.o_orderkey == line.l_orderkey), ["o_orderdate", "l_shipdate"])


@query("SELECT max(o_orderdate) AS newest FROM orders")
def newest_row(spark, sf):
    return sync.newest_row(table(spark, sf, "orders"), "o_orderdate").select(F.col("o_orderdate").alias("newest"))


@query("SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '1998-05-31 22:00:00' OR l_shipdate >= TIMESTAMP '1998-05-31 22:00:00'")
def incremental_filter(spark, sf):
    o, line = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    both = o.join(line, o.o_orderkey == line.l_orderkey)
    return sync.since(both, ["o_orderdate", "l_shipdate"], "1998-06-01 00:00:00", "2 hours").select("o_orderkey", "l_linenumber")


def _split_events(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    return e.where("event_id % 3 <> 0"), e.withColumn("value", F.when(F.col("event_id") % 5 == 0, F.col("value") + 1).otherwise(F.col("value")))


@query("""WITH old AS (SELECT * FROM events WHERE event_id % 3 <> 0 AND ts < TIMESTAMP '2024-01-15'), w AS (SELECT max(ts) + INTERVAL 1 SECOND AS d FROM old),
    new AS (SELECT event_id, ts, CASE WHEN event_id % 5 = 0 THEN value + 1 ELSE value END AS value FROM events, w WHERE ts >= d)
    SELECT coalesce(n.event_id, o.event_id) AS event_id, coalesce(n.value, o.value) AS value FROM old o FULL JOIN new n ON n.event_id = o.event_id""")
def sync_scd1(spark, sf):
    path = folder(spark, "sync")
    old, new = _split_events(spark, sf)
    swap_in(old.where("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'"), f"{path}/out/events")
    swap_in(new, f"{path}/in/events")
    sync.sync(spark, f"""
source: {{format: parquet, path: "{path}/in"}}
target: {{format: parquet, path: "{path}/out", load: scd1, buckets: 16}}
tables:
  - {{source_table: events, target_table: events, keys: [event_id], date_fields: [ts], hash: false}}
  - {{source_table: absent, target_table: absent, active: false}}
""")
    return tables.read(spark, f"{path}/out", "events").select("event_id", "value")


@query("SELECT o_orderkey, o_totalprice, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def sync_enriched(spark, sf):
    path = folder(spark, "sync")
    swap_in(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), f"{path}/in/orders", "orc")
    swap_in(table(spark, sf, "customer").select("c_custkey", "c_name"), f"{path}/in/customer", "orc")
    sync.sync(spark, f"""
source: {{format: orc, path: "{path}/in"}}
target: {{format: parquet, path: "{path}/out", load: full}}
tables:
  - {{source_table: orders, target_table: orders, enrichment: {{table: customer, source_key: o_custkey, key: c_custkey}}}}
""")
    return tables.read(spark, f"{path}/out", "orders").select("o_orderkey", "o_totalprice", "c_name")


@query("SELECT doc_id, lang, source, text FROM documents")
def json_documents(spark, sf):
    path = folder(spark, "json")
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    swap_in(d, f"{path}/docs", "json")
    return csvio.read_documents(spark, f"{path}/docs", d.schema)


@query("SELECT user_id, value FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id, value) AS n FROM events) WHERE n = 1")
def latest_per_key(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return upsert.latest_per_key(e, ["user_id"], "ts").select("user_id", "value")


@query("SELECT user_id, value FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id, value) AS n FROM events) WHERE n = 1")
def streaming_upsert(spark, sf):
    path = folder(spark, "stream")
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    swap_in(e, f"{path}/in")
    stream = spark.readStream.schema(e.schema).parquet(f"{path}/in")
    upsert.upsert_stream(stream, path, "latest", ["user_id"], "ts", f"{path}/checkpoint").awaitTermination()
    return tables.read(spark, path, "latest").select("user_id", "value")


@query("SELECT c_custkey AS k, c_nationkey AS v, NULL::TIMESTAMP AS e FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 2 = 1 UNION ALL SELECT c_custkey, c_nationkey, TIMESTAMP '2020-01-01' FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 2 = 0 UNION ALL SELECT c_custkey, c_nationkey + 100, NULL FROM customer WHERE c_custkey % 2 = 0")
def jdbc_scd2_load(spark, sf):
    db = derby("scd2")
    c = table(spark, sf, "customer").selectExpr("2 * c_custkey AS id", "c_custkey AS k", "c_nationkey AS v")
    load = jdbc.Load("scd2", ("k",), "id", "e")
    jdbc.load_table(c.where("k % 3 <> 0"), db, "t", load)
    jdbc.load_table(c.where("k % 2 = 0").selectExpr("id + 1 AS id", "k", "v + 100 AS v"), db, "t", load, F.lit("2020-01-01").cast("timestamp"))
    return jdbc.read_query(spark, db, "SELECT * FROM t").select("k", "v", F.col("e").cast("timestamp_ntz").alias("e"))


@query("SELECT c_custkey, c_nationkey FROM customer")
def sync_database_to_files(spark, sf):
    path, db = folder(spark, "sync"), derby("sync")
    jdbc.write_table(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), db, "customer", partitions=2)
    source = sync.Place("jdbc", database={"url": db.url, "driver": db.driver, "rename": db.rename, "rename_index": db.rename_index}, partitions=3)
    job = sync.Job(source, sync.Place("parquet", f"{path}/out", "scd1"), (sync.TableJob("customer", "customer", ("c_custkey",), hash=False),))
    sync.sync(spark, job)
    return tables.read(spark, f"{path}/out", "customer")


@query("SELECT c_custkey, c_nationkey FROM customer")
def sync_files_to_database(spark, sf):
    path, db = folder(spark, "sync"), derby("sync")
    swap_in(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), f"{path}/in/customer")
    target = sync.Place("jdbc", load="full", database={"url": db.url, "driver": db.driver, "rename": db.rename, "rename_index": db.rename_index})
    sync.sync(spark, sync.Job(sync.Place("parquet", f"{path}/in"), target, (sync.TableJob("customer", "customer", hash=False),)))
    return jdbc.read_query(spark, db, "SELECT * FROM customer")


@query("SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders")
def jdbc_swap_load(spark, sf):
    db = derby("swap")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    for rows in (o, o.withColumn("o_totalprice", F.col("o_totalprice") + 1)):
        jdbc.swap_table(rows, db, "orders")
    return jdbc.read_query(spark, db, "SELECT * FROM orders", 3, "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey > 100 AND o_orderstatus = 'F' THEN 'done' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def jdbc_statements(spark, sf):
    db = derby("run")
    jdbc.write_table(table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").cast("varchar(8)").alias("o_orderstatus")), db, "orders", partitions=2)
    jdbc.execute(spark, db, [('UPDATE orders SET "o_orderstatus" = ? WHERE "o_orderkey" > ? AND CAST("o_orderstatus" AS VARCHAR(8)) = ?', ["done", 100, "F"])])
    return jdbc.read_query(spark, db, "SELECT * FROM orders", 3, "o_orderkey")


@query("""WITH old AS (SELECT * FROM events WHERE event_id % 3 <> 0 AND ts < TIMESTAMP '2024-01-15'), w AS (SELECT max(ts) + INTERVAL 1 SECOND AS d FROM old),
    new AS (SELECT event_id, ts, CASE WHEN event_id % 5 = 0 THEN value + 1 ELSE value END AS value FROM events, w WHERE ts >= d)
    SELECT coalesce(n.event_id, o.event_id) AS event_id, coalesce(n.value, o.value) AS value FROM old o FULL JOIN new n ON n.event_id = o.event_id""")
def sync_database_increment(spark, sf):
    path, db = folder(spark, "sync"), derby("increment")
    old, new = _split_events(spark, sf)
    jdbc.write_table(new, db, "events", partitions=2)
    jdbc.load_table(old.where("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'"), db, "done", jdbc.Load("megafull"))
    place = sync.Place("jdbc", load="scd1", database={"url": db.url, "driver": db.driver, "rename": db.rename, "rename_index": db.rename_index}, partitions=3)
    sync.sync(spark, sync.Job(place, place, (sync.TableJob("events", "done", ("event_id",), date_fields=("ts",), hash=False),)))
    return jdbc.read_query(spark, db, "SELECT * FROM done", 3, "event_id").select("event_id", "value")


@query("SELECT c_custkey, c_name FROM customer")
def sync_to_documents(spark, sf):
    path = folder(spark, "sync")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    swap_in(c, f"{path}/in/customer")
    job = sync.Job(sync.Place("parquet", f"{path}/in"), sync.Place("json", f"{path}/out", "scd1"), (sync.TableJob("customer", "customer", ("c_custkey",), hash=False),))
    for _ in range(2):  # by document id: the second run changes nothing
        sync.sync(spark, job)
    return csvio.read_documents(spark, f"{path}/out/customer", c.schema)


@query("SELECT c_name AS lib_table, c_custkey % 3 <> 0 AS is_active FROM customer")
def sync_catalog_levels(spark, sf):
    path = folder(spark, "catalog")
    c = table(spark, sf, "customer")
    columns = c.select(F.lit("db").alias("lib_database"), F.lit("omop").alias("lib_schema"), F.col("c_name").alias("lib_table"), F.concat(F.lower("c_name"), F.lit("_id")).alias("lib_column"), F.lit(1).alias("order_column"), "c_custkey")
    for found in (columns, columns.where("c_custkey % 3 <> 0")):
        sync.sync_catalog(spark, [{"name": "customers", "strategy": "omop", "schemas": "omop"}], path, lambda conf, found=found: found.drop("c_custkey"))
    return tables.read(spark, path, "meta_table").select("lib_table", "is_active")


@query("SELECT column_name, column_type FROM (VALUES ('c_custkey', 'bigint'), ('c_acctbal', 'double')) v(column_name, column_type)")
def jdbc_schema_probe(spark, sf):
    db = derby("probe")
    jdbc.write_table(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), db, "customer", partitions=1)
    probed = jdbc.query_schema(spark, db, "SELECT * FROM customer")
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in probed], "column_name string, column_type string")


# databases as catalogs
@query("""SELECT tab AS lib_table, c AS lib_column, n AS count_table, n - v AS count_null, 100.0 * (n - v) / n AS null_ratio, d AS count_distinct, k AS primarykey FROM (
    SELECT 'customer' AS tab, 'c_custkey' AS c, count(*) AS n, count(c_custkey) AS v, count(DISTINCT c_custkey) AS d, true AS k FROM customer
    UNION ALL SELECT 'customer', 'c_name', count(*), count(x), count(DISTINCT x), false FROM (SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS x FROM customer)
    UNION ALL SELECT 'customer', 'c_acctbal', count(*), count(c_acctbal), count(DISTINCT c_acctbal), false FROM customer
    UNION ALL SELECT 'orders', 'o_orderkey', count(*), count(o_orderkey), count(DISTINCT o_orderkey), true FROM orders
    UNION ALL SELECT 'orders', 'o_custkey', count(*), count(o_custkey), count(DISTINCT o_custkey), false FROM orders
    UNION ALL SELECT 'orders', 'o_orderstatus', count(*), count(o_orderstatus), count(DISTINCT o_orderstatus), false FROM orders)""")
def database_catalog(spark, sf):
    """Tables made through the catalog; their columns with rows, nulls and distinct values, counted there."""
    db = derby("catalog")
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("c_name"), "c_acctbal")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for name, df in (("customer", c), ("orders", o)):
        fields = [T.StructField(f.name, T.VarcharType(40) if f.dataType == T.StringType() else f.dataType) for f in df.schema]
        databases.create_table(spark, db, f'"{name}"', T.StructType(fields), [df.columns[0]])
        jdbc.append_once(df, db, f'"{name}"', partitions=2)
    found = databases.catalog_of(spark, db, "shop")
    return found.select("lib_table", "lib_column", "count_table", "count_null", "null_ratio", "count_distinct", "primarykey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 1000 < 10 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey FROM orders")
def jdbc_digest_load(spark, sf):
    """Type 1 by digests of key ranges: only ranges that differ are fetched."""
    db, load = derby("digest"), jdbc.Load("scd1", ("o_orderkey",), digest="digest")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    reconcile.load(o, db, "orders", load)
    reconcile.load(o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 1000 < 10, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))), db, "orders", load)
    return jdbc.read_query(spark, db, "SELECT * FROM orders", 3, "o_orderkey").select("o_orderkey", "o_custkey")


@query("SELECT c_custkey AS k, c_nationkey AS v, CASE WHEN c_custkey % 50 = 0 THEN TIMESTAMP '2020-01-01' END AS e FROM customer UNION ALL SELECT c_custkey, c_nationkey + 100, NULL FROM customer WHERE c_custkey % 50 = 0")
def jdbc_digest_history(spark, sf):
    """Type 2 by digests: open rows that differ are closed and followed by new ones."""
    db, load = derby("history"), jdbc.Load("scd2", ("k",), "id", "e", digest="digest")
    c = table(spark, sf, "customer").selectExpr("2 * c_custkey AS id", "c_custkey AS k", "c_nationkey AS v")
    at = F.lit("2020-01-01").cast("timestamp")
    reconcile.load(c, db, "customer", load, at)
    reconcile.load(c.selectExpr("id + 1 AS id", "k", "CASE WHEN k % 50 = 0 THEN v + 100 ELSE v END AS v"), db, "customer", load, at)
    return jdbc.read_query(spark, db, "SELECT * FROM customer").select("k", "v", F.col("e").cast("timestamp_ntz").alias("e"))


@query("SELECT o_orderkey, o_custkey + 1 AS o_custkey, true AS has_key, 1 AS n_indexes FROM orders")
def jdbc_swap_with_structure(spark, sf):
    """A swapped table keeps its primary key and index."""
    db = derby("structure")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    databases.create_table(spark, db, "orders", T.StructType([T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_custkey", T.LongType())]), ["o_orderkey"])
    jdbc.execute(spark, db, ['CREATE INDEX by_customer ON orders ("o_custkey")'])
    jdbc.append_once(o, db, "orders", partitions=2)
    jdbc.swap_table(o.withColumn("o_custkey", F.col("o_custkey") + 1), db, "orders", partitions=2)
    kept = databases.structure(spark, db, "orders")
    return jdbc.read_query(spark, db, "SELECT * FROM orders", 3, "o_orderkey").withColumns({"has_key": F.lit(kept.primary_key == ("o_orderkey",)), "n_indexes": F.lit(len(kept.indexes))})


@query("""SELECT o_orderkey, 'it''s "odd" ?; -- x' AS note, CAST(NULL AS INTEGER) AS nothing FROM orders
    WHERE o_orderdate >= TIMESTAMP '1994-03-01 00:00:00' AND CAST(o_orderdate AS DATE) < DATE '1997-05-06' AND o_totalprice > 1000.25 AND o_orderstatus <> 'it''s'""")
def database_parametrised_query(spark, sf):
    """Typed parameters in a split read of a database."""
    db = derby("bound")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"), "o_orderstatus")
    fields = [T.StructField(f.name, T.VarcharType(8) if f.name == "o_orderstatus" else f.dataType) for f in o.schema]
    databases.create_table(spark, db, "orders", T.StructType(fields))
    jdbc.append_once(o, db, "orders", partitions=2)
    text = """SELECT "o_orderkey", ? AS "note", ? AS "nothing" FROM orders -- a question?
        WHERE "o_orderdate" >= ? AND DATE("o_orderdate") < ? AND "o_totalprice" > ? AND "o_orderstatus" <> ?"""
    params = ["it's \"odd\" ?; -- x", jdbc.Null("INTEGER"), datetime(1994, 3, 1), date(1997, 5, 6), Decimal("1000.25"), "it's"]
    return jdbc.read_bound(spark, db, text, params, 3, "o_orderkey")


@query("""SELECT doc_id, len(w) AS n_words, md5(coalesce(array_to_string(list_transform(w, lambda x: coalesce(x, '<null>')), '|'), '')) AS digest, doc_id AS a, lang AS b
    FROM (SELECT doc_id, lang, list_concat(list_transform(string_split(coalesce(text, ''), ' '), lambda x: CASE WHEN x <> 'null' THEN x END), ['a,b', 'c"d', '', 'null', '{e}', 'f\\g', NULL, ' h ']) AS w FROM documents)""")
def array_text_quoted(spark, sf):
    """Words with commas, quotes, braces, blanks and nulls, and structs, through a database and back."""
    db = derby("nested")
    odd = F.array(*map(F.lit, ["a,b", 'c"d', "", "null", "{e}", "f\\g", None, " h "]))
    words = F.transform(F.split(F.coalesce("text", F.lit("")), " "), lambda x: F.when(x != "null", x))
    d = table(spark, sf, "documents").select("doc_id", F.concat(words, odd).alias("w"), F.struct(F.col("doc_id").alias("a"), F.col("lang").alias("b")).alias("s"))
    flat = scalars.to_flat_text(d)
    jdbc.append_once(flat, db, "documents", partitions=4)
    back = scalars.from_flat_text(jdbc.read_query(spark, db, "SELECT * FROM documents", 4, "doc_id"), d.schema)
    joined = F.array_join(F.transform("w", lambda x: F.coalesce(x, F.lit("<null>"))), "|")
    return back.select("doc_id", F.size("w").cast("long").alias("n_words"), F.md5(joined).alias("digest"), "s.a", "s.b")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 100 < 2 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders UNION ALL SELECT -o_orderkey, 'added' FROM orders WHERE o_orderkey % 100 = 1")
def scd1_merge_bucketed(spark, sf):
    """A type 1 merge that writes the touched buckets of the target only."""
    path = f"{folder(spark, 'bucketed')}/orders"
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    buckets.lay_out(o, path, ["o_orderkey"], 32)
    changed = o.where("o_orderkey % 100 < 2").withColumn("o_orderstatus", F.lit("new"))
    added = o.where("o_orderkey % 100 = 1").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("added").alias("o_orderstatus"))
    buckets.merge_by_bucket(changed.union(added), path, ["o_orderkey"])
    return buckets.read(spark, path)


@query("SELECT o_orderstatus, count(*) AS n_rows, 1 AS n_small FROM orders GROUP BY o_orderstatus")
def compaction_by_size(spark, sf):
    """Small files of each partition become one; see the test for large ones, which stay."""
    path = folder(spark, "compact")
    table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").repartition(6).write.partitionBy("o_orderstatus").parquet(f"{path}/orders")
    tables.compact_by_size(spark, path, "orders")
    o = tables.read(spark, path, "orders")
    return o.groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"), F.count_distinct("_metadata.file_name").cast("int").alias("n_small"))


@query("SELECT 'customer' AS table_name, 'loaded' AS state, count(*) AS n_rows FROM customer UNION ALL SELECT 'orders', 'loaded', count(*) FROM orders")
def sync_run_ledger(spark, sf):
    """A run that is started again under its name loads what is left and nothing twice."""
    path = folder(spark, "runs")
    c, o = table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").select("o_orderkey")
    swap_in(c, f"{path}/in/customer")
    places = sync.Place("parquet", f"{path}/in"), sync.Place("parquet", f"{path}/out", "full")
    jobs = tuple(sync.TableJob(t, t, hash=False) for t in ("customer", "orders"))
    sync.sync(spark, sync.Job(*places, jobs[:1]), "monday")  # and here it died
    swap_in(c.limit(0), f"{path}/in/customer")
    swap_in(o, f"{path}/in/orders")
    sync.sync(spark, sync.Job(*places, jobs), "monday")
    found = ledger.entries(sync.ledger_of(spark, sync.Job(*places, jobs), "monday"), ["customer", "orders"])
    sizes = [tables.read(spark, f"{path}/out", t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in ("customer", "orders")]
    return found.join(sizes[0].union(sizes[1]), "table_name").select("table_name", "state", "n_rows")


@query("SELECT doc_id, lang, source, text, n_chars FROM documents")
def document_store(spark, sf):
    """Documents through the registered source and sink, read in ranges of ids."""
    path, fmt = folder(spark, "documents"), documents.register(spark)
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "text", "n_chars")
    d.where("doc_id % 2 = 0").write.format(fmt).option("id", "doc_id").mode("overwrite").save(path)
    d.where("doc_id % 2 = 1").write.format(fmt).option("id", "doc_id").mode("append").save(path)
    return spark.read.format(fmt).option("partitions", 4).load(path)


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer")
def sync_document_store(spark, sf):
    """A sync job that merges into the document store by id."""
    path = folder(spark, "sync")
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    job = sync.Job(sync.Place("parquet", f"{path}/in"), sync.Place("documents", f"{path}/out", "scd1"), (sync.TableJob("customer", "customer", ("c_custkey",), hash=False),))
    for rows in (c, c.where("c_custkey % 10 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)):
        swap_in(rows, f"{path}/in/customer")
        sync.sync(spark, job)
    return sync.Place("documents", f"{path}/out").read(spark, "customer")


@query("SELECT 'l_orderkey' AS column_name, count(*) AS n_rows, count(*) - count(l_orderkey) AS n_null, true AS within_error FROM lineitem UNION ALL SELECT 'l_partkey' AS column_name, count(*) AS n_rows, count(*) - count(l_partkey) AS n_null, true AS within_error FROM lineitem UNION ALL SELECT 'l_suppkey' AS column_name, count(*) AS n_rows, count(*) - count(l_suppkey) AS n_null, true AS within_error FROM lineitem UNION ALL SELECT 'l_linenumber' AS column_name, count(*) AS n_rows, count(*) - count(l_linenumber) AS n_null, true AS within_error FROM lineitem UNION ALL SELECT 'l_quantity' AS column_name, count(*) AS n_rows, count(*) - count(l_quantity) AS n_null, true AS within_error FROM lineitem UNION ALL SELECT 'l_extendedprice' AS column_name, count(*) AS n_rows, count(*) - count(l_extendedprice) AS n_null, true AS within_error FROM lineitem UNION ALL SELECT 'l_discount' AS column_name, count(*) AS n_rows, count(*) - count(l_discount) AS n_null, true AS within_error FROM lineitem UNION ALL SELECT 'l_tax' AS column_name, count(*) AS n_rows, count(*) - count(l_tax) AS n_null, true AS within_error FROM lineitem UNION ALL SELECT 'l_returnflag' AS column_name, count(*) AS n_rows, count(*) - count(l_returnflag) AS n_null, true AS within_error FROM lineitem UNION ALL SELECT 'l_linestatus' AS column_name, count(*) AS n_rows, count(*) - count(l_linestatus) AS n_null, true AS within_error FROM lineitem")
def sketch_statistics(spark, sf):
    """Statistics by partition, brought up to date after one partition has grown; distinct counts within
    three standard errors of the exact ones."""
    path = f"{folder(spark, 'statistics')}/lineitem"
    line = table(spark, sf, "lineitem").drop("l_shipdate")
    late = "l_returnflag = 'R' AND l_orderkey % 2 = 0"
    line.where(f"NOT ({late})").write.partitionBy("l_returnflag").parquet(path)
    statistics.update(spark, path)
    line.where(late).write.mode("append").partitionBy("l_returnflag").parquet(path)
    statistics.update(spark, path)
    exact = profile.profile(line).select("column_name", F.col("n_distinct").alias("exact"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 3 * statistics.ERROR * F.col("exact")
    return statistics.merged(spark, path).join(exact, "column_name").select("column_name", "n_rows", "n_null", near.alias("within_error"))
