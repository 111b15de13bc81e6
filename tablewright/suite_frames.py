"""Queries of the frame operators: schemas, cleaning, merges, constraints, profiles, catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import scalars
from tablewright.operators import catalog, profile, quality, schema, versioning
from tablewright.suite import query, table

ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False),
    T.StructField("o_custkey", T.IntegerType()),
    schema.optional("o_channel", T.StringType(), "web"),
    schema.optional("o_score", T.IntegerType(), "7", False),
    schema.optional("o_note", T.StringType(), None),
])


def text_orders(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"), "o_orderstatus")


@query("SELECT o_custkey, o_orderkey FROM orders")
def reorder_columns(spark, sf):
    return schema.reorder(table(spark, sf, "orders"), schema.string_schema(["o_custkey", "o_orderkey"]))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def drop_unknown_columns(spark, sf):
    return schema.drop_unknown(table(spark, sf, "orders"), schema.string_schema(["o_orderstatus", "o_orderkey", "absent"]))


@query("SELECT o_orderkey, o_custkey, 'web' AS o_channel, 7 AS o_score, CAST(NULL AS VARCHAR) AS o_note FROM orders")
def add_missing_columns(spark, sf):
    return schema.add_missing(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ORDER_SCHEMA)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS INTEGER) END AS o_custkey FROM orders")
def cast_columns(spark, sf):
    return schema.cast_columns(text_orders(spark, sf).select("o_orderkey", "o_custkey"), T.StructType(ORDER_SCHEMA.fields[:2]))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS INTEGER) END AS o_custkey, 'web' AS o_channel, 7 AS o_score, CAST(NULL AS VARCHAR) AS o_note FROM orders")
def apply_schema(spark, sf):
    return schema.apply_schema(text_orders(spark, sf), ORDER_SCHEMA)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey, 'web' AS o_channel, 7 AS o_score, CAST(NULL AS VARCHAR) AS o_note FROM orders")
def apply_schema_soft(spark, sf):
    return schema.apply_schema_soft(text_orders(spark, sf), ORDER_SCHEMA)


@query("SELECT count(*) FILTER (o_orderkey % 7 = 0) AS o_custkey FROM orders")
def null_violations(spark, sf):
    cast = text_orders(spark, sf).select(F.col("o_custkey").try_cast("int").alias("o_custkey"))
    return schema.null_violations(cast, T.StructType([T.StructField("o_custkey", T.IntegerType(), False)]))


@query("SELECT n_nationkey AS id, n_name AS name FROM nation")
def rename_columns(spark, sf):
    return schema.rename(table(spark, sf, "nation").select("n_nationkey", "n_name"), {"n_nationkey": "id", "n_name": "name"})


@query("SELECT n_nationkey AS nation_key, n_name AS _name_, n_regionkey AS region_e FROM nation")
def normalize_names(spark, sf):
    return schema.normalize_names(table(spark, sf, "nation").toDF("Nation Key", "(Name)", "Région É"))


@query("SELECT c_custkey, nullif(regexp_replace(CASE WHEN c_custkey % 5 = 0 THEN '  ' ELSE '  ' || c_name || chr(10) END, '^\\s+|\\s+$', '', 'g'), '') AS c_name FROM customer")
def trim_all(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit("\n"))).alias("c_name"))
    return schema.trim_all(c)


@query("SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 3 <> 0")
def remove_blank_rows(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, F.lit("  ")).when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("c_name"))
    return schema.remove_blank(c, "c_name").select("c_custkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN date_trunc('day', o_orderdate) END AS at FROM orders")
def parse_dates(spark, sf):
    text = F.when(F.col("o_orderkey") % 4 == 0, F.lit("unknown")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select("o_orderkey", scalars.to_second(text, "yyyy-MM-dd").cast("timestamp_ntz").alias("at"))


@query("SELECT o_orderkey, '{' || o_orderkey || ',' || coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END, 'null') || '}' AS keys FROM orders")
def array_as_text(spark, sf):
    o = table(spark, sf, "orders")
    return scalars.to_flat_text(o.select("o_orderkey", F.array("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey"))).alias("keys")))


@query("SELECT o_orderkey, o_orderkey AS first, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS second, o_orderkey % 2 = 0 AS even FROM orders")
def array_from_text(spark, sf):
    o = table(spark, sf, "orders")
    text = scalars.to_flat_text(o.select("o_orderkey", F.array("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey"))).alias("keys"), F.when(F.col("o_orderkey") % 2 == 0, F.lit("t")).otherwise(F.lit("f")).alias("even")))
    kinds = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("even", T.BooleanType())])
    return scalars.from_flat_text(text, kinds).select("o_orderkey", F.col("keys")[0].alias("first"), F.col("keys")[1].alias("second"), "even")


@query("""SELECT n_nationkey, '{"key":' || n_nationkey || ',"name":"' || n_name || '"}' AS nested FROM nation""")
def nested_as_json(spark, sf):
    n = table(spark, sf, "nation")
    return scalars.nested_to_json(n.select("n_nationkey", F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")).alias("nested")))


@query("""SELECT c_custkey, sha256('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}') AS digest, 0 AS n_other_hashes FROM customer""")
def row_hashes(spark, sf):
    c = table(spark, sf, "customer")
    own = c.select("c_custkey", scalars.row_digest(F.col("c_custkey"), F.col("c_name")).alias("digest"), scalars.row_hash(F.col("c_custkey"), F.col("c_name")).alias("h"))
    # a row's hash does not depend on its partition or on columns without a value
    again = c.repartition(5).select("c_custkey", scalars.row_hash(F.col("c_custkey"), F.lit(None), F.col("c_name")).alias("again"))
    return own.join(again, "c_custkey").select("c_custkey", "digest", (F.col("h") != F.col("again")).cast("int").alias("n_other_hashes"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS \"{t}\"" for t in EVENT_TYPES) + " FROM events GROUP BY user_id")
def pivot_levels(spark, sf):
    return schema.pivot(table(spark, sf, "events"), ["user_id"], "event_type", F.count(F.lit(1)), EVENT_TYPES).na.fill(0, EVENT_TYPES)


@query("SELECT o_orderpriority, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS \"F\", max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS \"O\", max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS \"P\" FROM orders GROUP BY o_orderpriority")
def pivot_discovered(spark, sf):
    return schema.pivot(table(spark, sf, "orders"), ["o_orderpriority"], "o_orderstatus", F.max("o_totalprice"))


@query("SELECT o_orderkey, 100 + row_number() OVER (ORDER BY o_orderkey) AS nr FROM orders")
def sequence_numbers(spark, sf):
    return schema.with_sequence(table(spark, sf, "orders").select("o_orderkey"), "nr", 100)


@query("SELECT min(o_orderkey) AS o_orderkey, o_custkey FROM orders GROUP BY o_custkey")
def deduplicate(spark, sf):
    return schema.remove_duplicates(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey")[0]


@query("SELECT o_orderkey, o_custkey FROM orders EXCEPT ALL SELECT min(o_orderkey), o_custkey FROM orders GROUP BY o_custkey")
def deduplicate_report(spark, sf):
    return schema.remove_duplicates(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey")[1]


@query("SELECT o_orderkey, o_custkey, NULL AS o_orderstatus, 'web' AS o_channel FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, NULL, o_orderstatus, 'shop' FROM orders WHERE o_orderkey % 2 = 1")
def union_with_defaults(spark, sf):
    o = table(spark, sf, "orders")
    a = o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey")
    b = o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus", F.lit("shop").alias("o_channel", metadata={"default": "web"}))
    return schema.union_missing(a, b)


@query("SELECT o_orderkey AS id, o_custkey AS cust, NULL AS price FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderkey % 3 = 1 UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 2")
def union_many(spark, sf):
    o = table(spark, sf, "orders")
    return schema.union_all([o.where("o_orderkey % 3 = 0").selectExpr("o_orderkey AS id", "o_custkey AS cust"), o.where("o_orderkey % 3 = 1").selectExpr("o_orderkey AS ID", "o_totalprice AS price"), o.where("o_orderkey % 3 = 2").selectExpr("o_totalprice AS Price", "o_custkey AS CUST", "o_orderkey AS id")])


# merges: a target without every third order, candidates of every second with some prices changed
TARGET_SQL = "t AS (SELECT o_orderkey AS k, o_totalprice AS v, o_orderkey % 4 < 3 AS active FROM orders WHERE o_orderkey % 3 <> 0)"
SOURCE_SQL = "s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 2 = 0)"


def merge_sides(spark, sf):
    o = table(spark, sf, "orders")
    target = o.where("o_orderkey % 3 <> 0").selectExpr("o_orderkey AS k", "o_totalprice AS v", "o_orderkey % 4 < 3 AS active")
    source = o.where("o_orderkey % 2 = 0").selectExpr("o_orderkey AS k", "CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v")
    return target, source


@query(f"WITH {TARGET_SQL}, {SOURCE_SQL} SELECT coalesce(t.k, s.k) AS k, coalesce(s.v, t.v) AS v FROM t FULL JOIN s ON t.k = s.k")
def scd1_merge(spark, sf):
    target, source = merge_sides(spark, sf)
    return versioning.scd1(target.drop("active"), source, ["k"])


@query(f"WITH {TARGET_SQL}, {SOURCE_SQL} SELECT coalesce(t.k, s.k) AS k, coalesce(s.v, t.v) AS v, CASE WHEN t.k IS NOT NULL AND s.k IS NULL THEN false WHEN t.k IS NULL THEN NULL ELSE active END AS active FROM t FULL JOIN s ON t.k = s.k")
def scd1_soft_delete(spark, sf):
    target, source = merge_sides(spark, sf)
    return versioning.scd1(target, source, ["k"], set_unmatched={"active": F.lit(False)})


@query(f"WITH {TARGET_SQL}, {SOURCE_SQL} SELECT coalesce(t.k, s.k) AS k, coalesce(s.v, t.v) AS v, active FROM t FULL JOIN s ON t.k = s.k AND t.active")
def scd1_filtered(spark, sf):
    target, source = merge_sides(spark, sf)
    return versioning.scd1(target, source, ["k"], in_scope=F.col("active"))


@query("""WITH t AS (SELECT o_orderkey AS id, o_custkey AS k, o_orderstatus AS v, CASE WHEN o_orderkey % 10 = 0 THEN TIMESTAMP '1999-01-01' END AS e FROM orders WHERE o_orderkey % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderkey % 10 = 0 ORDER BY o_orderkey) = 1),
    s AS (SELECT min(o_orderkey) + 10000000 AS id, o_custkey AS k, min(o_orderpriority) AS p, min(o_orderstatus) AS v FROM orders WHERE o_custkey % 2 = 0 GROUP BY o_custkey)
    SELECT t.id, t.k, t.v, CASE WHEN t.e IS NULL AND s.v IS DISTINCT FROM t.v AND s.k IS NOT NULL THEN TIMESTAMP '2020-01-01' ELSE t.e END AS e FROM t LEFT JOIN s ON s.k = t.k
    UNION ALL SELECT s.id, s.k, s.v, NULL FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = s.k AND t.e IS NULL AND t.v IS NOT DISTINCT FROM s.v)""")
def scd2_merge(spark, sf):
    o = table(spark, sf, "orders")
    from pyspark.sql import Window

    by = Window.partitionBy("k", F.col("id") % 10 == 0).orderBy("id")
    target = o.where("o_orderkey % 3 <> 0").selectExpr("o_orderkey AS id", "o_custkey AS k", "o_orderstatus AS v", "CASE WHEN o_orderkey % 10 = 0 THEN TIMESTAMP_NTZ '1999-01-01 00:00:00' END AS e").withColumn("n", F.row_number().over(by)).where("n = 1").drop("n")
    source = o.where("o_custkey % 2 = 0").groupBy(F.col("o_custkey").alias("k")).agg((F.min("o_orderkey") + 10000000).alias("id"), F.min("o_orderstatus").alias("v"))
    return versioning.scd2(target, source, ["k"], "id", "e", F.lit("2020-01-01").cast("timestamp_ntz"))


@query("""SELECT o_custkey AS k, max(o_orderkey) AS v FROM orders o
    WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders n WHERE n.o_custkey = o.o_custkey) GROUP BY o_custkey""")
def archive(spark, sf):
    o = table(spark, sf, "orders")
    year = lambda y: o.where(F.year("o_orderdate") == y).groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderkey").alias("v"))
    first, last = o.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return versioning.archived(["k"], *(year(y) for y in range(last, first - 1, -1)))


@query(f"WITH {TARGET_SQL}, {SOURCE_SQL} SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NOT NULL AND (t.k IS NULL OR s.v > 100000) THEN s.v ELSE t.v END AS v, active FROM t FULL JOIN s ON t.k = s.k WHERE NOT (t.k IS NOT NULL AND s.k IS NOT NULL AND s.v < 20000)")
def merge_conditions(spark, sf):
    target, source = merge_sides(spark, sf)
    return versioning.merge(target, source, ["k"], mode="iud", update_when=F.col("s.v") > 100000, delete_when=F.col("s.v") < 20000)


@query(f"WITH {TARGET_SQL}, {SOURCE_SQL} SELECT 'insert' AS change, s.k FROM s ANTI JOIN t ON t.k = s.k UNION ALL SELECT 'update', s.k FROM s JOIN t ON t.k = s.k WHERE t.v <> s.v UNION ALL SELECT 'delete', t.k FROM t ANTI JOIN s ON t.k = s.k")
def change_sets(spark, sf):
    target, source = merge_sides(spark, sf)
    found = versioning.change_sets(target, source, ["k"], ["v"])
    parts = [df.select(F.lit(kind).alias("change"), "k") for kind, df in found.items()]
    return parts[0].union(parts[1]).union(parts[2])


# constraints
CHECKS = [
    quality.Field("c_name", required=True, unique=True, pattern="^Customer#0+[1-5]"),
    quality.Field("c_acctbal", ratio=0.9, minimum=-500, maximum=9000, noNan=True, fatal=False),
    quality.Field("c_mktsegment", allowed=("BUILDING", "MACHINERY")),
]


@query("""SELECT 'c_name' AS field, 'required' AS "constraint", count(c_name) / count(*) AS value FROM customer
    UNION ALL SELECT 'c_name', 'pattern', count(*) FILTER (regexp_matches(c_name, '^Customer#0+[1-5]')) / count(*) FROM customer
    UNION ALL SELECT 'c_name', 'unique', count(*) FILTER (n = 1) / sum(n) FROM (SELECT count(*) AS n FROM customer GROUP BY c_name)
    UNION ALL SELECT 'c_acctbal', 'minimum', count(*) FILTER (c_acctbal >= -500) / count(*) FROM customer
    UNION ALL SELECT 'c_acctbal', 'maximum', count(*) FILTER (c_acctbal <= 9000) / count(*) FROM customer
    UNION ALL SELECT 'c_acctbal', 'noNan', count(*) FILTER (NOT isnan(c_acctbal)) / count(*) FROM customer
    UNION ALL SELECT 'c_mktsegment', 'allowed', count(*) FILTER (c_mktsegment IS NULL OR c_mktsegment IN ('BUILDING', 'MACHINERY')) / count(*) FROM customer""")
def quality_metrics(spark, sf):
    return quality.metrics(table(spark, sf, "customer"), CHECKS)


@query("""SELECT 'l_orderkey' AS field, 'unique' AS "constraint", count(*) FILTER (n = 1) / sum(n) AS value FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""")
def quality_unique(spark, sf):
    return quality.metrics(table(spark, sf, "lineitem"), quality.from_yaml("fields: [{name: l_orderkey, unique: true}]"))


# profiles
@query("""SELECT 'l_returnflag' AS column_name, count(*) AS n_rows, count(*) - count(l_returnflag) AS n_null, 100.0 * (count(*) - count(l_returnflag)) / count(*) AS null_percent, count(DISTINCT l_returnflag) AS n_distinct, min(l_returnflag) AS min_value, max(l_returnflag) AS max_value FROM lineitem
    UNION ALL SELECT 'l_linenumber', count(*), count(*) - count(l_linenumber), 100.0 * (count(*) - count(l_linenumber)) / count(*), count(DISTINCT l_linenumber), CAST(min(l_linenumber) AS VARCHAR), CAST(max(l_linenumber) AS VARCHAR) FROM lineitem
    UNION ALL SELECT 'l_partkey', count(*), 0, 0.0, count(DISTINCT l_partkey), CAST(min(l_partkey) AS VARCHAR), CAST(max(l_partkey) AS VARCHAR) FROM lineitem""")
def profile_columns(spark, sf):
    return profile.profile(table(spark, sf, "lineitem"), ["l_returnflag", "l_linenumber", "l_partkey"])


# catalogs: a table of six columns for each customer, and one of concepts
CATALOG_SQL = """cat AS (SELECT 'db' AS lib_database, 'omop' AS lib_schema, CASE WHEN k % 2 = 0 THEN 'ems_' ELSE 'orbis_' END || k AS t,
    CASE i WHEN 1 THEN 't' || k || '_id' WHEN 2 THEN 'concept_id' WHEN 3 THEN 'x_concept_id' WHEN 4 THEN 't' || (k // 2) || '_id' WHEN 5 THEN 't' || (k // 3) || '_ref__id' ELSE 'concept_id_2' END AS lib_column, i AS order_column
    FROM (SELECT c_custkey AS k FROM customer), range(1, 7) r(i) UNION ALL SELECT 'db', 'omop', 'orbis_concept', 'concept_id', 1)"""


def column_catalog(spark, sf):
    k = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    part = lambda n: F.expr(f"k div {n}").cast("string")
    names = F.array(F.concat(F.lit("t"), "k", F.lit("_id")), F.lit("concept_id"), F.lit("x_concept_id"), F.concat(F.lit("t"), part(2), F.lit("_id")), F.concat(F.lit("t"), part(3), F.lit("_ref__id")), F.lit("concept_id_2"))
    rows = k.select(F.lit("db").alias("lib_database"), F.lit("omop").alias("lib_schema"), F.concat(F.when(F.col("k") % 2 == 0, "ems_").otherwise("orbis_"), "k").alias("lib_table"), F.posexplode(names).alias("pos", "lib_column"))
    own = rows.select("lib_database", "lib_schema", "lib_table", "lib_column", (F.col("pos") + 1).alias("order_column"))
    return own.union(spark.createDataFrame([("db", "omop", "orbis_concept", "concept_id", 1)], own.schema))


@query(f"WITH {CATALOG_SQL} SELECT t AS lib_table, lib_column, CASE WHEN split_part(t, '_', 1) IN ('orbis', 'ems') AND contains(t, '_') THEN split_part(t, '_', 1) ELSE 'orbis' END AS outil_source, regexp_matches(lib_column, '_id$') AND order_column = 1 AS is_pk, regexp_matches(lib_column, '_id$') AND order_column <> 1 AS is_fk FROM cat")
def catalog_keys(spark, sf):
    s = catalog.STRATEGIES["default"]
    return s.keys(s.source(column_catalog(spark, sf))).select("lib_table", "lib_column", "outil_source", "is_pk", "is_fk")


def _references(strategy):
    def run(spark, sf):
        s = catalog.STRATEGIES[strategy]
        refs = s.references(s.keys(s.source(column_catalog(spark, sf))))
        return refs.select("lib_table_source", "lib_column_source", "lib_table_target", "lib_column_target", "lib_reference")

    return run


def _linked(condition: str, foreign: str = "_id$") -> str:
    """References from later columns to first ones of other tables, by a condition on s and p."""
    return f"""SELECT s.t AS lib_table_source, s.lib_column AS lib_column_source, p.t AS lib_table_target, p.lib_column AS lib_column_target, 'FK' AS lib_reference
    FROM cat s JOIN cat p ON s.t <> p.t AND p.order_column = 1 AND s.order_column > 1 AND regexp_matches(s.lib_column, '{foreign}') AND {condition}"""


_CONCEPT = "regexp_replace(s.lib_column, '.*_concept_id$|concept_id_[0-9]$', 'concept_id') = p.lib_column"
_PLAIN = "replace(s.lib_column, '_ref_', '') = replace(p.lib_column, '_ref_', '') AND split_part(s.t, '_', 1) = split_part(p.t, '_', 1)"
_OMOP = f"WITH {CATALOG_SQL} {_linked(_CONCEPT, '_id$|_id_[0-9]$')}"


@query(f"WITH {CATALOG_SQL} {_linked(_PLAIN)} UNION ALL {_linked(_CONCEPT)}")
def fk_inference_default(spark, sf):
    """Names but for ``_ref_`` within a source, and concepts in any."""
    return _references("default")(spark, sf)


@query(_OMOP)
def fk_inference_concepts(spark, sf):
    """Equal names, and every kind of concept column."""
    return _references("omop")(spark, sf)


@query(f"WITH {CATALOG_SQL} {_linked('s.lib_column = p.lib_column')}")
def fk_inference_in_source(spark, sf):
    """Equal names only."""
    return _references("covidom")(spark, sf)


def keyed_events(spark, sf):
    """Columns named by number: first of each customer segment's table, then of all others."""
    c = table(spark, sf, "customer").select(F.lit("db").alias("lib_database"), F.lit("i2b2").alias("lib_schema"), F.concat(F.lit("orbis_"), F.lower("c_mktsegment")).alias("lib_table")).distinct()
    names = F.array(F.concat(F.lit("ids_"), F.substring("lib_table", 7, 20)), F.lit("ids_building"), F.lit("ids_eds"), F.lit("ids_cat_x"), F.lit("patient_num"))
    rows = c.select("*", F.posexplode(names).alias("pos", "lib_column")).select("lib_database", "lib_schema", "lib_table", "lib_column", (F.col("pos") + 1).alias("order_column"))
    cat = c.limit(1).select("lib_database", "lib_schema", F.lit("orbis_ref_cat").alias("lib_table"), F.lit("ids_ref_cat").alias("lib_column"), F.lit(1).alias("order_column"))
    return rows.union(cat)


_KEYED = """WITH tabs AS (SELECT DISTINCT 'orbis_' || lower(c_mktsegment) AS t FROM customer),
    cat AS (SELECT t, CASE i WHEN 1 THEN 'ids_' || substr(t, 7, 20) WHEN 2 THEN 'ids_building' WHEN 3 THEN 'ids_eds' WHEN 4 THEN 'ids_cat_x' ELSE 'patient_num' END AS c, i FROM tabs, range(1, 6) r(i)
            UNION ALL SELECT 'orbis_ref_cat', 'ids_ref_cat', 1)"""


@query(f"""{_KEYED} SELECT DISTINCT s.t AS lib_table_source, s.c AS lib_column_source, p.t AS lib_table_target, p.c AS lib_column_target
    FROM cat s JOIN cat p ON s.t <> p.t AND s.i > 1 AND s.c LIKE 'ids\\_%' ESCAPE '\\' AND s.c NOT LIKE 'ids\\_eds%' ESCAPE '\\'
    AND ((p.i = 1 AND replace(s.c, '_ref_', '') = replace(p.c, '_ref_', '')) OR (p.t = 'orbis_ref_cat' AND s.c LIKE '%\\_cat\\_%' ESCAPE '\\'))""")
def fk_inference_categories(spark, sf):
    s = catalog.STRATEGIES["eds"]
    return s.references(s.keys(s.source(keyed_events(spark, sf)))).select("lib_table_source", "lib_column_source", "lib_table_target", "lib_column_target")


@query(f"""{_KEYED} SELECT DISTINCT s.t AS lib_table_source, s.c AS lib_column_source, p.t AS lib_table_target, p.c AS lib_column_target
    FROM (SELECT * FROM cat UNION ALL SELECT t || '_2', 'patient_num', 1 FROM tabs) s JOIN (SELECT * FROM cat UNION ALL SELECT t || '_2', 'patient_num', 1 FROM tabs) p
    ON s.t <> p.t AND s.i > 1 AND p.i = 1 AND s.c = p.c AND regexp_matches(s.c, '_num$|concept_cd$')""")
def fk_inference_numbers(spark, sf):
    s, rows = catalog.STRATEGIES["i2b2"], keyed_events(spark, sf)
    more = rows.where("lib_column = 'patient_num'").select("lib_database", "lib_schema", F.concat("lib_table", F.lit("_2")).alias("lib_table"), "lib_column", F.lit(1).alias("order_column"))
    return s.references(s.keys(s.source(rows.union(more)))).select("lib_table_source", "lib_column_source", "lib_table_target", "lib_column_target")


@query("SELECT n_name AS lib_table, 1 AS order_column, 'key' AS lib_column, 'long' AS typ_column, true AS is_mandatory FROM nation UNION ALL SELECT n_name, 2, lower(n_name), 'string', false FROM nation")
def catalog_json(spark, sf):
    text = F.concat(F.lit('{"type":"struct","fields":[{"name":"key","type":"long","nullable":false,"metadata":{}},{"name":"'), F.lower("n_name"), F.lit('","type":"string","nullable":true,"metadata":{}}]}'))
    return catalog.columns_of_json(table(spark, sf, "nation").select(F.col("n_name").alias("lib_table"), text.alias("schema")))


@query("SELECT c_mktsegment AS lib_table, 'c_acctbal' AS lib_column, count(*) AS count_table, count(*) FILTER (c_acctbal < 0) AS count_null, 100.0 * count(*) FILTER (c_acctbal < 0) / count(*) AS null_ratio, count(DISTINCT c_nationkey) AS count_distinct FROM customer GROUP BY c_mktsegment")
def catalog_statistics(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("db").alias("lib_database"), F.lit("s").alias("lib_schema"), F.col("c_mktsegment").alias("lib_table"), F.lit("c_acctbal").alias("lib_column"), "c_acctbal", "c_nationkey")
    keys = ["lib_database", "lib_schema", "lib_table", "lib_column"]
    columns = c.groupBy(*keys).agg(F.count("*").alias("count_table"))
    nulls = c.groupBy(*keys).agg(F.count_if(F.col("c_acctbal") < 0).alias("count_null"))
    distincts = c.groupBy(*keys).agg(F.count_distinct("c_nationkey").alias("count_distinct"))
    return catalog.with_statistics(columns, nulls, distincts).drop("lib_database", "lib_schema")


@query("SELECT n_name AS lib_table, last_change FROM nation LEFT JOIN (SELECT c_nationkey, max(o_orderdate) AS last_change FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1) ON c_nationkey = n_nationkey")
def catalog_last_change(spark, sf):
    named = lambda df: df.select(F.lit("db").alias("lib_database"), F.lit("s").alias("lib_schema"), F.col("n_name").alias("lib_table"), *(c for c in df.columns if c == "o_orderdate"))
    n, c, o = (table(spark, sf, x) for x in ("nation", "customer", "orders"))
    log = n.join(c, n.n_nationkey == c.c_nationkey).join(o, o.o_custkey == c.c_custkey)
    return catalog.with_last_change(named(n), named(log), "o_orderdate").select("lib_table", "last_change")


@query(f"""WITH {CATALOG_SQL}, refs AS ({_linked(_CONCEPT, '_id$|_id_[0-9]$')}),
    up AS (SELECT lib_table_source AS t, count(DISTINCT lib_table_target) AS n FROM refs GROUP BY 1), down AS (SELECT lib_table_target AS t, count(DISTINCT lib_table_source) AS n FROM refs GROUP BY 1)
    SELECT t AS lib_table, count(*) AS n_columns, coalesce(any_value(up.n), 0) AS n_parents, coalesce(any_value(down.n), 0) AS n_children FROM cat LEFT JOIN up USING (t) LEFT JOIN down USING (t) GROUP BY t""")
def catalog_summary(spark, sf):
    s = catalog.STRATEGIES["omop"]
    full = s.keys(s.source(column_catalog(spark, sf)))
    return catalog.table_summary(full, s.references(full))


@query(f"WITH refs AS ({_OMOP}) SELECT DISTINCT least(lib_table_source, lib_table_target) AS a, greatest(lib_table_source, lib_table_target) AS b FROM refs")
def catalog_links(spark, sf):
    s = catalog.STRATEGIES["omop"]
    refs = s.references(s.keys(s.source(column_catalog(spark, sf))))
    return catalog.table_links(catalog.distinct_references(refs.union(refs)))


@query("SELECT count(DISTINCT t) AS n_tables, 1 AS n_schemas, count(DISTINCT (t, lib_column)) AS n_columns FROM (WITH " + CATALOG_SQL + " SELECT * FROM cat)")
def catalog_assembly(spark, sf):
    c = catalog.assemble(column_catalog(spark, sf), "omop", "omop")
    return c.table.agg(F.count("*").alias("n_tables")).crossJoin(c.schema.agg(F.count("*").cast("int").alias("n_schemas"))).crossJoin(c.column.agg(F.count("*").alias("n_columns")))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'edited' ELSE c_name END AS name FROM customer WHERE c_custkey % 5 <> 0")
def catalog_active_view(spark, sf):
    n = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "CAST(NULL AS STRING) AS name_m", "c_custkey % 5 <> 0 AS is_active")
    edits = n.where("id % 3 = 0").select("id", F.lit("edited").alias("name"))
    return catalog.active_view(catalog.override(n, edits, "id", ["name"]), ["name"]).drop("is_active")


@query("SELECT c_custkey AS lib_table, c_custkey % 4 <> 0 AS is_active, n_name AS parent FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND c_custkey % 4 <> 0 WHERE c_custkey % 5 <> 0 OR c_custkey % 4 <> 0")
def catalog_load(spark, sf):
    c = table(spark, sf, "customer")
    old = c.where("c_custkey % 5 <> 0").selectExpr("c_custkey AS lib_table", "c_nationkey AS nation", "CAST(NULL AS STRING) AS parent", "true AS is_active")
    found = c.where("c_custkey % 4 <> 0").selectExpr("c_custkey AS lib_table", "c_nationkey AS nation")
    lookup = table(spark, sf, "nation").selectExpr("n_nationkey AS nation", "n_name AS parent")
    return catalog.load_level(old, found, ["lib_table"], [(lookup, ["nation"])]).drop("nation")


@query(f"WITH {TARGET_SQL}, {SOURCE_SQL} SELECT coalesce(t.k, s.k) AS k, coalesce(s.v, t.v) AS v FROM t FULL JOIN s ON t.k = s.k")
def merge_hash_gated(spark, sf):
    """Updates gated by a stored hash of the tracked columns."""
    target, source = merge_sides(spark, sf)
    hashed = lambda df: df.select("k", "v", scalars.row_digest(F.col("k"), F.col("v")).alias("hash"))
    return versioning.scd1(hashed(target), hashed(source), ["k"], compare=["hash"]).select("k", "v")


@query(f"WITH {CATALOG_SQL} SELECT t AS lib_table, lib_column, order_column, row_number() OVER (ORDER BY t, order_column) AS place FROM cat")
def catalog_ordered(spark, sf):
    ordered = catalog.in_order(column_catalog(spark, sf)).withColumn("key", F.concat_ws("/", "lib_table", F.format_string("%04d", "order_column")))
    return schema.with_sequence(ordered.select("key", "lib_table", "lib_column", "order_column"), "place").drop("key")


@query(f"SELECT DISTINCT * FROM ({_OMOP})")
def catalog_references(spark, sf):
    s = catalog.STRATEGIES["omop"]
    refs = s.references(s.keys(s.source(column_catalog(spark, sf))))
    return catalog.distinct_references(refs.union(refs)).select("lib_table_source", "lib_column_source", "lib_table_target", "lib_column_target", "lib_reference")


@query("SELECT o_orderkey, n_name AS name, c_nationkey AS nation FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 12")
def lookup_join(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_nationkey").alias("nation"))
    lookup = table(spark, sf, "nation").where("n_nationkey < 12").selectExpr("n_nationkey AS nation", "n_name AS name")
    return catalog.looked_up(o, lookup, ["nation"])


@query("SELECT 'c_name' AS field, 'required' AS \"constraint\", 1.0::DOUBLE AS ratio, true AS fatal, count(c_name) / count(*) AS value, count(c_name) = count(*) AS passed FROM customer UNION ALL SELECT 'c_acctbal', 'minimum', 0.99::DOUBLE, false, count(*) FILTER (c_acctbal >= 0) / count(*), count(*) FILTER (c_acctbal >= 0) / count(*) >= 0.99 FROM customer")
def quality_verdicts(spark, sf):
    checks = quality.from_yaml("fields: [{name: c_name, required: true}, {name: c_acctbal, minimum: 0, ratio: 0.99, fatal: false}]")
    results = quality.evaluate(table(spark, sf, "customer"), checks)
    return spark.createDataFrame([(r.field, r.constraint, r.ratio, r.fatal, r.value, r.passed) for r in results], "field string, constraint string, ratio double, fatal boolean, value double, passed boolean")
