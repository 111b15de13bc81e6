"""Queries of the relation algebra: joins, filters, events, selections, groupings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.plans.predicate import EMPTY, FALSE, TRUE, Entity, Event, Is, predicate
from tablewright.plans.relation import Relation, count_all, count_distinct_required
from tablewright.suite import query, table


def customer(spark, sf):
    return Relation(table(spark, sf, "customer"), "customer", ("c_custkey",), "o_custkey")


def orders(spark, sf):
    return Relation(table(spark, sf, "orders"), "orders", ("o_orderkey",), "l_orderkey", {"ordered": "o_orderdate"})


def nation(spark, sf):
    return Relation(table(spark, sf, "nation"), "nation", ("n_nationkey",), "c_nationkey")


def region(spark, sf):
    return Relation(table(spark, sf, "region"), "region", ("r_regionkey",), "n_regionkey")


def lineitem(spark, sf):
    return Relation(table(spark, sf, "lineitem"), "lineitem", ("l_orderkey", "l_linenumber"))


def part(spark, sf):
    return Relation(table(spark, sf, "part"), "part", ("p_partkey",), "l_partkey")


def events(spark, sf):
    return Relation(table(spark, sf, "events"), "events", ("event_id",), events={"happened": "ts"})


def shifted_customer(spark, sf):
    """All customers; a tenth has keys that no order knows."""
    key = F.col("c_custkey")
    return Relation(table(spark, sf, "customer").withColumn("c_custkey", F.when(key % 10 == 0, -key - 1).otherwise(key)), "customer", ("c_custkey",), "o_custkey")


#: Customers of a group in join_on_leaf, at most.
TOGETHER = 256

#: The same in SQL.
SHIFTED = "(SELECT CASE WHEN c_custkey % 10 = 0 THEN -c_custkey - 1 ELSE c_custkey END AS c_custkey FROM customer)"


@query("""SELECT c_custkey, any_value(c_name) AS c_name, any_value(c_nationkey) AS c_nationkey,
    any_value(c_acctbal) AS c_acctbal, any_value(c_mktsegment) AS c_mktsegment, count(DISTINCT o_orderkey) AS orders
    FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 100000 GROUP BY c_custkey""")
def flagship(spark, sf):
    c, o = customer(spark, sf), orders(spark, sf)
    return ((c + o) | (o["o_totalprice"] > 100000)) / c


@query("SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey")
def join_inner(spark, sf):
    r = customer(spark, sf) + orders(spark, sf)
    return r.df.select(r["c_custkey"], r["c_name"], r["o_orderkey"], r["o_totalprice"])


@query(f"SELECT c_custkey, o_orderkey FROM {SHIFTED} LEFT JOIN orders ON c_custkey = o_custkey")
def join_left(spark, sf):
    r = shifted_customer(spark, sf) % orders(spark, sf)
    return r.df.select(r["c_custkey"], r["o_orderkey"])


@query(f"SELECT c_custkey, o_orderkey FROM {SHIFTED} RIGHT JOIN orders ON c_custkey = o_custkey")
def join_right(spark, sf):
    r = shifted_customer(spark, sf).right_join(orders(spark, sf))
    return r.df.select(r["c_custkey"], r["o_orderkey"])


@query(f"SELECT c_custkey, o_orderkey FROM {SHIFTED} FULL JOIN orders ON c_custkey = o_custkey")
def join_full(spark, sf):
    r = shifted_customer(spark, sf).full_join(orders(spark, sf))
    return r.df.select(r["c_custkey"], r["o_orderkey"])


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def join_anti(spark, sf):
    o = orders(spark, sf)
    r = customer(spark, sf) - (o | (o["o_totalprice"] > 200000))
    return r.df.select(r["c_custkey"], r["c_name"])


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def join_semi(spark, sf):
    o = orders(spark, sf)
    r = customer(spark, sf) ^ (o | (o["o_totalprice"] > 200000))
    return r.df.select(r["c_custkey"], r["c_name"])


@query("SELECT r_name, c_custkey FROM region CROSS JOIN customer")
def join_cross(spark, sf):
    r = region(spark, sf) * customer(spark, sf)
    return r.df.select(r["r_name"], r["c_custkey"])


@query("""SELECT r_name, n_name, c_custkey, o_orderkey, l_linenumber FROM region
    JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
    JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey""")
def join_auto_chain(spark, sf):
    x = region(spark, sf) + nation(spark, sf) + customer(spark, sf) + orders(spark, sf) + lineitem(spark, sf)
    return x.df.select(*(x[c] for c in ("r_name", "n_name", "c_custkey", "o_orderkey", "l_linenumber")))


@query("""SELECT a.c_custkey, a.c_nationkey, b.c_name FROM customer a
    JOIN (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN c_name || '?' ELSE c_name END AS c_name, c_nationkey FROM customer) b
    ON a.c_custkey = b.c_custkey AND a.c_name = b.c_name AND a.c_nationkey = b.c_nationkey""")
def join_common_columns(spark, sf):
    c = table(spark, sf, "customer")
    a, b = Relation(c, "a"), Relation(c.select("c_custkey", F.when(F.col("c_custkey") % 10 == 0, F.concat("c_name", F.lit("?"))).otherwise(F.col("c_name")).alias("c_name"), "c_nationkey"), "b")
    return (a + ~b).df.select(a["c_custkey"], a["c_nationkey"], b["c_name"])


@query("SELECT a.l_partkey AS left_part, b.l_partkey AS right_part FROM lineitem a JOIN lineitem b USING (l_orderkey) WHERE a.l_linenumber < b.l_linenumber")
def join_on_name(spark, sf):
    a, b = lineitem(spark, sf).alias("a"), lineitem(spark, sf).alias("b")
    r = (a + b.on("l_orderkey")) | (a["l_linenumber"] < b["l_linenumber"])
    return r.df.select(a["l_partkey"].alias("left_part"), b["l_partkey"].alias("right_part"))


@query("SELECT n_name, s_suppkey, s_name FROM nation JOIN supplier ON s_nationkey = n_nationkey")
def join_on_names(spark, sf):
    s = Relation(table(spark, sf, "supplier"), "supplier", ("s_suppkey",))
    r = nation(spark, sf) + s.on(("n_nationkey", "s_nationkey"))
    return r.df.select(r["n_name"], r["s_suppkey"], r["s_name"])


@query("""SELECT c_custkey, s_suppkey FROM customer JOIN nation ON n_nationkey = c_nationkey
    JOIN (SELECT s_suppkey, s_nationkey AS n_nationkey FROM supplier) s ON s.n_nationkey = nation.n_nationkey""")
def join_on_leaf(spark, sf):
    s = Relation(table(spark, sf, "supplier").selectExpr("s_suppkey", "s_nationkey AS n_nationkey"), "supplier", ("s_suppkey",))
    # Each customer meets every supplier of its nation, so a few customers are a task's work. They are joined in
    # groups: one supplier for many rows in a row, then the next, which files keep in a few bits a row.
    dealt = table(spark, sf, "customer").select("c_custkey", "c_nationkey").repartition(64, "c_custkey").sortWithinPartitions("c_nationkey", "c_custkey")
    dealt = dealt.withColumn("part", F.floor(F.monotonically_increasing_id() / TOGETHER)).repartition(64, "part")
    c = Relation(dealt.groupBy("part", "c_nationkey").agg(F.collect_list(F.struct("c_custkey")).alias("customers")), "customer", ("part", "c_nationkey"), "o_custkey")
    n = nation(spark, sf)
    r = (c + n) + s.on((n, "n_nationkey"))
    return r.df.select(F.inline(c["customers"]), s["s_suppkey"])


@query("SELECT p_partkey, p_size, n_nationkey FROM nation JOIN part ON p_size > n_nationkey AND p_size <= n_nationkey + 2")
def join_on_condition(spark, sf):
    n, p = nation(spark, sf), part(spark, sf)
    r = n + p.on((p["p_size"] > n["n_nationkey"]) & (p["p_size"] <= n["n_nationkey"] + 2))
    return r.df.select(p["p_partkey"], p["p_size"], n["n_nationkey"])


@query("""SELECT p.c_name AS parent_name, m.c_name AS member_name FROM customer p JOIN customer m
    ON p.c_custkey = m.c_nationkey WHERE p.c_custkey <> m.c_custkey""")
def self_join_alias(spark, sf):
    c = Relation(table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_nationkey").cast("long").alias("c_nationkey")), "customer", ("c_custkey",))
    p, m = c.alias("p"), c.alias("m")
    r = (p + m.on(("c_custkey", "c_nationkey"))) | (p["c_custkey"] != m["c_custkey"])
    # both sides have c_name, so the leaves are named
    return r.df.select(p["c_name"].alias("parent_name"), m["c_name"].alias("member_name"))


@query("SELECT n_nationkey AS nation_n_nationkey, n_name AS nation_n_name, n_regionkey AS nation_n_regionkey, r_regionkey AS reg_r_regionkey, r_name AS reg_r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def select_prefixed(spark, sf):
    n, r = nation(spark, sf), region(spark, sf)
    return (n + r).select((n, "nation_"), (r, "reg_"))


@query("SELECT n_nationkey AS nation_n_nationkey, n_name AS nation_n_name, n_regionkey AS nation_n_regionkey, r_regionkey AS region_r_regionkey, r_name AS region_r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def select_leaves(spark, sf):
    return (nation(spark, sf) + region(spark, sf)).select()


@query("SELECT a.n_nationkey, a.n_name, a.n_regionkey, r_regionkey, r_name FROM nation a JOIN region ON n_regionkey = r_regionkey")
def select_skip_duplicates(spark, sf):
    n, r = nation(spark, sf), region(spark, sf)
    twice = (n + r) + nation(spark, sf).alias("again").on("n_nationkey")
    return twice.select_plain(skip_duplicates=True)


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'")
def filter_chain(spark, sf):
    o = orders(spark, sf)
    r = ((o | (o["o_totalprice"] > 100000)) | (o["o_orderstatus"] == "F")) | ~predicate(o["o_orderpriority"] == "1-URGENT")
    return r.df.select(r["o_orderkey"])


@query("SELECT o_orderkey FROM orders WHERE NOT (o_totalprice > 100000 AND (o_orderstatus = 'F' OR o_orderstatus = 'O'))")
def predicate_algebra(spark, sf):
    o = orders(spark, sf)
    dear, finished, is_open = Is(o["o_totalprice"] > 100000), Is(o["o_orderstatus"] == "F"), Is(o["o_orderstatus"] == "O")
    return (o | ~(dear & (finished | is_open))).df.select(o["o_orderkey"])


@query("SELECT count(*) AS n_true, 0 AS n_false, count(*) AS n_empty, count(*) FILTER (n_nationkey > 10) AS n_mixed FROM nation")
def predicate_constants(spark, sf):
    n = nation(spark, sf)
    big = Is(n["n_nationkey"] > 10)
    count = lambda p: F.count_if(p.column())
    return n.df.agg(count(TRUE).alias("n_true"), count(FALSE).cast("int").alias("n_false"), count(EMPTY & EMPTY).alias("n_empty"), count((TRUE & big) | (FALSE | EMPTY)).alias("n_mixed"))


@query("SELECT a.l_partkey AS x, b.l_partkey AS y FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND NOT (a.l_linenumber = b.l_linenumber)")
def entity_equality(spark, sf):
    a, b = lineitem(spark, sf).alias("a"), lineitem(spark, sf).alias("b")

    class Line(Entity):
        def __init__(self, r):
            self.r = r

        def same_as(self, other):
            return Is(self.r["l_linenumber"] == other.r["l_linenumber"])

    r = (a + b.on("l_orderkey")) | Line(a).differs(Line(b))
    return r.df.select(a["l_partkey"].alias("x"), b["l_partkey"].alias("y"))


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'")
def event_between(spark, sf):
    e = events(spark, sf)
    first, last = (Event(F.lit(t).cast("timestamp_ntz")) for t in ("2024-01-10", "2024-01-20"))
    return (e | (e.happens().after(first) & e.happens().before(last))).df.select(e["event_id"])


@query("SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate + INTERVAL 100 DAY OR l_shipdate < o_orderdate + INTERVAL 2 DAY")
def event_interval(spark, sf):
    o, line = orders(spark, sf), lineitem(spark, sf)
    ordered, shipped = o.event("ordered"), Event(line["l_shipdate"])
    r = (o + line) | ((shipped > ordered + "100 days") | (shipped - "2 days" < ordered))
    return r.df.select(o["o_orderkey"], line["l_linenumber"])


@query("SELECT c_custkey, max(o_orderdate) AS last_order FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey HAVING max(o_orderdate) IS NULL OR max(o_orderdate) < TIMESTAMP '1998-01-01'")
def event_happened(spark, sf):
    c, o = customer(spark, sf), orders(spark, sf)
    last = (c % o).df.groupBy(c["c_custkey"]).agg(F.max(o["o_orderdate"]).alias("last_order"))
    r = Relation(last, "last", ("c_custkey",), events={"ordered": "last_order"})
    return (r | (~r.event() | (r.event() < Event(F.lit("1998-01-01").cast("timestamp_ntz"))))).df.select("c_custkey", "last_order")


@query("SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def union_relations(spark, sf):
    c = Relation(table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name"), "party")
    s = Relation(table(spark, sf, "supplier").selectExpr("s_name AS name", "s_suppkey AS id"), "supplier")
    both = c & s
    return both.df.select(both["id"], both["name"])


@query("SELECT n_name, count(DISTINCT c_custkey) AS customer, any_value(n_regionkey) AS n_regionkey, n_nationkey FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name")
def group_by_leaf(spark, sf):
    n, c = nation(spark, sf), customer(spark, sf)
    return (n % c) / n


@query("""SELECT n_regionkey, c_mktsegment, count(o_orderkey) AS orders FROM nation JOIN customer ON c_nationkey = n_nationkey
    JOIN orders ON o_custkey = c_custkey GROUP BY n_regionkey, c_mktsegment""")
def group_by_columns(spark, sf):
    n, c, o = nation(spark, sf), customer(spark, sf), orders(spark, sf)
    r = n + c + o
    return r.group_by((n, ["n_regionkey"]), (c, ["c_mktsegment"]), agg=count_all).select("n_regionkey", "c_mktsegment", "orders")


@query("SELECT n_name, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS customer FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name")
def group_by_aggregate(spark, sf):
    n, c = nation(spark, sf), customer(spark, sf)
    total = lambda leaf: F.sum(F.round(leaf["c_acctbal"] * 100).cast("long")).alias(leaf.name)
    return (n + c).group_by((n, ["n_name"]), agg=total).select("n_name", "customer")


@query("SELECT r_name, any_value(r_regionkey) AS r_regionkey, count(DISTINCT n_name) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def count_distinct_non_nullable(spark, sf):
    n = table(spark, sf, "nation").select(F.coalesce("n_name", F.lit("")).alias("name"), "n_regionkey")
    r, named = region(spark, sf), Relation(n, "n")
    joined = r + named.on(("r_regionkey", "n_regionkey"))
    return joined.group_by((r, ["r_name"]), agg=count_distinct_required)
