"""A trie of conversations by their common first turns, with totals of every subtree.

Turns are digested first, so texts are read once and never shuffled. They are dealt out by ranges of
(conversation, turn) and numbered there, however long a conversation is; only the ranges' last
states (one a task) meet on the driver. A prefix's key is the polynomial of its turns' SHA-256 digests
modulo 2^127 - 1: a running sum, so ranges work apart and a conversation's rest can be put behind
another's first turns by a shift. Prefixes with one key are one node.

Subtree totals come from parallel tree contraction. A round rakes all leaves into their parents and
compresses unary chains: a unary node absorbs its only child where that is unary too and their depths
differ in the round's bit, so half of a long chain goes at once. Rounds grow with the logarithm of the
number of nodes. Absorbed nodes are then expanded again, last round first: their total is that of
the node that absorbed them less what it held before.

Defined cases: rows with a null conv_id belong to no conversation and are left out; a null turn comes
first; turns of one number go by the digest of role and text; repeated rows are turns of their own; null roles and texts are empty; texts of any length count whole. No
conversations give no nodes, not even the root. Other columns of the caller's are left out.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import looked_up, new_path
from tablewright.runtime import ship_package

PRIME = (1 << 127) - 1
#: Any large number; its powers place the turns of a prefix.
BASE = 0x5DEECE66D1CE4E5B9A3F7B1D2C8E4F61
ROOT = bytes(16)
#: Shared turns are at most five; see rebuilt().
SHARED = 5


def put(df: DataFrame, name: str) -> str:
    """``df`` as Parquet in the shared folder; where it is."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return path


def read(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def key(x: int) -> bytes:
    return (x % PRIME).to_bytes(16, "big")


def number(k: bytes) -> int:
    return int.from_bytes(k, "big")


LOCATED = "conv_id long, part int, pos long, before binary, after binary, chars long"


def located(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), chars and the keys of the prefixes before and after each turn."""
    spark = turns.sparkSession
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.sha2(F.concat_ws(":", F.length(role), role, text), 256).alias("digest"),
        F.monotonically_increasing_id().alias("nth"),
        F.length(text).cast("long").alias("chars"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("nth")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "chars")

    def numbered(records):
        part, now, pos, prefix, power = TaskContext.get().partitionId(), None, 0, 0, 1
        for record in records:
            place, before, after = [], [], []
            for conv, digest in zip(record.column("conv_id").to_pylist(), record.column("digest").to_pylist(), strict=True):
                if conv != now:
                    now, pos, prefix, power = conv, 0, 0, 1
                pos, power = pos + 1, power * BASE % PRIME
                place.append(pos)
                before.append(key(prefix))
                prefix = (prefix + int(digest[:32], 16) * power) % PRIME
                after.append(key(prefix))
            n = record.num_rows
            yield pa.RecordBatch.from_arrays([record.column("conv_id"), pa.array([part] * n, pa.int32()), pa.array(place, pa.int64()), pa.array(before, pa.binary()), pa.array(after, pa.binary()), record.column("chars")], names=[f.split()[0] for f in LOCATED.split(", ")])

    rows = read(spark, put(ranged.mapInArrow(numbered, LOCATED), "trie-turns"))
    # a range may begin within a conversation: then the ranges before it say how far that has come
    last = rows.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos", "after")).alias("last")).orderBy("part").collect()  # one row a task
    carry, state = {}, None
    for r in last:
        conv, pos, prefix = r.last.conv_id, r.last.pos, number(r.last.after)
        if state and state[0] == r.first:
            carry[r.part] = state
            if conv == r.first:
                pos, prefix = pos + state[1], (state[2] + prefix * pow(BASE, state[1], PRIME)) % PRIME
        state = (conv, pos, prefix)
    if not carry:
        return rows.drop("part")
    sent = spark.sparkContext.broadcast(carry)

    def continued(records):
        for record in records:
            columns = {c: record.column(c).to_pylist() for c in ("conv_id", "part", "pos", "before", "after")}
            for i, (conv, part) in enumerate(zip(columns["conv_id"], columns["part"], strict=True)):
                begun = sent.value.get(part)
                if begun and begun[0] == conv:
                    columns["pos"][i] += begun[1]
                    shift = pow(BASE, begun[1], PRIME)
                    for side in ("before", "after"):
                        columns[side][i] = key(begun[2] + number(columns[side][i]) * shift)
            yield pa.RecordBatch.from_arrays([record.column("conv_id"), pa.array(columns["pos"], pa.int64()), pa.array(columns["before"], pa.binary()), pa.array(columns["after"], pa.binary()), record.column("chars")], names=["conv_id", "pos", "before", "after", "chars"])

    return read(spark, put(rows.mapInArrow(continued, LOCATED.replace("part int, ", "")), "trie-turns"))


REBUILT = "conv_id long, depth long, before binary, after binary, chars long"


def behind(rows: DataFrame) -> DataFrame:
    """A conversation's turns after its first h, put behind the m turns that come from another: rows
    with conv_id, pos, before, after, chars, h, m, theirs (key of the m turns) and own (of the h)."""

    def moved(records):
        for record in records:
            depth, keys = [], {"before": [], "after": []}
            names = ("pos", "h", "m", "theirs", "own", "before", "after")
            for pos, h, m, theirs, own, before, after in zip(*(record.column(c).to_pylist() for c in names), strict=True):
                depth.append(pos - h + m)
                shift, own, theirs = pow(BASE, m - h, PRIME), number(own), number(theirs)
                keys["before"].append(key(theirs + (number(before) - own) * shift))
                keys["after"].append(key(theirs + (number(after) - own) * shift))
            yield pa.RecordBatch.from_arrays([record.column("conv_id"), pa.array(depth, pa.int64()), pa.array(keys["before"], pa.binary()), pa.array(keys["after"], pa.binary()), record.column("chars")], names=["conv_id", "depth", "before", "after", "chars"])

    return rows.mapInArrow(moved, REBUILT)


def shared_turns() -> F.Column:
    """How many first turns a conversation takes from the first of its hundred."""
    return F.expr(f"crc32(CAST(CAST(conv_id AS string) AS binary)) % {SHARED + 1}")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations (REBUILT), and where each ends (the same columns, one
    row a conversation, depth 0 where it has no turn): the first h turns of the conversation
    conv_id - conv_id % 100, then the own turns after the first h; h: see shared_turns()."""
    spark = turns.sparkSession
    turns = located(turns)
    head = F.when(F.col("pos") <= SHARED, F.struct("pos", "before", "after", "chars"))
    convs = turns.groupBy("conv_id").agg(F.max(F.struct("pos", "after")).alias("end"), F.array_sort(F.collect_list(head)).alias("heads"))
    convs = read(spark, put(convs.withColumns({"h": shared_turns(), "first": F.expr("conv_id - conv_id % 100")}), "trie-conversations"))
    at = lambda heads, n: F.when(n > 0, F.try_element_at(heads, n.cast("int"))["after"]).otherwise(F.lit(ROOT))
    # at most a hundred conversations take turns from one
    theirs = convs.select(F.col("conv_id").alias("first"), F.col("heads").alias("given"))
    m = F.least("h", F.coalesce(F.size("given"), F.lit(0)))
    plan = convs.join(theirs, "first", "left").withColumn("m", F.when(F.col("given").isNull(), 0).otherwise(m).cast("long"))
    plan = plan.select("conv_id", "h", "m", at(F.col("given"), F.col("m")).alias("theirs"), at(F.col("heads"), F.col("h")).alias("own"), F.col("end.pos").alias("n"), F.col("end.after").alias("last"), F.slice("given", F.lit(1), F.col("m").cast("int")).alias("taken"))
    plan = read(spark, put(plan, "trie-plan"))
    taken = plan.select("conv_id", F.explode("taken").alias("t")).select("conv_id", F.col("t.pos").alias("depth"), "t.before", "t.after", "t.chars")
    rest = turns.where(F.col("pos") > shared_turns())
    rest = looked_up(rest, plan.select("conv_id", "h", "m", "theirs", "own", "n"), "conv_id", "n")
    ends = plan.where("n > h").select("conv_id", F.col("n").alias("pos"), F.col("last").alias("before"), F.col("last").alias("after"), F.lit(0).cast("long").alias("chars"), "h", "m", "theirs", "own")
    short = plan.where("n <= h").select("conv_id", F.col("m").alias("depth"), F.col("theirs").alias("before"), F.col("theirs").alias("after"), F.lit(0).cast("long").alias("chars"))
    return taken.unionByName(behind(rest)), short.unionByName(behind(ends))


def ends_digest(ends: DataFrame) -> DataFrame:
    """after, ends_sha256: of the ascending conv_ids that end at a node, joined by commas.

    Ranges of conv_ids write them down as text, a row for each node and batch; a node's texts are
    then hashed in order as they stream by, so no list of a node is ever held."""
    ship_package(ends.sparkSession)

    def written(records):
        for record in records:
            lists: dict[bytes, list[int]] = {}
            for conv, after in zip(record.column("conv_id").to_pylist(), record.column("after").to_pylist(), strict=True):
                lists.setdefault(after, []).append(conv)
            yield pa.RecordBatch.from_arrays([pa.array(list(lists), pa.binary()), pa.array([v[0] for v in lists.values()], pa.int64()), pa.array([",".join(map(str, v)) for v in lists.values()], pa.string())], names=["after", "first", "ids"])

    def hashed(records):
        now, state = None, None
        for record in records:
            done = []
            for after, ids in zip(record.column("after").to_pylist(), record.column("ids").to_pylist(), strict=True):
                if after != now:
                    done += [(now, state.hexdigest())] if state else []
                    now, state = after, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield out(done)
        yield out([(now, state.hexdigest())] if state else [])

    out = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["after", "ends_sha256"])
    lists = ends.select("conv_id", "after").repartitionByRange("conv_id").sortWithinPartitions("conv_id").mapInArrow(written, "after binary, first long, ids string")
    return lists.repartition("after").sortWithinPartitions("after", "first").select("after", "ids").mapInArrow(hashed, "after binary, ends_sha256 string")


def subtree_totals(tree: DataFrame, sums: list[str], settle: int = 200) -> DataFrame:
    """id and the totals of ``sums`` over each node's subtree, the node included.

    ``tree``: id, parent (null at a root), depth, kids (number of children) and the columns of
    ``sums`` (long). No join here has a hot key: sums of leaves meet in partial aggregates by
    parent, and absorbing nodes, absorbed nodes and their only children are each there once.
    """
    spark = tree.sparkSession
    old = {s: F.col(s) for s in sums}
    active, rounds, absorbed = tree.select("id", "parent", "depth", "kids", *sums), [], []
    bits = max(1, int(tree.agg(F.max("depth")).first()[0] or 0).bit_length())
    for step in range(settle):
        leaf = F.col("kids") == 0
        told = active.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count_if(leaf).alias("raked"), F.max(F.when(~leaf, F.col("id"))).alias("only"), *(F.coalesce(F.sum(F.when(leaf, old[s])), F.lit(0)).alias(f"more_{s}") for s in sums))
        after = active.join(told, "id", "left").select("id", "parent", "depth", leaf.alias("done"), (F.col("kids") - F.coalesce("raked", F.lit(0))).alias("kids"), "only", *((old[s] + F.coalesce(f"more_{s}", F.lit(0))).alias(s) for s in sums))
        rounds.append(put(after, "trie-raked"))
        after = read(spark, rounds[-1])
        left, unary = after.where("NOT done").agg(F.count("*"), F.count_if(F.col("kids") == 1)).first()
        if not left:
            break
        active = after.where("NOT done").drop("done", "only")
        if unary < 2:
            continue
        chain = after.where("NOT done AND kids = 1")
        bit = F.shiftright("depth", step % bits).bitwiseAND(1)
        above = chain.where(bit == 0).select(F.col("id").alias("above"), F.col("only").alias("id"), *(old[s].alias(f"held_{s}") for s in sums))
        pairs = chain.where(bit == 1).select("id", F.col("only").alias("child"), *sums).join(above, "id")
        absorbed.append(put(pairs, "trie-absorbed"))
        pairs = read(spark, absorbed[-1])
        nothing = {s: F.lit(None).cast("long").alias(f"add_{s}") for s in sums}
        none = F.lit(None).cast("long").alias("onto")
        changes = pairs.select("id", F.lit(True).alias("gone"), none, *nothing.values())
        changes = changes.union(pairs.select("above", F.lit(False), none, *sums)).union(pairs.select("child", F.lit(False), F.col("above"), *nothing.values()))
        changes = changes.groupBy("id").agg(F.max("gone").alias("gone"), F.max("onto").alias("onto"), *(F.max(f"add_{s}").alias(f"add_{s}") for s in sums))
        active = active.join(changes, "id", "left").where("gone IS NULL OR NOT gone").select("id", F.coalesce("onto", "parent").alias("parent"), "depth", "kids", *((old[s] + F.coalesce(f"add_{s}", F.lit(0))).alias(s) for s in sums))
    else:
        raise RuntimeError(f"the tree did not contract in {settle} rounds")
    done = read(spark, *rounds).where("done").select("id", *sums)
    if not absorbed:
        return done
    tops = done.join(read(spark, *absorbed).select(F.col("above").alias("id")).distinct(), "id", "left_semi")
    known = [put(tops, "trie-known")]
    for path in reversed(absorbed):
        whole = read(spark, *known).select(F.col("id").alias("above"), *(old[s].alias(f"total_{s}") for s in sums))
        found = read(spark, path).join(whole, "above").select("id", *((F.col(f"total_{s}") - F.col(f"held_{s}")).alias(s) for s in sums))
        known.append(put(found, "trie-known"))
    return done.unionByName(read(spark, *known[1:]))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    spark = turns.sparkSession
    ship_package(spark)
    rows, ends = rebuilt(turns)
    ends = read(spark, put(ends, "trie-ends"))
    nodes = rows.groupBy("depth", "after").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.max("before").alias("before"))
    root = ends.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("after"), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"), F.lit(None).cast("binary").alias("before"))
    nodes = read(spark, put(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "trie-nodes"))
    kids = nodes.where("depth > 0").groupBy(F.col("before").alias("after")).agg(F.count("*").alias("n_children"))
    nodes = read(spark, put(nodes.join(kids, "after", "left").fillna(0, ["n_children"]), "trie-nodes"))
    parents = nodes.where("n_children > 0").select(F.col("after").alias("before"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("uses"))
    linked = looked_up(nodes.where("depth > 0"), parents, "before", "uses").unionByName(nodes.where("depth = 0"), allowMissingColumns=True)
    linked = read(spark, put(linked, "trie-linked"))
    tree = linked.select("id", "parent", "depth", F.col("n_children").alias("kids"), (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    out = linked.join(totals, "id").join(ends_digest(ends), "after", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
