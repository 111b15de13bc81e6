import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablewright.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, id long, depth int, part string, first string"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA).repartition(parts)


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}:{text or ''}".encode()).hexdigest(), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def holds(spark, rows, parts=4):
    got = prefix_trie.prefix_trie(frame(spark, rows, parts)).select(*FIELDS).collect()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got) == brute(rows)


def some(n, seed, words=3, turns=7):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]), " ".join(r.choices("ab é".split(), k=r.randint(1, words)))) for c in range(n) for t in range(r.randint(1, turns))]


def test_against_brute_force(spark):
    rows = some(230, 1)
    odd = [(5000, None, None, None), (5000, 0, "", ""), (5001, 2, "user", "x"), (5001, 2, "user", "x"), (5001, 2, "user", "w"), (None, 0, "user", "lost"), (-7, 0, "user", "a"), (7007, 0, None, "z" * 50_000)]
    holds(spark, rows + odd + rows[:5])


def test_long_conversations_cross_ranges(spark):
    """Most rows are of two conversations that share their first 300 turns, one of them repeats itself."""
    long = [(c, t, "user", f"{t % 3 if t < 300 else c + t}") for c in (100, 228) for t in range(700)]
    holds(spark, long + some(60, 2))
    holds(spark, [(3, 1, "user", "same")] * 500 + some(20, 3), 8)


def test_turnless_and_empty(spark):
    few = [(c, 0, "user", "only") for c in range(101, 160)]  # their hundred's first is absent
    assert any(zlib.crc32(str(c).encode()) % 6 for c, *_ in few)
    holds(spark, few)
    assert prefix_trie.prefix_trie(frame(spark, [])).count() == 0
    assert prefix_trie.prefix_trie(frame(spark, [(None, 1, "a", "b")])).count() == 0


def tree(spark, parents, weights):
    depth = {}
    for i in sorted(parents, key=lambda i: -1 if parents[i] is None else parents[i]):
        depth[i] = 0 if parents[i] is None else depth[parents[i]] + 1
    kids = Counter(parents.values())
    return spark.createDataFrame([(i, p, depth[i], kids[i], weights[i]) for i, p in parents.items()], "id long, parent long, depth long, kids long, w long")


@pytest.mark.parametrize("shape", ["chain", "caterpillar", "random", "star", "two roots", "forks of chains"])
def test_contraction(spark, shape):
    r = random.Random(shape)
    n = 400
    parents = {
        "chain": {i: i - 1 if i else None for i in range(n)},
        "caterpillar": {i: None if i == 0 else i - 2 if i % 2 == 0 else i - 1 for i in range(n)},
        "random": {i: r.randrange(i) if i else None for i in range(n)},
        "star": {i: 0 if i else None for i in range(n)},
        "two roots": {i: i - 2 if i > 1 else None for i in range(n)},
        "forks of chains": {i: None if i == 0 else i - 1 if i % 37 else r.randrange(i) for i in range(n)},
    }[shape]
    weights = {i: r.randrange(100) for i in range(n)}
    want = dict(weights)
    for i in range(n - 1, 0, -1):
        if parents[i] is not None:
            want[parents[i]] += want[i]
    got = {row.id: row.w for row in prefix_trie.subtree_totals(tree(spark, parents, weights), ["w"]).collect()}
    assert got == want


def test_chains_take_few_rounds(spark, monkeypatch):
    written = []
    put = prefix_trie.put
    monkeypatch.setattr(prefix_trie, "put", lambda df, name: written.append(name) or put(df, name))
    n = 1024
    chain = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.col("id").alias("depth"), (F.col("id") < n - 1).cast("long").alias("kids"), F.lit(1).cast("long").alias("w"))
    assert {r.id: r.w for r in prefix_trie.subtree_totals(chain, ["w"]).collect()} == {i: n - i for i in range(n)}
    assert written.count("trie-raked") <= 14


def test_hot_ends_are_hashed_in_order(spark):
    ends = spark.range(25_000).select(F.col("id").alias("conv_id"), F.when(F.col("id") % 3 == 0, F.lit(b"hot")).otherwise(F.col("id").cast("string").cast("binary")).alias("after")).repartition(7)
    got = {bytes(r.after): r.ends_sha256 for r in prefix_trie.ends_digest(ends).collect()}
    assert got[b"hot"] == hashlib.sha256(",".join(map(str, range(0, 25_000, 3))).encode()).hexdigest()
    assert got[b"16000"] == hashlib.sha256(b"16000").hexdigest() and len(got) == 25_000 - 25_000 // 3
