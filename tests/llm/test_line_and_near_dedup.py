import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tablewright.llm import bloom, decontaminate, line_dedup, near_dedup, quality
from tablewright.llm.components import components
from tests.llm.data import WORD, edited, frame, odd_documents, prose, words

BLANKS = " \t\n\x0b\x0c\r"


def lower(s):
    return s.encode().lower().decode()


def brute_lines(rows):
    held = defaultdict(list)
    for i, t in rows:
        for k in {lower(x.strip(BLANKS)) for x in (t or "").split("\n")}:
            held[k].append(i)
    owner = {k: max((i for i in v if i is not None), default=None) for k, v in held.items() if len(k) >= 20 and len(v) >= 3}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if (k := lower(x.strip(BLANKS))) not in owner or owner[k] == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def lines_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()), key=str)


def test_lines_against_brute_force(spark):
    rows = [*odd_documents().items(), (10, odd_documents()[10]), (None, odd_documents()[10])]
    out = line_dedup.drop_repeated_lines(frame(spark, rows))
    assert lines_of(out) == brute_lines(rows)
    assert {"lang", "key", "segment"} <= set(out.columns)


def test_lines_with_a_full_filter(spark):
    """A filter far too small suspects everything and changes nothing."""
    rows = list(odd_documents().items())
    docs = frame(spark, rows, extra=False)
    small = line_dedup.repeated_lines(docs, max_filter_bits=1 << 10)
    assert sorted((r.doc_id, sorted(map(bytes, r["keys"]))) for r in small.collect()) == sorted((r.doc_id, sorted(map(bytes, r["keys"]))) for r in line_dedup.repeated_lines(docs).collect())


def test_lines_empty(spark):
    assert line_dedup.drop_repeated_lines(frame(spark, {}).limit(0)).count() == 0


def test_bloom_merge():
    a, b = bloom.Seen(1 << 12), bloom.Seen(1 << 12)
    x = np.arange(1, 60, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a.add(x[:30])
    b.add(x[20:])
    assert bloom.holds(a.once, x[:30]).all() and not bloom.holds(a.twice, x[:30]).any()
    both = a.twice | b.twice | (a.once & b.once)
    assert bloom.holds(both, x[20:30]).all()


def shingles(t):
    w = WORD.findall(lower(t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_near(rows, percent=75):
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=str)


def near_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_near_against_brute_force(spark):
    texts = odd_documents()
    base = prose(150, 77)
    texts |= {200 + i: edited(base, 25 + i, i) for i in range(12)}  # some pairs on either side of the threshold
    rows = [*texts.items(), (5, texts[5]), (None, texts[5]), (None, None)]
    assert near_of(near_dedup.near_duplicates(frame(spark, rows))) == brute_near(rows)


def test_large_near_group(spark):
    """Copies that are linked to a base in the middle, and barely to each other."""
    base = prose(300, 5)
    rows = [(i, base if i == 50 else edited(base, 34 + i % 3, i)) for i in range(90)] + [(500 + i, prose(100, 900 + i)) for i in range(20)]
    got = near_of(near_dedup.near_duplicates(frame(spark, rows, extra=False)))
    assert got == brute_near(rows)


def family(n, base_words, slots, own, shared):
    """``n`` texts of one template, in twin pairs: ``own`` replaced words each, ``shared`` of them with the twin."""
    base, rows = words(base_words, 31), []
    for i in range(n):
        twin, single = random.Random(i // 2), random.Random(1000 + i)
        both = {10 * k + 5: f"both{i // 2}at{k}" for k in twin.sample(range(slots), shared)}
        alone = {10 * k + 5: f"new{i}at{k}" for k in single.sample([k for k in range(slots) if 10 * k + 5 not in both], own - shared)}
        rows.append((i, " ".join((both | alone).get(k, w) for k, w in enumerate(base))))
    return rows


def test_pairs_inside_a_large_family(spark):
    """Twin pairs above the threshold among texts that are all a little below it."""
    rows = family(300, 400, 39, 9, 4)
    want = brute_near(rows)
    assert sum(not kept for *_, kept in want) > 100 and len({c for _, _, c, _ in want}) > 20
    assert near_of(near_dedup.near_duplicates(frame(spark, rows, extra=False))) == want


def test_pairs_inside_large_buckets(spark, monkeypatch):
    """All pairs come from the join on rare shingles where no bucket counts as small."""
    monkeypatch.setattr(near_dedup, "SMALL", 1)
    rows = family(120, 150, 14, 4, 2) + [(900 + i, prose(60, 900 + i)) for i in range(20)]
    assert near_of(near_dedup.near_duplicates(frame(spark, rows, extra=False))) == brute_near(rows)


def test_other_columns_with_any_name(spark):
    """Columns that are named like this package's own ones, or with a dot, come back untouched."""
    texts = odd_documents()
    extra = ["_out", "_lost", "_lost_id", "a.b", "_node", "component", "n_lines", "key"]
    docs = frame(spark, texts)
    clash = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(extra) if c not in docs.columns))
    bench = spark.createDataFrame([(0, texts[13])], "item_id long, text string")
    for kept in (near_dedup.keep_one_each(clash), line_dedup.drop_repeated_lines(clash), decontaminate.keep_clean(clash, bench), quality.keep_regular(clash)):
        assert {r["a.b"] for r in kept.collect()} == {3}
        assert set(clash.columns) <= set(kept.columns)
    assert {r.n_lines for r in line_dedup.drop_repeated_lines(clash).where("doc_id = 12").collect()} == {9}  # the caller's own give way


def test_near_empty(spark):
    assert near_dedup.near_duplicates(frame(spark, {}).limit(0)).count() == 0
    assert near_of(near_dedup.near_duplicates(frame(spark, {1: None, 2: None}))) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_estimates_are_close():
    r = np.random.default_rng(1)
    sets = [r.integers(0, 2**63, 600, dtype=np.uint64) for _ in range(2)]
    for shared in (100, 300, 500):
        a, b = np.unique(sets[0]), np.unique(np.concatenate([sets[0][:shared], sets[1][shared:]]))
        u = near_dedup.registers([a, b])
        true = shared / (1200 - shared)
        assert abs(near_dedup.jaccard_estimate(u[:1], u[1:], np.array([600.0]), np.array([600.0]))[0] - true) < 0.15
    merged = np.maximum(*near_dedup.registers(sets))
    assert (merged == near_dedup.registers([np.concatenate(sets)])[0]).all()


def test_components_of_a_chain(spark):
    edges = spark.range(60).selectExpr("id + 1 AS a", "id AS b").union(spark.createDataFrame([(100, 101)], "a long, b long"))
    found = Counter(r.component for r in components(edges).collect())
    assert found == {0: 61, 100: 2}
    assert components(edges.limit(0)).count() == 0
