"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles becomes 128 registers: each is the truncated logarithm of a
minimum of exponential hashes, so registers of unions are maxima of registers, and two registers
agree with about the probability of the Jaccard similarity. Bands of four registers make
candidates, a joint maximum-likelihood estimate over all registers and both set sizes drops the
hopeless ones with a margin of five standard deviations, and the rest is confirmed on full sets.

Nothing here pairs up a large group:

* equal sets collapse into one class before banding;
* each member of a bucket first meets the bucket's pivot only, the member that shares most buckets
  with others, so candidates follow the members;
* where that leaves a bucket in several components, members of different components meet: all of
  them in a small bucket; in large ones, documents are joined on the rarest shingles of their full
  sets, of which two sets of the wanted similarity always share one. So no link that a bucket holds
  is lost, and only links inside a component stay unexamined.

Defined cases: a null or empty text, or one without words, has an empty set and stays alone; fewer
words than a shingle has make one shingle; rows that share a doc_id are one document that has the
links of each; a null doc_id stays alone with a null component and is kept; ties in doc_id can't
change the component, which is a minimum; a very long text is one set, made whole in one task, in
memory that follows its length; an empty table gives no rows; other columns are not read, and
keep_one_each() returns them whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import WordHashes, slices, stored, texts_of, window_hashes, without
from tablewright.llm.components import components
from tablewright.runtime import ship_package

BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: The sketch: base of the exponential spacing, rate of the hashes, highest register value.
BASE, RATE, TOP = 1.001, 20.0, 65535
#: Members of a bucket that may meet one by one; shingles whose frequency tasks know, at most.
SMALL, RANKED = 24, 1_000_000
MARGIN = 0.2

_random = np.random.default_rng(20240229)
_FACTOR = _random.integers(1, 2**63, REGISTERS, dtype=np.uint64) | np.uint64(1)
_SHIFT = _random.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_words = WordHashes()


def shingle_set(text: str, width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of ``width`` words."""
    return np.unique(window_hashes(_words.of(text.encode("utf-8").lower().split()), width))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers, one row for each non-empty set: floor(1 - log_BASE(minimum)) of
    exponential hashes, truncated.

    The minimum of exponentials is taken on the uniform hashes they grow with.
    """
    least = np.empty((len(sets), REGISTERS), np.uint64)
    start = 0
    while start < len(sets):  # some thousand shingles at a time stay in the processor's cache
        end, held = start + 1, len(sets[start])
        while end < len(sets) and held + len(sets[end]) <= 8192:
            held += len(sets[end])
            end += 1
        flat = np.concatenate(sets[start:end])
        cuts = np.cumsum([0, *(len(s) for s in sets[start : end - 1])])
        for i in range(REGISTERS):
            least[start:end, i] = np.minimum.reduceat(flat * _FACTOR[i] + _SHIFT[i], cuts)
        start = end
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-uniform) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def jaccard_estimate(u: np.ndarray, v: np.ndarray, nu: np.ndarray, nv: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood estimates from register matrices and set sizes, on a grid of 1/64."""
    more, less = (u > v).sum(axis=1), (u < v).sum(axis=1)
    same = u.shape[1] - more - less
    share = nu / (nu + nv)
    grid = np.arange(65) / 64
    p = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)
    above = p(share[:, None] - (1 - share)[:, None] * grid)
    below = p((1 - share)[:, None] - share[:, None] * grid)
    equal = np.clip(1 - above - below, 1e-9, 1)
    likelihood = more[:, None] * np.log(above) + less[:, None] * np.log(below) + same[:, None] * np.log(equal)
    return grid[likelihood.argmax(axis=1)]


def sketches(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, signature (of the whole set), registers, bands (32 bucket keys)."""

    def sketched(records):
        for record in (part for r in records for part in slices(r)):
            sets = [shingle_set(text, width) for text in record.column("text").to_pylist()]
            found = iter(registers([s for s in sets if len(s)]))
            rows: list[tuple] = []
            for own in sets:
                if not len(own):
                    rows.append((0, None, None, None))
                    continue
                row = next(found)
                keys = [xxhash.xxh3_64_intdigest(row[b * ROWS : (b + 1) * ROWS].tobytes(), b) - (1 << 63) for b in range(BANDS)]
                rows.append((len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest(), row.tobytes(), keys))
            types = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([record.column("doc_id"), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], names=["doc_id", "n_shingles", "signature", "registers", "bands"])

    return texts_of(docs).mapInArrow(sketched, "doc_id long, n_shingles long, signature binary, registers binary, bands array<long>")


def hopeful(pairs: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """(a, b, estimate) of the pairs whose sizes and registers leave the threshold possible."""
    side = sketch.select("doc_id", "n_shingles", "registers")
    joined = pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
    joined = joined.where(F.least("na", "nb") >= threshold * F.greatest("na", "nb"))

    def estimated(records):
        for record in records:
            if record.num_rows:
                u, v = (np.frombuffer(b"".join(record.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
                j = jaccard_estimate(u, v, record.column("na").to_numpy().astype(float), record.column("nb").to_numpy().astype(float))
                hit = pa.array(np.flatnonzero(j >= threshold - MARGIN))
                yield pa.RecordBatch.from_arrays([record.column("a").take(hit), record.column("b").take(hit), pa.array(j).take(hit)], names=["a", "b", "estimate"])

    return joined.mapInArrow(estimated, "a long, b long, estimate double")


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on the full sets."""
    text = texts_of(docs)
    joined = pairs.select("a", "b").join(text.toDF("a", "ta"), "a").join(text.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")

    def linked(records):
        sets = lru_cache(64)(lambda t: shingle_set(t, width))
        for record in records:
            hits = []
            for i, (s, t) in enumerate(zip(record.column("ta").to_pylist(), record.column("tb").to_pylist(), strict=True)):
                x, y = sets(s), sets(t)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    hits.append(i)
            keep = pa.array(hits, pa.int64())
            yield pa.RecordBatch.from_arrays([record.column("a").take(keep), record.column("b").take(keep)], names=["a", "b"])

    return joined.mapInArrow(linked, "a long, b long").distinct()


def in_order(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("x") != F.col("y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def pivot_pairs(members: DataFrame) -> DataFrame:
    """Candidate pairs (a, b): each of the members (key, n, doc, score) with its bucket's pivot."""
    pivots = members.groupBy("key").agg(F.max_by("doc", F.struct("score", -F.col("doc"))).alias("y"))
    return in_order(members.join(stored(pivots, "near-pivots"), "key").select(F.col("doc").alias("x"), "y"))


def mixed_members(members: DataFrame) -> DataFrame:
    """The members (key, n, doc, c) of buckets that hold several components c."""
    mixed = members.groupBy("key").agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least < most").select("key")
    return members.join(stored(mixed, "near-mixed"), "key")


def small_pairs(mixed: DataFrame) -> DataFrame:
    """All pairs (a, b) of different components in the buckets of ``SMALL`` members at most."""
    small = mixed.where(F.col("n") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("doc", "c"))).alias("own"))
    later = F.filter(F.slice("own", F.col("i") + 2, SMALL), lambda y: y["c"] != F.col("one.c"))
    pairs = small.select("own", F.posexplode("own").alias("i", "one")).select("one", F.explode(later).alias("other"))
    return in_order(pairs.select(F.col("one.doc").alias("x"), F.col("other.doc").alias("y")))


def rarest_pairs(large: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """All pairs (a, b) of different components that can reach ``percent``, among the members
    (key, n, doc, c) of large buckets that hold several components.

    Sets are put in one order, rarest shingles first: by the number of sets that hold a shingle where
    it is among the ``RANKED`` most frequent ones, at most, and then by hash. A smaller set that
    reaches the threshold with a larger one shares a shingle among its first
    n - 2p / (100 + p) * n + 1, which is among the larger one's first n - p / 100 * n + 1; the first
    one shared leaves enough behind it on both sides, in any order that is the same for all sets.
    Members of a shingle's main component do not meet each other; a frequent shingle is dealt to
    several tasks.
    """
    open_docs = stored(large.where(F.col("n") > SMALL).select("doc", "c").distinct(), "near-open")

    def shingled(records):
        for record in (part for r in records for part in slices(r)):
            sets = [shingle_set(text, width) for text in record.column("text").to_pylist()]
            own = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([record.column("doc"), record.column("c"), own, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc", "c", "own", "shingles"])

    texts = texts_of(docs).join(open_docs, F.col("doc_id") == F.col("doc")).select("doc", "c", "text")
    # rows that share a doc_id are sets of their own
    sets = stored(texts.mapInArrow(shingled, "doc long, c long, own binary, shingles array<long>").dropDuplicates(["doc", "own"]), "near-sets")
    least = max(2, (sets.agg(F.sum(F.size("shingles")).alias("n")).first().n or 0) // RANKED)  # so many sets hold RANKED shingles at most
    counts = sets.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("held")).where(F.col("held") >= least)
    frequent = counts.toArrow().sort_by("shingle")
    sent = docs.sparkSession.sparkContext.broadcast(tuple(frequent.column(c).to_numpy() for c in ("shingle", "held")))

    def first_ones(records):
        known, held = sent.value
        for record in records:
            parts: list[list] = [[] for _ in range(7)]
            for doc, c, own in zip(record.column("doc").to_pylist(), record.column("c").to_pylist(), record.column("shingles"), strict=True):
                own = np.asarray(own.values)
                n = len(own)
                at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
                often = np.where(known[at] == own, held[at], 0) if len(known) else np.zeros(n, np.int64)
                order = np.lexsort((own, often))[: n - -(-percent * n // 100) + 1]
                at = np.arange(len(order))
                for part, x in zip(parts, (own[order], often[order], np.full(len(order), doc), np.full(len(order), c), np.full(len(order), n), at, at <= n - -(-2 * percent * n // (100 + percent))), strict=True):
                    part.append(x)
            if parts[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in parts], names=["shingle", "held", "doc", "c", "n", "at", "short"])

    prefix = stored(sets.mapInArrow(first_ones, "shingle long, held long, doc long, c long, n long, at long, short boolean"), "near-prefix")

    sizes = prefix.groupBy("shingle", "c").agg(F.count("*").alias("size"))
    main = sizes.groupBy("shingle").agg(F.max_by("c", F.struct("size", "c")).alias("main"), F.count("*").alias("several")).where("several > 1")
    prefix = stored(prefix.join(stored(main.select("shingle", "main"), "near-mains"), "shingle").withColumn("salts", F.expr("1 + held div 512")), "near-prefix")
    side = lambda df, end: df.select("shingle", "salt", *(F.col(c).alias(c + end) for c in ("doc", "c", "n", "at", "short")))
    x = side(prefix.where(F.col("c") != F.col("main")).withColumn("salt", F.explode(F.expr("sequence(0L, salts - 1)"))), "1")
    y = side(prefix.withColumn("salt", F.pmod(F.xxhash64("doc"), F.col("salts"))), "2")
    fits = F.expr(
        f"c1 <> c2 AND 100 * least(n1, n2) >= {percent} * greatest(n1, n2) AND {100 + percent} * least(n1 - at1, n2 - at2) >= {percent} * (n1 + n2)"
        " AND CASE WHEN n1 < n2 THEN short1 WHEN n2 < n1 THEN short2 ELSE short1 AND short2 END"
    )
    return in_order(x.join(y, ["shingle", "salt"]).where(fits).select(F.col("doc1").alias("x"), F.col("doc2").alias("y")))


def labelled(rows: DataFrame, label: DataFrame, column: str, into: str) -> DataFrame:
    """``rows`` with the component of ``column`` (itself where no link is known)."""
    known = label.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    return rows.join(known, F.col(column) == F.col("_node"), "left").withColumn(into, F.coalesce("_component", column)).drop("_node", "_component")


def apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """``pairs`` of different components, with these as ca and cb."""
    return labelled(labelled(pairs, label, "a", "ca"), label, "b", "cb").where(F.col("ca") != F.col("cb"))


def best_of_each(pairs: DataFrame) -> DataFrame:
    """The most promising pair of each end of the pairs (a, b, estimate)."""
    ends = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "estimate").union(pairs.select("b", "a", "estimate"))
    return in_order(ends.groupBy("x").agg(F.max_by("y", F.struct("estimate", -F.col("y"))).alias("y")).select("x", "y"))


def near_duplicates(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id is it)."""
    ship_package(docs.sparkSession)
    sketch = stored(sketches(docs, width), "near-sketches")
    known = sketch.where("signature is not null and doc_id is not null")
    classes = stored(known.groupBy("signature").agg(F.min("doc_id").alias("rep")), "near-classes")
    same = known.select("doc_id", "signature").join(classes, "signature").where(F.col("doc_id") != F.col("rep")).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reps = stored(known.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", "n_shingles", "registers", "bands"), "near-reps")

    rows = reps.select(F.col("doc_id").alias("doc"), F.explode("bands").alias("key")).distinct()
    buckets = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(rows.join(stored(buckets, "near-buckets"), "key"), "near-members")
    score = stored(members.groupBy("doc").agg(F.sum("n").alias("score")), "near-scores")
    pairs = hopeful(pivot_pairs(members.join(score, "doc")), reps, percent / 100)
    links = stored(confirmed(pairs, docs, percent, width), "near-links")
    label = components(links)

    mixed = stored(mixed_members(labelled(members, label, "doc", "c")), "near-mixed-members")
    rest = small_pairs(mixed).union(rarest_pairs(mixed, docs, percent, width)).distinct()
    rest = stored(hopeful(rest, reps, percent / 100), "near-rest")
    for pick in (best_of_each, lambda pairs: pairs):  # once components have grown, fewer pairs are left
        more = stored(confirmed(pick(rest), docs, percent, width), "near-links")
        label = joined_up(label, more)
        rest = stored(apart(rest, label).select("a", "b", "estimate"), "near-apart")

    label = joined_up(label, same)
    out = labelled(sketch.select("doc_id", "n_shingles"), label, "doc_id", "component_id")
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def joined_up(label: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``label`` after more links (a, b): only components and new links are looked at."""
    over = components(apart(links, label).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    nodes = label.select("node").union(ends).distinct()
    now = labelled(labelled(nodes, label, "node", "c"), over, "c", "component")
    return stored(now.select("node", "component"), "near-components")


def keep_one_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component; null doc_ids stay."""
    return without(docs, near_duplicates(docs, **how).where(~F.col("kept")), "near-dropped")
