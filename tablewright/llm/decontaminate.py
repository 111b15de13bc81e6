"""Benchmark decontamination by template canonicalisation.

Words become templates: numbers, units and names (words with a capital, wherever they stand) turn
into typed placeholders, other words lose case and outer punctuation. Windows of eight template words
are hashed on both sides and joined; windows with names are also hashed with the names as they are,
so that a copy in other case is found. A Bloom filter of the benchmark's windows, of a bounded
size, lets only suspects leave the map side; a document meets an item by one of the windows that
fewest items hold, so windows that many items share make no pairs. For each document and item,
the values that stand in the placeholders are lined up: a re-parameterised question replaces each
value of the item by one value throughout, so windows whose slots contradict the majority are not
counted. Slots are settled in the whole document and in each occurrence, as far as hits of about
one shift tell occurrences apart. A document is contaminated where the counted windows cover
enough of an item.

Defined cases: a null or empty text on either side has no windows; an item shorter than a window
is one window of its length; a very long text is looked at whole, in one task, in memory that
follows its length; rows that share a doc_id or item_id count together; null ids match nothing;
ties between slot values go to the smaller text; an empty benchmark or table finds nothing; other
columns are not read, and keep_clean() returns them whatever their names.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm import bloom
from tablewright.llm.common import looked_up, mixed, slices, stored, texts_of, window_hashes, without
from tablewright.runtime import ship_package

WINDOW = 8
#: Common units of measure and money, as written after a number.
UNITS = frozenset("mm cm m km in ft yd mi g kg mg lb oz t ml l cl s sec min h hr hrs day days week weeks month months year years mph kmh km/h m/s % ° °c °f c f usd eur gbp $ € £ dollars euros pounds cents percent meters metres kilometers kilometres miles feet inches hours minutes seconds grams kilograms liters litres".split())
_OUTER = re.compile(r"^[^\w%$€£°]+|[^\w%$€£°]+$")
_NUMBER = re.compile(r"[-+$€£]?\d[\d.,:/]*(?:st|nd|rd|th)?(%|°?[a-zA-Z/%°]{0,4})")


class Templates(dict):
    """word (as bytes) -> its number, by which ``hashes`` has template hashes, ``plain`` those with names
    as they are, and ``slots`` (placeholder, value) or None.

    ``forget`` empties it between texts once it holds more than ``limit`` words.
    """

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit, self.slots = limit, []
        self.hashes, self.plain = np.zeros((2, 1 << 16), np.uint64)

    def __missing__(self, word: bytes) -> int:
        bare = _OUTER.sub("", word.decode("utf-8", "surrogatepass"))
        lower, kind = bare.lower(), None
        if _NUMBER.fullmatch(bare):
            kind = "<number>"
        elif lower in UNITS:
            kind = "<unit>"
        elif bare[:1].isupper() and (len(bare) == 1 or not bare.isupper()):
            kind = "<name>"
        as_is = lower.encode("utf-8", "surrogatepass") or word
        code = self[word] = len(self.slots)
        if code == len(self.hashes):
            self.hashes, self.plain = np.concatenate([(self.hashes, self.plain), np.zeros((2, code), np.uint64)], axis=1)
        self.hashes[code] = xxhash.xxh3_64_intdigest(kind or as_is)
        self.plain[code] = xxhash.xxh3_64_intdigest(as_is if kind in (None, "<name>") else kind)
        self.slots.append((kind, lower) if kind else None)
        return code

    def forget(self) -> None:
        if len(self.slots) > self.limit:
            self.clear()
            self.slots.clear()


_templates = Templates()


def coded(text: str) -> np.ndarray:
    """The numbers of a text's words in ``_templates``, valid until it forgets."""
    words = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(_templates.__getitem__, words), np.int64, len(words))


# functions of this module, so that tasks use its one table: a name that a task's own function
# mentions would travel with it as a copy
def forget_some() -> None:
    _templates.forget()


def digest_of(text: str) -> bytes:
    """128 bits of all that windows of the text can tell."""
    forget_some()
    codes = coded(text)
    return xxhash.xxh3_128_digest(_templates.hashes[codes].tobytes() + _templates.plain[codes].tobytes() + slots_of(codes).encode())


def slots_of(codes: np.ndarray, names: bool = True) -> str:
    """The slot values of words as JSON text, null where a word is not in a slot."""
    found = (_templates.slots[c] for c in codes)
    return json.dumps([f[1] if f and (names or f[0] != "<name>") else None for f in found])


def hashed(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all windows of ``width`` words: with names as placeholders, and as they are."""
    return tuple(mixed(window_hashes(h[codes], width) + np.uint64(width)) for h in (_templates.hashes, _templates.plain))


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW, share: float = 0.5) -> DataFrame:
    """item_id, n_windows, hash, position and slots of every window of the items, and lead.

    Of an item's windows ``share`` must be found, so a match has at least one of its ``lead``
    windows: those that fewest items hold, as many as may be missing and one more.
    """

    def cut(records):
        for record in records:
            rows = []
            for item, text in zip(record.column("doc_id").to_pylist(), record.column("text").to_pylist(), strict=True):
                forget_some()
                codes = coded(text)
                own = min(width, len(codes))
                typed, plain = hashed(codes, own) if own else (codes, codes)
                for i in range(len(typed)):
                    for names, h in {False: plain[i], typed[i] != plain[i]: typed[i]}.items():
                        rows.append((item, len(typed), int(h.astype(np.int64)), i, own, slots_of(codes[i : i + own], bool(names))))
            types = (*[pa.int64()] * 5, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["item_id", "n_windows", "hash", "at", "width", "item_slots"])

    items = texts_of(benchmark.select(F.col("item_id").alias("doc_id"), "text")).where("doc_id is not null")
    rows = stored(items.mapInArrow(cut, "item_id long, n_windows long, hash long, at long, width long, item_slots string"), "benchmark-windows")
    held = rows.groupBy("hash").agg(F.count_distinct("item_id").alias("held"))
    most = F.max("held").over(Window.partitionBy("item_id", "at"))
    rarest = Window.partitionBy("item_id").orderBy("most", "at")  # a group is one item's text
    ranked = rows.join(held, "hash").withColumn("most", most).withColumn("rank", F.dense_rank().over(rarest))
    return ranked.withColumn("lead", F.col("rank") <= F.col("n_windows") - F.ceil(F.col("n_windows") * share) + 1).drop("held", "most", "rank")


def item_classes(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """item_id and class_id, a number for all items with the same words, slots included; and class_id
    and text, one of each class. Items of a class have the same windows, so one text stands for all;
    an item_id with several texts is in several classes."""

    def digests(records):
        for record in (part for r in records for part in slices(r)):
            out = []
            for text in record.column("text").to_pylist():
                out.append(digest_of(text))
            yield pa.RecordBatch.from_arrays([*record.columns, pa.array(out, pa.binary())], names=["doc_id", "text", "digest"])

    items = texts_of(benchmark.select(F.col("item_id").alias("doc_id"), "text")).where("doc_id is not null")
    rows = stored(items.mapInArrow(digests, "doc_id long, text string, digest binary"), "benchmark-digests")
    classes = rows.groupBy("digest").agg(F.first("text").alias("text"), F.count("*").alias("n"))
    classes = stored(classes.withColumn("class_id", F.monotonically_increasing_id()), "benchmark-classes")
    members = looked_up(rows.select(F.col("doc_id").alias("item_id"), "digest"), classes.select("digest", "class_id", "n"), "digest", "n")
    return members.select("item_id", "class_id").distinct(), classes.select("class_id", "text")


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, share: float = 0.5, max_filter_bits: int = 1 << 30) -> DataFrame:
    """doc_id, item_id, n_windows of the item, n_found with consistent slots: contaminated pairs.

    ``share`` of an item's windows must be found; ``max_filter_bits`` bounds the broadcast filter.
    """
    found, members = class_matches(docs, benchmark, width, share, max_filter_bits)
    return found.join(members, "class_id").select("doc_id", "item_id", "n_windows", "n_found")


def class_matches(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, share: float = 0.5, max_filter_bits: int = 1 << 30) -> tuple[DataFrame, DataFrame]:
    """doc_id, class_id, n_windows and n_found, and the members (item_id) of the classes: rows grow with
    the documents and the items, however often an item is repeated."""
    spark = docs.sparkSession
    ship_package(spark)
    members, classes = item_classes(benchmark)
    items = stored(benchmark_windows(classes.withColumnRenamed("class_id", "item_id"), width, share), "benchmark-ranked")
    lengths = sorted(row.width for row in items.select("width").distinct().collect())  # at most ``width`` rows
    bits = bloom.bits_for(items.count(), 16, max_filter_bits)

    def seen(records):
        filters = bloom.Seen(bits)
        for record in records:
            filters.add(np.repeat(record.column("hash").to_numpy().astype(np.uint64), 2))  # seen twice: the filter that merge() gives
        yield filters.record(TaskContext.get().partitionId())

    known = spark.sparkContext.broadcast(bloom.merge(items.select("hash").mapInArrow(seen, bloom.ROWS), bits))

    def suspects(records):
        for record in (part for r in records for part in slices(r)):
            rows = []
            forget_some()
            found = [coded(text) for text in record.column("text").to_pylist()]
            codes = np.concatenate([np.zeros(0, np.int64), *found])
            ends = np.cumsum([len(f) for f in found])
            for own in lengths:
                if len(codes) < own:
                    continue
                typed, plain = hashed(codes, own)
                for names, hashes, some in ((True, typed, np.flatnonzero(typed != plain)), (False, plain, np.arange(len(plain)))):
                    for i in some[bloom.holds(known.value, hashes[some])].tolist():
                        k = int(np.searchsorted(ends, i, "right"))
                        if i + own <= ends[k]:  # else it goes over the end of a text
                            rows.append((k, int(hashes[i].astype(np.int64)), i - int(ends[k] - len(found[k])), slots_of(codes[i : i + own], names)))
            ids = record.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[i] for r in rows], t) for i, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.string())))], names=["doc_id", "hash", "pos", "doc_slots"])

    suspect = stored(texts_of(docs).where("doc_id is not null").mapInArrow(suspects, "doc_id long, hash long, pos long, doc_slots string"), "benchmark-suspects")
    # pairs come from the items' rarest windows; windows that many items hold only count in them
    leads = suspect.join(items.where("lead"), "hash").select("doc_id", "item_id").distinct()
    pairs = stored(suspect.join(stored(leads, "benchmark-pairs"), "doc_id").join(items.drop("lead"), ["item_id", "hash"]), "benchmark-hits")

    # slots are settled within the document and within the hits of about one shift (two grids, so
    # that no occurrence is cut by both): the best of them counts
    grids = F.array(F.struct(F.lit(0).alias("grid"), F.lit(0).cast("long").alias("cell")), *(F.struct(F.lit(g).alias("grid"), F.floor((F.col("pos") - F.col("at") + add) / 16).alias("cell")) for g, add in ((1, 0), (2, 8))))
    pairs = pairs.withColumn("g", F.explode(grids)).select("*", "g.grid", "g.cell").drop("g")
    place = ["doc_id", "item_id", "grid", "cell"]
    hit = [*place, "at", "pos", "hash"]
    # the value that most often stands for an item's value is the one that counts
    slots = pairs.select(*hit, F.explode(F.arrays_zip(F.from_json("item_slots", "array<string>").alias("v"), F.from_json("doc_slots", "array<string>").alias("w"))).alias("s")).where("s.v is not null").select(*hit, "s.v", "s.w")
    votes = slots.groupBy(*place, "v", "w").agg(F.count("*").alias("n"))
    chosen = votes.groupBy(*place, "v").agg(F.min_by("w", F.struct(-F.col("n"), "w")).alias("chosen"))
    broken = slots.join(chosen, [*place, "v"]).where(F.col("w") != F.col("chosen")).select(*hit).distinct()
    counted = pairs.join(broken, hit, "left_anti")
    found = counted.groupBy(*place, "n_windows").agg(F.count_distinct("at").alias("n")).groupBy("doc_id", "item_id", "n_windows").agg(F.max("n").alias("n_found"))
    return found.where(F.col("n_found") >= share * F.col("n_windows")).withColumnRenamed("item_id", "class_id"), stored(members, "benchmark-members")


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per contaminated document: doc_id, item_ids (ascending), n_found (most windows of one item)."""
    found = matches(docs, benchmark, **how)
    return found.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("n_found").alias("n_found"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` without contaminated documents; rows with a null doc_id stay."""
    return without(docs, contaminated(docs, benchmark, **how), "benchmark-leaks")
