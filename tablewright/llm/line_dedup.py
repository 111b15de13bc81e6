"""Line deduplication with a once-seen and a twice-seen Bloom filter.

Pass one hashes every line's key into two filters in each task and merges them. Pass two shuffles
only keys that the twice-seen filter suspects, as 128-bit digests, to count their documents
exactly and choose the one that keeps them. Pass three drops lines.

Defined cases: a null or empty text is one empty line; each row counts as a document, so two rows
with one doc_id count twice, and what that doc_id loses both lose; a null doc_id never wins over
another one; ties are impossible as the largest doc_id wins; a very long text is split whole in one
task, in memory that follows its length; an empty table gives no rows; columns other than doc_id and
text pass through untouched, whatever their names, but columns n_lines and n_dropped of the caller's
give way to the result's own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import bloom
from tablewright.llm.common import BLANKS, batch, stored, texts_of
from tablewright.runtime import ship_package

SUSPECT = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])


def keys_of(text: str, min_chars: int) -> list[bytes]:
    """The keys of a text's lines, in order; b"" for a line below ``min_chars``."""
    keys = (line.strip(BLANKS) for line in text.split("\n"))
    return [k.encode("utf-8", "surrogatepass").lower() if len(k) >= min_chars else b"" for k in keys]


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, max_filter_bits: int = 1 << 30) -> DataFrame:
    """(doc_id, keys): the digests of the line keys that each document loses.

    ``max_filter_bits`` bounds the broadcast filter (128 MB by default); beyond it more keys are
    suspected and shuffled, and the result is the same.
    """
    spark, docs = docs.sparkSession, texts_of(docs)
    ship_package(spark)
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    bits = bloom.bits_for(size // 64, most=max_filter_bits)

    def hashes(text: str) -> set[bytes]:
        found = set(keys_of(text, min_chars))
        found.discard(b"")
        return found

    def seen(records):
        filters = bloom.Seen(bits)
        for record in records:
            found = [xxhash.xxh3_64_intdigest(k) for t in record.column("text") for k in hashes(t.as_py())]
            filters.add(np.array(found, np.uint64))
        yield filters.record(TaskContext.get().partitionId())

    twice = spark.sparkContext.broadcast(bloom.merge(docs.select("text").mapInArrow(seen, bloom.ROWS), bits))

    def suspects(records):
        for record in records:
            ids, keys = [], []
            for doc_id, text in zip(record.column("doc_id").to_pylist(), record.column("text").to_pylist(), strict=True):
                own = hashes(text)
                ids += [doc_id] * len(own)
                keys += own
            if keys:
                hit = np.flatnonzero(bloom.holds(twice.value, np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)))
                yield batch({"doc_id": [ids[i] for i in hit], "key": [digest(keys[i]) for i in hit]}, SUSPECT)

    held = stored(docs.mapInArrow(suspects, "doc_id long, key binary"), "line-suspects")
    owner = held.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("owner")).where(F.col("n") >= min_docs)
    owner = stored(owner.select("key", "owner"), "line-owners")
    lost = held.join(owner, "key").where(~F.col("doc_id").eqNullSafe(F.col("owner")))
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the text that is left, and n_lines (before) and n_dropped."""
    ship_package(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    names = [f"c{i}" for i in range(len(others))]  # on the way, no name of the caller's can clash with ours
    lost = repeated_lines(docs, min_chars, min_docs).select(F.col("doc_id").alias("lost_id"), F.col("keys").alias("lost"))
    plain = docs.select(*(docs[f"`{c}`"].alias(n) for c, n in zip(others, names, strict=True)), F.coalesce("text", F.lit("")).alias("text"))
    joined = plain.join(lost, F.col(names[others.index("doc_id")]).cast("long").eqNullSafe(F.col("lost_id")), "left").select(*names, "text", "lost")
    schema = joined.drop("lost").withColumns({"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}).schema

    def kept(records):
        for record in records:
            texts, lines, dropped = [], [], []
            for text, lost in zip(record.column("text").to_pylist(), record.column("lost").to_pylist(), strict=True):
                own = text.split("\n")
                lines.append(len(own))
                if lost:
                    lost = set(lost)
                    own = [line for line, key in zip(own, keys_of(text, min_chars), strict=True) if not key or digest(key) not in lost]
                texts.append("\n".join(own))
                dropped.append(lines[-1] - len(own))
            columns = [record.column(n) for n in names] + [pa.array(texts, record.schema.field("text").type), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "text", "n_lines", "n_dropped"])

    return joined.mapInArrow(kept, schema).toDF(*others, "text", "n_lines", "n_dropped")
