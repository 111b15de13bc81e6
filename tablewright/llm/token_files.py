"""Token ids in ORC files: sorted by document, indexed, readable by stripe.

The format: one row per document, ``doc_id`` long, ``ids`` array of int (ORC run-length encodes
the integers), ``start`` long (ids before the document in its file). Files hold ascending,
disjoint doc_id ranges; row indexes and a Bloom filter on doc_id let readers skip stripes and row
groups, and every stripe is a split of its own. Beside them, ``<path>.counts`` (Parquet) holds a row
for each file: its name, number of ids and smallest doc_id, so that a reader of a few documents
reads their stripes and this table only.

Defined cases: a null or empty text is only the end id; a null doc_id sorts first; rows with one
doc_id are all kept, ordered by text; a very long text is encoded whole in one task, in memory that
follows its length; an empty table makes an empty table; other columns are not written.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import new_path, slices, texts_of
from tablewright.llm.pretokens import encoder, vocabulary
from tablewright.runtime import ship_package

SCHEMA = "doc_id long, start long, ids array<int>"


def write_tokens(docs: DataFrame, path: str, vocab: str = "word_bpe_49k.json", end_id: int = 2, stripe_bytes: int = 64 << 20, row_index_stride: int = 1000) -> None:
    """Encode every text of ``docs``, append ``end_id``, write ``path`` in ascending doc_id order."""
    end = np.array([end_id], "<u4").tobytes()

    def encoded(records):
        ids_of, start = encoder(vocabulary(vocab)), 0
        for record in (part for r in records for part in slices(r)):
            found = [own + end for own in ids_of.encode(record.column("text").to_pylist())]
            sizes = np.array([len(own) // 4 for own in found], np.int64)
            ends = np.cumsum(sizes)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(np.frombuffer(b"".join(found), "<u4").astype(np.int32)))
            yield pa.RecordBatch.from_arrays([record.column("doc_id"), pa.array(start + ends - sizes), ids], names=["doc_id", "start", "ids"])
            start += int(ends[-1])

    ordered = texts_of(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (
        ordered.mapInArrow(encoded, SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", row_index_stride)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )
    files = opened(docs.sparkSession, path)
    files.groupBy("file").agg(F.max(F.col("start") + F.size("ids")).alias("n"), F.min("doc_id").alias("first")).coalesce(1).write.parquet(f"{path}.counts")


def opened(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path).select("*", F.col("_metadata.file_path").alias("file"))


def with_base(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (with file and start in it) of ``path`` with start counted over all files."""
    sums = rows.sparkSession.read.schema("file string, n long, first long").parquet(f"{path}.counts")
    # one row a file, so this window stays small
    order = Window.orderBy(F.col("first").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return rows.join(base, "file").withColumn("start", F.col("base") + F.col("start")).drop("file", "base")


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids. ``doc_ids`` prunes by metadata."""
    files = opened(spark, path)
    rows = files.where(F.col("doc_id").isin(doc_ids)) if doc_ids is not None else files
    return with_base(rows, path)


def token_digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, file, n_tokens and the unsigned crc32 of the ids as little-endian 32-bit integers."""

    def digests(records):
        for record in records:
            ids = record.column("ids")
            ends = np.asarray(ids.offsets)
            flat = np.asarray(ids.values).astype("<u4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([record.column("doc_id"), record.column("start"), record.column("file"), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "file", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(digests, "doc_id long, start long, file string, n_tokens long, ids_crc32 long")


def encode_and_read_back(docs: DataFrame, vocab: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    spark = docs.sparkSession
    ship_package(spark)
    path = new_path(spark, "tokens-orc")
    write_tokens(docs, path, vocab, end_id)
    files = opened(spark, path)
    return with_base(token_digest(files), path).select("doc_id", "start", "n_tokens", "ids_crc32")
