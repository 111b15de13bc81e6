"""What the text operators share: the folder for intermediate tables, words, row batches."""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.sources.staging import shared_dir

#: The six ASCII blanks that separate words in every contract here.
BLANKS = " \t\n\x0b\x0c\r"
#: An odd number, for polynomials modulo 2^64.
RATIO = np.uint64(0x9E3779B97F4A7C15)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The same two classes for Spark's (Java) regular expressions.
JAVA_BLANKS = r"[\x20\x09-\x0D]+"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tablewright/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Later plans start from the files: no branch computes ``df`` again, and a lost executor costs
    only the tasks that it was running.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long and text (null: empty), with the columns ``more``; nothing else."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def without(docs: DataFrame, out: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not among those of ``out``; null doc_ids stay.

    The list is stored, and joined under a name that no column of ``docs`` has.
    """
    own = f"doc_id_{uuid.uuid4().hex}"
    listed = stored(out.select(F.col("doc_id").alias(own)).distinct(), name)
    return docs.join(listed, F.col("doc_id").cast("long") == F.col(own), "left_anti")


#: Keys that looked_up() treats as hot, at most.
HOT = 10_000


def looked_up(rows: DataFrame, facts: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` with the facts of their ``key``, which is never null; rows without facts are kept.

    ``facts`` has one narrow row a key, and in ``weight`` the number of rows with it. Keys that hold
    more than one of ``HOT`` rows, ``HOT`` of them at most, are broadcast; the other rows are
    joined, so no key brings a large share of the rows to one task. ``rows`` are read twice.
    """
    facts = stored(facts, "facts")
    total = facts.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    hot = facts.where(F.col(weight) * HOT > total).drop(weight)
    by_hand = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(facts.drop(weight), key, "left")
    return by_hand.unionByName(rest)


def ascii_lower(text: str) -> str:
    """A-Z lower-cased, every other character as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


class WordHashes(dict):
    """word -> 64-bit hash; forgets everything at ``limit`` entries, so memory stays bounded."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str | bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (xor-shift and multiply rounds)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` consecutive entries; a shorter sequence is one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    total = hashes[: n - width + 1].copy()
    for k in range(1, width):  # a polynomial of the well mixed hashes of words, modulo 2^64
        total *= RATIO
        total += hashes[k : n - width + 1 + k]
    return mixed(total)


def batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def slices(record: pa.RecordBatch, chars: int = 1_500_000, column: str = "text"):
    """A batch as smaller ones of about so many bytes of ``column``, one row at least."""
    own = record.column(column)
    sizes = np.diff(np.frombuffer(own.buffers()[1], np.int32 if own.type in (pa.string(), pa.binary()) else np.int64)[own.offset :][: record.num_rows + 1]) if record.num_rows else []
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > chars:
            yield record.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < record.num_rows:
        yield record.slice(start)
