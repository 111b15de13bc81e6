"""The corpus pipeline: five stages, each on all that its predecessor kept.

``run`` stores each stage's result and goes on from the files, as a driver does that writes and
rereads them. Every stage but the last returns the columns of ``documents``; the
last returns the packed pieces. Other columns of the caller's are dropped by the first stage.

Defined cases, as the stages' operators have them: null and empty texts have no words and go with the
base rule of the quality stage; a null lang or source is a group like any other; texts of any length
are taken whole; of equal documents the one with the smallest doc_id stays; an empty table gives
no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, line_dedup, near_dedup, packing, quality
from tablewright.llm.common import stored
from tablewright.runtime import ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the robust outlier test rejects go."""
    return quality.keep_regular(docs).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents hold stay in one of them; n_chars follows the text."""
    ship_package(spark)
    kept = line_dedup.drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship_package(spark)
    return near_dedup.keep_one_each(docs).select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, also re-parameterised ones, go."""
    ship_package(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences of at most 2048 tokens."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("near-duplicate removal", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("best-fit packing", pack),
]

#: The robust outlier test, the template slots and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
