"""A stream of changes kept up to date as a table, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewright.operators.schema import col
from tablewright.sources.buckets import merge_by_bucket


def latest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the newest by ``order``, ties by the other columns."""
    by = Window.partitionBy(*(col(k) for k in keys)).orderBy(col(order).desc_nulls_last(), *(col(c) for c in df.columns if c != order))
    return df.withColumn("_nth", F.row_number().over(by)).where("_nth = 1").drop("_nth")


def upsert_stream(stream: DataFrame, where: str, table: str, keys: list[str], order: str, checkpoint: str, buckets: int = 64, **trigger) -> StreamingQuery:
    """Merge every micro-batch into the files ``where/table`` by type 1, in ``buckets`` by key of which
    only those that a batch touches are read and written.

    A batch that runs again after a failure gives the same table, as the merge sets values and adds
    none; a reader finds the old buckets or the new ones, never a part.
    """

    def apply(batch: DataFrame, _: int) -> None:
        merge_by_bucket(latest_per_key(batch, keys, order), f"{where}/{table}", keys, buckets, check_keys=False)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
