"""Connected components over an edge table, in Spark, without bringing edges to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored


def _sum(label: DataFrame):
    return label.agg(F.sum(F.col("p").cast("decimal(38,0)"))).first()[0]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each end of an edge (a, b) reaches.

    Every node points to the smallest one it has heard of; a round passes that on over the edges
    and then jumps from pointer to pointer, so a chain of n nodes takes about log n rounds. Hot
    nodes cost no large group: only minima are aggregated, partly before the shuffle.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "cc-edges")
    label = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")).withColumnRenamed("a", "node"), "cc-labels")
    before = _sum(label)
    for _ in range(rounds):
        told = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("p").alias("q"))
        heard = label.join(told, F.col("node") == F.col("a"), "left").select("node", "p", F.least("p", "q").alias("q"))
        # what a node heard also goes to the one it pointed to, and then everyone asks their target
        passed = heard.select(F.col("node"), F.col("q")).union(heard.select(F.col("p"), F.col("q"))).groupBy("node").agg(F.min("q").alias("q"))
        passed = stored(passed, "cc-passed")
        target = passed.select(F.col("node").alias("t"), F.col("q").alias("r"))
        label = stored(passed.join(target, F.col("q") == F.col("t"), "left").select("node", F.least("q", "r").alias("p")), "cc-labels")
        # labels never grow, so an equal sum means that none has changed
        after = _sum(label)
        if after == before:
            return label.withColumnRenamed("p", "component")
        before = after
    raise RuntimeError(f"components did not settle in {rounds} rounds")
