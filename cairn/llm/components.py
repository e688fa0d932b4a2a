"""Connected components by alternating stars; neither links nor labels ever reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import durable, forget, tidy


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, label) for every node that has a link to another; label: the least node of its component.

    Each round points every node at the least node it knows, first from its larger neighbours, then
    from its smaller ones, until the links no longer change: about log2 of a component's breadth.
    Links that still change after ``rounds`` rounds are an error.  Null ends, self links and repeats are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    spark = links.sparkSession
    edges = durable(edges, "links")
    seen = _state(edges)
    for _ in range(rounds if seen[0] else 0):
        old, both = edges, edges.union(edges.select("m", "v"))
        least = both.groupBy("v").agg(F.least(F.min("m"), F.first("v")).alias("to"))
        large = both.join(least, "v").where("m > v").select(F.col("m").alias("v"), F.col("to").alias("m")).distinct()
        small = large.groupBy("v").agg(F.min("m").alias("to"))
        edges = large.join(small, "v").select(F.when(F.col("m") == F.col("to"), F.col("v")).otherwise(F.col("m")).alias("v"), F.col("to").alias("m")).distinct()
        edges = durable(edges, "links")
        forget(spark, old)
        now = _state(edges)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError(f"links still change after {rounds} rounds: components would be split")
    # every node now hangs on its component's least node
    return edges.groupBy(F.col("v").alias("node")).agg(F.min("m").alias("label")).union(edges.select(F.col("m").alias("node"), F.col("m").alias("label")).distinct())


def _state(edges: DataFrame) -> tuple:
    with tidy(edges.sparkSession):
        return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(v, m))"), F.expr("sum(cast(xxhash64(m, v) as decimal(38, 0)))")).first())
