"""Connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.session import BATCH_ROWS, bounded, written

#: Nodes that may have so many edges that they are joined by broadcast, and edges that any node may have without it.
HOT_NODES, LEAST_HOT = 2000, 500
#: Edges that a task ties at a time.
TIED = 1 << 18


def _tied_nearby(edges: DataFrame) -> DataFrame:
    """Edges of the same components: those of a range of nodes, ``TIED`` at a time, are replaced by an edge from every node to the
    smallest that they tie it to. Chains of neighbours, which steps by doubling shorten slowly, become a star for each range."""
    kind = to_arrow_type(edges.schema["u"].dataType)

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (pair for b in batches for pair in zip(*(c.to_pylist() for c in b.columns), strict=True))
        while some := list(islice(each, TIED)):
            up: dict = {}

            def top(x, up=up):
                while (y := up.setdefault(x, x)) != x:
                    up[x] = x = up[y]
                return x

            for u, v in some:
                a, b = top(u), top(v)
                if a != b:
                    up[max(a, b)] = min(a, b)
            told = [(x, t) for x in up if (t := top(x)) != x]
            for at in range(0, len(told), BATCH_ROWS * 10):
                part = told[at : at + BATCH_ROWS * 10]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], kind), pa.array([t for _, t in part], kind)], ["u", "v"])

    bounded(edges.sparkSession)
    return edges.repartitionByRange("u").sortWithinPartitions("u", "v").mapInArrow(tie, edges.schema).distinct()


def components(edges: DataFrame, label: str = "components", most: int = 50) -> DataFrame:
    """``node`` and ``root`` (the smallest node) of every connected component of ``edges`` (``u``, ``v``).

    Edges of near nodes are tied first (``_tied_nearby``). Then large-star and small-star in turn, until the edges are stars: every step is an aggregation and a join by node,
    written to the shared folder; the number of steps grows with the logarithm of the components' sizes. Nodes with
    many edges are joined by broadcast, so no task gets a large star as a whole.
    """
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), label)
    edges = written(_tied_nearby(edges), label)

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def with_least(rows: DataFrame, least: DataFrame, n: int) -> DataFrame:
        most_edges = max(LEAST_HOT, 2 * n // HOT_NODES)
        hot = F.broadcast(least.where(F.col("edges") > most_edges).drop("edges"))  # HOT_NODES rows at the most
        cold = rows.join(hot.select("u"), "u", "left_anti").join(least.drop("edges"), "u")
        return rows.join(hot, "u").unionByName(cold)

    before = state(edges)
    for _ in range(most if before[0] else 0):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("edges")).withColumn("m", F.least("m", "u"))
        large = with_least(both, least, before[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), label)
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("edges"))
        joined = with_least(large, least, before[0])
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), label)
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError("the components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
