"""A stored index of vectors for exact search by the largest inner product.

Vectors are put to the nearest of a few centres, which come from a bounded sample, and each centre's members are packed as blocks of at
most ``BLOCK_ROWS`` rows (a crowded centre has several, dealt by hash). A block keeps its mean, its radius around it and its members
as bytes, so the index is a table that is read by block. For a query ``q`` no member of a block scores more than
``q . mean + |q| * radius``. A search first scores every query's ``FIRST`` most promising blocks, which gives it a k-th score, and
then only those blocks whose bound reaches it; queries go in chunks, and chunks meet blocks by the block's number. What is skipped
holds no better vector, so results are exact, whatever the centres; those only decide how much is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.retrieval import _matrix, _usable
from corpusloom.session import bounded, spread, written

#: Vectors of the sample, centres, rows of a block, queries of a chunk, blocks that a query visits first, and blocks whose means are
#: compared with a chunk in one task.
SAMPLE, MOST_CENTRES, BLOCK_ROWS, CHUNK_QUERIES, FIRST, MEANS = 20_000, 2048, 512, 512, 2, 16_384


def sampled_centres(vectors: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Centres of a sample: the first one, each next one the farthest from all before, then moved to their members' means."""
    chosen, far = [0], np.full(len(vectors), np.inf)
    while len(chosen) < min(n, len(vectors)):
        far = np.minimum(far, ((vectors - vectors[chosen[-1]]) ** 2).sum(1))
        if not far.max():
            break
        chosen.append(int(far.argmax()))
    centres = vectors[chosen].copy()
    for _ in range(rounds):
        near = nearest(vectors, centres)
        size = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, vectors)
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


def nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of every vector's nearest centre."""
    return ((centres**2).sum(1) - 2 * vectors @ centres.T).argmin(1)


def write_index(vectors: DataFrame, path: str, id_col: str = "vec_id", vector_col: str = "embedding", cosine: bool = False) -> None:
    """Write the index of all vectors that have an id and finite numbers; ``cosine`` brings them to length 1 first."""
    bounded(vectors.sparkSession)
    rows = written(_usable(vectors, id_col, vector_col), "index-vectors")
    n, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    sample = rows.orderBy(F.xxhash64("id", "v")).limit(SAMPLE).toPandas()
    wanted = max(1, min(MOST_CENTRES, -(-4 * n // BLOCK_ROWS)))
    centres = sampled_centres(_matrix(sample["v"], dims, cosine), wanted) if n else np.zeros((1, dims))
    shared = rows.sparkSession.sparkContext.broadcast(centres)  # MOST_CENTRES vectors at the most

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            m = _matrix(frame["v"], dims, cosine)
            yield pd.DataFrame({"id": frame["id"], "centre": nearest(m, shared.value), "data": [r.tobytes() for r in m]})

    placed = written(spread(rows).mapInPandas(place, "id bigint, centre bigint, data binary"), "index-placed")
    sizes = placed.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("parts"))  # MOST_CENTRES rows at the most
    dealt = placed.join(F.broadcast(sizes), "centre").withColumn("part", F.expr("pmod(xxhash64(id, data), parts)"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for (centre, part), members in groupby(each, lambda r: r[:2]):
            held = list(members)
            m = np.frombuffer(b"".join(r[3] for r in held)).reshape(len(held), dims)
            mean = m.mean(0)
            radius = float(np.sqrt(((m - mean) ** 2).sum(1).max())) if dims else 0.0
            out = ([(centre << 32) + part], [mean.tobytes()], [radius], [len(held)], [np.array([r[2] for r in held], np.int64).tobytes()], [m.tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["block", "mean", "radius", "members", "ids", "data"])

    ready = dealt.select("centre", "part", "id", "data").repartition("centre", "part").sortWithinPartitions("centre", "part", "id")
    blocks = ready.mapInArrow(pack, "block bigint, mean binary, radius double, members bigint, ids binary, data binary")
    blocks.write.mode("errorifexists").parquet(path)


def _bounds(q: np.ndarray, means: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """The most that a member can score, with room for rounding."""
    length, reach = np.linalg.norm(q, axis=1), np.linalg.norm(means, axis=1) + radius
    return q @ means.T + length[:, None] * radius + 1e-9 * (1 + length[:, None] * reach)


def search_index(queries: DataFrame, spark: SparkSession, path: str, k: int, id_col: str = "vec_id", vector_col: str = "embedding", cosine: bool = False, told: dict | None = None) -> DataFrame:
    """``query_id``, ``vec_id``, ``score`` and ``rank`` of every query's k vectors of the largest inner product, others than itself,
    ties by id. ``told`` gets how many pairs of a query and a block there are, and how many were scored."""
    bounded(spark)  # a row has a chunk and a block, or a chunk and MEANS means
    blocks = spark.read.parquet(path)
    wanted = _usable(queries, id_col, vector_col)
    dims = blocks.agg(F.coalesce(F.max(F.octet_length("mean")), F.lit(0))).first()[0] // 8
    numbered = written(wanted.withColumn("chunk", F.pmod(F.xxhash64("id", "v"), F.lit(max(1, -(-wanted.count() // CHUNK_QUERIES))))), "index-queries")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for chunk, members in groupby(each, lambda r: r[0]):
            held = list(members)
            whole = _matrix(pd.Series([np.array(r[2]) for r in held]), max([dims, *(len(r[2]) for r in held)]), cosine)
            data = whole[:, :dims]  # what the index's vectors lack counts as zero
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([np.array([r[1] for r in held], np.int64).tobytes()]), pa.array([data.tobytes()])], ["chunk", "ids", "data"])

    chunks = written(numbered.select("chunk", "id", "v").repartition("chunk").sortWithinPartitions("chunk", "id").mapInArrow(pack, "chunk bigint, ids binary, data binary"), "index-chunks")
    counted = blocks.count()
    parts = max(1, -(-counted // MEANS))
    means = blocks.select(F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part"), "block", "mean", "radius").groupBy("part").agg(F.array_sort(F.collect_list(F.struct("block", "mean", "radius"))).alias("all"))  # about MEANS each

    def pairs(least: DataFrame | None) -> DataFrame:
        """``chunk``, ``block`` and the places of the queries that have to see it: first the most promising, then (with the k-th scores
        so far, ``least``) those others that the bound lets in."""
        later = least is not None
        known = chunks.join(least, "chunk", "left") if later else chunks
        met = known.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(means, "part")
        columns = ["chunk", "ids", "data", "all", *(["least"] if later else [])]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    many = len(row[1]) // 8
                    q = np.frombuffer(row[2]).reshape(many, dims)
                    bound = _bounds(q, np.frombuffer(b"".join(x["mean"] for x in row[3])).reshape(-1, dims), np.array([x["radius"] for x in row[3]]))
                    first = np.zeros(bound.shape, bool)
                    np.put_along_axis(first, np.argsort(-bound, axis=1, kind="stable")[:, :FIRST], True, axis=1)
                    if later:
                        kth = np.full(many, -np.inf)
                        for x in row[4] or []:
                            kth[x["at"]] = x["score"]
                        first = ~first & (bound >= kth[:, None])
                    hit = np.flatnonzero(first.any(0))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), row[0])), pa.array([row[3][b]["block"] for b in hit], pa.int64()), pa.array([np.flatnonzero(first[:, b]).astype(np.int32).tobytes() for b in hit], pa.binary())], ["chunk", "block", "at"])

        return written(met.select(*columns).mapInArrow(run, "chunk bigint, block bigint, at binary"), "index-pairs")

    def scored(which: DataFrame) -> DataFrame:
        met = which.join(blocks.select("block", F.col("ids").alias("keys"), F.col("data").alias("others")), "block").join(chunks, "chunk").select("chunk", "at", "ids", "data", "keys", "others")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, at, ids, data, keys, others in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    at, ids, keys = np.frombuffer(at, np.int32), np.frombuffer(ids, np.int64), np.frombuffer(keys, np.int64)
                    scores = np.frombuffer(data).reshape(len(ids), dims)[at] @ np.frombuffer(others).reshape(len(keys), dims).T
                    out = []
                    for i, row in zip(at, scores, strict=True):
                        near = np.flatnonzero(keys != ids[i])
                        near = near[np.lexsort((keys[near], -row[near]))[:k]]
                        out.append((np.full(len(near), chunk), np.full(len(near), i, np.int32), np.full(len(near), ids[i]), keys[near], row[near]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["chunk", "at", "query_id", "vec_id", "score"])

        return met.mapInArrow(run, "chunk bigint, at int, query_id bigint, vec_id bigint, score double")

    place = Window.partitionBy("chunk", "at").orderBy(F.desc("score"), "vec_id")
    best = lambda df: df.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    visited = pairs(None)
    found = written(best(scored(visited)), "index-found")
    kth = found.where(F.col("rank") == k).groupBy("chunk").agg(F.collect_list(F.struct("at", "score")).alias("least"))  # one for each query of a chunk
    more = pairs(kth)
    if told is not None:
        size = F.coalesce(F.sum(F.octet_length("at") / 4), F.lit(0)).cast("bigint")
        told |= {"pairs": numbered.count() * counted, "scored": visited.agg(size).first()[0] + more.agg(size).first()[0]}
    return best(found.drop("rank").union(scored(more))).select("query_id", "vec_id", "score", "rank")
