"""Exact top-k search by inner product with block-at-a-time pruning.

Rows, in the order of their ids, form blocks (ranges of documents). A block is one row: its ids, its vectors as a
forward index, and each term's (dimension's) largest and smallest value. Groups of neighbouring blocks meet packs of
queries by an equi-join on a grid, so a task holds one group (of bounded bytes) and a few packs, whatever the sizes of the
tables.

In a task, a query's bound for a block is the sum over its terms of the weight times the term's maximum (its minimum
for negative weights). Every query goes through the blocks from the largest bound down, many queries at once, scores
whole blocks through the forward index, and stops when the next bound falls below its k-th score; on equal bounds it
goes on, as a smaller id may win the tie. Every pack meets one group first; the k-th scores found there go with the
queries to all other groups, so a group none of whose blocks can reach them is not scored at all. The groups' best k meet
in one ranking for each query. Results are exact.

Scores are integers of any size: they are computed in doubles where all partial sums stay below 2^53, else in Python
integers, and ranked exactly. Where a score doesn't fit a long, the largest (or smallest) long stands for it.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows with a null
id; shorter vectors count as padded with zeros; a query's own row is every row with its id; every row with a query's id is a
query with ranks of its own; rows that repeat are candidates each; ties go to the smaller id; a query with fewer than k
candidates gets them all; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.batches import bounded
from corpusloom.session import written

#: Rows of a block and queries of a pack, bytes of a group and rows of one, packs that share a group's copy.
BLOCK_ROWS, PACK_ROWS, GROUP_BYTES, GROUP_ROWS, PACKS_TOGETHER = 256, 256, 16 << 20, 16_384, 8
EXACT, LONGEST, UNKNOWN = 2.0**53, (1 << 63) - 1, -(1 << 63)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and the vector ``v`` in doubles of every row that takes part."""
    x = F.transform(F.col(f"`{vector_col}`"), lambda c: c.cast("double"))
    fit = F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c))
    return vectors.where(fit).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), x.alias("v"))


def quantized(lists: list, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors, whole numbers in the smallest kind of float that holds them exactly (a double holds the
    floor of any double); shorter ones padded with zeros."""
    out = np.zeros((len(lists), max(map(len, lists), default=0)))
    for row, v in zip(out, lists, strict=True):
        row[: len(v)] = np.floor(np.asarray(v, np.float64) * scale)
    return out.astype(np.float32) if np.abs(out).max(initial=0) <= 1 << 24 else out


def blocks(rows: DataFrame, size: int, name: str, scale: int) -> DataFrame:
    """Ranges of at most ``size`` ids, each as one row: ``name`` (a number of its own), ``n``, ``dims``, ids and vectors."""
    sorted_rows = rows.repartitionByRange("id").sortWithinPartitions("id")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        held: list[pd.DataFrame] = []
        number = TaskContext.get().partitionId() << 33

        def one(part: pd.DataFrame) -> pd.DataFrame:
            nonlocal number
            m = quantized(part["v"].tolist(), scale)
            number += 1
            return pd.DataFrame({name: [number - 1], "n": [len(m)], "dims": [m.shape[1]], "ids": [part["id"].to_numpy(np.int64).tobytes()], "data": [m.tobytes()]})

        for frame in frames:
            held.append(frame)
            if sum(map(len, held)) >= size:
                whole = pd.concat(held, ignore_index=True)
                full = len(whole) // size * size
                for at in range(0, full, size):
                    yield one(whole.iloc[at : at + size])
                held = [whole.iloc[full:]] if full < len(whole) else []
        if held:
            yield one(pd.concat(held, ignore_index=True))

    return sorted_rows.mapInPandas(pack, f"{name} bigint, n int, dims int, ids binary, data binary")


def _load(ids: bytes, data: bytes, n: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    kind = np.float32 if len(data) == 4 * n * dims else np.float64
    return np.frombuffer(ids, np.int64), np.frombuffer(data, kind).reshape(n, dims)


def _whole(m: np.ndarray, exact: bool) -> np.ndarray:
    """Whole numbers as doubles, or as Python integers."""
    return m.astype(np.float64) if exact else np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape)


def search_blocks(docs: list[tuple[np.ndarray, np.ndarray]], qid: np.ndarray, q: np.ndarray, k: int, least: Sequence[int | None] | None = None) -> tuple[np.ndarray, np.ndarray, list[int], int]:
    """The best k of the blocks for each query, as arrays of the query's place, id and score, and the number of blocks scored.
    ``least`` has scores that are known to be reached k times elsewhere."""
    dims = max([q.shape[1], *(m.shape[1] for _, m in docs)])
    widen = lambda m: np.pad(m, ((0, 0), (0, dims - m.shape[1]))) if m.shape[1] < dims else m
    most = float(np.abs(q).max(initial=0)) * max((float(np.abs(m).max(initial=0)) for _, m in docs), default=0.0) * max(dims, 1)
    exact = most < EXACT
    q, docs = _whole(widen(q), exact), [(ids, _whole(widen(m), exact)) for ids, m in docs]
    highs, lows = np.stack([m.max(0) for _, m in docs]), np.stack([m.min(0) for _, m in docs])
    bounds = np.maximum(q, 0) @ highs.T + np.minimum(q, 0) @ lows.T  # queries x blocks
    order = np.argsort(-bounds, axis=1, kind="stable")
    n = len(q)
    known = [None] * n if least is None else list(least)
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, q.dtype), np.empty(0, np.int64))] * n
    alive, scored = np.arange(n), 0

    def floor(i: int) -> int | None:
        own = int(best[i][0][-1]) if len(best[i][0]) >= k else None
        return known[i] if own is None or known[i] is not None and known[i] > own else own

    for step in range(len(docs)):
        going = []
        for i in alive.tolist():  # a query whose next bound falls below its k-th score is done
            reached = floor(i)
            if reached is None or bounds[i, order[i, step]] >= reached:
                going.append(i)
        alive = np.array(going, np.int64)
        if not len(alive):
            break
        at = order[alive, step]
        for b in np.unique(at).tolist():
            ids, m = docs[b]
            some = alive[at == b]
            scores = q[some] @ m.T
            scored += len(some)
            for i, row in zip(some.tolist(), scores, strict=True):
                keep, reached = ids != qid[i], floor(i)
                if reached is not None:
                    keep &= (row >= reached).astype(bool)
                if not keep.any():
                    continue
                s, v = np.concatenate([best[i][0], row[keep]]), np.concatenate([best[i][1], ids[keep]])
                top = np.lexsort((v, -s))[:k] if exact else np.array(sorted(range(len(s)), key=lambda j: (-s[j], v[j]))[:k])
                best[i] = s[top], v[top]
    return np.repeat(np.arange(n), [len(s) for s, _ in best]), np.concatenate([v for _, v in best]), [int(x) for s, _ in best for x in s.tolist()], scored


def sort_key(score: int) -> str:
    """A text that sorts as the integer does."""
    digits = str(abs(score))
    return f"1{len(digits):05d}{digits}" if score >= 0 else f"0{99999 - len(digits):05d}" + "".join(str(9 - int(c)) for c in digits)


def top_k(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's k best rows; ``queries`` says by the
    column ``id`` which rows are queries."""
    spark = vectors.sparkSession
    bounded(spark)
    rows = usable(vectors, id_col, vector_col)
    dims = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    group_rows = max(1, min(GROUP_ROWS, GROUP_BYTES // (8 * max(1, dims))))
    block_rows, pack_rows = min(BLOCK_ROWS, group_rows), min(PACK_ROWS, group_rows)
    docs = written(blocks(rows, block_rows, "block", scale), "topk-blocks")
    packs = written(blocks(rows.where(queries), pack_rows, "pack", scale), "topk-queries")

    # numbers without gaps, from counts by partition: the high bits are the partition
    def numbered(frame: DataFrame, name: str, together: int, out: str) -> tuple[DataFrame, int]:
        spread = frame.groupBy(F.shiftright(name, 33).alias("part")).agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        number = F.col("base") + F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
        placed = frame.withColumn("part", F.shiftright(name, 33)).join(spread.select("part", "base"), "part").withColumn(out, F.floor(number / together)).drop("part", "base")
        return placed, -(-frame.count() // together)

    docs, groups = numbered(docs, "block", max(1, group_rows // block_rows), "g")
    packs, chunks = numbered(packs, "pack", PACKS_TOGETHER, "c")
    if not groups or not chunks:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")

    schema = "pack bigint, at int, query_id bigint, vec_id bigint, score bigint, wide string"

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        docs = [_load(r.ids, r.data, r.n, r.dims) for r in left.itertuples()]
        for r in right.itertuples() if docs else ():
            ids, q = _load(r.ids, r.data, r.n, r.dims)
            least = None if r.least is None else [None if x == UNKNOWN else int(x) for x in r.least]
            at, doc, score, _ = search_blocks(docs, ids, q, k, least)
            wide = [sort_key(x) if abs(x) >= LONGEST else None for x in score]
            found.append(pd.DataFrame({"pack": r.pack, "at": at.astype(np.int32), "query_id": ids[at], "vec_id": doc, "score": np.array([max(-LONGEST, min(LONGEST, x)) for x in score], np.int64), "wide": pd.Series(wide, dtype=object)}))
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})

    def searched(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.drop("block").groupBy("g", "c").cogroup(right.groupBy("g", "c")).applyInPandas(search, schema)

    def ranked(found: DataFrame) -> DataFrame:
        place = Window.partitionBy("pack", "at").orderBy(F.desc("score"), F.desc("wide"), "vec_id")
        return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)

    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    own = F.pmod("c", F.lit(groups))  # the group that a pack meets first
    left, right = docs.withColumn("c", numbers(chunks)), packs.withColumn("g", numbers(groups))
    nothing = F.lit(None).cast("array<bigint>").alias("least")
    first = written(ranked(searched(left.where(F.col("g") == own), right.where(F.col("g") == own).select("*", nothing))).drop("rank"), "topk-first")
    if groups > 1:
        # the k-th score of every query that has k; one too long for a long bounds nothing
        reached = first.groupBy("pack", "at").agg(F.count("*").alias("n"), F.min("score").alias("score"), F.count("wide").alias("wide")).where(F.expr(f"n = {k} AND wide = 0"))
        by_pack = reached.groupBy("pack").agg(F.map_from_entries(F.collect_list(F.struct("at", "score"))).alias("kth"))  # a pack's queries at the most
        told = right.where(F.col("g") != own).join(by_pack, "pack", "left")
        told = told.withColumn("least", F.when(F.col("kth").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.coalesce(F.try_element_at("kth", i), F.lit(UNKNOWN))))).drop("kth")
        first = first.unionByName(searched(left.where(F.col("g") != own), told))
    return ranked(first).select("query_id", "rank", "vec_id", "score")
