"""Lookups, anti-joins with reasons, merges and tolerance joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.columns import all_columns, free
from corpusloom.operators.order import RANGES, keep_first, running_sum
from corpusloom.session import written

#: Rows and bytes up to which a table is broadcast; both are counted first.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20
#: Points of a grid cell's block.
CELL_ROWS = 4096


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: texts by their length, nested values by that of their JSON, all others 8."""

    def size(column: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0))
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        return F.lit(8)

    return reduce(lambda a, b: a + b, (size(c, f.dataType) for c, f in zip(all_columns(df), df.schema, strict=True)), F.lit(8))


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows and bytes, else as it is: Spark then shuffles and splits hot keys."""
    some = df.limit(BROADCAST_ROWS + 1).select(row_bytes(df).cast("bigint").alias("size"))
    rows, size = some.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def lookup(df: DataFrame, mapping: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """``df`` with the mapping's value of its key, or the default. The mapping has each key once."""
    return df.join(small(mapping.select(key, value)), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def last_wins(mapping: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Each key with the value of its last row in order."""
    return mapping.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, order).alias(value))


def cascade_reasons(df: DataFrame, known: DataFrame, keys: list[tuple[str, Column, Column]]) -> DataFrame:
    """``df`` with ``reason``: the name of the first key under which ``known`` has the row, or null.

    A key is (name, expression over ``df``, expression over ``known``); null and empty keys match nothing.
    """
    out, flags = df, free(df, *[f"_f{i}" for i in range(len(keys))])
    own, theirs = free(df, "_left", "_right", *flags)[:2]
    for flag, (_, left, right) in zip(flags, keys, strict=True):
        seen = known.select(right.alias(theirs)).where(F.col(theirs) != "").distinct().withColumn(flag, F.lit(True))
        out = out.withColumn(own, left).join(seen, F.col(own) == F.col(theirs), "left").drop(own, theirs)
    reason = F.coalesce(*[F.when(F.col(f), name) for f, (name, _, _) in zip(flags, keys, strict=True)])
    return out.withColumn("reason", reason).drop(*flags)


def unseen(df: DataFrame, done: DataFrame, left: Column, right: Column) -> DataFrame:
    """The rows whose key isn't among those done; rows without a key stay."""
    key, known = free(df, "_key", "_done")
    keys = done.select(right.alias(known)).where(F.col(known).isNotNull()).distinct()
    return df.withColumn(key, left).join(keys, F.col(key) == F.col(known), "left_anti").drop(key)


def append_new(main: DataFrame, more: DataFrame, key: str, order: str) -> DataFrame:
    """``main`` and those rows of ``more`` whose key is neither in it nor earlier in ``more``; empty keys always count
    as new. With ``branch`` 0 or 1."""
    fresh = keep_first(more, [key], [order], empty_key="keep")
    filled = fresh.where(F.col(key) != "")
    fresh = filled.join(main.select(key).where(F.col(key) != "").distinct(), key, "left_anti").unionByName(fresh.where((F.col(key) == "") | F.col(key).isNull()))
    return main.withColumn("branch", F.lit(0)).unionByName(fresh.withColumn("branch", F.lit(1)))


def _by_blocks(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both sides joined by ``cell``; of cells with more than a block on a side, every block of the one meets every block of the other."""
    blocks = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias(name))
    dealt = written(blocks(left, "lefts").join(blocks(right, "rights"), "cell").where("lefts > 1 OR rights > 1"), "grid-crowded")

    def spread_out(df: DataFrame, own: str, other: str, seed: int) -> DataFrame:
        told = df.join(small(dealt), "cell", "left").withColumn(own, F.pmod(F.xxhash64(F.struct(*[c for c in df.columns if c != "cell"]), F.lit(seed)), F.coalesce(own, F.lit(1))).cast("int"))
        return told.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))

    # a side's rows are many times those of the files it is read from, so their size says nothing of a broadcast's
    return spread_out(left, "lefts", "rights", 1).join(spread_out(right, "rights", "lefts", 2).hint("merge"), ["cell", "lefts", "rights"])


def nearest_known(points: DataFrame, known: DataFrame, columns: list[str], tolerance: float, key: str, known_order: str) -> DataFrame:
    """Every point with the first known point, in order (those without one last), that differs by less than the tolerance in every
    column (its columns get the prefix ``known_``), or nulls. Points with equal keys get the first of what any of them meets.

    A grid over all columns has cells twice as wide as the tolerance, told by a hash, as the distance is tested anyway; a point stands
    in its own cell, and a known point in all that its tolerance reaches (two of every column, three where rounding makes it so).
    Known points with the same coordinates are one, the first in order, and are numbered in order.
    The points of a crowded cell are dealt out in blocks, and every block of the one side meets every block of the other.
    What a point meets is brought down to the smallest number where it is found, by hash, so matches are neither gathered nor sorted.
    Points with a coordinate that is null, NaN or infinite meet none.
    """
    width, places = 2.0 * tolerance, range(len(columns))
    as_double = lambda c: F.col(c).cast("double")
    usable = reduce(lambda a, b: a & b, (F.abs(as_double(c)) < float("inf") for c in columns))
    first = F.min(F.struct(F.col(known_order).isNull().alias("last"), F.col(known_order).alias("order"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(known.columns)]))
    told = written(known.where(usable).groupBy(*[as_double(c).alias(f"x{i}") for i, c in enumerate(columns)]).agg(first.alias("known")).select("*", "known.*").drop("known"), "grid-known")
    few = told.limit(CELL_ROWS + 1).count() <= CELL_ROWS
    ties = tuple(f"v{i}" for i, c in enumerate(known.columns) if c != known_order)
    numbered = running_sum(told, F.lit(1), "order", ties, out="no", ranges=1 if few else RANGES).withColumn("no", F.col("no").cast("bigint"))
    numbered = written(numbered.withColumn("no", F.when(F.col("last"), F.col("no") + (1 << 62)).otherwise(F.col("no"))), "grid-numbered")

    right = numbered.select("no", *[f"x{i}" for i in places])
    for i in places:
        right = right.withColumn(f"c{i}", F.explode(F.sequence(F.floor((F.col(f"x{i}") - tolerance) / width), F.floor((F.col(f"x{i}") + tolerance) / width))))
    right = right.select("no", *[f"x{i}" for i in places], F.xxhash64(*[f"c{i}" for i in places]).alias("cell"))
    left = points.where(usable).select(F.col(key).alias("key"), *[as_double(c).alias(f"y{i}") for i, c in enumerate(columns)])
    left = left.withColumn("cell", F.xxhash64(*[F.floor(F.col(f"y{i}") / width) for i in places]))
    # of few known points no cell has more than a block; many points of a cell are split as skew
    near = left.join(right, "cell") if few else _by_blocks(left, right)
    for i in places:
        near = near.where(F.abs(F.col(f"y{i}") - F.col(f"x{i}")) < tolerance)
    values = numbered.select("no", *[f"v{i}" for i in range(len(known.columns))])
    best = near.groupBy("key").agg(F.min("no").alias("no")).join(small(values), "no")
    (own,) = free(points, "_key")
    best = best.select(F.col("key").alias(own), *[F.col(f"v{i}").alias(f"known_{c}") for i, c in enumerate(known.columns)])
    return points.join(best, F.col(key) == F.col(own), "left").drop(own)


def new_by_group(df: DataFrame, key: str, group_order: str, row_order: str) -> DataFrame:
    """Groups in order with how many keys each brings first."""
    return keep_first(df, [key], [group_order, row_order]).groupBy(group_order).agg(F.count("*").alias("n_new"))
