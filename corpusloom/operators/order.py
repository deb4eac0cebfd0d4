"""Operators on ordered rows that never bring all rows to one task.

Rows are cut into ranges of the order column; sums by range are few and small, and what is left runs within a range. A value
that many rows share has ranges of its own, cut by the column that breaks ties.

Numbers are cut at approximate quantiles. Keys of any other type that Spark can sort (strings, times, structs, arrays) are cut,
together with the columns that break ties, at the keys of a sample, so a frequent key is cut by its ties as well. Ranges only
balance the work: the results don't depend on what was drawn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.columns import beside, free, named

#: Ranges that an ordered operator cuts its rows into.
RANGES = 64
#: Rows drawn for each range, and characters of a string that a cut keeps (what a cut lacks only moves it).
DRAWN, CUT_CHARS = 64, 1000


def _cuts(df: DataFrame, order_col: str, ranges: int) -> list[float]:
    """Approximate quantiles of a numeric column, equal ones as often as they come; none for other columns."""
    if not isinstance(df.schema[order_col].dataType, T.NumericType):
        return []
    return df.approxQuantile(order_col, [i / ranges for i in range(1, ranges)], 0.25 / ranges)


def _range(order_col: str, cuts: list[float]) -> Column:
    number = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < named(order_col))) if cuts else F.lit(0)
    return F.when(named(order_col).isNull(), -1).otherwise(number)


def by_range(df: DataFrame, order_col: str, ranges: int = RANGES) -> Column:
    """The number of a row's range of the numeric order column, by approximate quantiles; null order is range -1."""
    return _range(order_col, sorted(set(_cuts(df, order_col, ranges))))


def _cut_short(key: Column, kind: T.DataType) -> Column:
    return F.substring(key, 1, CUT_CHARS) if isinstance(kind, (T.StringType, T.BinaryType)) else key


def _literal(value: object, kind: T.DataType) -> Column:
    """A value of any type that can be sorted, as a literal."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(value[i], f.dataType).alias(f.name) for i, f in enumerate(kind)])
    if isinstance(kind, T.ArrayType):
        return F.array(*[_literal(v, kind.elementType) for v in value]).cast(kind)
    return F.lit(value).cast(kind)


def sampled_range(df: DataFrame, keys: list[str], ranges: int = RANGES) -> tuple[Column, int]:
    """The number of a row's range in the order of the keys (of any types that can be sorted, nulls first), and how many ranges
    there are. They have about as many rows each, by a sample; rows with equal keys share one."""
    key = F.struct(*[named(k).alias(f"k{i}") for i, k in enumerate(keys)])
    short = df.select(F.struct(*[_cut_short(named(k), df.schema[k].dataType).alias(f"k{i}") for i, k in enumerate(keys)]).alias("key"))
    n = short.count() if ranges > 1 else 0
    if not n:
        return F.lit(0), 1
    drawn = short.sample(min(1.0, 1.2 * DRAWN * ranges / n), seed=17).orderBy("key").collect()  # about DRAWN rows for each range
    kind, step = short.schema["key"].dataType, max(1, len(drawn) // ranges)
    cuts = list(dict.fromkeys(tuple(map(repr, r.key)) for r in drawn[step::step]))
    by_repr = {tuple(map(repr, r.key)): r.key for r in drawn[step::step]}
    if not cuts:
        return F.lit(0), 1
    return F.size(F.filter(F.array(*[_literal(by_repr[c], kind) for c in cuts]), lambda c: c < key)), len(cuts) + 1


def _sum_by_sample(df: DataFrame, value: Column, keys: list[str], out: str, groups: tuple[str, ...], ranges: int) -> DataFrame:
    """The running sum over sampled ranges: sums by range, those of all earlier ranges, and a window within each range."""
    at, one, base, total = free(df, "_range", "_value", "_base", "_total")
    place, many = sampled_range(df, keys, ranges)
    told = df.withColumn(at, place).withColumn(one, value)
    sums = told.groupBy(*groups, at).agg(F.coalesce(F.sum(one), F.lit(0)).alias(total))
    # every range gives its sum to those behind it: at most ranges x ranges rows of a group, no window over all
    later = sums.where(F.col(at) < many - 1).select(*map(named, groups), F.explode(F.sequence(F.col(at) + 1, F.lit(many - 1))).alias(at), F.col(total).alias(base))
    none = sums.select(*map(named, groups), at, (F.col(total) - F.col(total)).alias(base))
    bases = later.unionByName(none).groupBy(*groups, at).agg(F.sum(base).alias(base))
    within = Window.partitionBy(*groups, at).orderBy(*[named(k) for k in keys]).rowsBetween(Window.unboundedPreceding, 0)
    summed = beside(told, bases, [*groups, at], broadcast=not groups)
    return summed.withColumn(out, named(base) + F.coalesce(F.sum(one).over(within), F.lit(0))).drop(at, one, base)


def running_sum(df: DataFrame, value: Column, order_col: str, ties: tuple[str, ...] = (), out: str = "running", groups: tuple[str, ...] = (), ranges: int = RANGES) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows (of its group) up to this one, in the order of the order column (nulls
    first) and then the ``ties`` columns.

    A numeric order column is cut into ranges. A value at which two quantiles lie has a range of its own, which is cut by the
    first of the ties; so neither a frequent value nor a large group is the work of one task. Other types are cut by samples of the
    order column and all ties. ``ranges`` is 1 for tables that are known to be small. Rows that agree in order and ties stand in
    any order.
    """
    if ranges > 1 and not isinstance(df.schema[order_col].dataType, T.NumericType):
        return _sum_by_sample(df, value, [order_col, *ties], out, groups, ranges)
    at, part, one, base = free(df, "_range", "_part", "_value", "_base")
    found = _cuts(df, order_col, ranges) if ranges > 1 else []
    if not found:
        upto = Window.partitionBy(*groups).orderBy(order_col, *ties).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(one, value).withColumn(out, F.coalesce(F.sum(one).over(upto), F.lit(0))).drop(one)
    whole = isinstance(df.schema[order_col].dataType, T.IntegralType)
    heavy = sorted({c for c in found if found.count(c) > 1 and (not whole or abs(c) < 2**53)}) if ties else []
    place, inside = _range(order_col, sorted(set(found))) * 2, F.lit(0)
    if heavy:
        often = named(order_col).isin([int(c) if whole else c for c in heavy])
        place = F.when(often, place + 1).otherwise(place)
        inside = F.when(often, by_range(df.where(often), ties[0])).otherwise(inside)
    told = df.withColumn(at, place).withColumn(part, inside).withColumn(one, value)
    earlier = Window.partitionBy(*groups).orderBy(at, part).rowsBetween(Window.unboundedPreceding, -1)
    sums = told.groupBy(*groups, at, part).agg(F.sum(one).alias(base))  # for each group at most a row for each range
    bases = sums.withColumn(base, F.coalesce(F.sum(base).over(earlier), F.lit(0)))
    within = Window.partitionBy(*groups, at, part).orderBy(order_col, *ties).rowsBetween(Window.unboundedPreceding, 0)
    summed = beside(told, bases, [*groups, at, part], broadcast=not groups)
    return summed.withColumn(out, named(base) + F.coalesce(F.sum(one).over(within), F.lit(0))).drop(at, part, one, base)


def budget_cut(df: DataFrame, tokens: Column, limit: int | None, order_col: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """The first rows in order (a column of any type that can be sorted, then the ties) until their tokens reach the limit, the row
    that crosses it included; no limit (null or not positive) keeps all."""
    if limit is None or limit <= 0:
        return df
    size, running = free(df, "_tokens", "_running")
    cut = running_sum(df.withColumn(size, tokens), F.col(size), order_col, ties, out=running)
    return cut.where(F.col(running) - F.col(size) < limit).drop(size, running)


def every_nth(df: DataFrame, n: int, order_col: str, keep: Column | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """Every n-th row in order (a column of any type that can be sorted, then the ties); rows that ``keep`` rejects are counted but not returned."""
    (number,) = free(df, "_number")
    numbered = running_sum(df, F.lit(1), order_col, ties, out=number).where(F.col(number) % n == 0)
    return (numbered if keep is None else numbered.where(keep)).drop(number)


def keep_first(df: DataFrame, keys: list[str], order: list[str], empty_key: str = "collapse") -> DataFrame:
    """The first row in order of every key. Null keys always stay; ``empty_key='keep'`` spares empty keys too.

    The first row is found where the rows lie and again after the shuffle, so a frequent key costs one row a task.
    """
    if empty_key not in ("collapse", "keep"):
        raise ValueError("empty_key is 'collapse' or 'keep'")
    spared = F.lit(False)
    for k in keys:
        spared = spared | F.col(k).isNull()
        if empty_key == "keep":
            spared = spared | (F.col(k) == "")
    (rank,) = free(df, "_rank")
    kept = df.where(~spared).withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) == 1).drop(rank)
    return kept.unionByName(df.where(spared))


def first_n(df: DataFrame, groups: list[str], order: list[Column | str], n: int) -> DataFrame:
    """The first n rows in order of every group."""
    (rank,) = free(df, "_rank")
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col(rank) <= n).drop(rank)


def top_n(df: DataFrame, column: str, n: int, ties: str, largest: bool = True) -> DataFrame:
    """The n rows with the largest (or smallest) values of a column, ties by another one, in that order; nulls come last."""
    return df.orderBy(F.desc_nulls_last(column) if largest else F.asc_nulls_last(column), ties).limit(n)
