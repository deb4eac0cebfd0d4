"""Statistics by group, exact, from counts that are summed before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.columns import beside, free, named
from corpusloom.operators.order import RANGES, running_sum
from corpusloom.session import written

#: Distinct values of all groups up to which they are not cut into ranges.
FEW_VALUES = 1_000_000


def _placed(df: DataFrame, groups: list[str], value: str) -> tuple[DataFrame, str, str, str]:
    """Every distinct value of every group with how many rows have it, how many have it or a smaller one, and how many the
    group has; and the names of these three. Distinct values are placed by ranges, so no task gets a group as a whole."""
    n, end, whole = free(df, "_n", "_end", "_all")
    counts = written(df.where(named(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias(n)), "quantile-counts")
    sizes = counts.groupBy(*groups).agg(F.sum(n).alias(whole))
    ranges = 1 if counts.count() <= FEW_VALUES else RANGES
    return beside(running_sum(counts, F.col(n), value, out=end, groups=tuple(groups), ranges=ranges), sizes, groups), n, end, whole


def _at(place: Column, value: str, n: str, end: str) -> Column:
    """Aggregate: the value at a place, from 0, of a group's sorted rows."""
    return F.max(F.when((F.col(end) - F.col(n) <= place) & (place < F.col(end)), named(value)))


def index_quantiles(df: DataFrame, groups: list[str], value: str, percents: list[int]) -> DataFrame:
    """Of every group the values at the places ``n * q div 100`` of its sorted values, as ``q25`` and so on, and ``n``.

    q = 50 is the upper median. Equal values of a group are counted first, so only distinct ones are sorted.
    """
    placed, n, end, whole = _placed(df, groups, value)
    picks = [_at(F.floor(F.col(whole) * q / 100), value, n, end).alias(f"q{q}") for q in percents]
    return placed.groupBy(*groups).agg(F.sum(n).alias("n"), *picks)


def percentiles(df: DataFrame, groups: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Of every group the interpolated percentiles of a column: ``shares`` has the share of each by the name of its column."""
    placed, n, end, whole = _placed(df, groups, value)
    columns = []
    for name, share in shares.items():
        place = (F.col(whole) - 1) * F.lit(float(share))
        low, high = _at(F.floor(place), value, n, end), _at(F.ceil(place), value, n, end)
        columns.append((low + (F.max(place) - F.floor(F.max(place))) * (high - low)).alias(name))
    return placed.groupBy(*groups).agg(*columns)


def top_groups(df: DataFrame, group: str, n: int, first_seen: str | None = None) -> DataFrame:
    """The n largest groups with their counts; ties by name, or by the smallest value of a column that tells the order in which
    rows were seen."""
    if first_seen is None:
        return df.groupBy(group).agg(F.count("*").alias("n")).orderBy(F.desc("n"), group).limit(n)
    (seen,) = free(df, "_seen")
    return df.groupBy(group).agg(F.count("*").alias("n"), F.min(first_seen).alias(seen)).orderBy(F.desc("n"), seen).limit(n).drop(seen)


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    """How many keys have each number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n_keys"))


def decision_counts(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row: the number of rows, and for every test how many pass and their share."""
    columns = [F.count("*").alias("n")]
    for name, test in tests.items():
        columns += [F.count_if(test).alias(f"n_{name}"), F.round(F.count_if(test) / F.count("*"), 4).alias(f"share_{name}")]
    return df.agg(*columns)


def totals(df: DataFrame, group: str, size: str) -> DataFrame:
    """Pages and characters of every group, and of all (group null): the totals of a manifest."""
    return df.rollup(group).agg(F.grouping(group).alias("is_total"), F.count("*").alias("pages"), F.coalesce(F.sum(size), F.lit(0)).alias("chars"))


def accuracy(df: DataFrame, correct: str, by: str) -> DataFrame:
    """Questions, correct ones and accuracy of every group, and of all under ``(all)``, which is 0 without questions."""
    told = lambda d: d.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col(correct).cast("bigint")), F.lit(0)).alias("n_correct"))
    whole = told(df).select(F.lit("(all)").alias("group_name"), "n", "n_correct")
    both = told(df.groupBy(F.col(by).cast("string").alias("group_name"))).unionByName(whole)
    return both.withColumn("accuracy", F.round(F.when(F.col("n") > 0, F.col("n_correct") / F.col("n")).otherwise(0.0), 4))


def changes(df: DataFrame, old: str, new: str) -> DataFrame:
    """One row: how many became right, became wrong, or stayed."""
    return df.agg(
        F.count("*").alias("n"),
        F.count_if(~F.col(old) & F.col(new)).alias("improved"),
        F.count_if(F.col(old) & ~F.col(new)).alias("degraded"),
        F.count_if(F.col(old) == F.col(new)).alias("unchanged"),
    )
