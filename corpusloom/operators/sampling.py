"""Sampling, splitting and shuffling by hashes of keys: the same rows at every run, whatever the partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.columns import all_columns, free
from corpusloom.functions.text import estimate_tokens
from corpusloom.operators.joins import small
from corpusloom.operators.order import budget_cut, first_n
from corpusloom.session import written


def draw(key: Column, seed: int) -> Column:
    """A number from 0 to 2^60 - 1 drawn by the key and the seed."""
    return F.conv(F.substring(F.md5(F.concat_ws("#", key.cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("bigint")


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """The rows in a drawn order."""
    return df.orderBy(draw(F.col(key), seed), key)


def hash_split(df: DataFrame, key: str, share: float, seed: int, names: tuple[str, str] = ("val", "train")) -> DataFrame:
    """``df`` with ``split``: the first name for the share of the keys, the second for the rest."""
    return df.withColumn("split", F.when(draw(F.col(key), seed) < int(share * (1 << 60)), names[0]).otherwise(names[1]))


def sample_n(df: DataFrame, groups: list[str], key: str, n: int, seed: int) -> DataFrame:
    """At most n drawn rows of every group (of all rows, without groups)."""
    if not groups:
        return df.orderBy(draw(F.col(key), seed), key).limit(n)
    return first_n(df, groups, [draw(F.col(key), seed), key], n)


def sample_quotas(df: DataFrame, quotas: DataFrame, group: str, key: str, seed: int, large: int = 100_000) -> DataFrame:
    """As many drawn rows of every group as ``quotas`` (``group``, ``quota``, a group once) has for it; a group without one gives
    none.

    Of a group with more than ``large`` rows, only those are ranked whose draw lies below a bound that keeps the quota and ten
    standard deviations; where that leaves too few (equal keys draw alike), all of the group are ranked.
    """
    rank, drawn, n, bound, quota, kept = free(df, "_rank", "_draw", "_n", "_bound", "_quota", "_kept")
    told = quotas.where("quota > 0").select(group, F.col("quota").alias(quota))
    sizes = df.join(small(told), group, "left_semi").groupBy(group).agg(F.count("*").alias(n)).join(told, group)
    whole = F.lit(1 << 60)
    some = F.ceil((F.col(quota) + 10 * F.sqrt(quota) + 100) / F.col(n) * float(1 << 60)).cast("bigint")
    sizes = written(sizes.withColumn(bound, F.when(F.col(n) <= large, whole).otherwise(F.least(whole, some))), "sample-bounds")
    draws = df.withColumn(drawn, draw(F.col(key), seed))
    if not sizes.where(F.col(bound) < whole).isEmpty():
        few = draws.join(small(sizes.select(group, bound, n, quota)), group).where((F.col(drawn) < F.col(bound)) & (F.col(bound) < whole))
        enough = few.groupBy(group).agg(F.count("*").alias(kept), F.first(quota).alias(quota), F.first(n).alias(n)).where(F.col(kept) >= F.least(quota, n)).select(group, F.lit(True).alias(kept))
        sizes = sizes.join(enough, group, "left").withColumn(bound, F.when(F.col(kept), F.col(bound)).otherwise(whole))
    ranked = draws.join(small(sizes.select(group, bound, quota)), group).where(F.col(drawn) < F.col(bound)).withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(drawn, key)))
    return ranked.where(F.col(rank) <= F.col(quota)).select(*all_columns(df))


def budgeted_mix(domain: DataFrame, general: DataFrame, ratio: float, order_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The domain's texts whole, and general ones in order until their tokens are ``ratio`` of the mix; with ``part``
    and ``tokens``. Null and empty texts go.

    Tables that have ``tokens`` are taken to hold counted, filled texts: so ids and tokens can be written once, mixed, and
    the texts joined to the result.
    """
    if not 0 <= ratio < 1:
        raise ValueError("the ratio is at least 0 and less than 1")
    counted = lambda d: d if "tokens" in d.columns else d.where(F.col(text_col) != "").withColumn("tokens", estimate_tokens(F.col(text_col)))
    kept = counted(domain)
    total = kept.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    limit = int(total * ratio / (1 - ratio))
    filler = counted(general)
    filler = budget_cut(filler, F.col("tokens"), limit, order_col) if limit > 0 else filler.limit(0)
    return kept.withColumn("part", F.lit("domain")).unionByName(filler.withColumn("part", F.lit("general")))


def composition(df: DataFrame, group: str, tokens: str = "tokens") -> DataFrame:
    """Rows and tokens of every group and of all (group null), and the group's share of the tokens."""
    told = df.rollup(group).agg(F.count("*").alias("n_docs"), F.sum(tokens).alias("tokens"), F.grouping(group).alias("is_total"))
    # the total's own row has the sum, so the table is read once
    whole = F.max(F.when(F.col("is_total") == 1, F.col("tokens"))).over(Window.partitionBy())
    return told.withColumn("share", F.round(F.col("tokens") / whole, 4))
