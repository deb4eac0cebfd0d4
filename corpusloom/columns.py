"""Column names that cannot clash, and joins that keep nulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as make it differ from all columns (whatever their case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_columns(df: DataFrame) -> list[Column]:
    """Every column, whatever characters its name has."""
    return [named(c) for c in df.columns]


def kept_if_there(df: DataFrame, names: list[str], renamed: dict[str, str] | None = None) -> DataFrame:
    """Those of the named columns that the table has, in the order of the names, under their new names where given."""
    return df.select(*[named(c).alias((renamed or {}).get(c, c)) for c in names if c in df.columns])


def beside(df: DataFrame, told: DataFrame, keys: list[str], broadcast: bool = False) -> DataFrame:
    """``df`` with the other columns of ``told``, which has a row for each combination of the keys; nulls equal nulls."""
    told = told.withColumnsRenamed(dict(zip(keys, own := free(df, *[f"_on_{k}" for k in keys]), strict=True)))
    told = F.broadcast(told) if broadcast or not keys else told
    if not keys:
        return df.crossJoin(told)  # one row
    same = reduce(lambda a, b: a & b, (named(k).eqNullSafe(named(o)) for k, o in zip(keys, own, strict=True)))
    return df.join(told, same).drop(*own)
