"""Writers: JSON lines, projections, splits, groups, statistics, upserts and versions."""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.session import written


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines in UTF-8."""
    df.write.mode("errorifexists").json(path)


def write_both(df: DataFrame, path: str, training: list[str]) -> None:
    """The training columns under ``path/train`` and all columns under ``path/full``; the rows are computed once."""
    rows = written(df, "sink")
    write_json(rows.select(*training), f"{path}/train")
    write_json(rows, f"{path}/full")


def write_split(df: DataFrame, path: str, column: str) -> None:
    """A folder for each value of the column: decisions, splits or groups."""
    df.write.mode("errorifexists").partitionBy(column).json(path)


def write_csv(df: DataFrame, path: str, mark: bool = False) -> None:
    """CSV with a header and doubled quotes; with a byte order mark before it on demand, as spreadsheets want it."""
    named = df.withColumnRenamed(df.columns[0], f"\ufeff{df.columns[0]}") if mark else df
    named.write.mode("errorifexists").options(header=True, escape='"').csv(path)


def write_texts(df: DataFrame, path: str, text_col: str = "text") -> None:
    """Plain texts, each behind a line of forty equals signs."""
    df.select(F.concat(F.lit("=" * 40 + "\n"), F.col(text_col)).alias("value")).write.mode("errorifexists").text(path)


def statistics(df: DataFrame) -> DataFrame:
    """One row of numbers as rows of ``metric`` and ``value``."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns])).alias("s")).select("s.*")


def upsert(df: DataFrame, path: str, key: str) -> None:
    """Replace the partitions of the keys that ``df`` has and leave the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def as_document(df: DataFrame, key: str, field: str = "results") -> DataFrame:
    """One row ``document``: a JSON object whose field has an entry for each key, with the other columns; for tables of few
    keys, such as models, that ``upsert`` keeps up to date."""
    entry = F.struct(F.col(key).cast("string").alias("k"), F.struct(*[F.col(c) for c in df.columns if c != key]).alias("v"))
    return df.agg(F.to_json(F.struct(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(field))).alias("document"))


def report(statistics: DataFrame) -> DataFrame:
    """The rows of ``statistics`` as lines of a text report, in ``line``, names padded to one width."""
    width = 40
    return statistics.select(F.concat(F.rpad("metric", width, "."), F.lit(" "), F.format_string("%,.2f", "value")).alias("line"))


def write_counted(df: DataFrame, path: str, counters: dict[str, Column], by: str | None = None) -> DataFrame:
    """Write JSON lines (a folder for each value of ``by``, if given) and give the counters, aggregates over the rows written, as one row.

    They are gathered by the tasks that write, so neither the input nor the output is read for them."""
    told = Observation()
    observed = df.observe(told, *[c.alias(name) for name, c in counters.items()])
    writer = observed.write.mode("errorifexists")
    (writer.partitionBy(by) if by else writer).json(path)
    found = told.get
    kinds = df.agg(*[c.alias(name) for name, c in counters.items()]).schema
    return df.sparkSession.createDataFrame([tuple(found[name] for name in counters)], kinds)


def _linked(target: str, content: str) -> bool:
    """Put a local file there as a whole unless there is one: a link fails if its name is taken, whoever took it."""
    os.makedirs(os.path.dirname(target), exist_ok=True)
    own = f"{target}.{uuid.uuid4().hex}"
    with open(own, "w") as f:
        f.write(content)
    try:
        os.link(own, target)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(own)


def _renamed(spark: SparkSession, path: str, content: str) -> bool:
    """The same on any file system of Spark, by a rename that doesn't replace: the file system's master decides."""
    hadoop, settings = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    at, own = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    fs = at.getFileSystem(settings)
    out = fs.create(own, False)
    out.write(bytearray(content.encode()))
    out.close()
    try:
        hadoop.FileContext.getFileContext(at.toUri(), settings).rename(own, at, spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
        return True
    except Py4JJavaError:
        if not fs.exists(at):
            raise
        fs.delete(own, False)
        return False


def _only_once(spark: SparkSession, path: str, content: str) -> bool:
    """Put a file there as a whole unless there is one; whether it was put. Of several writers one succeeds."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    local = at.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"  # whose renames replace
    return _linked(at.toUri().getPath(), content) if local else _renamed(spark, path, content)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the whole versions of a table, ascending; the last is the current one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{path}/_versions")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n) for n in names if n.isdigit())


def next_version(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Write a new version of a table and make it the current one; its number.

    The rows go to a folder that no other writer has, the manifest names its files, and the version's number is taken last, by a
    step that only one writer can do; another one takes the next number. So two writers leave two whole versions, a failed one
    leaves the current version as it was, and readers of older versions find theirs unchanged.
    """
    data = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{data}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{path}/{data}")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    files = sorted(f.getPath().getName() for f in found if f.getPath().getName().endswith(".parquet"))
    manifest = json.dumps({"folder": data, "files": files, "schema": df.schema.jsonValue()})
    n = (versions(spark, path) or [-1])[-1] + 1
    while not _only_once(spark, f"{path}/_versions/{n}", manifest):
        n += 1
    return n


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A version of a table, the current one without a number: the files that its manifest names, whatever is written later."""
    known = versions(spark, path)
    if not known or number is not None and number not in known:
        raise ValueError(f"{path} has no version {number if known else ''}".rstrip())
    manifest = json.loads("\n".join(r.value for r in spark.read.text(f"{path}/_versions/{known[-1] if number is None else number}", wholetext=True).collect()))
    schema = StructType.fromJson(manifest["schema"])
    files = [f"{path}/{manifest['folder']}/{f}" for f in manifest["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def write_index(vectors: DataFrame, path: str) -> None:
    """A vector index: chunks with ids, texts and vectors in the order of ids."""
    vectors.repartitionByRange("id").sortWithinPartitions("id").write.mode("errorifexists").parquet(path)
