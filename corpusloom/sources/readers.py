"""Readers: JSON lines with limits and quarantine, CSV, dictionaries, XML and whole files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.records import parse_articles
from corpusloom.functions.text import estimate_tokens
from corpusloom.operators.joins import last_wins
from corpusloom.operators.order import budget_cut

#: Where a line that is no record is kept.
CORRUPT = "_corrupt_record"


def json_lines(spark: SparkSession, path: str, schema: str, keep_corrupt: bool = False) -> DataFrame:
    """Records of JSON lines; blank lines don't count. Malformed lines go, or are kept in ``_corrupt_record``.

    Compressed files are read by their ending (gzip, bzip2, zstandard).
    """
    if not keep_corrupt:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    wide = T.StructType.fromDDL(schema).add(CORRUPT, T.StringType())
    return spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def quarantined(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records, and the malformed lines. The reader needs all columns at once, so the flag is computed first."""
    good = records.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, records.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def raw_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every filled line as ``value`` with ``record``, which is null where the line is malformed: such lines stay."""
    return spark.read.text(path).where(F.trim("value") != "").withColumn("record", F.from_json("value", schema, {"mode": "PERMISSIVE"}))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with ``line_no`` from 0 in the order of one file, by prefix sums over partitions."""
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    counts = lines.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    base = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = lines.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(base), "part")
    return placed.select((F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("line_no"), "value")


def corpus(spark: SparkSession, path: str, tag: str, limit: int | None = None, order_col: str | None = None) -> DataFrame:
    """Filled texts with their source's tag, up to a budget of tokens in the order of a column of the file."""
    schema = "text string" + (f", {order_col} bigint" if order_col else "")
    texts = json_lines(spark, path, schema).where(F.col("text") != "").withColumn("source", F.lit(tag))
    if limit is None:
        return texts
    if order_col is None:
        raise ValueError("a limit needs a column to order by")
    return budget_cut(texts, estimate_tokens(F.col("text")), limit, order_col)


def csv_table(spark: SparkSession, path: str, schema: str, skip_bad: bool = False) -> DataFrame:
    """A CSV file with a header, quoted line ends and doubled quotes; bad lines go, or stay with nulls."""
    mode = "DROPMALFORMED" if skip_bad else "PERMISSIVE"
    return spark.read.schema(schema).options(header=True, multiLine=True, escape='"', mode=mode).csv(path)


def csv_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All CSV files of a folder; unreadable ones go."""
    return spark.read.schema(schema).options(header=True, ignoreCorruptFiles=True, escape='"').csv(path)


def dictionary(spark: SparkSession, path: str, key: str, value: str, order: str | None = None) -> DataFrame:
    """Filled pairs of a (gzipped) CSV file, stripped; the last pair of a key wins, by the order column or by place."""
    table = spark.read.options(header=True, escape='"').csv(path)
    told = table.select(F.trim(key).alias(key), F.trim(value).alias(value), (F.col(order) if order else F.monotonically_increasing_id()).alias("_at"))
    return last_wins(told.where((F.col(key) != "") & (F.col(value) != "")), key, value, "_at")


def screened(table: DataFrame, test: Column, most: int | None = None) -> DataFrame:
    """Rows that pass, ``most`` at the most."""
    kept = table.where(test)
    return kept if most is None else kept.limit(most)


def documents_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Whole JSON documents: an array gives a row for each element."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def existing_ids(spark: SparkSession, path: str, least_bytes: int = 100) -> DataFrame:
    """Names, without endings, of the files of a folder that have more than a few bytes; their contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length").where(F.col("length") > least_bytes).select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("id"))


def subset(spark: SparkSession, path: str, name: str, split: str = "train") -> DataFrame:
    """One subset and split of a table written by ``subset`` and ``split``; only its files are read."""
    return spark.read.parquet(path).where((F.col("subset") == name) & (F.col("split") == split)).drop("subset", "split")


def articles(spark: SparkSession, path: str) -> DataFrame:
    """The articles of a folder of XML files, sorted by their ids."""
    return parse_articles(xml_files(spark, path)).orderBy("pmcid")


def xml_files(spark: SparkSession, path: str) -> DataFrame:
    """Every XML file's name and content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+?)\.xml$", 1).alias("name"), "content")


def first_that_exists(spark: SparkSession, *paths: str) -> str | None:
    """The first of the paths that exists, in whatever file system."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return p
    return None


def trainer_logs(spark: SparkSession, path: str) -> DataFrame:
    """Steps with loss and rate of every run's newest state file below ``path/run/[checkpoint-n/]trainer_state.json``; a file
    beside the checkpoints counts before them."""
    entry = "array<struct<step int, loss double, learning_rate double>>"
    states = spark.read.schema(f"log_history {entry}").options(multiLine=True, recursiveFileLookup=True, pathGlobFilter="trainer_state.json").json(path)
    file = F.input_file_name()
    told = states.select(F.regexp_extract(file, r"([^/]+)/(?:checkpoint-\d+/)?trainer_state\.json$", 1).alias("run"), F.regexp_extract(file, r"checkpoint-(\d+)/", 1).alias("at"), "log_history")
    newest = told.groupBy("run").agg(F.max_by("log_history", F.when(F.col("at") == "", F.lit(2**62)).otherwise(F.expr("try_cast(at AS BIGINT)"))).alias("log"))
    return newest.select("run", F.explode("log").alias("e")).select("run", "e.step", "e.loss", "e.learning_rate")
