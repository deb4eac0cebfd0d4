"""Token counts for every context limit from one exact histogram of encoded lengths.

Each task encodes its texts and counts lengths; the counts are summed into one row for each distinct length, whose
number is bounded by the longest text, not by the number of texts. Running sums over that histogram then answer
totals, quantiles and truncated totals for every limit without looking at a text again.

Defined results: a null or empty text has length 0 and is counted; a text of any length is encoded whole, by the task that
holds it; texts of one length share a row, and repeated rows count each; an empty table gives an empty histogram. Only the
text column is read, so other columns may have any names.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.batches import bounded
from corpusloom.session import spread

#: Fixed value: how the byte-level vocabulary cuts texts before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary whose ranks the file holds."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def length_histogram(docs: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """``length`` and ``n_docs``: how many texts have each encoded length."""
    bounded(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = encoding(ranks_path), Counter()
        for batch in batches:
            for text in batch.column(0):
                found[len(known.encode_ordinary(text.as_py() or ""))] += 1
        if found:
            yield pa.record_batch([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["length", "n_docs"])

    each = spread(docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))).mapInArrow(run, "length bigint, n_docs bigint")
    return each.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def limits(histogram: DataFrame) -> DataFrame:
    """For each length as a context limit: texts and tokens up to it and over it, the total of all texts cut at it,
    and the share of texts that fit. Between two lengths of the histogram, the lower row's sums hold."""
    upto = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    tokens = F.col("length") * F.col("n_docs")
    return histogram.select(
        "length",
        "n_docs",
        tokens.alias("tokens"),
        F.sum("n_docs").over(upto).alias("docs_upto"),
        F.sum(tokens).over(upto).alias("tokens_upto"),
        F.sum("n_docs").over(whole).alias("docs"),
        F.sum(tokens).over(whole).alias("all_tokens"),
    ).select(
        "length",
        "n_docs",
        "tokens",
        "docs_upto",
        "tokens_upto",
        (F.col("docs") - F.col("docs_upto")).alias("docs_over"),
        (F.col("all_tokens") - F.col("tokens_upto")).alias("tokens_over"),
        (F.col("tokens_upto") + F.col("length") * (F.col("docs") - F.col("docs_upto"))).alias("truncated_total"),
        (F.col("docs_upto") / F.col("docs")).alias("share"),
    )


def truncated_total(limit: int) -> Column:
    """Aggregate over a histogram: tokens of all texts, each cut at the limit."""
    return F.coalesce(F.sum(F.least(F.col("length"), F.lit(limit)) * F.col("n_docs")), F.lit(0))


def quantile(table: DataFrame, q: float) -> DataFrame:
    """The least length that a share ``q`` of the texts doesn't exceed, from the rows of ``limits``; null if there are none."""
    return table.where(F.col("share") >= q).agg(F.min("length").alias("length"))
