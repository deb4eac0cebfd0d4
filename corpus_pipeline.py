"""The corpus pipeline: four stages, each written as Parquet and read again as the next one's documents.

1. ``toxicity`` rejects documents that any severity grade over 0 is likelier for than not.
2. ``near_duplicates`` keeps one document of each class of near duplicates (the smallest id).
3. ``mixing`` draws the sources to their target weights; a document may stand several times, or cut where a target falls.
4. ``sentencepiece`` encodes every text, and checks by decoding that the ids give it back.

All but the last return the columns of ``documents``. Defined results: null and empty texts are clean, alike among themselves
only, never drawn by the mix, and so don't reach the end; null ids and null sources are kept; rows that repeat id and text are
one document behind the second stage; of ties for the smallest id any copy stays, as their texts are alike; texts of any
length are read whole and may be cut by the mix only; columns of any other names, clashing ones too, go along through the
first three stages; an empty table gives an empty result. The third stage needs the column ``n_chars``, which follows a text that is
cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.columns import all_columns
from corpusloom.llm import jaccard, mixing, pieces, toxicity
from corpusloom.llm.catalog import PIECES_PATH, table
from corpusloom.session import written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the model, fitted on this input's labelled ones, takes for toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.where(F.col(scored.columns[-1]) < 0.5).select(*all_columns(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard.one_of_each(docs, jaccard.near_duplicates(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; ``n_chars`` follows the text where a document is cut."""
    mix = mixing.mixed(docs).select("row.*")
    return mix.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*all_columns(docs))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids, their number, and whether decoding them gives the text back."""
    columns = docs.select(F.struct("doc_id", "lang", "source", F.sha2(F.encode(F.replace(F.coalesce("text", F.lit("")), F.lit(pieces.MARK), F.lit(" ")), "UTF-8"), 256).alias("digest")).alias("row"), "text")
    decoded = pieces.encode(columns, PIECES_PATH, id_col="row", decoded=True)
    same = F.col("id.digest") == F.sha2(F.encode("text", "UTF-8"), 256)
    return decoded.select("id.doc_id", "id.lang", "id.source", "ids", F.size("ids").cast("bigint").alias("n_tokens"), same.alias("exact"))


STAGES = [("toxicity", reject_toxic), ("near_duplicates", keep_one_of_each), ("mixing", mix_sources), ("sentencepiece", encode_texts)]

#: SQL has neither the fitted model nor the drawn order; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, the tables between them in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
