"""The pipeline on a small corpus with planted cases, stage by stage, against plain recomputation."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import jaccard, mixing

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(5)
    clean = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        words = rng.choices(clean, k=rng.randrange(30, 120))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(6):
                words[rng.randrange(len(words))] = rng.choice(["vile", "nasty", "foulish"])
        rows.append([i, " ".join(words), "en", f"s{i % 3}"])
        if i < 600:
            labels.append((i, i % 2, int(toxic)))
    for i in range(60):  # near copies of clean documents
        words = rows[2 * i + 1 if (2 * i + 1) % 6 else 2][1].split()
        rows.append([2000 + i, " ".join(words[:-1] + ["changed"]), "en", "s0"])
    rows += [[3000, None, None, None], [3001, "", "en", "s1"], [1, rows[1][1], "en", "s1"], [None, "some text without an id at all", "de", None], [3002, " ".join(rng.choices(clean, k=30_000)), "en", "s2"]]
    path = str(tmp_path_factory.mktemp("pipeline"))
    clashing = "_toxic int, _K int, row string, `a.b` string, size string, pieces string, ids string, class_id string"
    spark.createDataFrame([(i, t, lang, s, len(t or ""), 1, 2, None, "x", "y", "z", "q", None) for i, t, lang, s in rows], f"{DOCS}, {clashing}").repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one = corpus_pipeline.reject_toxic(spark, docs, folder).cache()
    assert one.columns == docs.columns
    ids = {r.doc_id for r in one.collect()}
    toxic = {i for i in range(900) if i % 6 == 0}
    assert len(toxic & ids) <= 2 and len(set(range(900)) - toxic - ids) <= 2 and {2000, 3000, 3001, 3002, None} <= ids
    two = corpus_pipeline.keep_one_of_each(spark, one, folder).cache()
    assert two.columns == docs.columns
    left = two.collect()
    sets = [frozenset(jaccard.shingles(r.text).tolist()) for r in left]
    assert not any(a == b or len(a & b) >= 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    gone = [frozenset(jaccard.shingles(r.text).tolist()) for r in one.collect() if r.doc_id not in {x.doc_id for x in left}]
    assert gone and all(any(a == b or len(a & b) >= 0.8 * len(a | b) for b in sets) for a in gone)
    three = corpus_pipeline.mix_sources(spark, two, folder).cache()
    assert three.columns == docs.columns
    plan = mixing.plan_mix(two).groupBy("source").agg(F.first("target").alias("t")).collect()
    words = {r.source: r.n for r in three.groupBy("source").agg(F.sum(mixing.words(F.col("text"))).alias("n")).collect()}
    assert all(abs(words.get(r.source, 0) - r.t) <= 1 for r in plan)
    assert three.where("n_chars <> char_length(text)").count() == 0
    four = corpus_pipeline.encode_texts(spark, three, folder)
    assert four.count() == three.count() and four.where("NOT exact OR n_tokens <> size(ids)").count() == 0


def test_run_and_rerun(spark, folder):
    key = lambda d: sorted(map(str, d.select("doc_id", "source", "n_tokens", F.xxhash64("ids")).collect()))
    assert key(corpus_pipeline.run(spark, folder)) == key(corpus_pipeline.run(spark, folder))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "mixing", "sentencepiece"]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
