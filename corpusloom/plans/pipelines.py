"""Whole steps made of the operators: cleaning, merging, auditing, instruction sets, evaluation and reliability."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.columns import free
from corpusloom.functions import lexicon as L
from corpusloom.functions import parse as P
from corpusloom.functions import text as T
from corpusloom.operators import joins, neardup, order, retrieval, sampling, stats
from corpusloom.operators.neardup import jaccard
from corpusloom.session import written
from corpusloom.sources import sinks


def clean_works(works: DataFrame, clean: Column, title_keys: Column, order_col: str, earlier: DataFrame | None = None) -> DataFrame:
    """Works with a title, in English or unknown language, each identifier and then each title once (the first in order;
    null identifiers don't count, empty title keys do), not among ``earlier`` ones, with cleaned abstract, ``quality``
    and ``tier``."""
    kept = works.where(F.col("title").isNotNull() & (F.coalesce(F.col("language"), F.lit("en")) == "en"))
    kept = order.keep_first(kept, ["doi"], [order_col]).withColumn("_title", title_keys)
    kept = order.keep_first(kept, ["_title"], [order_col]).drop("_title")
    if earlier is not None:
        kept = joins.unseen(kept, earlier, T.doi_key(F.col("doi")), T.doi_key(F.col("doi")))
    quality = T.abstract_quality(F.col("abstract"))
    # an abstract under 50 characters is broken and goes
    return kept.withColumn("abstract", clean).withColumn("quality", quality).withColumn("abstract", F.when(F.char_length("abstract") >= 50, F.col("abstract"))).withColumn("tier", T.tier(F.col("cited_by_count")))


def with_full_text(works: DataFrame, mapping: DataFrame, texts: DataFrame, least: int = 500, least_abstract: int = 100) -> tuple[DataFrame, DataFrame]:
    """Works with a long full text (by identifier and corpus id), and the others that have an abstract."""
    ids = mapping.select("doi", F.expr("cast(try_cast(corpus_id AS DOUBLE) AS BIGINT)").cast("string").alias("corpus_id"))
    mapped = works.join(ids, "doi", "left")
    full = mapped.join(texts.where(F.char_length("full_text") > least).select("corpus_id", "full_text"), "corpus_id")
    rest = works.join(full.select("doi").distinct(), "doi", "left_anti").where(F.char_length("abstract") > least_abstract)
    return full, rest


def merge_sources(main: DataFrame, more: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``main`` (``doi``, ``title_key``, ``text``) and those of ``more`` (``pmcid``, ``title_key``, ``text``) that it lacks by
    identifier or title; and one row of counts."""
    known = joins.lookup(more, mapping.withColumnRenamed("doi", "mapped"), "pmcid", "mapped", "")
    told = joins.cascade_reasons(known, main, [("doi", T.doi_key(F.col("mapped")), T.doi_key(F.col("doi"))), ("title", F.col("title_key"), F.col("title_key"))])
    fresh = told.where("reason IS NULL")
    both = main.select("text", F.lit(0).alias("branch")).unionByName(fresh.select("text", F.lit(1).alias("branch")))
    counts = told.agg(F.count("*").alias("total"), F.count_if(F.col("mapped") != "").alias("found"), F.count_if(F.col("reason") == "doi").alias("removed_doi"), F.count_if(F.col("reason") == "title").alias("removed_title"), F.count_if(F.col("reason").isNull()).alias("kept"))
    return both, counts


def clean_corpus(texts: DataFrame, least: int = 500) -> DataFrame:
    """Texts after the cleaning of bodies, those that are long enough still, with ``modified``."""
    cleaned = T.clean_full_text(F.col("text"))
    return texts.withColumn("_clean", cleaned).withColumn("modified", F.col("_clean") != F.col("text")).where(F.char_length("_clean") >= least).withColumn("text", F.col("_clean")).drop("_clean")


def purity_audit(records: DataFrame, quartiles: DataFrame, pattern: str, key: str, sample: int, seed: int) -> DataFrame:
    """Of every quartile of venues (unknown ones too): records, drawn ones, and how many of these match the pattern in
    title, venue or keywords."""
    fields = records.select(key, *[T.header_field(F.col("text"), f).alias(f.lower()) for f in ("Title", "Venue", "Keywords")])
    tiers = joins.lookup(fields, quartiles, "venue", "quartile", "unknown")
    totals = tiers.groupBy("quartile").agg(F.count("*").alias("n"))
    match = F.concat_ws(" ", "title", "venue", "keywords").rlike(f"(?i){pattern}")
    drawn = sampling.sample_n(tiers, ["quartile"], key, sample, seed).groupBy("quartile").agg(F.count("*").alias("drawn"), F.count_if(match).alias("matched"))
    return totals.join(drawn, "quartile").withColumn("purity", F.round(100 * F.col("matched") / F.col("drawn"), 1))


def instruction_set(pairs: DataFrame, key: str, trivial: Sequence[str], threshold: float | None = 0.8) -> DataFrame:
    """Pairs (``instruction``, ``output``, ``type``) with ``reason``: duplicate, a quality reason, near_duplicate, or null for
    those that stay; types are normalised. Without a threshold, near duplicates stay."""
    instruction, output = T.strip(F.col("instruction")), T.strip(F.col("output"))
    reason = (
        F.when(F.char_length(instruction) < 20, "instruction_too_short")
        .when(F.char_length(output) < 100, "output_too_short")
        .when(F.char_length(output) > 5000, "output_too_long")
        .when(L.any_substring(instruction, trivial), "trivial_question")
    )
    pairs = pairs.where(F.col("instruction").isNotNull())
    first = pairs.groupBy(F.lower(instruction).alias("_k")).agg(F.min(key).alias("_first")).select("_first", F.xxhash64("_k").alias("_same"))
    if threshold is not None:
        # used twice; merged, so that rows are dealt out for the signatures of their instructions, however few files the table has
        first = written(first, "instruction-firsts").hint("merge")
    # a row is the first of its instruction if its key is; joined by keys, as many rows may say the same, and texts don't move for it;
    # reasons are found before the join, so texts that aren't asked for don't move either
    told = pairs.withColumn("_h", F.xxhash64(F.lower(instruction))).withColumn("_reason", reason).withColumn("type", T.question_type(F.col("type")))
    told = told.join(first, (F.col(key) == F.col("_first")) & (F.col("_h") == F.col("_same")), "left")
    told = told.withColumn("reason", F.when(F.col(key).isNotNull() & F.col("_first").isNull(), "duplicate").otherwise(F.col("_reason"))).drop("_h", "_same", "_first", "_reason")
    if threshold is None:
        return told
    stay = neardup.greedy_survivors(told.where("reason IS NULL"), key, "instruction", threshold).select(F.col("id").alias("_id"), F.lit(True).alias("_stays"))
    marked = told.join(stay, F.col(key) == F.col("_id"), "left")
    return marked.withColumn("reason", F.coalesce("reason", F.when(F.col("_stays").isNull(), "near_duplicate"))).drop("_id", "_stays")


def funnel(told: DataFrame) -> DataFrame:
    """Rows by reason, ``kept`` for those without."""
    return told.groupBy(F.coalesce("reason", F.lit("kept")).alias("step")).agg(F.count("*").alias("n"))


def chat_mix(sources: dict[str, tuple[DataFrame, int]], key: str, seed: int) -> DataFrame:
    """Drawn first turns of several chat sources (``messages``), each up to its quota, that pass the gate; with ``source``."""
    parts = []
    for name, (chats, quota) in sources.items():
        turns = sampling.sample_n(chats, [], key, quota, seed).select(key, P.first_turn(F.col("messages")).alias("t"))
        parts.append(turns.where(P.chat_gate(F.col("t"))).select(key, "t.instruction", "t.input", "t.output", F.lit(name).alias("source")))
    return reduce(DataFrame.unionByName, parts)


def rescored(results: DataFrame, questions: DataFrame) -> DataFrame:
    """Stored replies (``id``, ``raw_output``, ``correct``) scored anew against their questions (``id``, ``answer`` letters,
    ``options`` letters, ``category``): ``predicted`` and ``was_correct``, ``correct``."""
    both = results.withColumnRenamed("correct", "was_correct").join(joins.small(questions), "id")
    predicted = P.answer_letters(F.col("raw_output"), F.col("options"))
    right = F.array_join(F.array_sort(F.array_distinct("answer")), "")
    return both.withColumn("predicted", predicted).withColumn("correct", F.col("predicted") == right)


def few_shot(questions: DataFrame, example_ids: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Examples, and the questions left to evaluate; a question without an id is no example."""
    chosen = F.coalesce(F.col("id").isin(list(example_ids)), F.lit(False))
    return questions.where(chosen), questions.where(~chosen)


def exam_prompts(questions: DataFrame, instruction: str, example_ids: Sequence[int] = ()) -> DataFrame:
    """``id`` and ``prompt`` of every question (``id``, ``question``, ``options``, ``answer``) that is no example, behind the examples
    in the order of their ids as given."""
    shown, left = few_shot(questions, example_ids)
    if not example_ids:
        return left.select("id", P.exam_prompt(instruction, F.col("question"), F.col("options")).alias("prompt"))
    place = F.array_position(F.array(*[F.lit(i) for i in example_ids]), F.col("id"))
    solved = shown.select(F.struct(place.alias("o"), P.solved_example(F.col("question"), F.col("options"), F.col("answer")).alias("e")).alias("x"))
    examples = solved.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["e"]).alias("examples"))  # as many as ids are given
    asked = left.crossJoin(F.broadcast(examples))  # one row
    return asked.select("id", P.exam_prompt(instruction, F.col("question"), F.col("options"), F.col("examples")).alias("prompt"))


def retrieval_prompts(questions: DataFrame, hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Prompts with the passages of every question (``hits``: ``query_id``, ``chunk_id``, ``score``, ``rank``), the best score and the
    number of passages."""
    told = hits.join(chunks.select("chunk_id", "text"), "chunk_id").groupBy(F.col("query_id").alias("id"))
    passages = told.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]).alias("passages"), F.max("score").alias("top_passage_score"), F.count("*").alias("num_passages"))
    return questions.join(passages, "id", "left").select("id", P.question_prompt(F.col("question"), F.col("options"), F.coalesce("passages", F.array())).alias("prompt"), "top_passage_score", F.coalesce("num_passages", F.lit(0)).alias("num_passages"))


def hit_rates(picks: DataFrame, pool: DataFrame) -> DataFrame:
    """Of every model, over its runs' picks (``model``, ``run``, ``idx``, a row for each), the mean share of picked candidates
    (``idx``, ``objective``) in the upper quarter and tenth, how often the best is among them, and the share that chance gives."""
    levels = stats.percentiles(pool, [], "objective", {"q75": 0.75, "q90": 0.9, "top": 1.0})
    known = pool.crossJoin(F.broadcast(levels))  # one row
    chance = known.agg(F.avg((F.col("objective") >= F.col("q75")).cast("double")).alias("chance"))
    each = picks.select("model", "run", "idx").join(joins.small(known), "idx").groupBy("model", "run").agg(
        F.avg((F.col("objective") >= F.col("q75")).cast("double")).alias("t25"), F.avg((F.col("objective") >= F.col("q90")).cast("double")).alias("t10"), F.max((F.col("objective") == F.col("top")).cast("double")).alias("best")
    )
    told = each.groupBy("model").agg(F.avg("t25").alias("top25_mean"), F.avg("t10").alias("top10_mean"), F.avg("best").alias("hit_best_rate"), F.count("*").alias("n_runs"))
    return told.crossJoin(F.broadcast(chance))


def stability(runs: DataFrame) -> DataFrame:
    """Of every model with several runs the mean similarity of two runs' selections (a model's runs are few)."""
    a, b = runs.select("model", F.col("run").alias("i"), F.col("selected").alias("x")), runs.select("model", F.col("run").alias("j"), F.col("selected").alias("y"))
    return a.join(b, "model").where("i < j").groupBy("model").agg(F.avg(jaccard(F.col("x"), F.col("y"))).alias("mean_similarity"))


def stable_picks(runs: DataFrame) -> DataFrame:
    """Candidates that more than half of a model's runs select."""
    picks = runs.select("model", "run", F.explode("selected").alias("idx")).groupBy("model", "idx").agg(F.count("*").alias("n"))
    return picks.join(runs.groupBy("model").agg(F.countDistinct("run").alias("runs")), "model").where("n > runs / 2").select("model", "idx", "n")


def accepted(confidence: Column, threshold: float = 2) -> Column:
    """``accept`` for a confidence above the threshold, else (null too) ``fallback``."""
    return F.when(confidence > threshold, "accept").otherwise("fallback")


def trajectory_metrics(runs: DataFrame, best: float) -> DataFrame:
    """Of every trajectory (``method``, ``repeat``, ``round``, ``best``): rounds to 90 and 95 % of the best, and the final best;
    summarised by method as means and population deviations."""
    level = lambda share: F.coalesce(F.min(F.when(F.col("best") >= share * best, F.col("round"))), F.count("*")).cast("double")
    each = runs.groupBy("method", "repeat").agg(level(0.9).alias("r90"), level(0.95).alias("r95"), F.max_by("best", "round").alias("final"))
    return each.groupBy("method").agg(*[f(c).alias(f"{c}_{n}") for c in ("r90", "r95", "final") for n, f in (("mean", F.avg), ("sd", F.stddev_pop))])


def loss_curve(log: DataFrame, most: int = 2000) -> DataFrame:
    """Steps with losses of every run, thinned to about ``most`` points."""
    losses = log.where("loss IS NOT NULL AND step IS NOT NULL")
    run = Window.partitionBy("run")
    placed = losses.withColumn("_at", F.row_number().over(run.orderBy("step")) - 1).withColumn("_n", F.count("*").over(run))
    return placed.where(F.col("_at") % F.greatest(F.lit(1), F.floor(F.col("_n") / most)) == 0).select("run", "step", "loss")


def loss_summary(log: DataFrame) -> DataFrame:
    """Best and last loss of every run."""
    return log.where("loss IS NOT NULL").groupBy("run").agg(F.min("loss").alias("best_loss"), F.max_by("loss", "step").alias("last_loss"), F.max("step").alias("last_step"))


def summary_matrix(results: DataFrame, row: str, column: str, value: str, columns: Sequence[str]) -> DataFrame:
    """A row for every model, a column for every test, and the names of the tests at which the model is best."""
    wide = results.groupBy(row).pivot(column, list(columns)).agg(F.max(value))
    best = [F.when(F.col(f"`{c}`") == F.max(f"`{c}`").over(Window.partitionBy()), F.lit(c)) for c in columns]
    return wide.withColumn("best_at", F.concat_ws(",", *best))


def group_quota(df: DataFrame, key: str, group_order: str, row_order: str, quota: int) -> DataFrame:
    """New keys in the order of groups until the quota is full; a large group is placed by ranges of the row order."""
    fresh = order.keep_first(df, [key], [group_order, row_order])
    (n,) = free(df, "_n")
    return order.running_sum(fresh, F.lit(1), group_order, (row_order,), n).where(F.col(n) <= quota).drop(n)


def start_metrics(starts: DataFrame, pool: DataFrame) -> DataFrame:
    """Of every method, over its repeats' first picks (``method``, ``repeat``, ``idx``, a row for each), means and population deviations
    of their mean objective and of their share in the upper quarter of the pool (``idx``, ``objective``)."""
    level = stats.percentiles(pool, [], "objective", {"q75": 0.75})
    known = pool.select("idx", "objective").crossJoin(F.broadcast(level))  # one row
    each = starts.join(joins.small(known), "idx").groupBy("method", "repeat").agg(F.avg("objective").alias("init_quality"), F.avg((F.col("objective") >= F.col("q75")).cast("double")).alias("top_quartile"))
    return each.groupBy("method").agg(*[f(c).alias(f"{c}_{n}") for c in ("init_quality", "top_quartile") for n, f in (("mean", F.avg), ("sd", F.stddev_pop))], F.count("*").alias("n_repeats"))


def general_mix(sources: dict[str, tuple[Callable[[], DataFrame], int]], key: str, seed: int, path: str) -> DataFrame:
    """Drawn first turns of several chat sources in one drawn order, written as training rows (``path/train``) and with all columns
    (``path/full``); a row for each source: its quota, how many rows it gave, and the error for which it was skipped.

    A source is read in whole before it joins the mix, so one that fails leaves the others as they are. ``place`` is a row's place in
    the order, and files hold ranges of places.
    """
    parts, told = [], []
    for name, (load, quota) in sources.items():
        try:
            part = written(chat_mix({name: (load(), quota)}, key, seed), "mix-source")
            told.append((name, quota, part.count(), None))
            parts.append(part)
        except (PySparkException, Py4JJavaError, OSError, ValueError) as e:
            told.append((name, quota, 0, type(e).__name__))
    if not parts:
        raise ValueError("no source could be read")
    mix = reduce(DataFrame.unionByName, parts).withColumn("_draw", sampling.draw(F.concat_ws("/", "source", F.col(key).cast("string")), seed))
    placed = order.running_sum(mix, F.lit(1), "_draw", ("source", key), "place").drop("_draw")
    sinks.write_both(placed.repartitionByRange("place").sortWithinPartitions("place"), path, ["instruction", "input", "output"])
    return mix.sparkSession.createDataFrame(told, "source string, quota int, n bigint, error string")


def retrieval_evaluation(questions: DataFrame, queries: DataFrame, candidates: DataFrame, chunks: DataFrame, replies: Callable[[DataFrame, DataFrame], DataFrame], k: int) -> DataFrame:
    """From vectors to a scored answer for every question (``id``, ``question``, ``options``, ``answer``, ``category``): the k nearest
    chunks, the prompt with their texts, the reply to it and whether it is right.

    ``replies`` gives ``id`` and ``raw_output`` for the prompts and their hits: stored ones, or those of a model.
    """
    hits = written(retrieval.top_k(queries, candidates, k), "evaluation-hits").withColumnRenamed("vec_id", "chunk_id")
    prompts = written(retrieval_prompts(questions, hits, chunks), "evaluation-prompts")
    letters = questions.select("id", "answer", F.array_sort(F.map_keys("options")).alias("options"), "category")
    results = replies(prompts, hits).select("id", "raw_output").withColumn("correct", F.lit(False))
    return rescored(results, letters).drop("was_correct").join(prompts, "id")
