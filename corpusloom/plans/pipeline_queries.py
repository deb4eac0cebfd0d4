"""Queries over whole steps, their inputs put together from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import parse as P
from corpusloom.functions import text as T
from corpusloom.operators import stats as A
from corpusloom.plans import pipelines as PL
from corpusloom.plans.corpus_queries import TURN_SQL
from corpusloom.session import scratch_path
from corpusloom.plans.registry import query, table
from corpusloom.plans.text_queries import TABLES, table_lines_sql, tidy_sql


@query(r"""
WITH w AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE md5(substr(text, 1, 40)) END AS doi, regexp_extract(text, '^[^\n]*') AS title, CASE WHEN lang = 'en' THEN 'en' WHEN lang = 'de' THEN NULL ELSE lang END AS language, text, n_chars FROM documents),
a AS (SELECT * FROM w WHERE language = 'en' OR language IS NULL),
b AS (SELECT * FROM a WHERE doi IS NULL OR doc_id IN (SELECT min(doc_id) FROM a GROUP BY doi)),
k AS (SELECT *, regexp_replace(regexp_replace(lower(trim(title)), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g') AS tk FROM b),
c AS (SELECT * FROM k WHERE doc_id IN (SELECT min(doc_id) FROM k GROUP BY tk))
SELECT doc_id, CASE WHEN length(text) >= 200 THEN 'good' WHEN length(text) >= 50 THEN 'short' ELSE 'none' END AS quality, CASE WHEN n_chars >= 50 THEN 1 WHEN n_chars >= 10 THEN 2 ELSE 3 END AS tier, CASE WHEN length(text) >= 50 THEN md5(text) END AS abstract FROM c
""")
def clean_works(spark, sf_dir):
    """Works cleaned, labelled and each once."""
    docs = table(spark, sf_dir, "documents")
    works = docs.select(
        "doc_id", F.when(F.col("doc_id") % 5 != 0, F.md5(F.substring("text", 1, 40))).alias("doi"), F.regexp_extract("text", r"^[^\n]*", 0).alias("title"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("language"), F.col("text").alias("abstract"), F.col("n_chars").alias("cited_by_count"),
    )
    return PL.clean_works(works, F.col("abstract"), T.title_key(F.col("title")), "doc_id").select("doc_id", "quality", "tier", F.md5("abstract").alias("abstract"))


EARLIER_SQL = """
WITH w AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE md5(substr(text, 1, 40)) END AS doi, regexp_extract(text, '^[^\\n]*') AS title, source FROM documents),
a AS (SELECT * FROM w WHERE source >= 'src2'),
b AS (SELECT * FROM a WHERE doi IS NULL OR doc_id IN (SELECT min(doc_id) FROM a GROUP BY doi)),
k AS (SELECT *, regexp_replace(regexp_replace(lower(trim(title)), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g') AS tk FROM b),
c AS (SELECT * FROM k WHERE doc_id IN (SELECT min(doc_id) FROM k GROUP BY tk))
SELECT doc_id FROM c WHERE doi IS NULL OR doi NOT IN (SELECT doi FROM w WHERE source < 'src2' AND doi IS NOT NULL)
"""


@query(EARLIER_SQL)
def clean_works_next_round(spark, sf_dir):
    """Works of a later round, those of an earlier one left out by their identifiers."""
    docs = table(spark, sf_dir, "documents")
    works = docs.select(
        "doc_id", "source", F.when(F.col("doc_id") % 5 != 0, F.md5(F.substring("text", 1, 40))).alias("doi"), F.regexp_extract("text", r"^[^\n]*", 0).alias("title"),
        F.lit("en").alias("language"), F.col("text").alias("abstract"), F.col("n_chars").alias("cited_by_count"),
    )
    earlier = works.where("source < 'src2'").select(F.upper("doi").alias("doi"))
    return PL.clean_works(works.where("source >= 'src2'"), F.col("abstract"), T.title_key(F.col("title")), "doc_id", earlier).select("doc_id")


MARKED = TABLES + " || '𝐀𝑏𝟗伪尾' || chr(7)"
CLEANED_SQL = tidy_sql(table_lines_sql(f"replace(replace(replace(replace(replace({MARKED}, '尾', 'β'), '伪', 'α'), '𝐀', 'A'), '𝑏', 'b'), '𝟗', '9')"))


@query(f"SELECT doc_id, md5(r) AS digest, r <> ({MARKED}) AS modified FROM (SELECT doc_id, text, {CLEANED_SQL} AS r FROM documents) WHERE length(r) >= 500")
def clean_corpus(spark, sf_dir):
    """Bodies cleaned, those that are long enough still, and whether cleaning changed them."""
    texts = table(spark, sf_dir, "documents").select("doc_id", F.expr(TABLES + " || '𝐀𝑏𝟗伪尾' || chr(7)").alias("text"))
    return PL.clean_corpus(texts).select("doc_id", F.md5("text").alias("digest"), "modified")


@query("""
WITH f AS (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > 3000)
SELECT (SELECT count(*) FROM f) AS n_full, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM f) AND length(o_orderpriority) > 5) AS n_abstract
""")
def full_text_merge(spark, sf_dir):
    """Orders as works: those whose customer gives a full text, and others with a long enough abstract."""
    orders = table(spark, sf_dir, "orders")
    works = orders.select(F.col("o_orderkey").cast("string").alias("doi"), F.col("o_orderpriority").alias("abstract"))
    mapping = orders.select(F.col("o_orderkey").cast("string").alias("doi"), F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("corpus_id"))
    texts = table(spark, sf_dir, "customer").where("c_acctbal > 3000").select(F.col("c_custkey").cast("string").alias("corpus_id"), F.col("c_name").alias("full_text"))
    full, rest = PL.with_full_text(works, mapping, texts, 0, 5)
    return full.agg(F.count("*").alias("n_full")).crossJoin(rest.agg(F.count("*").alias("n_abstract")))


@query("""
WITH m AS (SELECT DISTINCT lower(md5(substr(text, 1, 30))) AS doi, md5(text) AS tk FROM documents WHERE source < 'src15'),
x AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE md5(substr(text, 1, 30)) END AS doi, md5(text) AS tk FROM documents WHERE source >= 'src15'),
r AS (SELECT *, CASE WHEN doi <> '' AND doi IN (SELECT doi FROM m) THEN 'doi' WHEN tk IN (SELECT tk FROM m) THEN 'title' END AS reason FROM x)
SELECT count(*) AS total, count(*) FILTER (doi <> '') AS found, count(*) FILTER (reason = 'doi') AS removed_doi, count(*) FILTER (reason = 'title') AS removed_title, count(*) FILTER (reason IS NULL) AS kept FROM r
""")
def merge_sources(spark, sf_dir):
    """Counts of a merge that drops known identifiers and titles."""
    docs = table(spark, sf_dir, "documents")
    doi, key = F.md5(F.substring("text", 1, 30)), F.md5("text").alias("title_key")
    main = docs.where("source < 'src15'").select(doi.alias("doi"), key, "text")
    more = docs.where("source >= 'src15'").select(F.col("doc_id").alias("pmcid"), key, "text")
    mapping = docs.where("source >= 'src15' AND doc_id % 3 <> 0").select(F.col("doc_id").alias("pmcid"), doi.alias("doi"))
    return PL.merge_sources(main, more, mapping)[1]


@query(r"""
SELECT quartile, n, drawn, matched, round(100 * matched / drawn, 1) AS purity FROM (
  SELECT q AS quartile, count(*) AS n, count(*) FILTER (r <= 100) AS drawn, count(*) FILTER (r <= 100 AND regexp_matches(t, '(?i)(the|der)')) AS matched FROM (
    SELECT q, t, row_number() OVER (PARTITION BY q ORDER BY CAST('0x' || substr(md5(doc_id || '#99'), 1, 15) AS BIGINT), doc_id) AS r FROM (
      SELECT doc_id, CASE WHEN source IN ('src0', 'src1') THEN 'Q1' ELSE 'unknown' END AS q, trim(regexp_extract(text, '^[^\n]*')) AS t FROM documents)) GROUP BY q)
""")
def tiered_audit(spark, sf_dir):
    """Match rates of drawn records by quartile of their venues."""
    record = F.concat(F.lit("Title: "), "text", F.lit("\nVenue: "), "source")
    quartiles = spark.createDataFrame([("src0", "Q1"), ("src1", "Q1")], "venue string, quartile string")
    records = table(spark, sf_dir, "documents").select("doc_id", record.alias("text"))
    return PL.purity_audit(records, quartiles, "(the|der)", "doc_id", 100, 99)


@query(r"""
WITH p AS (SELECT doc_id, regexp_replace(regexp_extract(text, '^[^\n]*'), '^\s+|\s+$', '', 'g') AS i, regexp_replace(text, '^\s+|\s+$', '', 'g') AS o FROM documents),
f AS (SELECT lower(i) AS k, min(doc_id) AS d FROM p GROUP BY 1)
SELECT step, count(*) AS n FROM (
  SELECT CASE WHEN doc_id <> d THEN 'duplicate' WHEN length(i) < 20 THEN 'instruction_too_short' WHEN length(o) < 100 THEN 'output_too_short' WHEN length(o) > 5000 THEN 'output_too_long' WHEN contains(lower(i), 'the re') THEN 'trivial_question' ELSE 'kept' END AS step
  FROM p JOIN f ON lower(i) = k) GROUP BY step
""")
def instruction_funnel(spark, sf_dir):
    """How many pairs each step of the instruction set drops."""
    pairs = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract("text", r"^[^\n]*", 0).alias("instruction"), F.col("text").alias("output"), F.lit("fact").alias("type"))
    return PL.funnel(PL.instruction_set(pairs, "doc_id", ["the re"], None))


@query()
def instruction_funnel_near(spark, sf_dir):
    """The same with near duplicates."""
    pairs = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract("text", r"^[^\n]*", 0).alias("instruction"), F.col("text").alias("output"), F.lit("fact").alias("type"))
    return PL.funnel(PL.instruction_set(pairs, "doc_id", ["the re"]))


@query("""
SELECT event_type AS group_name, count(*) AS n, CAST(sum(CAST(event_id % 4 < 2 AS BIGINT)) AS BIGINT) AS n_correct, round(avg(CAST(event_id % 4 < 2 AS DOUBLE)), 4) AS accuracy FROM events GROUP BY event_type
UNION ALL SELECT '(all)', count(*), CAST(sum(CAST(event_id % 4 < 2 AS BIGINT)) AS BIGINT), round(avg(CAST(event_id % 4 < 2 AS DOUBLE)), 4) FROM events
""")
def rescored_accuracy(spark, sf_dir):
    """Accuracy of replies scored anew, by category."""
    letters = lambda *x: F.array(*[F.lit(c) for c in x])
    events = table(spark, sf_dir, "events")
    replies = F.element_at(letters("AB", "B, A.", "A. x", "none"), (F.col("event_id") % 4 + 1).cast("int"))
    results = events.select(F.col("event_id").alias("id"), replies.alias("raw_output"), F.lit(False).alias("correct"))
    questions = events.select(F.col("event_id").alias("id"), letters("B", "A").alias("answer"), letters("A", "B", "C").alias("options"), F.col("event_type").alias("category"))
    return A.accuracy(PL.rescored(results, questions), "correct", "category")


@query("""
WITH pool AS (SELECT p_partkey AS idx, p_retailprice AS o FROM part), l AS (SELECT quantile_cont(o, 0.75) AS q75, quantile_cont(o, 0.9) AS q90, max(o) AS top FROM pool),
r AS (SELECT l_returnflag AS model, l_linestatus AS run, l_partkey AS idx FROM lineitem),
e AS (SELECT model, run, avg(CAST(o >= q75 AS DOUBLE)) AS t25, avg(CAST(o >= q90 AS DOUBLE)) AS t10, max(CAST(o = top AS DOUBLE)) AS best FROM r JOIN pool USING (idx) CROSS JOIN l GROUP BY model, run)
SELECT model, round(avg(t25), 4) AS top25_mean, round(avg(t10), 4) AS top10_mean, avg(best) AS hit_best_rate, count(*) AS n_runs, round((SELECT avg(CAST(o >= q75 AS DOUBLE)) FROM pool CROSS JOIN l), 4) AS chance FROM e GROUP BY model
""")
def hit_rates(spark, sf_dir):
    """How often selections hit the best candidates."""
    pool = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("idx"), F.col("p_retailprice").alias("objective"))
    picks = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("run"), F.col("l_partkey").alias("idx"))
    found = PL.hit_rates(picks, pool)
    return found.select("model", F.round("top25_mean", 4).alias("top25_mean"), F.round("top10_mean", 4).alias("top10_mean"), "hit_best_rate", "n_runs", F.round("chance", 4).alias("chance"))


RUNS = "SELECT role AS model, conv_id % 7 AS run, list_distinct(list(length(text) % 10)) AS s FROM conversations GROUP BY 1, 2"


def _runs(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy(F.col("role").alias("model"), (F.col("conv_id") % 7).alias("run")).agg(F.collect_set((F.char_length("text") % 10).cast("bigint")).alias("selected"))


@query(f"WITH r AS ({RUNS}) SELECT a.model, round(avg(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s)))), 4) AS mean_similarity FROM r a JOIN r b ON a.model = b.model AND a.run < b.run GROUP BY a.model")
def selection_stability(spark, sf_dir):
    """How alike a model's selections are."""
    return PL.stability(_runs(spark, sf_dir)).withColumn("mean_similarity", F.round("mean_similarity", 4))


@query(f"WITH r AS ({RUNS}), e AS (SELECT model, run, unnest(s) AS idx FROM r) SELECT model, idx, count(*) AS n FROM e GROUP BY model, idx HAVING count(*) > (SELECT count(DISTINCT run) FROM r WHERE r.model = e.model) / 2")
def stable_picks(spark, sf_dir):
    """Picks of most of a model's runs."""
    return PL.stable_picks(_runs(spark, sf_dir))


@query("SELECT event_id, CASE WHEN value > 50 THEN 'accept' ELSE 'fallback' END AS decision FROM events")
def fallback_decision(spark, sf_dir):
    """Which confidences are accepted."""
    return table(spark, sf_dir, "events").select("event_id", PL.accepted(F.col("value"), 50).alias("decision"))


@query("""
WITH t AS (SELECT event_type AS method, user_id AS rep, row_number() OVER w - 1 AS round, max(value) OVER w AS best FROM events WINDOW w AS (PARTITION BY event_type, user_id ORDER BY event_id)),
e AS (SELECT method, rep, CAST(coalesce(min(round) FILTER (best >= 0.9 * 100), count(*)) AS DOUBLE) AS r90, CAST(coalesce(min(round) FILTER (best >= 0.95 * 100), count(*)) AS DOUBLE) AS r95, max_by(best, round) AS final FROM t GROUP BY method, rep)
SELECT method, round(avg(r90), 4) AS r90_mean, round(stddev_pop(r90), 4) AS r90_sd, round(avg(r95), 4) AS r95_mean, round(stddev_pop(r95), 4) AS r95_sd, round(avg(final), 4) AS final_mean, round(stddev_pop(final), 4) AS final_sd FROM e GROUP BY method
""")
def trajectory_metrics(spark, sf_dir):
    """Metrics of trajectories by method."""
    from pyspark.sql import Window

    w = Window.partitionBy("event_type", "user_id").orderBy("event_id")
    runs = table(spark, sf_dir, "events").select(F.col("event_type").alias("method"), F.col("user_id").alias("repeat"), (F.row_number().over(w) - 1).alias("round"), F.max("value").over(w).alias("best"))
    found = PL.trajectory_metrics(runs, 100.0)
    return found.select("method", *[F.round(c, 4).alias(c) for c in found.columns if c != "method"])


@query("SELECT user_id AS run, round(min(value), 4) AS best_loss, round(max_by(value, event_id), 4) AS last_loss, max(event_id) AS last_step FROM events GROUP BY user_id")
def loss_summary(spark, sf_dir):
    """Best and last losses of runs."""
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss"))
    return PL.loss_summary(log).withColumns({"best_loss": F.round("best_loss", 4), "last_loss": F.round("last_loss", 4)})


@query("SELECT run, step FROM (SELECT event_type AS run, event_id AS step, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS a, count(*) OVER (PARTITION BY event_type) AS n FROM events) WHERE a % greatest(1, n // 100) = 0")
def loss_curve(spark, sf_dir):
    """Thinned curves of runs."""
    log = table(spark, sf_dir, "events").select(F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss"))
    return PL.loss_curve(log, 100).select("run", "step")


@query("""
WITH m AS (SELECT lang, max(n_chars) FILTER (source = 'src1') AS src1, max(n_chars) FILTER (source = 'src2') AS src2 FROM documents GROUP BY lang)
SELECT lang, src1, src2, concat_ws(',', CASE WHEN src1 = (SELECT max(src1) FROM m) THEN 'src1' END, CASE WHEN src2 = (SELECT max(src2) FROM m) THEN 'src2' END) AS best_at FROM m
""")
def summary_matrix(spark, sf_dir):
    """A matrix of results with the best of each column."""
    return PL.summary_matrix(table(spark, sf_dir, "documents"), "lang", "source", "n_chars", ["src1", "src2"])


@query("SELECT doc_id, source_no FROM (SELECT doc_id, source_no, row_number() OVER (ORDER BY source_no, doc_id) AS r FROM (SELECT doc_id, source_no, row_number() OVER (PARTITION BY k ORDER BY source_no, doc_id) AS f FROM (SELECT doc_id, CAST(substr(source, 4) AS BIGINT) AS source_no, md5(text) AS k FROM documents)) WHERE f = 1) WHERE r <= 300")
def group_quota(spark, sf_dir):
    """New texts in the order of sources until a quota is full."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.substring("source", 4, 9).cast("bigint").alias("source_no"), F.md5("text").alias("k"))
    return PL.group_quota(docs, "k", "source_no", "doc_id", 300).select("doc_id", "source_no")


@query("SELECT item_id AS id, md5('[1] ' || substr(text, 1, 1500) || chr(10) || chr(10) || 'Question: q' || chr(10) || 'A. yes' || chr(10) || 'Answer:') AS prompt, 0.5 AS top_passage_score, 1 AS num_passages FROM benchmark")
def retrieval_prompts(spark, sf_dir):
    """Prompts with retrieved passages."""
    items = table(spark, sf_dir, "benchmark")
    questions = items.select(F.col("item_id").alias("id"), F.lit("q").alias("question"), F.create_map(F.lit("A"), F.lit("yes")).alias("options"))
    hits = items.select(F.col("item_id").alias("query_id"), F.col("item_id").alias("chunk_id"), F.lit(0.5).alias("score"), F.lit(1).alias("rank"))
    return PL.retrieval_prompts(questions, hits, items.select(F.col("item_id").alias("chunk_id"), "text")).withColumn("prompt", F.md5("prompt"))


EXAM_SQL = """
WITH q AS (SELECT item_id AS id, 'Question: ' || substr(text, 1, 60) || chr(10) || 'A. yes' || chr(10) || 'B. no' || chr(10) || chr(10) || 'Answer:' AS q FROM benchmark)
SELECT id, md5('Select.' || chr(10) || chr(10) || (SELECT q FROM q WHERE id = 3) || ' AB' || chr(10) || chr(10) || (SELECT q FROM q WHERE id = 1) || ' AB' || chr(10) || chr(10) || q) AS prompt FROM q WHERE id NOT IN (1, 3)
"""


def _questions(spark, sf_dir):
    options = F.create_map(F.lit("B"), F.lit("no"), F.lit("A"), F.lit("yes"))
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.substring("text", 1, 60).alias("question"), options.alias("options"), F.array(F.lit("B"), F.lit("A")).alias("answer"))


@query(EXAM_SQL)
def few_shot_prompts(spark, sf_dir):
    """Prompts behind two solved examples, which are not asked."""
    return PL.exam_prompts(_questions(spark, sf_dir), "Select.", [3, 1]).withColumn("prompt", F.md5("prompt"))


@query("SELECT item_id AS id, md5('Select.' || chr(10) || chr(10) || 'Question: ' || substr(text, 1, 60) || chr(10) || 'A. yes' || chr(10) || 'B. no' || chr(10) || chr(10) || 'Answer:') AS prompt FROM benchmark")
def zero_shot_prompts(spark, sf_dir):
    """Prompts without examples."""
    return PL.exam_prompts(_questions(spark, sf_dir), "Select.").withColumn("prompt", F.md5("prompt"))


@query("""
SELECT p_size AS pool, 'Take 3 of ' || count(*) || ':' || chr(10) || string_agg(printf('  #%2d: CE=%.2f, GE=%.2f', CAST(p_partkey AS INTEGER), CAST(p_retailprice AS DOUBLE), CAST(p_size AS DOUBLE)), chr(10) ORDER BY p_partkey) AS prompt FROM part GROUP BY p_size
""")
def candidate_prompt(spark, sf_dir):
    """A table of candidates in a prompt, for every pool."""
    pool = table(spark, sf_dir, "part")
    line = P.candidate_line(F.col("p_partkey").cast("int"), {"CE": F.col("p_retailprice").cast("double"), "GE": F.col("p_size").cast("double")})
    told = pool.groupBy(F.col("p_size").alias("pool")).agg(F.count("*").alias("n"), P.in_lines(line, F.col("p_partkey")).alias("lines"))
    return told.select("pool", P.filled("Take {k} of {n}:\n{lines}", k=F.lit(3), n=F.col("n"), lines=F.col("lines")).alias("prompt"))


@query("SELECT doc_id, md5('Write 5 pairs about src {x}.' || chr(10) || 'ARTICLE:' || chr(10) || text) AS prompt FROM documents")
def generation_prompt(spark, sf_dir):
    """Prompts that ask for pairs about an article."""
    template = "Write {n} pairs about {what}.\nARTICLE:\n{article}"
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(P.filled(template, n=F.lit(5), what=F.lit("src {x}"), article=F.col("text"))).alias("prompt"))


MIX_SQL = TURN_SQL + f"""
, d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id % 2 ORDER BY CAST('0x' || substr(md5(conv_id || '#42'), 1, 15) AS BIGINT), conv_id) AS r FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT CASE WHEN conv_id % 2 = 0 THEN 'even' ELSE 'odd' END AS source, count(*) AS n, count(DISTINCT conv_id) AS chats FROM d JOIN f USING (conv_id)
WHERE r <= 1000 AND length(instruction) >= 10 AND length(output) BETWEEN 20 AND 8000 GROUP BY 1
"""


@query(MIX_SQL)
def chat_mix(spark, sf_dir):
    """First turns of two chat sources that pass the gate, by source."""
    said = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    chats = said.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))
    mix = PL.chat_mix({"even": (chats.where("conv_id % 2 = 0"), 1000), "odd": (chats.where("conv_id % 2 = 1"), 1000)}, "conv_id", 42)
    return mix.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("conv_id").alias("chats"))


@query(MIX_SQL + " UNION ALL SELECT 'gone', 0, NULL")
def general_chat_mix(spark, sf_dir):
    """The same mix in one drawn order with both of its sinks, and a source that can't be read; rows and chats as the files have them."""
    said = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    chats = said.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))
    path = scratch_path(spark, "general-mix")
    sources = {"even": (lambda: chats.where("conv_id % 2 = 0"), 1000), "gone": (lambda: spark.read.parquet(f"{path}/nowhere"), 1000), "odd": (lambda: chats.where("conv_id % 2 = 1"), 1000)}
    told = PL.general_mix(sources, "conv_id", 42, path)
    full = spark.read.schema("conv_id bigint, source string").json(f"{path}/full").groupBy("source").agg(F.count("*").alias("found"), F.countDistinct("conv_id").alias("chats"))
    rows = told.join(full, "source", "left").where("coalesce(found, 0) = n")  # what was counted is what was written
    return rows.select("source", "n", "chats")


@query("""
WITH l AS (SELECT quantile_cont(p_retailprice, 0.75) AS q FROM part),
e AS (SELECT l_returnflag AS method, l_orderkey AS rep, avg(p_retailprice) AS quality, avg(CAST(p_retailprice >= q AS DOUBLE)) AS hits FROM lineitem JOIN part ON l_partkey = p_partkey CROSS JOIN l WHERE l_linenumber <= 3 GROUP BY ALL)
SELECT method, round(avg(quality), 4) AS init_quality_mean, round(stddev_pop(quality), 4) AS init_quality_sd, round(avg(hits), 4) AS top_quartile_mean, round(stddev_pop(hits), 4) AS top_quartile_sd, count(*) AS n_repeats FROM e GROUP BY method
""")
def trajectory_starts(spark, sf_dir):
    """How good the first three picks of every repeat are, by method."""
    pool = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("idx"), F.col("p_retailprice").alias("objective"))
    starts = table(spark, sf_dir, "lineitem").where("l_linenumber <= 3").select(F.col("l_returnflag").alias("method"), F.col("l_orderkey").alias("repeat"), F.col("l_partkey").alias("idx"))
    found = PL.start_metrics(starts, pool)
    return found.select("method", *[F.round(c, 4).alias(c) for c in found.columns if c.endswith(("_mean", "_sd"))], "n_repeats")


EVALUATION_SQL = """
WITH s AS (SELECT a.vec_id AS id, b.vec_id AS chunk_id, b.label, list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))) AS score
           FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
h AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, chunk_id) AS r FROM s QUALIFY r <= 5),
p AS (SELECT h.id, list(substr(d.text, 1, 1500) ORDER BY r) AS texts, max(score) AS top_passage_score, count(*) AS num_passages FROM h JOIN documents d ON d.doc_id = h.chunk_id GROUP BY h.id),
q AS (SELECT vec_id AS id, label, substr(text, 1, 60) AS question FROM embeddings JOIN documents ON doc_id = vec_id WHERE vec_id % 100 = 0),
o AS (SELECT string_agg(chr(CAST(65 + i AS INTEGER)) || '. group ' || i, chr(10) ORDER BY i) AS options FROM (SELECT unnest(range(10)) AS i))
SELECT q.id, md5(coalesce(array_to_string(list_transform(texts, lambda x, i: '[' || i || '] ' || x), chr(10) || chr(10)), '') || chr(10) || chr(10) || 'Question: ' || question || chr(10) || options || chr(10) || 'Answer:') AS prompt,
       round(top_passage_score, 4) AS top_passage_score, coalesce(num_passages, 0) AS num_passages, chr(CAST(65 + h.label AS INTEGER)) AS predicted, h.label = q.label AS correct, CAST(q.label AS VARCHAR) AS category
FROM q LEFT JOIN p ON p.id = q.id CROSS JOIN o JOIN h ON h.id = q.id AND h.r = 1
"""


def _evaluated(spark, sf_dir):
    """Which group a vector's document belongs to, asked with its nearest documents; the reply told is the nearest one's group."""
    vectors, docs = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents")
    letter = lambda label: F.char(label.cast("int") + 65)
    options = F.map_from_entries(F.array(*[F.struct(F.lit(chr(65 + i)), F.lit(f"group {i}")) for i in range(10)]))
    asked = vectors.where("vec_id % 100 = 0").join(docs.select(F.col("doc_id").alias("vec_id"), F.substring("text", 1, 60).alias("question")), "vec_id")
    questions = asked.select(F.col("vec_id").alias("id"), "question", options.alias("options"), F.array(letter(F.col("label"))).alias("answer"), F.col("label").cast("string").alias("category"))
    groups = vectors.select(F.col("vec_id").alias("chunk_id"), F.concat(F.lit("The answer is "), letter(F.col("label"))).alias("raw_output"))
    replies = lambda prompts, hits: hits.where("rank = 1").select(F.col("query_id").alias("id"), "chunk_id").join(groups, "chunk_id").join(prompts.select("id"), "id", "left_semi")
    return PL.retrieval_evaluation(questions, vectors.where("vec_id % 100 = 0"), vectors, docs.select(F.col("doc_id").alias("chunk_id"), "text"), replies, 5)


@query(EVALUATION_SQL)
def retrieval_evaluation(spark, sf_dir):
    """From vectors to scored answers: nearest documents, prompts, replies and whether they are right."""
    found = _evaluated(spark, sf_dir)
    return found.select("id", F.md5("prompt").alias("prompt"), F.round("top_passage_score", 4).alias("top_passage_score"), "num_passages", "predicted", "correct", "category")


@query(f"""
WITH e AS ({EVALUATION_SQL})
SELECT category AS group_name, count(*) AS n, CAST(sum(CAST(correct AS BIGINT)) AS BIGINT) AS n_correct, round(avg(CAST(correct AS DOUBLE)), 4) AS accuracy FROM e GROUP BY category
UNION ALL SELECT '(all)', count(*), CAST(sum(CAST(correct AS BIGINT)) AS BIGINT), round(avg(CAST(correct AS DOUBLE)), 4) FROM e
""")
def retrieval_accuracy(spark, sf_dir):
    """The accuracy of that evaluation, overall and by category."""
    return A.accuracy(_evaluated(spark, sf_dir), "correct", "category")
