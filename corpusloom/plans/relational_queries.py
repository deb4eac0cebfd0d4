"""Queries over joins, deduplication, statistics, sampling and search replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.columns import kept_if_there
from corpusloom.operators import joins as J
from corpusloom.operators import order as O
from corpusloom.operators import replay as R
from corpusloom.operators import sampling as S
from corpusloom.operators import stats as A
from corpusloom.plans.registry import query, table


def _sha(key: str, seed: int) -> str:
    """SQL of ``sampling.draw``."""
    return f"CAST('0x' || substr(md5({key} || '#{seed}'), 1, 15) AS BIGINT)"


@query("SELECT o_orderkey, coalesce(c_mktsegment, 'unknown') AS c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def left_join_default(spark, sf_dir):
    """Orders with their customer's segment, or a default."""
    known = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return J.lookup(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), known, "o_custkey", "c_mktsegment", "unknown").select("o_orderkey", "c_mktsegment")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_ids(spark, sf_dir):
    """Orders whose customer is in a set of ids."""
    ids = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(ids, "o_custkey", "left_semi").select("o_orderkey")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_resume(spark, sf_dir):
    """Documents that no earlier run has done."""
    return J.unseen(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), F.col("doc_id"), F.col("doc_id"))


@query("""
SELECT c_custkey, CASE WHEN a THEN 'id' WHEN b THEN 'segment' END AS reason FROM (
  SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AS a,
         lower(trim(c_mktsegment)) IN (SELECT lower(c_mktsegment) FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 450000) AS b FROM customer)
""")
def cascade_anti_dedup(spark, sf_dir):
    """Customers with the first key under which others are known."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    known = joined.select(F.when(F.col("o_totalprice") > 400000, F.col("o_custkey")).cast("string").alias("id"), F.when(F.col("o_totalprice") > 450000, F.lower("c_mktsegment")).alias("segment"))
    keys = [("id", F.col("c_custkey").cast("string"), F.col("id")), ("segment", F.lower(F.trim("c_mktsegment")), F.col("segment"))]
    return J.cascade_reasons(customer.select("c_custkey", "c_mktsegment"), known, keys).select("c_custkey", "reason")


@query("""
SELECT doc_id, text_key, 0 AS branch FROM (SELECT doc_id, md5(text) AS text_key FROM documents WHERE source < 'src2')
UNION ALL
SELECT min(doc_id), md5(text), 1 FROM documents WHERE source >= 'src2' AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE source < 'src2') GROUP BY md5(text)
""")
def expansion_merge(spark, sf_dir):
    """A corpus and the new texts of its expansion."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("text_key"))
    return J.append_new(docs.where("source < 'src2'"), docs.where("source >= 'src2'"), "text_key", "doc_id").select("doc_id", "text_key", "branch")


@query("SELECT min(doc_id) AS doc_id, md5(text) AS text_key FROM documents GROUP BY md5(text)")
def keep_first_exact(spark, sf_dir):
    """The first document of every text."""
    return O.keep_first(table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("text_key")), ["text_key"], ["doc_id"])


@query("SELECT s_suppkey, coalesce(CASE WHEN n_regionkey < 2 THEN n_name END, 'unknown') AS n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def quartile_lookup(spark, sf_dir):
    """A dimension's value, or unknown."""
    known = table(spark, sf_dir, "nation").where("n_regionkey < 2").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return J.lookup(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), known, "s_nationkey", "n_name", "unknown").select("s_suppkey", "n_name")


@query("""
SELECT p_partkey, (SELECT min(s_suppkey) FROM supplier WHERE abs(p_retailprice - abs(s_acctbal)) < 0.5 AND abs(p_size - s_nationkey) < 0.5) AS s_suppkey FROM part
""")
def band_join_tolerance(spark, sf_dir):
    """Every part with the first supplier near it in two columns."""
    points = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("x"), F.col("p_size").cast("double").alias("y"))
    known = table(spark, sf_dir, "supplier").select("s_suppkey", F.abs("s_acctbal").alias("x"), F.col("s_nationkey").cast("double").alias("y"))
    return J.nearest_known(points, known, ["x", "y"], 0.5, "p_partkey", "s_suppkey").select("p_partkey", F.col("known_s_suppkey").alias("s_suppkey"))


@query("SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey")
def last_wins(spark, sf_dir):
    """The last value of every key."""
    return J.last_wins(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


@query("SELECT g AS source_no, count(*) AS n_new FROM (SELECT md5(text) AS k, min(CAST(substr(source, 4) AS BIGINT)) AS g FROM documents GROUP BY 1) GROUP BY g")
def first_seen_by_group(spark, sf_dir):
    """How many new texts each source brings, in the order of sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("k"), F.substring("source", 4, 9).cast("bigint").alias("source_no"))
    return J.new_by_group(docs, "k", "source_no", "doc_id")


@query("SELECT u.lang FROM (SELECT lang FROM documents EXCEPT SELECT lang FROM documents WHERE source = 'src99') u UNION SELECT 'xx'")
def set_operations(spark, sf_dir):
    """Distinct union and difference of keys."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("lang").subtract(docs.where("source = 'src99'").select("lang")).union(spark.sql("SELECT 'xx' AS lang")).distinct()


@query("SELECT 'doc' AS kind, doc_id AS id, source AS name FROM documents UNION ALL SELECT 'page', page_id, NULL FROM pages")
def union_by_name(spark, sf_dir):
    """Two tables one behind the other, missing columns null."""
    docs = table(spark, sf_dir, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), F.col("source").alias("name"))
    return docs.unionByName(table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id")), allowMissingColumns=True)


@query("SELECT doc_id, source AS venue FROM documents")
def kept_columns(spark, sf_dir):
    """Those of the wanted columns that a table has, one renamed."""
    return kept_if_there(table(spark, sf_dir, "documents"), ["doc_id", "doi", "source", "abstract"], {"source": "venue"})


# --- statistics


@query("SELECT split_part(url, '.', -1)[1:2] AS agency, CAST(grouping(agency) AS TINYINT) AS is_total, count(*) AS pages, CAST(sum(length(html)) AS BIGINT) AS chars FROM pages GROUP BY ROLLUP (agency)")
def manifest_totals(spark, sf_dir):
    """Pages and characters of every agency of a crawl, and of all."""
    pages = table(spark, sf_dir, "pages")
    return A.totals(pages.select(F.substring(F.substring_index("url", ".", -1), 1, 2).alias("agency"), F.char_length("html").cast("bigint").alias("size")), "agency", "size")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def longest_documents(spark, sf_dir):
    """The longest documents."""
    return O.top_n(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", 25, "doc_id")


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, min(l_orderkey * 10 + l_linenumber) LIMIT 15")
def topn_groups_first_seen(spark, sf_dir):
    """The largest groups, of equally large ones those that were seen first."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return A.top_groups(lines, "l_partkey", 15, "at")


@query("""
SELECT l_returnflag, count(*) AS n, max(x) FILTER (r = n * 25 // 100) AS q25, max(x) FILTER (r = n * 50 // 100) AS q50, max(x) FILTER (r = n * 75 // 100) AS q75, max(x) FILTER (r = n * 95 // 100) AS q95
FROM (SELECT l_returnflag, l_extendedprice AS x, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS r, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) GROUP BY l_returnflag
""")
def index_quantiles(spark, sf_dir):
    """Values at places of the sorted column, the upper median among them."""
    return A.index_quantiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", [25, 50, 75, 95])


@query("SELECT lang, count(*) AS n, max(n_chars) FILTER (r = n // 2) AS q50 FROM (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents) GROUP BY lang")
def upper_median(spark, sf_dir):
    """The upper median length by language."""
    return A.index_quantiles(table(spark, sf_dir, "documents"), ["lang"], "n_chars", [50])


@query("SELECT l_returnflag, round(quantile_cont(l_quantity, 0.5), 4) AS med, round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY l_returnflag")
def percentiles(spark, sf_dir):
    """Interpolated percentiles."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    told = A.percentiles(lines, ["l_returnflag"], "l_quantity", {"med": 0.5}).join(A.percentiles(lines, ["l_returnflag"], "l_extendedprice", {"p75": 0.75, "p90": 0.9}), "l_returnflag")
    return told.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("med", "p75", "p90")])


@query("SELECT l_linestatus, round(avg(l_quantity), 4) AS mean, round(stddev_pop(l_quantity), 4) AS sd, CAST(sum(l_quantity) AS BIGINT) // count(*) AS floor_mean, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_linestatus")
def stddev_pop_summary(spark, sf_dir):
    """Means, population deviations and extremes."""
    return table(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(
        F.round(F.avg("l_quantity"), 4).alias("mean"), F.round(F.stddev_pop("l_quantity"), 4).alias("sd"), F.floor(F.sum("l_quantity") / F.count("*")).alias("floor_mean"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )


@query("SELECT size, count(*) AS n_keys FROM (SELECT o_custkey, count(*) AS size FROM orders GROUP BY o_custkey) GROUP BY size")
def count_of_counts(spark, sf_dir):
    """How many customers have each number of orders."""
    return A.count_of_counts(table(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT count(*) AS n, count(*) FILTER (lang = 'en') AS n_english, round(count(*) FILTER (lang = 'en') / count(*), 4) AS share_english, count(*) FILTER (n_chars < 500) AS n_short, round(count(*) FILTER (n_chars < 500) / count(*), 4) AS share_short FROM documents")
def decision_counters(spark, sf_dir):
    """Counts and shares of decisions."""
    return A.decision_counts(table(spark, sf_dir, "documents"), {"english": F.col("lang") == "en", "short": F.col("n_chars") < 500})


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 15")
def topn_groups(spark, sf_dir):
    """The largest groups."""
    return A.top_groups(table(spark, sf_dir, "lineitem"), "l_partkey", 15)


@query("SELECT source, count(*) AS n_docs, sum(n_chars) AS tokens, CAST(grouping(source) AS TINYINT) AS is_total, round(sum(n_chars) / (SELECT sum(n_chars) FROM documents), 4) AS share FROM documents GROUP BY ROLLUP (source)")
def rollup_total(spark, sf_dir):
    """Sources with their shares, and the total."""
    return S.composition(table(spark, sf_dir, "documents"), "source", "n_chars")


@query("""
SELECT coalesce(event_type, '(all)') AS group_name, count(*) AS n, CAST(sum(CAST(value > 50 AS BIGINT)) AS BIGINT) AS n_correct, round(avg(CAST(value > 50 AS DOUBLE)), 4) AS accuracy FROM events GROUP BY ROLLUP (event_type)
""")
def accuracy_breakdown(spark, sf_dir):
    """Accuracy by group and over all."""
    return A.accuracy(table(spark, sf_dir, "events").withColumn("correct", F.col("value") > 50), "correct", "event_type")


@query("SELECT count(*) AS n, count(*) FILTER (quality = 0 AND toxic = 1) AS improved, count(*) FILTER (quality = 1 AND toxic = 0) AS degraded, count(*) FILTER (quality = toxic) AS unchanged FROM labels")
def rescore_delta(spark, sf_dir):
    """What became right and wrong between two scorings."""
    return A.changes(table(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("a"), (F.col("toxic") == 1).alias("b")), "a", "b")


@query("SELECT * FROM (SELECT event_type, user_id % 2 AS arm, value FROM events) PIVOT (round(avg(value), 4) FOR arm IN (0 AS plain, 1 AS helped) GROUP BY event_type)")
def with_without_delta(spark, sf_dir):
    """Means of two arms side by side."""
    told = table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 2).alias("arm"), "value")
    return told.groupBy("event_type").pivot("arm", [0, 1]).agg(F.round(F.avg("value"), 4)).withColumnsRenamed({"0": "plain", "1": "helped"})


# --- windows and samples


@query("SELECT doc_id FROM (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) AS r FROM documents) WHERE r % 7 = 0 AND n_chars >= 500")
def every_nth(spark, sf_dir):
    """Every seventh document, if it is long enough; short ones count."""
    return O.every_nth(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), 7, "doc_id", F.col("n_chars") >= 500).select("doc_id")


@query("SELECT page_id, url FROM (SELECT page_id, url, row_number() OVER (ORDER BY url NULLS FIRST, page_id) AS r FROM pages) WHERE r % 7 = 0")
def every_nth_by_url(spark, sf_dir):
    """Every seventh page in the order of urls, which are strings, and then of ids."""
    return O.every_nth(table(spark, sf_dir, "pages").select("page_id", "url"), 7, "url", ties=("page_id",))


@query("SELECT event_id, sum(value) OVER (ORDER BY ts NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) AS running FROM (SELECT event_id, ts, CAST(floor(1000 * value) AS BIGINT) AS value FROM events)")
def running_sum_over_time(spark, sf_dir):
    """The sum of all events' values up to each one, in the order of times."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.floor(F.col("value") * 1000).alias("value"))
    return O.running_sum(events, F.col("value"), "ts", ("event_id",)).select("event_id", "running")


@query("""SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY k.source, k.text, doc_id) AS place
FROM (SELECT doc_id, lang, {'source': source, 'text': substr(text, 1, 20)} AS k FROM documents)""")
def places_by_struct(spark, sf_dir):
    """Every document's place in its language, in the order of a struct of two strings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.struct("source", F.substring("text", 1, 20).alias("text")).alias("k"))
    return O.running_sum(docs, F.lit(1), "k", ("doc_id",), "place", groups=("lang",)).select("doc_id", F.col("place").cast("bigint").alias("place"))


@query(f"SELECT doc_id, CASE WHEN {_sha('doc_id', 42)} < CAST(floor(0.02 * (1::BIGINT << 60)) AS BIGINT) THEN 'val' ELSE 'train' END AS split FROM documents")
def hash_split(spark, sf_dir):
    """A validation split of two in a hundred."""
    return S.hash_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.02, 42)


@query(f"SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_sha('doc_id', 7)}, doc_id) AS r FROM documents) WHERE r <= 20")
def stratified_n(spark, sf_dir):
    """Twenty drawn documents of every language."""
    return S.sample_n(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], "doc_id", 20, 7)


@query(f"SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_sha('doc_id', 7)}, doc_id) AS r FROM documents) WHERE r <= CASE lang WHEN 'en' THEN 50 WHEN 'de' THEN 10 ELSE 0 END")
def quota_sample(spark, sf_dir):
    """Drawn documents by quotas."""
    quotas = spark.createDataFrame([("en", 50), ("de", 10)], "lang string, quota int")
    return S.sample_quotas(table(spark, sf_dir, "documents").select("doc_id", "lang"), quotas, "lang", "doc_id", 7)


@query(f"SELECT doc_id FROM documents ORDER BY {_sha('doc_id', 3)}, doc_id LIMIT 50")
def reservoir_sample(spark, sf_dir):
    """Fifty drawn documents."""
    return S.sample_n(table(spark, sf_dir, "documents").select("doc_id"), [], "doc_id", 50, 3)


@query("SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS r FROM lineitem) WHERE r <= 2")
def per_group_cap(spark, sf_dir):
    """The two dearest lines of every order."""
    return O.first_n(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), ["l_orderkey"], [F.desc("l_extendedprice"), "l_linenumber"], 2).select("l_orderkey", "l_linenumber")


@query(f"SELECT doc_id, row_number() OVER (ORDER BY {_sha('doc_id', 42)}, doc_id) AS place FROM documents")
def seeded_shuffle(spark, sf_dir):
    """The places of a drawn order."""
    drawn = table(spark, sf_dir, "documents").select("doc_id", S.draw(F.col("doc_id"), 42).alias("d"))
    return O.running_sum(drawn, F.lit(1), "d", ("doc_id",), "place").select("doc_id", F.col("place").cast("bigint").alias("place"))


@query("SELECT user_id, event_id, max(value) OVER (PARTITION BY user_id ORDER BY event_id) AS best FROM events")
def running_best(spark, sf_dir):
    """The best value of a user so far."""
    return R.running_best(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], "event_id", "value").select("user_id", "event_id", "best")


@query("""
SELECT user_id, coalesce(min(round) FILTER (best >= 90), count(*)) AS rounds FROM (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS round, max(value) OVER (PARTITION BY user_id ORDER BY event_id) AS best FROM events) GROUP BY user_id
""")
def rounds_to_threshold(spark, sf_dir):
    """The first round at which a user's best reaches 90."""
    from pyspark.sql import Window

    events = table(spark, sf_dir, "events").withColumn("round", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1)
    return R.rounds_to(R.running_best(events, ["user_id"], "event_id", "value"), ["user_id"], "round", "best", F.lit(90))


@query("SELECT user_id, event_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS delta FROM events")
def step_delta(spark, sf_dir):
    """The change from a user's event to the next."""
    from pyspark.sql import Window

    before = F.lag("value").over(Window.partitionBy("user_id").orderBy("event_id"))
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.round(F.col("value") - before, 4).alias("delta"))


# --- search replay


@query("SELECT row_number() OVER (ORDER BY a, b) - 1 AS idx, a / 10 AS a, b / 10 AS b, (20 - a - b) / 10 AS c FROM range(11) x(a), range(11) y(b) WHERE 20 - a - b BETWEEN 0 AND 10")
def simplex_grid(spark, sf_dir):
    """The grid of three shares."""
    return R.simplex_grid(spark).select(F.col("idx").cast("bigint").alias("idx"), "a", "b", "c")


@query("""
WITH runs AS (SELECT event_type AS run, list_distinct(list(user_id)) AS s FROM events GROUP BY event_type)
SELECT a.run AS run_a, b.run AS run_b, round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))), 4) AS similarity FROM runs a JOIN runs b ON a.run < b.run
""")
def pairwise_jaccard(spark, sf_dir):
    """Similarity of every two runs' selections: users by type of event (a few types, each once)."""
    each = table(spark, sf_dir, "events").select(F.col("event_type").alias("run"), "user_id").distinct()
    sizes = each.groupBy("run").agg(F.count("*").alias("n"))
    both = each.withColumnRenamed("run", "run_a").join(each.withColumnRenamed("run", "run_b"), "user_id").where("run_a < run_b").groupBy("run_a", "run_b").agg(F.count("*").alias("both"))
    told = both.join(F.broadcast(sizes.select(F.col("run").alias("run_a"), F.col("n").alias("na"))), "run_a").join(F.broadcast(sizes.select(F.col("run").alias("run_b"), F.col("n").alias("nb"))), "run_b")
    return told.select("run_a", "run_b", F.round(F.col("both") / (F.col("na") + F.col("nb") - F.col("both")), 4).alias("similarity"))


@query("""
SELECT conv_id, CAST(len(list_filter(s, lambda x: x >= 5)) AS INTEGER) AS out_of_range, CAST(len(s) <> 3 AS INTEGER) AS wrong_count, CAST(len(s) - len(list_distinct(s)) AS INTEGER) AS repeated
FROM (SELECT conv_id, list(length(text) % 7) AS s FROM conversations GROUP BY conv_id)
""")
def violations(spark, sf_dir):
    """What is wrong with selections."""
    runs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.char_length("text") % 7).alias("s"))
    return runs.select("conv_id", R.violations(F.col("s"), 3, 5).alias("v")).select("conv_id", "v.*")


@query("SELECT length(text) % 7 AS pick, count(DISTINCT conv_id) AS n_runs FROM conversations GROUP BY 1 HAVING count(DISTINCT conv_id) > (SELECT count(DISTINCT conv_id) FROM conversations) / 2")
def frequent_picks(spark, sf_dir):
    """Picks of more than half of the runs."""
    told = table(spark, sf_dir, "conversations").select((F.char_length("text") % 7).cast("bigint").alias("pick"), "conv_id").distinct()
    runs = told.select(F.countDistinct("conv_id").alias("all_runs"))
    return told.groupBy("pick").agg(F.count("*").alias("n_runs")).join(F.broadcast(runs), F.col("n_runs") > F.col("all_runs") / 2).select("pick", "n_runs")


@query()
def bo_replay(spark, sf_dir):
    """Trajectories of model-guided and random search over the grid, by a fitted mixture model."""
    import numpy as np

    x = np.array([[r.a, r.b, r.c] for r in R.simplex_grid(spark).orderBy("idx").collect()])  # 66 rows
    truth = R.mixture_features(x) @ np.array([20.0, 30.0, 25.0, 40.0, 10.0, 30.0])
    y = R.mixture_features(x) @ R.mixture_fit(x, truth)
    runs = spark.createDataFrame([(m, r) for m in ("model", "random") for r in range(20)], "method string, repeat bigint")
    return R.replay(runs, x, y).withColumn("best", F.round("best", 6))
