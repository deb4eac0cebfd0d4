"""Queries over the driver's tables, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import jaccard, langid, lengths, media, mixing, phrases, pieces, sessions, style_tree, topk, toxicity, urls, warc

#: Public vocabularies, at the same path on every machine.
PIECES_PATH = "/opt/tokenizers/piece_bpe_32k.model"
RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: The rules of op5, as its contract fixes them: host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words that the mix takes of it."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        mixing.taken_words().alias("taken"),
        "source",
        F.array_sort(F.array_distinct("pieces.shard")).alias("shards"),
    )


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of op1: every document's size, its source's size and target."""
    told = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return told.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", F.round("target", 3).alias("target"))


MIXING_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM d GROUP BY source),
w AS (SELECT *, CASE number % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, (SELECT sum(size) FROM d) AS total FROM s),
o AS (SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
             sum(weight) OVER (ORDER BY 3 * source_size / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS remaining FROM w),
l AS (SELECT *, (total - earlier) / remaining AS level, (total - earlier) / remaining >= 3 * source_size / weight AS capped FROM o),
t AS (SELECT source, source_size, CASE WHEN capped THEN 3 * source_size ELSE least(3 * source_size, weight * max(CASE WHEN NOT capped THEN level END) OVER ()) END AS target FROM l)
SELECT doc_id, size, source_size, round(CAST(target AS DOUBLE), 3) AS target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates and its number of links."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "class_docs", "n_links")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, and its ids decoded again: ids, their number, and size and digest of the decoded text."""
    return pieces.encode(table(spark, sf_dir, "documents"), PIECES_PATH, decoded=True).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived as a WARC record and read back."""
    read = warc.read_archive(spark, warc.write_archive(table(spark, sf_dir, "pages")))
    return read.select(
        F.col("id").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


OP4_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first_id FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN r THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN r THEN first_id END AS refers_to
FROM (SELECT p.*, first_id, coalesce(payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id, false) AS r
      FROM p JOIN f USING (payload_digest))
"""


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the fixed rules."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


OP5_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages
), s AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path
  FROM u
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
  END AS rule FROM s)
"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, by a model fitted on a sample of the labelled ones, and whether it counts
    as toxic (any grade over 0 is likelier than not)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.col("_severity").alias("severity"),
        F.col("_toxic").alias("p_toxic"),
        (F.col("_toxic") >= 0.5).cast("int").alias("toxic"),
    )


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every twentieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, shares and truncated totals of all texts for every context limit."""
    return lengths.limits(lengths.length_histogram(table(spark, sf_dir, "documents"), RANKS_PATH))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a PNG in a binary column, read back, with its digests and cosine hash."""
    described = media.text_media(table(spark, sf_dir, "documents"))
    return described.select(*media.columns(described))


def media_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of op9: the payload of every text as it is read back."""
    return op9_media_columns(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


MEDIA_SQL = """
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS data FROM documents), n AS (SELECT *, octet_length(data) AS n_bytes FROM b),
p AS (SELECT *, CASE WHEN n_bytes = 0 THEN 576 ELSE CAST((n_bytes + 575) // 576 * 576 AS BIGINT) END AS payload_bytes FROM n)
SELECT doc_id, n_bytes, payload_bytes, sha256(data || unhex(repeat('FF', CAST(payload_bytes - n_bytes AS INTEGER)))) AS payload_sha256 FROM p
"""


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    found = style_tree.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language by their lowest cut."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
             list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS phrase FROM w),
f AS (SELECT lang, phrase, count(*) AS n FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, n AS a, string_split(phrase, ' ') AS s FROM f WHERE n >= 10 AND contains(phrase, ' ')),
k AS (SELECT *, unnest(range(1, len(s))) AS k FROM c),
q AS (SELECT k.*, l.n AS l, r.n AS r, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l.n AS HUGEINT) * r.n) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(s[1:k], ' ') JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(s[k + 1:], ' ')),
b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (SELECT lang, phrase, max(a) AS longest FROM (SELECT lang, a, unnest([s[1] || ' ' || s[2], s[2] || ' ' || s[3]]) AS phrase FROM c WHERE len(s) = 3) GROUP BY ALL),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN h ON b.lang = h.lang AND b.phrase = h.phrase WHERE longest IS NULL OR 100 * longest < 50 * a)
SELECT o.lang, rank, o.phrase, a, l, r, t.n, CAST(score AS BIGINT) AS score FROM o JOIN t ON o.lang = t.lang WHERE rank <= 2000
"""


def op12_session_merging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of the sessions that conversations form while their turns come in, batch by batch."""
    told = table(spark, sf_dir, "conversations").where("turn IS NOT NULL AND conv_id IS NOT NULL").select("conv_id", "turn")
    conv, whole = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    told = told.select(conv.alias("conv"), whole.alias("turn"), F.crc32(conv.cast("string")).alias("c"), F.crc32(F.concat_ws(":", conv.cast("string"), whole.cast("string"))).alias("h"))
    timed = told.withColumn("seconds", F.expr("(c div 2) % 7200 + 300 * turn + h % 600")).withColumn("g", F.expr("h div 600"))
    late = F.when(F.col("g") % 5 == 0, F.col("g") % 4).otherwise(0)
    return sessions.session_versions(timed, F.shiftright("conv", 3) * 2 + F.col("c") % 2, F.col("seconds"), F.expr("(seconds - pmod(seconds, 900)) div 900") + late, F.col("h"))


#: crc32 from its polynomial, eight steps a byte; then the sessions of every user after each of its batches.
OP12_SQL = """
WITH bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
d AS (SELECT CAST(conv_id AS BIGINT) AS conv, CAST(turn AS BIGINT) AS turn FROM conversations WHERE turn IS NOT NULL AND conv_id IS NOT NULL),
k AS (SELECT *, list_transform(string_split(CAST(conv AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS a,
             list_transform(string_split(conv || ':' || turn, ''), lambda x: CAST(ascii(x) AS BIGINT)) AS b FROM d),
r AS (SELECT conv, turn, xor(list_reduce(list_concat([4294967295], a), lambda x, y: xor(x >> 8, t[CAST(xor(x, y) & 255 AS INTEGER) + 1])), 4294967295) AS c,
             xor(list_reduce(list_concat([4294967295], b), lambda x, y: xor(x >> 8, t[CAST(xor(x, y) & 255 AS INTEGER) + 1])), 4294967295) AS h FROM k, bits),
s AS (SELECT *, 2 * (conv >> 3) + c % 2 AS u, (c // 2) % 7200 + 300 * turn + h % 600 AS t, h // 600 AS g FROM r),
e AS (SELECT u, t, h, CAST(floor(t / 900.0) AS BIGINT) + CASE WHEN g % 5 = 0 THEN g % 4 ELSE 0 END AS batch FROM s),
x AS (SELECT n.u, n.batch, e.t, e.h, e.batch AS own, row_number() OVER (PARTITION BY n.u, n.batch ORDER BY e.t) AS nth,
             CASE WHEN e.t - lag(e.t) OVER (PARTITION BY n.u, n.batch ORDER BY e.t) <= 600 THEN 0 ELSE 1 END AS breaks
      FROM (SELECT DISTINCT u, batch FROM e) n JOIN e ON e.u = n.u AND e.batch <= n.batch),
y AS (SELECT *, sum(breaks) OVER (PARTITION BY u, batch ORDER BY t, nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nr FROM x),
v AS (SELECT u, batch, min(t) AS start_s, max(t) AS end_s, count(*) AS n_events, count(*) FILTER (own = batch) AS n_new, sum(h) AS h_sum
      FROM y GROUP BY u, batch, nr HAVING count(*) FILTER (own = batch) > 0),
w AS (SELECT o.u, o.batch, o.start_s, min(n.batch) AS by_batch, arg_min(n.start_s, n.batch) AS by_start
      FROM v o JOIN v n ON o.u = n.u AND n.batch > o.batch AND n.start_s <= o.start_s AND n.end_s >= o.end_s GROUP BY ALL),
m AS (SELECT u, by_batch, by_start, count(*) AS n FROM w GROUP BY ALL)
SELECT v.u AS "user", v.batch, v.start_s, v.end_s, v.n_events, v.n_new, coalesce(m.n, 0) AS n_retracted, CAST(v.h_sum AS BIGINT) AS h_sum,
       w.by_batch AS retracted_batch, w.by_start AS retracted_start_s
FROM v LEFT JOIN w ON v.u = w.u AND v.batch = w.batch AND v.start_s = w.start_s
       LEFT JOIN m ON v.u = m.u AND v.batch = m.by_batch AND v.start_s = m.by_start
"""


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by models of the documents that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)))
    model = langid.fit(docs, ~F.col("held_out"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The operators' queries by name."""
    return {f.__name__: f for f in (op1_mixing, op2_ngram_jaccard, op3_sentencepiece, op4_warc, op5_url_filters, op6_toxicity, op7_topk, op8_token_counts, op9_media_columns, op10_html_extraction, op11_phrase_collocations, op12_session_merging, op13_language_id, mixing_targets, media_payloads)}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express."""
    return {"op4_warc": OP4_SQL, "op5_url_filters": OP5_SQL, "op7_topk": OP7_SQL, "op11_phrase_collocations": OP11_SQL, "op12_session_merging": OP12_SQL, "mixing_targets": MIXING_SQL, "media_payloads": MEDIA_SQL}
