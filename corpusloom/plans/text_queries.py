"""Queries over the text functions and lexicons.

The tables' texts have none of the marks that the cleaners look for, so marks are added to every text first, and long
results are told by their digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import lexicon as L
from corpusloom.functions import text as T
from corpusloom.functions import unicode as U
from corpusloom.plans.registry import query, table

MARKS = "' [1] b [2,3] <b>c</b> (4) (1234) d.e ,f  g'"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _told(docs: DataFrame, result: Column, name: str = "digest") -> DataFrame:
    return docs.select("doc_id", F.md5(result).alias(name), F.char_length(result).cast("bigint").alias("length"))


def _told_sql(result: str, source: str = "documents") -> str:
    return f"SELECT doc_id, md5(r) AS digest, length(r) AS length FROM (SELECT doc_id, {result} AS r FROM {source})"


WORDS_SQL = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))"
TOKENS_SQL = f"CAST(floor({WORDS_SQL} * CAST(1.3 AS DOUBLE)) AS BIGINT)"


@query(f"SELECT doc_id, CAST({WORDS_SQL} AS BIGINT) AS n_words, {TOKENS_SQL} AS n_tokens, n_chars // 4 AS n_quarter FROM documents")
def token_estimate(spark, sf_dir):
    """Words, tokens by words and tokens by characters of every text."""
    return _docs(spark, sf_dir).select("doc_id", T.word_count(F.col("text")).alias("n_words"), T.estimate_tokens(F.col("text")).alias("n_tokens"), T.chars_to_tokens(F.col("n_chars")).alias("n_quarter"))


@query("SELECT lang, count(*) FILTER (length(text) >= 2000) AS long, count(*) FILTER (length(text) BETWEEN 500 AND 50000) AS web, count(*) FILTER (length(text) < 200) AS short FROM documents GROUP BY lang")
def length_gate(spark, sf_dir):
    """Texts that pass length gates, by language."""
    n = F.char_length("text")
    return _docs(spark, sf_dir).groupBy("lang").agg(F.count_if(n >= 2000).alias("long"), F.count_if(n.between(500, 50000)).alias("web"), F.count_if(n < 200).alias("short"))


CITE_SQL = r"regexp_replace(regexp_replace({x}, '\[\s*\d+(?:\s*[,\-–]\s*\d+)*\s*\]', '', 'g'), '\(\s*\d{{1,3}}(?:\s*[,\-–]\s*\d{{1,3}})*\s*\)', '', 'g')"


@query(_told_sql(CITE_SQL.format(x=f"text || {MARKS}")))
def strip_citations(spark, sf_dir):
    """Citation markers removed."""
    return _told(_docs(spark, sf_dir), T.strip_citations(F.concat("text", F.expr(MARKS))))


@query(_told_sql(f"regexp_replace(text || {MARKS}, '<[^>]+>', '', 'g')"))
def strip_html(spark, sf_dir):
    """Tags removed."""
    return _told(_docs(spark, sf_dir), T.strip_html(F.concat("text", F.expr(MARKS))))


SPACE_SQL = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '[\t\r\n]+', ' ', 'g'), ' {{2,}}', ' ', 'g'), '\s+([.,;:!?)])', '\1', 'g'), '([.,;:!?])([A-Za-z])', '\1 \2', 'g'), '^\s+|\s+$', '', 'g')"


@query(_told_sql(SPACE_SQL.format(x=f"text || {MARKS}")))
def fix_whitespace(spark, sf_dir):
    """White space tidied."""
    return _told(_docs(spark, sf_dir), T.fix_whitespace(F.concat("text", F.expr(MARKS))))


@query(_told_sql(SPACE_SQL.format(x=CITE_SQL.format(x=f"regexp_replace(nfc_normalize(text) || {MARKS}, '<[^>]+>', '', 'g')"))))
def clean_text(spark, sf_dir):
    """The whole cleaning (the texts' composed and compatibility forms are the same)."""
    return _told(_docs(spark, sf_dir), U.clean_text(F.concat("text", F.expr(MARKS))))


def tidy_sql(x: str) -> str:
    """SQL of ``text.tidy_lines``."""
    return rf"regexp_replace(regexp_replace(regexp_replace({x}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'), '(?m)[ \t\r\f]+$', '', 'g').regexp_replace('^\s+|\s+$', '', 'g')"


@query(_told_sql(tidy_sql("replace(text, chr(10), repeat(chr(10), 5)) || ' ' || chr(7)")))
def collapse_blank_lines(spark, sf_dir):
    """Control characters, runs of line ends and white space at ends removed."""
    return _told(_docs(spark, sf_dir), T.tidy_lines(F.concat(F.expr("replace(text, '\\n', repeat('\\n', 5))"), F.lit(" "), F.lit("\x07"))))


TABLES = "text || chr(10) || '1 2.5 3e4 5 6 7 8' || chr(10) || '+--+--+' || chr(10) || 'a' || chr(9) || 'b' || chr(9) || 'c' || chr(9) || 'd' || chr(10) || 'z'"


def table_lines_sql(x: str) -> str:
    """SQL of ``text.drop_table_lines``."""
    return f"regexp_replace(regexp_replace(regexp_replace({x}" + r", '(?m)^[ \t]*(?:\d+\.?\d*(?:[eE][+-]?\d+)?[ \t]+){5,}\d+\.?\d*(?:[eE][+-]?\d+)?[ \t]*$', '', 'g'), '(?m)^[ \t]*(?:[+|][-=]+){2,}[+|]?[ \t]*$|^[ \t]*[-─━═]{10,}[ \t]*$', '', 'g'), '(?m)^[^\t\n]{0,30}(?:\t[^\t\n]{0,30}){3,}$', '', 'g')"


@query(_told_sql(table_lines_sql(TABLES)))
def remove_table_lines(spark, sf_dir):
    """Lines that are rows of tables emptied."""
    return _told(_docs(spark, sf_dir), T.drop_table_lines(F.expr(TABLES)))


@query(_told_sql("replace(replace(replace(text || '𝐀𝑏𝟗', '𝐀', 'A'), '𝑏', 'b'), '𝟗', '9')"))
def math_to_ascii(spark, sf_dir):
    """Mathematical letters and digits as plain ones."""
    return _told(_docs(spark, sf_dir), T.math_to_ascii(F.concat("text", F.lit("𝐀𝑏𝟗"))))


@query(_told_sql("replace(replace(text || '伪尾', '尾', 'β'), '伪', 'α')"))
def mojibake_fix(spark, sf_dir):
    """Wrongly decoded Greek letters restored."""
    return _told(_docs(spark, sf_dir), T.fix_mojibake(F.concat("text", F.lit("伪尾"))))


@query(_told_sql(r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text || ' [1-3] x... y ,', '\s+', ' ', 'g'), '\[[\d,\s\-–]+\]', '', 'g'), '\.{2,}', '.', 'g'), '\s+([.,;:!?])', '\1', 'g'), '^\s+|\s+$', '', 'g')"))
def clean_jats(spark, sf_dir):
    """Text of article XML cleaned."""
    return _told(_docs(spark, sf_dir), T.clean_jats(F.concat("text", F.lit(" [1-3] x... y ,"))))


FIRST_LINE = r"regexp_extract({x}, '^[^\n]*')"


@query(r"SELECT doc_id, regexp_replace(regexp_replace(lower(regexp_replace(t, '^\s+|\s+$', '', 'g')), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g') AS key FROM (SELECT doc_id, regexp_extract(text, '^[^\n]*') AS t FROM documents)")
def title_key(spark, sf_dir):
    """Keys of the first lines."""
    return _docs(spark, sf_dir).select("doc_id", T.title_key(F.regexp_extract("text", r"^[^\n]*", 0)).alias("key"))


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(lower(t)), '[^a-z0-9 ]', '', 'g'), '\s+', ' ', 'g')) AS key FROM (SELECT doc_id, regexp_extract(text, '^[^\n]*') AS t FROM documents)")
def folded_title_key(spark, sf_dir):
    """Keys of first lines with accents folded."""
    return _docs(spark, sf_dir).select("doc_id", U.folded_title_key(F.regexp_extract("text", r"^[^\n]*", 0)).alias("key"))


@query("""
SELECT doc_id, md5(CASE WHEN length(t) > 1000 THEN (CASE WHEN p > 800 THEN substr(h, 1, p) ELSE h END) || '[...]' ELSE t END) AS digest
FROM (SELECT doc_id, t, h, CASE WHEN strpos(reverse(h), b) > 0 THEN 1000 - strpos(reverse(h), b) - 1 ELSE -1 END AS p
      FROM (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS t, substr(replace(text, chr(10), chr(10) || chr(10)), 1, 1000) AS h, chr(10) || chr(10) AS b FROM documents))
""")
def boundary_truncate(spark, sf_dir):
    """Texts cut at a blank line near 1,000 characters."""
    text = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.truncate_at_break(text, 1000, "[...]")).alias("digest"))


@query("SELECT doc_id, md5(substr(text, 1, 500)) AS article_id FROM documents")
def article_id_md5(spark, sf_dir):
    """Ids from the beginnings of texts."""
    return _docs(spark, sf_dir).select("doc_id", T.article_id(F.col("text")).alias("article_id"))


@query("SELECT doc_id, CASE WHEN length(text) >= 200 THEN 'good' WHEN length(text) >= 50 THEN 'short' ELSE 'none' END AS quality, CASE WHEN n_chars >= 50 THEN 1 WHEN n_chars >= 10 THEN 2 ELSE 3 END AS tier FROM documents")
def quality_label(spark, sf_dir):
    """Labels by length, and tiers."""
    return _docs(spark, sf_dir).select("doc_id", T.abstract_quality(F.col("text")).alias("quality"), T.tier(F.col("n_chars")).alias("tier"))


@query("""
SELECT event_type, CASE upper(trim(t)) WHEN 'METHOD' THEN 'METHODOLOGICAL' WHEN 'FACT' THEN 'FACTUAL' WHEN 'EXPLAIN' THEN 'MECHANISTIC' ELSE 'OTHER' END AS kind, count(*) AS n
FROM (SELECT event_type, CASE event_id % 4 WHEN 0 THEN ' method ' WHEN 1 THEN 'Fact' WHEN 2 THEN 'explain' ELSE event_type END AS t FROM events) GROUP BY ALL
""")
def normalise_type(spark, sf_dir):
    """Question types that labels mean."""
    label = F.expr("CASE event_id % 4 WHEN 0 THEN ' method ' WHEN 1 THEN 'Fact' WHEN 2 THEN 'explain' ELSE event_type END")
    return table(spark, sf_dir, "events").groupBy("event_type", T.question_type(label).alias("kind")).agg(F.count("*").alias("n"))


@query(_told_sql(r"CASE WHEN regexp_extract(text, '^[^\n]*') <> '' THEN 'Title: ' || regexp_extract(text, '^[^\n]*') || chr(10) ELSE '' END || 'Venue: ' || source || CASE WHEN length(text) > 50 THEN chr(10) || chr(10) || 'Abstract:' || chr(10) || regexp_replace(text, '^\s+|\s+$', '', 'g') ELSE '' END || chr(10) || chr(10) || 'Full Text:' || chr(10) || regexp_replace(text, '^\s+|\s+$', '', 'g')"))
def format_record(spark, sf_dir):
    """Texts as structured records."""
    none, title = F.lit(""), F.regexp_extract("text", r"^[^\n]*", 0)
    return _told(_docs(spark, sf_dir), T.paper_record(title, none, F.lit(0), F.col("source"), none, F.col("text"), F.col("text")))


@query(_told_sql("'Title: ' || source || chr(10) || 'Source: Wikipedia' || chr(10) || chr(10) || text"))
def format_article(spark, sf_dir):
    """Texts as titled articles."""
    return _told(_docs(spark, sf_dir), T.titled_record(F.col("source"), "Wikipedia", F.col("text")))


@query(r"SELECT doc_id, source AS venue, trim(regexp_extract(text, '^[^\n]*')) AS title FROM documents")
def header_fields(spark, sf_dir):
    """Fields of record headers."""
    record = F.concat(F.lit("Title: "), "text", F.lit("\nVenue: "), "source", F.lit("\n"))
    return _docs(spark, sf_dir).select("doc_id", T.header_field(record, "Venue").alias("venue"), T.header_field(record, "Title").alias("title"))


@query(r"SELECT p_partkey, substr(regexp_replace(regexp_replace(regexp_replace(lower(p_name || ' (' || p_brand || ')'), '[^\w\s-]', '', 'g'), '[\s_]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 80) AS slug FROM part")
def file_slug(spark, sf_dir):
    """Names for files."""
    return table(spark, sf_dir, "part").select("p_partkey", T.slug(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))).alias("slug"))


@query("SELECT page_id, replace(url || '?a,b', ',', '%2C') AS csv_url, 'https://example.org/x' AS absolute, replace('2024/01/02', '/', '-') AS day FROM pages")
def url_and_date_parts(spark, sf_dir):
    """Urls for CSV files, absolute urls and date prefixes."""
    return table(spark, sf_dir, "pages").select("page_id", T.csv_url(F.concat("url", F.lit("?a,b"))).alias("csv_url"), T.absolute_url(F.lit("/x"), "https://example.org").alias("absolute"), T.date_prefix(F.lit("2024/01/02")).alias("day"))


@query(r"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(replace(text, chr(10), chr(10) || ' ' || chr(10)), '\n\s*\n'), lambda p: trim(p, ' ' || chr(10) || chr(9) || chr(13)) <> '')) AS BIGINT) AS n_paragraphs FROM documents")
def paragraph_split(spark, sf_dir):
    """Paragraphs of texts with blank lines."""
    return _docs(spark, sf_dir).select("doc_id", F.size(T.paragraphs(F.replace(F.col("text"), F.lit("\n"), F.lit("\n \n")))).cast("bigint").alias("n_paragraphs"))


@query(r"SELECT doc_id, CAST(len(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS BIGINT) AS n_sentences FROM documents")
def sentence_split(spark, sf_dir):
    """Sentences of texts."""
    return _docs(spark, sf_dir).select("doc_id", F.size(T.sentences(F.col("text"))).cast("bigint").alias("n_sentences"))


TERMS = ("idiot", "licensed under", "the re", "le la")


@query("SELECT doc_id, regexp_matches(lower(text), 'idiot|licensed under|the re|le la') AS hit FROM documents")
def substring_lexicon(spark, sf_dir):
    """Texts with a term anywhere."""
    return _docs(spark, sf_dir).select("doc_id", L.any_substring(F.col("text"), TERMS).alias("hit"))


@query(r"SELECT doc_id, regexp_matches(' ' || trim(regexp_replace(lower(text), '\s+', ' ', 'g')) || ' ', ' the | la ') AS hit FROM documents")
def padded_lexicon(spark, sf_dir):
    """Texts with a term between single spaces."""
    return _docs(spark, sf_dir).select("doc_id", L.any_padded(F.col("text"), (" the ", " la ")).alias("hit"))


@query(r"SELECT doc_id, regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])(?:there|with|of)($|[^\p{L}\p{N}_])') AS hit FROM documents")
def boundary_lexicon(spark, sf_dir):
    """Texts with a term as a whole word."""
    return _docs(spark, sf_dir).select("doc_id", L.any_word(F.col("text"), ("of", "with", "there")).alias("hit"))


@query(r"""
SELECT doc_id, concat_ws('+', CASE WHEN contains(lower(source), 'src1') THEN 'venue' END, CASE WHEN contains(lower(regexp_extract(text, '^[^\n]*')), 'the') THEN 'title' END, CASE WHEN contains(lower(lang), 'en') THEN 'keywords' END) AS layers FROM documents
""")
def three_layer_filter(spark, sf_dir):
    """Which of three layers of terms match."""
    layers = {"venue": L.any_substring(F.col("source"), ["src1"]), "title": L.any_substring(F.regexp_extract("text", r"^[^\n]*", 0), ["the"]), "keywords": L.any_substring(F.col("lang"), ["en"])}
    return _docs(spark, sf_dir).select("doc_id", L.matched_layers(layers).alias("layers"))


@query(r"""
SELECT doc_id, CASE WHEN regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(?:idiot)($|[^\p{L}\p{N}_])') THEN NULL WHEN regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(?:and)($|[^\p{L}\p{N}_])') THEN 'safe_title'
  WHEN regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(?:the|of)($|[^\p{L}\p{N}_])') THEN CASE WHEN c THEN 'confirmed_title' END WHEN c THEN 'text' END AS tier
FROM (SELECT doc_id, regexp_extract(text, '^[^\n]*') AS t, regexp_matches(substr(text, 1, 500), '(?i)(^|[^\p{L}\p{N}_])(?:with|in)($|[^\p{L}\p{N}_])') AS c FROM documents)
""")
def tiered_classifier(spark, sf_dir):
    """Tiers of texts by title and confirming words."""
    return _docs(spark, sf_dir).select("doc_id", L.tiered(F.regexp_extract("text", r"^[^\n]*", 0), F.col("text"), ["idiot"], ["and"], ["the", "of"], ["with", "in"]).alias("tier"))


@query("SELECT doc_id, least(CAST(regexp_matches(text, '(?i)idiot') AS INTEGER) + CAST(regexp_matches(text, '(?i)the') AS INTEGER) + CAST(regexp_matches(text, '(?i)and') AS INTEGER), 2) AS n FROM documents")
def match_count_capped(spark, sf_dir):
    """How many patterns match, two at the most."""
    return _docs(spark, sf_dir).select("doc_id", L.matches_up_to(F.col("text"), ["idiot", "the", "and"]).alias("n"))


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)(thth|onon)[a-z]*') THEN 'anchor' WHEN regexp_matches(lower(source), 'src2|src3') THEN 'journal' END AS kept FROM documents")
def anchor_rescue(spark, sf_dir):
    """Texts that an anchor or the source's name keeps."""
    return _docs(spark, sf_dir).select("doc_id", L.anchored(F.col("text"), F.col("source"), "(thth|onon)[a-z]*", ["src2", "src3"]).alias("kept"))


@query("SELECT doc_id, regexp_matches(text, '(?i)(the|que)') AND NOT regexp_matches(regexp_extract(text, '^[^\\n]*'), '(?i)(and|of)') AS dropped FROM documents")
def trigger_without_anchor(spark, sf_dir):
    """Texts that a trigger drops for want of an anchor."""
    return _docs(spark, sf_dir).select("doc_id", L.trigger_without_anchor(F.col("text"), F.regexp_extract("text", r"^[^\n]*", 0), "(the|que)", "(and|of)").alias("dropped"))


@query("SELECT c_custkey, regexp_matches(lower(c_mktsegment), 'a') AND NOT regexp_matches(lower(c_mktsegment), 'auto') AS keep FROM customer")
def name_filters(spark, sf_dir):
    """Names chosen by plain and banned words."""
    return table(spark, sf_dir, "customer").select("c_custkey", L.model_selected(F.col("c_mktsegment"), ["a", "!auto"]).alias("keep"))
