"""Queries over whole corpus steps: mixes, near duplicates, chats, answers, retrieval, records and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import automaton as AM
from corpusloom.functions import lexicon as L
from corpusloom.functions import parse as P
from corpusloom.functions import records as RC
from corpusloom.functions import text as T
from corpusloom.operators import neardup as N
from corpusloom.operators import order as O
from corpusloom.operators import retrieval as R
from corpusloom.operators import sampling as S
from corpusloom.operators import vector_index as VI
from corpusloom.plans.registry import query, table
from corpusloom.plans.text_queries import TOKENS_SQL
from corpusloom.session import scratch_path, written
from corpusloom.sources import markup as M
from corpusloom.sources import paged as PG
from corpusloom.sources import readers as RD
from corpusloom.sources import sinks as SK
from corpusloom.streaming import incremental as I


@query(f"SELECT source, count(*) AS n_docs, CAST(sum({TOKENS_SQL}) AS BIGINT) AS tokens, CAST(grouping(source) AS TINYINT) AS is_total, round(sum({TOKENS_SQL}) / (SELECT sum({TOKENS_SQL}) FROM documents), 4) AS share FROM documents GROUP BY ROLLUP (source)")
def source_composition(spark, sf_dir):
    """Documents, tokens and share of every source, and of all."""
    docs = table(spark, sf_dir, "documents").select("source", T.estimate_tokens(F.col("text")).alias("tokens"))
    return S.composition(docs, "source")


CUT_SQL = "SELECT doc_id, tokens FROM (SELECT doc_id, tokens, sum(tokens) OVER (ORDER BY doc_id) AS running FROM ({source})) WHERE running - tokens < {limit}"


@query(CUT_SQL.format(source=f"SELECT doc_id, {TOKENS_SQL} AS tokens FROM documents", limit=100000))
def token_budget_cut(spark, sf_dir):
    """Documents in order up to 100,000 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", T.estimate_tokens(F.col("text")).alias("tokens"))
    return O.budget_cut(docs, F.col("tokens"), 100_000, "doc_id")


@query(f"""SELECT doc_id, source, tokens FROM (SELECT doc_id, source, tokens, sum(tokens) OVER (ORDER BY source NULLS FIRST, doc_id ROWS UNBOUNDED PRECEDING) AS running
FROM (SELECT doc_id, source, {TOKENS_SQL} AS tokens FROM documents)) WHERE running - tokens < 300000""")
def token_budget_by_source(spark, sf_dir):
    """Documents up to 300,000 tokens, source by source (a string that many share) and by id within a source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", T.estimate_tokens(F.col("text")).alias("tokens"))
    return O.budget_cut(docs, F.col("tokens"), 300_000, "source", ("doc_id",))


@query(f"""
WITH t AS (SELECT doc_id, lang, {TOKENS_SQL} AS tokens FROM documents WHERE length(text) BETWEEN 500 AND 50000),
d AS (SELECT doc_id, tokens, 'domain' AS part FROM t WHERE lang = 'en'),
g AS (SELECT doc_id, tokens, sum(tokens) OVER (ORDER BY doc_id) AS running FROM t WHERE lang <> 'en' OR lang IS NULL),
m AS (SELECT * FROM d UNION ALL SELECT doc_id, tokens, 'general' FROM g WHERE running - tokens < floor((SELECT sum(tokens) FROM d) * 0.25 / 0.75))
SELECT part, count(*) AS n_docs, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(tokens) / (SELECT sum(tokens) FROM m), 4) AS share, CAST(grouping(part) AS TINYINT) AS is_total FROM m GROUP BY ROLLUP (part)
""")
def budgeted_mix(spark, sf_dir):
    """English texts whole, others up to a quarter of the mix; what each part has."""
    # ids and tokens once; the texts themselves would be joined to the result
    docs = table(spark, sf_dir, "documents").where(F.char_length("text").between(500, 50000)).select("doc_id", "lang", T.estimate_tokens(F.col("text")).alias("tokens"))
    docs = written(docs, "mix-tokens")
    english = F.col("lang") == "en"
    mix = S.budgeted_mix(docs.where(english), docs.where(~F.coalesce(english, F.lit(False))), 0.25)
    return S.composition(mix.select("part", "tokens"), "part")


# --- near duplicates


@query(r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) ELSE ws END)) AS g FROM w),
c AS (SELECT min(doc_id) AS id, g, len(g) AS n FROM g WHERE len(g) > 0 GROUP BY g),
e AS (SELECT id, n, unnest(g) AS s FROM c),
p AS (SELECT a.id AS i, b.id AS j, count(*) / (a.n + b.n - count(*)) AS similarity FROM e a JOIN e b ON a.s = b.s AND a.id < b.id GROUP BY a.id, b.id, a.n, b.n)
SELECT i, j, round(similarity, 4) AS similarity FROM p WHERE similarity >= 0.8
""")
def shingle_jaccard_pairs(spark, sf_dir):
    """All pairs of different texts whose shingles are as alike as 0.8."""
    return N.exact_pairs(table(spark, sf_dir, "documents")).withColumn("similarity", F.round("similarity", 4))


@query(r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) ELSE ws END)) AS g FROM w),
c AS (SELECT min(doc_id) AS id, g, len(g) AS n, count(*) AS docs FROM g GROUP BY g),
e AS (SELECT id, n, docs, unnest(g) AS s FROM c),
p AS (SELECT a.id AS i, b.id AS j, a.docs AS di, b.docs AS dj FROM e a JOIN e b ON a.s = b.s AND a.id < b.id GROUP BY a.id, b.id, a.n, b.n, a.docs, b.docs HAVING count(*) / (a.n + b.n - count(*)) >= 0.8),
l AS (SELECT id, sum(d) AS links FROM (SELECT i AS id, dj AS d FROM p UNION ALL SELECT j, di FROM p) GROUP BY id)
SELECT g.doc_id AS id, c.id AS representative, CAST(c.docs - 1 + coalesce(l.links, 0) AS BIGINT) AS n_links FROM g JOIN c ON g.g = c.g LEFT JOIN l ON l.id = c.id
""")
def shingle_jaccard_members(spark, sf_dir):
    """The set of every document, and how many others are as alike as 0.8; the membership of the pairs."""
    return N.exact_members(table(spark, sf_dir, "documents")).drop("class_id")


@query()
def minhash_document_clusters(spark, sf_dir):
    """Clusters of documents that share a band of nine: the compatible form, with a recall of 0.40 at a similarity of 0.8.
    ``minhash_verified_clusters`` and ``shingle_jaccard_members`` find all but few links, and all."""
    return N.document_clusters(table(spark, sf_dir, "documents"))


@query(r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) ELSE ws END)) AS g FROM w),
c AS (SELECT min(doc_id) AS id, g, len(g) AS n FROM g GROUP BY g),
e AS (SELECT id, n, unnest(g) AS s FROM c),
p AS (SELECT a.id AS i, b.id AS j FROM e a JOIN e b ON a.s = b.s AND a.id < b.id GROUP BY a.id, b.id, a.n, b.n HAVING count(*) / (a.n + b.n - count(*)) >= 0.8),
b AS (SELECT i, j FROM p UNION ALL SELECT j, i FROM p),
r AS (SELECT id AS node, id AS root FROM c UNION SELECT b.j, r.root FROM r JOIN b ON b.i = r.node),
m AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT g.doc_id AS id, m.root AS cluster FROM g JOIN c ON g.g = c.g JOIN m ON m.node = c.id
""")
def minhash_verified_clusters(spark, sf_dir):
    """Clusters of documents that share a band of thirty-two and whose shingles are as alike as 0.8."""
    return N.document_clusters(table(spark, sf_dir, "documents"), n_bands=32, rows=4, verify=0.8)


@query()
def minhash_recall(spark, sf_dir):
    """Of all links of different texts at 0.8, found exactly, the share within the clusters of both MinHash forms."""
    docs = table(spark, sf_dir, "documents")
    links = written(N.exact_pairs(docs), "recall-links")
    signed = N.document_signatures(docs)
    forms = {"nine bands": N.document_clusters(docs, signed=signed), "verified": N.document_clusters(docs, n_bands=32, rows=4, verify=0.8, signed=signed, links=links)}
    each = [N.cluster_recall(links, found).withColumn("form", F.lit(form)) for form, found in forms.items()]
    return each[0].unionByName(each[1])


@query()
def near_dup_sizes(spark, sf_dir):
    """Sizes of the document clusters, at the recall of ``minhash_document_clusters``."""
    return N.cluster_sizes(N.document_clusters(table(spark, sf_dir, "documents")))


#: Signatures are the least MD5 of a gram and each number as four bytes; rows are kept one by one in the order of ids.
GREEDY_SQL = r"""
WITH RECURSIVE m AS (SELECT conv_id * 1000 + turn AS id, trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g')) AS t FROM conversations WHERE role = 'user'),
g AS (SELECT DISTINCT id, substr(t, CAST(i AS INTEGER), 3) AS g FROM (SELECT id, t, unnest(range(1, greatest(1, length(t) - 2) + 1)) AS i FROM m)),
d AS (SELECT g, k, md5(g || chr(0) || chr(0) || chr(0) || chr(CAST(k AS INTEGER))) AS h FROM (SELECT DISTINCT g FROM g), (SELECT unnest(range(128)) AS k)),
v AS (SELECT id, k, min(h) AS h FROM g JOIN d USING (g) GROUP BY id, k),
s AS (SELECT id, list(h ORDER BY k) AS s, row_number() OVER (ORDER BY id) AS r FROM v GROUP BY id),
b AS (SELECT id, r, b, array_to_string(s[4 * b + 1:4 * b + 4], '') AS key FROM s, (SELECT unnest(range(32)) AS b)),
c AS (SELECT DISTINCT x.r AS early, y.r AS late FROM b x JOIN b y ON x.b = y.b AND x.key = y.key AND x.r < y.r),
e AS (SELECT late, list(early) AS near FROM c JOIN s x ON x.r = early JOIN s y ON y.r = late
      WHERE len(list_filter(list_zip(x.s, y.s), lambda z: z[1] = z[2])) >= 0.8 * 128 GROUP BY late),
w AS (SELECT CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS kept UNION ALL
      SELECT s.r, CASE WHEN list_has_any(w.kept, coalesce(e.near, [])) THEN w.kept ELSE list_append(w.kept, s.r) END FROM w JOIN s ON s.r = w.r + 1 LEFT JOIN e ON e.late = s.r)
SELECT id FROM s WHERE r IN (SELECT unnest(kept) FROM (SELECT kept FROM w ORDER BY r DESC LIMIT 1))
"""


@query(GREEDY_SQL)
def instruction_near_dup(spark, sf_dir):
    """User messages that stay when similar later ones go."""
    said = table(spark, sf_dir, "conversations").where("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    return N.greedy_survivors(said, "id", "text")


@query("SELECT u AS node, min(v) AS root FROM (SELECT o_custkey AS u, first_value(o_custkey) OVER (PARTITION BY o_custkey % 10 ORDER BY o_custkey) AS v FROM orders) GROUP BY u")
def connected_components(spark, sf_dir):
    """Customers whose keys end in one digit, tied in chains."""
    from pyspark.sql import Window

    from corpusloom.operators.graph import components

    keys = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    before = F.lag("o_custkey").over(Window.partitionBy(F.col("o_custkey") % 10).orderBy("o_custkey"))
    return components(keys.select(F.col("o_custkey").alias("u"), before.alias("v")).where("v IS NOT NULL"))


# --- chats, replies and answers


def _turns(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return said.select("conv_id", P.first_turn(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))).alias("t"))


TURN_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM conversations WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''),
u AS (SELECT conv_id, min(turn) AS ut FROM c WHERE role = 'user' GROUP BY conv_id),
a AS (SELECT conv_id, min(turn) AS aturn FROM c JOIN u USING (conv_id) WHERE role = 'assistant' AND turn > ut GROUP BY conv_id),
s AS (SELECT conv_id, max(turn) AS st FROM c JOIN u USING (conv_id) WHERE role = 'system' AND turn < ut GROUP BY conv_id),
f AS (SELECT u.conv_id, coalesce(x.t || chr(10) || chr(10), '') || y.t AS instruction, z.t AS output FROM u JOIN a USING (conv_id) LEFT JOIN s USING (conv_id)
      JOIN c y ON y.conv_id = u.conv_id AND y.turn = ut JOIN c z ON z.conv_id = u.conv_id AND z.turn = aturn LEFT JOIN c x ON x.conv_id = u.conv_id AND x.turn = st)
"""


@query(TURN_SQL + "SELECT conv_id, md5(instruction) AS instruction, md5(output) AS output FROM f")
def chat_first_turn(spark, sf_dir):
    """The first complete turn of every chat."""
    return _turns(spark, sf_dir).where("t IS NOT NULL").select("conv_id", F.md5("t.instruction").alias("instruction"), F.md5("t.output").alias("output"))


@query(TURN_SQL + "SELECT conv_id, length(instruction) >= 10 AND length(output) BETWEEN 20 AND 8000 AS keep FROM f")
def alpaca_gate(spark, sf_dir):
    """Which first turns pass the gate."""
    return _turns(spark, sf_dir).where("t IS NOT NULL").select("conv_id", P.chat_gate(F.col("t")).alias("keep"))


@query("""
SELECT doc_id, CASE WHEN length(i) < 20 THEN 'instruction_too_short' WHEN length(o) < 100 THEN 'output_too_short' WHEN length(o) > 5000 THEN 'output_too_long' WHEN contains(lower(i), 'the re') THEN 'trivial_question' END AS reason
FROM (SELECT doc_id, trim(regexp_extract(text, '^[^\\n]*'), ' ') AS i, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS o FROM documents)
""")
def instruction_quality(spark, sf_dir):
    """The first reason for which a pair is rejected."""
    i, o = T.strip(F.regexp_extract("text", r"^[^\n]*", 0)), T.strip(F.col("text"))
    reason = (
        F.when(F.char_length(i) < 20, "instruction_too_short")
        .when(F.char_length(o) < 100, "output_too_short")
        .when(F.char_length(o) > 5000, "output_too_long")
        .when(L.any_substring(i, ["the re"]), "trivial_question")
    )
    return table(spark, sf_dir, "documents").select("doc_id", reason.alias("reason"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 < 2 AND length(trim(source || ' question')) >= 10 AND length(t) >= 50 THEN 'FACTUAL' END AS type, CASE WHEN doc_id % 3 < 2 AND length(trim(source || ' question')) >= 10 AND length(t) >= 50 THEN md5(t) END AS output
FROM (SELECT doc_id, source, regexp_replace(text, '[^a-zA-Z .]', '', 'g') AS r, trim(regexp_replace(text, '[^a-zA-Z .]', '', 'g')) AS t FROM documents)
""")
def qa_json_repair(spark, sf_dir):
    """Pairs out of fenced, wrapped and broken replies."""
    plain = F.regexp_replace("text", "[^a-zA-Z .]", "")
    listed = F.concat(F.lit('[{"instruction": "'), "source", F.lit(' question", "output": "'), plain, F.lit('", "type": " factual "}]'))
    reply = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("```json\n"), listed, F.lit("\n```"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("Here: "), listed, F.lit(" done"))).otherwise(F.lit("no list"))
    told = table(spark, sf_dir, "documents").select("doc_id", P.qa_pairs(reply).alias("p"))
    return told.select("doc_id", F.try_element_at("p", F.lit(1))["type"].alias("type"), F.md5(F.try_element_at("p", F.lit(1))["output"]).alias("output"))


@query("""
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'ABD' WHEN 1 THEN 'ABD' WHEN 2 THEN 'B' WHEN 3 THEN 'C' WHEN 4 THEN 'B' ELSE '' END AS answer FROM events
""")
def answer_extract(spark, sf_dir):
    """Option letters of replies of six kinds."""
    replies = F.array(*[F.lit(x) for x in ("ABD", "A, B and D", "B. False", "The answer is C", "<think>A</think>B", "")])
    valid = F.array(*[F.lit(x) for x in "ABCD"])
    return table(spark, sf_dir, "events").select("event_id", P.answer_letters(F.element_at(replies, (F.col("event_id") % 6 + 1).cast("int")), valid).alias("answer"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN '5,7,9' WHEN 1 THEN '1,2,3' END AS selected FROM events")
def selection_parse(spark, sf_dir):
    """Numbers that replies select."""
    replies = F.array(*[F.lit(x) for x in ('x {"selected": [5, 7, 9]} y', "I take 1, 2 and 99, then 2, 3", "none")])
    chosen = P.selection(F.element_at(replies, (F.col("event_id") % 3 + 1).cast("int")))
    return table(spark, sf_dir, "events").select("event_id", F.when(chosen.isNotNull(), F.array_join(chosen.cast("array<string>"), ",")).alias("selected"))


@query("SELECT item_id, md5('[1] ' || substr(text, 1, 1500) || chr(10) || chr(10) || 'Question: ' || substr(text, 1, 60) || chr(10) || 'A. yes' || chr(10) || 'B. no' || chr(10) || 'Answer:') AS prompt FROM benchmark")
def question_prompt(spark, sf_dir):
    """Prompts of questions with passages."""
    options = F.create_map(F.lit("B"), F.lit("no"), F.lit("A"), F.lit("yes"))
    return table(spark, sf_dir, "benchmark").select("item_id", F.md5(P.question_prompt(F.substring("text", 1, 60), options, F.array("text"))).alias("prompt"))


# --- retrieval


#: The pieces of every text in order (P paragraphs, S sentences of long ones between F and E, Z the end), taken one by one.
CHUNKS_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id AS id, string_split_regex(replace(coalesce(text, ''), chr(10), chr(10) || chr(10)), '\n\s*\n') AS ps FROM documents),
p AS (SELECT id, n, trim(p, ' ' || chr(9) || chr(10) || chr(13)) AS p FROM (SELECT id, unnest(range(1, len(ps) + 1)) AS n, unnest(ps) AS p FROM d)),
t AS (SELECT *, CAST(floor(len(string_split_regex(p, '\s+')) * CAST(1.3 AS DOUBLE)) AS INTEGER) AS tok FROM p WHERE p <> ''),
l AS (SELECT id, n, string_split(regexp_replace(p, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS ss FROM t WHERE tok > 512),
o AS (SELECT id, n, 0 AS m, 'P' AS kind, p AS text, tok FROM t WHERE tok <= 512
      UNION ALL SELECT id, n, 0, 'F', '', 0 FROM l UNION ALL SELECT id, n, 1000000000, 'E', '', 0 FROM l
      UNION ALL SELECT id, n, m, 'S', s, CAST(floor(len(string_split_regex(s, '\s+')) * CAST(1.3 AS DOUBLE)) AS INTEGER) FROM (SELECT id, n, unnest(range(1, len(ss) + 1)) AS m, unnest(ss) AS s FROM l)
      UNION ALL SELECT DISTINCT id, 1000000000, 0, 'Z', '', 0 FROM t),
q AS (SELECT id, kind, text, tok, row_number() OVER (PARTITION BY id ORDER BY n, m) AS i FROM o),
r AS (SELECT DISTINCT id, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS held, CAST([] AS INTEGER[]) AS sizes, 0 AS size, CAST(NULL AS VARCHAR) AS chunk FROM q
      UNION ALL
      SELECT id, i,
             CASE WHEN kind = 'E' THEN [array_to_string(held, ' ')] WHEN kind IN ('F', 'Z') THEN CAST([] AS VARCHAR[]) WHEN taken THEN list_append(held[len(held) - tail + 1:], text) ELSE list_append(held, text) END,
             CASE WHEN kind = 'E' THEN [CAST(floor(len(string_split_regex(array_to_string(held, ' '), '\s+')) * CAST(1.3 AS DOUBLE)) AS INTEGER)] WHEN kind IN ('F', 'Z') THEN CAST([] AS INTEGER[]) WHEN taken THEN list_append(sizes[len(sizes) - tail + 1:], tok) ELSE list_append(sizes, tok) END,
             CAST(CASE WHEN kind = 'E' THEN size WHEN kind IN ('F', 'Z') THEN 0 WHEN taken THEN coalesce(list_sum(sizes[len(sizes) - tail + 1:]), 0) + tok ELSE size + tok END AS INTEGER),
             CASE WHEN taken AND kind = 'S' THEN array_to_string(held, ' ') WHEN taken THEN array_to_string(held, E'\n\n') END
      FROM (SELECT q.*, r.held, r.sizes, r.size, len(r.held) > 0 AND (q.kind IN ('F', 'Z') OR q.kind IN ('P', 'S') AND r.size + q.tok > 512) AS taken,
                   len(list_filter(range(1, len(r.sizes) + 1), lambda j: list_sum(r.sizes[len(r.sizes) - j + 1:]) <= 128)) AS tail
            FROM r JOIN q ON q.id = r.id AND q.i = r.i + 1))
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS INTEGER) AS chunk_no, 'fulltext' AS chunk_type, md5(chunk) AS digest FROM r WHERE chunk IS NOT NULL
"""


@query(CHUNKS_SQL)
def chunk_documents(spark, sf_dir):
    """Chunks of every document, its lines taken for paragraphs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return R.chunk_documents(docs).select("id", "chunk_no", "chunk_type", F.md5("text").alias("digest"))


TOP_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), q AS (SELECT * FROM v WHERE vec_id % 100 = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, {score} AS score FROM q JOIN v ON q.vec_id <> v.vec_id)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query(TOP_SQL.format(score="list_dot_product(q.e, v.e)"))
def topk_inner_product(spark, sf_dir):
    """The five vectors of the largest inner product for every hundredth."""
    v = table(spark, sf_dir, "embeddings")
    return R.top_k(v.where("vec_id % 100 = 0"), v, 5).select("query_id", "vec_id", "rank")


@query(TOP_SQL.format(score="list_dot_product(q.e, v.e)"))
def topk_stored_index(spark, sf_dir):
    """The same through a stored index of blocks, of which a search reads those that can matter."""
    vectors, path = table(spark, sf_dir, "embeddings"), scratch_path(spark, "vector-index")
    VI.write_index(vectors, path)
    return VI.search_index(vectors.where("vec_id % 100 = 0"), spark, path, 5).select("query_id", "vec_id", "rank")


@query(TOP_SQL.format(score="list_cosine_similarity(q.e, v.e)"))
def topk_cosine(spark, sf_dir):
    """The five vectors of the smallest angle for every hundredth."""
    v = table(spark, sf_dir, "embeddings")
    return R.top_k(v.where("vec_id % 100 = 0"), v, 5, cosine=True).select("query_id", "vec_id", "rank")


@query("SELECT vec_id, round(list_dot_product(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS square, CAST(1 AS DOUBLE) AS unit FROM embeddings")
def l2_normalise(spark, sf_dir):
    """Squared lengths, and those of the normalised vectors."""
    unit = R.normalised(F.col("embedding"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(R.dot(F.col("embedding"), F.col("embedding")), 4).alias("square"), F.round(R.dot(unit, unit), 6).alias("unit"))


# --- records and markup


@query("SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS abstract FROM (SELECT conv_id, turn, text || '#' || turn AS text FROM conversations) GROUP BY conv_id HAVING max(turn) = count(*) - 1")
def inverted_index_text(spark, sf_dir):
    """Texts put together from maps of words to positions."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat("text", F.lit("#"), "turn").alias("w"))
    index = said.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct("w", F.array(F.col("turn").cast("int"))))).alias("i"), F.max("turn").alias("last"), F.count("*").alias("n"))
    return index.where("last = n - 1").select("conv_id", T.inverted_index_text(F.col("i")).alias("abstract"))


@query("SELECT event_id, 'W' || event_id AS work_id, CAST(user_id AS VARCHAR) || '; ' || event_type AS authors, event_type AS institutions, event_type AS venue, CAST(event_id % 9 AS INTEGER) AS cited_by_count FROM events")
def flatten_work(spark, sf_dir):
    """Nested works as flat records."""
    name = lambda c: F.struct(c.alias("display_name"))
    person = lambda c, i: F.struct(name(c).alias("author"), F.array(name(i)).alias("institutions"))
    kind = F.col("event_type")
    work = F.struct(
        F.concat(F.lit("https://openalex.org/W"), "event_id").alias("id"),
        F.array(person(F.col("user_id").cast("string"), kind), person(kind, kind)).alias("authorships"),
        F.struct(name(kind).alias("source")).alias("primary_location"),
        (F.col("event_id") % 9).cast("int").alias("cited_by_count"),
    )
    told = table(spark, sf_dir, "events").select("event_id", kind, F.from_json(F.to_json(work), RC.WORK_SCHEMA).alias("w"))
    return told.select("event_id", RC.flat_work(F.col("w"), kind).alias("r")).select("event_id", "r.work_id", "r.authors", "r.institutions", "r.venue", "r.cited_by_count")


@query("SELECT item_id, 'PMC' || item_id AS pmcid, 'T' || item_id AS title, 'Methods' AS section FROM benchmark WHERE length(regexp_replace(text, '[^a-zA-Z ]', '', 'g')) * 10 >= 500")
def jats_extract(spark, sf_dir):
    """Articles out of XML."""
    words = F.regexp_replace("text", "[^a-zA-Z ]", "")
    xml = F.concat(
        F.lit('<r><article><front><article-meta><article-id pub-id-type="pmc">'), "item_id", F.lit("</article-id><title-group><article-title>T"), "item_id",
        F.lit("</article-title></title-group></article-meta></front><body><sec><title>Funding</title><p>none</p></sec><sec><title>Methods</title><p>"), F.repeat(words, F.lit(10)), F.lit("</p></sec></body></article></r>"),
    )
    files = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("name"), F.encode(xml, "UTF-8").alias("content"))
    return RC.parse_articles(files).select(F.substring("pmcid", 4, 20).cast("bigint").alias("item_id"), "pmcid", "title", F.element_at("sections", 1)["title"].alias("section"))


@query("SELECT 'PMC' || item_id AS pmcid, md5(r) AS digest, CAST(length(r) AS INTEGER) AS text_length FROM (SELECT item_id, 'Title: T' || item_id || chr(10) || chr(10) || 'Keywords: k, l' || chr(10) || chr(10) || 'Methods' || chr(10) || t || chr(10) || chr(10) || 'Figure Descriptions:' || chr(10) || '  F1: a long caption' AS r, t FROM (SELECT item_id, trim(regexp_replace(repeat(regexp_replace(text, '[^a-zA-Z ]', '', 'g') || ' ', 10), '\\s+', ' ', 'g')) AS t FROM benchmark)) WHERE length(t) >= 500")
def article_text(spark, sf_dir):
    """Articles in XML as texts."""
    words = F.regexp_replace("text", "[^a-zA-Z ]", "")
    xml = F.concat(
        F.lit('<r><article><front><article-meta><article-id pub-id-type="pmc">'), "item_id", F.lit("</article-id><title-group><article-title>T"), "item_id", F.lit("</article-title></title-group><kwd>k</kwd><kwd>l</kwd></article-meta></front><body><sec><title>Methods</title><p>"),
        F.repeat(F.concat(words, F.lit(" ")), F.lit(10)), F.lit("</p></sec></body><fig><label>F1</label><caption><p>a long caption</p></caption></fig></article></r>"),
    )
    files = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("name"), F.encode(xml, "UTF-8").alias("content"))
    return RC.parse_articles(files).select("pmcid", F.md5("full_text").alias("digest"), "text_length")


@query("SELECT 'PMC' || item_id AS pmcid, section_no, title, CASE WHEN title = 'In' THEN 'inner' ELSE trim(regexp_replace(repeat(regexp_replace(text, '[^a-zA-Z ]', '', 'g') || ' ', 10), '\\s+', ' ', 'g')) END AS text FROM benchmark, (VALUES (0, 'In'), (1, 'Methods')) s(section_no, title) WHERE length(trim(regexp_replace(repeat(regexp_replace(text, '[^a-zA-Z ]', '', 'g') || ' ', 10), '\\s+', ' ', 'g'))) + 5 >= 500")
def exploded_sections(spark, sf_dir):
    """A row for every section of articles in XML, inner sections first."""
    words = F.regexp_replace("text", "[^a-zA-Z ]", "")
    xml = F.concat(
        F.lit('<r><article><front><article-meta><article-id pub-id-type="pmc">'), "item_id", F.lit("</article-id></article-meta></front><body><sec><title>Methods</title><p>"),
        F.repeat(F.concat(words, F.lit(" ")), F.lit(10)), F.lit("</p><sec><title>In</title><p>inner</p></sec></sec></body></article></r>"),
    )
    files = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("name"), F.encode(xml, "UTF-8").alias("content"))
    return RC.exploded_sections(RC.parse_articles(files))


@query("SELECT page_id AS id, '2024/01/02' AS date, 'Page ' || page_id AS title, 'https://example.org/p/' || page_id AS url FROM pages")
def html_table_links(spark, sf_dir):
    """Dates, titles and urls of table rows."""
    row = F.concat(F.lit("<tr><td> 2024/01/02 </td><td><a class='x' href='/p/"), "page_id", F.lit("'>Page <b>"), "page_id", F.lit("</b></a></td></tr><tr><td>none</td></tr>"))
    html = F.concat(F.lit("<table><tbody>"), row, F.lit("</tbody></table>"), "html")
    return M.table_links(table(spark, sf_dir, "pages").select("page_id", html.alias("html")), "page_id", "html", "https://example.org")


@query("SELECT page_id, url, 'Page ' || page_id AS title, CAST(length(html) AS VARCHAR) AS chars FROM pages")
def page_headers(spark, sf_dir):
    """Crawled pages written with headers and read again."""
    title = F.concat(F.lit("Page "), "page_id")
    content = M.page_file("crawl", title, F.lit("2024-01-02"), F.col("url"), F.lit("2024-01-03"), F.col("html"))
    told = table(spark, sf_dir, "pages").select("page_id", M.page_header(content).alias("h"))
    return told.select("page_id", F.col("h")["url"].alias("url"), F.col("h")["title"].alias("title"), F.col("h")["chars"].alias("chars"))


@query("SELECT lang, count(*) AS n, count(*) FILTER (regexp_matches(text, '(?i)(the|der)')) AS hits FROM documents GROUP BY lang")
def purity_audit(spark, sf_dir):
    """How many texts of each language match the audit's terms."""
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("text").rlike("(?i)(the|der)")).alias("hits"))


# --- sources and sinks


@query("SELECT doc_id, source, md5(text) AS digest FROM documents")
def json_round_trip(spark, sf_dir):
    """Documents written as JSON lines and read again."""
    path = scratch_path(spark, "json")
    SK.write_json(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), path)
    return RD.json_lines(spark, path, "doc_id bigint, text string, source string").select("doc_id", "source", F.md5("text").alias("digest"))


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def csv_round_trip(spark, sf_dir):
    """Documents written as CSV and read again."""
    path = scratch_path(spark, "csv")
    SK.write_csv(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return RD.csv_table(spark, path, "doc_id bigint, text string").select("doc_id", F.md5("text").alias("digest"))


@query("SELECT doc_id, source FROM documents")
def csv_with_mark(spark, sf_dir):
    """Documents written as CSV with a byte order mark, which the reader takes off."""
    path = scratch_path(spark, "csv-mark")
    SK.write_csv(table(spark, sf_dir, "documents").select("doc_id", "source"), path, mark=True)
    return RD.csv_table(spark, path, "doc_id bigint, source string")


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def split_sink(spark, sf_dir):
    """Documents written in a folder for each language, and counted from there."""
    path = scratch_path(spark, "split")
    SK.write_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), path, "lang")
    return spark.read.schema("doc_id bigint, lang string").json(path).groupBy("lang").agg(F.count("*").alias("n"))


@query("SELECT event_type, event_id FROM events")
def upsert_sink(spark, sf_dir):
    """Events written by type, one type written again."""
    path, events = scratch_path(spark, "upsert"), table(spark, sf_dir, "events").select("event_type", "event_id")
    SK.upsert(events, path, "event_type")
    SK.upsert(events.where("event_type = 'click'"), path, "event_type")
    return spark.read.schema("event_id bigint, event_type string").parquet(path)


@query("SELECT key, CAST(value ->> 'n' AS BIGINT) AS n FROM (SELECT unnest(json_keys(d)) AS key, d FROM (SELECT json_group_object(k, json_object('n', n)) AS d FROM (SELECT event_type AS k, CASE WHEN event_type = 'click' THEN 7 ELSE count(*) END AS n FROM events GROUP BY event_type))) t, LATERAL (SELECT json_extract(d, '$.' || key) AS value)")
def upsert_document(spark, sf_dir):
    """Results by model in one JSON document, one model's replaced."""
    path = scratch_path(spark, "upsert-document")
    results = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model")).agg(F.count("*").alias("n"))
    SK.upsert(results, path, "model")
    SK.upsert(results.where("model = 'click'").withColumn("n", F.lit(7).cast("bigint")), path, "model")
    document = SK.as_document(spark.read.schema("n bigint, model string").parquet(path), "model")
    told = document.select(F.explode(F.from_json("document", "results map<string, struct<n: bigint>>")["results"]).alias("key", "value"))
    return told.select("key", F.col("value.n").alias("n"))


@query("SELECT 'n' AS metric, CAST(count(*) AS DOUBLE) AS value FROM documents UNION ALL SELECT 'chars', CAST(sum(n_chars) AS DOUBLE) FROM documents")
def statistics_report(spark, sf_dir):
    """Statistics as rows of metrics."""
    return SK.statistics(table(spark, sf_dir, "documents").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars")))


# --- streams


def _events(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    # the stream reads folders: the table's own, through a glob of its name
    return I.file_stream(spark, f"{sf_dir}/events.parque[t]", schema).withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT user_id, event_type FROM events GROUP BY ALL")
def events_dedup_available_now(spark, sf_dir):
    """Users and types, each when first seen."""
    return I.run_available(I.first_seen(_events(spark, sf_dir).select("user_id", "event_type"), ["user_id", "event_type"]), "stream-first")


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def events_tumbling_counts(spark, sf_dir):
    """Events of every hour and type."""
    return I.run_available(I.tumbling_counts(_events(spark, sf_dir), "ts", "1 hour", [F.col("event_type")], "1 hour"), "stream-hours", "complete")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS first FROM events),
s AS (SELECT user_id, ts, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g)
SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, user_id, count(*) AS n FROM s GROUP BY user_id, no
""")
def events_session_counts(spark, sf_dir):
    """Events of every user's sessions."""
    return I.run_available(I.session_counts(_events(spark, sf_dir), "ts", "30 minutes", "user_id", "1 hour"), "stream-sessions", "complete")


@query("SELECT event_id, event_type, tokens FROM (SELECT event_id, event_type, 10 AS tokens, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r FROM events) WHERE (r - 1) * 10 < 500")
def budget_running_stream(spark, sf_dir):
    """Events of every type up to a budget."""
    told = _events(spark, sf_dir).select("event_id", "event_type", F.lit(10).alias("tokens"))
    return I.run_budget(told, "event_type", "event_id", "tokens", 500, "stream-budget")


# --- stored forms: paged sources, lexicons of many terms, counters of a pass, versions


@query("SELECT page_id // 16 AS shelf, count(*) AS n, CAST(sum(length(html)) AS BIGINT) AS chars, count(DISTINCT url) AS urls FROM pages WHERE page_id // 16 >= 2 GROUP BY 1")
def paged_shelves(spark, sf_dir):
    """Pages stored as the shelves of a paginated service, and read from it by ranges; the filter narrows the range."""
    path = scratch_path(spark, "shelves")
    pages = table(spark, sf_dir, "pages").select(F.expr("page_id div 16").alias("shelf"), "page_id", "url", "html")
    PG.stored_pages(pages, "shelf", path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    name = "shelves_" + path.rpartition("-")[2]
    PG.register_paged(spark, name, PG.FolderService(path), "shelf bigint, page_id bigint, url string, html string", "shelf", most=400, page_size=100)
    found = spark.read.format(name).load().where("shelf >= 2")
    return found.groupBy("shelf").agg(F.count("*").alias("n"), F.sum(F.char_length("html")).alias("chars"), F.countDistinct("url").alias("urls"))


@query(r"""
WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS term FROM benchmark), n AS (SELECT DISTINCT lower(n_name) AS term FROM nation)
SELECT doc_id, (SELECT count(*) FROM t WHERE contains(lower(d.text), term)) AS n_benchmark, (SELECT count(*) FROM n WHERE contains(lower(d.text), term)) AS n_nations FROM documents d
""")
def lexicon_terms(spark, sf_dir):
    """How many words of the benchmark, and names of nations, stand in every document, by one automaton for both lists."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("w")).distinct()
    lists = {"benchmark": [r.w for r in words.collect()], "nations": [r.n_name for r in table(spark, sf_dir, "nation").collect()]}  # word lists, small by their purpose
    found = AM.lexicon_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", AM.Automaton(lists))
    return found.select("doc_id", *[F.size(c).cast("bigint").alias(f"n_{c}") for c in ("benchmark", "nations")])


@query("SELECT count(*) AS n, count(*) FILTER (length(text) >= 500) AS kept, count(*) FILTER (NOT length(text) >= 500) AS dropped, count(*) FILTER (text IS NULL) AS errors, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents")
def counted_pass(spark, sf_dir):
    """Kept and dropped documents, counted by the pass that writes them."""
    decision = F.when(F.col("text").isNull(), "error").when(F.char_length("text") >= 500, "kept").otherwise("dropped")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", decision.alias("decision"))
    is_ = lambda d: F.count_if(F.col("decision") == d)
    counters = {"n": F.count("*"), "kept": is_("kept"), "dropped": is_("dropped"), "errors": is_("error"), "chars": F.sum(F.char_length("text"))}
    return SK.write_counted(docs, scratch_path(spark, "counted"), counters, "decision")


@query("""
SELECT 0 AS version, event_type, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 1, event_type, count(*) FROM events WHERE value > 50 GROUP BY ALL
""")
def table_versions(spark, sf_dir):
    """Two versions of a table, each read as it was written."""
    path, events = scratch_path(spark, "versions"), table(spark, sf_dir, "events").select("event_type", "value")
    numbers = [SK.next_version(spark, rows, path) for rows in (events, events.where("value > 50"))]
    each = [SK.read_version(spark, path, n).groupBy("event_type").agg(F.count("*").alias("n")).withColumn("version", F.lit(n)) for n in numbers]
    return each[0].unionByName(each[1]).select("version", "event_type", "n")
