"""Text functions on small tables: every trap has a row."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import lexicon as L
from corpusloom.functions import text as T
from corpusloom.functions import unicode as U


def each(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in rows.select("i", f(F.col("v")).alias("r")).orderBy("i").collect()]


CASES = [
    (T.strip_citations, ["a [1], b [2,3] c [1-5] (12) (1234)", None, "(1, 2)[ 3 ]"], ["a , b  c   (1234)", None, ""]),
    (T.strip_html, ["<p>a<br/>b</p> < c", None], ["ab < c", None]),
    (T.fix_whitespace, ["a\t\tb  c ,d.e 3.5 e.g.x\n", None, " "], ["a b c, d. e 3.5 e. g. x", None, ""]),
    (T.drop_control, ["a\x00b​c\n\td", None], ["abc\n\td", None]),
    (T.math_to_ascii, ["𝐀𝐳𝑏𝟎𝟿x"], ["Azb09x"]),
    (T.fix_mojibake, ["伪-尾聽x"], ["α-β x"]),
    (T.drop_table_lines, ["1 2 3 4 5 6\nx\n+--+--+\na\tb\tc\td\n1 2 3\n----------"], ["\nx\n\n\n1 2 3\n"]),
    (T.tidy_lines, ["  a \x07 \n\n\n\n\nb\t\n"], ["a\n\n\nb"]),
    (T.clean_jats, [None, "a  b [1-3] c.. d ,"], ["", "a b  c. d,"]),
    (T.title_key, ["Ünïcode!", "日本", None, "A  b", "a !"], ["ncode", "", "", "a b", "a "]),
    (T.doi_key, [" 10.1/AbC ", None], ["10.1/abc", None]),
    (T.abstract_quality, [None, "x" * 49, "x" * 50, "x" * 199, "x" * 200], ["none", "none", "short", "short", "good"]),
    (T.question_type, [" method", "Fact", "x", None], ["METHODOLOGICAL", "FACTUAL", "OTHER", "OTHER"]),
    (T.slug, ["My  Title: (é) _x-", "a" * 90], ["my_title_é_x-", "a" * 80]),
    (T.csv_url, ["a,b"], ["a%2Cb"]),
    (T.date_prefix, ["2024/01/02", "", None], ["2024-01-02", "undated", "undated"]),
    (lambda c: T.absolute_url(c, "https://h"), ["/x", "http://y"], ["https://h/x", "http://y"]),
    (lambda c: T.header_field(c, "Title"), ["x\n Title: a b \nTitle: c", "no"], ["a b", ""]),
    (lambda c: T.truncate_at_break(c, 10, "~"), ["short", "aaaaaaaaa\n\nbbb", "aa\n\nbbbbbbbbbb", "aaaaaaaa\n\nbbb"], ["short", "aaaaaaaaa\n~", "aa\n\nbbbbbb~", "aaaaaaaa\n\n~"]),
    (U.nfkc, ["ﬁ①", None], ["fi1", None]),
    (U.clean_text, ["<b>ﬁ</b> [1] x ,y", " ", None, "[1]"], ["fi x, y", " ", None, None]),
    (U.folded_title_key, [" Café  Ünï! ", "日本"], ["cafe uni", ""]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_cases(spark, case):
    f, values, want = CASES[case]
    assert each(spark, values, f) == want


def test_counts(spark):
    assert each(spark, ["a b  c", "", None, " x "], T.word_count) == [3, 0, 0, 1]
    assert each(spark, [" ".join("w" * n) for n in (1, 3, 7, 10)], T.estimate_tokens) == [1, 3, 9, 13]
    assert each(spark, [50, 49, 10, 9, None], T.tier, "int") == [1, 2, 2, 3, 3]
    assert each(spark, [7, 8], T.chars_to_tokens, "int") == [1, 2]


@pytest.mark.parametrize("f", [T.strip_citations, T.strip_html, T.tidy_lines, T.math_to_ascii, T.drop_table_lines])
def test_cleaners_are_idempotent(spark, f):
    values = ["a [1] <b>x</b>\n\n\n\n\n1 2 3 4 5 6 7\n𝐀 ", "x\t\ty"]
    once = each(spark, values, f)
    assert each(spark, once, f) == once


def test_parts(spark):
    assert each(spark, ["a\n\n b \n \n\nc", ""], T.paragraphs) == [["a", "b", "c"], []]
    assert each(spark, ["A b. C! d? e"], T.sentences) == [["A b.", "C!", "d?", "e"]]
    assert each(spark, [{"a": [0, 3], "b": [1]}, {"x": [0], "y": [0]}, {}, None], T.inverted_index_text, "map<string, array<int>>") == ["a b  a", "y", None, None]


def test_records(spark):
    row = spark.createDataFrame([("T", "A; B", 0, "V", "", "y" * 51, " body ")], "t string, a string, y int, v string, k string, ab string, f string")
    c = F.col
    full = row.select(T.paper_record(c("t"), c("a"), c("y"), c("v"), c("k"), c("ab"), c("f")).alias("r")).first().r
    assert full == "Title: T\nAuthors: A; B\nVenue: V\n\nAbstract:\n" + "y" * 51 + "\n\nFull Text:\nbody"
    assert row.select(T.titled_record(c("t"), "W", c("f")).alias("r")).first().r == "Title: T\nSource: W\n\n body "
    assert row.select(T.article_id(c("f"), c("k")).alias("r")).first().r == row.select(F.md5("f").alias("r")).first().r


def test_lexicons(spark):
    assert each(spark, ["cured ham", "hamlet", None], lambda c: L.any_padded(c, ["ham "])) == [True, False, False]
    assert each(spark, ["a (b", "x"], lambda c: L.any_substring(c, ["(B"])) == [True, False]
    assert each(spark, ["cafés", "caf x", "CAF"], lambda c: L.any_word(c, ["caf"])) == [False, True, True]
    assert each(spark, ["a b", "b", "z"], lambda c: L.matches_up_to(c, ["a", "b", "c|a"])) == [2, 1, 0]
    assert each(spark, ["net-4", "other", "net-x"], lambda c: L.model_selected(c, ["net", "!x"])) == [True, False, False]
    rows = spark.createDataFrame([(1, "bad safe", "ok"), (2, "safe", ""), (3, "amb", "x" * 501 + " ok"), (4, "amb", "ok"), (5, "none", "ok"), (6, "none", "")], "i int, t string, x string")
    tiers = rows.select("i", L.tiered(F.col("t"), F.col("x"), ["bad"], ["safe"], ["amb"], ["ok"]).alias("r")).orderBy("i").collect()
    assert [r.r for r in tiers] == [None, "safe_title", None, "confirmed_title", "text", None]
    assert each(spark, ["trig", "trig anc"], lambda c: L.trigger_without_anchor(c, c, "trig", "anc")) == [True, False]
    assert each(spark, ["anc", "x"], lambda c: L.anchored(c, F.lit("The Journal"), "anc", ["journal"])) == ["anchor", "journal"]


def test_strip_takes_white_space_at_the_ends_only(spark):
    texts = [" \t\n\x0b\f\ra b\n c \r\n", "a \u2028", "\xa0a ", " \n ", "", None]
    found = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(T.strip(F.col("t"))).collect()]
    assert found == ["a b\n c", "a \u2028", "\xa0a", "", "", None]  # a pattern's $ stands before a last line separator, too
