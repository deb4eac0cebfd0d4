"""Text cleaning, keys and formatting as column expressions.

White space is ASCII white space as the JVM's ``\\s`` has it. A null input gives null, unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and tables that results depend on.
CITATION_SQUARE = r"\[\s*\d+(?:\s*[,\-–]\s*\d+)*\s*\]"
CITATION_ROUND = r"\(\s*\d{1,3}(?:\s*[,\-–]\s*\d{1,3})*\s*\)"
CITATION_JATS = r"\[[\d,\s\-–]+\]"
HTML_TAG = r"<[^>]+>"
NUMBER = r"\d+\.?\d*(?:[eE][+-]?\d+)?"
NUMBER_LINE = rf"(?m)^[ \t]*(?:{NUMBER}[ \t]+){{5,}}{NUMBER}[ \t]*$"
BORDER_LINE = r"(?m)^[ \t]*(?:[+|][-=]+){2,}[+|]?[ \t]*$|^[ \t]*[-─━═]{10,}[ \t]*$"
TAB_LINE = r"(?m)^[^\t\n]{0,30}(?:\t[^\t\n]{0,30}){3,}$"
CONTROL_ASCII = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
CONTROL_ANY = r"[\p{C}&&[^\n\t]]"
#: First code point of a mathematical alphabet, its length and what it stands for.
MATH_ALPHABETS = (
    (0x1D400, 26, "A"),
    (0x1D41A, 26, "a"),
    (0x1D434, 26, "A"),
    (0x1D44E, 26, "a"),
    (0x1D468, 26, "A"),
    (0x1D482, 26, "a"),
    (0x1D49C, 26, "A"),
    (0x1D4B6, 26, "a"),
    (0x1D4D0, 26, "A"),
    (0x1D4EA, 26, "a"),
    (0x1D7CE, 10, "0"),
    (0x1D7D8, 10, "0"),
    (0x1D7E2, 10, "0"),
    (0x1D7EC, 10, "0"),
    (0x1D7F6, 10, "0"),
)
#: Characters of wrongly decoded Greek text, and what was meant.
MOJIBAKE = (
    ("尾", "β"),
    ("伪", "α"),
    ("纬", "γ"),
    ("未", "δ"),
    ("渭", "μ"),
    ("蟺", "π"),
    ("蠁", "φ"),
    ("蠂", "χ"),
    ("蠅", "ω"),
    ("螝", "Δ"),
    ("鈭", "−"),
    ("垎", "Δ"),
    ("聽", " "),
)
#: Question types and the words that mean them.
TYPE_WORDS = {
    "ANALYTICAL": ("ANALYTICAL", "ANALYSIS", "ANALYZE"),
    "METHODOLOGICAL": ("METHODOLOGICAL", "METHODOLOGIC", "METHOD"),
    "SYNTHESIS": ("SYNTHESIS", "SYNTHESIZE", "PREDICT"),
    "APPLICATION": ("APPLICATION", "APPLY", "PRACTICAL"),
    "FACTUAL": ("FACTUAL", "FACT", "KNOWLEDGE", "RECALL"),
    "MECHANISTIC": ("MECHANISTIC", "MECHANISM", "EXPLAIN"),
}


def _math() -> tuple[str, str]:
    points = [(chr(first + i), chr(ord(base) + i)) for first, n, base in MATH_ALPHABETS for i in range(n)]
    return "".join(a for a, _ in points), "".join(b for _, b in points)


MATH_FROM, MATH_TO = _math()


def drop(text: Column, pattern: str) -> Column:
    """The text without what matches."""
    return F.regexp_replace(text, pattern, "")


def strip(text: Column) -> Column:
    """The text without white space at its ends."""
    # the characters of \s; a pattern would be tried at every white space of the text
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def words(text: Column) -> Column:
    """The words between white space."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")).cast("bigint"), F.lit(0).cast("bigint"))


def estimate_tokens(text: Column) -> Column:
    """Words times 1.3, rounded down."""
    return F.floor(word_count(text) * F.lit(1.3)).cast("bigint")


def chars_to_tokens(n_chars: Column) -> Column:
    """A token for every four characters, rounded down."""
    return F.floor(n_chars / 4).cast("bigint")


def strip_citations(text: Column) -> Column:
    """Without markers like [1], [2,3], [1-5], (1) and (12, 13)."""
    return drop(drop(text, CITATION_SQUARE), CITATION_ROUND)


def strip_html(text: Column) -> Column:
    """Without tags; what stands between them stays."""
    return drop(text, HTML_TAG)


def fix_whitespace(text: Column) -> Column:
    """One space for white space, none before and one behind punctuation that a letter follows, none at the ends."""
    text = F.regexp_replace(F.regexp_replace(text, r"[\t\r\n]+", " "), r" {2,}", " ")
    text = F.regexp_replace(text, r"\s+([.,;:!?)])", "$1")
    return strip(F.regexp_replace(text, r"([.,;:!?])([A-Za-z])", "$1 $2"))


def drop_control(text: Column) -> Column:
    """Without control, format and unassigned characters, but with line ends and tabs."""
    return drop(text, CONTROL_ANY)


def math_to_ascii(text: Column) -> Column:
    """Mathematical letters and digits as plain ones."""
    return F.translate(text, MATH_FROM, MATH_TO)


def fix_mojibake(text: Column) -> Column:
    """Greek letters for what they were wrongly decoded to."""
    return F.translate(text, "".join(a for a, _ in MOJIBAKE), "".join(b for _, b in MOJIBAKE))


def drop_table_lines(text: Column) -> Column:
    """Lines of numbers, borders and short tab-separated cells become empty lines."""
    return drop(drop(drop(text, NUMBER_LINE), BORDER_LINE), TAB_LINE)


def tidy_lines(text: Column) -> Column:
    """No control characters, at most three line ends in a row, no white space at ends of lines and of the text."""
    text = F.regexp_replace(drop(text, CONTROL_ASCII), r"\n{4,}", "\n\n\n")
    return strip(F.regexp_replace(text, r"(?m)[^\S\n]+$", ""))


def clean_full_text(text: Column) -> Column:
    """The cleaning of a paper's body."""
    return tidy_lines(drop_table_lines(math_to_ascii(fix_mojibake(text))))


def clean_abstract(text: Column) -> Column:
    """The light cleaning of an abstract."""
    return strip(drop(math_to_ascii(fix_mojibake(text)), CONTROL_ASCII))


def clean_jats(text: Column) -> Column:
    """The cleaning of text taken from article XML; null gives the empty text."""
    text = drop(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "), CITATION_JATS)
    return strip(F.regexp_replace(F.regexp_replace(text, r"\.{2,}", "."), r"\s+([.,;:!?])", "$1"))


def title_key(title: Column) -> Column:
    """Key of a title for deduplication, which may end in a space; null gives the empty key."""
    return F.regexp_replace(drop(F.lower(strip(F.coalesce(title, F.lit("")))), r"[^a-z0-9\s]"), r"\s+", " ")


def doi_key(doi: Column) -> Column:
    """Key of a document identifier."""
    return F.lower(strip(doi))


def tier(citations: Column) -> Column:
    """1 from 50 citations, 2 from 10, else (null too) 3."""
    return F.when(citations >= 50, 1).when(citations >= 10, 2).otherwise(3)


def abstract_quality(abstract: Column) -> Column:
    """none (null or under 50 characters), short (under 200) or good."""
    return F.when(F.char_length(abstract) >= 200, "good").when(F.char_length(abstract) >= 50, "short").otherwise("none")


def question_type(kind: Column) -> Column:
    """The type that a label means, else OTHER."""
    label = F.upper(strip(kind))
    found = F.lit(None).cast("string")
    for name, meant in TYPE_WORDS.items():
        found = F.coalesce(found, F.when(label.isin(*meant), name))
    return F.coalesce(found, F.lit("OTHER"))


def _filled(value: Column) -> Column:
    """Null for the empty text."""
    return F.when(value != "", value)


def paper_record(title: Column, authors: Column, year: Column, venue: Column, keywords: Column, abstract: Column, full_text: Column | None = None) -> Column:
    """A paper as one text: a line for every field it has, the abstract if it has more than 50 characters, the body."""
    head = [F.concat(F.lit(f"{name}: "), _filled(value.cast("string"))) for name, value in (("Title", title), ("Authors", authors), ("Year", F.nullif(year, F.lit(0))), ("Venue", venue), ("Keywords", keywords))]
    parts = [*head, F.when(F.char_length(abstract) > 50, F.concat(F.lit("\nAbstract:\n"), strip(abstract)))]
    if full_text is not None:
        parts.append(F.concat(F.lit("\nFull Text:\n"), strip(_filled(full_text))))
    return F.concat_ws("\n", *parts)


def titled_record(title: Column, source: str, text: Column) -> Column:
    """An article of an encyclopedia as one text."""
    return F.concat(F.lit("Title: "), title, F.lit(f"\nSource: {source}\n\n"), text)


def article_id(text: Column, known: Column | None = None) -> Column:
    """The known id, else the MD5 of the first 500 characters."""
    digest = F.md5(F.substring(F.coalesce(text, F.lit("")), 1, 500))
    return digest if known is None else F.coalesce(_filled(known), digest)


def truncate_at_break(text: Column, most: int, marker: str = "") -> Column:
    """Longer texts end at the last blank line of their first ``most`` characters if it lies beyond four fifths of
    them, else at ``most``, and in the marker."""
    head = F.substring(text, 1, most)
    # where the last blank line begins, from 0, or -1
    last = F.when(F.locate("\n\n", F.reverse(head)) > 0, most - F.locate("\n\n", F.reverse(head)) - 1).otherwise(-1)
    cut = F.when(last > most * 0.8, F.substring(head, F.lit(1), last)).otherwise(head)
    return F.when(F.char_length(text) > most, F.concat(cut, F.lit(marker))).otherwise(text)


def header_field(text: Column, name: str) -> Column:
    """The rest of the first line that begins with the field's name, empty if there is none."""
    return strip(F.regexp_extract(text, rf"(?m)^[ \t]*{name}:(.*)$", 1))


def slug(title: Column, most: int = 80) -> Column:
    """A name for files: lower case, word characters, underscores for white space."""
    return F.substring(drop(F.regexp_replace(drop(F.lower(title), r"(?U)[^\w\s-]"), r"[\s_]+", "_"), "^_+|_+$"), 1, most)


def csv_url(url: Column) -> Column:
    """Commas percent-encoded."""
    return F.replace(url, F.lit(","), F.lit("%2C"))


def absolute_url(url: Column, host: str) -> Column:
    """The host before a path."""
    return F.when(F.startswith(url, F.lit("/")), F.concat(F.lit(host), url)).otherwise(url)


def date_prefix(date: Column) -> Column:
    """A date as the beginning of a file name."""
    return F.coalesce(_filled(F.replace(date, F.lit("/"), F.lit("-"))), F.lit("undated"))


def paragraphs(text: Column) -> Column:
    """The stripped, filled parts between blank lines."""
    return F.filter(F.transform(F.split(text, r"\n\s*\n"), strip), lambda p: p != "")


def sentences(text: Column) -> Column:
    """The parts behind a full stop, question or exclamation mark and white space."""
    return F.split(text, r"(?<=[.!?])\s+")


def inverted_index_text(index: Column) -> Column:
    """The text of a map from words to positions: gaps are empty words, the last word in order of the map wins a place.

    Places are sorted once; each word is led by as many empty ones as lie between it and the place before.
    """
    places = F.array_sort(F.flatten(F.transform(F.map_entries(index), lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("p"), i.alias("i"), e["key"].alias("w"))))))
    # the one-element arrays bind what is sorted and filtered, which is then computed once
    last = lambda s: F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["p"] != x["p"], F.lit(True)))
    led = lambda s: F.transform(s, lambda x, i: F.concat(F.array_repeat(F.lit(""), x["p"] - F.coalesce(F.get(s, i - 1)["p"], F.lit(-1)) - 1), F.array(x["w"])))
    words = F.transform(F.transform(F.array(places), last), led)[0]
    return F.when(F.size(places) > 0, F.array_join(F.flatten(words), " "))
