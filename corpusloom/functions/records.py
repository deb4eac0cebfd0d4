"""Records of scholarly works: flattening of nested ones, and articles in JATS XML."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import inverted_index_text

# The schema of a work, and the titles of sections that are left out.
WORK_SCHEMA = (
    "id string, doi string, title string, abstract_inverted_index map<string, array<int>>, publication_year int, publication_date string, cited_by_count int, "
    "authorships array<struct<author struct<display_name string>, institutions array<struct<display_name string>>>>, concepts array<struct<display_name string>>, "
    "primary_location struct<source struct<display_name string>>, open_access struct<is_oa boolean>, type string, language string"
)
SKIPPED_SECTIONS = frozenset(
    {
        "competing interests",
        "conflict of interest",
        "conflicts of interest",
        "credit authorship contribution statement",
        "authorship contribution",
        "declaration of competing interest",
        "author contributions",
        "funding",
        "acknowledgements",
        "acknowledgments",
        "acknowledgment",
        "data availability",
        "supplementary material",
        "supplementary data",
        "abbreviations",
        "ethics statement",
        "ethical approval",
    }
)
ARTICLE_SCHEMA = "pmcid string, title string, abstract string, keywords array<string>, journal string, sections array<struct<title string, text string>>, figure_captions array<string>, table_captions array<string>, full_text string, text_length bigint"


def _joined(names: Column) -> Column:
    """Filled names joined by semicolons, null if there are none."""
    filled = F.filter(names, lambda n: n != "")
    return F.when(F.size(filled) > 0, F.array_join(filled, "; "))


def flat_work(work: Column, label: Column) -> Column:
    """A nested work as one flat struct: ids without their web prefix, ten authors and concepts, five institutions of
    the first five authors (two of each, in order of name)."""
    institutions = F.flatten(F.transform(F.slice(work["authorships"], 1, 5), lambda a: F.transform(F.slice(a["institutions"], 1, 2), lambda i: i["display_name"])))
    return F.struct(
        F.replace(F.coalesce(work["id"], F.lit("")), F.lit("https://openalex.org/"), F.lit("")).alias("work_id"),
        F.when(work["doi"] != "", F.replace(work["doi"], F.lit("https://doi.org/"), F.lit(""))).alias("doi"),
        work["title"].alias("title"),
        inverted_index_text(work["abstract_inverted_index"]).alias("abstract"),
        work["publication_year"].alias("publication_year"),
        work["publication_date"].alias("publication_date"),
        work["primary_location"]["source"]["display_name"].alias("venue"),
        F.coalesce(work["cited_by_count"], F.lit(0)).alias("cited_by_count"),
        _joined(F.transform(F.slice(work["authorships"], 1, 10), lambda a: a["author"]["display_name"])).alias("authors"),
        _joined(F.slice(F.array_sort(F.array_distinct(institutions)), 1, 5)).alias("institutions"),
        _joined(F.transform(F.slice(work["concepts"], 1, 10), lambda c: c["display_name"])).alias("keywords"),
        F.coalesce(work["open_access"]["is_oa"], F.lit(False)).alias("is_open_access"),
        work["type"].alias("type"),
        work["language"].alias("language"),
        label.alias("primary_concept"),
    )


def _flat(element: ET.Element | None) -> str:
    """All text of an element in order, without pictures; references and scripts give their own text only."""
    if element is None:
        return ""
    out, stack = [], [(element, 0)]
    while stack:
        node, at = stack.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        tag = node.tag.lower() if isinstance(node.tag, str) else ""
        if at and tag in ("graphic", "media", "inline-graphic"):
            continue
        if node.text:
            out.append(node.text)
        if at and tag in ("xref", "ext-link", "uri", "sup", "sub"):
            continue
        for child in reversed(node):
            if child.tail:
                stack.append((child.tail, 1))
            stack.append((child, 1))
    return "".join(out).strip()


def _tidy(text: str) -> str:
    text = re.sub(r"\[[\d,\s\-–]+\]", "", re.sub(r"\s+", " ", text))
    return re.sub(r"\s+([.,;:!?])", r"\1", re.sub(r"\.{2,}", ".", text)).strip()


def _abstract(meta: ET.Element) -> str:
    found = meta.find(".//abstract")
    if found is None:
        return ""
    text = lambda e: " ".join(_flat(p) for p in e.iterfind(".//p"))
    sections = [(_flat(s.find("title")), text(s)) for s in found.iterfind(".//sec")]
    if sections:
        return " ".join(f"{t}: {b}" if t else b for t, b in sections if b)
    return text(found) if found.find(".//p") is not None else _flat(found)


def _sections(body: ET.Element | None) -> list[tuple[str, str]]:
    """Sections with paragraphs of their own, inner ones first; a skipped title drops all that it holds."""
    if body is None:
        return []
    filled = lambda e: " ".join(t for t in map(_flat, e.findall("p")) if t)

    def walk(section: ET.Element) -> Iterator[tuple[str, str]]:
        title = _flat(section.find("title"))
        if title.lower() in SKIPPED_SECTIONS:
            return
        for inner in section.findall("sec"):
            yield from walk(inner)
        if text := filled(section):
            yield title, text

    found = [s for section in body.findall("sec") for s in walk(section)]
    return found or ([("", filled(body))] if filled(body) else [])


def _captions(article: ET.Element, tag: str) -> list[str]:
    told = ((_flat(e.find("label")), _flat(e.find("caption"))) for e in article.iter(tag))
    return [_tidy(f"{label}: {text}" if label else text) for label, text in told if len(text) > 10]


def parse_article(data: bytes | str, name: str = "", least_body: int = 500) -> dict | None:
    """The parts of a JATS article, or null if it is none or its sections are too short."""
    try:
        root = ET.fromstring(data)
    except ET.ParseError:
        return None
    article = root.find(".//article")
    if article is None and root.tag == "article":
        article = root
    meta = article.find(".//article-meta") if article is not None else None
    if meta is None:
        return None
    sections = _sections(article.find(".//body"))
    if sum(len(t) for _, t in sections) < least_body:
        return None
    title, abstract = _tidy(_flat(meta.find(".//article-title"))), _tidy(_abstract(meta))
    keywords = [k for k in map(_flat, meta.iterfind(".//kwd")) if k]
    ids = [e.text for e in meta.iterfind(".//article-id") if e.get("pub-id-type") == "pmc" and e.text]
    tidy = [(t, _tidy(x)) for t, x in sections]
    figures, tables = _captions(article, "fig"), _captions(article, "table-wrap")
    lines = [f"Title: {title}"] if title else []
    lines += [f"\nAbstract: {abstract}"] if abstract else []
    lines += [f"\nKeywords: {', '.join(keywords)}"] if keywords else []
    lines += [f"\n{t}\n{x}" if t else f"\n{x}" for t, x in tidy]
    for head, captions in (("Figure", figures), ("Table", tables)):
        lines += [f"\n{head} Descriptions:", *(f"  {c}" for c in captions)] if captions else []
    text = "\n".join(lines)
    return {
        "pmcid": f"PMC{ids[0]}" if ids else name,
        "title": title,
        "abstract": abstract,
        "keywords": keywords,
        "journal": _flat(root.find(".//journal-title")),
        "sections": [{"title": t, "text": x} for t, x in tidy],
        "figure_captions": figures,
        "table_captions": tables,
        "full_text": text,
        "text_length": len(text),
    }


def parse_articles(files: DataFrame, name_col: str = "name", content_col: str = "content") -> DataFrame:
    """One row for every article of a table of XML files."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = (parse_article(content, name) for name, content in zip(frame.iloc[:, 0], frame.iloc[:, 1], strict=True) if content)
            rows = [a for a in found if a]
            if rows:
                yield pd.DataFrame(rows)

    return files.select(name_col, content_col).mapInPandas(run, ARTICLE_SCHEMA)


def exploded_sections(articles: DataFrame) -> DataFrame:
    """A row for every section of every article: ``pmcid``, ``section_no`` from 0, ``title``, ``text``."""
    return articles.select("pmcid", F.posexplode("sections").alias("section_no", "s")).select("pmcid", "section_no", "s.title", "s.text")


def exploded_captions(articles: DataFrame) -> DataFrame:
    """A row for every caption: ``pmcid``, ``kind`` (figure or table), ``caption_no`` from 0 in its kind, ``caption``."""
    parts = [articles.select("pmcid", F.lit(kind).alias("kind"), F.posexplode(f"{kind}_captions").alias("caption_no", "caption")) for kind in ("figure", "table")]
    return parts[0].union(parts[1])
