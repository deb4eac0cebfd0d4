"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of styles: a node is a path of elements (tag, letters of classes and id), and
siblings of one style share a node. Over the host's distinct pages every node gets two entropies, as sums that executors
aggregate by node:

* presentation: the entropy of the sequences of child elements that the node shows (many different ones: important);
* content: one minus the mean entropy of its text blocks over pages (a block that stands on all pages has entropy 1,
  one of a single page 0), so repeated text is unimportant.

Their weighted sum times a prior is a node's importance, and the text of nodes under ``LOW`` goes; nothing else does. The prior
(``PRIORS``) comes from what pages mark: menus, footers, sidebars, adverts, forms, scripts and comments by 0.1, so none of
them stays; words that boilerplate and articles share (notice, banner, widget) by 0.5, so such a box goes if it repeats and
stays if its text is its page's own; an article or main element by 3, so of it goes what most pages share (a disclaimer on 8 of 10
pages); all else by 1. A prior is needed: menus and adverts with other words on every page have the same entropies as articles.

Pages are read twice (for the tree, then for the texts), so that no text is shuffled; only nodes with low importance
are joined back by host.

Defined results: null and empty html give an empty text; broken markup is closed as browsers close it, and a tag that the
page breaks off in is none; equal pages of a host count once; a host with fewer than ``MIN_PAGES`` distinct pages, or a row
without a host, is judged by marks alone, by which a page's article or main element, where it has text, is all of its main
text; so is a page of which the tree would leave nothing. A form around an article or main element, or around all text of a
page, is no form; where class names mark all text of a page, they count for nothing. Digits in classes and ids don't count, so
numbered ones share a node. A node whose importance is just ``LOW`` stays. Pages of any length are read whole, in one pass over their
markup. Repeated rows give repeated results; null ids stay null; an empty table gives an empty result.
Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.batches import bounded, emit
from corpusloom.session import spread, written

#: Weight of the presentation entropy, importance under which a branch goes, and pages that a judgement needs.
PRESENTATION, LOW, MIN_PAGES = 0.1, 0.3, 4
#: Nodes of low importance (8 bytes each) up to which they are broadcast, tasks that share a host beyond that, and nodes of one
#: host that go along with each of its pages; the pages of hosts with more are judged by a join of their blocks.
BROADCAST_NODES, SALTS, NODES_WITH_PAGE = 2_000_000, 64, 4096

# Fixed values of the format: what breaks blocks, has no content, or closes itself.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - frozenset("body dd dt html legend option tbody td tfoot th thead tr".split()) | {"dd", "dt"}
SELF_CLOSING = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"})}
SCOPES = frozenset("html body table td th article section main div button object".split())

#: Elements whose content is raw text up to their end tag; none of it is main text.
RAW = frozenset("script style title textarea iframe noembed noframes".split())

# Presentation prior: marks of what is no main text.
NO_TEXT = RAW | frozenset("head noscript template object svg math canvas audio video nav footer aside button select input option datalist dialog menu search".split())
MARKS = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs masthead footer sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist respond replies disqus pagination pager".split())
#: Words of classes that boilerplate and parts of articles share.
DOUBTFUL = frozenset("notice notices alert banner widget widgets promo promotion popup modal overlay".split())
#: Classes of article elements that are no articles; others of theirs often name topics, so parts of names don't count.
REPLIES = frozenset({"comment", "comments", "comment-body", "reply", "ad", "advert"})
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_LETTERS = re.compile(r"[a-z]+")
_ATTRIBUTE = re.compile(r"""([^\s=/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_NAMED = frozenset(("class", "id", "role", "hidden"))
#: A tag with its attributes (in a value's quotes a tag doesn't end, but for a quote that nothing closes), a comment, or
#: another declaration. Possessive, so that broken markup costs no second look.
_MARKUP = re.compile(
    r"""<(?:(/?)([a-zA-Z][^\s/>]*+)(?:((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>|([^>]*+)>)|!--(?:-?>|.*?(?:--!?>|\Z))|[!?/][^>]*+>?)""",
    re.DOTALL,
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}

#: Marks, and the prior of each.
UNMARKED, BOILERPLATE, ARTICLE, DOUBTED, FORM = range(5)
PRIORS = (1.0, 0.1, 3.0, 0.5, 0.1)


def _hash(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "replace")) - (1 << 63)


class _Element:
    """An open element: its tag, node, marks with and without the words of classes, and the styles of its children."""

    __slots__ = ("block", "children", "loose", "mark", "path", "tag")

    def __init__(self, tag: str, path: int, mark: int, loose: int):
        self.tag, self.path, self.mark, self.loose, self.children = tag, path, mark, loose, []
        self.block = tag in BLOCKS


def _by_tag(tag: str, above: int, given: dict[str, str]) -> int:
    """The mark of an element below one marked ``above``, but for its classes' words."""
    if above == BOILERPLATE or tag in NO_TEXT or "hidden" in given or tag == "header" and above != ARTICLE or given.get("role", "").lower() in ROLES:
        return BOILERPLATE
    if tag in ("article", "main"):
        return BOILERPLATE if not REPLIES.isdisjoint(given.get("class", "").lower().split()) else ARTICLE
    return FORM if tag == "form" else above


class Page:
    """A page's text blocks as (node, mark, text), and its nodes with their sequences of children."""

    def __init__(self, html: str):
        self.stack = [_Element("", 0, UNMARKED, UNMARKED)]
        self.found: list[tuple[int, int, int, str]] = []
        self.shown: dict[int, list[str]] = {}
        self.held: list[str] = []
        self._read(html)
        self._flush()
        while len(self.stack) > 1:
            self._pop()
        marks = 1 if any(mark not in (BOILERPLATE, FORM) for _, mark, _, _ in self.found) else 2
        if marks == 2 and not any(loose not in (BOILERPLATE, FORM) for _, _, loose, _ in self.found):
            self.blocks = [(node, UNMARKED if loose == FORM else loose, text) for node, _, loose, text in self.found]
        else:
            self.blocks = [(b[0], b[marks], b[3]) for b in self.found]

    def _read(self, html: str) -> None:
        at, end = 0, html.rfind(">") + 1
        while True:
            found = _MARKUP.search(html, at, end)
            if found is None:
                break
            if found.start() > at:
                self._text(html[at : found.start()])
            at = found.end()
            tag = found[2]
            if tag is None:
                continue
            tag = tag.lower()
            if found[1]:
                self._end(tag)
                continue
            attributes = found[3] or found[4]
            self._start(tag, attributes)
            if tag in RAW:
                close = _RAW_END[tag].search(html, at)
                if close is None:
                    return
                at = close.start()
        # behind the last tag: text, and maybe the beginning of a tag
        rest = html[at:]
        broken = re.search(r"<[a-zA-Z!?/]", rest)
        self._text(rest[: broken.start()] if broken else rest)

    def _text(self, text: str) -> None:
        self.held.append(unescape(text) if "&" in text else text)

    def _flush(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            self.held = []
            if text:
                top = self.stack[-1]
                owner = next((e for e in reversed(self.stack) if e.block or e.mark != top.mark), self.stack[0])
                self.found.append((owner.path, top.mark, top.loose, text))

    def _pop(self) -> None:
        element = self.stack[-1]
        if element.block:
            self._flush()
        self.stack.pop()
        if element.children:
            self.shown.setdefault(element.path, []).append(" ".join(element.children))

    def _close(self, tags: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        """Close the innermost open element of the tags, unless one of ``until`` is further in."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i].tag in until:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self._close({"p"}, SCOPES)
        if tag in SELF_CLOSING:
            self._close(*SELF_CLOSING[tag])
        block = tag in BLOCKS
        if block:
            self._flush()
        top = self.stack[-1]
        style, names, given = tag, [], {}
        if attributes and not attributes.isspace():
            for m in _ATTRIBUTE.finditer(attributes):
                name = m[1].lower()
                if name in _NAMED and name not in given:
                    value = m[2] or m[3] or m[4] or ""
                    given[name] = unescape(value) if "&" in value else value
            names = _LETTERS.findall(f"{given.get('class', '')} {given.get('id', '')}".lower())
            if names:
                style = f"{tag}.{'.'.join(sorted(set(names)))}"
        if not top.children or top.children[-1] != style:
            top.children.append(style)
        if tag in VOID:
            if tag == "br":
                self.held.append(" ")
            return
        mark, loose = _by_tag(tag, top.mark, given), _by_tag(tag, top.loose, given)
        if names and mark != BOILERPLATE and tag not in ("html", "body", "article", "main"):
            if not MARKS.isdisjoint(names):
                mark = BOILERPLATE
            elif not DOUBTFUL.isdisjoint(names):
                mark = DOUBTED
        if mark != top.mark:
            self._flush()
        self.stack.append(_Element(tag, _hash(top.path, style), mark, loose))

    def _end(self, tag: str) -> None:
        if tag == "br":
            self.held.append(" ")
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                if self.stack[i].block or self.stack[i].mark != self.stack[i - 1].mark:
                    self._flush()
                while len(self.stack) > i:
                    self._pop()
                return
            if tag not in BLOCKS and self.stack[i].block and self.stack[i].tag != "p":
                return  # an inline end tag closes nothing outside its block


def host_key(url: Column) -> Column:
    """A hash of the url's host, null without one; computed by Spark, so that joins by host need no Python."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]+)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(rest != "", F.xxhash64(F.translate(rest, upper, lower)))


#: Kinds of a tree's rows behind those of content, which are its marks: presentation, and the page itself.
SHOWN, SHEET = 10, 11


def tree_rows(key: int | None, html: str | None) -> Iterator[tuple[int, int, int, int, int]]:
    """The page's part of its host's tree: (host, kind, node, feature, page); the kind of content is its mark."""
    if key is None or not html:
        return
    sheet = _hash(html)
    page = Page(html)
    yield key, SHEET, 0, sheet, sheet
    for node, mark, feature in {(n, mark, _hash(text)) for n, mark, text in page.blocks}:
        yield key, mark, node, feature, sheet
    for node, sequences in page.shown.items():
        yield key, SHOWN, node, _hash(*sequences), sheet


def node_importance(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every node of every host's tree: ``host`` (hash), ``node``, ``pages`` of the host, ``presentation``, ``content``, the largest
    ``prior`` that pages give it, ``importance``, and whether any text stands in it (``texts``)."""
    bounded(pages.sparkSession)
    schema = pa.schema([("host", pa.int64()), ("kind", pa.int32()), ("node", pa.int64()), ("feature", pa.int64()), ("page", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from emit((r for k, h in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for r in tree_rows(k, h.as_py())), schema)

    rows = spread(pages.select(host_key(F.col(f"`{url_col}`").cast("string")).alias("host"), F.col(f"`{html_col}`").cast("string").alias("html"))).mapInArrow(run, "host bigint, kind int, node bigint, feature bigint, page bigint")
    features = rows.groupBy("host", "kind", "node", "feature").agg(F.countDistinct("page").alias("n"))
    # of an entropy -sum(p log p) with p = n / s: log(s) - sum(n log n) / s
    sums = features.groupBy("host", "kind", "node").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.log("n")).alias("l"))
    shown, text = F.col("kind") == SHOWN, F.col("kind") < SHOWN
    prior = F.element_at(F.array(*map(F.lit, PRIORS)), F.col("kind") + 1)
    nodes = sums.where(F.col("kind") != SHEET).groupBy("host", "node").agg(
        F.sum(F.when(shown, F.col("s"))).alias("ps"), F.sum(F.when(shown, F.col("l"))).alias("pl"), F.sum(F.when(text, F.col("s"))).alias("cs"), F.sum(F.when(text, F.col("l"))).alias("cl"), F.max(F.when(text, prior)).alias("prior")
    )
    sizes = sums.where(F.col("kind") == SHEET).select(F.col("host").alias("h"), F.col("s").alias("pages"))
    base = F.log(F.greatest("pages", F.lit(2)))
    presentation = F.coalesce((F.log("ps") - F.col("pl") / F.col("ps")) / base, F.lit(0.0))
    content = F.coalesce(1 - F.col("cl") / F.col("cs") / base, F.lit(1.0))
    importance = (F.col("presentation") * PRESENTATION + F.col("content") * (1 - PRESENTATION)) * F.col("prior")
    told = nodes.join(sizes, F.col("host") == F.col("h")).select("host", "node", "pages", presentation.alias("presentation"), content.alias("content"), F.coalesce("prior", F.lit(1.0)).alias("prior"), F.col("cs").isNotNull().alias("texts"))
    return told.withColumn("importance", importance)


def by_marks(blocks: list[tuple[int, int, str]]) -> list[str]:
    """The texts of blocks that marks alone take for main text."""
    wanted = ARTICLE if any(mark == ARTICLE for _, mark, _ in blocks) else UNMARKED
    return [text for _, mark, text in blocks if mark == wanted]


def main_text(html: str | None, low: frozenset[int] | None = None) -> str:
    """The page's main text; ``low`` has the nodes of its host that go, and is None for hosts without a judgement."""
    if not html:
        return ""
    blocks = Page(html).blocks
    kept = [] if low is None else [text for node, _, text in blocks if node not in low]
    return "\n".join(kept or by_marks(blocks))


def _joined_blocks(pages: DataFrame, low: DataFrame) -> DataFrame:
    """``id``, ``url`` and ``text`` of ``pages`` (with ``host``) whose hosts have too many low nodes (``host``, ``node``) to go along
    with every page: blocks are joined with them, and what is left is put together again, or by marks if nothing is."""
    kind = pages.schema["id"].dataType
    schema = pa.schema([("row", pa.int64()), ("host", pa.int64()), ("place", pa.int32()), ("node", pa.int64()), ("marked", pa.bool_()), ("block", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for row, host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    blocks = Page(html.as_py() or "").blocks
                    wanted = ARTICLE if any(mark == ARTICLE for _, mark, _ in blocks) else UNMARKED
                    for place, (node, mark, text) in enumerate(blocks):
                        yield row, host, place, node, mark == wanted, text

        yield from emit(rows(), schema, lambda r: len(r[5]))

    numbered = written(pages.withColumn("row", F.monotonically_increasing_id()), "pages-large-hosts")
    blocks = numbered.select("row", "host", "html").mapInArrow(cut, "row bigint, host bigint, place int, node bigint, marked boolean, block string")
    told = blocks.join(low.withColumn("low", F.lit(True)), ["host", "node"], "left").withColumn("low", F.coalesce("low", F.lit(False)))
    block = F.struct("place", "block")
    lists = told.groupBy("row").agg(F.collect_list(F.when(~F.col("low"), block)).alias("kept"), F.collect_list(F.when(F.col("marked"), block)).alias("marked"))  # of one page
    chosen = F.when(F.size("kept") > 0, F.col("kept")).otherwise(F.col("marked"))
    texts = lists.select("row", F.array_join(F.transform(F.array_sort(chosen), lambda x: x["block"]), "\n").alias("text"))
    return numbered.select("row", F.col("id").cast(kind).alias("id"), "url").join(texts, "row", "left").select("id", "url", F.coalesce("text", F.lit("")).alias("text"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id``, ``url`` and main ``text`` of every page."""
    bounded(pages.sparkSession)
    judged = node_importance(pages, url_col, html_col).where(F.col("pages") >= MIN_PAGES)
    low = F.when((F.col("importance") < LOW) & F.col("texts"), F.col("node"))
    nodes = written(judged.select("host", low.alias("node")).distinct(), "pages-low")  # a null stands for the judgement itself
    sizes = written(nodes.groupBy("host").agg(F.count("node").alias("n")), "pages-hosts")
    large = sizes.where(F.col("n") > NODES_WITH_PAGE).select("host")
    by_host = nodes.join(large, "host", "left_anti").groupBy("host").agg(F.collect_list("node").alias("low"))  # NODES_WITH_PAGE at the most
    few = sizes.agg(F.coalesce(F.sum(F.col("n") + 1), F.lit(0))).first()[0] <= BROADCAST_NODES
    url = F.col(f"`{url_col}`").cast("string")
    plain = pages.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    kind = plain.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), batch.column(2), strict=True)
            yield from emit(((k, u, main_text(h.as_py(), None if nodes is None else frozenset(nodes))) for k, u, nodes, h in rows), schema, lambda r: len(r[2]))

    known = spread(plain).withColumn("host", host_key(F.col("url")))
    apart = None
    if not large.isEmpty():
        some = F.broadcast(large) if few else large
        apart = _joined_blocks(known.join(some, "host", "left_semi"), nodes.join(large, "host", "left_semi").where("node IS NOT NULL"))
        known = known.join(some, "host", "left_anti")
    if few:
        joined = known.join(F.broadcast(by_host), "host", "left")
    else:  # a host's pages are dealt out over SALTS tasks, each with a copy of the host's nodes
        salted = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = known.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    joined = joined.select("id", "url", "html", "low")
    texts = joined.mapInArrow(run, f"id {kind.simpleString()}, url string, text string")
    return texts if apart is None else texts.unionByName(apart)
