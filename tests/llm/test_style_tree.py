"""Main text: marks, broken markup, and branches that only their entropies tell."""

import html
import random
import re
from collections import Counter
from pathlib import Path

import pytest

from corpusloom.llm import style_tree as st


def test_marks_and_broken_markup():
    source = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "</p>";</script></head><body>
    <header>Top</header><nav><ul><li><a href=/>Home</a></ul></nav><!-- note --><div class="ad">Buy</div><div id="cookie-notice">We use</div>
    <article><header><h1>A &amp; B &eacute;</h1></header><p><b>One.<br><p>Two
      words&nbsp;here<ul><li>x<li>y</ul><form>f<input></form><div class="share">s</div><aside>side</aside>
    <table><tr><td>c1<td>c2</table><p>last <i>in</i><span>line</span></article>
    <section id="comments"><article>reply</article></section><footer>&copy; F</footer>"""
    assert st.main_text(source) == "A & B é\nOne.\nTwo words here\nx\ny\nc1\nc2\nlast inline"


def test_without_marks_or_markup():
    assert st.main_text(None) == "" and st.main_text("") == "" and st.main_text("<p>") == ""
    assert st.main_text("just  text") == "just text"
    assert st.main_text("<div>a<p>b</div>c <main></main>") == "a\nb\nc"
    assert st.main_text("<nav>x</nav>") == ""
    assert st.main_text("<article class='post tag-social'>a</article><article class='comment'>b</article>") == "a"
    deep = "<div>" * 5000 + "core" + "</div>" * 5000
    assert st.main_text(deep) == "core"
    assert st.main_text("<p>" + "word " * 300_000).count("word") == 300_000


def page(rng, host, i, body):
    return f"<html><body><div class='top'>Welcome to {host}</div><div class='side'><p>About us</p><p>All rights</p></div><div class='story'>{body}</div><div class='end'>Bye</div></body></html>"


def test_low_entropy_branches_go(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(40):
        host = "a.example" if i % 2 else "b.example"
        paragraphs = [" ".join(f"w{rng.randrange(999)}" for _ in range(12)) for _ in range(rng.randrange(1, 5))]
        want[i] = "\n".join(paragraphs)
        rows.append((i, f"http://{host}/{i}", page(rng, host, i, "".join(f"<p>{p}</p>" for p in paragraphs)), "x"))
    rows += [(100 + i, "http://copies.example/1", rows[0][2], "x") for i in range(30)]  # equal pages are one page
    rows += [(200, None, "<p>no host", None), (201, "http://a.example/", None, None), (None, "http://a.example/", "<p>null id", None), (202, "nothing", "", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string").repartition(4)
    found = {r.id: r.text for r in st.extract(pages).collect()}
    assert {k: found[k] for k in want} == want
    assert found[100] == st.main_text(rows[0][2]) and found[200] == "no host" and found[201] == "" and found[None] == "null id" and found[202] == ""
    assert st.extract(pages).count() == len(rows)
    nodes = st.node_importance(pages).where("pages >= 4").collect()
    assert all(0 <= r.importance <= 1 for r in nodes) and min(r.importance for r in nodes) < 0.1 and max(r.importance for r in nodes) >= 0.9


def test_entropies_judge_articles_too(spark):
    source = "<body><main>Small {0}</main><div class='story'>Long text {0}</div><article><p>Own {0}</p><div class='box'>Same words</div></article></body>"
    rows = [(i, f"http://{'large' if i < 6 else 'small'}.example/{i}", source.format(i)) for i in range(8)]
    found = {r.id: r.text for r in st.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found == {i: f"Small {i}\nLong text {i}\nOwn {i}" if i < 6 else f"Small {i}\nOwn {i}\nSame words" for i in range(8)}


def test_the_salted_join_gives_the_same(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, f"http://h.example/{i}", page(rng, "h", i, f"<p>text {i} {rng.random()}</p>")) for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    plain = sorted(tuple(r) for r in st.extract(pages).collect())
    monkeypatch.setattr(st, "BROADCAST_NODES", 0)
    assert sorted(tuple(r) for r in st.extract(pages).collect()) == plain


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_hosts_of_many_low_nodes_give_the_same(spark, monkeypatch, broadcast):
    """Hosts whose nodes don't go along with each page: judged by a join of blocks, also where nothing is left or hosts differ."""
    rng = random.Random(3)
    rows = [(i, f"http://h.example/{i}", page(rng, "h", i, f"<p>text {i} {rng.random()}</p>")) for i in range(20)]
    rows += [(100 + i, f"http://u.example/{i}", f"<nav>{i}</nav><article>all the same</article>") for i in range(5)]
    rows += [(200 + i, f"http://plain.example/{i}", f"<p>only {i}</p>") for i in range(5)] + [(3, "http://h.example/3", rows[3][2]), (None, "http://h.example/x", rows[4][2]), (300, "http://h.example/", None), (301, "http://few.example/", "<p>x</p><nav>n</nav>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    key = lambda d: sorted(((r.id is None, r.id or 0), r.url, r.text) for r in d.collect())
    plain = key(st.extract(pages))
    monkeypatch.setattr(st, "BROADCAST_NODES", broadcast)
    monkeypatch.setattr(st, "NODES_WITH_PAGE", 2)
    assert key(st.extract(pages)) == plain and len(plain) == len(rows)


def test_empty_table(spark):
    assert st.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_tags_that_break():
    text = st.main_text
    assert text("<p title='a>b' x=\"c>d\">in</p>a <b class=x>b</b <i>c</i> 1 < 2 & 3 <4") == "in\na bc 1 < 2 & 3 <4"
    assert text("<p>it's <a href=x'y>z</a> <q cite=\"open>w</q> end") == "it's z w end"
    assert text("<p>one<br/>two</P><script>if (a<b) '</p>'</SCRIPT >three<!-- c --><!DOCTYPE x><?php y ?></>four<!-->five") == "one two\nthreefourfive"
    assert text("a<!-- open") == "a" and text("a<p") == "a" and text("a<script>b") == "a" and text("a<b c='") == "a" and text("<") == "<"
    assert text("&lt;p&gt; &#x41;&#66; &nosuch; &amp;amp;") == "<p> AB &nosuch; &amp;"
    for slow in ("<a " * 50_000, "<a b='" * 50_000, "<!--" * 50_000, "<p>" * 20_000, "</p>" * 50_000, "<a =\"'" * 50_000, "<b><p>" * 3_000):
        assert text(slow + "x") is not None


def test_wrappers_and_boxes():
    # a form around the article, or around all text, is no form
    assert st.main_text("<form action=x><div>menu</div><article><p>text</p><form>own</form></article><input></form>") == "text"
    assert st.main_text("<form><div>only</div><p>text</p><select><option>o</select></form>") == "only\ntext"
    assert st.main_text("<p>text</p><form>f</form>") == "text"
    # words of classes that mark all text mark nothing
    assert st.main_text("<div class='page with-sidebar'><nav>n</nav><main>text</main></div>") == "text"
    assert st.main_text("<div class='with-sidebar'><nav>n</nav><p>text</p></div>") == "text"
    assert st.main_text("<section id=comments><article>reply</article></section><p>text</p>") == "text"


def test_what_most_articles_share_goes(spark):
    """A disclaimer inside the article of 8 of 10 pages goes by its entropy; marks and switched-off entropies would leave it."""
    rng = random.Random(8)
    body = lambda i: f"<nav>home</nav><article><h1>Title {i} {rng.random()}</h1><p>Own text {i} {rng.random()}</p>" + ("<p class=legal>All opinions are ours</p>" if i < 8 else "") + f"<p>More {i} {rng.random()}</p></article>"
    rows = site(10, body)
    found = {r.id: r.text for r in st.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    marked = {i: st.main_text(html) for i, _, html in rows}
    assert all("opinions" not in found[i] and found[i].count("\n") == 2 for i in range(10))
    assert sum("opinions" in marked[i] for i in range(10)) == 8 and all(marked[i].replace("All opinions are ours\n", "") == found[i] for i in range(10))


def site(n, body):
    return [(i, f"http://s.example/{i}", body(i)) for i in range(n)]


def test_entropies_overrule_doubtful_marks(spark):
    words = lambda i, k: " ".join(f"w{i}x{j}" for j in range(k))
    rows = site(6, lambda i: f"<form id=f><nav>menu {i}</nav><div class='notice' id='n-{i}'>{words(i, 4)}</div><div class='notice top'>Same on all</div><article id='post-{i}'><p>{words(i, 9)}</p><div class='alert'>{words(i, 3)}</div><p class='alert box'>All alike</p></article></form>")
    found = {r.id: r.text for r in st.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found == {i: f"{words(i, 4)}\n{words(i, 9)}\n{words(i, 3)}" for i in range(6)}


def test_near_copies_keep_their_articles(spark):
    # six of eight pages differ in a word only
    rows = site(8, lambda i: f"<nav>menu</nav><article><h1>{'Title' if i < 6 else i}</h1><p>The same paragraph</p><p>as ever {i}</p></article>")
    rows += [(20, "http://t.example/", "<article>one</article>")] + [(30 + i, "http://u.example/", f"<nav>{i}</nav><article>all the same</article>") for i in range(5)]
    found = {r.id: r.text for r in st.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[20] == "one" and all(found[30 + i] == "all the same" for i in range(5))
    assert all(found[i] == f"{'Title' if i < 6 else i}\nThe same paragraph\nas ever {i}" for i in range(8))


def test_importance_is_that_of_plain_entropies(spark):
    """Every node's entropies from lists of what its pages show, without any sums."""
    from collections import Counter
    from math import log

    rng = random.Random(4)
    rows = site(9, lambda i: "<div class=a>" + "".join(rng.choice(["<p>x</p>", "<ul><li>x</ul>", f"<p>{i}</p>", "<b>z</b>"]) for _ in range(rng.randrange(1, 4))) + "</div><nav><p>n</p></nav><main>m<div>same</div></main>")
    rows += [(50, "http://s.example/copy", rows[0][2])]
    found = {r.node: r for r in st.node_importance(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)).collect()}
    pages = [st.Page(h) for h in {h for _, _, h in rows}]
    entropy = lambda counts: -sum(n / sum(counts) * log(n / sum(counts)) for n in counts)
    nodes = {b[0] for p in pages for b in p.blocks} | {n for p in pages for n in p.shown}
    assert set(found) == nodes
    for node in nodes:
        shapes = Counter(tuple(p.shown[node]) for p in pages if node in p.shown)
        presentation = entropy(list(shapes.values())) / log(len(pages)) if shapes else 0
        texts = Counter(t for p in pages for t in {b[2] for b in p.blocks if b[0] == node})
        # the entropy of a text over the pages it stands on is log n; the mean weighs a text by its pages
        content = 1 - sum(n * log(n) for n in texts.values()) / sum(texts.values()) / log(len(pages)) if texts else 1
        prior = max((st.PRIORS[b[1]] for p in pages for b in p.blocks if b[0] == node), default=1)
        r = found[node]
        assert r.pages == len(pages) and abs(r.presentation - presentation) < 1e-9 and abs(r.content - content) < 1e-9
        assert abs(r.importance - (st.PRESENTATION * presentation + (1 - st.PRESENTATION) * content) * prior) < 1e-9


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")
def test_tables_by_a_plain_reading(spark):
    """The tables' articles read by tag names alone; and without the tree's judgement the judged pages' texts are others."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.id: r.text for r in st.extract(pages).collect()}
    rows = pages.collect()
    other, judged = 0, 0
    hosts = Counter(r.url.split("://")[1].split("/")[0].split("?")[0].split("#")[0].lower() for r in rows)
    for r in rows:
        article = re.search(r"(?s)<article>(.*)</article>", r.html)[1]
        parts = (" ".join(html.unescape(re.sub("<(?!br)[^>]*>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:h1|p|ul|li|div)\b[^>]*>", article))
        assert found[r.page_id] == "\n".join(x for x in parts if x)
        if hosts[r.url.split("://")[1].split("/")[0].split("?")[0].split("#")[0].lower()] >= 2 * st.MIN_PAGES:
            judged += 1
            other += st.main_text(r.html, frozenset()) != found[r.page_id]
    assert judged > 50 and other == judged
