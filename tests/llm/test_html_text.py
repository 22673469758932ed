"""Main text against what the pages were made of, and style trees against plain loops."""

import html
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from opslake.llm.html_text import Page, extract_main_text, main_text, site_of, style_trees
from opslake.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, low string, __low string, main_text string, node long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", 1) for r in rows], SCHEMA)


def extracted(spark, rows, **options):
    got = extract_main_text(frame(spark, rows), **options)
    assert got.columns == ["page_id", "url", "low", "__low", "node", "main_text"]
    return {r.page_id: r.main_text for r in got.collect()}


def test_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op13_html_text"](spark, sf).collect()}
    want = {}
    for page_id, source in pages.items():
        article = source.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        parts = re.split(r"</?(?:p|h1)>", article)
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in parts)
        text = "\n\n".join(b for b in blocks if b)
        want[page_id] = (text, len(text))
    assert got == want


PAGE = """<!DOCTYPE html><html><head><title>T</title><meta charset=utf-8>
<body class="has-sidebar comments-open"><header class="site-header"><h1>Site</h1>
<nav><ul><li><a href=/a/>A</a></ul></nav></header><div id=wrapper class="menu-open">
<div class="cookie-notice">We use cookies</div><main>
<article class="post comments-open tag-ads"><header><h1>Head &amp; line</h1></header>
<p>One <b>two</b>
three&nbsp;f<i>ou</i>r<p>Second <a href=x>link</a>.<ul><li>a<li>b</ul><table><tr><td>x<td>y<tr><td>z</table>
<div class="share-buttons"><a>Tweet</a></div><blockquote>Quote</blockquote>
<form><label>Mail</label><input></form><script>if (a<b) "</p>"</script><style>p{}</style><!-- c <p>no -->
<ul><li><a>r1</a><li><a>r2</a><li><a>r3</a></ul><div hidden>h</div><p style="display: none">h</p>
<aside>Side</aside><footer>By X</footer></article>
<section id="comments"><h2>2 comments</h2><article><p>Nice!</article>
<article class="comment-body">Bad</article></section></main><aside class="sidebar">S</aside></div>
<div class="ad">Buy</div><div role="alert">Beta</div><footer>&copy; 2024</footer></body></html>"""
TEXT = "Head & line|One two three four|Second link.|a|b|x y|z|Quote"

DIVS = """<body><div id="top-menu"><a>1</a><a>2</a></div><div class="c1"><div class=c2><h2>Title</h2>
Lead text<br>more <i>text</i> here 1 < 2 &lt;b&gt;<p>Para</div></div>
<div class="c3"><a>x</a> <a>y</a> <a>z</a></div><textarea>zz</textarea><noscript>js</noscript>"""


@pytest.mark.parametrize(
    "source,want",
    [
        (PAGE, TEXT),
        (DIVS, "Title|Lead text more text here 1 < 2 <b>|Para"),
        (None, ""),
        ("", ""),
        ("plain &amp; &#x41;&bogus;", "plain & A&bogus;"),
        ("<title>t</title>x<p", "x"),
        ("<head><title>t</title><p>x", "x"),
        ("a < b <<b>c</b> </ d", "a < b <c"),
        ("<p>a</p>b<div>c<p>d</div>e<span/>f<br/>g", "a|b|c|d|ef g"),
        ("<b>x<p>y</b>z<p>w", "x|yz|w"),
        ("<script>never ends", ""),
        ("<!-- never ends <p>x", ""),
        ('<a href="never ends>x', ""),
        ("<div role=main><p>m</p></div><div><p>o</p></div>", "m"),
        ("<div class=entry-content><p>main part</p></div><div><p>o</p></div>", "main part"),
        ("<div class=article-header><h1>t</h1></div><div class=article-body>text of it</div>x", "t|text of it"),
        ("<div class=header-content>s</div><div class=content>text of it</div>", "text of it"),
        ("<div class='popup'>p</div><div class=post>t</div><div class='siteNotice'>n</div>", "t"),
        ("<main>m</main>o", "m"),
        ("<article></article>o", "o"),
        ("<article>a1</article>x<article>a2</article>", "a1|a2"),
        ("<article>a1<article>c</article></article>", "a1"),
        ("<dl><dt>t<dd>d<dt>u</dl><pre> p\n q</pre>", "t|d|u|p q"),
        ("<DIV CLASS='SideBar'>s</DIV><P>p</P>", "p"),
    ],
)
def test_pages(source, want):
    assert main_text(source) == want.replace("|", "\n\n")


def test_deep_and_long_pages():
    n = 60_000
    assert main_text("<div>" * n + "x" + "<p>a" * 50) == "\n\n".join(["x"] + ["a"] * 50)
    assert main_text("<p>" + "word " * n + "<b>end") == "word " * n + "end"


def site(rng, host, pages, first):
    """Pages without telling names: what tells the boilerplate is that it repeats."""
    out = []
    for i in range(pages):
        body = "".join(f"<p>{' '.join(rng.choices(WORDS, k=9))}</p>" for _ in range(rng.randrange(1, 6)))
        source = (
            f"<html><body><div class='q1'>Welcome to {host}<p>Read our paper</p></div>"
            f"<div class='q2'><h2>{' '.join(rng.choices(WORDS, k=4))}</h2>{body}</div>"
            f"<div class='q3'><p>All rights</p><p>reserved {host}</p></div></body></html>"
        )
        out.append((first + i, f"https://user@{host.upper()}:80/p{i}?x=//y", source))
    return out


WORDS = [f"w{i}" for i in range(400)]


def test_repeated_branches_go(spark):
    rng = random.Random(2)
    rows = site(rng, "a.example", 12, 0) + site(rng, "b.example", 2, 100)
    rows += [(200 + i, "https://c.example/same", rows[0][2]) for i in range(30)]
    got = extracted(spark, rows)
    for page_id, _, source in rows:
        middle = source.split("<div class='q2'>")[1].split("</div>")[0]
        want = "\n\n".join(b for b in re.split(r"</?(?:p|h2)>", middle) if b)
        if page_id < 100:
            assert got[page_id] == want
        else:  # too few different pages to tell
            assert want in got[page_id] and "All rights" in got[page_id]


def trees_by_hand(rows, damp=0.9):
    pages = defaultdict(set)
    for _, url, source in rows:
        host = re.match(r"https?://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
        if source:
            pages[host.group(1).lower() if host else ""].add(source)
    out = []
    for sources in pages.values():
        seen, styles, texts, up = Counter(), defaultdict(Counter), defaultdict(Counter), {}
        for source in sources:
            page = Page(source)
            chain = {0: ()}
            own, kids = defaultdict(str), defaultdict(list)
            for _, element, text in page.texts:
                own[element] += text
            for i in range(1, len(page.tag)):
                chain[i] = (*chain[page.parent[i]], page.label[i])
                kids[page.parent[i]].append(page.label[i])
            for path in set(chain.values()) - {()}:
                same = [i for i in range(1, len(page.tag)) if chain[i] == path]
                seen[path] += 1
                styles[path][tuple(tuple(kids[i]) for i in same)] += 1
                for text in {" ".join(own[i].split()) for i in same} - {""}:
                    texts[path][text] += 1
        for path, m in seen.items():
            def entropy(p):
                return -p * math.log(p) / math.log(m)

            presentation = sum(entropy(n / m) for n in styles[path].values()) if m > 1 else 1.0
            shares = []
            for other, found in texts.items():
                if other[: len(path)] == path:
                    k = seen[other]
                    for n in found.values():
                        shares += [math.log(n) / math.log(k) if k > 1 else 0.0] * n
            content = 1 - sum(shares) / len(shares) if shares else 1.0
            kinds = sum(len(o) == len(path) + 1 and o[: len(path)] == path for o in seen)
            w = damp**kinds
            out.append((m, *(round(x + 0.0, 6) for x in (presentation, content, (1 - w) * presentation + w * content))))
    return sorted(out)


def test_trees_equal_plain_loops(spark):
    rng = random.Random(7)
    rows = site(rng, "a.example", 9, 0) + site(rng, "b.example", 4, 50)
    rows += rows[:3] + [(90, None, rows[0][2]), (91, "no url", PAGE), (92, "", DIVS), (93, "http://a.example", None)]
    got = style_trees(frame(spark, rows)).collect()
    found = sorted(
        (r.pages, *(round(x + 0.0, 6) for x in (r.presentation, r.content, r.importance))) for r in got
    )
    want = trees_by_hand(rows)
    assert len(found) == len(want)
    for a, b in zip(found, want):
        assert a == pytest.approx(b, abs=2e-6)


def test_awkward_rows(spark):
    rows = [(1, "http://x.example/", PAGE), (1, "http://x.example/", PAGE), (2, None, None), (None, "%%", "")]
    rows += [(3, None, "<p>" + "long " * 100_000), (4, "http://[bad", "<p>x")]
    assert extracted(spark, rows) == {
        1: TEXT.replace("|", "\n\n"), 2: "", None: "", 3: ("long " * 100_000).strip(), 4: "x"
    }
    assert extract_main_text(frame(spark, rows)).count() == 6
    assert extracted(spark, rows[:0]) == {}


def test_sites(spark):
    urls = ["https://User:p@Host.Example:8080/a", "http://a.b?x", "ftp://c#d", "//e/f", "mailto:x@y", None, ""]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r[0] for r in df.select(site_of(df.url)).collect()]
    assert got == ["host.example", "a.b", "c", "", "", "", ""]
