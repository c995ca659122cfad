import html as entities
import re
from collections import defaultdict

import pytest

from tellerlake.llm.markup import PLAIN, STRICT, Page, signed
from tellerlake.llm.pages import extract, op11_html

SCHEMA = "page_id long, url string, html string, host string, text string"


def pages(spark, rows):
    """Rows with columns that clash with the operator's own."""
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)


def text_of(html, templates=None):
    return Page(html).article(templates or {})


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two", "one\n\ntwo"),
        ("<p><b>bold<br>line<p>two</p></p>tail", "bold line\n\ntwo\n\ntail"),
        ("<p>a<b>b</b>c <i>d</i></p>", "abc d"),
        ("<ul><li>x<li>y</ul>", "x\n\ny"),
        ("<table><tr><td>1</td><td> 2</td></tr><tr><td>3</table>", "1 2\n\n3"),
        ("<p>a\n\t b&nbsp;&nbsp;c</p>", "a b c"),
        ("<p>&#65;&#x42;&amp&copy; &am</p>", "AB&© &am"),
        ("a < b <p>c</p> <3", "a < b\n\nc\n\n<3"),
        ("<!-- x > --><p>y</p><!--> z<!-- never ends <p>n</p>", "y\n\nz"),
        ("<p title='a > b'>q</p><a b=\"never ends>r</a>", "q\n\nr"),
        ("<script>var t = '</p>';</script><style>p{}</style><p>z</p><script>open", "z"),
        ("<p>cut in a ta<a href", "cut in a ta"),
        ("</div></p><p>stray ends</p></article>", "stray ends"),
        ("<title>no</title><body><p>yes", "yes"),
        ("<head><title>no</title><p>yes", "yes"),
    ],
)
def test_markup(html, text):
    assert text_of(html) == text


def test_what_is_not_the_article_goes():
    html = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="top-nav">menu</div>
    <div class="page-content"><div class="cookie-notice">We use cookies</div><aside>side</aside>
    <article class="post comments-open"><header><h1>Title</h1><span class="byline">by X</span></header>
    <p>First.</p><div class="ad">buy</div><form><p>mail</p><button>go</button></form><p hidden>secret</p>
    <section id="comments"><article class="comment"><p>Great!</p></article></section><p>Last.</p></article>
    <article class="teaser">More</article></div><div role="contentinfo">legal</div><footer>end</footer></body></html>"""
    assert text_of(html) == "Title\n\nFirst.\n\nLast."


def test_pages_without_an_article():
    html = """<body><div class="sidebar">s</div><div id="wrapper"><p>One is long enough to hold most of it.</p>
    <p>Two.</p></div><div class="comments"><p>c</p></div></body>"""
    assert text_of(html) == "One is long enough to hold most of it.\n\nTwo."
    whole = '<body><form id="form1"><h2>Head</h2><p>A page of which all is in one form.</p></form></body>'
    assert text_of(whole) == "Head\n\nA page of which all is in one form."


def test_templates_go_from_what_is_kept():
    page = Page("<div>Shop now</div><p>text here</p><article><p>common</p><p>own</p></article>")
    beside, strict, plain = page.subtrees()
    assert (len(beside), len(strict), len(plain)) == (3, 2, 0)
    shared = signed(page.digests[page.tags.index("article") + 1])
    assert shared in strict
    assert page.article({shared: PLAIN}) == "common\n\nown"
    assert page.article({shared: STRICT}) == "own"
    bare = Page("<div>Shop now and here</div><div><p>text here</p></div>")
    first, prose = signed(bare.digests[1]), signed(bare.digests[bare.tags.index("p")])
    assert bare.subtrees() == (set(), {prose}, {first, signed(bare.digests[2])})
    assert bare.article({}) == "Shop now and here\n\ntext here"
    assert bare.article({first: PLAIN, prose: PLAIN}) == "text here"
    assert bare.article({prose: STRICT}) == "Shop now and here"


def test_deep_and_long_pages():
    deep = "<div>" * 50_000 + "x" + "</div>" * 50_000
    assert text_of(deep) == "x"
    long = "<article>" + "<p>word &lt;</p>" * 50_000 + "</article>"
    assert text_of(long) == "\n\n".join(["word <"] * 50_000)
    assert text_of("<a " * 50_000) == ""
    assert text_of("<a ' <b>x" * 20_000).count("x") == 10_000  # quotes pair up


def site(n, host, start=0):
    """Pages of a site that marks no article: a menu, a shared widget, two paragraphs of their own."""
    return [
        (start + i, f"https://{host}/{i}", f"<div>Home About</div><div><p>A page of its own, number {start + i}.</p>"
         f"<p>More of {start + i}.</p></div><div>Call us</div>")
        for i in range(n)
    ]


def test_templates_are_of_a_host_and_of_different_pages(spark):
    rows = site(6, "a.example") + site(3, "b.example", 100)
    rows += [(200 + i, "http://c.example/", "<div>Only a copy of one page</div>") for i in range(30)]
    got = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}
    assert got[3] == "A page of its own, number 3.\n\nMore of 3."
    assert got[101] == "Home About\n\nA page of its own, number 101.\n\nMore of 101.\n\nCall us"
    assert {got[200 + i] for i in range(30)} == {"Only a copy of one page"}


def test_counts_equal_brute_force(spark):
    """Templates by plain loops over all pages, and the same texts from them."""
    rows = site(8, "a.example") + site(14, "u@B.example:80", 50) + site(4, "d.example", 90) + site(2, "a.example", 4)
    rows += [(i, "https://b.example/x", f"<article><p>shared by many</p><p>own {i} and longest</p></article>") for i in range(300, 325)]
    seen, different = defaultdict(set), defaultdict(set)
    parsed = {}
    for number, (_, url, html) in enumerate(rows):
        host = re.match(r"https?://(?:.*@)?([^/:]+)", url.lower()).group(1)
        page = parsed[number] = Page(html), host
        different[host].add(page[0].identity())
        for subtree in set().union(*page[0].subtrees()):
            seen[host, subtree].add(page[0].identity())
    want = []
    for number, (i, url, html) in enumerate(rows):
        page, host = parsed[number]
        kinds = {}
        for subtree in set().union(*page.subtrees()):
            n = len(seen[host, subtree])
            if n >= 5:
                kinds[subtree] = STRICT if n >= 10 and 2 * n >= len(different[host]) else PLAIN
        want.append((i, url, page.article(kinds)))
    got = [(r.page_id, r.url, r.text) for r in extract(pages(spark, rows)).collect()]
    assert sorted(got) == sorted(want)
    assert any("shared by many" not in text for i, _, text in got if i >= 300)


def test_edges(spark):
    rows = [(1, None, "<p>no url</p>"), (2, "http://x.example/", None), (None, "mailto:y", "<p>z</p>"), (3, "http://x.example/", "")]
    got = sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in extract(pages(spark, rows + rows[:1])).collect())
    assert got == [
        (0, "mailto:y", "z", 1), (1, None, "no url", 6), (1, None, "no url", 6), (2, "http://x.example/", "", 0),
        (3, "http://x.example/", "", 0),
    ]
    empty = extract(pages(spark, []))
    assert empty.columns == ["page_id", "url", "text", "n_chars"] and empty.collect() == []


def test_given_pages(spark, sf_dir):
    """Every page of the small table against a plain reading of its article element."""
    given = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    want = {}
    for row in given:
        inner = re.search("<article>(.*?)</article>", row.html, re.S).group(1)
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>|<br>", " ", inner))
        want[row.page_id] = "\n\n".join(t for t in (" ".join(entities.unescape(b).split()) for b in blocks) if t)
    got = {r.page_id: r.text for r in op11_html(spark, sf_dir).collect()}
    assert got == want
