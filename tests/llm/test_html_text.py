import random
import time
from html import escape
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from formline.llm.html_text import UNSEEN, VOID, visible_text


class Plain(HTMLParser):
    """All text outside unseen elements, with a space for every tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.out = [], []

    def handle_starttag(self, tag, attrs):
        self.out.append(" ")
        if tag in UNSEEN and tag not in VOID:
            self.inside.append(tag)

    def handle_endtag(self, tag):
        self.out.append(" ")
        if self.inside and self.inside[-1] == tag:
            self.inside.pop()

    def handle_data(self, data):
        if not self.inside:
            self.out.append(data)


def words(html):
    parser = Plain()
    parser.feed(html or "")
    parser.close()
    return "".join(parser.out).split()


def test_whole_table_has_the_words_of_a_plain_reading(spark, sf_dir):
    from formline.llm.html_text import extract

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    got = {r["page_id"]: r for r in extract(pages).collect()}
    assert set(got) == set(html)
    for i, r in got.items():
        kept = [w for line in r["text"].split("\n") for w in line.removeprefix("- ").split()]
        assert kept == words(html[i])
        assert r["n_chars"] == len(r["text"])


LAYOUT = {
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<h1>T</h1>x<div>y</div><div>z</div>": "T\n\nx\ny\nz",
    "<p>one <b>two</b>\n three<p>four<div>five</div>six": "one two three\n\nfour\n\nfive\nsix",
    "<ul><li>one<li>two<ul><li>x<li>y</ul><li>three</ul>after": "- one\n- two\n  - x\n  - y\n- three\n\nafter",
    "<ol start=3><li>a<p>para</p><li value=9>b<li>c</ol>": "3. a\n\n   para\n9. b\n10. c",
    "<table><caption>cap</caption><tr><th>Name<th>Value<tr><td>alpha<td>1</table>tail": "cap\n\nName   Value\nalpha  1\n\ntail",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>long<td>d</table>": "a     b\n      c\nlong  d",
    "<table><tr><td colspan=2>wide cell<td>z<tr><td>a<td>b<td>c</table>": "wide cell  z\na  b       c",
    "<table><tr><td>x<td><p>p<p>q<tr><td>y</table>": "x  p\n   q\ny",
    "<table>out<tr><td>in<table><tr><td>n1<td>n2</table></table>": "out\n\nin\nn1  n2",
    "<pre> a\n   b </pre>x": " a\n   b\n\nx",
    "<dl><dt>t<dd>d<dd>e<dt>u</dl>": "t\n  d\n  e\nu",
    "<blockquote>q<p>w</blockquote>z": "  q\n\n  w\n\nz",
    "&lt;b&gt; &am &amp a&nbsp;b &#233;&#x41;": "<b> &am & a b éA",
    "1 < 2 and 3<4 <>": "1 < 2 and 3<4 <>",
    "x<!-- c -- > > d -->y<!doctype z>w<?php q ?>": "xyw",
    "<td>stray</td><li>item": "stray\n- item",
    "a<textarea> q\n r</textarea>": "a\n q\n r",
    "cut <p>off <a href='x": "cut\n\noff",
    "</p>x</b></table>y": "xy",
}


@pytest.mark.parametrize("html", LAYOUT)
def test_layout(html):
    assert visible_text(html)[1] == LAYOUT[html]


INVISIBLE = [
    "<p hidden>no</p>yes", "<div style='color:red; display : NONE'>no<p>no</div>yes", "<input type=hidden value=no>yes",
    "<style>.x , aside{display:none}</style><aside>no</aside><p class='a x'>no</p>yes",
    "<style>#i{visibility:hidden}</style><p id=i>no<u style='visibility:visible'>yes</u></p>",
    "<script>if (a<b) '</p>no'</script>yes<script>no", "<template><p>no</template><noscript>no</noscript>yes",
    "<details><summary>yes</summary>no<p>no</p></details>", "<dialog>no</dialog><details open><dialog open>yes</dialog></details>",
    "<head><title>t</title><meta x><style>p{}</style></head>yes", "<svg><text>no</text></svg><video>no</video>yes",
    "<table hidden><tr><td>no</table>yes", "<ul><li hidden>no<li>yes</ul>",
]


@pytest.mark.parametrize("html", INVISIBLE)
def test_visibility(html):
    assert visible_text(html)[1].removeprefix("- ") == "yes"


#: Pages and what a browser shows of them on a screen, written down by hand.
STYLED = {
    "<style>@media print{.c{display:none}}</style><p class=c>shown": "shown",
    "<style>@media screen{.c{display:none}}</style><p class=c>not</p>shown": "shown",
    "<style>@media screen and (max-width:600px){.c{display:none}}</style><p class=c>shown": "shown",
    "<style>@media (min-width:40em) and (orientation:landscape){.c{display:none}}</style><p class=c>not</p>shown": "shown",
    "<style>@media not print{.c{display:none}}</style><p class=c>not</p>shown": "shown",
    "<style>@media print, (width >= 600px){.c{display:none}}</style><p class=c>not</p>shown": "shown",
    "<style>@media (aspect-ratio > 1/1){.c{display:none}}</style><p class=c>shown": "shown",
    "<style media=print>.c{display:none}</style><p class=c>shown": "shown",
    "<style>.c{display:none} .c{display:block}</style><p class=c>shown": "shown",
    "<style>.c{display:block} .c{display:none}</style><p class=c>not</p>shown": "shown",
    "<style>.c{display:none}</style><p class=c style='display:block'>shown": "shown",
    "<style>.c{display:none!important}</style><p class=c style='display:block'>not</p>shown": "shown",
    "<style>.c{display:none!important}</style><p class=c style='display:block !important'>shown": "shown",
    "<style>.Menu{display:none}</style><p class=menu>shown": "shown",
    "<style>P{display:none}</style><p>not</p>shown": "shown",
    "<style>#a{display:block} p.c{display:none}</style><p id=a class=c>shown": "shown",
    "<style>p.c{display:block} .c{display:none}</style><p class=c>shown": "shown",
    "<style>.c{visibility:hidden}</style><p class=c style='visibility:visible'>shown": "shown",
    "<style>.c{visibility:hidden} .c b{visibility:visible}</style><p class=c>not <b>shown</b>": "shown",
    "<p class=c>not</p>shown<style>.c{display:none}</style>": "shown",
    "<style>div > p{display:none}</style><div><p>not</p><section><p>shown</section></div>": "shown",
    "<style>.a .b{display:none}</style><p class=b>shown</p><div class=a><i><u class=b>not</u></i></div>": "shown",
    "<style>h1 + p{display:none}</style><h1>one</h1><p>not</p><p>two": "one two",
    "<style>h1 ~ p{display:none}</style><p>one</p><h1>two</h1><i></i><p>not": "one two",
    "<style>p:first-child{display:none}</style><div><p>not</p><p>shown</div>": "shown",
    "<style>p:not(.c){display:none}</style><p>not</p><p class=c>shown": "shown",
    "<style>:is(.a,.b) i{display:none}</style><p class=b>one <i>not</i></p><i>two": "one two",
    "<style>p:hover,p:nth-child(2),p::before,p:unheard-of{display:none}</style><p>one<p>two": "one two",
    "<style>[data-x='1']{display:none}[href^=http]{display:none}</style><p data-x=1>not</p><a href=https://x>not</a><p data-x=2>shown": "shown",
    "<style>.sm\\:x{display:none}</style><p class='sm:x'>not</p>shown": "shown",
    "<style>/* .c{display:none} */ .d{content:'} .c{display:none}'}</style><p class=c>shown": "shown",
    "<style>.c{color:red;display:none;}}.d{display:none}</style><p class=c>not</p>shown": "shown",
    "<style>@font-face{font-family:x}@keyframes k{from{display:none}}@import 'a.css';.d{display:none}</style><p class=d>not</p>shown": "shown",
    "<style>@layer a{.c{display:none}}.c{display:block}</style><p class=c>shown": "shown",
    "<style>@layer a,b;@layer b{.c{display:block}}@layer a{.c{display:none}}</style><p class=c>shown": "shown",
    "<style>@layer a{.c{display:none!important}}.c{display:block!important}</style><p class=c>not</p>shown": "shown",
    "<style>@supports (display:grid){.c{display:none}}@supports not (display:grid){.d{display:none}}</style><p class=c>not</p><p class=d>shown": "shown",
    "<style>@container (width > 1px){.c{display:none}}</style><p class=c>shown": "shown",
    "<style>[hidden]{display:block}</style><p hidden>shown": "shown",
    "<p hidden style='display:inline'>shown": "shown",
    "<style>.c{display:block;&.d{display:none}}</style><p class='c d'>shown": "shown",
    "<script>'<style>p{display:none}</style>'</script><!--<style>p{display:none}</style>--><p>shown": "shown",
    "<style>p{display:none": "",
    "shown<plaintext><b>as it &amp; is</b>": "shown<b>as it &amp; is</b>",
}


@pytest.mark.parametrize("html", STYLED)
def test_style_sheets(html):
    assert " ".join(visible_text(html)[1].split()) == STYLED[html]


USED = {
    "<svg><defs><text id=t>label</text></defs><use href='#t'/></svg>": "label",
    "<svg><symbol id='s'><text>one</text><title>no</title></symbol><use xlink:href='#s'></use><use href='#s'/></svg>": "one one",
    "<svg><defs><g id=a><text>in <tspan>g</tspan></text></g><text id=b>no</text></defs><text>x</text><use href=#a /></svg>end": "x in g end",
    "<svg><defs><g id=a><use href='#b'/></g><g id=b><text>deep</text><use href='#a'/></g></defs><use href='#a'/></svg>": "deep",
    "<svg><defs><text id=t>no</text></defs><use href='#missing'/><g style='display:none'><use href='#t'/></g></svg>yes": "yes",
}


@pytest.mark.parametrize("html", USED)
def test_drawings_show_what_they_use(html):
    assert " ".join(visible_text(html, drawings=True)[1].split()) == USED[html]


def test_many_rules_and_deep_pages_are_read_in_time():
    start = time.time()
    rules = "".join(f".r{i} > .s{i} p, #t{i}{{display:none}}" for i in range(300))
    page = f"<style>{rules}</style>" + "".join(f"<div class=r{i}><div class=s{i}><p>no</p></div><p id=u{i}>w{i}</p></div>" for i in range(300))
    assert visible_text(page)[1].split() == [f"w{i}" for i in range(300)]
    assert visible_text("<style>a b c d{display:none}</style>" + "<b>" * 2000 + "x")[1] == "x"
    assert visible_text("<style>" + "@media screen{" * 5000 + "p{display:none}</style><p>x")[1] == "x"
    assert time.time() - start < 20


FOREIGN = {
    "<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds": "so x= 1 2 holds",
    "<math><semantics><mi>E</mi><annotation>no</annotation></semantics></math>yes": "Eyes",
    "<math><mtext>a <b>b</b></mtext><mi>c</mi></math>": "a bc",
    "a<svg><title>no</title><defs><text>no</text></defs>no<text>one</text><text>t<tspan>wo</tspan></text></svg>b": "a one two b",
    "<svg><defs/><title/><path d='M0'/><text>yes</text></svg><svg/>z": "yes z",
    "<svg><foreignObject><p>in</p></foreignObject></svg>out": "in\n\nout",
    "<svg><g><defs><p>after an open drawing": "after an open drawing",
}


@pytest.mark.parametrize("html", FOREIGN)
def test_formulas_and_labels_of_drawings(html):
    assert visible_text(html, drawings=True) == ("", FOREIGN[html])


def test_queries_read_formulas_and_drawings(spark):
    from formline.llm.html_text import extract

    pages = spark.createDataFrame([(1, "<svg><text>label</text></svg><math><mi>y</mi></math>")], "page_id long, html string")
    assert extract(pages).first()["text"] == "label y"


def test_text_ends_an_open_head():
    assert visible_text("<head><title>x</title> \n Hello <p>there") == ("x", "Hello\n\nthere")
    assert visible_text("<head> <meta a> <title>x</title>&amp;") == ("x", "&")


def test_title():
    assert visible_text("<title> A &amp;\n B</title><title>C</title>x") == ("A & B", "x")


def random_page(rnd, wanted, depth=0):
    """Markup with end tags left out where they are implied; ``wanted`` gets the visible words in order."""
    out = []
    for _ in range(rnd.randrange(1, 5)):
        kind = rnd.choice(["text", "p", "div", "ul", "table", "gone", "b"] if depth < 4 else ["text"])
        word = f"w{rnd.randrange(10**6)}&<"
        if kind == "text":
            wanted.append(word)
            out.append(f" {escape(word)} ")
        elif kind == "p":
            wanted.append(word)
            out.append(f"<p>{escape(word)}{'</p>' if rnd.random() < 0.5 else '<div></div>'}")
        elif kind == "gone":
            out.append(f"<span hidden>{escape(word)}</span><script>{word}</script><!-- {word} -->")
        elif kind == "ul":
            out.append("<ul>" + "".join("<li>" + random_page(rnd, wanted, depth + 1) for _ in range(2)) + "</ul>")
        elif kind == "table":
            # cells of one line each, so that reading by lines is reading by cells
            cells = [[f"c{rnd.randrange(10**6)}" for _ in range(3)] for _ in range(2)]
            wanted.extend(c for row in cells for c in row)
            out.append("<table>" + "".join("<tr>" + "".join(f"<td>{c}" for c in row) for row in cells) + "</table>")
        else:
            out.append(f"<{kind}>{random_page(rnd, wanted, depth + 1)}</{kind}>")
    return "".join(out)


def test_round_trip_of_random_pages():
    rnd = random.Random(7)
    for _ in range(300):
        wanted = []
        page = random_page(rnd, wanted)
        assert [w for w in visible_text(page)[1].split() if w != "-"] == wanted, page


@pytest.mark.parametrize("html", ["<b>" * 50_000 + "x", "<div>" * 50_000 + "x", "<ul><li>" * 2000 + "x", '<a "' * 20_000, "<" * 50_000, "<table><tr><td>" * 1000 + "x", "<p>" * 50_000 + "x</b>" * 3000, "&" * 50_000])
def test_long_and_deep_pages_take_linear_time(html):
    start = time.time()
    visible_text(html)
    assert time.time() - start < 10


def test_odd_rows(spark):
    from formline.llm.html_text import extract

    rows = [(1, None), (2, ""), (None, "<p>a"), (3, "plain"), (3, "plain"), (4, "<p>" + "word " * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumns({"text": F.lit(1), "title": F.lit("q"), "id": F.lit(2)})
    got = sorted(((r["page_id"] or 0, r["text"][:9], r["n_chars"], r["title"]) for r in extract(df).collect()))
    assert got == [(0, "a", 1, ""), (1, "", 0, ""), (2, "", 0, ""), (3, "plain", 5, ""), (3, "plain", 5, ""), (4, "word word", 999_999, "")]
    assert extract(df.limit(0)).collect() == []
