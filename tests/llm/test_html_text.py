import re
from html.parser import HTMLParser

import pytest

from attemptlog.llm import html_text, markup
from attemptlog.llm.registry import QUERIES


class Plain(HTMLParser):
    """Blocks inside <article>, for pages whose side parts are elements of their own."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.now = False, [], ""

    def cut(self):
        text = re.sub(r"\s+", " ", self.now).strip()
        if text and self.inside:
            self.blocks.append(text)
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.now += " "
        elif tag not in ("b", "a", "i"):
            self.cut()
        self.inside = self.inside or tag == "article"

    def handle_endtag(self, tag):
        if tag not in ("b", "a", "i"):
            self.cut()
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        self.now += data


def brute(html):
    reader = Plain()
    reader.feed(html or "")
    reader.close()
    reader.cut()
    return "\n".join(reader.blocks)


def run(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int, host string, token long")
    return {r.page_id: r.text for r in html_text.extract(df, "page_id", "url", "html").collect()}


def page(i, html, host="a.example.com"):
    return (i, f"https://{host}/p/{i}?x=1", html, 7, "clash", 1)


def test_given_pages(spark, sf):
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op13_html_text"](spark, sf).collect()}
    want = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert got.keys() == want.keys()
    for i, html in want.items():
        assert got[i] == (brute(html), len(brute(html)))


def test_side_parts(spark):
    html = """<html><head><title>T &amp; t</title></head><body class="page with-sidebar">
    <header class="site-header"><h1>Site</h1></header><nav><a href="/">Home</a></nav>
    <div id="cookie-notice">We use cookies</div><aside>Read also</aside>
    <article><header><h1>A  &lt;b&gt;
    title</h1></header><p>One <b>bold</b><i>er</i> word<br>and &eacute;&#233; &copy more<script>no("</p>")</script>.
    <p class=adText>Sponsored<p>Two<ul><li>x<li>y</ul><table><tr><td>1<td>2</table>
    <div class="adverts"><p>Buy</p></div><form><label>Mail</label><input value="z"></form>
    <style>p{}</style><!-- hidden <p>no</p> --><pre>a
      b</pre><section id="comments"><article class="comment"><p>First!</p></article></section>
    <footer>by me</footer></article><footer>&copy; host</footer></body></html>"""
    want = "A <b> title\nOne bolder word and éé © more.\nTwo\nx\ny\n1\n2\na b"
    assert run(spark, [page(1, html)])[1] == want


def layout(i, title, paragraphs, notice="Please note our terms"):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return page(i, f"<body><div class='top x{i}'>Site of all</div><div class='c'><div id='post-{i}'><h2>{title}</h2>{body}"
                   f"</div></div><div class='b'>{notice}</div></body>", "plain.example.org")  # fmt: skip


def test_template_without_article_element(spark):
    rows = [layout(i, f"Title {i}", [f"Paragraph {i} {j} of some length to be read" for j in range(1 + i % 4)]) for i in range(12)]
    # A page of another layout, and copies on another host, where nothing differs.
    rows += [page(50, "<body><p>All alone</p></body>", "plain.example.org")]
    rows += [page(60 + i, "<body><div><p>Same on all</p></div></body>", "copies.example.org") for i in range(5)]
    got = run(spark, rows)
    for i in range(12):
        assert got[i] == "\n".join([f"Title {i}"] + [f"Paragraph {i} {j} of some length to be read" for j in range(1 + i % 4)])
    assert got[50] == "All alone"
    assert all(got[60 + i] == "Same on all" for i in range(5))


def test_articles_shared_by_pages_stay(spark):
    rows = [page(i, "<body><nav>m</nav><article><p>Same text</p></article></body>") for i in range(6)]
    assert set(run(spark, rows).values()) == {"Same text"}


def test_classes(spark):
    """Equal vectors make a class; a token out of order on one page leaves its class invalid."""
    rows = [page(i, "<body><div class='k'><p>x</p></div><div class='l'><p>y</p></div></body>") for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int, host string, token long")
    outline = html_text.outlines(df, "url", "html")
    assert html_text.classes(outline).count() == 7
    odd = page(9, "<body><div class='l'><p>y</p></div><div class='k'><p>x</p></div></body>")
    df = df.union(spark.createDataFrame([odd], df.schema))
    assert html_text.classes(html_text.outlines(df, "url", "html")).count() == 0


@pytest.mark.parametrize("limit", [1 << 30, -1])
def test_odd_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(html_text, "SENT_BYTES", limit)
    long = "<article>" + "<p>word &amp; more</p>" * 30_000 + "</article>"
    rows = [page(1, None), page(2, ""), page(3, "no markup  at\nall"), page(4, "<nav>only</nav>"), page(5, long), page(5, long),
            page(6, "<article>cut <p>off <b"), page(7, "<article>a<!-- open <p>b"), page(8, "<p>x<script>y"), page(9, "</p></b><p>z< 3 & 4"),
            (None, None, "<p>w</p>", None, None, None), (11, "", "<p title='a > b'>v&nbsp;&#xD800;</p>", None, None, None),
            page(12, "<p>" + "<div>u" * 20_000)]
    got = run(spark, rows)
    assert got[1] == got[2] == got[4] == ""
    assert got[3] == "no markup at all"
    assert got[5] == "\n".join(["word & more"] * 30_000)
    assert (got[6], got[7], got[8], got[9], got[None]) == ("cut\noff", "a", "x", "z< 3 & 4", "w")
    assert got[11] == "v �"
    assert got[12] == "\n".join("u" * 20_000)
    assert run(spark, []) == {}


def test_reader_is_linear():
    import time

    for text in ("<a b=\"" * 100_000, "<a b='>\" " * 100_000, "<b><div>" * 50_000 + "</b>" * 50_000, "<li><div>x" * 50_000, "<!--" * 100_000,
                 "<" * 300_000, "<a " * 100_000 + ">", "&" * 300_000, "<title>" * 50_000, "<p><a>" * 50_000 + "</p>"):
        began = time.monotonic()
        markup.Reader()(text)
        assert time.monotonic() - began < 10, text[:20]
