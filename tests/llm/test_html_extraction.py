import pytest

from fathomline.llm import html_extraction as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li>Menu</li></ul></nav>
<div class="cookie-notice">We use cookies, please agree to all of them now.</div>
<div class="{box}"><h1>Title &amp; more</h1><P>First   para&nbsp;one<br>line two<p>Second <b>bold</b> <a href="x">link</a>.
<script>var a = "<p>no</p>";</script><!-- <p>hidden</p> --><blockquote>Quoted &#233;</blockquote><ul><li>Item one<li>Item two</ul>
<form><p>Form text</p></form></div>
<aside><p>Side text that is quite long, with many words in it, so that it could be taken for the article.</p></aside>
<div class="comments"><p>First comment by a reader, which is long enough to look like a paragraph of text.</p></div>
<footer><p>&copy; nobody</p></footer></body></html>"""
TEXT = "Title & more\nFirst para one line two\nSecond bold link.\nQuoted é\nItem one\nItem two"


def test_blocks():
    for box in ("content", "post-12", "with-sidebar"):
        html = PAGE.format(box=box)
        assert h.extracted(html, h.votes(html)[0][0]) == TEXT


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\nb"), ("<nav>x</nav>", ""), ("<p>a < b &lt; c</p>", "a < b < c"),
        ("<article><p>a</article></div></p><p>tail", "a"), ("<article><script>x", ""), ("<article>&amp;lt; <![CDATA[ q&amp; ]]></article>", "&lt; q&amp;"),
        ("<ARTICLE><h1 title='a>b'>A\t\nB</h1></ARTICLE>", "A B"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b\nc"), ("<p hidden>x</p><p>y</p>", "y"),
    ],
)
def test_odd_pages(html, text):
    best = h.votes(html)
    assert h.extracted(html, best[0][0] if best else None) == text


def test_long_pages_take_linear_time():
    html = "<div>" * 300 + "<p>x " * 20_000 + "<a b='" + "c" * 100_000
    assert h.extracted(html, None).startswith("x\nx")


def test_host_agrees(spark):
    good = "<body><div class=main2><p>" + "article words here " * 20 + "</p></div><div class=links><p>{}</p></div></body>"
    rows = [(i, f"http://A.example/{i}", good.format("short")) for i in range(5)]
    rows.append((5, "https://u@a.example:80/5", good.format("a longer teaser than the article, repeated once more. " * 20)))
    rows += [(6, "http://b.example", "<p>other</p>"), (7, None, None), (8, "http://a.example/x", "<section><p>alone</p></section>"), (6, "http://b.example", "<p>other</p>")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, path string, text string")
    out = {r["page_id"]: r for r in h.extract(pages).collect()}
    want = ("article words here " * 20).strip()
    assert [out[i]["text"] for i in range(6)] == [want] * 6  # the host's path, also where another container is larger
    assert out[6]["text"] == "other" and out[7]["text"] == "" and out[8]["text"] == "alone"
    assert h.extract(pages).count() == len(rows) and h.extract(pages.limit(0)).count() == 0
    assert {r["n_chars"] for r in h.op4_html_extraction(pages.filter("page_id = 6")).collect()} == {5}


def test_given_pages(spark):
    import re
    from html import unescape

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = {r["page_id"]: r["text"] for r in h.op4_html_extraction(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        plain = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in blocks]
        assert out[r["page_id"]] == "\n".join(b for b in plain if b)
