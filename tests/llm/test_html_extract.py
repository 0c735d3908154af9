import html
import re

from strata.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body class="with-sidebar"><header class="top"><p>Site header text that is quite long</p></header>
<nav><ul><li><a href="/">Home</a><li>More</ul></nav><div class="cookie-notice"><p>We use cookies, really a lot of them</p></div>
<!-- <p>comment</p> --><div class="ad">Buy now, this advert is long enough to count</div>
<div id="main" class="post-{n} content"><h1>Head &amp; <i>line</i></h1><p><b>First&nbsp;para
 graph, with   some words<br>and a break<p>Second &lt;para&gt; &#233;t&eacute; here, long enough
<ul><li>one<li>two <a href=x>link</a></ul><form><p>Your name please</p></form>
<aside><p>Related story text, long enough to count</p></aside></div>
<section class="comments"><article class="comment"><p>A reader writes a very long remark about all of this, on and on</p></article></section>
<footer>Imprint and more</footer></body></html>"""
TEXT = "Head & line First para graph, with some words and a break Second <para> été here, long enough one two link"


def test_main_text_of_a_page():
    assert H.extract(PAGE.format(n=3), []) == TEXT
    paths = [p for p, _ in H.votes(PAGE.format(n=12))]
    assert paths[0] == "html/body.with-sidebar/div.content.post-"
    assert H.extract(PAGE.format(n=7), paths) == TEXT


def test_odd_markup():
    assert H.extract("", []) == "" and H.extract("just text", []) == "just text"
    assert H.extract("<p>a<p>b", []) == "a b" and H.extract("x<b>y</b>z</div> w", []) == "xyz w"
    assert H.extract("<article><p>unclosed <b>bold <i>both</b> on", []) == "unclosed bold both on"
    assert H.extract("<div>" * 3000 + "deep", []) == "deep"
    assert H.extract("a &amp;&#x41;&unknown; b", []) == "a &A&unknown; b"
    assert H.extract("<" * 500, []) == "<" * 500


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_the_host_vote_decides(spark):
    body = "<body><div class='story'><p>{}</p></div><div class='box'><p>{}</p></div></body>"
    usual = [(i, f"http://h.example/{i}", body.format("The story text of this page, long. " * 9, "Box text here, a bit long")) for i in range(9)]
    # its box is longer than its story, but by less than twice: the host's path holds
    odd = (99, "http://h.example/odd", body.format("Story text. " * 20, "Box words. " * 30))
    out = {r.page_id: r.text for r in H.main_text(spark, pages(spark, [*usual, odd])).collect()}
    assert out[99] == ("Story text. " * 20).strip()
    assert H.extract(odd[2], []) == ("Box words. " * 30).strip()


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "no url", ""), (None, "http://a.example/x", "<p>hi there</p>"),
            (4, "https://u@b.example:80/", PAGE.format(n=1)), (4, "https://u@b.example:80/", PAGE.format(n=1)),
            (5, "http://b.example", "<p>" + "long " * 60_000)]
    df = pages(spark, rows).selectExpr("*", "'own' as text", "1 as paths", "'x' as host")
    out = H.main_text(spark, df)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == len(rows)
    got = {}
    for r in out.collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.page_id, []).append(r.text)
    assert got[1] == [""] and got[2] == [""] and got[None] == ["hi there"] and got[4] == [TEXT, TEXT]
    assert got[5] == [("long " * 60_000).strip()]
    assert H.main_text(spark, df.limit(0)).count() == 0


def test_given_pages_against_their_articles(spark, small_sf):
    given = {r.page_id: r for r in spark.read.parquet(f"{small_sf}/pages.parquet").collect()}
    rows = H.op5_html_extract(spark, small_sf).collect()
    assert len(rows) == len(given)
    for r in rows:
        article = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", given[r.page_id].html, re.S)[1]
        plain = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article)))
        assert r.text == " ".join(plain.split())
