"""Whole pages in one form or aside, titles beside the container, odd class names."""

import pytest

from strata.llm import html_extract as H

BODY = " ".join(f"Sentence {i} of the report says something new." for i in range(20))


@pytest.mark.parametrize("wrap", ["<form id='aspnetForm'>{}</form>", "<aside>{}</aside>",
                                  "<div role='form'>{}</div>", "<nav>{}</nav>", "<footer>{}</footer>",
                                  "<form><div class='x'><form>{}</form></div></form>"])
def test_a_wrapper_of_the_whole_page_is_no_boilerplate(wrap):
    page = f"<html><body>{wrap.format(f'<div><h1>Title</h1><p>{BODY}</p></div>')}</body></html>"
    assert H.extract(page, []) == f"Title {BODY}"


def test_small_forms_and_asides_go():
    page = (f"<body><header><h1>Site</h1></header><nav><a href='/'>Home</a> menu</nav><div class='text'><p>{BODY}</p></div>"
            "<aside>See also this</aside><form>Your name</form><footer>Imprint</footer></body>")
    assert H.extract(page, []) == BODY


def test_title_and_lead_in_the_body():
    page = f"<body><h1>TITLE</h1><p>LEAD of the story in a few words</p><div class='text'><p>{BODY}</p></div></body>"
    assert H.extract(page, []) == f"TITLE LEAD of the story in a few words {BODY}"


def test_a_header_that_titles_its_container():
    page = f"<body><header><h1>Site</h1></header><div class='post'><header><h1>TITLE</h1></header><p>{BODY}</p></div></body>"
    assert H.extract(page, []) == f"TITLE {BODY}"
    menu = f"<body><div class='page'><header><h1>Site</h1><ul><li>Menu</li></ul></header><p>{BODY}</p></div></body>"
    assert H.extract(menu, []) == BODY


@pytest.mark.parametrize("name", ["blog-comments", "wp-block-comments", "ez-ad-mid", "cookie-law-info-bar",
                                  "sidebar-right", "ads", "gdpr-notice", "newsletter-box-v2"])
def test_boilerplate_with_unknown_words(name):
    page = f"<body><div class='text'><p>{BODY}</p><div class='{name}'><p>Not part of it.</p></div></div></body>"
    assert H.extract(page, []) == BODY


@pytest.mark.parametrize("name", ["related-work", "hidden-layers", "notice-of-appeal", "skip-target",
                                  "cookie-recipes", "advanced", "download"])
def test_names_that_only_sound_like_it(name):
    page = f"<body><article><h1>T</h1><p>{BODY}</p><section id='{name}'><p>Part of it.</p></section></article></body>"
    assert H.extract(page, []) == f"T {BODY} Part of it."


def brute_paths(pages):
    """The vote of one host, plainly: shares in thousandths, ties by path."""
    totals = {}
    for html in pages:
        best = H.scored(H.parse(html))[:H.VOTES]
        for node in best:
            totals[node.path()] = totals.get(node.path(), 0) + int(node.score / best[0].score * 1000 + 0.5)
    return [p for p, _ in sorted(totals.items(), key=lambda t: (-t[1], t[0]))][:H.PATHS]


def test_the_vote_against_a_plain_count(spark, small_sf):
    pages = spark.read.parquet(f"{small_sf}/pages.parquet")
    rows = [(r.url, r.html) for r in pages.collect()]
    by_host = {}
    for (url, html), at in zip(rows, [r.h for r in pages.select(H.host().alias("h")).collect()]):
        by_host.setdefault(at, []).append(html or "")
    got = {r.host: r.paths for r in H.host_paths(pages).collect()}
    assert got == {h: p for h, p in ((h, brute_paths(x)) for h, x in by_host.items()) if p}
