import pytest

from strata.llm import html_extract as H

LONG = " ".join(["A sentence of the long body."] * 40)


@pytest.mark.parametrize("name", ["elementor-widget-text-editor", "layout-sidebar-right", "skip-target",
                                  "widget", "sidebar-right", "hidden"])
def test_a_wrapper_of_the_body_is_no_boilerplate(name):
    for attr in ("class", "id"):
        page = f"<body><div {attr}='{name}'><div><p>{LONG}</p></div></div><div class='ad'>Buy this now</div></body>"
        assert H.extract(page, []) == LONG
        assert H.extract(page, [p for p, _ in H.votes(page)]) == LONG


@pytest.mark.parametrize("name", ["related-work", "hidden-layers", "notice-of-appeal"])
def test_a_section_with_a_boilerplate_word_in_its_name(name):
    page = f"<body><article><p>{LONG}</p><section id='{name}'><h2>Head</h2><p>Words of it.</p></section></article></body>"
    assert H.extract(page, []) == f"{LONG} Head Words of it."


@pytest.mark.parametrize("name", ["ad", "cookie-notice", "related-posts", "site-footer", "commentList", "box share-buttons"])
def test_boilerplate_names_still_drop(name):
    page = f"<body><article><p>{LONG}</p><div class='{name}'><p>Words that are not of the article.</p></div></article></body>"
    assert H.extract(page, []) == LONG


def test_captions_of_figures_stay():
    page = f"<body><article><p>{LONG}</p><figure><img src=x><figcaption>A caption.</figcaption></figure></article></body>"
    assert H.extract(page, []) == f"{LONG} A caption."


def test_comments_longer_than_the_article_still_drop():
    page = (f"<body><article><p>Short article words.</p></article><section class='comments'><p>{LONG}</p>"
            "</section></body>")
    assert H.extract(page, []) == "Short article words."
