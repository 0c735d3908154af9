from strata.llm import html_extract as H

LEAD, LONG = "The lead of the story. " * 9, "A sentence of the long body. " * 70
NAV = "<nav><a href=/>Home</a></nav>"


def text(page):
    """Extracted alone and by the page's own vote."""
    alone = H.extract(page, [])
    assert H.extract(page, [p for p, _ in H.votes(page)]) == alone
    return alone


def joined(*parts):
    return " ".join(" ".join(parts).split())


def test_title_and_lead_outside_the_body_stay():
    page = (f"<body>{NAV}<{{0}}><h1>Title</h1><p>{LEAD}</p><div class='body'><p>{LONG}</p></div></{{1}}>"
            "<div class='box'><p>Some other box of this page</p></div></body>")
    for start, end in (("article", "article"), ("main", "main"), ("div", "div"), ("div class=x", "div")):
        assert text(page.format(start, end)) == joined("Title", LEAD, LONG)


def test_sections_of_several_classes_stay():
    page = (f"<body><article><section class='intro'><p>{LEAD}</p></section><section class='deep'><p>{LONG}</p>"
            f"</section><section class='end'><p>Last words of it.</p></section></article><div>{NAV}</div></body>")
    assert text(page) == joined(LEAD, LONG, "Last words of it.")


def test_nested_bodies_stay_whole_and_once():
    page = (f"<body><div class='post'><h1>Title</h1><div class='inner'><div class='body'><p>{LONG}</p></div>"
            f"<div class='body'><p>{LEAD}</p></div></div></div><div class='box'>Box words, a few</div></body>")
    assert text(page) == joined("Title", LONG, LEAD)


def test_a_sibling_box_is_not_taken():
    page = (f"<body><div class='wrap'><div class='story'><p>{LONG}</p></div>"
            f"<div class='box'><p>Box words, a few</p></div></div></body>")
    assert text(page) == joined(LONG)
