import pytest

from staylens.llm import html_density as op
from tests_llm_helpers import frame

LONG = "This sentence is long enough to look like a part of the article and not like a menu"
PAGES = {
    "": "", "plain &amp; text": "plain & text", "<p>a<p>b": "a b",
    f"<html><head><title>t</title></head><body><nav><ul><li><a href=x>Home</a></ul></nav><div class='ad'>Buy {LONG}</div>"
    f"<article><h1>Head &lt;1&gt;</h1><p>{LONG}<br>more  <b>bold</b>er&nbsp;text<p>x</article><footer>&copy; {LONG}</footer>":
        f"Head <1> {LONG} more bolder text x",
    f"<body><div id=menu><a href=1>One</a><a href=2>Two</a></div><div class=content><h2>T</h2><p>{LONG}</p><ul><li>i<li>j</ul>"
    f"</div><div class='sidebar-left'><p>{LONG}</p></div><section id=comments><p>{LONG} {LONG} {LONG}</p></section>"
    f"<form><p>{LONG}</p></form><script>var x='<p>no</p>';</script></body>": f"T {LONG} i j",
    f"<main><p>{LONG}</p><aside>{LONG}</aside><p>end</main><div>{LONG} {LONG}</div>": f"{LONG} end",
    f"<table><tr><td>{LONG}<td>cell<tr><th>x</table>": f"{LONG} cell x",
    f"<article><p>{LONG}<!-- comment --><p hidden>no</p><p>tail &am": f"{LONG} tail &am",
}


@pytest.mark.parametrize("page", list(PAGES))
def test_main_text(page):
    assert op.main_text(page) == PAGES[page]


def test_deep_and_broken_pages():
    assert op.main_text("<div>" * 5000 + LONG) == LONG
    assert op.main_text("<" * 1000 + LONG).endswith(LONG)
    assert op.main_text("<p>" + "x " * 200_000) == " ".join(["x"] * 200_000)


def test_table(spark):
    rows = [(i, f"u{i}", page) for i, page in enumerate(PAGES)] + [(99, None, None), (99, None, None)]
    made = op.extract(frame(spark, rows, "page_id long, main string, html string"), name="found").collect()
    assert len(made) == len(rows)
    for r in made:
        assert r.found.text == PAGES.get(r.html or "") and r.found.n_chars == len(r.found.text)
    assert op.extract(frame(spark, [], "page_id long, html string")).count() == 0


ARTICLE = f"<article><h1>Head</h1><p>{LONG}</p><p>end</p></article>"


@pytest.mark.parametrize("name", ["layout with-sidebar", "no-comments", "has-header", "search-results"])
def test_marked_wrappers_keep_the_article(name):
    around = f"<div class='sidebar'><p>{LONG}</p></div>"
    assert op.main_text(f"<body><div class='{name}'>{ARTICLE}{around}</div></body>") == f"Head {LONG} end"
    assert op.main_text(f"<body><form><div id='{name}'>{ARTICLE}</div></form><p>tail</body>") == f"Head {LONG} end"
    # Without an article element, the text decides.
    plain = f"<div><h2>T</h2><p>{LONG}</p><p>{LONG}</p></div><div class=ad><p>Buy</p></div>"
    assert op.main_text(f"<body><a href=x>Home</a><div class='{name}'>{plain}</div></body>") == f"T {LONG} {LONG}"
    assert op.main_text(f"<form>{plain}</form>") == f"T {LONG} {LONG}"


def test_marked_elements_beside_the_article_are_cut():
    comments = f"<div id=comments><article class=comment-body><p>{LONG}</p></article><article><p>{LONG} {LONG}</p></article></div>"
    assert op.main_text(f"<body>{ARTICLE}<div class=ad>{LONG} {LONG} {LONG}</div></body>") == f"Head {LONG} end"
    assert op.main_text(f"<body><div><p>{LONG}</p>{ARTICLE}<p>{LONG}</p></div>"
                        f"{comments.replace(LONG, 'short')}</body>") == f"Head {LONG} end"


def test_a_page_of_marked_elements_only_is_not_empty():
    page = "<body><a href=x>Home</a>" + "".join(f"<div class=widget><p>{LONG} {i}</p></div>" for i in range(3)) + "</body>"
    assert all(f"{LONG} {i}" in op.main_text(page) for i in range(3))
