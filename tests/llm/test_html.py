import re
from html import unescape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import html as op
from clickloom.llm.queries import QUERIES


def article(page):
    """The pages of the test tables have one article of h1 and p."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|br)>", re.sub("</?b>", "", inside))
    return " ".join(t for b in blocks if (t := " ".join(unescape(b).split())))


def test_query_gives_the_articles(spark, sf_dir, table_rows):
    got = QUERIES["op5_html_text"](spark, sf_dir)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    pages = table_rows("pages")
    want = {(p, u, t, len(t)) for p, u, t in zip(pages.page_id, pages.url, pages.html.map(article))}
    assert set(map(tuple, got.collect())) == want


TEXT = "A sentence of the article, with some words. And another one, longer than the first; it goes on."
PARTS = {
    "menu": "<nav><ul><li><a href='/a'>Home</a><li><a href=/b>News</a></ul></nav>",
    "header": "<header><h1>Site name</h1> slogan, of the site.</header>",
    "advert": '<div class="box ad-slot">Buy this, now! Very cheap.</div>',
    "cookie": '<div id="cookie-notice"><p>We use cookies, as others do. Accept?</p></div>',
    "form": "<form><p>Your name, please.</p><input name=x><button>Send</button></form>",
    "script": "<script>var a = '<p>not text</p>';</script><style>p { color: red }</style><!-- <p>no</p> -->",
    "aside": "<aside><p>Also read, this one. And that one.</p></aside>",
    "hidden": "<div hidden><p>Hidden text, here.</p></div><div style='display: none'>Gone, too.</div>",
    "comments": "<section class=comments><article><p>I like it, really. First!</p></article></section>",
    "footer": "<footer>&copy; 2024, all rights. Imprint.</footer>",
    "role": "<div role=navigation>Up, down.</div>",
}


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_other_parts_go(part, tag):
    page = f"<html><head><title>T.</title></head><body>{PARTS[part]}<{tag}><p>{TEXT}</p><p>{TEXT}</p></{tag}>{PARTS[part]}"
    assert op.main_text(page) == f"{TEXT} {TEXT}"


WRAPPERS = ["div class=has-sidebar", "section id='content-with-sidebar'", "div class='page no-comments'", "form action=/x"]


@pytest.mark.parametrize("wrapper", [*WRAPPERS, "div class=page-header-banner", "div class=social", "div role=form"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_wrappers_with_marks_stay(wrapper, tag):
    ad = PARTS["advert"] + PARTS["menu"] + PARTS["hidden"]
    page = f"<body><{wrapper}>{ad}<{tag}><p>{TEXT}</p><p>{TEXT}</p></{tag}>{ad}</{wrapper.split()[0]}></body>"
    assert op.main_text(page) == f"{TEXT} {TEXT}"


def test_marked_parts_beside_the_article_go_even_if_longer():
    for part in ("<div class=comments>", "<section class=related><article>"):
        for tag in ("article", "div"):
            page = f"<{tag}><p>{TEXT}</p></{tag}>{part}<p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p>"
            assert op.main_text(page) == TEXT
    assert op.main_text(f"<div><p>{TEXT}</p></div><div class=widget><article>Teaser, short.</article></div>") == TEXT
    assert op.main_text(f"<div class='x no-comments'><p>{TEXT}</p></div><p>Stray line, here.</p>").startswith(TEXT)
    assert op.main_text(f"<div class=legal><div class=ad>Buy, now!</div><p>{TEXT}</p></div>") == TEXT


def test_a_menu_without_names_goes_by_its_ratio():
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div><h2>Title</h2><p>{TEXT}</p><p>Short.</p></div></div></body>"
    assert op.main_text(page) == f"Title {TEXT} Short."


def test_white_space_references_and_unclosed_tags():
    page = "<article><h1>A&amp;B</h1><p>one\n two<br>th<b>re</b>e &eacute;<p>four <i>five<p>six</article>"
    assert op.main_text(page) == "A&B one two three é four five six"
    assert op.main_text("<article><p>cut off he") == "cut off he"
    assert op.main_text("<article><p>cut off</p></artic") == "cut off"
    assert op.main_text("a < b, and c > d. x <3") == "a < b, and c > d. x <3"
    assert op.main_text("<article><header><h1>Head</h1></header><p>Body, text.</p></article>") == "Head Body, text."
    assert op.main_text('<p title="a > b">In, it.</p>') == "In, it."


def test_comments_inside_the_article_go():
    page = f"<article><p>{TEXT}</p><div id=comments><article class=comment><p>{TEXT}</p></article></div></article>"
    assert op.main_text(page) == TEXT


@settings(max_examples=300, deadline=None)
@given(st.text("<>/!-pabdiv \"'=&;x.", max_size=80))
def test_any_page_is_read(page):
    found = op.main_text(page)
    assert found == " ".join(found.split())


def test_long_and_deep_pages():
    assert op.main_text("<div>" * 3000 + TEXT) == TEXT
    assert len(op.main_text(f"<article>{f'<p>{TEXT}' * 3000}</article>")) == 3000 * (len(TEXT) + 1) - 1
    op.main_text("<a \"" * 3000)
    op.main_text("<!--" * 20000)


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "x", "y"), (1, None, "", "x", "y"), (None, "v", f"<p>{TEXT}", "x", "y"), (2, "w", "<br>", "x", "y")]
    pages = spark.createDataFrame(rows, schema)
    got = pages.select("page_id", op.extract("html").alias("t")).collect()
    assert sorted((r.page_id or 0, r.t) for r in got) == [(0, TEXT), (1, ""), (1, ""), (2, "")]
    assert pages.where("false").select(op.extract("html")).collect() == []


LINE = "Mix the flour with water and salt, slowly; leave it for a night, then bake it for an hour, not more."
RECIPE = f"""<body><div><ul><li><a href=x>Home</a><li><a href=y>About us</a></ul></div>
<div><div><h1>Bread</h1><p>{LINE}</p><ul><li>Flour</li><li>Salt</li></ul><p>Short.</p><div><p>{LINE}</p></div>
<table><tr><td>Time</td><td>2 h</td></tr></table><p><a href=z>By hand</a></p></div></div>
<div>Buy now and save</div><div><div>Write to us.</div></div></body>"""


def test_a_page_without_telling_names_keeps_all_of_its_main_element():
    want = f"Bread {LINE} Flour Salt Short. {LINE} Time 2 h By hand"
    assert op.main_text(RECIPE) == want


def test_the_ratios_decide_where_names_do_not(monkeypatch):
    want = op.main_text(RECIPE)
    monkeypatch.setattr(op, "kept_paths", lambda blocks: {b[0] for b in blocks})
    spoiled = op.main_text(RECIPE)
    assert spoiled != want and "Home" in spoiled and "Buy now" in spoiled


def test_ratios_alone_find_most_articles_of_the_test_pages(table_rows):
    """Without the names of parts and the article's own element, from the paths only."""
    pages = table_rows("pages").html
    found = 0
    for page in pages:
        blocks = [(path, content, linked, False, -1) for path, content, linked, *_ in op.Blocks(page).found]
        paths = op.kept_paths(blocks)
        found += " ".join([b[1] for b in blocks if b[0] in paths]) == op.main_text(page)
    assert found > 0.6 * len(pages)


def test_main_element():
    assert op.main_element({}) == "" and op.main_element({"": 3.0}) == ""
    assert op.main_element({"a/b/p": 5.0, "a/b/ul/li": 3.0, "a/c/p": 1.0}) == "a/b"
    assert op.main_element({"a/b/p": 1.0, "a/c/p": 1.0}) == "a"
