"""Regions of web pages: pages whose articles are known, and a plain version on the given pages."""

import html
import random
import re

import duckdb
import pytest

from clicktrail.llm import html_text

PAGES = "/root/testdata/sf0.001/pages.parquet"
LONG = "A sentence of the article that goes on for some time, so that nobody takes it for a menu or a button. " * 3
CHROME = (
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>',
    '<div class="ad">Buy this now, it is cheap and good and you surely need one of these at home</div>',
    '<div id="site-header"><a href="/">The site</a></div>',
    '<div class="main-sidebar"><p>' + LONG + "</p></div>",
    '<div role="alert">We keep cookies, and tell you so at great length in this very long notice</div>',
    '<footer><p>&copy; all rights</p></footer>',
    '<form action="/s"><input name="q"><p>Mail address please, we write to you often</p></form>',
    '<div class="comments-section"><p>A reader says very much about this article, and more and more</p></div>',
    "<script>var t = '<p>no text</p>';</script>",
    '<div class="share-buttons"><a href="x">Share</a></div>',
)


def plain_text(page: str) -> str:
    """What stands in the article of a given page, by regular expressions."""
    inside = re.search(r"(?s)<article>(.*)</article>", page)[1]
    assert not re.search(r"<(nav|form|aside|script|style|div)", inside)
    blocks = re.split(r"</?(?:p|h1|li|ul|div)>", inside.replace("<br>", " "))
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("tag", ["article", "div", "main", "section"])
def test_given_pages_equal_a_plain_version(tag):
    pages = [p for (p,) in duckdb.sql(f"SELECT html FROM '{PAGES}' WHERE html LIKE '%<article>%'").fetchall()]
    assert pages
    for page in pages:
        renamed = page.replace("<article>", f"<{tag}>").replace("</article>", f"</{tag}>")
        assert html_text.main_text(renamed) == plain_text(page)


def article(rng: random.Random) -> tuple[str, list[str]]:
    """Markup of an article with long and short parts, and its lines."""
    words = lambda n: " ".join(rng.choice(("sea", "and", "R&D", "tree", "of", "<b>", "wind", "x")) for _ in range(n))
    parts, lines = [], []

    def add(tag: str, text: str) -> str:
        lines.append(text)
        return f"<{tag}>{html.escape(text)}</{tag}>"

    parts.append(add("h1", words(5)))
    for _ in range(rng.randint(2, 6)):
        parts.append(add("p", LONG.strip() + " " + words(rng.randint(5, 60))))
        kind = rng.randrange(5)
        if kind == 0:
            parts.append("<ul>" + "".join(add("li", words(2)) for _ in range(9)) + "</ul>")
        elif kind == 1:
            parts.append("<blockquote>" + "".join(add("p", words(3)) for _ in range(8)) + "</blockquote>")
        elif kind == 2:
            parts.append(add("h2", words(3)))
        elif kind == 3:
            parts.append('<div class="related-work">' + add("p", words(4)) + "</div>")
        else:
            parts.append(rng.choice([c for c in CHROME if "site-header" not in c]))
    parts.append(add("p", LONG.strip()))
    parts.append(add("p", words(2)))
    return "".join(parts), lines


@pytest.mark.parametrize("opening", ["<article>", "<main>", "<div>", '<div class="content has-sidebar">', '<section id="social-science">'])
def test_articles_of_made_pages_come_back_whole(opening):
    rng = random.Random(opening)
    close = f"</{re.match(r'<(\w+)', opening)[1]}>"
    for _ in range(60):
        body, lines = article(rng)
        chrome = [rng.choice(CHROME) for _ in range(6)]
        page = f"<html><body>{''.join(chrome[:3])}{opening}{body}{close}{''.join(chrome[3:])}</body></html>"
        assert html_text.main_text(page) == "\n".join(" ".join(x.split()) for x in lines)


def test_text_right_in_the_page():
    menu = "<div>" + '<a href="x">One</a> <a href="y">Two</a>' + "</div>"
    verse = "".join(f"<p>line {k}</p>" for k in range(9))
    page = f"<body>{menu * 3}<h1>Title</h1><p>{LONG}</p>{verse}<ul><li>a</li><li>b</li></ul><p>{LONG}</p><p>End.</p><div>Imprint</div>{menu}</body>"
    want = ["Title", LONG.strip(), *(f"line {k}" for k in range(9)), "a", "b", LONG.strip(), "End."]
    assert html_text.main_text(page) == "\n".join(want)


def test_region_without_a_name_leaves_menus_of_links():
    links = "".join(f'<li><a href="{k}">Link number {k}</a></li>' for k in range(8))
    page = f"<div id='page'><div><ul>{links}</ul></div><div><h1>T</h1><p><a href='x'>Ann</a></p><p>{LONG}</p><p>Short.</p></div><ul>{links}</ul></div>"
    assert html_text.main_text(page) == "\n".join(["T", "Ann", LONG.strip(), "Short."])


def test_two_parts_of_one_text_and_several_articles():
    two = f"<div><div><h1>T</h1><p>{LONG * 5}</p></div><div><p>{LONG}</p></div></div><div>Imprint</div>"
    assert html_text.main_text(two) == "\n".join(["T", (LONG * 5).strip(), LONG.strip()])
    several = "".join(f"<article><h2>T{k}</h2><p>{LONG * (1 + 20 * (k == 1))}</p></article>" for k in range(3))
    assert html_text.main_text(several).count("\n") == 5


@pytest.mark.parametrize(
    ("name", "found"),
    [
        ("ad", True), ("main-nav", True), ("mainNav", True), ("share-box", True), ("comments-list", True), ("top-ad-728x90", True), ("AD", True),
        ("has-sidebar", False), ("no-comments", False), ("related-work", False), ("social-science", False), ("shadow", False), ("wrapper", False),
        ("", False), ("728", False),
    ],
)
def test_what_names_say(name, found):
    assert html_text.says(name, html_text.BOILERPLATE) is found


def test_very_deep_and_very_long_pages():
    assert html_text.main_text("<div>" * 30_000 + LONG) == LONG.strip()
    assert html_text.main_text("<b>" * 30_000 + LONG + "</i>" * 30_000) == LONG.strip()
    assert len(html_text.main_text(f"<p>{LONG}</p>" * 5000).split("\n")) == 5000
