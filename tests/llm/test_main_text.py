"""Main text: broken heads, attributes, wrappers, parts beside an article, and densities against a second computation."""

import xml.etree.ElementTree as ET
from math import e, log

import pytest

from tallyloom.llm.main_text import Page, main_text

T = "The quick article text goes on and on for a while, with many words in it. " * 4
P = f"<p>{T}</p>"
PAGES = {
    "form around the body": f"<body><form id=aspnetForm>{P}{P}<input><label>Search</label><button>Go</button></form></body>",
    "form around the article": f"<form id=aspnetForm><nav><a href=x>menu</a></nav><main><article>{P}{P}</article></main></form>",
    "role around the text": f"<div role=form>{P}{P}</div>",
    "role around the article": f"<div role=search><article>{P}{P}</article><label>Mail</label></div>",
    "aside around the text": f"<nav>menu</nav><aside>{P}{P}</aside>",
    "aside around the article": f"<aside><article>{P}{P}</article></aside>",
    "head without end": f"<html><head><title>x</title><meta a=b><link c=d><body>{P}{P}</body>",
    "head without end or body": f"<html><head><title>x</title>{P}{P}",
    "head ended by text": f"<html><head><title>x</title> {T}{P}",
    "self-closed graphic": f"<svg class=i/>{P}{P}",
    "self-closed graphic in a text": f"<p><svg class='i' /><math/>{T}</p>{P}",
    "hidden inside a value": f"<div title=\"The hidden truth\">{P}{P}</div>",
    "hidden inside code": f"<div onclick=\"el.hidden = true; a.class = 'comments'\">{P}{P}</div>",
    "hidden inside a name": f"<div data-hidden='false' data-id='sidebar' data-class=comments x-style='display:none'>{P}{P}</div>",
    "notice beside the article": f"<article>{P}{P}</article><div class=xyz><p>We use some technology of ours on this site today.</p></div>",
    "advert beside the article": f"<a href=q>home</a><article>{P}{P}</article><div class=qrs><p>Buy this product now and save a lot of money today.</p></div>",
    "comment beside the article": f"<main><article>{P}{P}</article><div class=kommentar><p>I like the text of this article, thank you so much.</p></div></main>",
}


@pytest.mark.parametrize("name", PAGES)
def test_the_article_and_nothing_else(name):
    assert main_text(PAGES[name]) == "\n\n".join([T.strip(), T.strip()]) if "in a text" not in name and "by text" not in name else main_text(PAGES[name]).count(T.strip()) == 2


@pytest.mark.parametrize("attribute", ["hidden", "hidden=''", "HIDDEN", "style='display: none'", "aria-hidden=true", "title='a > b' hidden"])
def test_hidden_elements_are_no_text(attribute):
    assert main_text(f"<article>{P}<div {attribute}><p>not to be seen</p></div>{P}</article>") == "\n\n".join([T.strip(), T.strip()])


def test_small_forms_and_asides_go():
    page = f"<article>{P}<form><p>Subscribe to our letter</p><label>Mail</label></form>{P}</article><aside><p>Read this too</p></aside><div role=search><p>Find</p></div>"
    assert main_text(page) == "\n\n".join([T.strip(), T.strip()])


def test_titles_and_further_articles_belong():
    page = f"<main><h1>A title</h1><article class=a>{P}</article><article class=a>{P}</article></main><div><p>Something else</p></div>"
    assert main_text(page) == "\n\n".join(["A title", T.strip(), T.strip()])


TREES = [
    "<div><p>one two three</p><p>four <a>five</a> six</p><ul><li><a>x</a></li><li>seven  eight</li></ul></div>",
    "<section><div><span>a</span><em>bc</em></div><div>long text here, more of it</div></section>",
    "<div><a>only links</a><a>and more</a></div>",
    "<article><h2>Title</h2><p>text</p><div><div><div>deep <b>bold</b> end</div></div></div></article>",
]


@pytest.mark.parametrize("tree", TREES)
@pytest.mark.parametrize("link", ["", "<div><a>far away link</a></div>"])
def test_densities_match_a_recursive_computation(tree, link):
    root = ET.fromstring(f"<body>{tree}{link}</body>")
    size = lambda text: len(" ".join((text or "").split()))

    def walk(node, linked):
        """[(chars, link chars, tags, link tags)] of the node and those below, in page order."""
        linked = linked or node.tag == "a"
        chars, below = size(node.text), []
        links, tags, link_tags = chars * linked, 0, int(node.tag == "a")
        for child in node:
            found = walk(child, linked)
            c, lc, t, lt = found[0]
            tail = size(child.tail)
            chars, links, tags, link_tags = chars + c + tail, links + lc + tail * linked, tags + t + 1, link_tags + lt
            below += found
        return [(chars, links, tags, link_tags), *below]

    nodes = walk(root, False)
    share = nodes[0][1] / max(nodes[0][0], 1)
    wanted = []
    for c, lc, t, lt in nodes:
        t = max(t, 1)
        value = c / t
        if value and nodes[0][1]:
            value *= max(log(c * t / (max(lc, 1) * max(lt, 1))), 0) / log(log(c * lc / max(c - lc, 1) + share * c + e))
        wanted.append(value)
    density, chars, _ = Page(f"<body>{tree}{link}</body>").densities()
    assert density == pytest.approx(wanted) and chars == [n[0] for n in nodes]
