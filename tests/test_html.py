import time

import pytest

from newsrisk.sources import html
from newsrisk.sources.html import parse, select, select_one
from newsrisk.sources.listing import LAYOUTS, ListingLayout, _items


def test_text_joins_stripped_strings_and_decodes_entities():
    page = parse("<h2 class='t x'> Harga <b>emas</b> &amp; perak a < b <!-- c --> naik</h2>")
    assert select_one(page, ("h2.t.x",)).text() == "Hargaemas& perak a < bnaik"


def test_descendant_selector_needs_the_ancestor():
    page = parse("<h3><a href='1'>x</a></h3><p><a href='2'>y</a></p>")
    assert [a.attrs["href"] for a in select(page, "h3 a")] == ["1"]
    assert [a.attrs["href"] for a in select(page, "h3 a, p a")] == ["1", "2"]


def test_class_is_a_token_not_a_substring():
    page = parse("<div class='rows'></div><div class='a row b'></div>")
    assert len(select(page, "div.row")) == 1


def test_unclosed_and_stray_tags():
    page = parse("</div><p>" * 5000 + "<a href='deep'>x")
    assert select_one(page, ("a[href]",)).attrs["href"] == "deep"


def test_void_elements_do_not_nest():
    page = parse("<div class='row'>a<br>b<img src=x>c</div><p>d</p>")
    assert select_one(page, ("div.row",)).text() == "abc"
    assert select_one(page, ("div.row p",)) is None


def test_script_text_is_not_content():
    page = parse("<div class='row'>a<script>var t = '</p>';</script>b</div>")
    assert select_one(page, ("div.row",)).text() == "ab"


def test_fallback_selectors_in_order():
    page = parse("<div class='m'>second</div><h3 class='m'>first</h3>")
    assert select_one(page, ("h3.m", ".m")).text() == "first"


def test_enclosing_anchor():
    page = parse("<a href='out'><div class='c'><h2>t</h2></div></a>")
    assert select_one(page, ("div.c",)).ancestor("a").attrs["href"] == "out"


@pytest.mark.parametrize(
    "html",
    ["</div><p>" * 40_000, "<div>" * 40_000 + "</p>" * 40_000, "< " * 200_000, "<b>x</i>" * 40_000],
    ids=["stray", "deep", "brackets", "mixed"],
)
def test_broken_pages_take_linear_time(html):
    start = time.process_time()
    for layout in LAYOUTS.values():
        assert _items(html + "<a href='deep'>x", layout) == (False, [])
    assert time.process_time() - start < 2 * len(LAYOUTS)


def test_unclosed_items_take_linear_time():
    layout = ListingLayout(item=("ul li",), title=("h2 a",), date=("span.d", "time"), link="around")
    html = "<ul>" + "".join(f"<li><h2><a href='{i}'>t{i}</a></h2>" for i in range(20_000))
    start = time.process_time()
    _, items = _items(html, layout)
    assert time.process_time() - start < 2
    assert len(items) == 20_000 and items[7]["title"] == "t7" and items[7]["link"] == "7"


def test_nested_chain_needs_its_parts_in_order():
    page = parse("<ul><li><b><ul><li><i>x</i></li></ul></b></li></ul><i>y</i>")
    assert [n.text() for n in select(page, "ul li i")] == ["x"]
    assert select(page, "b ul b") == [] and select(page, "i li") == []


def standard(page):
    builder = html._TreeBuilder()
    builder.feed(page)
    return builder.finish()


def tree(root):
    return [n if isinstance(n, str) else (n.tag, n.attrs, n.start, n.end, n.parent and n.parent.start) for n in root.nodes]


PLAIN_PAGE = "<main><div class='row x'><a HREF=\"u\" b> T &amp; x<br/>&copy</a></p></div><LI>x > y<img src='a'></main>z"


def test_plain_pages_do_not_go_through_the_standard_parser(monkeypatch):
    expected = tree(standard(PLAIN_PAGE))
    monkeypatch.setattr(html._TreeBuilder, "feed", None)
    assert tree(html.parse(PLAIN_PAGE)) == expected


@pytest.mark.parametrize(
    "odd",
    ["<!-- c -->", "<script>a<b</script>", "<title>x<b></title>", "<a href=u>", "<a href='?a=1&b=2'>", "< p>", "<x-y>",
     "<p a='1'b='2'>", "</p >", "<", "</", "<a b = 'c'>", "<a href='>'>", "<!DOCTYPE html>", '<p a=""b>', "&#65;"],
)
def test_odd_markup_reads_as_the_standard_parser_does(odd):
    page = PLAIN_PAGE + odd + PLAIN_PAGE
    assert tree(html.parse(page)) == tree(standard(page))
