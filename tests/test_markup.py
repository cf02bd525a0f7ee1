"""The regular-markup reader must build the same tree as the tolerant parser."""

from __future__ import annotations

import random

from hypothesis import given, settings, strategies as st

from tallyshelf.sources.markup import Page

PIECES = (
    "< > </ /> <div> </div> <p> </p> <br> <br/> </br> </a> <script> </script> <style> </style> <!----> <!--c--> "
    "<!--x--y--> <![CDATA[x]]> <?pi?> &amp; &lt; &copy &unknown; text = <title> </title> <template> </template> "
    "<div/> & -- --> <a/b> <1> <x:y> <rt> </rt> <script/> <img/> é"
).split() + [" ", "\n", "\r\n", "'", '"', '<a href="x&amp;y">', "<a href=x>", "<img src=a/>", '<DIV Class="A b" class=\'c\'>',
             '<a href="a>b">', "<!doctype html>", "</SCRIPT >", "<a b='c\"d'>"]


def shape(page: Page):
    return [
        (n.tag, n.attrs if n.tag and n.at else None, n.parent.at if n.parent else None, n.end, n.text, n.hidden)
        for n in page.nodes
    ]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_regular_reader_equals_tolerant_parser(pieces):
    html = "".join(pieces)
    try:
        expected = shape(Page(html, tolerant=True))
    except Exception as problem:
        expected = type(problem)
    try:
        found = shape(Page(html))
    except Exception as problem:
        found = type(problem)
    assert found == expected


def test_long_random_pages():
    rng = random.Random(11)
    for _ in range(300):
        html = "".join(rng.choice(PIECES) for _ in range(80))
        try:
            expected = shape(Page(html, tolerant=True))
        except Exception:
            continue
        assert shape(Page(html)) == expected


def test_no_implied_closing_and_nearest_open_match():
    page = Page("<div><p>a<p>b</div>c</p><b>d")
    outer, inner = list(page.elements(page.root, "p"))
    assert inner.parent is outer
    assert page.text(page.root) == "a b c d"
    assert page.text(outer) == "a b"


def test_hidden_text_is_left_out():
    page = Page("<p>a<!-- x --><script>b</script><style>c</style><template><i>d</i></template>e &amp; f</p>")
    assert page.texts(page.root) == ["a", "e & f"]


def test_void_elements_hold_nothing():
    page = Page("<p>a<br>b</br><img src=x>c</p>")
    assert page.text(page.root, "|") == "a|b|c"
    assert [n.end - n.at for n in page.elements(page.root, "br", "img")] == [1, 1]
