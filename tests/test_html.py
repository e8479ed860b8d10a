"""Selectors, also against the standard library's parser on random pages."""

import random
from html.parser import HTMLParser

import pytest

from pageloom.functions import html as H
from pageloom.functions.html import element as E
from pageloom.operators.extract import matches

DOC = '''<html><div class="x y"><div class='inner'>a<div>b</div>c<br>d &amp;amp; &eacute;</div>z
<a title="a > b" class="L" href="/1?a=1&amp;b=2">link</a></div><a href='/2' class=L>two</a>
<div class="q"><img src="1.png"><b><img src=2.png></b><img src='3.png'/></div>
<!-- <a class="L" href="no">no</a> --><script>var t = '<a class="L" href="no">';</script>
<ul><li>1<ul><li>2</li></ul>3</li></ul>
<p class="t">one<p class="t">two <b>bold</b> three</p><div class="inner">last<p>no</p></div>
<div id="annonce-12"><em>k</em></div><i class="tok other">it</i><input name=prix value="">
</html>'''


def select(evaluate, doc, *path, take):
    return evaluate(matches(H.readable("s"), path, take), [doc])[0]


@pytest.mark.parametrize("path, take, want", [
    ((E("div", class_is="inner"),), "text", ["a", "c", "d &amp; é", "last"]),
    ((E("a", class_is="L"),), "@href", ["/1?a=1&b=2", "/2"]),
    ((E("a", class_is="L"),), "@title", ["a > b"]),
    ((E("div", class_token="y"),), "//@href", ["/1?a=1&b=2"]),
    ((E("div", class_token="y"), E("div", class_is="inner")), "visible", ["a b c d &amp; é"]),
    ((E("div", class_is="x"),), "visible", []),
    ((E("div", class_is="q"), E("img", child=True)), "@src", ["1.png", "3.png"]),
    ((E("div", class_is="q"), E("img")), "@src", ["1.png", "2.png", "3.png"]),
    ((E("li"),), "text", ["1", "2", "3"]),
    ((E("p", class_is="t"),), "text", ["one", "two ", " three"]),
    ((E("div", id_prefix="annonce-"),), "@id", ["annonce-12"]),
    ((E("div", id_prefix="annonce-"),), "outer", ['<div id="annonce-12"><em>k</em></div>']),
    ((E("*", class_token="tok"),), "text", ["it"]),
    ((E("div", class_is="inner"), E("div", child=True)), "text", ["b"]),
    ((E("div", class_token="y"), E("a", child=True)), "@href", ["/1?a=1&b=2"]),
    ((E("input", name="prix"),), "@value", [""]),
    ((E("input", name="none"),), "@value", []),
])
def test_selectors(evaluate, path, take, want):
    assert select(evaluate, DOC, *path, take=take) == want


def test_no_document_has_no_matches(evaluate):
    assert select(evaluate, None, E("div", class_is="x"), take="text") == []
    assert select(evaluate, "", E("a"), take="@href") == []


def test_very_long_tags_and_texts(evaluate):
    long = "<div " + "a" * 300_000 + ' class="x">' + "t<" * 100_000 + "</div>"
    assert select(evaluate, long, E("div", class_is="x"), take="text") == ["t<" * 100_000]
    assert select(evaluate, "<div " + "a" * 300_000, E("div", class_is="x"), take="text") == []


@pytest.mark.parametrize("depth", [1, 5, 6, 7, 30])
def test_nesting_beyond_the_pattern_is_counted(evaluate, depth):
    doc = ('<div class="x">' + "<div>" * depth + "core" + "</div>" * depth
           + '<a href="t">q</a></div><a href="out">o</a>')
    assert select(evaluate, doc, E("div", class_is="x"), E("a"), take="@href") == ["t"]


def test_unclosed_element_ends_with_the_document(evaluate):
    doc = '<div class="x">a<div>b</div><a href="1">l</a>'
    assert select(evaluate, doc, E("div", class_is="x"), E("a"), take="@href") == ["1"]


class Oracle(HTMLParser):
    """Own text nodes and links below elements of class x, by keeping the open elements."""

    def __init__(self):
        super().__init__()
        self.open, self.text, self.links = [], [], []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "br":
            return
        self.open.append((tag, attrs.get("class") == "x"))
        if tag == "a" and any(x for _, x in self.open):
            self.links.append(attrs["href"])

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1][1]:
            self.text.append(data)


def random_page(rng, depth=0):
    out = []
    for i in range(rng.randint(0, 4)):
        kind = rng.random()
        if kind < 0.3:
            out.append(rng.choice(["t", " u v ", "w>", "é"]))
        elif kind < 0.4:
            out.append("<br>")
        elif kind < 0.5:
            out.append(f'<a href="{depth}-{i}">l</a>')
        elif depth < 11:
            cls = rng.choice(["", ' class="x"', " class='y'", ' data-c="x" class="x"'])
            tag = rng.choice(["div", "div", "b", "span"])
            cls = cls if tag == "div" else ""
            out.append(f"<{tag}{cls}>{random_page(rng, depth + 1)}</{tag}>")
    return "".join(out)


def test_random_pages_agree_with_a_parser(evaluate):
    rng = random.Random(3)
    pages = [f"<div>{random_page(rng)}{random_page(rng)}</div>" for _ in range(400)]
    pages += ['<div class="x">' + random_page(rng, 3) + "</div>" for _ in range(200)]
    want = []
    for page in pages:
        parser = Oracle()
        parser.feed(page)
        parser.close()
        want.append((parser.text, parser.links))
    el = E("div", class_is="x")
    texts = evaluate(matches("s", (el,), "text"), pages)
    links = evaluate(matches("s", (el, E("a")), "@href"), pages)
    assert sum(bool(t) for t, _ in want) > 100
    assert texts == [t for t, _ in want]
    assert links == [l for _, l in want]


@pytest.mark.parametrize("doc, el, take, want", [
    ('<div class="u"><div class="u">1</div>2</div><div class="u">3</div>', E("div", class_is="u"), "outer",
     ['<div class="u"><div class="u">1</div>2</div>', '<div class="u">1</div>', '<div class="u">3</div>']),
    ('<div class="u">0<div><div class="u">1</div>2</div>', E("div", class_is="u"), "visible", ["0 1 2", "1"]),
    ("<strong>a<strong>b</strong>c</strong>d", E("strong"), "visible", ["abc", "b"]),
    ("<em>a<em>b</em>c</em>", E("em"), "outer", ["<em>a<em>b</em>c</em>", "<em>b</em>"]),
    ('<b class="u">x<i class="u">y<br>z</i></b>w', E("*", class_is="u"), "visible", ["xy z", "y z"]),
    ('<b class="u">x<b>' * 8 + "</b></b>" * 8, E("b", class_is="u"), "visible", ["x" * k for k in range(8, 0, -1)]),
])
def test_matches_inside_matches_are_found(evaluate, doc, el, take, want):
    assert select(evaluate, doc, el, take=take) == want


def test_children_of_matches_inside_matches_are_found(evaluate):
    doc = '<div class="u"><i>1</i><div class="u"><i>2</i></div></div>'
    assert select(evaluate, doc, E("div", class_is="u"), E("i", child=True), take="text") == ["1", "2"]
    assert select(evaluate, doc, E("div", class_is="u"), E("i"), take="text") == ["1", "2"]


@pytest.mark.parametrize("tag", ["em", "h2", "strong", "td", "div", "span", "li", "dd"])
def test_texts_of_matches_inside_matches_come_in_document_order(evaluate, tag):
    doc = f"<{tag}>x<{tag}>y</{tag}>z</{tag}>" if tag not in H.LEFT_OUT else {
        "td": "<table><tr><td>x<table><tr><td>y</td></tr></table>z</td></tr></table>",
        "li": "<ul><li>x<ul><li>y</li></ul>z</li></ul>",
        "dd": "<dl><dd>x<dl><dd>y</dd></dl>z</dd></dl>"}[tag]
    assert select(evaluate, doc, E(tag), take="text") == ["x", "y", "z"]


@pytest.mark.parametrize("doc, el, take, want", [
    ("<ul><li>a<li>b</ul>", E("li"), "outer", ["<li>a</li>", "<li>b</li>"]),
    ("<ul><li>a<li>b</ul>", E("li"), "visible", ["a", "b"]),
    ("<ul><li>a<li>b</ul>c", E("ul"), "outer", ["<ul><li>a<li>b</ul>"]),
    ("<ul><li>a<li>b", E("li"), "text", ["a", "b"]),
    ("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul>f", E("li"), "text", ["a", "b", "c", "d", "e"]),
    ("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul>f", E("li"), "visible", ["a b c d", "b", "c", "e"]),
    ("<ul><li>a<ul><li>b</li></li></ul>c</li></ul>", E("li"), "visible", ["a b c", "b"]),
    ("<ul><li class='k'>a<li>b<li class='k'>c</ul>", E("li", class_is="k"), "outer",
     ["<li class='k'>a</li>", "<li class='k'>c</li>"]),
    ("<dl><dt>a<dd>b<dd>c<dt>d<dd>e</dl>", E("dd"), "outer", ["<dd>b</dd>", "<dd>c</dd>", "<dd>e</dd>"]),
    ("<dl><dt>a<dd>b<dl><dt>i<dd>j</dl>c<dt>d</dl>", E("dt"), "visible", ["a", "i", "d"]),
    ("<table><tr><td>a<td>b<tr><th>c<td>d</table>e", E("tr"), "visible", ["a b", "c d"]),
    ("<table><tr><td>a<td>b<tr><th>c<td>d</table>e", E("td"), "outer", ["<td>a</td>", "<td>b</td>", "<td>d</td>"]),
    ("<table><thead><tr><th>h<tbody><tr><td>a</table>", E("tbody"), "visible", ["a"]),
    ("<table><tr><td>x<table><tr><td>y</table>z<td>w</table>", E("td"), "visible", ["x y z", "y", "w"]),
    ("<select><option value=1>a<option>b<optgroup><option>c</select>d", E("option"), "visible", ["a", "b", "c"]),
    ("<div><ul><li>a<b>c</div>d", E("li"), "visible", ["ac"]),
    ("<ul><li>a<span><div></span>b</div><li>c</ul>", E("li"), "visible", ["a b", "c"]),
    ("<ul><li>a<li>b</ul>", E("li", child=True), "text", []),
    ("<ul><LI>a<Li>b</UL>", E("li"), "visible", ["a", "b"]),
])
def test_ends_that_are_left_out(evaluate, doc, el, take, want):
    assert select(evaluate, doc, el, take=take) == want


def test_children_whose_end_is_left_out(evaluate):
    doc = '<ul class="u"><li>a<li>b<ul><li>c</ul><li>d</ul>'
    assert select(evaluate, doc, E("ul", class_is="u"), E("li", child=True), take="visible") == ["a", "b c", "d"]


class Closing(HTMLParser):
    """Items of lists by a stack of open tags, where </li> may be left out."""

    def __init__(self):
        super().__init__()
        self.open, self.items = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "li":
            self.end("li", ("ul",))
            self.items.append("")
            self.open.append((tag, len(self.items) - 1))
        else:
            self.open.append((tag, None))

    def handle_endtag(self, tag):
        self.end(tag, ("ul",) if tag == "li" else ())

    def end(self, tag, stops):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return
            if self.open[i][0] in stops:
                return

    def handle_data(self, data):
        for _, item in self.open:
            if item is not None:
                self.items[item] += data


def random_list(rng, depth=0):
    out = ["<ul>"]
    for _ in range(rng.randint(0, 4)):
        out.append("<li>" + rng.choice(["a", "b", "<div>c</div>", ""]))
        if depth < 4 and rng.random() < 0.4:
            out.append(random_list(rng, depth + 1) + rng.choice(["", "t"]))
        out.append(rng.choice(["", "</li>"]))
    return "".join(out) + "</ul>"


def test_random_lists_agree_with_a_parser(evaluate):
    rng = random.Random(7)
    pages = [f"<div>{random_list(rng)}x{random_list(rng)}</div>" for _ in range(300)]
    want = []
    for page in pages:
        parser = Closing()
        parser.feed(page)
        want.append(parser.items)
    got = evaluate(matches("s", (E("li"),), "visible"), pages)
    assert [["".join(t.split()) for t in page] for page in got] == want
    assert sum(map(len, want)) > 800


@pytest.mark.parametrize("word", ["card", "été€"])
def test_matches_are_whole_however_deep_and_whatever_the_value(evaluate, word):
    deep = f'<div class="{word}">{"<div>" * 9}ü{"</div>" * 9}</div>'
    docs = [deep, deep + deep, f'é<div class="{word}">a', f'<div title="{word}"></div>{deep}', f"{word} {deep} {word}", f"<div>{word}</div>",
            "<div>a</div>", "", None]
    found = evaluate(H.outer_html("s", E("div", class_is=word)), docs)
    assert found == [[deep], [deep, deep], [f'<div class="{word}">a</div>'], [deep], [deep], [], [], [], []]
    for field in (H.inner_html, H.text_nodes):
        assert evaluate(field("s", E("div", class_is=word, child=field is H.inner_html)), docs[-3:]) == [[], [], []]
