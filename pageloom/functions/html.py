"""HTML selection with native expressions.

Only the selector forms that listing pages need exist: an element by tag and attribute tests,
its attributes, its own text nodes, its visible text, its outer HTML, its direct children.

Every quantified group in the patterns is possessive: Java then matches it in a loop instead of by
recursion, so a page of any length neither overflows the stack nor backtracks.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pageloom.functions.expr import (NO_STRINGS, case, each, each_flat, fold, let, quote, struct,
                                     those)
from pageloom.functions.text import collapse_blank, decode_entities

# Elements that never have content, so they open no level.
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "source", "track", "wbr")

# Tags that end an open paragraph even without a closing </p>.
ENDS_PARAGRAPH = ("p", "div", "ul", "ol", "li", "h[1-6]", "table", "article", "section", "footer",
                  "header", "nav", "form", "body", "html")

# Tags that part words; all others are inline.
PARTS_WORDS = ENDS_PARAGRAPH + ("br", "hr", "dl", "dt", "dd", "tr", "td", "th", "main", "aside",
                                "button", "option")

# Elements that never hold one of their own kind; they end at the first closing tag.
# The end of all others is found by counting.
FLAT_TAGS = ("p", "a", "button", "form", "select", "script", "style", "textarea", "title")

# Tags whose end may be left out, and what an opening tag of theirs ends: the first open one of
# ``ends`` after the last of ``within``, and all that is open above it.
LEFT_OUT = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "table", "dl")),
    "dt": (("dt", "dd"), ("dl", "table", "ul", "ol")),
    "dd": (("dt", "dd"), ("dl", "table", "ul", "ol")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr", "td", "th"), ("thead", "tbody", "tfoot", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("optgroup", "select", "datalist")),
    "optgroup": (("optgroup", "option"), ("select",)),
}

# Tags whose closing tag ends nothing but themselves.
INLINE = ("a", "abbr", "b", "big", "cite", "code", "em", "font", "i", "label", "q", "s", "small", "span", "strong",
          "sub", "sup", "tt", "u")

# How deep an element may hold its own kind before levels are counted one by one.
NESTED = 6

# Outside quotes a tag holds no '<', so that text full of stray '<' is scanned only once.
_NAME = r"[a-zA-Z][^\s<>/]*+"
_REST_OF_TAG = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
_TAG = rf"</?{_NAME}{_REST_OF_TAG}"
_COMMENT = r"<!--(?s:.*?)(?:-->|\z)"
_TEXT = rf"(?:[^<]++|<(?!{_COMMENT[1:]}|{_TAG[1:]}))++"


class Test(NamedTuple):
    """A condition on one attribute: ``is`` the value, has the ``token``, has the ``prefix``."""
    attribute: str
    kind: str
    value: str


class Element(NamedTuple):
    tag: str
    tests: tuple[Test, ...] = ()
    child: bool = False          # only direct children of the enclosing element


def element(tag: str, class_is: str | None = None, class_token: str | None = None,
            id_prefix: str | None = None, child: bool = False, **equal: str) -> Element:
    """``element('a', class_is='x')``, ``element('input', name='prix')`` and the like."""
    tests = [Test(name, "is", value) for name, value in equal.items()]
    if class_is is not None:
        tests.append(Test("class", "is", class_is))
    if class_token is not None:
        tests.append(Test("class", "token", class_token))
    if id_prefix is not None:
        tests.append(Test("id", "prefix", id_prefix))
    return Element(tag, tuple(tests), child)


# ---- patterns ----------------------------------------------------------------------------------

def _literal(value: str) -> str:
    return r"\Q" + value + r"\E"


def _up_to_attribute(name: str) -> str:
    """Consume a tag from its name up to and including ``name=``."""
    here = rf"{re.escape(name)}\s*="
    return rf"""(?:[^\s"'<>]++|"[^"]*+"|'[^']*+'|\s++(?!(?i:{here})))*+\s++(?i:{here})\s*"""


def _value(test: Test) -> str:
    v = _literal(test.value)
    if test.kind == "is":
        bare = "" if re.search(r"\s", test.value) or not test.value else rf"|{v}(?=[\s>])"
        return rf"""(?:"{v}"|'{v}'{bare})"""
    if test.kind == "token":
        return (rf"""(?:"(?:[^"]*\s)?{v}(?:\s[^"]*)?"|'(?:[^']*\s)?{v}(?:\s[^']*)?'"""
                rf"""|{v}(?=[\s>]))""")
    if test.kind == "prefix":
        return rf"""(?:"{v}[^"]*"|'{v}[^']*'|{v}[^\s"'>]*)"""
    raise ValueError(f"unknown attribute test {test.kind!r}")


def _open(el: Element) -> str:
    """Pattern of the opening tag; no capturing group."""
    name = _NAME if el.tag == "*" else rf"(?i:{el.tag})(?=[\s/>])"
    looks = "".join(f"(?={_up_to_attribute(t.attribute)}{_value(t)})" for t in el.tests)
    return f"<{name}{looks}{_REST_OF_TAG}"


def _end(tag: str) -> str:
    if tag == "p":
        others = "|".join(ENDS_PARAGRAPH)
        return rf"(?:</(?i:p)\s*>|(?=</?(?i:{others})[\s/>])|\z)"
    return rf"(?:</(?i:{tag})\s*>|\z)"


# ---- documents ---------------------------------------------------------------------------------

def readable(html: str) -> str:
    """The document without scripts, styles and comment bodies; '' for no document.

    An empty comment stays behind, because a comment separates two text nodes.
    """
    # All alternatives share their first character, so most of the text is skipped quickly.
    hidden = (r"<(?:!--(?s:.*?)(?:-->|\z)"
              r"|(?i:script|style)(?=[\s/>])(?s:.*?)(?:</(?i:script|style)\s*>|\z))")
    return f"regexp_replace(coalesce({html}, ''), {quote(hidden)}, '<!---->')"


# ---- ends that are left out --------------------------------------------------------------------

def _names(tags) -> str:
    return "|".join(tags)


def _open_after(open_: str, tags) -> str:
    """What is open above the last of the tags; all that is open if none of them is."""
    return f"regexp_replace({open_}, {quote(rf'^.*/(?:{_names(tags)});')}, '')"


def _ended(above: str) -> str:
    """The closing tags left out for the open tags ``above``, the last one first."""
    names = f"reverse(filter(split({above}, ';'), e -> substr(e, 2) IN ({', '.join(map(quote, LEFT_OUT))})))"
    return f"array_join(transform({names}, e -> concat('<', e, '>')), '')"


def all_ended(html: str) -> str:
    """The document with all ends written out that ``LEFT_OUT`` lets it leave out, and without closing tags
    of these names that end nothing.

    One walk over the tags. The state is the open tags as a string, '/ul;/li;', and the few places where
    something changes: the number of a piece, what comes before it, and whether its tag goes.
    """
    changes = "cast(array() AS array<struct<at: int, ends: string, gone: boolean>>)"

    def step(acc: str, p: str) -> str:
        def opened(name: str) -> str:
            entry = f"concat('/', {name}, ';')"

            def after(cut: str) -> str:
                """``cut`` is what the new tag ends."""
                left = f"left({acc}.open, length({acc}.open) - length({cut}))"
                return struct(open=f"concat({left}, {entry})", ends=_ended(cut), gone="false")

            by_name = [(f"{name} IN ({', '.join(quote(t) for t, rule in LEFT_OUT.items() if rule == of)})",
                        f"regexp_extract({_open_after(f'{acc}.open', of[1])}, {quote(rf'/(?:{_names(of[0])});.*$')}, 0)")
                       for of in dict.fromkeys(LEFT_OUT.values())]
            return case((_is_void(p), struct(open=f"{acc}.open", ends="''", gone="false")),
                        otherwise=let(case(*by_name, otherwise="''"), after))

        def closed(name: str) -> str:
            entry = f"concat('/', {name}, ';')"
            within = [(f"{name} IN ({', '.join(quote(t) for t, rule in LEFT_OUT.items() if rule[1] == bounds)})",
                       _open_after(f"{acc}.open", bounds)) for bounds in dict.fromkeys(r[1] for r in LEFT_OUT.values())]

            def in_scope(scope: str) -> str:
                above = f"substring_index({scope}, {entry}, -1)"
                left = f"left({acc}.open, length({acc}.open) - length({above}) - length({entry}))"
                whole = struct(open=left, ends=_ended(above), gone="false")
                alone = struct(open=f"concat({left}, {above})", ends="''", gone="false")
                none = struct(open=f"{acc}.open", ends="''", gone=f"{name} IN ({', '.join(map(quote, LEFT_OUT))})")
                return case((f"NOT contains({scope}, {entry})", none),
                            (f"{name} IN ({', '.join(map(quote, INLINE))})", alone), otherwise=whole)

            return let(case(*within, otherwise=f"{acc}.open"), in_scope)

        now = let(_tag_name(p), lambda name: case(
            (f"startswith({p}, '</')", closed(name)), otherwise=opened(name)))

        def moved(n: str) -> str:
            entry = struct(at=f"{acc}.at", ends=f"{n}.ends", gone=f"{n}.gone")
            return struct(at=f"{acc}.at + 1", open=f"{n}.open", changes=case(
                (f"{n}.ends <> '' OR {n}.gone", f"array_append({acc}.changes, {entry})"), otherwise=f"{acc}.changes"))

        same = struct(at=f"{acc}.at + 1", open=f"{acc}.open", changes=f"{acc}.changes")
        return case((f"NOT {p} RLIKE '^</?[a-zA-Z]'", same), otherwise=let(now, moved))

    def written(ps: str) -> str:
        def finish(acc: str) -> str:
            def piece(p: str, i: str, change: str) -> str:
                rest = case((f"{change}.gone", f"regexp_replace({p}, {quote(f'^</{_REST_OF_TAG}')}, '')"), otherwise=p)
                return case((f"{change} IS NULL", p), otherwise=f"concat({change}.ends, {rest})")

            marked = (f"transform({ps}, (p, i) -> " + let(
                f"try_element_at(filter({acc}.changes, c -> c.at = i), 1)", lambda c: piece("p", "i", c)) + ")")
            return f"concat(array_join({marked}, ''), {_ended(f'{acc}.open')})"

        return fold(ps, struct(at="0", open="''", changes=changes), step, finish)

    return let(f"split({html}, {quote('(?=</?[a-zA-Z])')})", written)


def _with_ends(html: str, el: Element) -> str:
    """The document; with the ends left out written out if the element's kind is one that leaves them out,
    and this document does."""
    if el.tag not in LEFT_OUT:
        return html
    ends, within = LEFT_OUT[el.tag]
    one = rf"(?i:{el.tag})(?=[\s/>])"
    # Well closed: as many closing as opening tags, and no opening tag right after another one.
    closed_by = rf"<(?:(?i:{_names(ends)})(?=[\s/>])|/(?i:{_names(within)})(?=[\s>]))"
    other = rf"[^<]++|<(?!/?(?i:{_names(dict.fromkeys((*ends, *within)))})(?=[\s/>]))"
    unclosed = rf"<{one}{_REST_OF_TAG}(?:{other})*+{closed_by}"
    opening, closing, plain = quote(f"<{one}"), quote(f"</{one}"), f"</{el.tag}>"

    def checked(h: str, n: str) -> str:
        # Counted as a plain text first: that is cheaper than a pattern.
        written = f"(length({h}) - length(replace({h}, {quote(plain)}, ''))) div {len(plain)}"
        return case((f"{n} = 0", h), (f"({n} = {written} OR {n} = regexp_count({h}, {closing})) AND NOT {h} RLIKE {quote(unclosed)}", h),
                    otherwise=all_ended(h))

    return let(html, lambda h: let(f"regexp_count({h}, {opening})", lambda n: checked(h, n)))


# ---- elements ----------------------------------------------------------------------------------

def _all(html: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({html}, {quote(pattern)}, {group})"


def _if_present(html: str, el: Element, search, otherwise: str = NO_STRINGS) -> str:
    """Search only documents that hold the tested values at all; a plain substring test is far
    cheaper than a pattern."""
    values = [t.value for t in el.tests if t.value]
    if not values:
        return search(html)
    return let(html, lambda h: case(
        (" AND ".join(f"contains({h}, {quote(v)})" for v in values), search(h)),
        otherwise=otherwise))


def _with_ends_if_present(html: str, el: Element) -> str:
    """``_with_ends`` for a document that holds the tested values; other kinds are looked for when they are searched."""
    return _if_present(html, el, lambda h: _with_ends(h, el), "''") if el.tag in LEFT_OUT else html


def opening_tags(html: str, el: Element) -> str:
    """Every matching opening tag, in document order."""
    return _if_present(html, el, lambda h: _all(h, _open(el)))


def _tag_name(piece: str) -> str:
    return f"lower(regexp_extract({piece}, {quote(f'^</?({_NAME})')}, 1))"


def _without_first_tag(outer: str) -> str:
    return f"regexp_replace({outer}, {quote(f'^<{_REST_OF_TAG}')}, '')"


def first_tag(outer: str) -> str:
    return f"regexp_extract({outer}, {quote(f'^<{_REST_OF_TAG}')}, 0)"


_VOID = rf"^<(?i:{'|'.join(VOID_TAGS)})(?=[\s/>])"

# What a piece of HTML does to the level of nesting.
_OTHER, _OPENS, _CLOSES, _STARTS = "0", "1", "2", "3"


def _spans(marks: str) -> str:
    """Spans ``[first, last)`` of piece numbers from a starting tag to the tag that closes it.

    One pass with a level counter. Only whole spans are appended to the state, so the state stays
    as small as the result. An element that is never closed ends with the document. Marks are
    structs of a kind and a tag name; only tags of the starting tag's name are counted.
    """
    def step(acc: str, mark: str) -> str:
        outside, same = f"{acc}.level = 0", f"{mark}.tag = {acc}.tag"
        begins = f"({outside} AND {mark}.kind = {_STARTS})"
        level = case((begins, "1"), (outside, "0"),
                     (f"NOT {same} OR {mark}.kind = {_OTHER}", f"{acc}.level"),
                     (f"{mark}.kind = {_CLOSES}", f"{acc}.level - 1"),
                     otherwise=f"{acc}.level + 1")
        done = f"{acc}.level = 1 AND {same} AND {mark}.kind = {_CLOSES}"
        span = struct(first=f"{acc}.first", last=f"{acc}.at + 1")
        return struct(
            level=level, at=f"{acc}.at + 1",
            first=case((begins, f"{acc}.at + 1"), otherwise=f"{acc}.first"),
            tag=case((begins, f"{mark}.tag"), otherwise=f"{acc}.tag"),
            spans=case((done, f"array_append({acc}.spans, {span})"), otherwise=f"{acc}.spans"))

    def finish(acc: str) -> str:
        to_end = struct(first=f"{acc}.first", last=f"{acc}.at + 1")
        return case((f"{acc}.level > 0", f"array_append({acc}.spans, {to_end})"),
                    otherwise=f"{acc}.spans")

    zero = struct(level="0", at="0", first="0", tag="''",
                  spans="cast(array() AS array<struct<first: int, last: int>>)")
    return fold(marks, zero, step, finish)


def _cut(pieces: str, mark, spans=_spans) -> str:
    """Outer HTML, without the closing tag, of every span that ``mark`` finds in the pieces."""
    return let(pieces, lambda ps: each(
        spans(each(ps, mark)),
        lambda s: f"array_join(slice({ps}, {s}.first, {s}.last - {s}.first), '')"))


def _balanced(el: Element) -> str:
    """Pattern of an element up to its closing tag, same-named elements inside it up to NESTED
    levels deep. No match for anything deeper or unclosed."""
    any_tag = el.tag == "*"
    name = (r"\1" if any_tag else rf"(?i:{el.tag})") + r"(?=[\s/>])"
    opening = _open(el).replace(f"<{_NAME}", f"<({_NAME})", 1) if any_tag else _open(el)
    other = rf"[^<]++|<(?!/?{name})"
    body = f"(?:{other})*+"
    for _ in range(NESTED):
        body = rf"(?:{other}|<{name}{_REST_OF_TAG}{body}</{name}[^>]*+>)*+"
    return f"{opening}{body}(?=</{name})"


def _counted(html: str, el: Element) -> str:
    """Outer HTML, without the closing tag, of every outermost matching element.

    One pattern finds them if they nest no deeper than NESTED levels and are closed. That is so
    when its matches hold every matching opening tag; otherwise levels are counted tag by tag.
    Either way only tags of the element's own name count, so unclosed <p>, <b> or <li> inside it
    do no harm.
    """
    any_tag = el.tag == "*"
    name = r"[a-zA-Z]" if any_tag else rf"(?i:{el.tag})(?=[\s/>])"
    opening = _open(el)

    def mark(p: str) -> str:
        kind = case((f"startswith({p}, '</')", _CLOSES), (f"NOT startswith({p}, '<')", _OTHER),
                    (f"{p} RLIKE {quote('^' + opening)}", _STARTS), otherwise=_OPENS)
        return struct(kind=kind, tag=_tag_name(p) if any_tag else "''")

    def removed(h: str) -> str:
        """How many bytes the first tested value takes up."""
        return f"(octet_length({h}) - octet_length(replace({h}, {quote(el.tests[0].value)}, '')))"

    def search(h: str, n: str = "") -> str:
        by_count = _cut(f"split({h}, {quote(f'(?=</?{name})')})", mark)

        def checked(f: str) -> str:
            inside = f"array_join({f}, '')"
            tags = (f"regexp_count({inside}, {quote(opening)}) = "
                    f"regexp_count({h}, {quote(opening)})")
            if el.tests and el.tests[0].value:
                # Cheaper, and enough: the tested value occurs nowhere else.
                tags = f"{removed(inside)} = {n or removed(h)} OR {tags}"
            return case((tags, f), otherwise=by_count)

        return let(_all(h, _balanced(el)), checked)

    if len(el.tests) == 1 and el.tests[0].value:
        # As ``_if_present``; the bytes are counted anyway.
        return let(html, lambda h: let(removed(h), lambda n: case((f"{n} > 0", search(h, n)), otherwise=NO_STRINGS)))
    return _if_present(html, el, lambda h: search(h) if el.tests else let(h, search))


def _every_span(marks: str) -> str:
    """Spans as of ``_spans``, but of every starting tag, by its place, also inside another span.

    The state holds the open tags; a closing tag closes the last one of its name. What is never
    closed ends with the document.
    """
    spans = "cast(array() AS array<struct<first: int, last: int>>)"
    opened = "cast(array() AS array<struct<first: int, tag: string>>)"

    def step(acc: str, mark: str) -> str:
        at = f"{acc}.at + 1"
        starts = f"{mark}.kind IN ({_STARTS}, {_OPENS})"
        # The open tag's number from the end; what lies above it stays open.
        back = f"array_position(reverse(transform({acc}.open, o -> o.tag)), {mark}.tag)"
        place = f"cast(size({acc}.open) - {back} + 1 AS int)"
        closes = f"({mark}.kind = {_CLOSES} AND {back} > 0)"
        entry = struct(first=case((f"{mark}.kind = {_STARTS}", at), otherwise="0"), tag=f"{mark}.tag")
        rest = (f"concat(slice({acc}.open, 1, {place} - 1), "
                f"slice({acc}.open, {place} + 1, size({acc}.open)))")
        first = f"element_at({acc}.open, {place}).first"
        span = struct(first=first, last=at)
        return struct(
            at=at,
            open=case((starts, f"array_append({acc}.open, {entry})"), (closes, rest), otherwise=f"{acc}.open"),
            spans=case((closes, case((f"{first} > 0", f"array_append({acc}.spans, {span})"),
                                     otherwise=f"{acc}.spans")), otherwise=f"{acc}.spans"))

    def finish(acc: str) -> str:
        left = f"transform(filter({acc}.open, o -> o.first > 0), o -> {struct(first='o.first', last=f'{acc}.at + 1')})"
        return f"array_sort(concat({acc}.spans, {left}))"

    return fold(marks, struct(at="0", open=opened, spans=spans), step, finish)


def _every(html: str, el: Element) -> str:
    """Outer HTML, without the closing tag, of every matching element, in document order."""
    any_tag = el.tag == "*"
    name = r"[a-zA-Z]" if any_tag else rf"(?i:{el.tag})(?=[\s/>])"
    opening = _open(el)

    def mark(p: str) -> str:
        kind = case((f"startswith({p}, '</')", _CLOSES), (f"NOT startswith({p}, '<')", _OTHER),
                    (f"{p} RLIKE {quote('^' + opening)}", _STARTS), otherwise=_OPENS)
        if any_tag:
            kind = case((f"{p} RLIKE {quote(_VOID)} AND NOT {p} RLIKE {quote('^' + opening)}", _OTHER), otherwise=kind)
        return struct(kind=kind, tag=_tag_name(p) if any_tag else "''")

    def inside(o: str) -> str:
        return case((f"substr({o}, 2) RLIKE {quote(opening)}",
                     _cut(f"split({o}, {quote(f'(?=</?{name})')})", mark, _every_span)), otherwise=f"array({o})")

    return each_flat(_counted(html, el), inside)


def _is_tag(piece: str) -> str:
    """For a part as ``_parts`` cuts them: only tags begin and end like one."""
    return f"({piece} RLIKE '^</?[a-zA-Z]' AND endswith({piece}, '>'))"


def _is_void(piece: str) -> str:
    return f"({piece} RLIKE {quote(_VOID)} OR endswith({piece}, '/>'))"


def _parts(inner: str) -> str:
    """Tags, comments and text runs, in order, nothing lost."""
    return _all(inner, f"{_COMMENT}|{_TAG}|{_TEXT}")


def _level(acc: str, p: str) -> str:
    """Nesting after a part."""
    return case((f"NOT {_is_tag(p)}", f"{acc}.level"),
                (f"startswith({p}, '</')", f"greatest({acc}.level - 1, 0)"),
                (_is_void(p), f"{acc}.level"), otherwise=f"{acc}.level + 1")


def _at_top(parts: str, test) -> str:
    """Parts outside any child element that pass the test."""
    def step(acc: str, p: str) -> str:
        return struct(level=_level(acc, p), found=case(
            (f"{acc}.level = 0 AND {test(p)}", f"array_append({acc}.found, {p})"),
            otherwise=f"{acc}.found"))

    return fold(parts, struct(level="0", found=NO_STRINGS), step, lambda acc: f"{acc}.found")


def children(inner: str, el: Element) -> str:
    """Outer HTML, without the closing tag, of the direct children that match.

    Children without content (``img`` and the like) come as their tag.
    """
    wanted = quote("^" + _open(el))

    def mark(p: str) -> str:
        # Any child starts a span, whether it matches or not: what is inside it is no child.
        kind = case((f"startswith({p}, '</')", _CLOSES), (f"NOT {_is_tag(p)}", _OTHER),
                    (_is_void(p), _OTHER), otherwise=_STARTS)
        return struct(kind=kind, tag="''")

    def found(i: str) -> str:
        if el.tag in VOID_TAGS:
            return _at_top(_parts(i), lambda p: f"{p} RLIKE {wanted}")
        return those(_cut(_parts(i), mark), lambda outer: f"{outer} RLIKE {wanted}")

    return _if_present(inner, el, lambda i: let(i, lambda i: case(
        (f"{i} RLIKE {quote(_open(el))}", found(i)), otherwise=NO_STRINGS)))


def _flat(el: Element) -> bool:
    return not el.child and el.tag in FLAT_TAGS


def outer_html(html: str, el: Element, nested: bool = True) -> str:
    """The element itself, tags included, for every match in document order; with ``nested`` false
    only for matches outside other ones."""
    if el.tag in VOID_TAGS:
        return children(html, el) if el.child else opening_tags(html, el)
    if _flat(el):
        return _if_present(html, el, lambda h: _all(h, f"{_open(el)}(?s:.*?){_end(el.tag)}"))
    html = _with_ends_if_present(html, el)
    found = children(html, el) if el.child else (_every if nested else _counted)(html, el)
    return each(found, lambda o: f"concat({o}, '</', {_tag_name(o)}, '>')")


def inner_html(html: str, el: Element, nested: bool = True) -> str:
    """What lies between the tags of every match, or of matches outside other ones."""
    if el.tag in VOID_TAGS:
        return each(outer_html(html, el), lambda _: "''")
    if _flat(el):
        return _if_present(html, el, lambda h: _all(h, f"{_open(el)}((?s:.*?)){_end(el.tag)}", 1))
    html = _with_ends_if_present(html, el)
    found = children(html, el) if el.child else (_every if nested else _counted)(html, el)
    return each(found, _without_first_tag)


# ---- values ------------------------------------------------------------------------------------

def attribute_values(fragment: str, name: str) -> str:
    """The attribute's value on every tag of the fragment that carries it."""
    pattern = rf"""<{_NAME}{_up_to_attribute(name)}("[^"]*"|'[^']*'|[^\s"'>]+)"""
    quoted = quote(r"""(?s)^(["'])(.*)\1$""")
    return each(_all(fragment, pattern, 1),
                lambda raw: decode_entities(f"regexp_replace({raw}, {quoted}, '$2')"))


def _texts(inner: str, from_parts) -> str:
    """Text nodes of a stretch of HTML, the simple cases without taking it apart."""
    return let(inner, lambda i: each(
        case((f"{i} = ''", NO_STRINGS), (f"NOT contains({i}, '<')", f"array({i})"),
             otherwise=from_parts(i)), decode_entities))


def own_text(inner: str) -> str:
    """The direct text nodes, blank ones included; text inside child elements is not part of it."""
    return _texts(inner, lambda i: _at_top(
        _parts(i), lambda p: f"NOT startswith({p}, '<!--') AND NOT {_is_tag(p)}"))


def nested_text(outer: str, el: Element) -> str:
    """Own text nodes of the element and of matching elements inside it, in document order.

    The state carries the open tags as one string, '/ul;/li;!', matching ones marked by '!'.
    """
    wanted = quote("^" + _open(el))

    def step(acc: str, p: str) -> str:
        def opened(name: str) -> str:
            # A new <li> or <p> ends an open one that it directly follows.
            entry = f"concat('/', {name}, ';')"
            base = case(
                (f"{name} IN ('li', 'p', 'option', 'dt', 'dd', 'tr', 'td', 'th') AND "
                 f"substring_index({acc}.open, {entry}, -1) IN ('', '!')",
                 closed(name)), otherwise=f"{acc}.open")
            mark = case((f"{p} RLIKE {wanted}", "'!'"), otherwise="''")
            return f"concat({base}, {entry}, {mark})"

        def closed(name: str) -> str:
            entry = f"concat('/', {name}, ';')"
            above = f"substring_index({acc}.open, {entry}, -1)"
            return case((f"{above} = {acc}.open", f"{acc}.open"),
                        otherwise=f"left({acc}.open, length({acc}.open) - length({above})"
                                  f" - length({name}) - 2)")

        now = case((f"NOT {_is_tag(p)}", f"{acc}.open"),
                   (f"startswith({p}, '</')", let(_tag_name(p), closed)),
                   (_is_void(p), f"{acc}.open"), otherwise=let(_tag_name(p), opened))
        text = f"endswith({acc}.open, '!') AND NOT startswith({p}, '<!--') AND NOT {_is_tag(p)}"
        return struct(open=now, texts=case((text, f"array_append({acc}.texts, {p})"),
                                           otherwise=f"{acc}.texts"))

    def walk(_: str) -> str:
        return fold(_parts(outer), struct(open="''", texts=NO_STRINGS), step,
                    lambda acc: f"{acc}.texts")

    return _texts(_without_first_tag(outer), walk)


def text_nodes(html: str, el: Element) -> str:
    """Own text nodes of every match, in document order."""
    if el.child or el.tag in FLAT_TAGS or el.tag in VOID_TAGS:
        return each_flat(inner_html(html, el), own_text)
    html = _with_ends_if_present(html, el)
    return each_flat(_counted(html, el), lambda o: case(
        (f"substr({o}, 2) RLIKE {quote(_open(el))}", nested_text(o, el)), otherwise=own_text(_without_first_tag(o))))


def visible_text(inner: str) -> str:
    """All text below the element, markup removed, as a reader sees it."""
    parting = quote(rf"</?(?i:{'|'.join(PARTS_WORDS)})(?=[\s/>]){_REST_OF_TAG}")
    markup = quote(f"{_COMMENT}|{_TAG}")
    return let(inner, lambda i: collapse_blank(decode_entities(case(
        (f"contains({i}, '<')",
         f"regexp_replace(regexp_replace({i}, {parting}, ' '), {markup}, '')"), otherwise=i))))
