"""Field specs and their compilation to expressions.

A field says where a value sits (``path``), what to take there and which of the matches to keep.
Fields that share a path and a take share one array column, so each selector runs once per page.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from pageloom.functions import html as H
from pageloom.functions import text as X
from pageloom.functions.expr import each, each_flat, let, quote, struct

Rule = Callable[[str], str]


class Field(NamedTuple):
    """One extracted column.

    take: ``text`` own text nodes, ``visible`` rendered text, ``outer`` outer HTML,
          ``@name`` attribute of the element itself, ``//@name`` of it and everything below,
          or a function of the document.
    pick: ``first``, ``all``, ``join``, a number (1-based, negative from the end), or a function
          of the array expression.
    post: applied to the picked value.  required: NULL after picking fails the page.
    """
    name: str
    path: tuple[H.Element, ...]
    take: str | Rule
    pick: str | int | Rule = "first"
    post: Rule | None = None
    required: bool = False
    rendered: bool = False


def _take(fragment: str, target: H.Element, take: str) -> str:
    """All values at the target inside one stretch of HTML."""
    if take == "outer":
        return H.outer_html(fragment, target)
    if take == "text":
        return H.text_nodes(fragment, target)
    if take == "visible":
        return each(H.inner_html(fragment, target), H.visible_text)
    if take.startswith("//@"):
        return each_flat(H.outer_html(fragment, target, nested=False),
                         lambda o: H.attribute_values(o, take[3:]))
    if take.startswith("@"):
        if target.child:
            tags = each(H.outer_html(fragment, target), H.first_tag)
        else:
            tags = H.opening_tags(fragment, target)
        return each_flat(tags, lambda t: H.attribute_values(t, take[1:]))
    raise ValueError(f"unknown take {take!r}")


def matches(document: str, path: Sequence[H.Element], take: str | Rule) -> str:
    """All values, in document order: narrow to each outer step, then take at the last."""
    if callable(take):
        return take(document)
    if len(path) == 1:
        return _take(document, path[0], take)
    return _below(_outer_step(document, path), path, take)


def _outer_step(document: str, path: Sequence[H.Element]) -> str:
    """What the first of several steps narrows to."""
    # What lies below a match inside a match lies below the outer one; only children need both.
    return H.inner_html(document, path[0], nested=path[1].child)


def _below(areas: str, path: Sequence[H.Element], take: str) -> str:
    return each_flat(areas, lambda area: matches(area, path[1:], take))


def _step_of(f: Field) -> tuple | None:
    """What fields have in common that narrow to the same areas first."""
    if callable(f.take) or len(f.path) == 1:
        return None
    return f.rendered, f.path[0], f.path[1].child


def pick(values: str, which: str | int | Rule) -> str:
    """First, n-th, joined or all of the matches; NULL where there is no such match."""
    if callable(which):
        return which(values)
    if which == "all":
        return values
    if which == "join":
        return X.join_all(values)
    return f"try_element_at({values}, {1 if which == 'first' else which})"


def value(f: Field, values: str) -> str:
    picked = pick(values, f.pick)
    return f.post(picked) if f.post else picked


def picked_struct(document: str, fields: dict[str, Field]) -> str:
    """The fields of one stretch of HTML as a struct; areas that several of them lie in are found once."""
    steps: dict[tuple, Field] = {}
    for f in fields.values():
        if _step_of(f):
            steps.setdefault(_step_of(f), f)

    def with_areas(left: list[tuple], areas: dict[tuple, str]) -> str:
        if left:
            first = left[0]
            return let(_outer_step(document, steps[first].path),
                       lambda found: with_areas(left[1:], {**areas, first: found}))
        return struct(**{name: value(f, _below(areas[_step_of(f)], f.path, f.take) if _step_of(f)
                                     else matches(document, f.path, f.take)) for name, f in fields.items()})

    return with_areas(list(steps), {})


def computed_once(df: DataFrame, keep: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """``keep`` and the computed columns, each evaluated once per row.

    A filter on a computed column is normally moved below the projection together with a copy of
    the expression, and an extraction would then run twice. A generator of one row stops that;
    filters on ``keep`` still reach the scan.
    """
    pairs = ", ".join(f"'{name}', {expr}" for name, expr in columns.items())
    return df.selectExpr(*keep, f"inline(array(named_struct({pairs})))")


def extract_fields(df: DataFrame, fields: Sequence[Field], html: str = "html",
                   rendered: str = "rendered_html", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, one column per field, and ``missing_fields``: required fields not found.

    The page body is dropped here, before anything could shuffle it.
    """
    keep = list(keep)
    body = [f"{H.readable(html)} AS _body"]
    if any(f.rendered for f in fields):
        seen = f"coalesce({rendered}, {html})" if rendered in df.columns else html
        body.append(f"{H.readable(seen)} AS _rendered")

    shared: dict[tuple, str] = {}
    for f in fields:
        shared.setdefault((f.rendered, f.path, f.take), f"_m{len(shared)}")
    # Areas that several columns are taken from are found once.
    steps = Counter(_step_of(Field("", path, take, rendered=seen)) for seen, path, take in shared)
    areas = {step: f"_a{k}" for k, step in enumerate(s for s, n in steps.items() if s and n > 1)}

    def document(seen: bool) -> str:
        return "_rendered" if seen else "_body"

    found, narrowed = {}, {}
    for (seen, path, take), name in shared.items():
        step = _step_of(Field("", path, take, rendered=seen))
        if step in areas:
            narrowed[areas[step]] = _outer_step(document(seen), path)
            found[name] = _below(areas[step], path, take)
        else:
            found[name] = matches(document(seen), path, take)

    def source(f: Field) -> str:
        return shared[(f.rendered, f.path, f.take)]

    checks = [f"CASE WHEN {pick(source(f), f.pick)} IS NULL THEN {quote(f.name)} END"
              for f in fields if f.required]
    missing = f"cast(array_compact(array({', '.join(checks)})) AS array<string>)"
    df = df.selectExpr(*keep, *body)
    if narrowed:
        df = computed_once(df, df.columns, narrowed)
    return (computed_once(df, keep, found)
            .selectExpr(*keep, *[f"{value(f, source(f))} AS {f.name}" for f in fields],
                        f"{missing} AS missing_fields"))
