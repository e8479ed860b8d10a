"""Parts of a page that belong together although no element around them is known."""

from __future__ import annotations

from collections.abc import Sequence

from pageloom.functions.expr import NO_STRINGS, case, fold, let, quote, struct
from pageloom.functions.html import INLINE, LEFT_OUT, VOID_TAGS, Element, _is_void, _names, _open, _tag_name, all_ended

_INTS = "cast(array() AS array<int>)"


def _ended(html: str) -> str:
    """The document, ends that it leaves out written out."""
    names = f"(?i:{_names(LEFT_OUT)})"
    opening, closing = (quote(rf"{sign}{names}(?=[\s/>])") for sign in ("<", "</"))
    return let(html, lambda h: case((f"regexp_count({h}, {opening}) = regexp_count({h}, {closing})", h), otherwise=all_ended(h)))


def areas(html: str, driver: Element, leading: Sequence[Element] = (), others: Sequence[Element] = ()) -> str:
    """The HTML of one card for each match of ``driver``, in document order.

    A card begins with the child of the lowest common ancestor of its match and the one before (for the first
    card, the one after) that holds its match, and ends where the next one begins; the last one ends
    with that ancestor's child list. A single match has the whole document. Where the matches themselves are
    siblings, cards end with their match instead if a ``leading`` element or one of ``others`` comes before the first
    of them, or if there are ``leading`` elements, which are known to come first in a card, and none behind the last
    match.

    One walk over the tags. The state holds the open elements by number of their piece, for each match the
    numbers of all elements around it, where matches and the elements around the last one end, the first
    element that may lead, and the last one that is known to.
    """
    def one_of(p: str, elements: Sequence[Element]) -> str:
        """Is the piece the opening tag of one of the elements? A plain substring test spares most pieces the pattern."""
        return "(" + (" OR ".join("(" + " AND ".join([
            *[f"contains({p}, {quote(t.value)})" for t in e.tests if t.value], f"{p} RLIKE {quote('^' + _open(e))}"]) + ")"
            for e in elements) or "false") + ")"

    def step(acc: str, p: str) -> str:
        at = f"{acc}.at"

        def state(open_=f"{acc}.open", found=f"{acc}.found", ends=f"{acc}.ends", lead=f"{acc}.lead",
                  known=f"{acc}.known") -> str:
            return struct(at=f"{at} + 1", open=open_, found=found, ends=ends, lead=lead, known=known)

        def opened(name: str) -> str:
            # The name alone tells almost always; only then the pattern is asked.
            void = case((f"{name} IN ({', '.join(map(quote, VOID_TAGS))})", _is_void(p)), otherwise=f"endswith({p}, '/>')")

            def with_facts(facts: str) -> str:
                mark, void = f"{facts}.mark", f"{facts}.void"
                entry = struct(at=at, tag=name, mark=mark)
                path = f"array_append(transform({acc}.open, o -> o.at), {at})"
                void_end = f"array_append({acc}.ends, {struct(at=at, stop=f'{at} + 1')})"
                return state(
                    open_=case((void, f"{acc}.open"), otherwise=f"array_append({acc}.open, {entry})"),
                    found=case((mark, f"array_append({acc}.found, {path})"), otherwise=f"{acc}.found"),
                    ends=case((f"{mark} AND {void}", void_end), otherwise=f"{acc}.ends"),
                    lead=case((f"{acc}.lead IS NULL AND {one_of(p, [*leading, *others])}", at), otherwise=f"{acc}.lead"),
                    known=case((one_of(p, leading), at), otherwise=f"{acc}.known"))

            return let(struct(mark=one_of(p, [driver]), void=void), with_facts)

        def closed(name: str) -> str:
            # Most tags end the last open one.
            top = f"try_element_at({acc}.open, -1)"
            around = f"coalesce(try_element_at({acc}.found, -1), {_INTS})"

            def told(o: str) -> str:
                return f"{o}.mark OR array_contains({around}, {o}.at)"

            def ended(o: str) -> str:
                return struct(at=f"{o}.at", stop=at)

            last = state(open_=f"slice({acc}.open, 1, size({acc}.open) - 1)", ends=case(
                (f"size({acc}.found) = 0", f"{acc}.ends"), (told(top), f"array_append({acc}.ends, {ended(top)})"),
                otherwise=f"{acc}.ends"))

            def popped(back: str) -> str:
                keep = f"size({acc}.open) - {back}"
                alone = f"{name} IN ({', '.join(map(quote, INLINE))})"
                left = f"slice({acc}.open, 1, {keep})"
                rest = case((alone, f"concat({left}, slice({acc}.open, {keep} + 2, size({acc}.open)))"), otherwise=left)
                gone = case((alone, f"slice({acc}.open, {keep} + 1, 1)"), otherwise=f"slice({acc}.open, {keep} + 1, size({acc}.open))")
                new = f"transform(filter({gone}, o -> {told('o')}), o -> {ended('o')})"
                return case((f"{back} = 0", state()), otherwise=state(open_=rest, ends=case(
                    (f"size({acc}.found) = 0", f"{acc}.ends"), otherwise=f"concat({acc}.ends, {new})")))

            by_name = let(f"cast(array_position(reverse(transform({acc}.open, o -> o.tag)), {name}) AS int)", popped)
            return case((f"{top}.tag = {name}", last), otherwise=by_name)

        tag = let(_tag_name(p), lambda name: case((f"startswith({p}, '</')", closed(name)), otherwise=opened(name)))
        # Only what comes before the first tag is a piece without one.
        return case((f"{at} = 0 AND NOT {p} RLIKE '^</?[a-zA-Z]'", state()), otherwise=tag)

    def cut(ps: str) -> str:
        def finish(acc: str) -> str:
            found = f"{acc}.found"
            # The first place where the ways to a match and its neighbour part.
            other = f"element_at({found}, CASE WHEN i = 0 THEN 2 ELSE i END)"
            parts = f"cast(array_position(zip_with(p, {other}, (x, y) -> coalesce(x = y, false)), false) AS int)"
            heads = f"transform({found}, (p, i) -> least({parts}, size(p)))"

            def split(at: str) -> str:
                start = f"transform({found}, (p, i) -> element_at(p, {at}[i]))"
                last = f"element_at({found}, -1)"
                # Where the parent of the last card ends; a document's end is its end as well.
                parent = f"try_element_at({last}, element_at({at}, -1) - 1)"
                stop = f"element_at(filter({acc}.ends, e -> e.at = {parent}), -1).stop"
                stop = case((f"element_at({at}, -1) > 1 AND exists({acc}.ends, e -> e.at = {parent})", stop), otherwise=f"size({ps})")
                flat = f"forall({found}, p -> element_at(p, -1) = element_at(p, element_at({at}, 1)))"
                seen = (f"coalesce({acc}.lead < element_at({found}[0], -1) AND "
                        f"{acc}.lead > coalesce(try_element_at({found}[0], element_at({at}, 1) - 1), -1), false)")
                told = f"coalesce({acc}.known < element_at({last}, -1), false)"
                ends = (f"transform({found}, p -> coalesce(element_at(filter({acc}.ends, e -> e.at = element_at(p, -1)), 1).stop + 1, size({ps})))")
                begin = case((seen, f"{acc}.lead"), otherwise=f"element_at({found}[0], -1)")

                def pieces(bounds: str) -> str:
                    return (f"transform(slice({bounds}, 1, size({bounds}) - 1), (b, i) -> "
                            f"array_join(slice({ps}, b + 1, greatest({bounds}[i + 1] - b, 0)), ''))")

                after = let(f"concat(array({begin}), {ends})", pieces)
                before = let(f"array_append({start}, {stop})", pieces)
                return case((f"{flat} AND ({seen} OR {told})", after), otherwise=before)

            return case((f"size({found}) = 0", NO_STRINGS), (f"size({found}) = 1", f"array(array_join({ps}, ''))"),
                        otherwise=let(heads, split))

        zero = struct(at="0", open="cast(array() AS array<struct<at: int, tag: string, mark: boolean>>)",
                      found="cast(array() AS array<array<int>>)", ends="cast(array() AS array<struct<at: int, stop: int>>)",
                      lead="cast(null AS int)", known="cast(null AS int)")
        return fold(ps, zero, step, finish)

    return let(f"split({_ended(html)}, {quote('(?=</?[a-zA-Z])')})", cut)
