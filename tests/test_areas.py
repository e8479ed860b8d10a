"""Cards without an element of their own."""

import random

import pytest

from pageloom.functions.areas import areas
from pageloom.functions.html import element as E

M = E("b", class_is="m")


def mark(n):
    return f'<b class="m">{n}</b>'


@pytest.mark.parametrize("doc, want", [
    (f"<ul><li>a{mark(1)}x</li><li>b{mark(2)}</li><li>{mark(3)}c</li></ul>z<i>w</i>",
     [f"<li>a{mark(1)}x</li>", f"<li>b{mark(2)}</li>", f"<li>{mark(3)}c</li>"]),
    (f"<ul><li>a{mark(1)}x<li>b{mark(2)}<li>{mark(3)}c</ul>z",  # ends left out
     [f"<li>a{mark(1)}x</li>", f"<li>b{mark(2)}</li>", f"<li>{mark(3)}c</li>"]),
    (f"<div><p>h</p><div><i>{mark(1)}</i><u>p</u></div><p>between</p><div><i>{mark(2)}</i></div><em>t</em></div>",
     [f"<div><i>{mark(1)}</i><u>p</u></div><p>between</p>", f"<div><i>{mark(2)}</i></div><em>t</em>"]),
    (f"<div><div><s>{mark(1)}</s><s>{mark(2)}</s></div><div><s>{mark(3)}</s></div></div>",  # rows of cards
     [f"<s>{mark(1)}</s>", f"<s>{mark(2)}</s></div>", f"<div><s>{mark(3)}</s></div>"]),
    (f"<div>{mark(1)}<i>p</i>{mark(2)}{mark(3)}<i>q</i></div>",  # siblings, each card begins with its match
     [f"{mark(1)}<i>p</i>", mark(2), f"{mark(3)}<i>q</i>"]),
    (f"<div>only {mark(1)}</div>", [f"<div>only {mark(1)}</div>"]),
    ("<div>none</div>", []), ("", []),
    (f"<div><b>{mark(1)}</div></b><div>{mark(2)}</div>", [f"<div><b>{mark(1)}</div></b>", f"<div>{mark(2)}</div>"]),
])
def test_cards_by_their_common_ancestors(evaluate, doc, want):
    assert evaluate(areas("s", M), [doc])[0] == want


def test_matches_that_end_their_cards(evaluate):
    doc = f"<div>h<i>p</i>{mark(1)}{mark(2)}<i>q</i>x{mark(3)}</div>end"
    got = evaluate(areas("s", M, [E("i")]), [doc])[0]
    assert got == [f"<i>p</i>{mark(1)}", mark(2), f"<i>q</i>x{mark(3)}"]
    doc = f"<div>{mark(1)}<i>p</i>{mark(2)}</div>"  # told that it leads, and nothing speaks against it
    assert evaluate(areas("s", M, [E("i")]), [doc])[0] == [mark(1), f"<i>p</i>{mark(2)}"]
    assert evaluate(areas("s", M, others=[E("i")]), [doc])[0] == [f"{mark(1)}<i>p</i>", mark(2)]
    doc = f"<div>{mark(1)}<i>p</i>{mark(2)}<i>q</i></div>"
    assert evaluate(areas("s", M, [E("i")]), [doc])[0] == [f"{mark(1)}<i>p</i>", f"{mark(2)}<i>q</i>"]
    doc = f"<div>h<i>p</i>{mark(1)}{mark(2)}<i>q</i></div>"
    assert evaluate(areas("s", M, others=[E("i")]), [doc])[0] == [f"<i>p</i>{mark(1)}", mark(2)]
    inside = f"<div><u><i>p</i>{mark(1)}</u><u>{mark(2)}</u></div>"  # elements around cards decide where they are
    assert evaluate(areas("s", M, [E("i")]), [inside])[0] == [f"<u><i>p</i>{mark(1)}</u>", f"<u>{mark(2)}</u>"]


def test_random_cards_keep_what_is_theirs(evaluate):
    rng = random.Random(11)
    pages, want = [], []
    for _ in range(200):
        cards = []
        for n in range(rng.randint(2, 6)):
            parts = [mark(n)] + [f"<i>{n}</i>"] * rng.randint(0, 2) + ["<br>"] * rng.randint(0, 1)
            rng.shuffle(parts)
            deep = "".join(f"<div>{p}</div>" if rng.random() < 0.4 else p for p in parts)
            cards.append(f"<li>{deep}</li>" if rng.random() < 0.5 else f"<li><div>{deep}</div></li>")
        pages.append(f"<div><ul>{''.join(cards)}</ul><p>foot</p></div>")
        want.append(cards)
    assert evaluate(areas("s", M, [E("i")]), pages) == want
