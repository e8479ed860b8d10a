"""Pieces of expression text."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable

_numbers = itertools.count(1)

NO_STRINGS = "cast(array() AS array<string>)"


def quote(s: str) -> str:
    """A string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _variable() -> str:
    """A lambda variable that no enclosing lambda uses."""
    return f"v{next(_numbers)}_"


def is_name(expr: str) -> bool:
    return re.fullmatch(r"[A-Za-z_][A-Za-z0-9_.]*", expr) is not None


def each(array: str, body: Callable[[str], str]) -> str:
    v = _variable()
    return f"transform({array}, {v} -> {body(v)})"


def those(array: str, test: Callable[[str], str]) -> str:
    v = _variable()
    return f"filter({array}, {v} -> {test(v)})"


def each_flat(array: str, body: Callable[[str], str]) -> str:
    return f"flatten({each(array, body)})"


def let(value: str, use: Callable[[str], str]) -> str:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    if is_name(value):
        return use(value)
    v = _variable()
    return f"element_at(transform(array({value}), {v} -> {use(v)}), 1)"


def fold(array: str, zero: str, step: Callable[[str, str], str],
         finish: Callable[[str], str]) -> str:
    acc, v, end = _variable(), _variable(), _variable()
    return f"aggregate({array}, {zero}, ({acc}, {v}) -> {step(acc, v)}, {end} -> {finish(end)})"


def case(*branches: tuple[str, str], otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN {test} THEN {value}" for test, value in branches)
    return f"CASE {arms} ELSE {otherwise} END"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"
