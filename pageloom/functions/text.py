"""Text: blanks, tokens, entities, numbers, JSON."""

from __future__ import annotations

from html.entities import name2codepoint

from pageloom.functions.expr import case, each, let, quote, those

# The blanks that count as white space, Unicode ones (no-break, narrow) included.
BLANK = (r"[\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F"
         r"\u3000]")

PRICE_TYPE = "decimal(14,2)"


# ---- blanks and tokens -------------------------------------------------------------------------

def trim_blank(s: str) -> str:
    """Strip leading and trailing white space; ``trim`` alone would leave no-break spaces."""
    return f"regexp_replace({s}, {quote(f'^{BLANK}+|{BLANK}+$')}, '')"


def collapse_blank(s: str) -> str:
    """One plain space between words, none at the ends: what a reader sees of an element."""
    return f"trim(regexp_replace({s}, {quote(BLANK + '+')}, ' '))"


def tokens(s: str) -> str:
    """White-space separated words, without empty ones."""
    return those(f"split({s}, {quote(BLANK + '+')})", lambda word: f"{word} <> ''")


def nth_token(s: str, n: int) -> str:
    """The n-th word (1-based, negative from the end); NULL when there are fewer."""
    return f"try_element_at({tokens(s)}, {n})"


def token_range(s: str, first: int, length: int) -> str:
    """Words ``first`` .. ``first+length-1`` joined by a space; NULL when the text is too short."""
    return let(tokens(s), lambda words: case(
        (f"size({words}) >= {first + length - 1}",
         f"array_join(slice({words}, {first}, {length}), ' ')")))


def join_all(values: str, separator: str = "") -> str:
    """All values joined to one string; '' for an empty list."""
    return f"array_join({values}, {quote(separator)})"


# ---- empty values ------------------------------------------------------------------------------

def null_if_empty(s: str) -> str:
    return f"nullif({s}, '')"


def null_if_no_items(values: str) -> str:
    return let(values, lambda v: case((f"size({v}) > 0", v)))


def fill_blank_items(values: str, filler: str = "None") -> str:
    """Replace empty and missing items, so that lists stay aligned by position."""
    return each(values, lambda v: f"coalesce(nullif({v}, ''), {quote(filler)})")


def labelled(label: str, s: str) -> str:
    """``label`` in front of the value; NULL stays NULL."""
    return f"concat({quote(label)}, {s})"


# ---- entities ----------------------------------------------------------------------------------

def _entity_table() -> str:
    """Name → character, generated from the standard list, the usual suspects first because a map
    is searched front to back. One text literal, which Spark turns into a map once per plan."""
    usual = ["amp", "nbsp", "quot", "lt", "gt", "eacute", "egrave", "agrave", "euro", "copy",
             "middot", "sup2", "ccedil"]
    names = usual + [n for n in sorted(name2codepoint) if n not in usual]
    pairs = [f"{name}\x02{chr(name2codepoint[name])}" for name in names] + ["apos\x02'"]
    return f"str_to_map({quote(chr(1).join(pairs))}, '\\u0001', '\\u0002')"


_ENTITIES = _entity_table()


def _character(code: str) -> str:
    """Character of a code point; NULL outside Unicode."""
    return let(code, lambda c: case(
        (f"{c} BETWEEN 1 AND 1114111 AND NOT {c} BETWEEN 55296 AND 57343",
         f"decode(unhex(lpad(hex({c}), 8, '0')), 'UTF-32')")))


def decode_entities(s: str) -> str:
    """Named and numeric character references to characters, each decoded once.

    Unknown references stay as written. Text without '&' is returned untouched.
    """
    def one(piece: str) -> str:
        # conv() raises on overflow, so longer digit runs (never Unicode) are kept away from it; zeros in front don't count.
        decoded = case(
            (f"{piece} RLIKE '^&#[0-9]+;$'",
             _character(f"try_cast(regexp_extract({piece}, '[0-9]+', 0) AS bigint)")),
            (f"{piece} RLIKE '^&#[xX]0*[0-9a-fA-F]{{1,8}};$'",
             _character(f"cast(conv(regexp_extract({piece}, '^&#[xX]0*([0-9a-fA-F]{{1,8}});$', 1), 16, 10) AS bigint)")),
            (f"{piece} RLIKE '^&[A-Za-z][A-Za-z0-9]*;$'",
             f"try_element_at({_ENTITIES}, substr({piece}, 2, length({piece}) - 2))"))
        return case((f"startswith({piece}, '&')", f"coalesce({decoded}, {piece})"),
                    otherwise=piece)

    pattern = quote(r"&#?[0-9A-Za-z]+;|[^&]++|&")
    return let(s, lambda t: case(
        (f"contains({t}, '&')",
         f"array_join({each(f'regexp_extract_all({t}, {pattern}, 0)', one)}, '')"), otherwise=t))


# ---- numbers -----------------------------------------------------------------------------------

def _first_number(s: str) -> str:
    """The first number as digits with a point, '' without one.

    A number is a sign, digits in groups of three with one blank of any kind between, and a decimal
    comma with digits; anything else ends it, so units, ranges and charges add no digits. A list such
    as '1,2,3' is none.
    """
    blank = r"[\s\u00a0\u202f\u2009]"
    number = quote(rf"(?<![0-9,])-?[0-9]++(?:(?<![0-9]{{4}}){blank}[0-9]{{3}}(?![0-9]))*+(?:,[0-9]++)?+(?!,[0-9])")
    first = f"regexp_extract({s}, {number}, 0)"
    return f"replace(regexp_replace({first}, '[^-0-9,]', ''), ',', '.')"


def amount(s: str) -> str:
    """'750 000 €' or '43,33 m²' → the first number as a decimal; NULL without one, or with one beyond the
    decimal type, which ``amount_too_large`` tells from it."""
    return f"try_cast({_first_number(s)} AS {PRICE_TYPE})"


def amount_too_large(s: str) -> str:
    """Is there a number, but one that the decimal type cannot hold? False for NULL."""
    return let(f"coalesce({_first_number(s)}, '')", lambda n: f"({n} <> '' AND try_cast({n} AS {PRICE_TYPE}) IS NULL)")


def criteria_items(outer_html: str) -> str:
    """'<em>1 p</em> <em>43,33 m²</em>' → ['1 p', '43,33 m²']."""
    pattern = quote(r"(?s)<em\b[^>]*>(.*?)</em>")
    return each(f"regexp_extract_all({outer_html}, {pattern}, 1)",
                lambda x: trim_blank(decode_entities(x)))


def criterion(items: str, unit: str, kind: str = PRICE_TYPE) -> str:
    """The first item carrying the unit, as a number."""
    carrying = those(items, lambda x: f"{x} RLIKE {quote(f'{BLANK}{unit}$')}")
    return f"try_cast({amount(f'try_element_at({carrying}, 1)')} AS {kind})"


def typed_criteria(items: str) -> dict[str, str]:
    """Rooms, surface and floor out of the items of a criteria block."""
    return {
        "rooms": criterion(items, "p", "int"),
        "surface_m2": criterion(items, "m²"),
        "floor": criterion(items, "etg", "int"),
    }


# ---- JSON --------------------------------------------------------------------------------------

def json_record(**fields: str) -> str:
    """One JSON object with every field present, NULL ones too."""
    pairs = ", ".join(f"{quote(k)}, {v}" for k, v in fields.items())
    return f"to_json(named_struct({pairs}), map('ignoreNullFields', 'false'))"
