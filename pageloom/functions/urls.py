"""URLs."""

from __future__ import annotations

from collections.abc import Iterable

from pageloom.functions.expr import case, each, let, quote


def host(url: str) -> str:
    """Lower-case host; NULL for a URL that does not parse."""
    return f"lower(try_parse_url({url}, 'HOST'))"


def query_parameter(url: str, name: str) -> str:
    return f"try_parse_url({url}, 'QUERY', {quote(name)})"


def last_segment(url: str) -> str:
    return f"element_at(split({url}, '/'), -1)"


def digit_runs(s: str) -> str:
    return f"regexp_extract_all({s}, '[0-9]+', 0)"


def with_site(path: str, site: str) -> str:
    """A path-only link made absolute, scheme included so that its host can be parsed."""
    return f"concat({quote('https://' + site)}, {path})"


def on_domain(url: str, domains: Iterable[str]) -> str:
    """Is the host one of the domains or below one of them? False when the URL has no host."""
    def test(name: str) -> str:
        hits = [f"{name} = {quote(d)} OR endswith({name}, {quote('.' + d)})" for d in domains]
        return f"coalesce({' OR '.join(hits)}, false)"

    return let(host(url), test)


def origin_url(url: str, redirect_urls: str) -> str:
    """The URL first asked for: the first redirect source, else the URL itself."""
    return f"coalesce(try_element_at({redirect_urls}, 1), {url})"


def _escaped(part: str) -> str:
    """Escapes of letters, digits and ``-._~`` undone, all others in capitals."""
    def piece(x: str) -> str:
        char = f"char(conv(substr({x}, 2), 16, 10))"
        return case((f"NOT {x} RLIKE '^%[0-9A-Fa-f]{{2}}$'", x), (f"{char} RLIKE '^[A-Za-z0-9._~-]$'", char), otherwise=f"upper({x})")

    return let(part, lambda p: case((f"NOT contains({p}, '%')", p), otherwise=(
        f"array_join({each(f'regexp_extract_all({p}, {quote("%[0-9A-Fa-f]{2}|[^%]+|%")}, 0)', piece)}, '')")))


def canonical(url: str) -> str:
    """One form for URLs that ask for the same: scheme and host in small letters, no default port, no fragment,
    no empty query, ``/`` for no path, arguments in order, escapes in one way. What is no such URL stays."""
    pattern = quote(r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$")

    def part(u: str, n: int) -> str:
        return f"regexp_extract({u}, {pattern}, {n})"

    def whole(u: str) -> str:
        scheme = f"lower({part(u, 1)})"
        site = (f"regexp_replace(concat(regexp_extract({part(u, 2)}, '^(?:.*@)?', 0), lower(regexp_replace({part(u, 2)}, '^.*@', ''))), "
                f"CASE {scheme} WHEN 'https' THEN ':443$' WHEN 'http' THEN ':80$' ELSE ':$' END, '')")
        path = case((f"{part(u, 3)} = ''", "'/'"), otherwise=_escaped(part(u, 3)))
        arguments = f"filter(split({part(u, 4)}, '&'), a -> a <> '')"
        ordered = f"array_join(array_sort({each(arguments, _escaped)}), '&')"
        query = let(ordered, lambda q: case((f"{q} = ''", "''"), otherwise=f"concat('?', {q})"))
        return f"concat({scheme}, '://', {site}, {path}, {query})"

    return let(url, lambda u: case((f"{u} RLIKE {pattern}", whole(u)), otherwise=u))
