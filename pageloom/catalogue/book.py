"""How the modules of the catalogue register their queries."""

from __future__ import annotations


class Book(dict):
    def query(self, sql: str | None = None):
        """Register the decorated function under its own name."""
        def register(fn):
            self[fn.__name__] = (fn, sql)
            return fn
        return register


def decoded(expr: str) -> str:
    """SQL that decodes the references occurring in the driver's pages, '&amp;' last."""
    for ref, char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''"),
                      ("&#x27;", "''"), ("&copy;", "©"), ("&middot;", "·"),
                      ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        expr = f"replace({expr}, '{ref}', '{char}')"
    return expr


# The blanks of the reference semantics, spelled out for SQL patterns.
SQL_BLANK = r"[\s\x{000b}\x{001c}-\x{001f}\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_tokens(expr: str) -> str:
    return (f"list_filter(regexp_split_to_array({expr}, '{SQL_BLANK}+'), lambda w: w <> '')")


# One row per link of a page: position, address, text.
LINKS = f"""
links AS (
  SELECT page_id, url, html, pos,
         regexp_extract(li, 'href="([^"]*)"', 1) AS href,
         {decoded("regexp_extract(li, '>([^<]*)</a>', 1)")} AS txt
  FROM (SELECT page_id, url, html,
               unnest(lis) AS li, generate_subscripts(lis, 1) AS pos
        FROM (SELECT page_id, url, html,
                     regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS lis
              FROM pages)))
"""
