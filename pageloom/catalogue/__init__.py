"""Named queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pageloom.catalogue import details, listing, retrying, selection, storing, streams, values

_MODULES = (selection, listing, details, values, retrying, storing, streams)


def queries():
    return {name: fn for m in _MODULES for name, (fn, _) in m.BOOK.items()}


def oracle_sql():
    return {name: sql for m in _MODULES for name, (_, sql) in m.BOOK.items() if sql}
