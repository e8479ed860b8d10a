"""Parallel match lists to records, and listing pages to their cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom import schemas
from pageloom.functions import html as H
from pageloom.functions.areas import areas
from pageloom.functions.expr import each, let
from pageloom.operators.classify import listing_outcome, page_flags
from pageloom.operators.extract import computed_once, matches, value
from pageloom.operators.specs import Listing


def zip_lists(lists: dict[str, str], mode: str = "truncate") -> str:
    """Combine arrays by position into an array of structs.

    ``truncate`` keeps the prefix all arrays can fill. ``strict`` yields NULL for unequal sizes.
    ``arrays_zip`` alone would pad to the longest array.
    """
    fields = ", ".join(f"{name}: string" for name in lists)
    zipped = f"cast(arrays_zip({', '.join(lists.values())}) AS array<struct<{fields}>>)"
    sizes = [f"size({a})" for a in lists.values()]
    least = f"least({', '.join(sizes)})" if len(sizes) > 1 else sizes[0]
    if mode == "truncate":
        return f"slice({zipped}, 1, {least})"
    if mode == "strict":
        same = " AND ".join(f"{s} = {sizes[0]}" for s in sizes)
        return f"CASE WHEN {same} THEN {zipped} END"
    raise ValueError(f"unknown zip mode {mode!r}")


def distinct_by(cards: str, field: str) -> str:
    """Cards without repeats of ``field``, each at its first position."""
    return let(cards, lambda cs: let(each(cs, lambda c: f"{c}.{field}"), lambda keys: (
        f"filter({cs}, (c, i) -> coalesce(array_position({keys}, c.{field}) = i + 1, true))")))


def _record(values: dict[str, str], spec: Listing) -> str:
    """A listing record; fields the site does not give are NULL."""
    filled = {**values, "Type": "'SmallAds'"}
    if spec.timed:
        filled["Time"] = "fetched_at"
    pairs = [f"'{f.name}', cast({filled.get(f.name, 'NULL')} AS {f.dataType.simpleString()})"
             for f in schemas.fields(schemas.LISTING_AD)]
    return f"named_struct({', '.join(pairs)})"


def discover(pages: DataFrame, spec: Listing, alignment: str = "per_card",
             with_records: bool = True) -> DataFrame:
    """One row per listing page: its flags, outcome, reason and the array of its records.

    ``positional`` extracts each field over the whole page and zips by position, so a card that
    lacks a field shifts the later ones. ``per_card`` extracts inside each card. ``by_driver`` does so, too, where
    no element around a card is known: the matches of the driver tell where one card ends and the next one
    begins. Without records only the cards are found and counted. The body does not leave this narrow stage.
    """
    if alignment not in ("positional", "per_card", "by_driver"):
        raise ValueError(f"unknown alignment {alignment!r}")
    flagged = page_flags(pages, rule="listing", domain=spec.domain)
    base = [c for c in flagged.columns if c not in ("html", "rendered_html")]
    # Pages that are not parsed cost no extraction.
    df = flagged.selectExpr(*base, f"CASE WHEN parsed THEN {H.readable('html')} ELSE '' END AS _body")

    if alignment == "positional":
        df = df.selectExpr(*base, *[f"{matches('_body', f.path, f.take)} AS _{f.name}"
                                    for f in spec.fields])
        sizes = [f"size(_{f.name})" for f in spec.fields]
        counts = {"n_cards": f"size(_{spec.driver})",
                  "n_records": f"least({', '.join(sizes)})" if len(sizes) > 1 else sizes[0]}
        cards = zip_lists({f.name: f"_{f.name}" for f in spec.fields})
        records = each(cards, lambda card: _record(
            {f.name: f.post(f"{card}.{f.name}") if f.post else f"{card}.{f.name}"
             for f in spec.fields}, spec))
    else:
        if alignment == "by_driver":
            first = {f.name: f.path[0] for f in spec.fields}
            cards = areas("_body", first.pop(spec.driver), others=list(first.values()))
        elif spec.card is None:
            raise ValueError("this listing names no card element; give one or use 'positional' or 'by_driver'")
        else:
            cards = H.outer_html("_body", spec.card)
        df = df.selectExpr(*base, f"{cards} AS _cards")
        counts = {"n_cards": "size(_cards)", "n_records": "size(_cards)"}
        records = each("_cards", lambda card: _record(
            {f.name: value(f, matches(card, f.path, f.take)) for f in spec.fields}, spec))

    columns = {**counts, "records": records} if with_records else counts
    df = computed_once(df, base, columns)
    return listing_outcome(df.selectExpr("*", "n_cards - n_records AS n_dropped"))


def listing_ads(discovered: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The records, one row each; a page that went wrong has none."""
    return discovered.select(*keep, F.inline("records"))


def cards_with_position(discovered: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return (discovered.select(*keep, F.posexplode("records").alias("pos", "card"))
            .select(*keep, (F.col("pos") + 1).alias("pos"), "card.*"))


def ads_per_page(discovered: DataFrame) -> DataFrame:
    """Ads per URL; a URL fetched several times is summed."""
    return discovered.groupBy("url").agg(F.sum("n_cards").cast("bigint").alias("n_ads"))


def union_sites(*listings: DataFrame) -> DataFrame:
    """Records of several sites as one table; fields one site lacks become NULL."""
    first, *rest = listings
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return schemas.conform(first, schemas.LISTING_AD)
