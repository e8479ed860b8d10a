"""Detail pages: general ads, luxury ads, agencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions import html as H
from pageloom.functions import text as X
from pageloom.functions import urls as U
from pageloom.functions.expr import each
from pageloom.operators import specs as S
from pageloom.operators.cards import distinct_by, zip_lists
from pageloom.operators.classify import detail_outcome, page_flags
from pageloom.operators.extract import computed_once, extract_fields, picked_struct

_FLAGS = ("url", "origin_url", "final_url", "status", "fetched_at", "redirected", "robot_error",
          "expired", "accepted", "on_site", "parsed")


def _extract(pages: DataFrame, fields, domain: str, keep=()) -> DataFrame:
    flagged = page_flags(pages, rule="detail", domain=domain)
    # An unusable page is not searched.
    for body in ("html", "rendered_html"):
        flagged = flagged.withColumn(body, F.when(F.col("parsed"), F.col(body)))
    return extract_fields(flagged, fields, keep=[*keep, *_FLAGS])


def general_ads(pages: DataFrame, domain: str = S.GENERAL_DOMAIN, keep=()) -> DataFrame:
    ads = _extract(pages, S.GENERAL_AD, domain, keep)
    return detail_outcome(ads).withColumn("Time", F.col("fetched_at"))


def luxury_ads(pages: DataFrame, domain: str = S.LUXURY_DOMAIN, keep=()) -> DataFrame:
    return detail_outcome(_extract(pages, S.LUXURY_AD, domain, keep))


def _unpaired(*lists: str) -> str:
    """How many items of the longest list the shortest has no partner for."""
    sizes = ", ".join(f"coalesce(array_size({x}), 0)" for x in lists)
    return f"(greatest({sizes}) - least({sizes}))"


def agencies(pages: DataFrame, domain: str = S.GENERAL_DOMAIN, keep=(), whole_cards: bool = False) -> DataFrame:
    """Agency profiles with their three nested lists.

    With ``whole_cards`` the fields of a sale ad are taken from its own part of the page, so one without a picture
    or text has a NULL there and shifts no other.

    Sale ads are made distinct by URL as whole cards, at their first position. Sold ads whose
    lists differ in length fail the page; a page without a team keeps a NULL there. What the shorter
    lists leave without a partner is counted, ``n_team_dropped`` and ``n_sales_dropped``.
    """
    fields = (*S.AGENCY, S.SALE_CARDS) if whole_cards else S.AGENCY
    df = _extract(pages, fields, domain, keep)
    # An image without an address still takes its place in the team.
    photos = each("team_photo_tags", lambda tag: (
        f"try_element_at({H.attribute_values(tag, 'src')}, 1)"))
    raw = ("sale_cards", "team_photo_tags", "team_name", "team_position", "sale_url", "sale_text",
           "sale_picture", "sold_type", "sold_tags", "sold_city", "sold_details")
    df = df.selectExpr("*", f"{X.fill_blank_items(photos)} AS _photo")
    team = zip_lists({"photo": "_photo", "name": "team_name", "position": "team_position"})
    sales, unpaired_sales = zip_lists({"url": "sale_url", "description": "sale_text", "picture": "sale_picture"}), \
        _unpaired("sale_url", "sale_text", "sale_picture")
    if whole_cards:
        sales, unpaired_sales = each("sale_cards", lambda card: picked_struct(card, S.SALE)), "0"
    sold = zip_lists({"type": "sold_type", "description": "sold_tags", "city": "sold_city",
                      "details": "sold_details"}, "strict")
    # Once per page, though a filter and an explosion of what comes out ask for them again.
    df = computed_once(df, df.columns, {"_team": team, "_sales": distinct_by(sales, "url"), "_sold": sold})
    kept = [c for c in df.columns
            if c not in (*raw, "_photo", "_team", "_sales", "_sold", "missing_fields")]
    df = df.selectExpr(
        *kept,
        f"{U.digit_runs(U.last_segment('url'))} AS Realtor_ID",
        f"{X.null_if_no_items('_team')} AS Realtor_Team_infos",
        f"{X.null_if_no_items('_sales')} AS Realtor_Ads_selling_infos",
        f"{X.null_if_no_items('_sold')} AS Realtor_sold_Ads_infos",
        "array_distinct(sale_url) AS sale_urls",
        f"{_unpaired('_photo', 'team_name', 'team_position')} AS n_team_dropped",
        f"{unpaired_sales} AS n_sales_dropped",
        "CASE WHEN _sold IS NULL THEN array_append(missing_fields, 'sold ads') "
        "ELSE missing_fields END AS missing_fields",
        "fetched_at AS Time")
    return detail_outcome(df)


def agency_ad_urls(profiles: DataFrame) -> DataFrame:
    """Every distinct URL of an ad for sale on a usable profile, as a message for the ad stage.

    All of them, also those that no picture or text could be paired with.
    """
    return profiles.filter(F.col("outcome") == "ok").select(
        F.explode("sale_urls").alias("url"), F.lit("general").alias("route"),
        F.lit(None).cast("string").alias("cp"))


def usable(details: DataFrame) -> DataFrame:
    return details.filter(F.col("outcome") == "ok")


def unusable(details: DataFrame) -> DataFrame:
    """The error route: every page that gave no document, with the reason."""
    return details.filter(F.col("outcome") != "ok").select("url", "status", "outcome", "reason")
