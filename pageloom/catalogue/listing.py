"""Search-result pages: frontier, cards, outcome, routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalogue import dressed as D
from pageloom.catalogue.book import LINKS, Book
from pageloom.functions import text as X
from pageloom.functions import urls as U
from pageloom.functions.html import element
from pageloom.operators import route as R
from pageloom.operators import specs as S
from pageloom.operators.cards import (ads_per_page, cards_with_position, discover, listing_ads,
                                      union_sites, zip_lists)
from pageloom.operators.classify import detail_outcome, page_flags
from pageloom.operators.extract import Field, extract_fields
from pageloom.plans import discovery
from pageloom.sources import frontier

BOOK = Book()

_GENERAL = S.GENERAL_LISTING._replace(domain="")
_LUXURY = S.LUXURY_LISTING._replace(domain="")
_LUXURY_CARDS = _LUXURY._replace(card=element("li"))


@BOOK.query("""
SELECT 'general' AS site, s_suppkey::VARCHAR AS cp, n::BIGINT AS page_no,
       'https://www.seloger.com/list.htm?tri=initial&idtypebien=2,1&idtt=2,5&naturebien=1,2,4&cp='
       || s_suppkey || '&LISTING-LISTpg=' || n AS url
FROM supplier, range(1, 200) r(n)
UNION ALL
SELECT 'luxury', s_suppkey::VARCHAR, n::BIGINT,
       'https://www.bellesdemeures.com/recherche?ci=' || s_suppkey
       || '&tri=Selection&idtt=2&page=' || n
FROM supplier, range(1, 6) r(n)
""")
def url_frontier(spark, sf_dir):
    params = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    both = [frontier.general_listing_urls(params, "s_suppkey").withColumn("site", F.lit("general")),
            frontier.luxury_listing_urls(params, "s_suppkey").withColumn("site", F.lit("luxury"))]
    return both[0].unionByName(both[1]).select(
        "site", "cp", F.col("page_no").cast("bigint").alias("page_no"), "url")


_PRICED = """
cards AS (
  SELECT page_id, pos, href, txt, regexp_matches(txt, '[aeiou]$') AS priced,
         page_id || chr(160) || '000 €' AS price
  FROM links)
"""


@BOOK.query(f"""
WITH {LINKS}, {_PRICED},
p AS (SELECT page_id, (count(*) FILTER (priced))::BIGINT AS n FROM cards GROUP BY page_id)
SELECT c.page_id, c.pos::BIGINT AS pos, 'annonce-' || txt AS ad_id, href AS ad_url,
       txt AS ad_type, price, 2::BIGINT AS rooms, (c.page_id + 0.5)::DOUBLE AS surface_m2,
       3::BIGINT AS floor
FROM cards c JOIN p ON c.page_id = p.page_id WHERE pos <= n
""")
def cards_positional(spark, sf_dir):
    """The reference's alignment: prices are counted from the top, gaps or not."""
    found = discover(D.general_listing(spark, sf_dir), _GENERAL, "positional")
    return _cards(found)


@BOOK.query(f"""
WITH {LINKS}, {_PRICED}
SELECT page_id, pos::BIGINT AS pos, 'annonce-' || txt AS ad_id, href AS ad_url, txt AS ad_type,
       CASE WHEN priced THEN price END AS price, 2::BIGINT AS rooms,
       (page_id + 0.5)::DOUBLE AS surface_m2, 3::BIGINT AS floor
FROM cards
""")
def cards_per_card(spark, sf_dir):
    return _cards(discover(D.general_listing(spark, sf_dir), _GENERAL, "per_card"))


def _cards(found):
    cards = cards_with_position(found, keep=("page_id",)).selectExpr(
        "*", f"{X.criteria_items('AdsCriterea')} AS items")
    typed = X.typed_criteria("items")
    return cards.selectExpr(
        "page_id", "cast(pos AS bigint) AS pos", "AdsWebId AS ad_id", "AdsUrl AS ad_url",
        "AdsType AS ad_type", "AdsPrice AS price", f"cast({typed['rooms']} AS bigint) AS rooms",
        f"cast({typed['surface_m2']} AS double) AS surface_m2",
        f"cast({typed['floor']} AS bigint) AS floor")


@BOOK.query(f"""
WITH {LINKS}, {_PRICED}
SELECT page_id, count(*)::BIGINT AS n_ids, (count(*) FILTER (priced))::BIGINT AS n_prices,
       CASE WHEN count(*) = count(*) FILTER (priced) THEN count(*)::BIGINT END AS n_records,
       (count(*) - count(*) FILTER (priced))::BIGINT AS n_dropped
FROM cards GROUP BY page_id
""")
def cards_strict(spark, sf_dir):
    fields = [Field(f.name, f.path, f.take, "all") for f in _GENERAL.fields]
    df = extract_fields(D.general_listing(spark, sf_dir), fields, keep=["page_id"])
    lists = {"id": "AdsWebId", "price": "AdsPrice"}
    strict, cut = F.expr(zip_lists(lists, "strict")), F.expr(zip_lists(lists, "truncate"))
    n_ids = F.size("AdsWebId")
    return df.filter(n_ids > 0).select(
        "page_id", n_ids.cast("bigint").alias("n_ids"),
        F.size("AdsPrice").cast("bigint").alias("n_prices"),
        F.when(strict.isNotNull(), F.size(strict)).cast("bigint").alias("n_records"),
        (n_ids - F.size(cut)).cast("bigint").alias("n_dropped"))


@BOOK.query(f"""
WITH {LINKS}
SELECT p.url, count(l.page_id)::BIGINT AS n_ads
FROM pages p LEFT JOIN links l ON p.page_id = l.page_id GROUP BY p.url
""")
def ads_by_page(spark, sf_dir):
    return ads_per_page(discover(D.general_listing(spark, sf_dir), _GENERAL, with_records=False))


_FACTS = """
facts AS (
  SELECT page_id, url, html,
         CASE page_id % 13 WHEN 0 THEN url || '/erreur-temporaire/'
                           WHEN 1 THEN url || '/annonce-expiree/' ELSE url END AS final_url,
         CASE page_id % 11 WHEN 0 THEN 404 WHEN 1 THEN 502 WHEN 2 THEN 500 ELSE 200 END AS status,
         page_id % 13 < 3 AS redirected, page_id % 7 AS retry_times,
         regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
         len(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')) AS n_links
  FROM pages),
judged AS (
  SELECT *, CASE WHEN NOT (host = 'example.com' OR host LIKE '%.example.com') THEN 'off_site'
                 WHEN status = 500 THEN 'bad_status'
                 WHEN contains(final_url, 'erreur') THEN 'robot_error'
                 WHEN contains(final_url, 'expiree') THEN 'expired'
                 WHEN n_links = 0 OR (page_id % 5 = 0) THEN 'empty' ELSE 'ok' END AS outcome,
            CASE WHEN redirected THEN 'https://old.example.com/?u=' || url ELSE url END AS origin
  FROM facts)
"""


def _judged(spark, sf_dir):
    """Every fifth page loses its cards, so that empty pages with each status occur."""
    pages = D.general_listing(spark, sf_dir, facts=True)
    pages = pages.withColumn("html", F.when(F.col("page_id") % 5 == 0, F.lit("<html></html>"))
                             .otherwise(F.col("html")))
    return discover(pages, S.GENERAL_LISTING._replace(domain="example.com"), with_records=False)


@BOOK.query(f"""
WITH {_FACTS}
SELECT page_id, origin, outcome,
       CASE WHEN outcome = 'ok' THEN NULL
            WHEN outcome = 'bad_status' OR (outcome = 'empty' AND status <> 200)
            THEN 'status_' || status ELSE outcome END AS reason,
       CASE WHEN outcome = 'ok' THEN n_links ELSE 0 END::BIGINT AS n_records,
       (redirected AND contains(url, 'erreur'))::BIGINT AS origin_robot_error
FROM judged
""")
def page_outcome(spark, sf_dir):
    return _judged(spark, sf_dir).select(
        "page_id", F.col("origin_url").alias("origin"), "outcome", "reason",
        F.col("n_records").cast("bigint").alias("n_records"),
        F.col("origin_robot_error").cast("bigint").alias("origin_robot_error"))


@BOOK.query(f"""
WITH {_FACTS}
SELECT 'retry' AS kind, origin AS url, (retry_times + 1)::BIGINT AS retries, NULL::BIGINT AS raison
FROM judged WHERE outcome NOT IN ('ok', 'off_site') AND retry_times + 1 <= 5
UNION ALL
SELECT 'DeferedRequest', origin, NULL, status::BIGINT
FROM judged WHERE outcome NOT IN ('ok', 'off_site') AND retry_times + 1 > 5
""")
def retry_or_defer(spark, sf_dir):
    """What becomes of each page without records, by the retries it already had."""
    found = _judged(spark, sf_dir)
    again = discovery.next_attempts(found, S.MAX_RETRIES).select(
        F.lit("retry").alias("kind"), "url", F.col("retry_times").cast("bigint").alias("retries"),
        F.lit(None).cast("bigint").alias("raison"))
    gone = discovery.given_up(found, S.MAX_RETRIES).select(
        F.col("Type").alias("kind"), F.col("RequestUrl").alias("url"),
        F.lit(None).cast("bigint").alias("retries"), F.col("Raison").cast("bigint").alias("raison"))
    return again.unionByName(gone)


@BOOK.query(f"""
WITH {_FACTS}
SELECT page_id,
       CASE WHEN status <> 200 THEN 'bad_status'
            WHEN redirected AND contains(final_url, 'erreur') THEN 'robot_error'
            WHEN redirected AND contains(final_url, 'expiree') THEN 'expired'
            WHEN redirected THEN 'redirected'
            WHEN n_links < 6 THEN 'extract_failed' ELSE 'ok' END AS outcome
FROM facts
""")
def detail_page_outcome(spark, sf_dir):
    """Detail pages: any redirect counts; a required sixth link is missing on some."""
    flagged = page_flags(D.with_fetch_facts(spark, sf_dir), rule="detail")
    fields = [Field("sixth", (element("li"), element("a")), "@href", 6, required=True)]
    df = extract_fields(flagged, fields, keep=[
        "page_id", "status", "on_site", "accepted", "parsed", "robot_error", "expired"])
    return detail_outcome(df).select("page_id", "outcome")


@BOOK.query("""
WITH r AS (
  SELECT CASE WHEN contains(url, 'blog.') THEN 'blog' WHEN contains(url, 'm.') THEN 'mobile'
              ELSE 'general' END AS route,
         nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS cp
  FROM pages)
SELECT route, cp, count(*)::BIGINT AS n FROM r GROUP BY route, cp
""")
def route_urls(spark, sf_dir):
    rules = (("blog.", "blog"), ("m.", "mobile"))
    url = F.col("url")
    routed = D.pages(spark, sf_dir).select(
        R.route_of(url, rules, "general").alias("route"), F.expr(U.query_parameter("url", "page")).alias("cp"))
    return routed.groupBy("route", "cp").agg(F.count("*").alias("n"))


@BOOK.query(f"""
WITH {LINKS}
SELECT 'luxury' AS route, 'https://www.bellesdemeures.com' || href AS url
FROM links WHERE contains('Paris ' || txt, 'è')
""")
def city_filter(spark, sf_dir):
    """Luxury ads pass only for one district; every address holds the luxury marker."""
    ads = listing_ads(discover(D.luxury_listing(spark, sf_dir), _LUXURY, "positional"))
    return R.route_ads(ads, site="luxury", district="è").select("route", "url")


@BOOK.query(f"""
WITH {LINKS}, {_PRICED}
SELECT 'annonce-' || txt AS ad_id, href AS ad_url, CASE WHEN priced THEN price END AS price,
       NULL::VARCHAR AS city, 'general' AS route
FROM cards
UNION ALL
SELECT 'id' || href, 'https://www.bellesdemeures.com' || href, txt || ' €', 'Paris ' || txt,
       'luxury'
FROM links
""")
def union_both_sites(spark, sf_dir):
    general = listing_ads(discover(D.general_listing(spark, sf_dir), _GENERAL))
    luxury = listing_ads(discover(D.luxury_listing(spark, sf_dir), _LUXURY_CARDS)).drop("Time")
    both = union_sites(general, luxury)
    return both.select(
        F.col("AdsWebId").alias("ad_id"), F.col("AdsUrl").alias("ad_url"),
        F.col("AdsPrice").alias("price"), F.col("AdsCity").alias("city"),
        R.route_of(F.col("AdsUrl"), R.GENERAL_ROUTES, R.GENERAL_DEFAULT).alias("route"))


@BOOK.query(f"""
WITH {LINKS}
SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, count(DISTINCT page_id)::BIGINT AS n_pages,
       count(*)::BIGINT AS n_ads
FROM links GROUP BY 1
""")
def ads_by_host(spark, sf_dir):
    """The flagship: pages to cards to routed records to counts per host."""
    found = discover(D.general_listing(spark, sf_dir), _GENERAL, with_records=False)
    return (found.filter(F.col("outcome") == "ok")
            .groupBy(F.expr(U.host("url")).alias("host"))
            .agg(F.count("*").alias("n_pages"), F.sum("n_records").cast("bigint").alias("n_ads")))


@BOOK.query(f"""
WITH {LINKS}, {_PRICED}
SELECT page_id, pos::BIGINT AS pos, 'id' || href AS ad_id, CASE WHEN priced THEN txt || ' €' END AS price,
       'Paris ' || txt AS city, 0::BIGINT AS n_dropped
FROM cards
""")
def luxury_cards_by_driver(spark, sf_dir):
    """Luxury cards, some without a price, on pages that name no element around a card."""
    pages = D.luxury_listing(spark, sf_dir)
    price = '<p class="annonceItemPrice">[^<]*[^aeiou<] €</p>'
    pages = pages.withColumn("html", F.regexp_replace("html", F.lit(price), F.lit("")))
    found = discover(pages, _LUXURY, "by_driver")
    return cards_with_position(found, keep=("page_id", "n_dropped")).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), F.col("AdsWebId").alias("ad_id"), F.col("AdsPrice").alias("price"),
        F.col("AdsCity").alias("city"), F.col("n_dropped").cast("bigint").alias("n_dropped"))
