"""Ad and agency pages to documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom import schemas
from pageloom.catalogue import dressed as D
from pageloom.catalogue.book import LINKS, Book, decoded, sql_tokens
from pageloom.functions.expr import each
from pageloom.operators import documents, store
from pageloom.plans import details
from pageloom.session import scratch_dir

BOOK = Book()

_H1 = decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")
_AD = decoded("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")

# What the general ad pages must give, by page number and the page's own texts.
_ADS = f"""
{LINKS},
t AS (SELECT page_id, list(txt ORDER BY pos) AS li FROM links GROUP BY page_id),
ads AS (
  SELECT p.page_id, page_id::VARCHAR AS num, {_AD} AS ad, {sql_tokens(_H1)} AS w, li,
         CASE page_id % 11 WHEN 0 THEN 404 WHEN 1 THEN 502 WHEN 2 THEN 500 ELSE 200 END AS status,
         page_id % 13 < 3 AS redirected
  FROM pages p LEFT JOIN t USING (page_id)),
judged AS (
  SELECT *, CASE WHEN status <> 200 THEN 'bad_status'
                 WHEN page_id % 13 = 0 THEN 'robot_error' WHEN page_id % 13 = 1 THEN 'expired'
                 WHEN redirected THEN 'redirected'
                 WHEN page_id % 7 = 0 OR page_id % 9 = 0 OR len(w) < 7 OR len(w) = 0
                      OR coalesce(len(li), 0) < 2 THEN 'extract_failed'
                 ELSE 'ok' END AS outcome
  FROM ads)
"""


@BOOK.query(f"""
WITH {_ADS}
SELECT page_id, outcome,
       CASE WHEN outcome = 'ok' THEN NULL WHEN outcome = 'bad_status' THEN 'status_' || status
            WHEN outcome <> 'extract_failed' THEN outcome
            ELSE 'missing ' || concat_ws(',',
              CASE WHEN len(w) = 0 THEN 'RealEstate_trans' END,
              CASE WHEN len(w) < 7 THEN 'RealEstate_title' END,
              CASE WHEN page_id % 9 = 0 THEN 'RealtorWebSite' END,
              CASE WHEN page_id % 7 = 0 THEN 'RealEstate_price' END,
              CASE WHEN coalesce(len(li), 0) < 2 THEN 'RealEstate_nbrooms' END) END AS reason
FROM judged
""")
def ad_outcome(spark, sf_dir):
    ads = details.general_ads(D.general_ad(spark, sf_dir), domain="", keep=("page_id",))
    return ads.select("page_id", "outcome", "reason")


_DOCUMENT = f"""
WITH {_ADS}
SELECT page_id, w[1] AS transaction, w[5] || ' ' || w[6] || ' ' || w[7] AS title,
       'Type ' || num AS type, '/i/' || num || '-1.jpg,/i/' || num || '-2.jpg' AS images,
       trim(ad) AS description, li[1] AS rooms, li[-2] AS beds, ad AS address,
       '0' || num AS zip, num || '000' AS price, '€ FAI*' AS price_unit,
       num || '-b' AS web_id, 'Agence ' || num || ' & fils' AS realtor,
       CASE WHEN page_id % 5 <> 0 THEN num END AS siren, num || ' rue' AS realtor_address,
       '01' || num AS phone, '/logo/' || num || '.png' AS logo, '/agence/' || num AS profile,
       CASE WHEN page_id % 4 <> 0 THEN '/site/' || num END AS website, num || ',5' AS surface,
       'm²' AS surface_unit, 'f' || num || ' & more|g' AS features,
       (1704067200 + page_id * 60)::BIGINT AS created
FROM judged WHERE outcome = 'ok'
"""


def _flat_ad(docs):
    return docs.select(
        *[c for c in docs.columns if c == "page_id"], F.col("TransactionType").alias("transaction"), F.col("Title").alias("title"),
        F.col("Type").alias("type"), F.array_join("Images", ",").alias("images"),
        F.col("Description").alias("description"), F.col("Rooms").alias("rooms"),
        F.col("Beds").alias("beds"), F.col("Adress.RealEstate_Adress").alias("address"),
        F.col("Adress.RealEstate_Zip_Code").alias("zip"),
        F.col("Price.Realestate_Price").alias("price"),
        F.col("Price.Realestate_Price_Unite").alias("price_unit"),
        F.col("WebRealtor.externId").alias("web_id"),
        F.col("WebRealtor.Realtor_Name").alias("realtor"),
        F.col("WebRealtor.Realtor_Siren").alias("siren"),
        F.col("WebRealtor.Realtor_Address").alias("realtor_address"),
        F.col("WebRealtor.Realtor_Phone_Number").alias("phone"),
        F.array_join("WebRealtor.Realtor_Logo", ",").alias("logo"),
        F.col("WebRealtor.Realtor_Seloger_Profile").alias("profile"),
        F.col("WebRealtor.Realtor_Website").alias("website"),
        F.col("Features.Realestate_Surface").alias("surface"),
        F.col("Features.Realestate_Surface_Unite").alias("surface_unit"),
        F.array_join("Features.RealEstate_Features", "|").alias("features"),
        F.unix_seconds("Creation_Date").alias("created"))


@BOOK.query(_DOCUMENT)
def ad_document(spark, sf_dir):
    ads = details.usable(details.general_ads(D.general_ad(spark, sf_dir), domain="",
                                             keep=("page_id",)))
    return _flat_ad(ads.select("page_id", *documents.ad_document_columns()))


@BOOK.query(_DOCUMENT)
def ad_document_json(spark, sf_dir):
    """The document written as JSON text and read back."""
    ads = details.usable(details.general_ads(D.general_ad(spark, sf_dir), domain="",
                                             keep=("page_id",)))
    docs = ads.select("page_id", *documents.ad_document_columns())
    text = documents.as_json(docs)
    back = F.from_json("value", "page_id BIGINT, " + schemas.AD_DOCUMENT)
    return _flat_ad(text.select(back.alias("d")).select("d.*"))


@BOOK.query(f"SELECT * EXCLUDE (page_id) FROM ({_DOCUMENT})")
def appended_ad_documents(spark, sf_dir):
    """Ad documents appended in two parts to a table that the first append creates."""
    path = scratch_dir(spark, "documents")
    pages = D.general_ad(spark, sf_dir)
    for rest in (0, 1):
        ads = details.general_ads(pages.filter(F.col("page_id") % 2 == rest), domain="")
        store.append_documents(documents.ad_document(details.usable(ads)), path)
    return _flat_ad(spark.read.parquet(path))


_LUXURY = f"""
SELECT page_id, 'Agence ' || page_id AS realtor, 'a' || page_id || '|b|c|d' AS address,
       'd' AS siren, 'a' || page_id AS carte_pro, '/s/' || page_id AS website,
       '02' || page_id AS phone, page_id || chr(160) || '€' AS price, {_AD} AS description,
       'alur' AS mention, page_id || ' m²' AS surface, '4 pièces' AS rooms
FROM pages
WHERE page_id % 6 <> 0 AND page_id % 13 >= 3 AND page_id % 11 >= 3
"""


def _flat_luxury(ads):
    return ads.select(
        F.col("RealtorName").alias("realtor"),
        F.array_join("RealtorAddress", "|").alias("address"), F.col("RealtroSiren").alias("siren"),
        F.col("RealtroCartePro").alias("carte_pro"),
        F.array_join("RealtorWebSite", "|").alias("website"),
        F.array_join("RealtorPhone", "|").alias("phone"),
        F.array_join("RealEstate_price", "|").alias("price"),
        F.array_join("RealEstate_desc", "|").alias("description"),
        F.array_join("RealEstate_price_mention", "|").alias("mention"),
        F.array_join("RealEstate_surface", "|").alias("surface"),
        F.array_join("RealEstate_nbrooms", "|").alias("rooms"), *[c for c in ads.columns if c == "page_id"])


@BOOK.query(f"SELECT * EXCLUDE (page_id) FROM ({_LUXURY})")
def appended_luxury_documents(spark, sf_dir):
    """Luxury ads stored as JSON, flat as they are, in two appends, and read by the schema."""
    path = scratch_dir(spark, "documents")
    pages = D.luxury_ad(spark, sf_dir)
    for rest in (0, 1):
        ads = details.luxury_ads(pages.filter(F.col("page_id") % 2 == rest), domain="")
        store.append_documents(documents.luxury_document(details.usable(ads)), path, "json")
    return _flat_luxury(spark.read.schema(schemas.AD_DETAIL).json(path))


@BOOK.query(_LUXURY)
def luxury_ad(spark, sf_dir):
    ads = details.usable(details.luxury_ads(D.luxury_ad(spark, sf_dir), domain="",
                                            keep=("page_id",)))
    return _flat_luxury(ads)


@BOOK.query(f"""
WITH {_ADS}, lux AS (
  SELECT page_id, page_id % 13 >= 3 AND page_id % 11 >= 3 AND page_id % 6 <> 0 AS ok FROM pages)
SELECT 'general' AS site, count(*)::BIGINT AS n, count(*)::BIGINT AS n_priced,
       count(*)::BIGINT AS n_prices, sum(CASE WHEN page_id % 5 <> 0 THEN 1 ELSE 0 END)::BIGINT AS n_siren
FROM judged WHERE outcome = 'ok'
UNION ALL
SELECT 'luxury', count(*)::BIGINT, count(*)::BIGINT, count(*)::BIGINT, count(*)::BIGINT FROM lux WHERE ok
""")
def wide_ad_details(spark, sf_dir):
    """Ads of both sites in the one raw schema."""
    parts = []
    for site, ads in (("general", details.general_ads(D.general_ad(spark, sf_dir), domain="")),
                      ("luxury", details.luxury_ads(D.luxury_ad(spark, sf_dir), domain=""))):
        parts.append(documents.wide_detail(details.usable(ads)).withColumn("site", F.lit(site)))
    return parts[0].unionByName(parts[1]).groupBy("site").agg(
        F.count("*").alias("n"),
        F.count_if(F.size("RealEstate_price") > 0).cast("bigint").alias("n_priced"),
        F.sum(F.size("RealEstate_price")).cast("bigint").alias("n_prices"),
        F.count("RealtroSiren").alias("n_siren"))


# Sale cards: distinct by address; the first link of each page occurs twice.
_SALES = f"""
{LINKS},
s AS (SELECT page_id, href, first(txt ORDER BY pos) AS txt, min(pos) AS pos FROM links
      GROUP BY page_id, href),
c AS (SELECT page_id, string_agg({decoded('href')} || '~vend ' || trim(txt) || '~/p' || {decoded('href')} || '.jpg', '|' ORDER BY pos) AS sales
      FROM s GROUP BY page_id)
"""


@BOOK.query(f"""
WITH {_SALES}
SELECT p.page_id, p.page_id::VARCHAR AS agency_id, 'Agence ' || p.page_id AS name,
       'adr ' || p.page_id AS address, '/w/' || p.page_id AS website, '03' || p.page_id AS phone,
       'un|deux' AS description, '/l/' || p.page_id || '.png' AS logo,
       '/v/' || p.page_id || '.png' AS images,
       CASE WHEN p.page_id % 8 <> 0
            THEN 'Team_Photo :/t1.png~Team_Name :Nom 1~Team Position :Poste 1|Team_Photo :None~Team_Name :Nom 2~Team Position :Poste 2|Team_Photo :None~Team_Name :Nom 3~Team Position :Poste 3'
            END AS team,
       sales, 'T1~g1~Paris~d1|T' || p.page_id || '~g2~Lyon~d2' AS sold
FROM pages p LEFT JOIN c ON p.page_id = c.page_id WHERE p.page_id % 9 <> 0
""")
def agency_profile(spark, sf_dir):
    profiles = details.usable(details.agencies(D.agency(spark, sf_dir), keep=("page_id",)))

    def flat(cards, *names):
        joined = each(cards, lambda c: f"concat_ws('~', {', '.join(f'{c}.{n}' for n in names)})")
        return f"array_join({joined}, '|')"

    team = flat(documents.labelled_team("Realtor_Team_infos"), "photo", "name", "position")
    sales = flat("Realtor_Ads_selling_infos", "url", "description", "picture")
    sold = flat("Realtor_sold_Ads_infos", "type", "description", "city", "details")
    return profiles.selectExpr(
        "page_id", "array_join(Realtor_ID, ',') AS agency_id",
        "array_join(RealtorName, '|') AS name", "RealtorAddress AS address",
        "RealtorWebSite AS website", "RealtorPhone AS phone",
        "array_join(Realtor_desc, '|') AS description", "array_join(Realtor_logo, '|') AS logo",
        "array_join(Realtor_imgs, '|') AS images", f"{team} AS team", f"{sales} AS sales",
        f"{sold} AS sold")


@BOOK.query("""
SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'extract_failed' ELSE 'ok' END AS outcome,
       CASE WHEN page_id % 9 = 0 THEN 'missing sold ads' END AS reason
FROM pages
""")
def agency_outcome(spark, sf_dir):
    return details.agencies(D.agency(spark, sf_dir), keep=("page_id",)) \
        .select("page_id", "outcome", "reason")


@BOOK.query(f"""
WITH {LINKS}
SELECT DISTINCT page_id, {decoded('href')} AS url, 'general' AS route FROM links
WHERE page_id % 9 <> 0
""")
def agency_ad_urls(spark, sf_dir):
    profiles = details.agencies(D.agency(spark, sf_dir), keep=("page_id",))
    return details.usable(profiles).select("page_id", F.explode("sale_urls").alias("url"),
                                           F.lit("general").alias("route"))


@BOOK.query(f"""
WITH {_SALES}
SELECT count(*)::BIGINT AS n, sum(CASE WHEN p.page_id % 8 <> 0 THEN 3 ELSE 0 END)::BIGINT AS n_team,
       (count(*) * 2)::BIGINT AS n_sold,
       (SELECT count(*) FROM s WHERE page_id % 9 <> 0)::BIGINT AS n_sale
FROM pages p WHERE p.page_id % 9 <> 0
""")
def agency_documents(spark, sf_dir):
    docs = documents.agency_document(details.usable(details.agencies(D.agency(spark, sf_dir))))
    return docs.agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce(F.size("Realtor_Team"), F.lit(0))).cast("bigint").alias("n_team"),
        F.sum(F.size("Realtor_Sold_Ads")).cast("bigint").alias("n_sold"),
        F.sum(F.coalesce(F.size("Realtor_Selling_Ads"), F.lit(0))).cast("bigint").alias("n_sale"))


@BOOK.query(f"""
WITH {LINKS},
s AS (SELECT page_id, href, first(txt ORDER BY pos) AS txt, min(pos) AS pos FROM links GROUP BY page_id, href)
SELECT s.page_id, {decoded('href')} AS url, 'vend ' || trim(txt) AS description,
       CASE WHEN regexp_matches(href, '[aeiou]$') THEN '/p' || {decoded('href')} || '.jpg' END AS picture,
       0::BIGINT AS n_dropped
FROM s WHERE s.page_id % 9 <> 0
""")
def agency_sales_whole(spark, sf_dir):
    """Sale ads, some without a picture, each from its own part of the page."""
    pages = D.agency(spark, sf_dir)
    picture = '<div class="c-pa-pic "><div class="c-pa-img"><img src="/p[^"]*[^aeiou"]\\.jpg"></div></div>'
    pages = pages.withColumn("html", F.regexp_replace("html", F.lit(picture), F.lit("")))
    profiles = details.usable(details.agencies(pages, keep=("page_id",), whole_cards=True))
    return profiles.select("page_id", F.explode("Realtor_Ads_selling_infos").alias("s"), F.col("n_sales_dropped").cast("bigint").alias("n_dropped")) \
        .select("page_id", "s.*", "n_dropped")
