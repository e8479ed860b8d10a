"""Golden pages per field spec, and the outcome rules."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pageloom import schemas
from pageloom.operators import documents, route
from pageloom.operators import specs as S
from pageloom.operators.cards import (ads_per_page, discover, distinct_by, listing_ads,
                                      union_sites, zip_lists)
from pageloom.plans import details, discovery
from pageloom.plans.steps import apply_steps, identity
from pageloom.sources.pages import fetched_pages

AT = datetime(2024, 1, 2, 3, 4, 5)


def page(html, url="https://www.seloger.com/p.htm", final=None, status=200, redirects=None,
         retries=0, rendered=None):
    return (url, final or url, status, redirects, retries, AT, html, rendered)


def table(spark, *pages):
    return spark.createDataFrame(list(pages), schemas.FETCHED_PAGE)


def card(i, price=True):
    paid = (f'<div class="h-fi-pulse annonce__detail__sauvegarde"><i data-prix="{i}00 €"></i></div>'
            if price else "")
    return (f'<div class="c" id="annonce-{i}"><div><a class="c-pa-link link_AB" title="T{i}" '
            f'href="/{i}">x</a></div>{paid}<div class="c-pa-criterion"><em>{i} p</em></div></div>')


GAP = card(1) + card(2, price=False) + card(3)


def test_listing_per_card_keeps_fields_with_their_card(spark):
    ads = listing_ads(discover(table(spark, page(GAP)), S.GENERAL_LISTING)).collect()
    assert [(a.AdsWebId, a.AdsUrl, a.AdsType, a.AdsPrice) for a in ads] == [
        ("annonce-1", "/1", "T1", "100 €"), ("annonce-2", "/2", "T2", None),
        ("annonce-3", "/3", "T3", "300 €")]
    assert {(a.Type, a.Time, a.AdsId, a.AdsCity) for a in ads} == {("SmallAds", AT, None, None)}
    assert ads[0].AdsCriterea == '<div class="c-pa-criterion"><em>1 p</em></div>'


def test_listing_positional_keeps_the_prefix_and_shifts_prices(spark):
    found = discover(table(spark, page(GAP)), S.GENERAL_LISTING, "positional")
    row = found.select("n_cards", "n_records", "n_dropped").first()
    assert tuple(row) == (3, 2, 1)
    ads = listing_ads(found).collect()
    assert [(a.AdsWebId, a.AdsPrice) for a in ads] == [("annonce-1", "100 €"),
                                                       ("annonce-2", "300 €")]


def test_listing_outcomes(spark):
    url = "https://www.seloger.com/list.htm"
    good = card(1)
    cases = {
        "ok": page(good, url + "?1"),
        "empty": page("<html></html>", url + "?2"),
        "status_404": page("", url + "?3", status=404),
        "status_502": page(None, url + "?4", status=502),
        "bad": page(good, url + "?5", status=500),
        "robot": page(good, url + "?6", final="https://www.seloger.com/erreur-temporaire/"),
        "expired": page(good, url + "?7", final="https://www.seloger.com/expiree"),
        "flag only": page(good, url + "?8", redirects=["https://www.seloger.com/erreur/"]),
        "off": page(good, "https://seloger.com.example.org/x"),
        "bad url": page(good, "not a url ::"),
        "sub": page(good, "https://m.seloger.com/x"),
    }
    found = discover(table(spark, *cases.values()), S.GENERAL_LISTING)
    got = {r.url: r for r in found.collect()}
    result = {k: (got[c[0]].outcome, got[c[0]].reason) for k, c in cases.items()}
    assert result == {
        "ok": ("ok", None), "empty": ("empty", "empty"), "status_404": ("empty", "status_404"),
        "status_502": ("empty", "status_502"), "bad": ("bad_status", "status_500"),
        "robot": ("robot_error", "robot_error"), "expired": ("expired", "expired"),
        "flag only": ("ok", None), "off": ("off_site", "off_site"),
        "bad url": ("off_site", "off_site"), "sub": ("ok", None)}
    flagged = got[cases["flag only"][0]]
    assert flagged.origin_robot_error and flagged.origin_url == "https://www.seloger.com/erreur/"


def test_failed_listing_is_retried_five_times_then_deferred(spark):
    pages = [page("", f"https://www.seloger.com/{n}", status=404, retries=n) for n in range(7)]
    found = discover(table(spark, *pages), S.GENERAL_LISTING)
    again = discovery.next_attempts(found, S.MAX_RETRIES).collect()
    assert sorted(r.priority for r in again) == [1, 2, 3, 4, 5]
    gone = discovery.given_up(found, S.MAX_RETRIES).collect()
    assert sorted((r.Type, r.RequestUrl[-1], r.Raison) for r in gone) == [
        ("DeferedRequest", "5", 404), ("DeferedRequest", "6", 404)]


def luxury_card(i, city):
    return (f'<p class="contactButtonsItem agencyContactPhone js_contactPhone trackClick">'
            f'<a data-id="{i}">t</a></p><div class="annonceItemContact"><a href="/ad/{i}">c</a>'
            f'</div><p class="annonceItemPrice">{i} €</p><span class="annonceItemType">T</span>'
            f'<span class="annonceItemRoom">r</span><strong class="annonceItemCity">{city}</strong>')


def test_luxury_listing_and_district_filter(spark):
    html = luxury_card(1, "Paris 15ème") + luxury_card(2, "Paris 7ème") + luxury_card(3, "15EME")
    found = discover(table(spark, page(html, "https://www.bellesdemeures.com/r")),
                     S.LUXURY_LISTING, "positional")
    ads = listing_ads(found)
    first = ads.first()
    assert (first.AdsWebId, first.AdsUrl, first.AdsPrice, first.AdsCity, first.Time) == (
        "1", "https://www.bellesdemeures.com/ad/1", "1 €", "Paris 15ème", None)
    routed = route.route_ads(ads, site="luxury").collect()
    assert [tuple(r) for r in routed] == [("https://www.bellesdemeures.com/ad/1", "luxury", None)]
    with pytest.raises(ValueError):
        discover(table(spark, page(html)), S.LUXURY_LISTING, "per_card")


def test_routes_first_rule_wins(spark, evaluate):
    chain = route.route_of(F.col("u"), route.GENERAL_ROUTES, route.GENERAL_DEFAULT)
    rows = spark.createDataFrame([("bellesdemeures selogerneuf",), ("x.selogerneuf",), ("",),
                                  (None,)], "u string")
    assert [r[0] for r in rows.select(chain).collect()] == ["luxury", "new_build", "general", None]


def test_records_are_split_by_kind(spark):
    ads = listing_ads(discover(table(spark, page(card(1))), S.GENERAL_LISTING))
    failed = discover(table(spark, page("", status=404, retries=5)), S.GENERAL_LISTING)
    records = union_sites(ads, discovery.given_up(failed, S.MAX_RETRIES))
    assert [r.AdsWebId for r in route.of_kind(records, "SmallAds").collect()] == ["annonce-1"]
    assert [tuple(r) for r in route.deferred(records).collect()] == [
        ("https://www.seloger.com/p.htm", 404)]
    assert [tuple(r) for r in route.route_ads(records, cp="75").collect()] == [
        ("/1", "general", "75")]


def test_sites_unite_in_one_schema(spark):
    general = listing_ads(discover(table(spark, page(card(1))), S.GENERAL_LISTING))
    luxury = listing_ads(discover(table(
        spark, page(luxury_card(2, "P"), "https://www.bellesdemeures.com/r")), S.LUXURY_LISTING,
        "positional")).drop("Time", "AdsId")
    both = union_sites(general, luxury)
    assert both.columns == [f.name for f in schemas.fields(schemas.LISTING_AD)]
    assert {r.AdsWebId for r in both.collect()} == {"annonce-1", "2"}


def test_ads_per_page_sums_fetches(spark):
    found = discover(table(spark, page(card(1)), page(GAP)), S.GENERAL_LISTING)
    assert [r.n_ads for r in ads_per_page(found).collect()] == [4]


AD = {
    "h1": '<h1 class="detail-title title1">Vente maison</h1>',
    "h2": '<h2 class="title2 fi fi-house description-bien-title">a b c d Appartement 3 pièces x</h2>',
    "name": '<a class="b agence-link">Agence &amp; Co</a>',
    "address": '<p class="agence-adresse">1 rue</p>',
    "siren": '<div class="legalNoticeAgency"><p>x</p><div><p>RCS 552100554</p></div></div>',
    "links": '<div class="agence-links"><a href="/1"></a><a href="/site"></a><a href="/3"></a></div>',
    "profile": '<input name="urlagence" value=" /agence ">',
    "webid": '<div class="g-col g-50 sticky_button_bottom_col sticky_button_bottom_col_tel">'
             '<a data-idannonce="12"></a><a data-idannonce="34"></a></div>',
    "type": '<h2 class="c-h2">Maison</h2>', "local": '<p class="localite">Paris</p>',
    "pub": '<div class="c-main listing  p-detail c-detail-bar" data-publication-id="9"></div>',
    "phone": '<div class="contact g-row-50"><div class="g-col g-50 u-pad-0"><button class="btn-phone'
             ' b-btn b-second fi fi-phone tagClick" data-phone="0102"></button></div></div>',
    "price": '<input name="prix" value="750 000">',
    "desc": "<input name='description' value=' Belle maison '>",
    "zip": '<input name="codepostal" value="07500">', "surface": '<input name="surface" value="43,33">',
    "li": "<ul><li>3 pièces</li><li>2 chambres</li><li>x</li></ul>",
    "logo": '<div class="agence-top"><p><img src="/l.png"></p></div>',
    "img": '<img class="carrousel_image_small" src="/a.jpg"><img class="carrousel_image_small" src="/b.jpg">',
    "features": '<div class="u-left">Ascenseur <b>oui</b></div>',
}


def ad(**changes):
    return page("<html>" + "".join({**AD, **changes}.values()) + "</html>")


def general(spark, html):
    return details.general_ads(table(spark, html)).first()


def test_complete_general_ad(spark):
    row = general(spark, ad())
    assert (row.outcome, row.reason, row.missing_fields) == ("ok", None, [])
    assert (row.RealEstate_trans, row.RealEstate_title) == ("Vente", "Appartement 3 pièces")
    assert (row.RealtorName, row.RealtorAddress, row.RealtroSiren) == (
        "Agence & Co", "1 rue", "552100554")
    assert (row.RealtorWebSite, row.Realtor_Profile, row.RealtorWebId, row.RealtorId) == (
        "/site", "/agence", "1234", "9")
    assert (row.RealEstate_type, row.RealEstate_Adress, row.RealtorPhone) == (
        "Maison", "Paris", "0102")
    assert (row.RealEstate_price, row.RealEstate_desc, row.RealEstate_zip) == (
        "750 000", "Belle maison", "07500")
    assert (row.RealEstate_pieces, row.RealEstate_nbrooms) == ("3 pièces", "2 chambres")
    assert (row.Realtor_logo, row.RealEstate_img) == (["/l.png"], ["/a.jpg", "/b.jpg"])
    assert (row.RealEstateFeatures, row.RealEstate_surface, row.Time) == (
        ["Ascenseur oui"], "43,33", AT)


@pytest.mark.parametrize("changes, outcome, field, value", [
    ({"features": ""}, "ok", "RealEstateFeatures", []),
    ({"h1": ""}, "ok", "RealEstate_trans", ""),
    ({"h1": '<h1 class="detail-title title1"> </h1>'}, "extract_failed", "RealEstate_trans", None),
    ({"h2": ""}, "ok", "RealEstate_title", ""),
    ({"h2": AD["h2"].replace(" 3 pièces x", "")}, "extract_failed", "RealEstate_title", None),
    ({"name": ""}, "ok", "RealtorName", None),
    ({"address": ""}, "ok", "RealtorAddress", None),
    ({"siren": ""}, "ok", "RealtroSiren", None),
    ({"siren": AD["siren"].replace(" 552100554", "")}, "ok", "RealtroSiren", None),
    ({"links": '<div class="agence-links"><a href="/1"></a></div>'}, "extract_failed",
     "RealtorWebSite", None),
    ({"links": AD["links"].replace("/site", "")}, "ok", "RealtorWebSite", None),
    ({"profile": ""}, "extract_failed", "Realtor_Profile", None),
    ({"webid": ""}, "ok", "RealtorWebId", ""),
    ({"type": ""}, "ok", "RealEstate_type", None),
    ({"local": ""}, "ok", "RealEstate_Adress", None),
    ({"pub": ""}, "ok", "RealtorId", ""),
    ({"phone": ""}, "ok", "RealtorPhone", None),
    ({"price": ""}, "extract_failed", "RealEstate_price", None),
    ({"desc": ""}, "extract_failed", "RealEstate_desc", None),
    ({"zip": ""}, "extract_failed", "RealEstate_zip", None),
    ({"surface": ""}, "extract_failed", "RealEstate_surface", None),
    ({"li": "<li>one</li>"}, "extract_failed", "RealEstate_nbrooms", None),
    ({"logo": "", "img": ""}, "ok", "Realtor_logo", []),
])
def test_general_ad_with_something_missing(spark, changes, outcome, field, value):
    row = general(spark, ad(**changes))
    assert (row.outcome, row[field]) == (outcome, value)
    assert (field in row.missing_fields) == (outcome != "ok")


def test_redirected_detail_page_gives_no_document(spark):
    html = ad()[6]
    pages = table(spark, page(html, redirects=["https://www.seloger.com/old"]),
                  page(html, final="https://www.seloger.com/annonce-expiree", redirects=["a"]),
                  page(html, redirects=["https://www.seloger.com/erreur-temporaire/"]),
                  page(html, status=404), page(html, status=None))
    rows = details.general_ads(pages).collect()
    assert [r.outcome for r in rows] == ["redirected", "expired", "robot_error", "bad_status",
                                         "not_fetched"]
    assert details.unusable(details.general_ads(pages)).count() == 5


def test_rendered_body_is_used_for_features(spark):
    seen = page(ad()[6], rendered='<div class="u-left">vu</div>')
    assert general(spark, seen).RealEstateFeatures == ["vu"]


def test_ad_document_and_its_json(spark):
    ads = details.general_ads(table(spark, ad()))
    docs = documents.ad_document(ads)
    doc = docs.first()
    assert (doc.Price.Realestate_Price_Unite, doc.Features.Realestate_Surface_Unite) == ("€ FAI*", "m²")
    assert doc.WebRealtor.externId == "1234" and doc.Creation_Date == AT
    text = documents.as_json(docs)
    back = text.select(F.from_json("value", schemas.AD_DOCUMENT).alias("d")).select("d.*").first()
    assert back == doc


def test_luxury_ad_needs_four_summary_texts(spark):
    def lux(*texts):
        return page('<div class="detailMoreSummary a">' + "<br>".join(texts) + "</div>",
                    "https://www.bellesdemeures.com/a")
    rows = details.luxury_ads(table(spark, lux("a", "b", "c", "d"), lux("a", "b", "c"))).collect()
    assert (rows[0].outcome, rows[0].RealtroSiren, rows[0].RealtroCartePro) == ("ok", "d", "a")
    assert rows[1].outcome == "extract_failed" and rows[1].missing_fields == ["RealtroCartePro"]
    wide = documents.wide_detail(details.luxury_ads(table(spark, lux("a", "b", "c", "d"))))
    assert wide.columns == [f.name for f in schemas.fields(schemas.AD_DETAIL)]


def agency(team=3, sold=('<div class="city">P</div>', '<div class="city">L</div>'), photo="src='/m'"):
    sale = "".join(
        f'<div class="c-pa-pic "><div class="c-pa-img"><img src="/p{i}"></div></div>'
        f'<div class="c-pa-info"><a href="/s{i}">vente {i}</a></div>' for i in (1, 2, 1))
    members = "".join(
        f'<div class="ag-team-member"><div class="portrait"><img {photo if i else ""}></div>'
        f'<div class="description high">N{i}</div><div class="description low">P{i}</div></div>'
        for i in range(team))
    done = "".join(f'<div class="ag-bien-vendu"><div class="title">t</div><div class="tags">g</div>'
                   f'{city}<div class="sold-details">d</div></div>' for city in sold)
    head = ('<h1 itemprop="name">A</h1><div class="subtitle">x<br> adr </div><div class="hide">01'
            '</div><div class="full"> d </div>')
    return page(head + members + sale + done, "https://www.seloger.com/a/agency-66070.htm")


def test_agency_profile(spark):
    row = details.agencies(table(spark, agency())).first()
    assert (row.outcome, row.Realtor_ID, row.RealtorAddress) == ("ok", ["66070"], "adr")
    assert [tuple(m) for m in row.Realtor_Team_infos] == [
        ("None", "N0", "P0"), ("/m", "N1", "P1"), ("/m", "N2", "P2")]
    assert [tuple(s) for s in row.Realtor_Ads_selling_infos] == [
        ("/s1", "vente 1", "/p1"), ("/s2", "vente 2", "/p2")]
    assert [s.city for s in row.Realtor_sold_Ads_infos] == ["P", "L"]
    assert (row.n_team_dropped, row.n_sales_dropped) == (0, 0)
    urls = details.agency_ad_urls(details.agencies(table(spark, agency()))).collect()
    assert [(u.url, u.route) for u in urls] == [("/s1", "general"), ("/s2", "general")]
    doc = documents.agency_document(details.agencies(table(spark, agency()))).first()
    assert doc.Realtor_Phone == "01" and doc.Realtor_Description == ["d"]


def test_agency_without_team_or_with_uneven_sold_ads(spark):
    rows = details.agencies(table(spark, agency(team=0), agency(sold=("", "<div class='city'>L</div>")),
                                  agency(sold=()))).collect()
    assert (rows[0].outcome, rows[0].Realtor_Team_infos) == ("ok", None)
    assert (rows[1].outcome, rows[1].reason) == ("extract_failed", "missing sold ads")
    assert (rows[2].outcome, rows[2].Realtor_sold_Ads_infos) == ("ok", None)


def test_zip_modes(spark):
    rows = spark.createDataFrame([(["a", "b", "c"], ["1", "2"]), ([], []), (["a"], ["1"])],
                                 "x array<string>, y array<string>")
    cut = rows.selectExpr(f"size({zip_lists({'x': 'x', 'y': 'y'})}) AS n").collect()
    strict = rows.selectExpr(f"size({zip_lists({'x': 'x', 'y': 'y'}, 'strict')}) AS n").collect()
    assert [r.n for r in cut] == [2, 0, 1]
    assert [r.n for r in strict] == [None, 0, 1]


def test_unpaired_items_are_counted(spark):
    rows = spark.createDataFrame([(["a", "b", "c"], ["1"]), (["a"], ["1"]), (None, ["1", "2"]), (None, None)],
                                 "x array<string>, y array<string>")
    assert [r.n for r in rows.selectExpr(f"{details._unpaired('x', 'y')} AS n").collect()] == [2, 0, 2, 0]


def test_distinct_by_keeps_the_first_and_all_nulls(spark):
    rows = spark.sql("SELECT array(named_struct('u', 'a', 'v', 1), named_struct('u', null, 'v', 2),"
                     "named_struct('u', 'a', 'v', 3), named_struct('u', null, 'v', 4)) AS c")
    assert [c.v for c in rows.selectExpr(f"{distinct_by('c', 'u')} AS d").first().d] == [1, 2, 4]


def test_pages_table_gets_defaults(spark):
    row = fetched_pages(spark.createDataFrame([("u", "h", 7)], "url string, html string, id int")).first()
    assert (row.id, row.final_url, row.status, row.redirect_urls, row.retry_times) == (
        7, "u", 200, None, 0)


def test_steps_run_by_order_number(spark):
    df = spark.range(1).selectExpr("'' AS s")
    add = lambda x: (lambda d: d.selectExpr(f"concat(s, '{x}') AS s"))
    assert apply_steps(df, [(2, add("b")), (1, add("a")), (0, identity)]).first().s == "ab"


def test_tasks_of_a_page_table_stay_bounded(spark, tmp_path, monkeypatch):
    from pageloom.sources import pages as P
    monkeypatch.setattr(P, "PAGES_PER_TASK", 10)
    spark.range(95).selectExpr("id AS page_id", "'<p>' AS html").coalesce(1).write.parquet(f"{tmp_path}/pages")
    found = P.read_pages(spark, f"{tmp_path}/pages")
    assert found.rdd.getNumPartitions() == 10 and found.count() == 95


def test_nested_lists_of_an_agency_are_taken_once(spark):
    """However often later steps ask for them: a filter and an explosion do."""
    found = details.usable(details.agencies(table(spark, agency()), whole_cards=True))
    text = found.selectExpr("explode(Realtor_Ads_selling_infos) AS s")._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in text.splitlines() if "c-pa-img" in line]
    assert lines and not any(line.strip(" +-:").startswith("Filter") for line in lines)
