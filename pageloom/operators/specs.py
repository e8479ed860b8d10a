"""Field specs of the page kinds."""

from __future__ import annotations

from typing import NamedTuple

from pageloom.functions import text as X
from pageloom.functions import urls as U
from pageloom.functions.areas import areas
from pageloom.functions.expr import case, each, let
from pageloom.functions.html import Element, element
from pageloom.operators.extract import Field

# Sites, address templates and markers that results depend on.
GENERAL_DOMAIN = "seloger.com"
LUXURY_DOMAIN = "bellesdemeures.com"
LUXURY_SITE = "www.bellesdemeures.com"
GENERAL_LISTING_URL = ("https://www.seloger.com/list.htm?tri=initial&idtypebien=2,1&idtt=2,5"
                       "&naturebien=1,2,4&cp=%s&LISTING-LISTpg=%d")
GENERAL_PAGES = (1, 199)
LUXURY_LISTING_URL = ("https://www.bellesdemeures.com/recherche?ci=%s&tri=Selection&idtt=2"
                      "&page=%d")
LUXURY_PAGES = (1, 5)
LUXURY_AREA = "750115"
LUXURY_DISTRICT = "15ème"
ROBOT_MARKER = "erreur"
EXPIRED_MARKER = "expiree"
PRICE_UNIT = "€ FAI*"
SURFACE_UNIT = "m²"
MAX_RETRIES = 5


class Listing(NamedTuple):
    """A search-result page: fields of its cards, the one that drives the zip, the card element."""
    fields: tuple[Field, ...]
    driver: str
    card: Element | None
    timed: bool
    domain: str


_LINK = element("a", class_is="c-pa-link link_AB")

GENERAL_LISTING = Listing(
    fields=(
        Field("AdsWebId", (element("div", id_prefix="annonce-"),), "@id"),
        Field("AdsUrl", (_LINK,), "//@href"),
        Field("AdsPrice", (element("div", class_is="h-fi-pulse annonce__detail__sauvegarde"),),
              "//@data-prix"),
        Field("AdsType", (_LINK,), "//@title"),
        Field("AdsCriterea", (element("div", class_is="c-pa-criterion"),), "outer"),
    ),
    driver="AdsWebId", card=element("div", id_prefix="annonce-"), timed=True,
    domain=GENERAL_DOMAIN)

LUXURY_LISTING = Listing(
    fields=(
        Field("AdsWebId", (element("p", class_is="contactButtonsItem agencyContactPhone "
                                   "js_contactPhone trackClick"),), "//@data-id"),
        Field("AdsUrl", (element("div", class_is="annonceItemContact"), element("a")), "//@href",
              post=lambda path: U.with_site(path, LUXURY_SITE)),
        Field("AdsPrice", (element("p", class_is="annonceItemPrice"),), "text"),
        Field("AdsType", (element("span", class_is="annonceItemType"),), "text"),
        Field("AdsCriterea", (element("span", class_is="annonceItemRoom"),), "outer"),
        Field("AdsCity", (element("strong", class_is="annonceItemCity"),), "text"),
    ),
    # These pages name no element around a whole card; callers that know one replace this.
    driver="AdsWebId", card=None, timed=False, domain=LUXURY_DOMAIN)


def _transaction(headings: str) -> str:
    """First word of each heading, joined; NULL when a heading is blank."""
    return let(each(headings, lambda h: X.nth_token(h, 1)), lambda words: case(
        (f"exists({words}, w -> w IS NULL)", "NULL"), otherwise=X.join_all(words)))


def _title(headings: str) -> str:
    """Words 5, 6, 7: all fifth words, then all sixth, then all seventh; NULL when one is short."""
    def words(lists: str) -> str:
        by_position = ", ".join(each(lists, lambda ws: f"try_element_at({ws}, {n})")
                                for n in (5, 6, 7))
        return case((f"forall({lists}, ws -> size(ws) >= 7)",
                     f"array_join(concat({by_position}), ' ')"))

    return let(each(headings, X.tokens), words)


def _input(name: str) -> tuple[Element, ...]:
    return (element("input", name=name),)


GENERAL_AD = (
    Field("RealEstateFeatures", (element("div", class_is="u-left"),), "visible", "all",
          rendered=True),
    Field("RealEstate_trans", (element("h1", class_is="detail-title title1"),), "text",
          _transaction, required=True),
    Field("RealEstate_title",
          (element("h2", class_is="title2 fi fi-house description-bien-title"),), "text",
          _title, required=True),
    Field("RealtorName", (element("*", class_token="agence-link"),), "text"),
    Field("RealtorAddress", (element("*", class_token="agence-adresse"),), "text"),
    Field("RealtroSiren", (element("div", class_is="legalNoticeAgency"), element("p")), "text", -1,
          post=lambda s: X.nth_token(s, 2)),
    Field("RealtorWebSite", (element("div", class_is="agence-links"), element("a")), "@href", -2,
          post=X.null_if_empty, required=True),
    Field("Realtor_Profile", _input("urlagence"), "@value", post=X.trim_blank, required=True),
    Field("RealtorWebId",
          (element("div", class_is="g-col g-50 sticky_button_bottom_col "
                                   "sticky_button_bottom_col_tel"),
           element("a", child=True)), "@data-idannonce", "join"),
    Field("RealEstate_type", (element("h2", class_is="c-h2"),), "text"),
    Field("RealEstate_Adress", (element("p", class_is="localite"),), "text"),
    Field("RealtorId", (element("div", class_is="c-main listing  p-detail c-detail-bar"),),
          "@data-publication-id", "join"),
    Field("RealtorPhone",
          (element("div", class_is="contact g-row-50"),
           element("div", class_is="g-col g-50 u-pad-0"),
           element("button", class_is="btn-phone b-btn b-second fi fi-phone tagClick")),
          "@data-phone"),
    Field("RealEstate_price", _input("prix"), "@value", post=X.trim_blank, required=True),
    Field("RealEstate_desc", _input("description"), "@value", post=X.trim_blank, required=True),
    Field("RealEstate_zip", _input("codepostal"), "@value", post=X.trim_blank, required=True),
    Field("RealEstate_surface", _input("surface"), "@value", post=X.trim_blank, required=True),
    Field("RealEstate_pieces", (element("li"),), "text"),
    Field("RealEstate_nbrooms", (element("li"),), "text", -2, required=True),
    Field("Realtor_logo", (element("div", class_is="agence-top"), element("img")), "@src", "all"),
    Field("RealEstate_img", (element("*", class_token="carrousel_image_small"),), "@src", "all"),
)

_SUMMARY = (element("*", class_token="detailMoreSummary"),)

LUXURY_AD = (
    Field("RealtorName", (element("span", class_is="agencyColLinkName"),), "text"),
    Field("RealtorAddress", _SUMMARY, "text", "all"),
    Field("RealtroSiren", _SUMMARY, "text", -1, required=True),
    Field("RealtroCartePro", _SUMMARY, "text", -4, required=True),
    Field("RealtorWebSite", (element("a", class_is="detailContactSite tagClick"),), "//@href",
          "all"),
    Field("RealtorPhone",
          (element("p", class_is="buttonBlack phoneBtn js_phoneBtn trackClickPopin"),),
          "//@data-phone", "all"),
    Field("RealEstate_price", (element("a", class_is="detailBanner js_favoritesParent"),),
          "//@data-short-price", "all"),
    Field("RealEstate_desc", (element("*", class_token="detailDescSummary"),), "text", "all"),
    Field("RealEstate_price_mention", (element("*", class_token="detailMoreAlur"),), "text",
          "all"),
    Field("RealEstate_surface", (element("li", class_is="annonceSpecsListItem js_livingArea"),),
          "text", "all"),
    Field("RealEstate_nbrooms", (element("li", class_is="annonceSpecsListItem js_nbRooms"),),
          "text", "all"),
)

_MEMBER = element("div", class_is="ag-team-member")
_SOLD = element("div", class_is="ag-bien-vendu")
_SALE_LINK = (element("div", class_is="c-pa-info"), element("a", child=True))


def _trim_all(values: str) -> str:
    return each(values, X.trim_blank)


AGENCY = (
    Field("RealtorName", (element("h1", itemprop="name"),), "text", "all"),
    Field("RealtorAddress", (element("div", class_is="subtitle"),), "text", 2,
          post=X.trim_blank, required=True),
    Field("RealtorWebSite", (element("a", class_is="b-link url-agency fi fi-agencywebsite"),),
          "@href"),
    Field("Realtor_logo", (element("div", class_is="img-container"), element("img")), "@src",
          "all"),
    Field("RealtorPhone", (element("div", class_is="hide"),), "text"),
    Field("Realtor_desc", (element("div", class_is="full"),), "text", "all", post=_trim_all),
    Field("Realtor_imgs",
          (element("div", class_is="g-col g-333 img-centered-panoramic"), element("img")), "@src",
          "all"),
    # The nested lists, still one array per selector; the agency plan zips them.
    Field("team_photo_tags", (element("div", class_is="portrait"), element("img", child=True)),
          "outer", "all", rendered=True),
    Field("team_name", (_MEMBER, element("div", class_is="description high")), "visible", "all",
          rendered=True),
    Field("team_position", (_MEMBER, element("div", class_is="description low")), "visible",
          "all", rendered=True),
    Field("sale_url", _SALE_LINK, "@href", "all", rendered=True),
    Field("sale_text", _SALE_LINK, "visible", "all", rendered=True),
    Field("sale_picture", (element("div", class_is="c-pa-pic "),
                           element("div", class_is="c-pa-img"), element("img")), "@src", "all",
          rendered=True),
    Field("sold_type", (_SOLD, element("div", class_is="title", child=True)), "visible", "all",
          rendered=True),
    Field("sold_tags", (_SOLD, element("div", class_is="tags", child=True)), "visible", "all",
          rendered=True),
    Field("sold_city", (_SOLD, element("div", class_is="city", child=True)), "visible", "all",
          rendered=True),
    Field("sold_details", (_SOLD, element("div", class_is="sold-details", child=True)), "visible",
          "all", rendered=True),
)

# The same sale ads card by card: where each one is, and its fields there. A picture may come before the rest.
SALE_CARDS = Field("sale_cards", (element("div", class_is="c-pa-info"),),
                   lambda page: areas(page, element("div", class_is="c-pa-info"), [element("div", class_is="c-pa-pic ")]),
                   "all", rendered=True)
SALE = {
    "url": Field("url", _SALE_LINK, "@href"),
    "description": Field("description", _SALE_LINK, "visible"),
    "picture": Field("picture", (element("div", class_is="c-pa-pic "), element("div", class_is="c-pa-img"), element("img")),
                     "@src"),
}

# The driver's own pages: one title, one ad block, a list of links.
_NAV_LINK = (element("li"), element("a"))

PLAIN_PAGE = (
    Field("lang", (element("html"),), "@lang"),
    Field("title", (element("title"),), "text", required=True),
    Field("heading", (element("h1"),), "text", required=True),
    Field("ad_text", (element("div", class_is="ad"),), "text"),
    Field("footer", (element("footer"),), "text"),
    Field("link_url", _NAV_LINK, "@href", "all"),
    Field("link_text", _NAV_LINK, "text", "all"),
)

PLAIN_LISTING = Listing(
    fields=(
        Field("AdsWebId", _NAV_LINK, "@href"),
        Field("AdsUrl", _NAV_LINK, "@href"),
        Field("AdsType", _NAV_LINK, "text"),
        Field("AdsCriterea", _NAV_LINK, "outer"),
    ),
    driver="AdsWebId", card=element("li"), timed=True, domain="")
