"""The driver's pages in the markup of the listing, ad and agency pages.

The driver's pages carry none of the classes the specs select by. Each query that runs a spec
rewrites every page of the table: its own links become cards, its own texts become fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.sources.pages import fetched_pages, read_pages

CARD = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir}/pages.parquet")


def _fetched(df: DataFrame) -> DataFrame:
    """Fetch facts derived from the page number: some redirects, markers and error codes."""
    n = F.col("page_id")
    final = (F.when(n % 13 == 0, F.concat("url", F.lit("/erreur-temporaire/")))
             .when(n % 13 == 1, F.concat("url", F.lit("/annonce-expiree/")))
             .otherwise(F.col("url")))
    status = (F.when(n % 11 == 0, 404).when(n % 11 == 1, 502).when(n % 11 == 2, 500)
              .otherwise(200))
    redirects = F.when(n % 13 < 3, F.array(F.concat(F.lit("https://old.example.com/?u="), "url")))
    return df.withColumns({
        "final_url": final, "status": status, "redirect_urls": redirects,
        "retry_times": (n % 7).cast("int"),
        "fetched_at": F.timestamp_seconds(F.lit(1704067200) + n * 60)})


def with_fetch_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetched_pages(_fetched(pages(spark, sf_dir)))


def _card_template(priced: bool) -> Column:
    price = ('<div class="h-fi-pulse annonce__detail__sauvegarde"><span data-prix="%s&nbsp;000 €">'
             "</span></div>")
    before = ('<div class="cartouche" id="annonce-$2"><div class="c-pa-info">'
              '<a class="c-pa-link link_AB" title="$2" href="$1">$2</a></div>')
    after = ('<div class="c-pa-criterion">\n\t<em>2 p</em>\r\n<em>%s,5 m²</em>'
             "<em>3 etg</em></div></div>")
    n = F.col("page_id").cast("string")
    if priced:
        return F.concat(F.format_string(before.replace("%", "%%") + price, n),
                        F.format_string(after, n))
    return F.concat(F.lit(before), F.format_string(after, n))


def general_listing(spark: SparkSession, sf_dir: str, facts: bool = False) -> DataFrame:
    """Each link a card; only links whose text ends in a vowel have a price."""
    vowel = CARD.replace("([^<]*)", "([^<]*[aeiou])")
    html = F.regexp_replace("html", F.lit(vowel), _card_template(True))
    df = pages(spark, sf_dir).withColumn("html", html)
    df = df.withColumn("html", F.regexp_replace("html", F.lit(CARD), _card_template(False)))
    return fetched_pages(_fetched(df) if facts else df)


def luxury_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = ('<li><p class="contactButtonsItem agencyContactPhone js_contactPhone trackClick">'
                '<b data-id="id$1"></b></p><div class="annonceItemContact"><i><a href="$1">x</a>'
                '</i></div><p class="annonceItemPrice">$2 €</p><span class="annonceItemType">'
                '$2</span><span class="annonceItemRoom">$2 p</span>'
                '<strong class="annonceItemCity">Paris $2</strong></li>')
    return fetched_pages(pages(spark, sf_dir).withColumn(
        "html", F.regexp_replace("html", CARD, template)))


def _insert(df: DataFrame, *blocks: Column | str) -> DataFrame:
    """Put a block in front of the footer of each page."""
    parts = [F.lit(b) if isinstance(b, str) else b for b in blocks]
    return df.withColumn("html", F.replace("html", F.lit("<footer>"),
                                           F.concat(*parts, F.lit("<footer>"))))


def general_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad pages. By page number some lack the price, the second-to-last link or the siren."""
    n, num = F.col("page_id"), F.col("page_id").cast("string")
    df = pages(spark, sf_dir).withColumns({
        "h1": F.regexp_extract("html", "<h1>([^<]*)</h1>", 1),
        "ad": F.regexp_extract("html", '<div class="ad">([^<]*)</div>', 1)})
    df = df.withColumn("html", F.regexp_replace("html", CARD, "<li>$2</li>"))
    df = df.withColumn("html", F.replace("html", F.lit("<h1>"),
                                         F.lit('<h1 class="detail-title title1">')))
    site = F.when(n % 4 == 0, "").otherwise(F.concat(F.lit("/site/"), num))
    links = F.when(n % 9 == 0, F.lit('<a href="/only">1</a>')).otherwise(F.concat(
        F.lit('<a href="/a">1</a><div><a href="'), site, F.lit('">2</a></div><a href="/c">3</a>')))
    df = _insert(
        df,
        '<h2 class="title2 fi fi-house description-bien-title">', F.col("h1"),
        '</h2><h2 class="c-h2">Type ', num, '</h2><p class="localite">', F.col("ad"), "</p>",
        '<div class="agence-top"><div><img alt="a > b" src="/logo/', num, '.png"></div></div>',
        '<a class="b agence-link x" href="#">Agence ', num, " &amp; fils</a>",
        "<span class='agence-adresse'>", num, " rue<br>Paris</span>",
        '<div class="legalNoticeAgency"><div>n</div><p>RCS</p><div><p>SIREN',
        F.when(n % 5 == 0, "").otherwise(F.concat(F.lit(" "), num)), "</p></div></div>",
        '<div class="agence-links">', links, "</div>",
        '<input type="hidden" name="urlagence" value=" /agence/', num, ' ">',
        F.when(n % 7 == 0, "").otherwise(F.concat(
            F.lit('<input name="prix" value="'), num, F.lit('000">'))),
        '<input name="description" value=" ', F.col("ad"), ' "><input name=codepostal value=0',
        num, '><input name="surface" value="', num, ',5">',
        '<div class="g-col g-50 sticky_button_bottom_col sticky_button_bottom_col_tel">'
        '<a data-idannonce="', num, '"></a><div><a data-idannonce="no"></a></div>'
        '<a data-idannonce="-b"></a></div>',
        '<div class="c-main listing  p-detail c-detail-bar" data-publication-id="pub', num,
        '"></div><div class="contact g-row-50"><div><div class="g-col g-50 u-pad-0"><button '
        'class="btn-phone b-btn b-second fi fi-phone tagClick" data-phone="01', num,
        '">t</button></div></div></div><img class="carrousel_image_small first" src="/i/', num,
        '-1.jpg"><img src="/no.jpg"><img src="/i/', num, '-2.jpg" class="carrousel_image_small">',
        '<div class="u-left">f', num, ' <b>&amp;</b> more</div><div class="u-left">g</div>')
    return fetched_pages(_fetched(df.drop("h1", "ad")))


def luxury_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Luxury ads. Pages divisible by 6 have three summary texts only, too few for the fourth
    from the end."""
    n, num = F.col("page_id"), F.col("page_id").cast("string")
    df = pages(spark, sf_dir).withColumn(
        "ad", F.regexp_extract("html", '<div class="ad">([^<]*)</div>', 1))
    df = _insert(
        df,
        '<span class="agencyColLinkName">Agence ', num, "</span>",
        '<div class="x detailMoreSummary">a', num, "<br>b<br>c",
        F.when(n % 6 == 0, "").otherwise("<br>d"), '</div><p class="detailDescSummary y">',
        F.col("ad"), '</p><p class="detailMoreAlur">alur</p>'
        '<a class="detailContactSite tagClick" href="/s/', num, '">s</a>'
        '<p class="buttonBlack phoneBtn js_phoneBtn trackClickPopin"><b data-phone="02', num,
        '"></b></p><a class="detailBanner js_favoritesParent"><i data-short-price="', num,
        '&nbsp;€"></i></a><ul><li class="annonceSpecsListItem js_livingArea">', num,
        ' m²</li><li class="annonceSpecsListItem js_nbRooms">4 pièces</li></ul>')
    return fetched_pages(_fetched(df.drop("ad")))


def agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agency profiles: links become sale ads (the first one twice), three team members, two sold
    ads. Pages divisible by 8 have no team, those divisible by 9 a sold ad without its city."""
    n, num = F.col("page_id"), F.col("page_id").cast("string")
    sale = ('<div class="c-pa-pic "><div class="c-pa-img"><img src="/p$1.jpg"></div></div>'
            '<div class="c-pa-info"><a href="$1">vend <b>$2</b></a></div>')
    df = pages(spark, sf_dir).withColumn(
        "first_card", F.regexp_extract("html", CARD, 0))
    df = df.withColumn("html", F.replace("html", F.lit("<nav><ul>"), F.concat(
        F.lit("<nav><ul>"), "first_card")))
    df = df.withColumn("html", F.regexp_replace("html", CARD, sale))

    def member(i: int, tag: str) -> str:
        return (f'<div class="ag-team-member"><div class="portrait">{tag}</div>'
                f'<div><div class="description high">Nom {i}</div>'
                f'<div class="description low">Poste <i>{i}</i></div></div></div>')

    team = (member(1, '<img src="/t1.png">') + member(2, "<img>")
            + member(3, '<img src="">'))
    df = _insert(
        df,
        '<div><h1 itemprop="name">Agence ', num, '</h1><div class="subtitle">un<br> adr ', num,
        ' </div></div><a class="b-link url-agency fi fi-agencywebsite" href="/w/', num, '">w</a>'
        '<div class="img-container"><div><img src="/l/', num, '.png"></div></div>'
        '<div class="hide">03', num, '</div><div class="full"> un <br> deux </div>'
        '<div class="g-col g-333 img-centered-panoramic"><img src="/v/', num, '.png"></div>',
        F.when(n % 8 == 0, "").otherwise(team),
        '<div class="ag-bien-vendu"><div class="title">T1</div><div class="tags">g1</div>'
        '<div class="city">Paris</div><div class="sold-details">d1</div></div>'
        '<div class="ag-bien-vendu"><div class="title">T', num, '</div><div class="tags">g2</div>',
        F.when(n % 9 == 0, "").otherwise('<div class="city">Lyon</div>'),
        '<div class="sold-details">d2</div></div>')
    df = df.withColumn("url", F.concat(
        F.lit("https://www.seloger.com/professionnels/agency-"), num, F.lit(".htm")))
    return fetched_pages(df.drop("first_card"))
