"""HTML selection on the driver's pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalogue.book import LINKS, Book, decoded, sql_tokens
from pageloom.catalogue.dressed import CARD, pages
from pageloom.functions import text as X
from pageloom.functions import urls as U
from pageloom.functions.html import element
from pageloom.operators import specs as S
from pageloom.operators.extract import Field, extract_fields
from pageloom.plans.steps import apply_steps, identity
from pageloom.session import scratch_dir
from pageloom.sources.frontier import distinct_requests, unseen_requests

BOOK = Book()

_NAV = (element("li"), element("a"))

_FIRST_MATCH = f"""
SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
       {decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
       {decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS heading,
       {decoded("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")} AS ad_text,
       {decoded("regexp_extract(html, '<footer>([^<]*)</footer>', 1)")} AS footer
FROM pages
"""

_FIRST_FIELDS = [f for f in S.PLAIN_PAGE if f.pick == "first"]


@BOOK.query(_FIRST_MATCH)
def first_match_fields(spark, sf_dir):
    return extract_fields(pages(spark, sf_dir), _FIRST_FIELDS, keep=["page_id"]) \
        .drop("missing_fields")


@BOOK.query(_FIRST_MATCH)
def ordered_steps(spark, sf_dir):
    steps = [
        (300, lambda df: df.drop("missing_fields")),
        (1, identity),
        (200, lambda df: extract_fields(df, _FIRST_FIELDS, keep=["page_id"])),
    ]
    return apply_steps(pages(spark, sf_dir), steps)


@BOOK.query(f"""
WITH {LINKS}
SELECT page_id, pos::BIGINT AS pos, {decoded('href')} AS link_url, txt AS link_text,
       '<a href="' || href || '">' || regexp_extract(
         regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')[pos], '>([^<]*)</a>', 1)
       || '</a>' AS outer_html,
       (count(*) OVER (PARTITION BY page_id))::BIGINT AS n_links
FROM links
""")
def all_match_links(spark, sf_dir):
    fields = [Field("link_url", _NAV, "@href", "all"), Field("link_text", _NAV, "text", "all"),
              Field("outer_html", _NAV, "outer", "all")]
    df = extract_fields(pages(spark, sf_dir), fields, keep=["page_id"])
    zipped = F.arrays_zip("link_url", "link_text", "outer_html")
    return df.select("page_id", F.size("link_url").cast("bigint").alias("n_links"),
                     F.posexplode(zipped).alias("pos", "m")) \
        .select("page_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "m.*", "n_links")


@BOOK.query(f"""
WITH {LINKS}, l AS (SELECT page_id, list(txt ORDER BY pos) AS t FROM links GROUP BY page_id)
SELECT p.page_id, t[2] AS second, t[-1] AS last, t[-2] AS second_last, t[-6] AS sixth_last,
       (t[6] IS NULL)::BIGINT AS fails
FROM pages p LEFT JOIN l ON p.page_id = l.page_id
""")
def nth_from_end(spark, sf_dir):
    fields = [Field("second", _NAV, "text", 2), Field("last", _NAV, "text", -1),
              Field("second_last", _NAV, "text", -2), Field("sixth_last", _NAV, "text", -6),
              Field("sixth", _NAV, "text", 6, required=True)]
    df = extract_fields(pages(spark, sf_dir), fields, keep=["page_id"])
    return df.select("page_id", "second", "last", "second_last", "sixth_last",
                     (F.size("missing_fields") > 0).cast("bigint").alias("fails"))


@BOOK.query(f"""
WITH {LINKS}, l AS (SELECT page_id, string_agg(txt, '' ORDER BY pos) AS t FROM links
                    GROUP BY page_id),
h AS (SELECT page_id, {sql_tokens(decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))} AS w
      FROM pages)
SELECT h.page_id, coalesce(t, '') AS joined,
       CASE WHEN len(w) >= 7 THEN w[5] || ' ' || w[6] || ' ' || w[7] END AS title_words
FROM h LEFT JOIN l ON h.page_id = l.page_id
""")
def joined_matches(spark, sf_dir):
    fields = [Field("joined", _NAV, "text", "join"),
              Field("title_words", (element("h1"),), "text", post=lambda t: X.token_range(t, 5, 3))]
    return extract_fields(pages(spark, sf_dir), fields, keep=["page_id"]).drop("missing_fields")


def _marked_up(spark, sf_dir):
    """Attributes the driver's pages lack, put on their own elements."""
    html = F.replace("html", F.lit('class="ad"'), F.lit('class="ad x"'))
    num = F.col("page_id").cast("string")
    html = F.replace(html, F.lit("<article"), F.concat(
        F.lit('<article id="annonce-'), num, F.lit('"')))
    html = F.replace(html, F.lit("<footer"), F.concat(
        F.lit('<input name="prix" value=" '), num, F.lit(' "><footer')))
    return pages(spark, sf_dir).withColumn("html", html)


@BOOK.query(f"""
SELECT page_id, {decoded("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")} AS by_token,
       NULL::VARCHAR AS by_whole_value
FROM pages
""")
def class_token_match(spark, sf_dir):
    fields = [Field("by_token", (element("div", class_token="ad"),), "text"),
              Field("by_whole_value", (element("div", class_is="ad"),), "text")]
    return extract_fields(_marked_up(spark, sf_dir), fields, keep=["page_id"]) \
        .drop("missing_fields")


@BOOK.query("SELECT page_id, 'annonce-' || page_id AS ad_id FROM pages")
def id_prefix_match(spark, sf_dir):
    fields = [Field("ad_id", (element("article", id_prefix="annonce-"),), "@id")]
    return extract_fields(_marked_up(spark, sf_dir), fields, keep=["page_id"]) \
        .drop("missing_fields")


@BOOK.query("SELECT page_id, page_id::VARCHAR AS price, 0::BIGINT AS fails FROM pages")
def input_by_name(spark, sf_dir):
    fields = [Field("price", (element("input", name="prix"),), "@value", post=X.trim_blank,
                    required=True)]
    df = extract_fields(_marked_up(spark, sf_dir), fields, keep=["page_id"])
    return df.select("page_id", "price", F.size("missing_fields").cast("bigint").alias("fails"))


@BOOK.query(f"""
WITH {LINKS}
SELECT page_id, len(list(href))::BIGINT AS n_links, len(list_distinct(list(href)))::BIGINT AS n_urls,
       len(list_distinct(list(txt)))::BIGINT AS n_texts,
       first(href ORDER BY pos) AS first_url
FROM links GROUP BY page_id
""")
def distinct_links(spark, sf_dir):
    df = extract_fields(pages(spark, sf_dir), S.PLAIN_PAGE, keep=["page_id"])
    urls = F.array_distinct("link_url")
    return df.filter(F.size("link_url") > 0).select(
        "page_id", F.size("link_url").cast("bigint").alias("n_links"),
        F.size(urls).cast("bigint").alias("n_urls"),
        F.size(F.array_distinct("link_text")).cast("bigint").alias("n_texts"),
        F.try_element_at(urls, F.lit(1)).alias("first_url"))


@BOOK.query(f"""
WITH {LINKS}, r AS (SELECT href AS url, page_id % 10 = 0 AS is_retry FROM links)
SELECT url, 0::BIGINT AS retry, 1::BIGINT AS n FROM (SELECT DISTINCT url FROM r WHERE NOT is_retry)
UNION ALL
SELECT url, 1::BIGINT, count(*)::BIGINT FROM r WHERE is_retry GROUP BY url
""")
def distinct_frontier(spark, sf_dir):
    df = extract_fields(pages(spark, sf_dir), S.PLAIN_PAGE, keep=["page_id"])
    requests = df.select(F.explode("link_url").alias("url"),
                         (F.col("page_id") % 10 == 0).alias("is_retry"))
    kept = distinct_requests(requests, F.col("is_retry"))
    return kept.groupBy("url", F.col("is_retry").cast("bigint").alias("retry")) \
        .agg(F.count("*").alias("n"))


@BOOK.query(r"""
SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host,
       string_split(url, '/')[-1] AS last_segment,
       array_to_string(regexp_extract_all(string_split(url, '/')[-1], '[0-9]+'), ',') AS digits,
       nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
       (regexp_extract(url, '^https?://([^/?#]+)', 1) = 'example.com'
        OR regexp_extract(url, '^https?://([^/?#]+)', 1) LIKE '%.example.com')::BIGINT AS on_site,
       'https://www.example.com' || regexp_replace(url, '^https?://[^/]+', '') AS moved
FROM pages
""")
def url_parts(spark, sf_dir):
    path = "regexp_replace(url, '^https?://[^/]+', '')"
    last = U.last_segment("url")
    return pages(spark, sf_dir).selectExpr(
        "page_id", f"{U.host('url')} AS host", f"{last} AS last_segment",
        f"array_join({U.digit_runs(last)}, ',') AS digits",
        f"{U.query_parameter('url', 'page')} AS page",
        f"cast({U.on_domain('url', ['example.com'])} AS bigint) AS on_site",
        f"{U.with_site(path, 'www.example.com')} AS moved")


@BOOK.query(f"""
SELECT page_id,
       trim({decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}) AS heading_text,
       len(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>'))::BIGINT AS n_items
FROM pages
""")
def rendered_text(spark, sf_dir):
    """Visible text over the rendered body; here the page itself, as nothing was rendered."""
    fields = [Field("heading_text", (element("h1"),), "visible", rendered=True),
              Field("items", (element("ul"), element("li")), "visible", "all", rendered=True)]
    df = extract_fields(pages(spark, sf_dir), fields, keep=["page_id"])
    return df.select("page_id", "heading_text", F.size("items").cast("bigint").alias("n_items"))


@BOOK.query(f"""
WITH {LINKS},
t AS (SELECT page_id, list(txt ORDER BY pos) AS a, list({decoded('href')} ORDER BY pos) AS b
      FROM links GROUP BY page_id),
n AS (SELECT page_id, flatten(list_transform(range(1, len(a) + 1), lambda i: [a[i], b[i], page_id::VARCHAR])) AS x FROM t)
SELECT p.page_id, coalesce(len(x), 0)::BIGINT AS n_texts, x[1] AS first, x[2] AS second, x[-1] AS last,
       x[-2] AS second_last, x[-4] AS fourth_last, coalesce(array_to_string(x, '|'), '') AS all_texts,
       coalesce(array_to_string(x, '|'), '') AS in_spans
FROM pages p LEFT JOIN n ON p.page_id = n.page_id
""")
def nested_texts(spark, sf_dir):
    """Each link a match that holds another one: texts come in the order of the page, not of the matches."""
    def dressed(tag):
        block = f'<{tag} class="n">$2<{tag} class="n">$1</{tag}>'
        return F.concat(F.lit(block), F.col("page_id").cast("string"), F.lit(f"</{tag}>"))

    strong, span = (F.regexp_replace("html", F.lit(CARD), dressed(tag)) for tag in ("strong", "span"))
    df = pages(spark, sf_dir).withColumn("html", F.concat(strong, span))
    path = (element("strong", class_is="n"),)
    fields = [Field("first", path, "text"), Field("second", path, "text", 2), Field("last", path, "text", -1),
              Field("second_last", path, "text", -2), Field("fourth_last", path, "text", -4),
              Field("found", path, "text", "all"), Field("inside", (element("span", class_is="n"),), "text", "all")]
    return extract_fields(df, fields, keep=["page_id"]).select(
        "page_id", F.size("found").cast("bigint").alias("n_texts"), "first", "second", "last", "second_last", "fourth_last",
        F.array_join("found", "|").alias("all_texts"), F.array_join("inside", "|").alias("in_spans"))


@BOOK.query(f"""
WITH {LINKS}
SELECT page_id, pos::BIGINT AS pos, txt AS item, '<li class="n">' || regexp_extract(
         regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')[pos], '>([^<]*)</a>', 1) || '</li>' AS outer_html,
       txt AS cell, {decoded('href')} AS definition
FROM links
""")
def left_out_ends(spark, sf_dir):
    """Each link an item, a table row and a definition, all of whose ends are left out."""
    def listed(tag, block):
        cards = F.array_join(F.regexp_extract_all("html", F.lit(CARD), F.lit(0)), "")
        return F.concat(F.lit(f"<{tag}>"), F.regexp_replace(cards, CARD, block), F.lit(f"</{tag}>"))

    df = pages(spark, sf_dir).withColumn("html", F.concat(
        listed("ul", '<li class="n">$2'), listed("table", "<tr><td>$2<td>x"), listed("dl", "<dt>$2<dd>$1"), F.lit("<p>after")))
    fields = [Field("item", (element("li", class_is="n"),), "visible", "all"),
              Field("outer_html", (element("li", class_is="n"),), "outer", "all"),
              Field("cell", (element("tr"),), "visible", "all"),
              Field("definition", (element("dd"),), "text", "all")]
    df = extract_fields(df, fields, keep=["page_id"])
    cells = F.transform("cell", lambda c: F.regexp_replace(c, " x$", ""))
    return df.select("page_id", F.posexplode(F.arrays_zip("item", "outer_html", cells.alias("cell"), "definition")).alias("pos", "m")) \
        .select("page_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "m.*")


@BOOK.query(f"""
WITH {LINKS}, r AS (SELECT 'https://www.example.com' || href AS u, page_id % 10 = 0 AS is_retry FROM links)
SELECT u || '?a=1&b=' || n AS url, 0::BIGINT AS retry, 1::BIGINT AS n
FROM (SELECT DISTINCT u FROM r WHERE NOT is_retry), (VALUES ('%2F'), ('~')) v(n)
UNION ALL
SELECT u || '?a=1&b=' || n, 1::BIGINT, count(*)::BIGINT FROM r, (VALUES ('%2F'), ('~')) v(n) WHERE is_retry GROUP BY u, n
""")
def distinct_crawl(spark, sf_dir):
    """Requests of two batches, each URL written differently every time: one per canonical URL over both."""
    df = extract_fields(pages(spark, sf_dir), S.PLAIN_PAGE, keep=["page_id"])
    links = df.select(F.explode("link_url").alias("link"), (F.col("page_id") % 10 == 0).alias("is_retry"), "page_id")
    n = F.col("page_id") % 4
    site = F.when(n == 0, "https://www.example.com").when(n == 1, "HTTPS://WWW.Example.com").when(n == 2, "https://www.example.com:443") \
        .otherwise("https://WWW.example.com")
    path, out = scratch_dir(spark, "crawl"), []
    for batch, (slash, tilde) in enumerate((("%2f", "%7E"), ("%2F", "~"))):
        value = F.explode(F.array(F.lit(slash), F.lit(tilde)))
        requests = links.filter(F.pmod("page_id", F.lit(3)) != batch).select("link", "is_retry", "page_id", value.alias("v"))
        url = F.when(n % 2 == 0, F.concat(site, "link", F.lit("?b="), "v", F.lit("&a=1#top"))) \
            .otherwise(F.concat(site, "link", F.lit("?a=1&&b="), "v"))
        out.append(unseen_requests(requests.select(url.alias("url"), "is_retry", "page_id"), F.col("is_retry"), path, batch))
    both = out[0].unionByName(out[1]).dropDuplicates(["canonical_url", "is_retry", "page_id"])
    return both.groupBy(F.col("canonical_url").alias("url"), F.col("is_retry").cast("bigint").alias("retry")) \
        .agg(F.count("*").alias("n"))
