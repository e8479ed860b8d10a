"""Text values: tokens, criteria, prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalogue.book import SQL_BLANK, Book, sql_tokens
from pageloom.functions import text as X
from pageloom.sources.pages import spread

BOOK = Book()


@BOOK.query(f"""
WITH d AS (SELECT doc_id, text, {sql_tokens('text')} AS w FROM documents)
SELECT doc_id, w[1] AS first, w[3] AS third, w[-2] AS second_last, len(w)::BIGINT AS n,
       CASE WHEN len(w) >= 7 THEN w[5] || ' ' || w[6] || ' ' || w[7] END AS middle,
       length(regexp_replace(regexp_replace(text, '^{SQL_BLANK}+', ''), '{SQL_BLANK}+$', ''))::BIGINT
         AS trimmed_length
FROM d
""")
def text_tokens(spark, sf_dir):
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    words = docs.selectExpr(
        "doc_id", f"{X.tokens('text')} AS words",
        f"cast(length({X.trim_blank('text')}) AS bigint) AS trimmed_length")
    return words.selectExpr(
        "doc_id", "try_element_at(words, 1) AS first", "try_element_at(words, 3) AS third",
        "try_element_at(words, -2) AS second_last", "cast(size(words) AS bigint) AS n",
        "CASE WHEN size(words) >= 7 THEN array_join(slice(words, 5, 3), ' ') END AS middle",
        "trimmed_length")


@BOOK.query("""
SELECT p_partkey, p_size::BIGINT AS rooms, round(p_retailprice, 2)::DOUBLE AS surface_m2,
       (p_partkey % 30)::BIGINT AS floor, 3::BIGINT AS n_items
FROM part
""")
def criteria_tokens(spark, sf_dir):
    """Criteria rendered as the listing pages do, then read back."""
    size = F.col("p_size").cast("string")
    surface = F.translate(F.format_number("p_retailprice", 2), ",.", "\u00a0,")
    floor = (F.col("p_partkey") % 30).cast("string")
    block = F.concat(F.lit('<div class="c-pa-criterion">\r\n \t<em>'), size, F.lit(" p</em>\r\n<em>"),
                     surface, F.lit(" m²</em>\n<em> "), floor, F.lit(" etg\t</em></div>"))
    parts = spread(spark.read.parquet(f"{sf_dir}/part.parquet"))
    items = parts.withColumn("block", block).selectExpr(
        "p_partkey", f"{X.criteria_items('block')} AS items")
    typed = X.typed_criteria("items")
    return items.selectExpr(
        "p_partkey", f"cast({typed['rooms']} AS bigint) AS rooms",
        f"cast({typed['surface_m2']} AS double) AS surface_m2",
        f"cast({typed['floor']} AS bigint) AS floor", "cast(size(items) AS bigint) AS n_items")


@BOOK.query("""
SELECT l_returnflag, count(*)::BIGINT AS n,
       sum(l_extendedprice::DECIMAL(14,2))::DOUBLE AS total, 0::BIGINT AS n_unread
FROM lineitem GROUP BY l_returnflag
""")
def price_roundtrip(spark, sf_dir):
    """Prices rendered with no-break spaces and a decimal comma, then read back."""
    exact = F.col("l_extendedprice").cast("decimal(14,2)")
    shown = F.concat(F.translate(F.format_number(exact, 2), ",.", "\u00a0,"), F.lit(" €"))
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return spread(items.select("l_returnflag", "l_extendedprice")).select(
        "l_returnflag", shown.alias("shown")) \
        .selectExpr("l_returnflag", f"{X.amount('shown')} AS price") \
        .groupBy("l_returnflag").agg(
            F.count("*").alias("n"), F.sum("price").cast("double").alias("total"),
            F.count_if(F.col("price").isNull()).cast("bigint").alias("n_unread"))


@BOOK.query("""
SELECT p_partkey, round(p_retailprice, 2)::DOUBLE AS price, NULL::DOUBLE AS on_request,
       CASE WHEN p_size > 25 THEN p_size::VARCHAR END AS size_or_null
FROM part
""")
def price_values(spark, sf_dir):
    shown = F.concat(F.translate(F.format_number("p_retailprice", 2), ",.", "\u00a0,"), F.lit(" € FAI*"))
    size = F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).otherwise("")
    request = F.concat(F.lit("Prix nous consulter "), F.regexp_replace("p_name", "[0-9]", ""))
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", shown.alias("shown"), size.alias("size"), request.alias("request")) \
        .selectExpr("p_partkey", f"cast({X.amount('shown')} AS double) AS price",
                    f"cast({X.amount('request')} AS double) AS on_request",
                    f"{X.null_if_empty('size')} AS size_or_null")
