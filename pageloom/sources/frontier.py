"""URLs of search-result pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.urls import canonical
from pageloom.operators import specs as S
from pageloom.operators import store


def listing_urls(params: DataFrame, column: str, template: str,
                 pages: tuple[int, int]) -> DataFrame:
    """Every page number for every parameter row. A narrow expansion: nothing is joined."""
    numbered = params.select(
        F.col(column).cast("string").alias("cp"),
        F.explode(F.sequence(F.lit(pages[0]), F.lit(pages[1]))).alias("page_no"))
    return numbered.select("cp", "page_no", F.format_string(template, "cp", "page_no").alias("url"))


def general_listing_urls(params: DataFrame, column: str = "cp") -> DataFrame:
    return listing_urls(params, column, S.GENERAL_LISTING_URL, S.GENERAL_PAGES)


def luxury_listing_urls(params: DataFrame, column: str = "cp") -> DataFrame:
    return listing_urls(params, column, S.LUXURY_LISTING_URL, S.LUXURY_PAGES)


def luxury_default_urls(spark) -> DataFrame:
    """The one area the luxury job asks for."""
    return luxury_listing_urls(spark.range(1).select(F.lit(S.LUXURY_AREA).alias("cp")))


def distinct_requests(requests: DataFrame, is_retry: Column) -> DataFrame:
    """Each URL once, retries always. Duplicates are dropped before the shuffle where they meet."""
    fresh = requests.filter(~F.coalesce(is_retry, F.lit(False))).dropDuplicates(["url"])
    return fresh.unionByName(requests.filter(is_retry))


def unseen_requests(requests: DataFrame, is_retry: Column, path: str, batch_id: int, crawl: str | None = None,
                    **index) -> DataFrame:
    """Of a batch of requests those whose canonical URL no batch has asked for before, one per URL, and all
    retries; with ``canonical_url``.

    What was asked for is stored at ``path``, with an index of which only the parts that this batch's URLs can
    be in are read (``store.insert_rows``). A batch that is tried again gives the same requests.
    """
    marked = requests.withColumn("canonical_url", F.expr(canonical("url")))
    retries = F.coalesce(is_retry, F.lit(False))
    store.insert_rows(marked.filter(~retries), path, "canonical_url", requests.columns, batch_id, crawl, **index)
    fresh = store.committed_rows(requests.sparkSession, path, crawl, batch_id)
    again = marked.filter(retries)
    return again if fresh is None else fresh.select(*marked.columns).unionByName(again)
