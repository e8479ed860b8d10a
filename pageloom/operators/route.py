"""Send records to named routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators import specs as S

# Markers in an ad's address, the first that matches decides.
GENERAL_ROUTES = (("bellesdemeures", "luxury"), ("selogerneuf", "new_build"))
GENERAL_DEFAULT = "general"
LUXURY_ROUTES = (("bellesdemeures", "luxury"),)
LUXURY_DEFAULT = "unknown_adsurl"


def route_of(url: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First rule whose marker is in the URL, else the default; NULL for no URL."""
    chain = F.when(url.isNull(), F.lit(None))
    for marker, route in rules:
        chain = chain.when(url.contains(marker), route)
    return chain.otherwise(default)


def of_kind(records: DataFrame, kind: str) -> DataFrame:
    return records.filter(F.col("Type") == kind)


def in_district(records: DataFrame, district: str = S.LUXURY_DISTRICT) -> DataFrame:
    """Case- and accent-sensitive."""
    return records.filter(F.col("AdsCity").contains(district))


def route_ads(records: DataFrame, cp: str | Column | None = None, site: str = "general",
              district: str | None = S.LUXURY_DISTRICT) -> DataFrame:
    """Ad URLs with ``route`` and ``cp``. The luxury site passes only ads of one district."""
    ads = of_kind(records, "SmallAds")
    rules, default = GENERAL_ROUTES, GENERAL_DEFAULT
    if site == "luxury":
        rules, default = LUXURY_ROUTES, LUXURY_DEFAULT
        if district is not None:
            ads = in_district(ads, district)
    cp = cp if isinstance(cp, Column) else F.lit(cp).cast("string")
    return ads.select(F.col("AdsUrl").alias("url"),
                      route_of(F.col("AdsUrl"), rules, default).alias("route"), cp.alias("cp"))


def deferred(records: DataFrame) -> DataFrame:
    return of_kind(records, "DeferedRequest").select("RequestUrl", "Raison")


def write_routes(routed: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    """One folder per route and cp. No shuffle: a hot route is written by every task that has it."""
    (routed.write.mode("append").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("route", "cp").parquet(path))


def read_routes(spark: SparkSession, path: str, columns: str = "url STRING") -> DataFrame:
    """What ``write_routes`` stored. Route and cp are text whatever they look like: cp '01' keeps its
    zero."""
    return spark.read.schema(f"{columns}, route STRING, cp STRING").parquet(path)
